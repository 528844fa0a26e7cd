"""Conversation structure repair: the cheapest edits that give every conversation alternating turns.

A conversation's rows become symbols (role initial and fault); equal neighbours are one run. A run is a
4 x 4 min-plus matrix over the states start, after system, after user, after assistant, and a run of any
length is a product of cached binary powers of its symbol's matrix. Matrices compose, so a conversation is
cut into pieces wherever the range partitioning by conversation and turn cuts it: each piece is summed up by
itself, costs are carried backwards over the few pieces of a conversation, each piece unrolls its choices for
every state it may be entered in, and the last pass picks the pieces that fit together while it reads the texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlake.llm.frames import picked, stored

# Fixed values of the contract: costs, and the roles that rerole and insert give.
DELETE_COST = 4
REROLE_COST = 3
INSERT_COST = 3
TRUNCATED_COST = 3
USER, ASSISTANT = "user", "assistant"
LEGAL_PAIRS = ("su", "ua", "au")

_NOT_BLANK = r"[^\x20\x09-\x0D]"
_ENDED = r"[.!?][\x20\x09-\x0D]*\z"

_FAR = 1 << 60
# The states; an insert or a rerole always leads to the turn that must follow.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_STATES = range(4)
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
_ENDS = (_START, _ASSISTANT)
# Where keeping a row leads, by the class of its initial (s, u, a, other) and the state before it.
_KEEP = (
    (_SYSTEM, None, None, None),
    (_USER, _USER, None, _USER),
    (None, None, _ASSISTANT, None),
    (None, None, None, None),
)
# Symbols: twice the class, plus one if truncated; and rows that must be deleted.
_GONE = 8
# Runs up to this length are unrolled row by row; longer ones are halved.
_SHORT = 64
_CACHED_RUNS = 64

Matrix = tuple[tuple[int, ...], ...]
Vector = tuple[int, ...]
Runs = tuple[tuple[int, int], ...]


def damage(conversations: DataFrame) -> DataFrame:
    """The rows of `(conv_id, turn, role, text)` damaged by a fixed rule on crc32 of `conv_id:turn`, modulo 20.

    0 drops a row (`copies` 0), 1 empties its text, 2 takes its `.`, `!` and `?` away, 3 repeats it (`copies`
    2), 4 makes its role user. NULLs count as one space in the key, the role and the text.
    """

    def plain(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    rule = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn"))) % 20
    text = F.when(F.col("rule") == 1, "").when(F.col("rule") == 2, F.regexp_replace("plain_text", "[.!?]", ""))
    return (
        conversations.select("conv_id", "turn", plain("role").alias("plain_role"), plain("text").alias("plain_text"), rule.alias("rule"))
        .select(
            "conv_id",
            "turn",
            F.when(F.col("rule") == 4, USER).otherwise(F.col("plain_role")).alias("role"),
            text.otherwise(F.col("plain_text")).alias("text"),
            F.when(F.col("rule") == 0, 0).when(F.col("rule") == 3, 2).otherwise(1).alias("copies"),
        )
    )


# --- The min-plus machine -----------------------------------------------------------------------


def _step_options(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, state after it) for one row, in the order of the edits' initials."""
    options = [("D", DELETE_COST, state)]
    if symbol != _GONE:
        truncated = TRUNCATED_COST * (symbol % 2)
        kept = _KEEP[symbol // 2][state]
        if kept is not None:
            options.append(("K", truncated, kept))
        options.append(("R", REROLE_COST + truncated, _NEXT[state]))
    return options


def _product(left: Matrix, right: Matrix) -> Matrix:
    return tuple(tuple(min(left[i][k] + right[k][j] for k in _STATES) for j in _STATES) for i in _STATES)


def _applied(matrix: Matrix, vector: Vector) -> Vector:
    return tuple(min(matrix[i][k] + vector[k] for k in _STATES) for i in _STATES)


@lru_cache(maxsize=None)  # 9 symbols, at most 63 powers each
def transition(symbol: int, power: int = 0) -> Matrix:
    """Least costs from state to state over 2**power rows of one symbol, inserts before each row included."""
    if power:
        half = transition(symbol, power - 1)
        return _product(half, half)
    rows = []
    for state in _STATES:
        row, cost, at = [_FAR] * len(_STATES), 0, state
        for _ in _STATES:  # no cheapest edit inserts a whole round
            for _, more, after in _step_options(symbol, at):
                row[after] = min(row[after], cost + more)
            cost, at = cost + INSERT_COST, _NEXT[at]
        rows.append(tuple(row))
    return tuple(rows)


def advance(symbol: int, length: int, vector: Vector) -> Vector:
    """Costs to go before a run, from those after it: one step per binary digit of its length."""
    power = 0
    while length:
        if length & 1:
            vector = _applied(transition(symbol, power), vector)
        length, power = length >> 1, power + 1
    return vector


def final_costs() -> Vector:
    """Costs to go after the last row: the inserts that complete the last pair."""
    costs = []
    for state in _STATES:
        cost = 0
        while state not in _ENDS:
            cost, state = cost + INSERT_COST, _NEXT[state]
        costs.append(cost)
    return tuple(costs)


def _runs_matrix(runs: Runs) -> Matrix:
    columns = []
    for end in _STATES:
        vector: Vector = tuple(0 if state == end else _FAR for state in _STATES)
        for symbol, length in reversed(runs):
            vector = advance(symbol, length, vector)
        columns.append(tuple(min(cost, _FAR) for cost in vector))
    return tuple(zip(*columns, strict=True))


def _unroll_run(symbol: int, length: int, after: Vector, state: int) -> tuple[str, int]:
    if symbol == _GONE:  # a delete leaves the state alone, so it may always come before an insert
        return "D" * length, state
    if length > _SHORT:
        half = length // 2
        first, state = _unroll_run(symbol, half, advance(symbol, length - half, after), state)
        rest, state = _unroll_run(symbol, length - half, after, state)
        return first + rest, state
    costs = [after]
    for _ in range(length):
        costs.append(_applied(transition(symbol), costs[-1]))
    edits = []
    for place in range(length, 0, -1):
        here, following = costs[place], costs[place - 1]
        while True:
            options = _step_options(symbol, state)
            options.insert(1, ("I", INSERT_COST, _NEXT[state]))
            edit, _, reached = next(
                option for option in options
                if option[1] + (here if option[0] == "I" else following)[option[2]] == here[state]
            )
            edits.append(edit)
            state = reached
            if edit != "I":
                break
    return "".join(edits), state


def _unroll(runs: Runs, after: Vector, state: int) -> tuple[str, int]:
    """The ASCII-least of the cheapest edits of some rows entered in `state`, and the state they end in."""
    costs = [after]
    for symbol, length in reversed(runs):
        costs.append(advance(symbol, length, costs[-1]))
    costs.pop()
    edits = []
    for symbol, length in runs:
        text, state = _unroll_run(symbol, length, costs.pop(), state)
        edits.append(text)
    return "".join(edits), state


# Many conversations are alike; short ones are worked out once in a process.
_short_matrix = lru_cache(maxsize=1 << 14)(_runs_matrix)
_short_unroll = lru_cache(maxsize=1 << 14)(_unroll)


def runs_matrix(runs: Runs) -> Matrix:
    return (_short_matrix if len(runs) <= _CACHED_RUNS else _runs_matrix)(runs)


def unroll(runs: Runs, after: Vector, state: int) -> tuple[str, int]:
    return (_short_unroll if len(runs) <= _CACHED_RUNS else _unroll)(runs, after, state)


# --- Rows to pieces -----------------------------------------------------------------------------

_COUNTS = ["blank", "duplicate", "truncated", "illegal", "turns"]
_EDGES = ["first_turn", "last_turn", "least_turn"]
_PIECE = (
    "part int, symbols binary, lengths binary, matrix array<long>, "
    + ", ".join(f"{name} long" for name in [*_COUNTS, *_EDGES])
    + ", first_initial string, last_initial string"
)


def _symbols(damaged: DataFrame) -> DataFrame:
    """One narrow row per different (conv_id, turn, role, text): how often it occurs, and its faults.

    Equal rows are combined before the shuffle. Whether a role and a text were seen in an earlier turn
    follows from the least turn of each, again combined before the shuffle; no text is moved.
    """
    rows = damaged.filter("copies > 0").select(
        "conv_id",
        "turn",
        "role",
        F.unhex(F.md5("text")).alias("digest"),
        "copies",
        (~F.col("text").rlike(_NOT_BLANK)).alias("blank"),
        (~F.col("text").rlike(_ENDED)).alias("truncated"),
    )
    rows = rows.groupBy("conv_id", "turn", "role", "digest", "blank", "truncated").agg(F.sum("copies").alias("n"))
    # In a struct a NULL turn is the least one.
    first = rows.groupBy(
        F.col("conv_id").alias("f_conv"), F.col("role").alias("f_role"), F.col("digest").alias("f_digest")
    ).agg(F.min(F.struct("turn")).alias("first"))
    met = (
        F.col("conv_id").eqNullSafe(F.col("f_conv")) & (F.col("role") == F.col("f_role")) & (F.col("digest") == F.col("f_digest"))
    )
    return rows.join(first, met).select(
        "conv_id", "turn", "role", "digest", "n", "blank", "truncated",
        (~F.col("turn").eqNullSafe(F.col("first.turn"))).alias("seen"),
    )


class _Piece:
    """Rows of one conversation, in order, summed up while they pass."""

    def __init__(self, conv_id, part: int):
        self.conv_id, self.part = conv_id, part
        self.symbols: list[int] = []
        self.lengths: list[int] = []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_turn = self.last_turn = self.least_turn = None
        self.first_initial: str | None = None
        self.last_initial = ""

    def _run(self, symbol: int, length: int) -> None:
        if self.symbols and self.symbols[-1] == symbol:
            self.lengths[-1] += length
        elif length:
            self.symbols.append(symbol)
            self.lengths.append(length)

    def add(self, turn, role: str, n: int, blank: bool, truncated: bool, seen: bool) -> None:
        initial = role[:1]
        if self.first_initial is None:
            self.first_initial, self.first_turn = initial, turn
        else:
            self.illegal += self.last_initial + initial not in LEGAL_PAIRS
        self.illegal += n - 1
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.least_turn = turn if self.least_turn is None else self.least_turn
        self.last_turn, self.last_initial = turn, initial
        if blank:
            self.blank += n
            self._run(_GONE, n)
            return
        if not seen:
            self.truncated += truncated
            self._run(2 * "sua".find(initial) + truncated if initial in ("s", "u", "a") else 6 + truncated, 1)
        self.duplicate += n - (not seen)
        self._run(_GONE, n - (not seen))

    def row(self) -> tuple:
        matrix = runs_matrix(tuple(zip(self.symbols, self.lengths, strict=True)))
        return (
            self.conv_id,
            self.part,
            np.array(self.symbols, np.int8).tobytes(),
            np.array(self.lengths, np.int64).tobytes(),
            [cost for line in matrix for cost in line],
            *(getattr(self, name) for name in [*_COUNTS, *_EDGES]),
            self.first_initial,
            self.last_initial,
        )


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(values), field.type) for values, field in zip(columns, schema, strict=True)], schema=schema
    )


_BATCH_ROWS = 2000


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= _BATCH_ROWS:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[column.to_pylist() for column in batch.columns], strict=True)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    piece: _Piece | None = None
    for conv_id, part, turn, role, n, blank, truncated, seen in _listed(batches):
        if piece is None or conv_id != piece.conv_id:
            if piece is not None:
                yield piece.row()
            piece = _Piece(conv_id, part)
        piece.add(turn, role, n, blank, truncated, seen)
    if piece is not None:
        yield piece.row()


def _square(flat: list[int]) -> Matrix:
    return tuple(tuple(flat[i * 4 : i * 4 + 4]) for i in _STATES)


def _costs_to_go(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows (conv_id, part, costs after the piece, cost of all from its start, first, last); last pieces come first."""
    held = None
    for conv_id, part, matrix in _listed(batches):
        follows = held is not None and held[0] == conv_id
        if held is not None:
            yield *held[:4], not follows, held[4]
        after = held[5] if follows else final_costs()
        before = _applied(_square(matrix), after)
        held = (conv_id, part, list(after), before[_START], not follows, before)
    if held is not None:
        yield *held[:4], True, held[4]


def _unrolled(batches: Iterator[pa.RecordBatch], keep: int) -> Iterator[tuple]:
    """For every state a piece may be entered in: its edits and the state they end in."""
    for row in _listed(batches):
        carried, (symbols, lengths, after, first, last) = row[:keep], row[keep:]
        runs = tuple(zip(np.frombuffer(symbols, np.int8).tolist(), np.frombuffer(lengths, np.int64).tolist(), strict=True))
        audits, ends = [], []
        for state in [_START] if first else _STATES:
            edits, state = unroll(runs, tuple(after), state)
            while last and state not in _ENDS:
                edits, state = edits + "I", _NEXT[state]
            audits.append(edits)
            ends.append(state)
        yield *carried, audits, ends


# --- The last pass: pieces meet their texts ------------------------------------------------------

_HEADER, _TEXT, _DROPPED = range(3)
_REPAIR_COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


class _Conversation:
    """One conversation while its pieces and then its texts pass: nothing but the edits is kept."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.state, self.cost, self.place, self.role_state = _START, 0, 0, _START
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.least = self.last_turn = None
        self.last_initial: str | None = None
        self.parts: list[str] = []
        self.audit = ""
        self.digest = hashlib.sha256()
        self.turns_out = 0

    def header(self, h: dict) -> None:
        if self.last_initial is None:
            self.cost = h["cost"]
        else:
            self.illegal += self.last_initial + h["first_initial"] not in LEGAL_PAIRS
        self.blank += h["blank"]
        self.duplicate += h["duplicate"]
        self.truncated += h["truncated"]
        self.illegal += h["illegal"]
        self.turns += h["turns"] - (h["first_turn"] is not None and h["first_turn"] == self.last_turn)
        self.least = h["least_turn"] if self.least is None else self.least
        self.last_turn, self.last_initial = h["last_turn"], h["last_initial"]
        entry = self.state if len(h["audits"]) > 1 else 0
        self.parts.append(h["audits"][entry])
        self.state = h["ends"][entry]

    def _out(self, edit: str, role: str, text: str) -> tuple:
        self.digest.update(("\n" if self.turns_out else "").encode() + role.encode() + b":" + text.encode())
        self.turns_out += 1
        return self.conv_id, self.turns_out - 1, edit, role, text

    def _led(self) -> str:
        """The role that an insert or a rerole gives here."""
        self.role_state = _NEXT[self.role_state]
        return ASSISTANT if self.role_state == _ASSISTANT else USER

    def inserts(self) -> Iterator[tuple]:
        if self.parts:
            self.audit, self.parts = "".join(self.parts), []
        while self.place < len(self.audit) and self.audit[self.place] == "I":
            self.place += 1
            yield self._out("I", self._led(), "")

    def text(self, role: str, text: str, copies: int) -> Iterator[tuple]:
        for _ in range(copies):
            yield from self.inserts()
            edit = self.audit[self.place]
            self.place += 1
            if edit == "K":
                self.role_state = _KEEP["sua".find(role[:1])][self.role_state]
                yield self._out("K", role, text)
            elif edit == "R":
                yield self._out("R", self._led(), text)

    def row(self) -> tuple:
        gaps = 0 if self.least is None else self.last_turn - self.least + 1 - self.turns
        return (
            self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost,
            self.audit, self.digest.hexdigest(),
        )


def _finished(batches: Iterator[pa.RecordBatch], turns: bool) -> Iterator[tuple]:
    current: _Conversation | None = None
    for conv_id, kind, role, text, copies, header in _listed(batches):
        if current is None or conv_id != current.conv_id:
            if current is not None:
                rest = list(current.inserts())
                yield from rest if turns else [current.row()]
            current = _Conversation(conv_id)
        if kind == _HEADER:
            current.header(header)
        elif kind == _TEXT:
            for turn in current.text(role, text, copies):
                if turns:
                    yield turn
    if current is not None:
        rest = list(current.inserts())
        yield from rest if turns else [current.row()]


def _mapped(frame: DataFrame, rows, id_type: pa.DataType, schema: str, arrow: list[tuple[str, pa.DataType]]) -> DataFrame:
    out = pa.schema([("conv_id", id_type), *arrow])
    return frame.mapInArrow(lambda batches: _batches(rows(batches), out), schema)


def _assembled(damaged: DataFrame, turns: bool) -> DataFrame:
    id_type = damaged.schema["conv_id"].dataType.simpleString()
    arrow_id = _arrow_type(id_type)
    longs = [(name, pa.int64()) for name in [*_COUNTS, *_EDGES]]
    order = ["conv_id", "turn", "role", "digest"]
    ranged = _symbols(damaged).repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = stored(
        _mapped(
            ranged.select("conv_id", F.spark_partition_id().alias("part"), "turn", "role", "n", "blank", "truncated", "seen"),
            _pieces,
            arrow_id,
            f"conv_id {id_type}, {_PIECE}",
            [
                ("part", pa.int32()), ("symbols", pa.binary()), ("lengths", pa.binary()), ("matrix", pa.list_(pa.int64())),
                *longs, ("first_initial", pa.string()), ("last_initial", pa.string()),
            ],
        ),
        "repair-pieces",
    )
    backwards = pieces.select("conv_id", "part", "matrix").repartition("conv_id")
    costs = _mapped(
        backwards.sortWithinPartitions(F.col("conv_id"), F.col("part").desc()),
        _costs_to_go,
        arrow_id,
        f"conv_id {id_type}, part int, after array<long>, cost long, first boolean, last boolean",
        [("part", pa.int32()), ("after", pa.list_(pa.int64())), ("cost", pa.int64()), ("first", pa.bool_()), ("last", pa.bool_())],
    )
    costs = costs.withColumnsRenamed({"conv_id": "c_conv", "part": "c_part"})
    met = pieces.join(costs, F.col("conv_id").eqNullSafe(F.col("c_conv")) & (F.col("part") == F.col("c_part")))
    carried = ["part", *_COUNTS, *_EDGES, "first_initial", "last_initial", "cost"]
    texts = {"first_initial", "last_initial"}
    kinds = {name: "string" if name in texts else "int" if name == "part" else "long" for name in carried}
    arrows = {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}
    headers = _mapped(
        met.select("conv_id", *carried, "symbols", "lengths", "after", "first", "last"),
        lambda batches: _unrolled(batches, len(carried) + 1),
        arrow_id,
        f"conv_id {id_type}, " + ", ".join(f"{n} {k}" for n, k in kinds.items()) + ", audits array<string>, ends array<int>",
        [*[(n, arrows[k]) for n, k in kinds.items()], ("audits", pa.list_(pa.string())), ("ends", pa.list_(pa.int32()))],
    )
    header = F.struct(*[name for name in headers.columns if name not in ("conv_id", "part")])
    rows = headers.select("conv_id", F.lit(_HEADER).alias("kind"), "part", header.alias("header"))
    kept = F.col("copies") > 0
    turn_type = damaged.schema["turn"].dataType
    rows = rows.unionByName(
        damaged.select(
            "conv_id",
            F.when(kept, _TEXT).otherwise(_DROPPED).alias("kind"),
            F.when(kept, F.col("turn")).cast(turn_type).alias("turn"),
            F.when(kept, F.col("role")).alias("role"),
            F.when(kept, F.unhex(F.md5("text"))).alias("digest"),
            F.when(kept, F.col("text")).alias("text"),
            "copies",
        ),
        allowMissingColumns=True,
    )
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "part", "turn", "role", "digest")
    out = [("place", "long"), ("edit", "string"), ("role", "string"), ("text", "string")]
    if not turns:
        out = [*[(name, "long") for name in _REPAIR_COLUMNS], ("audit", "string"), ("repaired_sha256", "string")]
    return _mapped(
        rows.select("conv_id", "kind", "role", "text", "copies", "header"),
        lambda batches: _finished(batches, turns),
        arrow_id,
        f"conv_id {id_type}, " + ", ".join(f"{n} {k}" for n, k in out),
        [(n, arrows[k]) for n, k in out],
    )


def _arrow_type(name: str) -> pa.DataType:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8(), "string": pa.string()}
    if name not in kinds:
        raise ValueError(f"a conversation's id is an integer or a text, not {name}")
    return kinds[name]


def _taken(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    return picked(rows, **columns).withColumn("turn", F.col("turn").cast("long"))


def repairs(damaged: DataFrame, copies_column: str = "copies") -> DataFrame:
    """One row per conversation: faults, the least cost of the edits, their audit, and a hash of the outcome.

    Takes rows (conv_id, turn, role, text, copies); a row of no copies only tells that its conversation
    exists. Returns conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit (initials of Keep,
    Rerole, Delete, Insert), repaired_sha256 (of the repaired `role:text` lines).

    Rows come by turn, NULL first; rows of one turn by role, then by the digest of their text, so equal rows
    are neighbours. A NULL conv_id is a conversation of its own. A conversation without rows has zeros, an
    empty audit and the hash of the empty text; an empty table gives an empty result. Other columns are ignored.

    A conversation that holds most rows is spread by turn for all work but the last pass: one hash of
    its texts in order is one stream, which a task reads row by row without keeping it.
    """
    columns = {name: name for name in ("conv_id", "turn", "role", "text")} | {"copies": copies_column}
    return _assembled(_taken(damaged, columns), turns=False)


def repaired_turns(damaged: DataFrame, copies_column: str = "copies") -> DataFrame:
    """The rows after the repair: conv_id, place (from 0), edit (K, R or I), role, text; cases as in `repairs`."""
    columns = {name: name for name in ("conv_id", "turn", "role", "text")} | {"copies": copies_column}
    return _assembled(_taken(damaged, columns), turns=True)
