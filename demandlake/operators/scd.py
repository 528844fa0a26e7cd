"""History-keeping dimensions (slowly changing, type 2).

A dimension holds one open row per business key and the closed rows before it. A merge compares the
open rows with an incoming snapshot, where every key occurs once (`unique_keys` proves it), and is a
pure function: it reads two frames and returns the new one. NULL counts as a value, in keys and in attributes.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlake.functions.surrogate import surrogate_key

SCD_COLUMNS = ["SurrogateKey", "ValidFrom", "ValidTo", "IsCurrent"]

# The open end of a validity, and the start given to rows that never had one.
OPEN_END = "9999-12-31 23:59:59"
LEGACY_START = "1900-01-01 00:00:00"


@dataclass(frozen=True)
class DimSpec:
    """Business key and tracked attributes; ``compare=None`` tracks every other column.

    `buckets` is the number of parts a stored dimension lies in. It must stay the same while a table lives.
    """

    keys: tuple[str, ...]
    compare: tuple[str, ...] | None = None
    buckets: int = 32

    def tracked(self, columns: list[str]) -> list[str]:
        if self.compare is not None:
            return list(self.compare)
        return [name for name in columns if name not in (*self.keys, *SCD_COLUMNS)]


DIM_SPECS: dict[str, DimSpec] = {
    "DimMaterial": DimSpec(
        keys=("MaterialNumberCustomer", "MaterialNumberSupplier"),
        compare=("MaterialDescription", "MaterialGlobalAssetId", "UnitOfMeasure", "UnitOfMeasureIsOmitted"),
    ),
    "DimCustomer": DimSpec(keys=("CustomerBPNL",), compare=(), buckets=8),
    "DimSupplier": DimSpec(keys=("SupplierBPNL",), compare=(), buckets=8),
    "DimDemandCategory": DimSpec(keys=("DemandCategoryCode",), compare=(), buckets=1),
}


def _at(moment: str) -> Column:
    return F.lit(moment).cast("timestamp")


def stamp(rows: DataFrame, keys: tuple[str, ...], as_of: str) -> DataFrame:
    """Add the four history columns of a version that starts at `as_of`."""
    return rows.withColumns(
        {
            "SurrogateKey": surrogate_key([F.col(key) for key in keys], F.lit(as_of)),
            "ValidFrom": _at(as_of),
            "ValidTo": _at(OPEN_END),
            "IsCurrent": F.lit(True),
        }
    )


def backfill(table: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Give a table from before history was kept the history columns it lacks."""
    defaults = {
        "SurrogateKey": surrogate_key([F.col(key) for key in keys], F.lit(LEGACY_START)),
        "ValidFrom": _at(LEGACY_START),
        "ValidTo": _at(OPEN_END),
        "IsCurrent": F.lit(True),
    }
    missing = {name: value for name, value in defaults.items() if name not in table.columns}
    return table.withColumns(missing) if missing else table


def _differs(names: list[str]) -> Column:
    """True if any attribute changed, to or from NULL included."""
    changes = [~F.col(f"open.{name}").eqNullSafe(F.col(f"incoming.{name}")) for name in names]
    return reduce(lambda left, right: left | right, changes, F.lit(False))


def _columns_like(frame: DataFrame, other: DataFrame) -> DataFrame:
    """Add the columns only `other` has, as NULLs of its types."""
    absent = {
        field.name: F.lit(None).cast(field.dataType)
        for field in other.schema
        if field.name not in frame.columns
    }
    return frame.withColumns(absent) if absent else frame


def match_open(open_rows: DataFrame, incoming: DataFrame, spec: DimSpec) -> DataFrame:
    """Pair open rows and incoming rows by key and name the outcome.

    Columns: `open` and `incoming` (structs, NULL where the side has no such key) and `outcome`:
    absent, new, changed or unchanged. Both sides hold a key once, so no pairing multiplies rows
    and no key can be hot.
    """
    left = open_rows.select(F.struct(*open_rows.columns).alias("open"))
    right = incoming.select(F.struct(*incoming.columns).alias("incoming"))
    same_key = reduce(
        lambda a, b: a & b,
        [F.col(f"open.{key}").eqNullSafe(F.col(f"incoming.{key}")) for key in spec.keys],
    )
    outcome = (
        F.when(F.col("incoming").isNull(), "absent")
        .when(F.col("open").isNull(), "new")
        .when(_differs(spec.tracked(incoming.columns)), "changed")
        .otherwise("unchanged")
    )
    return left.join(right, same_key, "full_outer").withColumn("outcome", outcome)


def _outcomes(open_rows: DataFrame, incoming: DataFrame, spec: DimSpec, as_of: str) -> tuple[DataFrame, dict[str, Column]]:
    """Open rows paired with a snapshot, and the rows that may come of a pair: kept, closed, opened."""
    stamped = stamp(incoming, spec.keys, as_of)
    incoming_all = _columns_like(stamped, open_rows)
    open_all = _columns_like(open_rows, stamped)
    names = [name for name in incoming_all.columns if name not in SCD_COLUMNS] + SCD_COLUMNS
    ended = {"ValidTo": _at(as_of), "IsCurrent": F.lit(False)}
    tracked = DimSpec(spec.keys, tuple(spec.tracked(incoming.columns)))
    return match_open(open_all, incoming_all, tracked), {
        "kept": F.struct(*[F.col(f"open.{name}").alias(name) for name in names]),
        "closed": F.struct(*[ended.get(name, F.col(f"open.{name}")).alias(name) for name in names]),
        "opened": F.struct(*[F.col(f"incoming.{name}").alias(name) for name in names]),
    }


def merge_open(open_rows: DataFrame, incoming: DataFrame, spec: DimSpec, as_of: str) -> DataFrame:
    """Merge a snapshot into the open rows.

    Returns the new open rows and the rows closed by this merge. A changed key closes its row and
    opens a new one in the same step; a key missing from the snapshot stays open. Repeating a merge
    with the same snapshot changes nothing.
    """
    matched, row = _outcomes(open_rows, incoming, spec, as_of)
    rows = (
        F.when(F.col("outcome") == "new", F.array(row["opened"]))
        .when(F.col("outcome") == "changed", F.array(row["closed"], row["opened"]))
        .otherwise(F.array(row["kept"]))
    )
    # Every outcome yields a row, so the outer form loses nothing and spares a filter on the array.
    return matched.select(F.inline_outer(rows))


def changed_rows(open_rows: DataFrame, incoming: DataFrame, spec: DimSpec, as_of: str) -> DataFrame:
    """Only what a merge changes: `closed`, the row it ends (NULL for a new key), and `opened`, the row it starts."""
    matched, row = _outcomes(open_rows, incoming, spec, as_of)
    changed = matched.filter(F.col("outcome").isin("new", "changed"))
    return changed.select(
        F.when(F.col("outcome") == "changed", row["closed"]).alias("closed"), row["opened"].alias("opened")
    )


def surrogate_clashes(rows: DataFrame, spec: DimSpec) -> DataFrame:
    """The rows whose surrogate key another key or another version of their key carries too.

    Rows of one surrogate key are compared by the least and greatest of what they stand for, combined before
    the shuffle, so no key is hot; only clashing rows are looked up.
    """
    version = F.struct(*spec.keys, "ValidFrom")
    ends = rows.groupBy(F.col("SurrogateKey").alias("_clash")).agg(F.min(version).alias("least"), F.max(version).alias("greatest"))
    clashing = ends.filter(~F.col("least").eqNullSafe(F.col("greatest"))).select("_clash")
    return rows.join(clashing, F.col("SurrogateKey") == F.col("_clash"), "left_semi")


def unique_keys(incoming: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The snapshot, which fails when it is run if a key occurs more than once.

    Rows are counted per key with the first one kept, so equal keys meet in one aggregate and no key
    is hot, however often it occurs.
    """
    rows = F.struct(*incoming.columns)
    counted = incoming.groupBy(*[F.col(key).alias(f"_key_{key}") for key in keys]).agg(
        F.count(F.lit(1)).alias("_rows"), F.first(rows).alias("_row")
    )
    proof = F.assert_true(F.col("_rows") == 1, F.lit(f"a snapshot holds a key of {', '.join(keys)} more than once"))
    # The proof is NULL where it holds; as part of a filter it is not pruned away.
    return counted.filter(proof.isNull()).select("_row.*")


def scd2_merge(
    existing: DataFrame | None, incoming: DataFrame, spec: DimSpec, as_of: str
) -> DataFrame:
    """The whole dimension after merging a snapshot: closed rows of old, plus the merged open rows."""
    if existing is None:
        return stamp(incoming, spec.keys, as_of)
    history = backfill(existing, spec.keys)
    merged = merge_open(history.filter("IsCurrent"), incoming, spec, as_of)
    return merged.unionByName(history.filter("NOT IsCurrent"), allowMissingColumns=True)
