"""Layer tables on plain Parquet folders.

* A batch table (`batch_id=<label>/`) grows by one folder per micro-batch: bronze, silver, facts, the calendar.
  A label names the stream and its batch, so several streams, or a stream with a new checkpoint, add to a
  table without touching each other's batches, and a batch tried again replaces what it wrote before.
  Batches count from the moment their `_SUCCESS` file is there.
* A replaced table (`version=<n>/`) is written anew as a whole; the newest complete version counts.
* A history-keeping dimension lies in buckets of its key: `open/bucket=<b>/` holds the open rows,
  `closed/bucket=<b>/merged_by=<label>/` the rows that one batch closed. A merge reads the buckets its
  snapshot's keys lie in, and writes those in which a row changed, by dynamic partition overwrite; closed rows
  are never written again.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from demandlake.contracts import topic_of
from demandlake.operators.gold import row_counts
from demandlake.operators.layout import check_columns, spread_for_write
from demandlake.operators.scd import DimSpec, backfill, changed_rows, scd2_merge, unique_keys
from demandlake.sources.files import (
    COMPACT,
    any_match,
    child_folders,
    delete_folder,
    exists,
    matches_with_time,
    read_text,
    touch,
    write_text,
)

_BATCH = "batch_id"
_VERSION = "version"
_OPEN = "open"
_CLOSED = "closed"
_BUCKET = "bucket"
_MERGED_BY = "merged_by"
_MERGED = "_merged"
_SUCCESS = "_SUCCESS"
_SCHEMAS = "_schemas"
# The engine's function that fails on the metrics of a step which the plan that ran no longer had.
_NEVER_COUNTED = "PythonSQLUtils.toPyRow"
_NO_MARKER = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}


@dataclass(frozen=True)
class Origin:
    """The stream, by the id its checkpoint keeps, and the micro-batch that a write belongs to."""

    stream: str
    batch: int

    def __str__(self) -> str:
        return f"{self.stream}-{self.batch}"


def _write(frame: DataFrame, location: str, partitions: list[str], **options: str) -> None:
    frame.write.mode("overwrite").options(**COMPACT, **options).partitionBy(*partitions).parquet(location)


def observed(seen: Observation, name: str) -> int | None:
    """A count taken while a frame was written.

    None means that no row got through and adaptive execution dropped the counting step; a job that
    failed has raised its own error before.
    """
    try:
        return seen.get[name]
    except Py4JJavaError as problem:
        if _NEVER_COUNTED not in str(problem):
            raise
        return None


def _versions(spark: SparkSession, location: str) -> list[int]:
    """Numbers of all version folders, complete or not, oldest first."""
    names = child_folders(spark, location)
    return sorted(int(name.split("=", 1)[1]) for name in names if name.startswith(f"{_VERSION}="))


# --- Batch tables -------------------------------------------------------------------------------


def append_batch(
    frame: DataFrame,
    location: str,
    batch_id: int | Origin,
    partitions: list[str] | None = None,
    gathered: bool = False,
) -> DataFrame:
    """Write one micro-batch of a table and return it as stored; writing it again replaces it.

    Rows are brought together by partition first, unless they are `gathered` already because they
    come from a table partitioned in the same way.
    """
    target = f"{location}/{_BATCH}={batch_id}"
    check_columns(frame, partitions or [])
    _note_schema(frame, location)
    _write(frame if gathered else spread_for_write(frame, partitions or []), target, partitions or [])
    # The schema is given, as a batch without rows may have left no file to take it from.
    return frame.sparkSession.read.schema(frame.schema).parquet(target)


def _note_schema(frame: DataFrame, location: str) -> None:
    """Keep the schema of a batch beside the table, once for all batches that have the same."""
    text = frame.schema.json()
    noted = f"{location}/{_SCHEMAS}/{hashlib.md5(text.encode()).hexdigest()}.json"
    if not exists(frame.sparkSession, noted):
        write_text(frame.sparkSession, noted, text)


def _noted_schema(spark: SparkSession, location: str) -> StructType | None:
    """The union of the schemas a table's batches were written with, oldest first; None if none was kept."""
    noted = matches_with_time(spark, f"{location}/{_SCHEMAS}/*.json")
    fields = {}
    for path, _ in sorted(noted, key=lambda found: found[::-1]):
        for field in StructType.fromJson(json.loads(read_text(spark, path))):
            known = fields.setdefault(field.name, StructField(field.name, field.dataType))
            if known.dataType != field.dataType:
                raise ValueError(f"{location}: {field.name} is {known.dataType} in one batch and {field.dataType} in another")
    return StructType(list(fields.values())) if fields else None


def read_batch(spark: SparkSession, location: str, batch_id: int | Origin) -> DataFrame:
    """One micro-batch of a table."""
    return spark.read.parquet(f"{location}/{_BATCH}={batch_id}")


def read_latest_batch(spark: SparkSession, location: str) -> DataFrame:
    """Only the micro-batch completed last, by any stream, as if each one had replaced the table."""
    complete = _complete_batches(spark, location)
    if not complete:
        raise FileNotFoundError(f"no complete batch in {location}")
    return spark.read.parquet(complete[-1])


def _complete_batches(spark: SparkSession, location: str) -> list[str]:
    """The folders of all complete micro-batches, in the order of their completion."""
    found = []
    for mark, moment in matches_with_time(spark, f"{location}/{_BATCH}=*/{_SUCCESS}"):
        name = mark.rsplit("/", 2)[1]
        found.append((moment, int(name.rsplit("-", 1)[-1].rsplit("=", 1)[-1]), f"{location}/{name}"))
    return [folder for _, _, folder in sorted(found)]


# --- Replaced tables ----------------------------------------------------------------------------


def latest_version(spark: SparkSession, location: str) -> int | None:
    """The newest complete version."""
    for number in reversed(_versions(spark, location)):
        if exists(spark, f"{location}/{_VERSION}={number}/{_SUCCESS}"):
            return number
    return None


def replace_table(
    frame: DataFrame, location: str, version: int, partitions: list[str] | None = None
) -> None:
    """Write a whole table as a new version; if there is no row it is refused and the old one stays.

    The rows are counted while they are written, and the version is only completed if there are any.
    """
    target = f"{location}/{_VERSION}={version}"
    check_columns(frame, partitions or [])
    seen = Observation()
    counted = frame.observe(seen, F.count(F.lit(1)).alias("rows"))
    _write(spread_for_write(counted, partitions or []), target, partitions or [], **_NO_MARKER)
    if not observed(seen, "rows"):
        delete_folder(frame.sparkSession, target)
        raise ValueError(f"nothing to write to {location}")
    touch(frame.sparkSession, f"{target}/{_SUCCESS}")


def read_version(spark: SparkSession, location: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{location}/{_VERSION}={version}")


# --- Tables of distinct rows --------------------------------------------------------------------


def extend_distinct(frame: DataFrame, location: str, batch_id: int | Origin) -> None:
    """Add the rows of `frame` that no other batch of the table holds, as a batch; known rows write nothing.

    NULLs are equal here. The table only grows: what is there is looked up, not written again.
    """
    spark = frame.sparkSession
    fresh = frame.distinct()
    earlier = [folder for folder in _complete_batches(spark, location) if not folder.endswith(f"/{_BATCH}={batch_id}")]
    if earlier:
        present = _read_batches(spark, location, earlier, None).alias("present")
        same = [F.col(f"fresh.{name}").eqNullSafe(F.col(f"present.{name}")) for name in frame.columns]
        fresh = fresh.alias("fresh").join(present, reduce(lambda left, right: left & right, same), "left_anti")
        if fresh.isEmpty():
            return
    append_batch(fresh, location, batch_id)


# --- Dimensions ---------------------------------------------------------------------------------


def _bucketed(rows: DataFrame, spec: DimSpec) -> DataFrame:
    """The rows with the bucket their key lies in."""
    return rows.withColumn(_BUCKET, F.pmod(F.xxhash64(*spec.keys), F.lit(spec.buckets)).cast("int"))


def _overwrite(rows: DataFrame, location: str, partitions: list[str]) -> None:
    """Replace the partitions that the rows lie in, and no other."""
    writer = spread_for_write(rows, partitions).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.options(**COMPACT).partitionBy(*partitions).parquet(location)


def _write_closed(rows: DataFrame, location: str, label: object) -> None:
    _overwrite(rows.withColumn(_MERGED_BY, F.lit(str(label))), f"{location}/{_CLOSED}", [_BUCKET, _MERGED_BY])


def _legacy_rows(spark: SparkSession, location: str, spec: DimSpec) -> DataFrame | None:
    """A table that lies in plain files where the dimension is to be, as from before it kept history."""
    if any_match(spark, f"{location}/*.parquet"):
        # Only the files of the table itself; a bucket beside them is no part of it.
        return backfill(spark.read.parquet(f"{location}/*.parquet"), spec.keys)
    return None


def _load(rows: DataFrame, location: str, spec: DimSpec, label: object, with_closed: bool) -> None:
    """The first load: closed rows, if a table from before had any, and then the open ones."""
    _note_schema(rows, location)
    rows = _bucketed(rows, spec)
    if with_closed:
        _write_closed(rows.filter("NOT IsCurrent"), location, label)
    _overwrite(rows.filter("IsCurrent"), f"{location}/{_OPEN}", [_BUCKET])


def _rows_of(spark: SparkSession, folder: str, schema: StructType, partitions: str) -> DataFrame:
    columns = StructType([*schema.fields, *StructType.fromDDL(partitions).fields])
    return spark.read.schema(columns).parquet(folder)


def _has_merged(spark: SparkSession, location: str, origin: Origin) -> bool:
    """Whether the stream's batch is in the dimension already; the batches of a stream come in order."""
    mark = f"{location}/{_MERGED}/{origin.stream}"
    return exists(spark, mark) and int(read_text(spark, mark)) >= origin.batch


def merge_dimension(
    incoming: DataFrame, location: str, spec: DimSpec, as_of: str, label: int | Origin
) -> None:
    """Merge a snapshot into a stored dimension, once for each batch of a stream.

    See `merge_snapshot`. A stream's batch that was merged before does nothing, also if another stream has
    changed its rows since: the number of a stream's last batch is kept beside the table.
    """
    spark = incoming.sparkSession
    if isinstance(label, Origin) and _has_merged(spark, location, label):
        return
    merge_snapshot(incoming, location, spec, as_of, label)
    if isinstance(label, Origin):
        write_text(spark, f"{location}/{_MERGED}/{label.stream}", str(label.batch))


def merge_snapshot(
    incoming: DataFrame, location: str, spec: DimSpec, as_of: str, label: int | Origin
) -> None:
    """Merge a snapshot into a stored dimension.

    Open rows are read from the buckets in which the snapshot has keys, and the rows that changed are put beside
    the table first. From them, what is closed is written under the batch's label, and then the buckets in which
    a row changed are written with their new open rows. A merge tried again finds what its first try
    finished unchanged, and replaces the closed rows of what it did not; so a label must be its batch's own. A snapshot without a new or changed row
    writes nothing. A table found in plain files is taken up. Batches of one dimension come one after the other;
    a lakehouse format, where there is one, closes the gap in which a bucket is moved into place.
    """
    spark = incoming.sparkSession
    snapshot = unique_keys(incoming, spec.keys)
    if not exists(spark, f"{location}/{_OPEN}"):
        legacy = _legacy_rows(spark, location, spec)
        _load(scd2_merge(legacy, snapshot, spec, as_of), location, spec, label, legacy is not None)
        return
    snapshot = _bucketed(snapshot, spec)
    known = _noted_schema(spark, location)
    # At most as many numbers as there are buckets.
    touched = [row[0] for row in snapshot.select(_BUCKET).distinct().collect()]
    open_rows = _rows_of(spark, f"{location}/{_OPEN}", known, f"{_BUCKET} int").filter(F.col(_BUCKET).isin(touched))
    changes = changed_rows(open_rows.drop(_BUCKET), snapshot.drop(_BUCKET), spec, as_of)
    found = f"{location}/_changes"
    changes.write.mode("overwrite").options(**COMPACT).parquet(found)
    try:
        _write_changes(spark.read.schema(changes.schema).parquet(found), open_rows, location, spec, label)
    finally:
        delete_folder(spark, found)


def _write_changes(changes: DataFrame, open_rows: DataFrame, location: str, spec: DimSpec, label: int | Origin) -> None:
    """Write the rows that a merge closes, and then the buckets in which it opens one."""
    opened = _bucketed(changes.select("opened.*"), spec)
    keyed = changes.select("closed", *[F.col(f"opened.{key}").alias(key) for key in spec.keys])
    closing = F.count_if(F.col("closed").isNotNull()).alias("closing")
    per_bucket = _bucketed(keyed, spec).groupBy(_BUCKET).agg(closing).collect()  # a row a bucket at most
    if not per_bucket:
        return
    _note_schema(opened.drop(_BUCKET), location)
    if any(row.closing for row in per_bucket):
        closed = changes.filter(F.col("closed").isNotNull()).select("closed.*")
        _write_closed(_bucketed(closed, spec), location, label)
    same_key = [F.col(f"kept.{key}").eqNullSafe(F.col(f"opened.{key}")) for key in spec.keys]
    kept = open_rows.filter(F.col(_BUCKET).isin([row[_BUCKET] for row in per_bucket])).alias("kept")
    kept = kept.join(opened.alias("opened"), reduce(lambda left, right: left & right, same_key), "left_anti")
    _overwrite(kept.unionByName(opened, allowMissingColumns=True), f"{location}/{_OPEN}", [_BUCKET])


def adopt_dimension(legacy: DataFrame, location: str, spec: DimSpec) -> None:
    """Store a table from before history was kept as a dimension."""
    _load(backfill(legacy, spec.keys), location, spec, "legacy", True)


def read_dimension(spark: SparkSession, location: str) -> DataFrame:
    """All rows of a dimension, the open ones and the closed ones; no file is opened to learn the columns."""
    schema = _noted_schema(spark, location)
    if schema is None or not exists(spark, f"{location}/{_OPEN}"):
        raise FileNotFoundError(f"no dimension in {location}")
    rows = _rows_of(spark, f"{location}/{_OPEN}", schema, f"{_BUCKET} int").select(*schema.names)
    if exists(spark, f"{location}/{_CLOSED}"):
        closed = _rows_of(spark, f"{location}/{_CLOSED}", schema, f"{_BUCKET} int, {_MERGED_BY} string")
        rows = rows.unionByName(closed.select(*schema.names))
    return rows


# --- Any table ----------------------------------------------------------------------------------


def _read_batches(spark: SparkSession, location: str, folders: list[str], schema: StructType | None) -> DataFrame:
    reader = spark.read.option("basePath", location)
    schema = schema or _noted_schema(spark, location)
    if schema is not None:
        return reader.schema(schema).parquet(*folders).select(*schema.names)
    return reader.option("mergeSchema", True).parquet(*folders).drop(_BATCH)


def read_table(spark: SparkSession, location: str, schema: StructType | None = None) -> DataFrame:
    """The current content of a table of any layout, without its bookkeeping columns; complete batches only.

    The columns of a batch table are the union over its batches, kept beside the table when they were
    written, so no file is opened to find them; a `schema` given takes their place.
    """
    names = child_folders(spark, location)
    if _OPEN in names:
        return read_dimension(spark, location)
    if any(name.startswith(f"{_VERSION}=") for name in names) and (newest := latest_version(spark, location)) is not None:
        return read_version(spark, location, newest)
    complete = _complete_batches(spark, location)
    if not complete:
        raise FileNotFoundError(f"no table in {location}")
    return _read_batches(spark, location, complete, schema)


def layer_path(lake: str, layer: str, topic: str, table: str | None = None) -> str:
    """Where a layer keeps a topic, or one of its gold tables."""
    base = f"{lake}/{layer}/{topic_of(topic).folder}"
    return f"{base}/{table}" if table else base


def gold_names(spark: SparkSession, lake: str, topic: str) -> list[str]:
    """The gold tables a topic has, by what marks each layout: found in three requests, no table is opened."""
    base = layer_path(lake, "gold", topic)
    marks = {f"{_BATCH}=*/{_SUCCESS}": 3, f"{_VERSION}=*/{_SUCCESS}": 3, _OPEN: 2}
    found = [path.split("/")[-depth] for mark, depth in marks.items() for path, _ in matches_with_time(spark, f"{base}/*/{mark}")]
    if not found and not exists(spark, base):
        raise FileNotFoundError(f"{topic} has no gold tables in {lake}")
    return sorted(set(found))


def preview_gold(spark: SparkSession, lake: str, topic: str) -> dict[str, DataFrame]:
    """The gold tables of a topic by name."""
    return {name: read_table(spark, layer_path(lake, "gold", topic, name)) for name in gold_names(spark, lake, topic)}


def show_gold(spark: SparkSession, lake: str, topic: str, limit: int = 10) -> dict[str, DataFrame]:
    """Print the row counts of a topic's gold tables, from one query, and the first rows of each."""
    found = preview_gold(spark, lake, topic)
    if found:
        row_counts(found).orderBy("table_name").show(len(found), truncate=False)
    for table in found.values():
        table.limit(limit).show(limit, truncate=False)
    return found
