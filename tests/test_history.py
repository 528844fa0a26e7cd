from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from demandlake.operators import scd
from demandlake.sources import tables

T1, T2, T3 = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"
SPEC = scd.DimSpec(keys=("k",))
SCHEMA = "k string, a string, b int"


def snapshot(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def merge(spark, existing, rows, as_of, spec=SPEC):
    return scd.scd2_merge(existing, snapshot(spark, *rows), spec, as_of)


def versions(frame):
    """key -> its (a, b, start month, end, current) versions, oldest first."""
    found = {}
    for row in frame.orderBy("ValidFrom").collect():
        end = None if row.ValidTo.year == 9999 else row.ValidTo.month
        found.setdefault(row.k, []).append((row.a, row.b, row.ValidFrom.month, end, row.IsCurrent))
    return found


def check_invariants(frame):
    per_key = frame.groupBy("k").agg(
        F.count_if("IsCurrent").alias("open"),
        F.count(F.lit(1)).alias("all"),
        F.countDistinct("ValidFrom").alias("starts"),
    )
    assert per_key.filter("open <> 1 OR starts <> all").count() == 0
    assert frame.filter("ValidFrom >= ValidTo").count() == 0
    assert frame.select("SurrogateKey").distinct().count() == frame.count()


FIRST = [("same", "x", 1), ("edit", "x", 1), ("gone", "x", 1), ("tonull", "x", 1), ("fromnull", None, 1), (None, "x", 1)]
SECOND = [("same", "x", 1), ("edit", "y", 1), ("tonull", None, 1), ("fromnull", "z", 1), (None, "w", 1), ("new", "x", 1)]


def test_merge_closes_opens_and_keeps(spark):
    merged = merge(spark, merge(spark, None, FIRST, T1), SECOND, T2)
    assert versions(merged) == {
        "same": [("x", 1, 1, None, True)],
        "gone": [("x", 1, 1, None, True)],
        "edit": [("x", 1, 1, 2, False), ("y", 1, 2, None, True)],
        "tonull": [("x", 1, 1, 2, False), (None, 1, 2, None, True)],
        "fromnull": [(None, 1, 1, 2, False), ("z", 1, 2, None, True)],
        None: [("x", 1, 1, 2, False), ("w", 1, 2, None, True)],
        "new": [("x", 1, 2, None, True)],
    }
    check_invariants(merged)


def expected_history(snapshots):
    """The same merge row by row: (k, a, b, start month, end month, current)."""
    opened, closed = {}, []
    for month, rows in enumerate(snapshots, start=1):
        for k, *attributes in rows:
            if k in opened and opened[k][0] != attributes:
                old, start = opened.pop(k)
                closed.append((k, *old, start, month, False))
            opened.setdefault(k, (attributes, month))
    return closed + [(k, *attributes, start, None, True) for k, (attributes, start) in opened.items()]


def test_random_snapshots_against_a_merge_by_hand(spark):
    draw = random.Random(7)
    keys = [None, *(f"k{i}" for i in range(40))]
    snapshots = [
        [(k, draw.choice([None, "x", "y"]), draw.choice([None, 1, 2])) for k in keys if draw.random() < 0.7] for _ in range(4)
    ]
    frame = None
    for month, rows in enumerate(snapshots, start=1):
        frame = merge(spark, frame, rows, f"2024-0{month}-01 00:00:00")
    found = [(k, *version) for k, all_versions in versions(frame).items() for version in all_versions]
    assert sorted(map(str, found)) == sorted(map(str, expected_history(snapshots)))
    check_invariants(frame)


def test_repeating_a_merge_changes_nothing(spark):
    once = merge(spark, merge(spark, None, FIRST, T1), SECOND, T2)
    for moment in (T2, T3):
        again = merge(spark, once, SECOND, moment)
        assert sorted(map(str, again.collect())) == sorted(map(str, once.collect()))


def test_several_versions_do_not_overlap(spark):
    frame = merge(spark, None, [("k", "v0", 0)], T1)
    for month, value in ((2, "v1"), (3, "v2"), (4, "v1")):
        frame = merge(spark, frame, [("k", value, 0)], f"2024-0{month}-01 00:00:00")
    assert versions(frame)["k"] == [
        ("v0", 0, 1, 2, False),
        ("v1", 0, 2, 3, False),
        ("v2", 0, 3, 4, False),
        ("v1", 0, 4, None, True),
    ]
    check_invariants(frame)


def test_tracked_columns(spark):
    loaded = merge(spark, None, [("k", "x", 1)], T1)
    changed = [("k", "y", 1)]
    assert merge(spark, loaded, changed, T2, scd.DimSpec(("k",), ("b",))).count() == 1
    assert merge(spark, loaded, changed, T2, scd.DimSpec(("k",), ())).count() == 1
    assert merge(spark, loaded, changed, T2, scd.DimSpec(("k",), ("a",))).count() == 2
    assert merge(spark, loaded, changed, T2).count() == 2


def test_a_new_column_counts_as_a_change(spark):
    loaded = merge(spark, None, [("k", "x", 1)], T1)
    wider = snapshot(spark, ("k", "x", 1)).withColumn("c", F.lit("new"))
    rows = scd.scd2_merge(loaded, wider, SPEC, T2).orderBy("ValidFrom").collect()
    assert [(row.c, row.IsCurrent) for row in rows] == [(None, False), ("new", True)]


def test_legacy_tables_get_history_columns(spark):
    legacy = snapshot(spark, ("k", "x", 1)).withColumn("IsCurrent", F.lit(True))
    row = scd.backfill(legacy, ("k",)).first()
    assert (row.ValidFrom.year, row.ValidTo.year, row.IsCurrent) == (1900, 9999, True)
    assert row.SurrogateKey is not None
    assert merge(spark, legacy, [("k", "y", 1)], T1).count() == 2


def test_one_join_and_no_python(spark):
    plan = merge(spark, merge(spark, None, FIRST, T1), SECOND, T2)._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" in plan and "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.fixture
def stored(spark, folder):
    location = f"{folder}/dim"
    for version, (rows, moment) in enumerate(((FIRST, T1), (SECOND, T2))):
        tables.merge_dimension(snapshot(spark, *rows), location, SPEC, moment, version)
    return location


def test_stored_dimension_equals_the_pure_merge(spark, stored):
    expected = merge(spark, merge(spark, None, FIRST, T1), SECOND, T2)
    assert versions(tables.read_dimension(spark, stored)) == versions(expected)
    check_invariants(tables.read_table(spark, stored))


def test_a_repeated_batch_changes_nothing(spark, stored):
    before = versions(tables.read_dimension(spark, stored))
    tables.merge_dimension(snapshot(spark, *SECOND), stored, SPEC, T3, 1)
    assert versions(tables.read_dimension(spark, stored)) == before


def files_of(location):
    """Bucket -> names of its files; a bucket written again has others."""
    return {
        folder: sorted(name for name in os.listdir(f"{location}/{folder}") if name.startswith("part-"))
        for folder in os.listdir(location)
        if folder.startswith("bucket=")
    }


def test_a_merge_writes_the_buckets_in_which_a_row_changed(spark, folder):
    rows = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("k"), F.lit("x").alias("a"), F.lit(1).alias("b"))
    tables.merge_dimension(rows, folder, SPEC, T1, 0)
    before = files_of(f"{folder}/open")
    assert len(before) == SPEC.buckets
    changed = rows.withColumn("a", F.when(F.col("k") == "k77", "y").otherwise(F.col("a")))
    tables.merge_dimension(changed, folder, SPEC, T2, 1)
    after = files_of(f"{folder}/open")
    assert [bucket for bucket in before if before[bucket] != after[bucket]] == list(files_of(f"{folder}/closed"))
    assert len(files_of(f"{folder}/closed")) == 1
    found = tables.read_dimension(spark, folder)
    assert found.count() == 20_001
    assert versions(found.filter("k = 'k77'")) == {"k77": [("x", 1, 1, 2, False), ("y", 1, 2, None, True)]}
    # One new key reads and writes its own bucket.
    tables.merge_dimension(snapshot(spark, ("new", "x", 1)), folder, SPEC, T3, 2)
    assert sum(files_of(f"{folder}/open")[bucket] != after[bucket] for bucket in after) == 1
    assert tables.read_dimension(spark, folder).filter("IsCurrent").count() == 20_001
    check_invariants(tables.read_dimension(spark, folder))


def test_a_merge_that_failed_between_its_writes_is_finished_by_the_next_try(spark, stored, monkeypatch):
    third = [("edit", "v", 2), ("same", "s", 3), ("late", "x", 1)]

    def fail(rows, location, partitions):
        if location.endswith("/open"):
            raise RuntimeError("lost")
        write(rows, location, partitions)

    write = tables._overwrite
    with monkeypatch.context() as patched:
        patched.setattr(tables, "_overwrite", fail)
        with pytest.raises(RuntimeError, match="lost"):
            tables.merge_dimension(snapshot(spark, *third), stored, SPEC, T3, 2)
    tables.merge_dimension(snapshot(spark, *third), stored, SPEC, "2024-04-01 00:00:00", 2)
    expected = merge(spark, merge(spark, merge(spark, None, FIRST, T1), SECOND, T2), third, "2024-04-01 00:00:00")
    assert versions(tables.read_dimension(spark, stored)) == versions(expected)
    check_invariants(tables.read_dimension(spark, stored))


def test_surrogate_clashes(spark):
    frame = merge(spark, merge(spark, None, FIRST, T1), SECOND, T2)
    assert scd.surrogate_clashes(frame, SPEC).count() == 0
    assert scd.surrogate_clashes(frame.unionByName(frame), SPEC).count() == 0  # the same row twice is no clash
    met = frame.withColumn("SurrogateKey", F.when(F.col("k").isin("same", "new") | F.col("k").isNull(), 7).otherwise(F.col("SurrogateKey")))
    assert {(row.SurrogateKey, row.k) for row in scd.surrogate_clashes(met, SPEC).collect()} == {(7, "same"), (7, "new"), (7, None)}


def test_a_legacy_dimension_can_be_adopted(spark, folder):
    location = f"{folder}/legacy"
    tables.adopt_dimension(snapshot(spark, ("k", "x", 1)), location, SPEC)
    tables.merge_dimension(snapshot(spark, ("k", "y", 1)), location, SPEC, T1, 1)
    assert [row.a for row in tables.read_dimension(spark, location).orderBy("ValidFrom").collect()] == ["x", "y"]
