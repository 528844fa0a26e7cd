from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from demandlake.contracts import CAPACITY_TOPIC, DEMAND_TOPIC
from demandlake.functions.calendar import iso_date
from demandlake.operators import bronze, gold, layout
from demandlake.operators.messages import parse_messages
from fixtures import capacity, demand, messages, series


def flat_demand(spark, *documents):
    return bronze.bronze_demand(parse_messages(messages(spark, DEMAND_TOPIC, *documents), DEMAND_TOPIC))


def flat_capacity(spark, *documents):
    return bronze.bronze_capacity(parse_messages(messages(spark, CAPACITY_TOPIC, *documents), CAPACITY_TOPIC))


def test_demand_is_flattened_per_entry(spark):
    rows = flat_demand(spark, demand()).orderBy("pointInTime").collect()
    assert [(r.demandCategoryCode, r.customerLocation, r.demand, r.pointInTime) for r in rows] == [
        ("A1", "BPNS-1", 742.0, dt.date(2025, 7, 7)),
        ("A1", "BPNS-1", 1200.5, dt.date(2025, 7, 14)),
        ("B1", "BPNS-2", 3.0, dt.date(2025, 7, 21)),
    ]
    assert len(rows[0]) == 16


@pytest.mark.parametrize("empty", [[], None, "ABSENT", [series("A1")]])
def test_messages_without_demands_have_no_rows(spark, empty):
    assert flat_demand(spark, demand(demandSeries=empty)).count() == 0


def test_missing_optional_fields_are_null(spark):
    absent = ("materialNumberSupplier", "materialGlobalAssetId", "unitOfMeasure")
    row = flat_demand(spark, demand(**{name: "ABSENT" for name in absent})).first()
    assert [row[name] for name in absent] == [None, None, None]


def test_missing_category_and_bad_date_keep_the_row(spark):
    rows = flat_demand(spark, demand(demandSeries=[series(None, ("2025-13-01", 5))])).collect()
    assert [(r.demandCategoryCode, r.pointInTime, r.demand) for r in rows] == [(None, None, 5.0)]


def test_capacity_takes_the_first_threshold_and_series(spark):
    rows = flat_capacity(spark, capacity()).orderBy("pointInTime").collect()
    assert [r.actualCapacity for r in rows] == [271.0, 272.0, 273.0]
    assert len(rows[0]) == 28
    first = rows[0]
    assert (first.sequenceNumber, first.absoluteNegativeDeviation) == (1, 17.0)
    assert (first.materialNumberCustomer, first.demandCategoryCode) == ("MC-1", "A1")
    assert first.linkedCapacityGroups == ["cg-2", "cg-3"]


def test_capacity_without_optional_parts(spark):
    bare = capacity(
        linkedCapacityGroups="ABSENT", supplierLocations=None, demandVolatilityParameters="ABSENT", linkedDemandSeries=[]
    )
    row = flat_capacity(spark, bare).first()
    assert (row.linkedCapacityGroups, row.supplierLocations) == ([], [])
    assert (row.measurementInterval, row.sequenceNumber, row.loadFactor, row.demandCategoryCode) == (None,) * 4
    assert flat_capacity(spark, capacity(capacities=[])).count() == 0


def test_material_dimension_keeps_the_latest_change(spark):
    rows = flat_demand(
        spark,
        demand(materialDescriptionCustomer="old", changedAt="2025-07-01T10:00:00Z"),
        # 14:00 in UTC, and so later than the next one, though its text sorts first
        demand(materialDescriptionCustomer="new", changedAt="2025-07-01T09:00:00-05:00"),
        demand(materialDescriptionCustomer="between", changedAt="2025-07-01T13:00:00.000001Z"),
        demand(materialNumberSupplier="ABSENT"),
    )
    found = {(r.MaterialNumberCustomer, r.MaterialNumberSupplier): r.MaterialDescription for r in gold.dim_material(rows).collect()}
    assert found == {("MC-1", "MS-1"): "new", ("MC-1", None): "bolt"}


def test_value_dimensions_are_distinct_and_not_empty(spark):
    rows = flat_demand(spark, demand(), demand(customer=""), demand(customer="ABSENT"))
    assert [r.CustomerBPNL for r in gold.dim_customer(rows).collect()] == ["BPNL00000001AAAA"]
    assert sorted(r.DemandCategoryCode for r in gold.dim_demand_category(rows).collect()) == ["A1", "B1"]


def test_calendar_rows(spark):
    days = spark.createDataFrame([("2025-07-07",), ("2025-07-07",), ("2023-01-01",), ("never",), (None,)], "d string")
    rows = {r.DateKey: r for r in gold.dim_time(days, "d").collect()}
    assert set(rows) == {20250707, 20230101}
    monday, sunday = rows[20250707], rows[20230101]
    assert tuple(monday) == (20250707, "2025-07-07", 7, 7, "July", 3, 2025, 1, 28, False)
    assert (sunday.DayOfWeek, sunday.WeekOfYear, sunday.IsWeekend) == (7, 52, True)


def test_calendar_without_dates_is_empty_with_its_columns(spark):
    empty = gold.dim_time(spark.createDataFrame([("x",)], "d string"), "d")
    assert empty.count() == 0 and len(empty.columns) == 10


@pytest.mark.parametrize(
    "text,day",
    [
        (" 2025-07-07 ", dt.date(2025, 7, 7)),
        ("2025-07-07T23:59:00-11:00", dt.date(2025, 7, 7)),
        ("20250707", dt.date(2025, 7, 7)),
        ("2025", None),
        ("2025-7-7", None),
        ("2025-02-30", None),
        ("2025-07-07Tlater", None),
        ("", None),
    ],
)
def test_iso_dates(spark, text, day):
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(iso_date(F.col("t"))).first()[0] == day


def test_capacity_facts_use_the_flat_names(spark):
    row = gold.fact_capacity_group(flat_capacity(spark, capacity())).orderBy("PointInTime").first()
    assert (row.CapacityGroupID, row.MaxCapacity, row.MeasurementIntervalWeeks) == ("cg-1", 355.5, 4)
    assert row.ParentCapacityGroupID is None


def test_gold_tables_and_counts(spark):
    tables = gold.gold_tables(flat_demand(spark, demand()), DEMAND_TOPIC)
    counts = {r.table_name: r.row_count for r in gold.row_counts(tables).collect()}
    assert counts == {
        "DimMaterial": 1,
        "DimCustomer": 1,
        "DimSupplier": 1,
        "DimDemandCategory": 2,
        "FactMaterialDemand": 3,
        "DimTime": 3,
    }


def test_partition_columns():
    assert layout.default_partitions(["x", "materialDemandId", "pointInTime"]) == ["materialDemandId", "pointInTime"]
    assert layout.default_partitions(["capacityGroupId", "pointInTime"], ["pointInTime"]) == ["pointInTime"]
    with pytest.raises(ValueError, match="pointInTime"):
        layout.default_partitions(["commentId"])
    assert layout.detect_partitions(["CustomerBPNL", "x", "PointInTime"]) == ["PointInTime", "CustomerBPNL"]
    assert layout.detect_partitions(["CustomerBPNL"]) == []
