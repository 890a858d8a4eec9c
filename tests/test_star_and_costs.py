from __future__ import annotations

import os
from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from tessera.plans import costs, star
from tessera.session import materialise, scratch, scratch_root
from tessera.sources.writers import scratch_database


def reading(unit, calibrated, lat=1.0, when="2024-01-02 03:04:05", detector="CS-1"):
    return (when, unit, lat, 2.0, 0.1, calibrated, detector, "GM-1", "TH-1", 0.1, 0.2, 0.3, "2024-01-01 00:00:00", 5.0, 6.0, 7.0)


@pytest.fixture(scope="module")
def readings(spark):
    rows = [
        reading("G1", "2024-01-01 00:00:00", 3.0), reading("G1", "2024-01-01 00:00:00", 1.0), reading("G1", "2024-02-01 00:00:00"),
        reading("G2", "2024-01-01 00:00:00", when="2024-01-03 00:00:00", detector="CS-2"), reading("G2", "bad date"),
    ]
    return spark.createDataFrame(rows, star.READINGS)


def test_dimensions(readings):
    location = star.dim_location(readings).collect()
    assert sorted((r.gps_unit_number, str(r.calibration_timestamp), r.gps_lat) for r in location) == [
        ("G1", "2024-01-01 00:00:00", 1.0), ("G1", "2024-02-01 00:00:00", 1.0), ("G2", "2024-01-01 00:00:00", 1.0), ("G2", "None", 1.0),
    ]
    assert len(star.dim_detector(readings).collect()) == 4
    assert sorted(r.date_key for r in star.dim_date(readings).collect()) == ["2024-01-02", "2024-01-03"]


def test_every_fact_key_is_in_its_dimension(readings):
    fact, locations, detectors = star.fact_readings(readings), star.dim_location(readings), star.dim_detector(readings)
    assert fact.join(locations, "location_key", "left_anti").count() == 0
    for name in ("cesium", "gamma", "thorium"):
        assert fact.join(detectors, fact[f"{name}_detector_key"] == detectors.detector_key, "left_anti").count() == 0
    assert "Exchange" not in plan_of(fact)


def test_write_replaces(spark, readings):
    database = scratch_database(spark)
    star.write_star(readings, database)
    tables = star.write_star(readings.filter("gps_unit_number = 'G1'"), database)
    assert {n: t.count() for n, t in tables.items()} == {"dim_location": 2, "dim_detector": 3, "dim_date": 1, "fact_radiation_readings": 3}
    location = spark.sql(f"DESCRIBE EXTENDED {database}.dim_date").filter("col_name = 'Location'").first().data_type
    assert scratch_root(spark) in location


def test_intervals(spark):
    rows = [("a", datetime(2024, 1, d)) for d in (5, 1, 3)] + [("b", datetime(2024, 2, 1))]
    versions = spark.createDataFrame(rows, "unit string, since timestamp")
    result = star.scd2_intervals(versions, ["unit"], "since").orderBy("unit", "since").collect()
    assert [(r.unit, r.effective_from.day, r.effective_to and r.effective_to.day, r.is_current) for r in result] == [
        ("a", 1, 3, False), ("a", 3, 5, False), ("a", 5, None, True), ("b", 1, None, True),
    ]


def test_intervals_of_a_missing_unit(spark):
    rows = [(None, datetime(2024, 1, 1)), (None, datetime(2024, 1, 4))]
    result = star.scd2_intervals(spark.createDataFrame(rows, "unit string, since timestamp"), ["unit"], "since").orderBy("since").collect()
    assert [(r.effective_to and r.effective_to.day, r.is_current) for r in result] == [(4, False), (None, True)]


LINES = "full_date date, product_id long, batch_id long, facility_id long, cost_category string, actual_cents long, standard_cents long, units_produced int"


@pytest.fixture(scope="module")
def lines(spark):
    day = date(2024, 3, 4)
    return spark.createDataFrame(
        [
            (day, 1, 10, 5, "Material", 11500, 10000, 4), (day, 1, 10, 5, "Material", 100, 0, 1), (day, 1, 10, 5, "Labor", 3000, 2000, 5),
            (day, 2, 11, 5, "QC", 700, 0, 0),
        ],
        LINES,
    )


def test_fact(lines):
    fact = costs.cost_fact(lines)
    rows = fact.orderBy("batch_id", "cost_category_id").collect()
    assert [(r.batch_id, r.cost_category_id, r.actual_cost, r.cost_variance, r.variance_percent, r.units_produced) for r in rows] == [
        (10, 1, Decimal("116.00"), Decimal("16.00"), Decimal("16.00"), 5),
        (10, 2, Decimal("30.00"), Decimal("10.00"), Decimal("50.00"), 5),
        (11, 4, Decimal("7.00"), Decimal("7.00"), None, 0),
    ]
    assert rows[0].date_id == 20240304
    assert len({r.material_cost_id for r in rows}) == 3
    assert "rangepartitioning" not in plan_of(fact)


def test_required_values(spark, lines):
    batch = spark.createDataFrame([(1, 2, "F", 5, 4, 0, None)], "batch_id long, facility_id long, batch_status string, planned_quantity int, actual_quantity int, qa_hold_days int, rework_hours decimal(10,2)")
    database = scratch_database(spark)
    assert costs.write_dimension(batch, "dim_batch", database).count() == 1
    with pytest.raises(Exception, match="facility_id is required"):
        costs.write_dimension(batch.withColumn("facility_id", F.lit(None).cast("long")), "dim_batch", database)
    with pytest.raises(Exception, match="date_id is required"):
        costs.cost_fact(lines.withColumn("full_date", F.lit(None).cast("date"))).collect()


def test_release_leaves_nothing_behind(spark):
    root = scratch_root(spark).removeprefix("file:")
    with scratch(spark):
        database = scratch_database(spark)
        spark.range(3).write.saveAsTable(f"{database}.kept")
        numbers = materialise(spark.range(5).toDF("n"), "numbers")
        made = [name for name in os.listdir(root) if database in name or name in numbers.inputFiles()[0]]
        assert len(made) == 2
    assert not spark.catalog.databaseExists(database)
    assert not set(made) & set(os.listdir(root))


def test_units_count_once_per_batch(lines):
    by = {(r.dimension, r.member): r for r in costs.cost_metrics_by_dim(lines).collect()}
    batch = by["batch_id", "10"]
    assert (batch.actual_cost, batch.variance_percent, batch.cost_per_unit) == (Decimal("146.00"), Decimal("21.67"), Decimal("29.20"))
    assert by["batch_id", "11"].cost_per_unit is None
    assert by["cost_category_id", "1"].cost_per_unit is None
    assert len(by) == 2 + 2 + 1 + 1 + 3


def test_wide(spark, lines):
    batches = spark.createDataFrame([(10, "F", 50, 3, Decimal("1.50")), (11, "O", 60, 0, None)], "batch_id long, batch_status string, actual_quantity int, qa_hold_days int, rework_hours decimal(10,2)")
    facilities = spark.createDataFrame([(5, "f", Decimal("0.30"), True)], "facility_id long, facility_name string, overhead_rate decimal(10,2), is_sterile boolean")
    products = spark.createDataFrame([(1, "a", "b", "c"), (2, "d", "e", "f")], "product_id long, product_name string, dosage_form string, product_line string")
    wide = costs.cost_ml_wide(lines, batches, facilities, products)
    assert wide.schema.simpleString() == costs.WIDE.simpleString()
    first, second = wide.orderBy("batch_id").collect()
    assert (first.material_cost, first.labor_cost, first.overhead_cost, first.total_actual_cost) == (Decimal("116.00"), Decimal("30.00"), None, Decimal("146.00"))
    assert (first.cost_per_unit, first.exceeds_15_percent, first.year, first.month) == (Decimal("2.92"), True, 2024, 3)
    assert second.exceeds_15_percent is None
