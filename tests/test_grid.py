from __future__ import annotations

import random

import pandas as pd
import pytest
from conftest import plan_of

from tessera.functions.grid import Grid, grid_assign, register_grid_function
from tessera.plans import grid_survey

X0, Y0, UNIT = 2180160.0001, 6660000.0, 32.81


def label(x, y):
    """The labels by plain arithmetic."""
    col, row = int((x - X0) // UNIT), int((y - Y0) // UNIT)
    sub = UNIT / 10
    across, up = int((x - X0 - col * UNIT) // sub), int((y - Y0 - row * UNIT) // sub)
    return chr(65 + row // 18) + chr(65 + col // 21), (17 - row % 18) * 21 + col % 21 + 1, up * 10 + across + 1


def test_known_points(spark):
    points = [(X0, Y0), (X0 + UNIT * 21.01, Y0), (X0 + UNIT * 22.01 + 4, Y0 + UNIT * 19.01 + 4)]
    df = spark.createDataFrame(points, "easting double, northing double")
    assert [tuple(r.c) for r in df.select(grid_assign("easting", "northing").alias("c")).collect()] == [
        ("AA", 358, 1), ("AB", 358, 1), ("BB", 338, 12),
    ]


def test_cell_edges(spark):
    rng = random.Random(5)
    points = []
    for _ in range(4000):
        col, row = rng.randrange(400), rng.randrange(300)
        points.append((X0 + UNIT * col + rng.choice([0.0, rng.random() * 33, UNIT / 10 * rng.randrange(10)]), Y0 + UNIT * row + rng.choice([0.0, UNIT / 10 * rng.randrange(10)])))
    df = spark.createDataFrame(points, "easting double, northing double")
    got = [tuple(r.c) for r in df.select(grid_assign("easting", "northing").alias("c")).collect()]
    assert got == [label(*p) for p in points]
    name = register_grid_function(spark, "edge_cells")
    by_sql = spark.sql(f"SELECT {name}(easting, northing) AS c FROM {{df}}", df=df).collect()
    assert [tuple(r.c) for r in by_sql] == got


def test_other_grid(spark):
    df = spark.createDataFrame([(25.0, 14.0)], "easting double, northing double")
    cell = df.select(grid_assign("easting", "northing", Grid(0.0, 0.0, 10.0, 2, 1, 2)).alias("c")).first().c
    assert tuple(cell) == ("BB", 1, 2)


def test_native_plan(spark):
    df = spark.range(10).selectExpr("CAST(id AS DOUBLE) AS easting", "CAST(id AS DOUBLE) AS northing", "1D AS reading")
    text = plan_of(grid_survey.subcell_averages(df))
    assert "Python" not in text and "Arrow" not in text


@pytest.fixture
def tiles(spark):
    rng = random.Random(1)
    rows = [(X0 + rng.random() * UNIT * 63, Y0 + rng.random() * UNIT * 54, rng.random() * 10) for _ in range(3000)]
    return spark.createDataFrame(rows, "easting double, northing double, reading double")


def test_neighbours_are_symmetric(tiles):
    pairs = {(r.tile, r.neighbor_tile): r.tile_change for r in grid_survey.neighbor_change(tiles).collect()}
    assert len(pairs) == 40  # a three by three grid
    assert all(pairs[(b, a)] == change for (a, b), change in pairs.items())
    text = plan_of(grid_survey.neighbor_change(tiles))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_status_limits(spark):
    values = [4.999, 5.0, 7.399, 7.4, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(grid_survey.status(df.v)).collect()] == ["OK", "Warning", "Warning", "Alarm", "Alarm"]


def test_single_reading_is_stable(spark):
    row = grid_survey.stability_scores(spark.createDataFrame([(X0, Y0, 3.0)], "easting double, northing double, reading double")).first()
    assert (row.num_readings, row.stddev_reading, row.stability_score) == (1, None, 1.0)


def test_findings_may_overlap(spark):
    rows = [(X0 + i * 3.281 + 1, Y0 + 1, v) for i in range(10) for v in (0.0, 40.0 + i)]
    found = grid_survey.findings(spark.createDataFrame(rows, "easting double, northing double, reading double"), k=4).collect()
    assert [r.finding_category for r in found] == ["Top Alarm Subcell"] * 4 + ["Low Stability - Needs Re-Survey"] * 4
    assert [r.subcell for r in found[:4]] == [10, 9, 8, 7]


def test_recommend_takes_a_batch_function(spark):
    df = spark.createDataFrame([("OK", "p1"), ("Alarm", "p2")], "subcell_status string, prompt string")
    answered = grid_survey.recommend(df, lambda batch: pd.Series([p.upper() for p in batch["prompt"]])).collect()
    assert [r.recommendation for r in answered] == ["P1", "P2"]
