from __future__ import annotations

import random

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from tessera.operators import aggregates as A
from tessera.operators import joins as J


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(2)
    people = [(i if i else None, f"p{i}") for i in range(60)]
    orders = [(n, 7 if n % 3 == 0 else rng.choice([None, *range(40)]), float(n)) for n in range(600)]
    return (
        spark.createDataFrame(people, "person int, name string"),
        spark.createDataFrame(orders, "order_id int, person int, amount double"),
    )


def same(got, want):
    assert sorted(got.columns) == sorted(want.columns)
    key = lambda r: tuple((v is not None, v) for v in r)
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=key) == sorted(map(tuple, want.collect()), key=key)


def test_keep_left(sides, join_mode):
    people, orders = sides
    same(J.keep_left(people, orders, "person"), people.join(orders, "person", "left"))
    same(J.keep_right(orders, people, "person"), orders.join(people, "person", "right"))


@pytest.mark.parametrize("hot", [False, True])
def test_keep_left_with_hot_keys_and_shared_names(sides, hot):
    people, orders = sides
    orders = orders.withColumn("name", F.lit("order"))
    joined = J.keep_left(people, orders, "person", hot)
    assert joined.columns == ["person", "name", "order_id", "amount", "name"]
    want = people.join(orders.drop("name"), "person", "left")
    assert sorted((r[0] or -1, r[1], r[2] or -1) for r in joined.collect()) == sorted((r[0] or -1, r[1], r[2] or -1) for r in want.collect())


def test_outer_joins_scan_each_side_once(spark):
    from tessera.queries import QUERIES

    for name in ("qa2", "qa3", "qb2", "qb3", "qc2", "qd2", "qd3"):
        assert plan_of(QUERIES[name](spark, "/root/testdata/sf0.001")).count("FileScan parquet") <= 2


def test_exists_flag_keeps_duplicates(sides, join_mode):
    people, orders = sides
    want = people.join(orders.withColumnRenamed("person", "who"), F.col("person") == F.col("who"), "left")
    same(J.exists_flag(people, orders, "person", "ordered"), want.select("person", "name", F.col("order_id").isNotNull().alias("ordered")))


@pytest.mark.parametrize("hot_left", [False, True])
def test_anti_and_semi(sides, join_mode, hot_left):
    people, orders = sides
    same(J.anti(people, orders, "person", hot_left), people.join(orders, "person", "left_anti"))
    same(J.semi(people, orders, "person", hot_left), people.join(orders, "person", "left_semi"))
    same(J.anti(orders, people, "person", hot_left), orders.join(people, "person", "left_anti"))


def test_anti_plan(sides):
    people, orders = sides
    assert "LeftAnti" in plan_of(J.anti(people, orders, "person"))


def test_counts_are_not_multiplied(spark):
    base = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    left = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (2, "c")], "k int, x string")
    right = spark.createDataFrame([(1, "d"), (1, "e"), (1, "f")], "k int, y string")
    counted = J.counts_per_key(base, "k", xs=(left, "x"), ys=(right, "y"))
    assert sorted(map(tuple, counted.collect())) == [(1, 2, 3), (2, 1, 0), (3, 0, 0)]


def test_attach(sides, join_mode):
    people, orders = sides
    totals = A.group_sum_count(orders, "person", "order_id", "amount", "n", "total")
    same(J.attach(orders, totals, "person"), orders.join(totals, "person"))


def test_count_distinct_by_keeps_null_group(spark):
    df = spark.createDataFrame([(1, "a", "x"), (1, "a", "y"), (None, "b", "z")], "k int, u string, v string")
    counted = A.count_distinct_by(df, "k", {"us": "u", "vs": "v"})
    assert {r.k: (r.us, r.vs) for r in counted.collect()} == {1: (1, 2), None: (1, 1)}


def test_metrics_by_dimension(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 2, 3.0), (None, 2, 5.0)], "x string, y int, v double")
    result = A.metrics_by(df, ["x", "y"], {"total": F.sum("v")})
    assert sorted(map(tuple, result.collect()), key=str) == sorted(
        [("x", "a", 5.0), ("x", None, 5.0), ("y", "1", 2.0), ("y", "2", 8.0)], key=str
    )


def test_filter_and_columns_reach_the_scan(spark):
    from tessera.plans.join_suite import qb5
    from tessera.queries import table

    text = qb5(lambda t: table(spark, "/root/testdata/sf0.001", t))._jdf.queryExecution().toString()
    assert "s_acctbal" not in text.split("== Physical Plan ==")[1]
    assert "PushedFilters: [IsNotNull(user_id)" in text
