from __future__ import annotations

import random
import re

import pytest
from conftest import plan_of
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import ranking
from tessera.operators.ranking import Criterion, percent_rank, row_number, spaced_second, top_per_group
from tessera.operators.relational import dedup, order, sort
from tessera.session import scratch_path


@pytest.fixture(scope="module")
def rows(spark):
    """A third of the rows share one value, another part has none."""
    rng = random.Random(3)
    data = []
    for i in range(3000):
        small = 7 if i % 3 == 0 else rng.choice([None, *range(20)])
        wide = None if i % 50 == 0 else round(rng.uniform(-1000, 1000), 2) * (0.0 if i % 97 == 0 else 1.0)
        data.append((i, small, wide, f"t{rng.randrange(40)}", "hot" if i % 3 else f"g{i % 30}"))
    return spark.createDataFrame(data, "id int, small int, wide double, text string, grp string").repartition(5).cache()


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("nulls_last", [False, True])
def test_percent_rank(rows, join_mode, descending, nulls_last):
    columns = ["small", "wide", "text"]
    got = percent_rank(rows, [Criterion(f"p_{c}", c, descending, nulls_last) for c in columns])
    where, nulls = "desc" if descending else "asc", "last" if nulls_last else "first"
    want = rows.select("*", *[F.percent_rank().over(Window.orderBy(order(c, where, nulls))).alias(f"p_{c}") for c in columns])
    pick = ["id", *[f"p_{c}" for c in columns]]
    assert sorted(map(tuple, got.select(pick).collect())) == sorted(map(tuple, want.select(pick).collect()))


def test_percent_rank_needs_no_single_task(rows):
    ranked = percent_rank(rows, [Criterion("p", "wide"), Criterion("q", F.abs(F.col("small") - 5))])
    # The windows run over the value counts of one range each.
    assert "SinglePartition" not in plan_of(ranked)


def test_wide_rows_are_shuffled_once(rows, monkeypatch, spark):
    """Six criteria with many values: the wide rows take part in one exchange."""

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wide = rows.withColumn("load", F.repeat(F.lit("x"), 50))
        columns = ["small", "wide", "text", "id", "grp", F.col("id") % 7]
        ranked = percent_rank(wide, [Criterion(f"p{i}", c) for i, c in enumerate(columns)])
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        plan = ranked._jdf.queryExecution().explainString(mode)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    inputs = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]", plan)
    assert len(inputs) >= 3 and sum("load#" in columns for columns in inputs) == 1


def test_percent_rank_of_one_row_and_of_none(spark):
    one = spark.createDataFrame([(1, 5.0)], "id int, v double")
    assert percent_rank(one, [Criterion("p", "v")]).first().p == 0.0
    assert percent_rank(one.limit(0), [Criterion("p", "v")]).collect() == []
    nothing_known = spark.createDataFrame([(1, None), (2, None)], "id int, v double")
    assert [r.p for r in percent_rank(nothing_known, [Criterion("p", "v")]).collect()] == [0.0, 0.0]


def test_row_number(rows, join_mode):
    for groups in (["grp"], [], ["grp", "small"]):
        keys = [order("wide", "desc"), order("id")]
        got = row_number(rows, groups, keys, "n")
        want = rows.withColumn("n", F.row_number().over(Window.partitionBy(*groups).orderBy(*keys)))
        assert sorted((r.id, r.n) for r in got.collect()) == sorted((r.id, r.n) for r in want.collect())


def test_row_number_splits_a_hot_group(spark):
    """All rows in one group, and still several ranges."""
    df = spark.range(200_000, numPartitions=4).selectExpr("id", "'one' AS grp", "pmod(hash(id), 100000) AS v")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = ranking._ranges(df, [F.col("grp").asc(), F.col("v").asc(), F.col("id").asc()], "split")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r["count"] for r in placed.groupBy("__part").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 100_000


def test_spaced_second(spark, join_mode):
    rng = random.Random(8)
    rows = [(i, f"c{i % 4}", f"I-{rng.randrange(3)}", rng.randrange(0, 200, 10), rng.random()) for i in range(200)]
    rows += [(900, "alone", "I-1", 0, 0.5), (901, "close", "I-1", 0, 0.9), (902, "close", "I-1", 10, 0.8)]
    df = spark.createDataFrame(rows, "id int, corridor string, line string, mile int, score double")
    ranked = row_number(df, ["corridor"], [order("score", "desc"), order("id")], "rank")
    got = {(r.corridor, r.id, r["rank"]) for r in spaced_second(ranked, "corridor", "rank", "line", "mile", 50).collect()}
    want = set()
    for corridor in {r[1] for r in rows}:
        group = sorted((r for r in rows if r[1] == corridor), key=lambda r: (-r[4], r[0]))
        first = group[0]
        want.add((corridor, first[0], 1))
        second = next(((i, r) for i, r in enumerate(group[1:], 2) if r[2] != first[2] or abs(r[3] - first[3]) >= 50), None)
        if second:
            want.add((corridor, second[1][0], second[0]))
    assert got == want


def test_top_per_group_limits_before_the_shuffle(rows):
    text = plan_of(top_per_group(rows, ["grp"], [order("wide", "desc"), order("id")], 2))
    assert text.count("WindowGroupLimit") == 2


def test_dedup_is_deterministic(spark):
    data = [("k", 2, "b"), ("k", 1, "z"), ("k", 1, "c"), ("m", 5, None)]
    for shuffled in (data, data[::-1]):
        df = spark.createDataFrame(shuffled, "key string, v int, w string")
        assert sorted(map(tuple, dedup(df, ["key"], ["v"]).collect())) == [("k", 1, "c"), ("m", 5, None)]


def test_sort_places_nulls(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "v int")
    assert [r.v for r in sort(df, "v").collect()] == [1, 3, None]
    assert [r.v for r in sort(df, ("v", "desc")).collect()] == [3, 1, None]
    assert [r.v for r in sort(df, ("v", "asc", "first"), split_ties=True).collect()] == [None, 1, 3]


def test_wide_values_are_not_broadcast(spark):
    """The bytes decide, not the number of rows."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
    try:
        narrow = spark.range(2_000).selectExpr("id", "CAST(id AS STRING) AS v")
        wide = spark.range(2_000).selectExpr("id", "concat(sha2(concat('a', id), 512), sha2(concat('b', id), 512)) AS v")
        texts = [plan_of(percent_rank(df, [Criterion("p", "v")])) for df in (narrow, wide)]
        assert ["SortMergeJoin" in t for t in texts] == [False, True]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_spaced_second_reads_the_rows_once(spark):
    rows = spark.range(1_000).selectExpr("id", "'c' AS corridor", "concat('I-', id % 3) AS line", "id % 20 * 10 AS mile", "id + 1 AS rank")
    rows.write.mode("overwrite").parquet(path := f"{scratch_path(spark, 'ranked')}")
    reads = []
    plain = ranking.materialise
    ranking.materialise = lambda df, name: (reads.append(plan_of(df).count("FileScan")), plain(df, name))[1]
    try:
        chosen = spaced_second(spark.read.parquet(path), "corridor", "rank", "line", "mile", 50)
    finally:
        ranking.materialise = plain
    assert reads == [1] and path not in plan_of(chosen)
    assert sorted(r.id for r in chosen.collect()) == [0, 1]
