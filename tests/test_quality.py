from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tessera.functions import scalar as S
from tessera.plans import quality

# Fixed cases: input and expected flag.
NAMES = [
    ("Smith, John", 1), ("Doe, Jane", 1), ("John Smith", 0), ("Jane Doe", 0), ("O'Connor, Mary", 1),
    ("Mary O'Connor", 0), ("Van Der Berg, Jan", 1), ("Jan Van Der Berg", 0), ("", 0), (None, 0),
]
PHONES = [
    ("5551234567", 0), ("555-123-4567", 0), ("(555) 123-4567", 0), ("555.123.4567", 0), ("555 123 4567", 0), ("123456789", 1),
    ("12345678901", 1), ("+1-555-123-4567", 1), ("555-1234", 1), ("", 1), ("555-123-4567 ext 123", 1),
]
ZIPS = [("12345", 0), ("12345-6789", 0), ("00501", 0), ("99999", 0), ("1234", 1), ("123", 1), ("12", 1), ("1", 1), ("0", 1)]
# Not among the fixed cases.
MORE = [("dq_invalid_phone_format", None, 0), ("dq_missing_category", None, 1), ("dq_missing_category", "  ", 1), ("dq_missing_category", "A", 0)]


def test_rule_cases(spark):
    rows = [("dq_reversed_name", *c) for c in NAMES] + [("dq_invalid_phone_format", *c) for c in PHONES] + [("dq_invalid_zip", *c) for c in ZIPS]
    assert len(rows) == 30
    cases = spark.createDataFrame(rows + MORE, "test_name string, input_value string, expected int")
    result = quality.rule_cases(cases).collect()
    assert len(result) == 34
    assert all(r.match for r in result), [r for r in result if not r.match]
    assert [r.test_name for r in result] == sorted(r.test_name for r in result)


DONATION = "donation_id long, name string, age int, date_of_birth string, zip string, phone string, category string"


def profile(spark, **changes):
    row = {"donation_id": 1, "name": "A B", "age": 30, "date_of_birth": "1/2/1996", "zip": "12345", "phone": "5551234567", "category": "x"}
    df = spark.createDataFrame([tuple({**row, **changes}.values())], DONATION)
    return quality.dq_profile(df, date(2026, 6, 1)).first()


def test_padded_zip_counts_in_the_total_only(spark):
    row = profile(spark, zip=" 123 ")
    assert (row.dq_invalid_zip, row.dq_total_issues) == (0, 1)


@pytest.mark.parametrize(
    ("born", "age", "flag"),
    [
        ("1/2/1996", 30, 0), ("1/2/1996", 32, 0), ("1/2/1996", 33, 1), ("1/2/96", 30, 0), ("1/2/25", 1, 0), ("1/2/27", 99, 0),
        ("1/2/27", 1, 1), ("not a date", 5, 0), (None, 5, 0), ("1996-01-02", 30, 0), ("13/45/1990", 3, 0),
    ],
)
def test_age_against_birth_date(spark, born, age, flag):
    assert profile(spark, date_of_birth=born, age=age).dq_age_dob_mismatch == flag


def test_profile_order(spark):
    rows = [(i, "a, b" if i % 2 else "a b", 30, "1/2/1996", "12345", "1", "x") for i in range(6)]
    result = quality.dq_profile(spark.createDataFrame(rows, DONATION), date(2026, 1, 1)).collect()
    assert [r.donation_id for r in result] == [1, 3, 5, 0, 2, 4]


def test_profile_runs_on_a_stream(spark, tmp_path):
    """The flags are stateless, so they also apply to a stream."""
    rows = [(i, "a, b", 30, "1/2/1996", "12345", "1", "x") for i in range(4)]
    spark.createDataFrame(rows, DONATION).write.parquet(str(tmp_path / "in"))
    stream = quality.dq_profile(spark.readStream.schema(DONATION).parquet(str(tmp_path / "in")), ordered=False)
    target = str(tmp_path / "out")
    stream.writeStream.option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start(target).awaitTermination()
    assert {r.dq_total_issues for r in spark.read.parquet(target).collect()} == {2}


def test_constraints(spark):
    child = spark.createDataFrame([(1, 10), (1, 11), (2, None), (3, 99)], "id int, parent int")
    parent = spark.createDataFrame([(10,), (11,), (12,)], "key int")
    result = quality.constraint_violations(
        quality.Unique("key", child, ["id"]), quality.NotNull("parent", child, "parent"), quality.References("fk", child, "parent", parent, "key")
    )
    assert {r.constraint: r.violations for r in result.collect()} == {"key": 1, "parent": 1, "fk": 1}


@pytest.mark.parametrize(("text", "number"), [(" 1,234 ", 1234), ("12", 12), ("n/a", None), ("1.5", None), ("", None), ("\t7\n", 7)])
def test_clean_number(spark, text, number):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(S.clean_number(F.col("t"))).first()[0] == number


def test_hash_key_leaves_out_null(spark):
    df = spark.createDataFrame([("a", None), ("a", "")], "x string, y string")
    keys = [r[0] for r in df.select(S.hash_key(F.col("x"), F.col("y"))).collect()]
    assert len(keys[0]) == 64
    only = spark.createDataFrame([("a",)], "x string").select(S.hash_key(F.col("x"))).first()[0]
    assert keys[0] == only != keys[1]
