"""Row-level quality flags, rule tests and constraint checks."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalar import birth_year, digits, flag
from tessera.operators.joins import anti
from tessera.operators.relational import sort

AGE_TOLERANCE = 2
ZIP_LENGTH = 5
PHONE_DIGITS = 10
REVIEW_DATE = date(2026, 1, 1)


def reversed_name(name: Column) -> Column:
    return flag(F.contains(name, F.lit(",")))


def age_mismatch(age: Column, birth_date: Column, as_of: date = REVIEW_DATE) -> Column:
    return flag(F.abs(age - (F.lit(as_of.year) - birth_year(birth_date, as_of))) > AGE_TOLERANCE)


def invalid_zip(code: Column) -> Column:
    return flag(F.length(code.cast("string")) < ZIP_LENGTH)


def invalid_phone(phone: Column) -> Column:
    return flag(F.length(digits(phone)) != PHONE_DIGITS)


def missing_category(category: Column) -> Column:
    return flag(category.isNull() | (F.trim(category) == ""))


RULES: dict[str, Callable[[Column], Column]] = {
    "dq_reversed_name": reversed_name,
    "dq_invalid_phone_format": invalid_phone,
    "dq_invalid_zip": invalid_zip,
    "dq_missing_category": missing_category,
}


def dq_profile(donations: DataFrame, as_of: date = REVIEW_DATE, ordered: bool = True) -> DataFrame:
    """All columns, a flag per issue, and the number of issues; worst rows first.

    The total judges the ZIP code without surrounding blanks, the flag as it stands, so for a
    padded code the total is not the sum of the flags.
    """
    flags = {
        "dq_reversed_name": reversed_name(F.col("name")),
        "dq_age_dob_mismatch": age_mismatch(F.col("age"), F.col("date_of_birth"), as_of),
        "dq_invalid_zip": invalid_zip(F.col("zip")),
        "dq_invalid_phone_format": invalid_phone(F.col("phone")),
        "dq_missing_category": missing_category(F.col("category")),
    }
    trimmed = invalid_zip(F.trim(F.col("zip").cast("string")))
    parts = [trimmed if name == "dq_invalid_zip" else F.col(name) for name in flags]
    profiled = donations.withColumns(flags).withColumn("dq_total_issues", reduce(lambda a, b: a + b, parts))
    return sort(profiled, ("dq_total_issues", "desc"), "donation_id") if ordered else profiled


def rule_cases(cases: DataFrame, rules: dict[str, Callable[[Column], Column]] = RULES) -> DataFrame:
    """Each case (test_name, input_value, expected) with the actual value of its rule and a match flag."""
    value = F.col("input_value")
    actual = reduce(lambda chain, r: chain.when(F.col("test_name") == r, rules[r](value)), rules, F)
    judged = cases.withColumn("actual", actual).withColumn("match", F.col("actual") == F.col("expected"))
    columns = judged.select("test_name", "input_value", "actual", "expected", "match")
    return sort(columns, "test_name", "match", ("input_value", "asc", "first"), split_ties=True)


@dataclass(frozen=True)
class Unique:
    name: str
    table: DataFrame
    columns: list[str]

    def count(self) -> Column:
        return F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("bigint")

    def rows(self) -> DataFrame:
        return self.table.groupBy(*self.columns).agg(F.count("*").alias("__n"))


@dataclass(frozen=True)
class NotNull:
    name: str
    table: DataFrame
    column: str

    def count(self) -> Column:
        return F.count_if(F.col(self.column).isNull())

    def rows(self) -> DataFrame:
        return self.table.select(self.column)


@dataclass(frozen=True)
class References:
    name: str
    table: DataFrame
    column: str
    parent: DataFrame
    parent_column: str

    def count(self) -> Column:
        return F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint")

    def rows(self) -> DataFrame:
        # Rows per key first, so a hot key is one row in the join.
        keys = self.table.filter(F.col(self.column).isNotNull()).groupBy(self.column).agg(F.count("*").alias("__n"))
        return anti(keys, self.parent.select(F.col(self.parent_column).alias(self.column)), self.column)


def constraint_violations(*constraints: Unique | NotNull | References) -> DataFrame:
    """Surplus rows per unique key, NULLs, and rows without a parent: one result row per constraint."""
    counted = [c.rows().agg(c.count().alias("violations")).select(F.lit(c.name).alias("constraint"), "violations") for c in constraints]
    return reduce(lambda a, b: a.unionByName(b), counted)
