"""Grouped aggregation. All of these combine partial results before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def group_sum_count(df: DataFrame, key: str, identifier: str, value: str, count_name: str, sum_name: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(identifier).alias(count_name), F.sum(value).alias(sum_name))


def group_avg(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(value).alias(name))


def layered_avg(df: DataFrame, levels: list[list[str]], value: str, name: str) -> DataFrame:
    """Average of averages, one level after the other; each group counts the same."""
    for keys in levels:
        df = group_avg(df, keys, value, name)
        value = name
    return df


def count_distinct_by(df: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """Number of distinct values per group for several columns.

    One aggregate per column: a single one would copy every row once per column before it counts.
    """
    result = None
    for name, column in columns.items():
        part = df.groupBy(key).agg(F.count_distinct(column).alias(name))
        result = part if result is None else result.join(part, result[key].eqNullSafe(part[key])).drop(part[key])
    return result


def qualifying(items: Column, condition, value) -> Column:
    """Values of the array items that satisfy a condition; an unknown condition does not."""
    return F.transform(F.filter(items, lambda i: F.coalesce(condition(i), F.lit(False))), value)


def metrics_by(df: DataFrame, dimensions: list[str], measures: dict[str, Column]) -> DataFrame:
    """The measures by each dimension separately, in one pass: dimension, its value as text, measures."""
    grouped = df.groupingSets([[d] for d in dimensions], *dimensions).agg(
        F.grouping_id().alias("__gid"), *[m.alias(n) for n, m in measures.items()]
    )
    # grouping_id has a bit per dimension, first one highest, cleared for the one grouped by.
    full = 2 ** len(dimensions) - 1
    name = value = None
    for i, d in enumerate(dimensions):
        here = F.col("__gid") == full - 2 ** (len(dimensions) - 1 - i)
        name = F.when(here, d) if name is None else name.when(here, d)
        value = F.when(here, F.col(d).cast("string")) if value is None else value.when(here, F.col(d).cast("string"))
    return grouped.select(name.alias("dimension"), value.alias("member"), *measures)


def pivot_sum(df: DataFrame, keys: list[str], column: str, names: dict, amount: str, **totals: Column) -> DataFrame:
    """Long to wide for a fixed list of categories: ``names`` maps a category to its output column.

    ``totals`` are aggregates over all categories. Conditional sums keep everything in one pass.
    """
    sums = [F.sum(F.when(F.col(column) == value, F.col(amount))).alias(name) for value, name in names.items()]
    return df.groupBy(*keys).agg(*sums, *[c.alias(n) for n, c in totals.items()])
