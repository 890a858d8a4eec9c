"""Projections, filters, sorting, set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project(df: DataFrame, *columns: str | Column) -> DataFrame:
    return df.select(*columns)


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def with_columns(df: DataFrame, **columns: Column) -> DataFrame:
    return df.withColumns(columns)


def tag(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def union_all(*dfs: DataFrame) -> DataFrame:
    """Rows of all inputs, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def order(column: str | Column, direction: str = "asc", nulls: str = "last") -> Column:
    """Sort key with the place of NULLs always stated."""
    col = F.col(column) if isinstance(column, str) else column
    return getattr(col, f"{direction}_nulls_{nulls}")()


def sort(df: DataFrame, *keys: tuple | str | Column, split_ties: bool = False) -> DataFrame:
    """Global order. Rows that tie on all keys end up in one task; ``split_ties`` spreads them over
    several, in the order they come in."""
    columns = [order(*k) if isinstance(k, tuple) else order(k) for k in keys]
    return df.orderBy(*columns, *([F.monotonically_increasing_id()] if split_ties else []))


def top_k(df: DataFrame, k: int, *keys: tuple | str | Column) -> DataFrame:
    """First ``k`` rows of the order; every task passes on at most ``k``."""
    return sort(df, *keys).limit(k)


def distinct(df: DataFrame) -> DataFrame:
    return df.distinct()


def dedup(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """One row per key: the first by ``order_by``, then by the other columns.

    An aggregate of whole rows, so a frequent key is reduced in every task before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = [*order_by, *[c for c in rest if c not in order_by]]
    first = F.min(F.struct(*ranked)).alias("__row")
    return df.groupBy(*keys).agg(first).select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns])
