"""Joins that stay balanced when one key holds a large share of the rows.

Joins are left to the optimizer: it broadcasts a side it knows to be small, and adaptive execution splits
an oversized partition. It cannot split the optional side of an outer join, nor the tested side of an anti
join; the caller says where one of those is hot.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import sized_join


def _keys(df: DataFrame, on: list[str]) -> DataFrame:
    """Distinct join keys. Partial aggregation reduces a hot key to one row per task, and the join
    reuses the partitioning of the aggregate."""
    return df.select(*on).dropna().distinct()


def _list(on: str | list[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def inner(left: DataFrame, right: DataFrame, on: str | list[str]) -> DataFrame:
    """Equi-join on shared column names, each kept once."""
    return left.join(right, _list(on), "inner")


def chain(first: DataFrame, *steps: tuple[DataFrame, str | list[str]]) -> DataFrame:
    return reduce(lambda acc, step: inner(acc, *step), steps, first)


def _tested(left: DataFrame, right: DataFrame, on: list[str], how: str, hot_left: bool) -> DataFrame:
    keys = _keys(right, on)
    return sized_join(left, keys, on, how) if hot_left else left.join(keys, on, how)


def anti(left: DataFrame, right: DataFrame, on: str | list[str], hot_left: bool = False) -> DataFrame:
    """Rows of ``left`` without a partner.

    Say ``hot_left`` where the left side is not unique by the key and a key may have very many rows:
    the tested keys are then written first, and a join of two plain shuffles can be split.
    """
    return _tested(left, right, _list(on), "left_anti", hot_left)


def semi(left: DataFrame, right: DataFrame, on: str | list[str], hot_left: bool = False) -> DataFrame:
    """Rows of ``left`` with a partner, each once; ``hot_left`` as for ``anti``."""
    return _tested(left, right, _list(on), "left_semi", hot_left)


def has_all(left: DataFrame, rights: list[DataFrame], on: str | list[str]) -> DataFrame:
    return reduce(lambda acc, right: semi(acc, right, on), rights, left)


def keep_left(left: DataFrame, right: DataFrame, on: str | list[str], hot_right: bool = False) -> DataFrame:
    """Left outer join on shared column names, each kept once, then the other columns of either side.

    Say ``hot_right`` where a key may have very many rows on the right: a partition of the optional side cannot
    be split, so the matches then come from an inner join, which can be, and the rest from an anti join.
    """
    on = _list(on)
    joined = left.join(right, on, "inner" if hot_right else "left")
    matched = joined.select(*[left[c] for c in left.columns], *[right[c] for c in right.columns if c not in on])
    if not hot_right:
        return matched
    padding = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields if f.name not in on]
    return matched.union(anti(left, right, on).select(*left.columns, *padding))


def keep_right(left: DataFrame, right: DataFrame, on: str | list[str], hot_left: bool = False) -> DataFrame:
    return keep_left(right, left, on, hot_left)


def exists_flag(left: DataFrame, right: DataFrame, on: str | list[str], name: str) -> DataFrame:
    """Left rows with a flag for a partner. A row with several partners appears once for each."""
    on = _list(on)
    found = left.join(right.select(*on, F.lit(True).alias(name)), on, "left")
    return found.select(*[left[c] for c in left.columns], F.coalesce(found[name], F.lit(False)).alias(name))


def attach(detail: DataFrame, aggregate: DataFrame, on: str | list[str]) -> DataFrame:
    """Detail rows with the values of their group; the aggregate has one row per key. It is written
    first, so that it can be broadcast if it is small and a hot group can be split if it is not."""
    return sized_join(detail, aggregate, _list(on))


def counts_per_key(base: DataFrame, on: str, **tables: tuple[DataFrame, str]) -> DataFrame:
    """For every key of ``base`` the number of distinct ids in each table, 0 without any.

    Each table is aggregated by itself, so the tables are never multiplied with each other.
    """
    result = base.select(on).distinct()
    for name, (table, identifier) in tables.items():
        counts = table.groupBy(on).agg(F.count_distinct(identifier).alias(name))
        result = result.join(counts, on, "left").withColumn(name, F.coalesce(name, F.lit(0).cast("bigint")))
    return result
