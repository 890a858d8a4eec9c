"""Small scalar functions: flags, tolerant dates, number text, hash keys."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.when(condition, 1).otherwise(0)


def classify(value: Column, limits: list[tuple[float, str]], default: str) -> Column:
    """Label of the first limit the value is below; NULL falls to the default."""
    chain = F.when(value < F.lit(limits[0][0]), limits[0][1])
    for limit, label in limits[1:]:
        chain = chain.when(value < F.lit(limit), label)
    return chain.otherwise(default)


def order_map(value: Column, ranks: dict[str, int]) -> Column:
    """Position of a value in a given order; NULL for values outside it."""
    items = list(ranks.items())
    chain = F.when(value == items[0][0], items[0][1])
    for key, rank in items[1:]:
        chain = chain.when(value == key, rank)
    return chain


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def try_date(text: Column) -> Column:
    """Month/day/year with a four- or two-digit year, or an ISO date; NULL for anything else."""
    return F.coalesce(*[F.try_to_date(text, pattern) for pattern in ("M/d/yyyy", "M/d/yy", "yyyy-MM-dd")])


def repair_year(year: Column, current: int) -> Column:
    """A year that lies in the future was meant for the century before."""
    return F.when(year > current, year - 100).otherwise(year)


def birth_year(text: Column, as_of: date) -> Column:
    return repair_year(F.year(try_date(text)), as_of.year)


def clean_number(text: Column) -> Column:
    """Digits with optional thousands commas and surrounding white space as a long; NULL otherwise."""
    bare = F.regexp_replace(F.regexp_replace(text, r"^\s+|\s+$", ""), ",", "")
    return F.when(bare.rlike("^[0-9]+$"), bare.try_cast("bigint"))


def hash_key(*parts: Column) -> Column:
    """SHA-256 over the parts joined by ``|``. NULL parts are left out of the text."""
    return F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256)


def zip_complete(**arrays: Column) -> Column:
    """Parallel arrays as one array of structs, up to the end of the shortest one."""
    names = list(arrays)
    columns = [F.coalesce(arrays[n], F.array()) for n in names]
    shortest = F.least(*[F.size(c) for c in columns]) if len(columns) > 1 else F.size(columns[0])
    zipped = F.arrays_zip(*[F.slice(c, F.lit(1), shortest).alias(n) for n, c in zip(names, columns)])
    return zipped
