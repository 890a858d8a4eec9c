"""Mixes sources to target weights by weighted sampling without replacement.

Every source gets a share of the words of the mix. Whole epochs of a source come first; what is left of its target
is filled with documents in the order of Efraimidis-Spirakis keys: an exponential variable, drawn from a hash of the
document id, divided by the document's quality weight, so better documents tend to come earlier. Sizes are
summed up in key order until the target is reached; the document that crosses it is taken if that comes nearer.

A source may hold any share of the rows. Its keys are cut into ``BUCKETS`` ranges (the keys of a weight of 1 fill
them evenly), running sums are taken inside a range and added to the sums of the ranges before, so no source is
ever sorted in one place. Rows with the same key, id and size are counted before the shuffle and travel as one row, so
rows without an id, or with one id in common, are no hot range; they are listed again at the end.

Defined cases: sources are ordered by code point, NULL last, and NULL is a source. A NULL size counts as 0, a NULL
or non-positive quality weight as the smallest positive one, ``LEAST_WEIGHT``. Without any words all targets are 0.
Rows with equal or NULL ids draw the same key and are ordered by size. Columns of the input are read by name only;
others do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import fresh, same, written

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
BUCKETS = 1_024
LEAST_WEIGHT = 1e-6
# Equal rows are listed again in pieces of so many, so no row holds a long array.
PIECE = 100_000
SEED = "mix-1"


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """``sizes(source, source_size)`` with ``target``: shares by weight of all words, none above ``most`` epochs.

    A source whose share would be more than its limit gets the limit, and the others share the rest by weight.
    In the order of limit per weight the limited sources come first, so one running sum finds them all.
    There is one row per source.
    """
    listed = ", ".join(str(w) for w in weights)
    return sizes.selectExpr(
        "*", f"element_at(array({listed}), CAST(pmod(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1, {len(weights)}) + 1 AS INT)) AS weight"
    ).selectExpr(
        "*",
        "sum(source_size) OVER () AS total",
        "sum(weight) OVER () AS weights",
        f"{most} * source_size AS most",
        f"row_number() OVER (ORDER BY CAST({most} * source_size AS DOUBLE) / weight, source ASC NULLS LAST) AS place",
    ).selectExpr(
        "*",
        "total - coalesce(sum(most) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest",
        "weights - coalesce(sum(weight) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest_weights",
    ).selectExpr(
        "*", "CAST(most AS DECIMAL(38,0)) * rest_weights <= CAST(rest AS DECIMAL(38,0)) * weight AS limited"
    ).selectExpr(
        "source",
        "source_size",
        "IF(limited, CAST(most AS DOUBLE), CAST(weight * (total - coalesce(sum(IF(limited, most, 0L)) OVER (), 0L)) AS DOUBLE)"
        " / sum(IF(limited, 0, weight)) OVER ()) AS target",
    )


def draw(identifier: Column, quality: Column, seed: str = SEED) -> Column:
    """Efraimidis-Spirakis key: smaller keys come first."""
    digits = F.conv(F.substring(F.sha2(F.concat(F.lit(seed + ":"), F.coalesce(identifier.cast("string"), F.lit(""))), 256), 1, 13), 16, 10)
    uniform = (digits.cast("bigint") + F.lit(0.5)) / F.lit(float(1 << 52))
    weight = F.when(quality > LEAST_WEIGHT, quality.cast("double")).otherwise(F.lit(LEAST_WEIGHT))
    return -F.log(uniform) / weight


def mix(
    docs: DataFrame, identifier: Column, source: Column, size: Column, quality: Column,
    weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS, seed: str = SEED,
) -> DataFrame:
    """One row per document: ``id, source, size, source_size, target, copies, taken``.

    ``copies`` is how often the mix has the document, ``taken`` the words that makes.
    """
    narrow = docs.select(
        identifier.alias("id"), source.alias("source"), F.coalesce(size, F.lit(0)).cast("bigint").alias("size"), draw(identifier, quality, seed).alias("key")
    ).withColumn("bucket", F.least(F.floor((1 - F.exp(-F.col("key"))) * BUCKETS), F.lit(BUCKETS - 1)).cast("int"))
    narrow = written(narrow.groupBy("source", "bucket", "key", "id", "size").agg(F.count("*").alias("n")), "sizes")
    ranges = written(narrow.groupBy("source", "bucket").agg(F.sum(F.col("n") * F.col("size")).alias("words")), "ranges")
    sources = targets(ranges.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most)
    of, part = F.col("of"), F.col("part")
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select(F.col("source").alias("of"), F.col("bucket").alias("part"), F.coalesce(F.sum("words").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("source", "bucket").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = narrow.withColumn("inside", F.sum(F.col("n") * F.col("size")).over(inside) - F.col("n") * F.col("size"))
    placed = placed.join(starts, same(F.col("source"), of) & (F.col("bucket") == part)).drop("of", "part")
    budget = sources.select(F.col("source").alias("of"), "source_size", "target")
    placed = placed.join(budget, same(F.col("source"), of)).drop("of")
    epochs = "IF(source_size > 0, CAST(floor(target / source_size) AS BIGINT), 0L)"
    pieces = placed.selectExpr(
        "id", "source", "size", "source_size", "target", f"{epochs} AS epochs", "before + inside AS start", "n", f"explode(sequence(0L, (n - 1) DIV {PIECE})) AS piece"
    )
    return pieces.selectExpr(
        "id", "source", "size", "source_size", "target", "epochs", "start",
        f"explode(sequence(piece * {PIECE} + 1, least(n, (piece + 1) * {PIECE}))) AS place",
    ).selectExpr(
        "id", "source", "size", "source_size", "target",
        "epochs + IF(2 * (start + place * size) - size <= 2 * (target - epochs * source_size) AND target > epochs * source_size, 1L, 0L) AS copies",
    ).withColumn("taken", F.col("copies") * F.col("size"))


def select(docs: DataFrame, plan: DataFrame, identifier: str, size: Column, copies: str = "copies") -> DataFrame:
    """The documents of the mix with their columns and ``copies``. Rows that share id and size share the larger
    number of copies."""
    key, words, times = (fresh(c, docs) for c in ("__id", "__words", copies))
    wanted = plan.filter("copies > 0").groupBy(F.col("id").alias(key), F.col("size").alias(words)).agg(F.max("copies").alias(times))
    return docs.join(wanted, same(docs[identifier], F.col(key)) & (size == F.col(words))).drop(key, words)


def repeat(selected: DataFrame, copies: str = "copies") -> DataFrame:
    """One row per copy."""
    return selected.withColumn(copies, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(copies)))).drop(copies)
