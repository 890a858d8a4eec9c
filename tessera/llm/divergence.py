"""Audits how far the sources of a language differ in their use of terms.

Terms are counted inside tasks in buckets by length: a term of up to 8 bytes is packed into one unsigned word, one
of up to 16 bytes into two, and occurrences are radix-sorted by group and words and counted by runs; longer terms
are sorted as bytes, one bucket per power of two. What a chunk of texts has counted goes to Spark, which adds it up
by language, term and source. Only the counts are shuffled, never occurrences, so a frequent term costs one row per
chunk and source.

Shares are exact integers. Two sources of a language are compared over all its kept terms without a row per term and
pair: with ``z`` the share of an absent term, a pair's sum is V times ``|z - z'|``, corrected for the terms of either
source (grouped by share first) and for the terms that both have.

Defined cases: NULL text, language and source are empty strings. A language without kept terms has pairs of value 0
and no terms. Every row is a document of its own, ids are not looked at. Extra columns are not looked at either.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written
from tessera.llm.terms import LETTERS, PACKED, SHORT, Cut, chunks, cut, radix_order, runs, unpack

LEAST_DOCUMENTS = 30
TOP_TERMS = 50
_SCALE, _PRIOR = 1_000_000_000, 5
_SCHEMA = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def _counted(order: np.ndarray, groups: np.ndarray, owners: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First occurrence, occurrences and documents of every run of equal groups and keys, given their order."""
    held = [k[order] for k in (groups, *keys)]
    starts = runs(*held)
    own = owners[order]
    # The order is stable and occurrences come in reading order, so those of a document are neighbours.
    fresh = np.zeros(len(own), np.int64)
    fresh[runs(*held, own)] = 1
    return order[starts], np.diff(starts, append=len(own)), np.add.reduceat(fresh, starts)


def _buckets(terms: Cut, groups: np.ndarray) -> Iterator[tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]]:
    """Group, term, occurrences and documents of all terms, bucket by bucket."""
    longest = int(terms.lengths.max(initial=0))
    for low, high, n_words in ((0, SHORT, 1), (SHORT, PACKED, 2)):
        chosen = np.flatnonzero((terms.lengths > low) & (terms.lengths <= high))
        if len(chosen):
            some, own = terms.take(chosen), groups[chosen]
            words = [some.words(k) for k in range(n_words)]
            first, n, docs = _counted(radix_order(own.astype(np.uint64), *words), own, some.owners, *words)
            yield own[first], unpack(*[w[first] for w in words]), n, docs
    width = PACKED
    while width < longest:
        chosen = np.flatnonzero((terms.lengths > width) & (terms.lengths <= 2 * width))
        width *= 2
        if len(chosen):
            some, own = terms.take(chosen), groups[chosen]
            wide = np.array(some.bytes(), f"S{width}")
            first, n, docs = _counted(np.lexsort((wide, own)), own, some.owners, wide)
            yield own[first], wide[first].tolist(), n, docs


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """``lang, source, term, n, docs`` per chunk of texts: occurrences and documents with the term, to be added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, sources = (batch.column(i).to_pylist() for i in (0, 1))
            numbers: dict[tuple[str, str], int] = {}
            group_of = np.array([numbers.setdefault(pair, len(numbers)) for pair in zip(langs, sources)], np.int64)
            names = [pa.array([pair[i] for pair in numbers], pa.string()) for i in (0, 1)]
            for texts in chunks(batch.column(2)):
                terms = cut(texts, LETTERS)
                if len(terms.starts):
                    for own, found, n, held in _buckets(terms, group_of[texts.first + terms.owners]):
                        chosen = pa.array(own)
                        columns = [names[0].take(chosen), names[1].take(chosen), pa.array(found, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(held)]
                        yield pa.RecordBatch.from_arrays(columns, schema=_SCHEMA)

    own = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "text"))])
    return own.mapInArrow(run, "lang string, source string, term string, n bigint, docs bigint")


def _share(count: str, total: str) -> str:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * V)); NULL without kept terms."""
    top = f"CAST({_SCALE} AS DECIMAL(10,0)) * CAST({count} + {_PRIOR} AS DECIMAL(20,0))"
    return f"IF(v = 0, NULL, 1L + (({top}) DIV CAST({total} + {_PRIOR} * v AS DECIMAL(20,0))))"


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank``: how far every source is from each other source of its language
    (``pair``), and the terms that it uses more often than its language does (``term``, the first ``top``)."""
    # Dealt by language and term once, which serves the sums of each source and of all of them: a term has a row per source by then.
    counted = term_counts(docs, lang, source, text).repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_all = "OVER (PARTITION BY lang, term)"
    summed = counted.selectExpr("lang", "term", "source", "n", f"sum(n) {of_all} AS of_all", f"sum(docs) {of_all} AS docs")
    kept = written(summed.filter(F.col("docs") >= least).drop("docs"), "kept-terms")

    named = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source")).distinct()
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = kept.groupBy("lang", "term").agg(F.sum("n").alias("n")).groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("lang_total"))
    groups = named.join(sums, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["total", "v", "lang_total"])
    # One row per group; the planner sees its size and broadcasts it where it is small.
    groups = written(groups.selectExpr("*", f"{_share('0L', 'total')} AS z"), "groups")

    shares = kept.join(groups, ["lang", "source"]).selectExpr(
        "lang", "source", "term", f"{_share('n', 'total')} AS p", f"{_share('of_all', 'lang_total')} AS q", "z"
    )
    shares = written(shares, "shares")
    return _ranked(_pairs(groups, shares).withColumn("part", F.lit("pair")), None).unionByName(
        _ranked(shares.filter("p > q").selectExpr("lang", "source", "term AS item", "p - q AS value", "'term' AS part"), top)
    )


def _pairs(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """``lang, source, item, value`` of every source and other source of its language."""
    other = groups.selectExpr("lang", "source AS item", "z AS other_z")
    absent = groups.select("lang", "source", "v", "z").join(other, "lang").filter("source <> item")
    absent = absent.selectExpr("lang", "source", "item", "coalesce(v * abs(z - other_z), 0L) AS value")
    # Terms that the source has, as if the other had none of them; by share, of which there are few.
    graded = shares.groupBy("lang", "source", "p", "z").agg(F.count("*").alias("n"))
    lone = graded.join(other, "lang").filter("source <> item")
    lone = lone.groupBy("lang", "source", "item").agg(F.expr("sum(n * (abs(p - other_z) - abs(z - other_z)))").alias("value"))
    # Terms that both have: what was added for either, set right.
    second = shares.selectExpr("lang", "term", "source AS item", "p AS other_p", "z AS other_z")
    both = shares.select("lang", "term", "source", "p", "z").join(second, ["lang", "term"]).filter("source < item")
    both = both.groupBy("lang", "source", "item").agg(
        F.expr("sum(abs(p - other_p) - abs(p - other_z) - abs(z - other_p) + abs(z - other_z))").alias("value")
    )
    turned = [df.selectExpr("lang", "item AS source", "source AS item", "value") for df in (lone, both)]
    return absent.unionByName(lone).unionByName(both).unionByName(turned[0]).unionByName(turned[1]).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _ranked(found: DataFrame, most: int | None) -> DataFrame:
    """Ranks inside group and part; ``most`` cuts groups down before they are shuffled."""
    numbered = found.selectExpr("*", "row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank")
    numbered = numbered.filter(F.col("rank") <= most) if most else numbered
    return numbered.select("lang", "source", "part", "item", F.col("value").cast("bigint"), F.col("rank").cast("int"))
