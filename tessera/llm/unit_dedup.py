"""Removes text units that an earlier document already has.

Texts are cut into units: paragraphs, lines, or sentences inside lines (a sentence also starts where a capitalised
word follows a word without a full stop and seven words in lower case come next, so that a passage put into the middle
of a line keeps its own units, and names and German nouns mostly do not cut). Units are normalised (lower case, runs
of white space as one blank) and hashed to 128 bits. Several kinds may be compared at once, each with its own kind only;
``WHOLE`` takes every paragraph and line that has a word, and sentences for passages inside a line. The occurrence with the smallest rank (the document id) and
offset stays, every later one goes; offsets count characters of the original text. Only hashes, ids and offsets are
shuffled. A unit is counted with partial sums and joined in a way adaptive execution can split, so one that a third
of the documents share is never gathered in one place.

Every row is a document of its own, whatever its id: rows are numbered and written once, and spans belong to numbers.

Defined cases: units of fewer words than their kind's least are not compared, and a unit without a word never is. NULL and empty texts have no units. A NULL id
ranks after all others; rows with equal or missing ids rank by a hash of their texts, and of equal rows any one keeps its
text. Extra columns pass through ``remove`` untouched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from tessera.llm.common import fresh, written

MIN_WORDS = 8
# A unit ends where one of these matches nothing; the units of a text make up the whole text.
CUTS = {
    "paragraph": re.compile(r"(?<=\n)(?=[ \t\r]*\n)"),
    "line": re.compile(r"(?<=\n)"),
    "sentence": re.compile(r"(?<=\n)|(?<=[.!?] )|(?<=[^\W\d_] )(?=[A-ZÀ-ÖØ-Þ][^\W\d_A-ZÀ-ÖØ-Þ]*[.,;]?(?: [a-zß-öø-ÿ][^\W_]*[.,;]?){7})"),
}
# Kinds of units with the least number of words, for all repeats of a text: lines and paragraphs have no floor.
WHOLE = {"paragraph": 1, "line": 1, "sentence": MIN_WORDS}
_UNITS = "row bigint, hash bigint, start int, length int, a bigint, b bigint"
_SPAN = "array<struct<start:int,end:int>>"


def cut(text: str, unit: str) -> Iterator[tuple[int, str]]:
    at = 0
    for match in CUTS[unit].finditer(text):
        if match.start() > at:
            yield at, text[at : match.start()]
            at = match.start()
    if at < len(text):
        yield at, text[at:]


def numbered(docs: DataFrame, row: str) -> DataFrame:
    """``docs`` with a number of its own for every row as ``row``, written, so that the numbers stay."""
    return written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")


def units(docs: DataFrame, row: str, rank: str, text: str = "text", unit: str | dict[str, int] = "sentence", min_words: int = MIN_WORDS) -> DataFrame:
    """``rank, row, hash, start, length, a, b`` of every unit with at least ``min_words`` words; ``a, b`` is its hash and
    ``hash`` that of the whole text. ``unit`` is a kind, or kinds with the least number of words of each, which then have
    hashes of their own."""
    kinds = {unit: min_words} if isinstance(unit, str) else unit

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, starts, lengths, digests = [], [], [], []
            for at, value in enumerate(batch.column(3).to_pylist()):
                for seed, (kind, least) in enumerate(kinds.items()):
                    for start, piece in cut(value or "", kind):
                        words = piece.lower().split()
                        if len(words) >= max(least, 1):
                            owner.append(at)
                            starts.append(start)
                            lengths.append(len(piece))
                            digests.append(xxh3_128_digest(" ".join(words).encode("utf-8", "surrogatepass"), seed))
            halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            own = [batch.column(k).take(pa.array(owner, pa.int64())) for k in range(3)]
            columns = [*own, pa.array(starts, pa.int32()), pa.array(lengths, pa.int32()), pa.array(halves[:, 0]), pa.array(halves[:, 1])]
            yield pa.RecordBatch.from_arrays(columns, ["rank", "row", "hash", "start", "length", "a", "b"])

    type_ = docs.schema[rank].dataType.simpleString()
    told = docs.select(F.col(rank).alias("rank"), F.col(row).alias("row"), F.xxhash64(text).alias("hash"), F.col(text).alias("text"))
    return told.mapInArrow(run, f"rank {type_}, {_UNITS}")


def repeats(docs: DataFrame, row: str, rank: str = "doc_id", text: str = "text", unit: str | dict[str, int] = "sentence", min_words: int = MIN_WORDS) -> DataFrame:
    """``row, start, length`` of every occurrence after the first."""
    found = written(units(docs, row, rank, text, unit, min_words), "units")
    place = F.struct(F.col("rank").isNull().alias("last"), *[F.col(c).alias(c) for c in ("rank", "hash", "row", "start")])
    firsts = found.groupBy("a", "b").agg(F.count("*").alias("n"), F.min(place).alias("first")).filter("n > 1")
    # Written, so that the join shuffles both sides anew and a hot unit can be split.
    firsts = written(firsts.select(F.col("a").alias("x"), F.col("b").alias("y"), "first.row", "first.start").withColumnsRenamed({"row": "first_row", "start": "first_start"}), "repeated-units")
    joined = found.join(firsts, (F.col("a") == F.col("x")) & (F.col("b") == F.col("y")))
    return joined.filter("row <> first_row OR start <> first_start").select("row", "start", "length")


def spans(docs: DataFrame, row: str, rank: str = "doc_id", text: str = "text", unit: str | dict[str, int] = "sentence", min_words: int = MIN_WORDS) -> DataFrame:
    """``row, n_units, spans`` of ``numbered`` documents: the number of removed units (one inside another does not count), and
    the removed stretches of the original text in order, neighbours joined. Documents that lose nothing are left out."""
    gone = repeats(docs, row, rank, text, unit, min_words).distinct()
    pieces = F.sort_array(F.collect_list(F.struct("start", (F.col("start") + F.col("length")).alias("end"))))
    listed = gone.groupBy("row").agg(pieces.alias("pieces"))
    told = F.pandas_udf(_joined_all, f"n_units bigint, spans {_SPAN}")("pieces")
    return listed.select("row", told.alias("told")).select("row", "told.n_units", "told.spans")


def judged(docs: DataFrame, rank: str = "doc_id", text: str = "text", unit: str | dict[str, int] = "sentence", min_words: int = MIN_WORDS, n_units: str = "n_units", removed: str = "removed") -> DataFrame:
    """``docs`` with the number of removed units and the removed stretches of every row (NULL: nothing)."""
    row, key, count, gone = fresh("__row", docs), fresh("__of", docs), fresh(n_units, docs), fresh(removed, docs)
    own = numbered(docs, row)
    found = written(spans(own, row, rank, text, unit, min_words), "spans").toDF(key, count, gone)
    return own.join(found, F.col(row) == F.col(key), "left").drop(row, key)


def joined(pieces: list[tuple[int, int]]) -> list[tuple[int, int]]:
    result: list[tuple[int, int]] = []
    for start, end in pieces:
        if result and start <= result[-1][1]:
            result[-1] = (result[-1][0], max(end, result[-1][1]))
        else:
            result.append((start, end))
    return result


def outermost(pieces: list[tuple[int, int]]) -> int:
    """Number of pieces that are not inside another."""
    n, reached = 0, -1
    for _, end in sorted(set(pieces), key=lambda p: (p[0], -p[1])):
        n, reached = n + (end > reached), max(reached, end)
    return n


def _joined_all(column: pd.Series) -> pd.DataFrame:
    rows = [[(p["start"], p["end"]) for p in pieces] for pieces in column]
    return pd.DataFrame([(outermost(r), [{"start": s, "end": e} for s, e in joined(r)]) for r in rows], columns=["n_units", "spans"])


def _without(texts: pd.Series, cuts: pd.Series) -> pd.Series:
    result = []
    for text, stretches in zip(texts, cuts):
        if text is not None and stretches is not None and len(stretches):
            edges = [0, *(x for s in stretches for x in (s["start"], s["end"])), len(text)]
            text = "".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
        result.append(text)
    return pd.Series(result, dtype=object)


def without(text: str | Column, stretches: str | Column) -> Column:
    """The text outside the stretches of a span column."""
    return F.pandas_udf(_without, "string")(text, stretches)


def remove(docs: DataFrame, rank: str = "doc_id", text: str = "text", unit: str | dict[str, int] = "sentence", min_words: int = MIN_WORDS, removed: str = "removed") -> DataFrame:
    """``docs`` without the repeated units, and the removed stretches as ``removed`` (NULL: nothing)."""
    count, gone = fresh("__n_units", docs), fresh(removed, docs)
    both = judged(docs, rank, text, unit, min_words, count, gone).drop(count)
    return both.withColumn(text, without(F.col(text), F.col(gone)))
