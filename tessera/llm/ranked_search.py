"""Ranks all documents for each item of a benchmark with a K2-treap over the grid of terms and documents.

The grid has a row per term that some item uses, a column per document and in each cell the impact of the term on the
document's score. A treap holds the columns of some thousand documents in the order of their ids: a quadtree of which
only cells with an impact are kept, level by level, as four bits for the children that exist, the place of the first
child, and the largest impact inside. An item descends along the row paths of all its terms at once: a range of
documents has one cell per term, whose maxima, times the weights of the terms, bound the score of every document in the
range. Ranges are opened best bound first, in blocks, until none can beat the last of the best documents; equal bounds
go by the first document, so ties come out by ascending id and thousands of equal copies are not all opened.

Postings (documents reduced to the terms of the items) are written once, and each task cuts its own into treaps, so
documents are never shuffled; a task hands on its best documents per item and Spark merges them. Every document is
indexed. The number of documents, their lengths and the document frequencies are aggregates over all documents.

The items of one pass hold ``SHARD_BYTES`` of text at most, which bounds what is sent to the tasks; a larger set is cut into
shards by a hash of the text, and the documents are searched with one after the other.

Defined cases: NULL and termless texts are no documents, and such items have no hits. Rows with equal document ids are
documents of their own; a NULL id ranks after all others with the same score. Each item row gets its own ranking, also
where ids repeat. Extra columns are not looked at.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import fresh, written
from tessera.llm.terms import ALPHANUMERIC, PACKED, Cut, Texts, chunks, cut

BEST = 50
SHARD_BYTES = 16 << 20
# A treap takes documents until it has so many postings or columns.
TREAP_POSTINGS, TREAP_COLUMNS = 1 << 20, 1 << 14
# Ranges opened at once.
_BLOCK = 256
_CHILDREN_BELOW = np.array([[bin(bits & ((1 << slot) - 1)).count("1") for slot in range(4)] for bits in range(16)], np.int64)
_UNKNOWN = np.iinfo(np.int64).max


def _all_terms(texts: list[str | None]) -> Iterator[tuple[Texts, Cut]]:
    for some in chunks(pa.array(texts, pa.large_string())):
        yield some, cut(some, ALPHANUMERIC)


class Vocabulary:
    """The terms of some items, numbered; looks up the terms of many documents at once."""

    def __init__(self, texts: list[str | None]):
        self.items: list[np.ndarray] = [np.zeros(0, np.int64)] * len(texts)
        numbers: dict[bytes, int] = {}
        for some, terms in _all_terms(texts):
            named = terms.bytes()
            for row, upto in zip(*np.unique(terms.owners, return_index=True)):
                held = dict.fromkeys(named[upto : upto + int((terms.owners == row).sum())])
                self.items[some.first + int(row)] = np.array([numbers.setdefault(t, len(numbers)) for t in held], np.int64)
        self.size = len(numbers)
        self.long = {t: k for t, k in numbers.items() if len(t) > PACKED}
        short = {t: k for t, k in numbers.items() if len(t) <= PACKED}
        first, second = (np.array([int.from_bytes(t.ljust(PACKED, b"\0")[a : a + 8], "big") for t in short], np.uint64) for a in (0, 8))
        self.first, self.second = np.unique(first), np.unique(second)
        pairs = np.searchsorted(self.first, first) * max(len(self.second), 1) + np.searchsorted(self.second, second)
        order = np.argsort(pairs)
        self.pairs, self.numbers = pairs[order], np.array(list(short.values()), np.int64)[order]

    def find(self, terms: Cut) -> tuple[np.ndarray, np.ndarray]:
        """Text and number of every term that is in the vocabulary."""
        packed = terms.take(np.flatnonzero(terms.lengths <= PACKED))
        owners, found = [], []
        if len(self.pairs):
            words = packed.words(0)
            at = np.minimum(np.searchsorted(self.first, words), len(self.first) - 1)
            hit = np.flatnonzero(self.first[at] == words)
            packed, at = packed.take(hit), at[hit]
            words = packed.words(1)
            then = np.minimum(np.searchsorted(self.second, words), len(self.second) - 1)
            pairs = at * len(self.second) + then
            place = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
            hit = np.flatnonzero((self.second[then] == words) & (self.pairs[place] == pairs))
            owners.append(packed.owners[hit])
            found.append(self.numbers[place[hit]])
        if self.long:
            wide = terms.take(np.flatnonzero(terms.lengths > PACKED))
            numbers = np.array([self.long.get(t, -1) for t in wide.bytes()], np.int64)
            owners.append(wide.owners[numbers >= 0])
            found.append(numbers[numbers >= 0])
        return (np.concatenate(owners), np.concatenate(found)) if owners else (np.zeros(0, np.int64),) * 2


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(values, pa.int32()))


def postings(docs: DataFrame, vocabulary: Vocabulary, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc, n, terms, times`` of every document with a term: its length in terms, and how often it has which terms of the
    vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in chunks(batch.column(1)):
                terms = cut(texts, ALPHANUMERIC)
                n = np.bincount(terms.owners, minlength=len(texts))
                owners, found = vocabulary.find(terms)
                cells, times = np.unique(owners * max(vocabulary.size, 1) + found, return_counts=True)
                held = np.bincount(cells // max(vocabulary.size, 1), minlength=len(texts))
                some = np.flatnonzero(n)
                columns = [batch.column(0).take(pa.array(some + texts.first)), pa.array(n[some], pa.int64())]
                lists = [_lists(cells % max(vocabulary.size, 1), held[some]), _lists(times, held[some])]
                yield pa.RecordBatch.from_arrays([*columns, *lists], ["doc", "n", "terms", "times"])

    type_ = docs.schema[doc].dataType.simpleString()
    return docs.select(F.col(doc).alias("doc"), F.col(text).alias("text")).mapInArrow(run, f"doc {type_}, n bigint, terms array<int>, times array<int>")


def _spaced(numbers: np.ndarray) -> np.ndarray:
    """The bits of numbers below 2**32 moved to the even places."""
    x = numbers.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | x << np.uint64(shift)) & np.uint64(mask)
    return x


class Treap:
    """Quadtree of the cells (row, column, impact) of a grid. Node 0 is the whole grid; the nodes of a level stand
    together in the order of their places, so the children of a node do too."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, impacts: np.ndarray):
        self.height = max(int(rows.max(initial=0)), int(columns.max(initial=0)), 1).bit_length()
        place = _spaced(rows) << np.uint64(1) | _spaced(columns)
        order = np.argsort(place)
        place, peak = place[order], impacts[order]
        peaks, bits, counts = [peak], [np.zeros(len(peak), np.uint8)], [np.zeros(len(peak), np.int64)]
        for _ in range(self.height):
            above = place >> np.uint64(2)
            starts = np.flatnonzero(np.concatenate([[True], above[1:] != above[:-1]])) if len(above) else np.zeros(0, np.int64)
            bits.append(np.bitwise_or.reduceat(np.uint8(1) << (place & np.uint64(3)).astype(np.uint8), starts) if len(starts) else np.zeros(0, np.uint8))
            counts.append(np.diff(starts, append=len(place)))
            peak = np.maximum.reduceat(peak, starts) if len(starts) else peak
            peaks.append(peak)
            place = above[starts]
        self.peak, self.bits = np.concatenate(peaks[::-1]), np.concatenate(bits[::-1])
        # Children follow in the order of their parents, behind the top node.
        counted = np.concatenate(counts[::-1])
        self.first = 1 + np.cumsum(counted) - counted

    def best(self, rows: np.ndarray, weights: np.ndarray, most: int, score: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores and columns of the best documents, by score and then column, merged with those known from elsewhere,
        which stand at ``place`` between the columns."""
        if not len(self.peak) or not len(rows):
            return score, place
        nodes = np.zeros((1, len(rows)), np.int64)
        level, column = np.array([self.height]), np.zeros(1, np.int64)
        bound = np.array([int(self.peak[0]) * int(weights.sum())])
        while len(bound):
            least, last = (score[-1], place[-1]) if len(score) >= most else (0, -1.0)
            open_ = np.flatnonzero((bound > least) | ((bound == least) & (column << level < last)))
            if len(open_) > _BLOCK:
                ahead = np.lexsort((column[open_] << level[open_], -bound[open_]))
                now, later = open_[ahead[:_BLOCK]], open_[ahead[_BLOCK:]]
            else:
                now, later = open_, open_[:0]
            below = level[now] - 1
            row_bit = rows >> below[:, None] & 1
            made = []
            for half in (0, 1):
                child, known = self._children(nodes[now], 2 * row_bit + half)
                limit = np.where(known, self.peak[child], 0) @ weights
                some = limit > 0
                made.append((np.where(known, child, -1)[some], below[some], (2 * column[now] + half)[some], limit[some]))
            fresh_ = [np.concatenate(parts) for parts in zip(*made)]
            done = fresh_[1] == 0
            if done.any():
                score, place = np.concatenate([score, fresh_[3][done]]), np.concatenate([place, fresh_[2][done].astype(float)])
                kept = np.lexsort((place, -score))[:most]
                score, place = score[kept], place[kept]
            nodes, level, column, bound = (
                np.concatenate([old[later], new[~done]]) for old, new in zip((nodes, level, column, bound), fresh_)
            )
        return score, place

    def _children(self, nodes: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        bits = np.where(nodes >= 0, self.bits[nodes], 0)
        known = bits >> slots & 1 == 1
        return np.where(known, self.first[nodes] + _CHILDREN_BELOW[bits, slots], 0), known


def _impacts(times: np.ndarray, length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    mean = 50 + 50 * length * n_docs // n_terms
    return 1_000_000_000 * times // (1000 * times + 20 * mean)


class _Best:
    """The best documents of every item among all that a task has seen."""

    def __init__(self, items: list[tuple[np.ndarray, np.ndarray]], most: int):
        self.items, self.most = items, most
        self.found: list[tuple[np.ndarray, list]] = [(np.zeros(0, np.int64), [])] * len(items)

    def add(self, batch: pa.Table, n_docs: int, n_terms: int) -> None:
        batch = batch.take(pc.sort_indices(batch, sort_keys=[("doc", "ascending")], null_placement="at_end")).combine_chunks()
        ids = batch.column("doc").to_pylist()
        known = len(ids) - batch.column("doc").null_count
        terms, times = (pc.list_flatten(batch.column(c)).to_numpy() for c in ("terms", "times"))
        columns = np.repeat(np.arange(len(ids)), pc.list_value_length(batch.column("terms")).to_numpy())
        lengths = batch.column("n").to_numpy()[columns]
        treap = Treap(terms.astype(np.int64), columns, _impacts(times.astype(np.int64), lengths, n_docs, n_terms))
        for k, (rows, weights) in enumerate(self.items):
            score, docs = self.found[k]
            place = np.array([(known if d is None else bisect_left(ids, d, 0, known)) - 0.5 for d in docs])
            new_score, new_place = treap.best(rows, weights, self.most, score, place)
            # Those from before keep their order, so the next of them is meant wherever a place lies between columns.
            before = iter(docs)
            self.found[k] = new_score, [ids[int(p)] if p == int(p) else next(before) for p in new_place]

    def batch(self, type_: pa.DataType) -> pa.RecordBatch:
        numbers = np.repeat(np.arange(len(self.items)), [len(s) for s, _ in self.found])
        scores = np.concatenate([s for s, _ in self.found]) if self.found else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(numbers), pa.array([d for _, ds in self.found for d in ds], type_), pa.array(scores, pa.int64())], ["item", "doc", "score"])


def _search(grid: DataFrame, items: list[tuple[np.ndarray, np.ndarray]], n_docs: int, n_terms: int, most: int) -> DataFrame:
    """``item, doc, score``: per task the best documents of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, waiting, held, rows, type_ = _Best(items, most), [], 0, 0, None
        for batch in batches:
            type_ = batch.schema.field("doc").type
            for at in range(0, len(batch), TREAP_COLUMNS // 4):
                piece = batch.slice(at, TREAP_COLUMNS // 4)
                waiting.append(piece)
                held, rows = held + (pc.sum(pc.list_value_length(piece.column("terms"))).as_py() or 0), rows + len(piece)
                if held >= TREAP_POSTINGS or rows >= TREAP_COLUMNS:
                    best.add(pa.Table.from_batches(waiting), n_docs, n_terms)
                    waiting, held, rows = [], 0, 0
        if waiting:
            best.add(pa.Table.from_batches(waiting), n_docs, n_terms)
        if type_ is not None:
            yield best.batch(type_)

    return grid.mapInArrow(run, f"item bigint, doc {grid.schema['doc'].dataType.simpleString()}, score bigint")


def search(
    docs: DataFrame, items: DataFrame, most: int = BEST, doc: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """``item, rank, doc, score``: the ``most`` best documents of every item, under the names of the id columns."""
    spark = docs.sparkSession
    own = items.select(F.col(item).alias("id"), F.col(item_text).alias("text")).filter("text IS NOT NULL")
    volume = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = 1 + volume // shard_bytes
    kind = items.schema[item].dataType.simpleString()
    ranked = spark.createDataFrame([], f"item_id {kind}, rank int, doc {docs.schema[doc].dataType.simpleString()}, score bigint")
    for k in range(shards):
        rows = (own if shards == 1 else own.filter(F.pmod(F.xxhash64("text"), F.lit(shards)) == k)).collect()
        vocabulary = Vocabulary([r.text for r in rows])
        if not vocabulary.size:
            continue
        grid = written(postings(docs, vocabulary, doc, text), "postings")
        n_docs, n_terms = grid.agg(F.count("*"), F.sum("n")).first()
        if not n_docs:
            break
        # At most one row per term of the shard's items.
        having = {r.term: r.df for r in grid.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()}
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * having.get(t, 0) + 1))) for t in range(vocabulary.size)], np.int64)
        useful = [t[weights[t] > 0] for t in vocabulary.items]
        found = written(_search(grid, [(t, weights[t]) for t in useful], n_docs, n_terms, most), "best-documents")
        ordered = "row_number() OVER (PARTITION BY item ORDER BY score DESC, doc ASC NULLS LAST) AS rank"
        top = found.selectExpr("*", ordered).filter(F.col("rank") <= most)
        names = spark.createDataFrame([(n, r.id) for n, r in enumerate(rows)], f"item bigint, item_id {kind}")
        ranked = ranked.unionByName(top.join(names, "item").select("item_id", F.col("rank").cast("int"), "doc", "score"))
    key = fresh(doc, ranked) if doc in (item, "rank", "score") else doc
    return ranked.select(F.col("item_id").alias(item), "rank", F.col("doc").alias(key), "score")
