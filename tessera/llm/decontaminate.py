"""Finds training documents that contain benchmark items.

The items form a BM25 inverted index; every passage of every document is a query against it. Scores are divided by
the score an item gets for its own text, so one threshold serves all items, and all items above it are retrieved.
Retrieval is block-max WAND. Postings lie in blocks of items with the largest score of a term per block. A passage
whose terms cannot reach the threshold with their largest scores of all is left, then every block that its terms
cannot reach it in. In the blocks that remain the cursors of the terms walk from pivot to pivot: with the cursors in
the order of their items, the pivot is the first item at which the block maxima up to it pass the threshold, and
postings before it are jumped over unread. All passages of a group of texts take their steps together, so a step is a few array
operations; nothing is lost by it. What is retrieved is then verified: five-word shingles of the question part and of
the answer part must both be found in the passage.

Passages are as long as two of the longest items and start every longest item, so each stretch as long as an item
lies in one passage. The index is built from at most ``SHARD_BYTES`` of item text; a larger benchmark is cut into
shards by item id. The documents are matched with one after the other: what a shard gives is written before the
next one's items are read, so the driver holds one index at a time.

Defined cases: words are runs of letters, digits and underscores in lower case. A NULL or wordless text matches
nothing, and so does a wordless item. Items with equal texts each match. A part with fewer words than a shingle is
one shingle; an item of one word has no answer part, and what is missing counts as found. Rows with equal ids are
reported together. Extra columns pass through ``drop_contaminated`` untouched.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import fresh, written

SHINGLE = 5
OVERLAP = 0.8
THRESHOLD = 0.5
SHARD_BYTES = 16 << 20
BLOCK = 16
# BM25.
K1, B = 1.2, 0.75
# Block maxima of terms found in more than one of so many blocks are kept as whole rows.
FULL_SHARE = 8
# Words of the texts that are searched together (a longer text by itself), and sums of block maxima held at once.
_GROUP = 1 << 15
_DENSE = 1 << 22
# Sums of maxima are rounded; this much below the threshold still counts as reaching it.
_SLACK = 1e-9

_WORD = re.compile(r"\w+")
_END = re.compile(r"[.!?]+(?=\s|$)|\n")
MATCH = "array<struct<item_id:bigint,score:double,question:double,answer:double>>"


def tokens(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def parts(text: str) -> tuple[list[str], list[str]]:
    """Question and answer of an item: cut after a question mark, else at the end of the sentence nearest to the
    middle, else in the middle."""
    asked = text.find("?")
    cuts = [asked + 1] if asked >= 0 else sorted((m.end() for m in _END.finditer(text)), key=lambda e: abs(e - len(text) / 2))
    for cut in cuts:
        question, answer = tokens(text[:cut]), tokens(text[cut:])
        if question and answer:
            return question, answer
    words = tokens(text)
    return words[: (len(words) + 1) // 2], words[(len(words) + 1) // 2 :]


def shingles(words: list[str]) -> set[tuple[str, ...]]:
    return set(zip(*(words[i:] for i in range(SHINGLE)))) if len(words) > SHINGLE else {tuple(words)} - {()}


@dataclass
class Index:
    """Items with their postings by term, and blocks of postings. Terms with whole rows of block maxima come first
    in the numbering of terms. ``scored`` counts the postings that were scored."""

    item_ids: list[int]
    shingles: list[tuple[set, set]]
    span: int
    terms: dict[str, int]
    # Postings by term and item; a place is term * width + item.
    width: int
    places: np.ndarray
    scores: np.ndarray
    term_max: np.ndarray
    # Blocks by term and number: where a term's begin, term * n_blocks + number, the first posting, the largest score.
    n_blocks: int
    begin: np.ndarray
    blocks: np.ndarray
    first: np.ndarray
    block_max: np.ndarray
    rows: np.ndarray = field(repr=False)
    scored: int = 0

    @staticmethod
    def build(rows: list[tuple[int, str]]) -> Index | None:
        rows = sorted(((i, t) for i, t in rows if tokens(t)), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        if not rows:
            return None
        bags = [Counter(tokens(t)) for _, t in rows]
        lengths = [sum(b.values()) for b in bags]
        mean = sum(lengths) / len(lengths)
        having = Counter(term for b in bags for term in b)
        lists: dict[str, list[tuple[int, float]]] = {t: [] for t in having}
        for k, (bag, length) in enumerate(zip(bags, lengths)):
            weight = {
                t: math.log1p((len(rows) - having[t] + 0.5) / (having[t] + 0.5)) * n * (K1 + 1) / (n + K1 * (1 - B + B * length / mean))
                for t, n in bag.items()
            }
            own = sum(weight.values())
            for t, w in weight.items():
                lists[t].append((k, w / own))
        reach = {t: len({k // BLOCK for k, _ in x}) for t, x in lists.items()}
        ordered = sorted(lists, key=lambda t: (-reach[t], t))
        n_blocks = -(-len(rows) // BLOCK)
        width = n_blocks * BLOCK
        places = np.array([n * width + k for n, t in enumerate(ordered) for k, _ in lists[t]], np.int64)
        scores = np.array([w for t in ordered for _, w in lists[t]])
        blocks, first = np.unique(places // BLOCK, return_index=True)
        block_max = np.maximum.reduceat(scores, first)
        full = np.zeros((sum(n * FULL_SHARE > n_blocks for n in reach.values()), n_blocks))
        inside = blocks[: np.searchsorted(blocks, full.size)]
        full.flat[inside] = block_max[: len(inside)]
        begin = np.searchsorted(blocks, np.arange(len(ordered) + 1) * n_blocks)
        term_max = np.maximum.reduceat(block_max, begin[:-1])
        grams = [tuple(shingles(p) for p in parts(t)) for _, t in rows]
        return Index(
            [i for i, _ in rows], grams, max(lengths), {t: n for n, t in enumerate(ordered)}, width, places, scores, term_max,
            n_blocks, begin, blocks, np.append(first, len(places)), block_max, full,
        )

    def reachable(self, found: np.ndarray, passages: np.ndarray, n_passages: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """Passages and numbers of the blocks in which the maxima of the passage's terms pass the threshold."""
        bound = np.zeros((n_passages, self.n_blocks))
        full = found < len(self.rows)
        which, first = np.unique(passages[full], return_index=True)
        if len(which):
            bound[which] = np.add.reduceat(self.rows[found[full]], first)
        terms = found[~full]
        owner, at = _ranges(self.begin[terms], self.begin[terms + 1])
        bound += np.bincount(
            passages[~full][owner] * self.n_blocks + self.blocks[at] % self.n_blocks, self.block_max[at], bound.size
        ).reshape(bound.shape)
        return np.nonzero(bound > threshold - _SLACK)

    def retrieve(self, found: np.ndarray, passages: np.ndarray, n_passages: int, threshold: float) -> list[tuple[int, int, float]]:
        """(passage, item, score) of all scores above the threshold, in this order. ``found`` and ``passages`` are the
        distinct (term, passage) pairs by passage and term."""
        hopeful = (np.bincount(passages, self.term_max[found], n_passages) > threshold - _SLACK)[passages]
        found, passages = found[hopeful], passages[hopeful]
        walks, number = self.reachable(found, passages, n_passages, threshold)
        # One cursor per walk (a passage in a block) and term that has postings in the block.
        walk, at = _ranges(*np.searchsorted(passages, [walks, walks + 1]))
        wanted = found[at] * self.n_blocks + number[walk]
        block = np.minimum(np.searchsorted(self.blocks, wanted), len(self.blocks) - 1)
        has = self.blocks[block] == wanted
        walk, block, term = walk[has], block[has], found[at][has]
        cursor, end, most = self.first[block], self.first[block + 1], self.block_max[block]
        result: list[tuple[int, int, float]] = []
        while len(walk):
            item = self.places[cursor] - term * self.width
            order = np.argsort(walk * self.width + item, kind="stable")
            walk, cursor, end, most, term, item = (x[order] for x in (walk, cursor, end, most, term, item))
            begin = np.flatnonzero(np.diff(walk, prepend=-1))
            total = np.cumsum(most)
            before = np.repeat(total[begin] - most[begin], np.diff(begin, append=len(walk)))
            passing = np.flatnonzero(total - before > threshold - _SLACK)
            # Walks without a pivot end: nothing that is left of their block can pass.
            going, where = np.unique(walk[passing], return_index=True)
            pivot = np.full(len(walks), -1)
            pivot[going] = item[passing[where]]
            on = pivot[walk] >= 0
            walk, cursor, end, most, term = (x[on] for x in (walk, cursor, end, most, term))
            cursor = np.maximum(cursor, np.searchsorted(self.places, term * self.width + pivot[walk]))
            on = cursor < end
            walk, cursor, end, most, term = (x[on] for x in (walk, cursor, end, most, term))
            there = self.places[cursor] - term * self.width == pivot[walk]
            self.scored += int(there.sum())
            score = np.bincount(walk[there], self.scores[cursor[there]], len(walks))
            result += [(int(walks[w]), int(pivot[w]), float(score[w])) for w in np.flatnonzero(score > threshold)]
            cursor = cursor + there
            on = cursor < end
            walk, cursor, end, most, term = (x[on] for x in (walk, cursor, end, most, term))
        return sorted(result)

    def matches(self, texts: list[str | None], threshold: float, overlap: float) -> list[list[tuple[int, float, float, float]]]:
        """For every text the (item id, best score, shares of its question and answer shingles) of the verified items."""
        result: list = []
        group: list[list[str]] = []
        for text in texts:
            words = tokens(text)
            if group and sum(map(len, group)) + len(words) > _GROUP:
                result += self._verified(group, threshold, overlap)
                group = []
            group.append(words)
        return result + self._verified(group, threshold, overlap)

    def _verified(self, group: list[list[str]], threshold: float, overlap: float) -> list[list[tuple[int, float, float, float]]]:
        best: list[dict[int, tuple[float, float, float]]] = [{} for _ in group]
        wide = len(self.terms)
        pairs, owners, starts, upto = [], [], [], 0
        for text, words in enumerate(group):
            numbers = np.array([self.terms.get(w, -1) for w in words], np.int64)
            at = np.flatnonzero(numbers >= 0)
            if not len(at):
                continue
            # Passage p holds the words from p * span to (p + 2) * span; the last one would lie in the one before.
            late = at // self.span
            count = max(int(late[-1]), 1)
            pairs += [(upto + np.minimum(late, count - 1)) * wide + numbers[at], (upto + np.maximum(late - 1, 0)) * wide + numbers[at]]
            owners.append(np.full(count, text))
            starts.append(np.arange(count) * self.span)
            upto += count
        if not pairs:
            return [[] for _ in group]
        pairs, owners, starts = np.unique(np.concatenate(pairs)), np.concatenate(owners), np.concatenate(starts)
        step = max(1, _DENSE // self.n_blocks)
        for low in range(0, upto, step):
            high = min(low + step, upto)
            part = pairs[slice(*np.searchsorted(pairs, [low * wide, high * wide]))]
            shown, grams = -1, set()
            for passage, item, score in self.retrieve(part % wide, part // wide - low, high - low, threshold):
                text, start = owners[low + passage], starts[low + passage]
                words = group[text][start : start + 2 * self.span]
                if passage != shown:
                    shown, grams = passage, set(zip(*(words[i:] for i in range(SHINGLE))))
                shares = tuple(_share(part, grams, words) for part in self.shingles[item])
                if min(shares) >= overlap and score > best[text].get(item, (0.0,))[0]:
                    best[text][item] = (score, *shares)
        return [[(self.item_ids[i], *v) for i, v in sorted(b.items())] for b in best]


def _ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the ranges, and which range each belongs to."""
    counts = ends - starts
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(starts, counts)


def _share(part: set, grams: set, words: list[str]) -> float:
    if not part:
        return 1.0
    if len(part) == 1 and len(short := next(iter(part))) < SHINGLE:
        return float(any(tuple(words[i : i + len(short)]) == short for i in range(len(words) - len(short) + 1)))
    return len(part & grams) / len(part)


def shards(items: DataFrame, identifier: str = "item_id", text: str = "text", most: int = SHARD_BYTES) -> list[DataFrame]:
    """The items as one table or, beyond ``most`` bytes of text, as several of about so many."""
    own = items.select(F.col(identifier).cast("bigint").alias("id"), F.col(text).alias("text")).filter("text IS NOT NULL")
    volume = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = 1 + volume // most
    return [own if count == 1 else own.filter(F.pmod(F.xxhash64("id", "text"), F.lit(count)) == k) for k in range(count)]


def read(shard: DataFrame) -> Index | None:
    return Index.build([(r.id, r.text) for r in shard.collect()])


def matches(text: str | Column, index: Index, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> Column:
    """Verified items of a text column."""

    def run(texts: pd.Series) -> pd.Series:
        found = index.matches(list(texts), threshold, overlap)
        return pd.Series([[dict(zip(("item_id", "score", "question", "answer"), m)) for m in hits] for hits in found])

    return F.pandas_udf(run, MATCH)(F.col(text) if isinstance(text, str) else text)


def find(docs: DataFrame, items: DataFrame, identifier: str = "doc_id", text: str = "text") -> DataFrame:
    """``identifier``, ``item_id``, best score and overlaps of every document and item that match."""
    schema = f"`{identifier}` {docs.schema[identifier].dataType.simpleString()}, item_id bigint, score double, question double, answer double"
    found = docs.sparkSession.createDataFrame([], schema)
    cut = shards(items)
    for shard in cut:
        if index := read(shard):
            hits = docs.select(identifier, matches(text, index).alias("__hits")).select(identifier, F.inline("__hits"))
            found = found.unionByName(hits if len(cut) == 1 else written(hits, "hits"))
    return found.groupBy(identifier, "item_id").agg(F.max("score").alias("score"), F.max("question").alias("question"), F.max("answer").alias("answer"))


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """The documents without any item, with the columns they came with."""
    kept = docs
    cut = shards(items)
    for shard in cut:
        if index := read(shard):
            hits = fresh("__hits", kept)
            clean = kept.withColumn(hits, F.size(matches(text, index))).filter(F.col(hits) == 0).drop(hits)
            kept = clean if len(cut) == 1 else written(clean, "clean")
    return kept
