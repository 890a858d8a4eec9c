"""Ranked search against scores of all pairs."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import ranked_search, terms

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def cut(text):
    return TERM.findall((text or "").translate(FOLD))


def all_pairs(docs, items, most):
    bags = [(i, Counter(cut(t))) for i, t in docs if cut(t)]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    result = Counter()
    for item, text in items:
        scores = []
        for i, bag in bags:
            m = 50 + 50 * sum(bag.values()) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 20 * m)) for t in set(cut(text)) if bag[t])
            if score > 0:
                scores.append((-score, i is None, i, score))
        for rank, (_, _, i, score) in enumerate(sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:most], 1):
            result[item, rank, i, score] += 1
    return result


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(400)] + ["Straße", "日本語", "x" * 17, "y" * 200, "ABCdefgh", "é"]
    text = lambda size: rng.choice([" ", "-", "\n"]).join(rng.choice(words) for _ in range(size))
    copy = text(30)
    rows = [(i, copy if i % 3 == 0 else text(rng.randint(0, 60))) for i in range(n)]
    rows += [(5, copy), (5, copy), (None, copy), (None, text(9)), (n, None), (n + 1, ""), (n + 2, " .,")]
    items = [(k, text(rng.randint(1, 25))) for k in range(12)] + [(3, copy), (90, None), (91, "..."), (92, "nowhere else"), (None, copy), (93, "w1")]
    rng.shuffle(rows)
    return rows, items


@pytest.mark.parametrize("columns, postings, block, shard", [(64, 1 << 20, 4, 1 << 20), (1 << 14, 300, 256, 200), (1 << 14, 1 << 20, 1, 1 << 20)])
def test_against_all_pairs(spark, monkeypatch, columns, postings, block, shard):
    monkeypatch.setattr(ranked_search, "TREAP_COLUMNS", columns)
    monkeypatch.setattr(ranked_search, "TREAP_POSTINGS", postings)
    monkeypatch.setattr(ranked_search, "_BLOCK", block)
    rows, items = corpus(columns + block, 500)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("rank", F.lit("extra")).repartition(3)
    asked = spark.createDataFrame(items, "item_id bigint, text string").withColumn("score", F.lit("extra"))
    got = ranked_search.search(docs, asked, most=20, shard_bytes=shard)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, got.collect())) == all_pairs(rows, items, 20)


def test_ids_of_other_types_and_names(spark):
    docs = spark.createDataFrame([("b", "one two"), ("a", "one two"), (None, "one two"), ("c", "three")], "name string, body string")
    items = spark.createDataFrame([("q", "ONE")], "name string, body string")
    got = ranked_search.search(docs, items, 3, "name", "body", "name", "body")
    assert [(r[0], r[1], r[2]) for r in sorted(got.collect(), key=lambda r: r[1])] == [("q", 1, "a"), ("q", 2, "b"), ("q", 3, None)]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs.withColumn("text", F.lit(None).cast("string")), items)):
        assert ranked_search.search(d, i).collect() == []


def test_cells_of_a_treap_hold_the_largest_impact_below():
    rng = np.random.default_rng(1)
    cells = np.unique(rng.integers(0, 300 * 700, 4000))
    rows, columns, impacts = cells // 700, cells % 700, rng.integers(1, 1000, len(cells))
    treap = ranked_search.Treap(rows, columns, impacts)
    found = {}
    stack = [(0, treap.height, 0, 0)]
    while stack:
        node, level, row, column = stack.pop()
        inside = (rows >> level == row) & (columns >> level == column)
        assert treap.peak[node] == impacts[inside].max()
        if level == 0:
            found[row, column] = treap.peak[node]
        below = 0
        for slot in range(4):
            if treap.bits[node] >> slot & 1:
                stack.append((treap.first[node] + below, level - 1, 2 * row + slot // 2, 2 * column + slot % 2))
                below += 1
    assert found == {(r, c): i for r, c, i in zip(rows, columns, impacts)}


def test_few_ranges_are_opened(monkeypatch):
    """A rare term leads to its documents without opening the ranges of the others."""
    rng = np.random.default_rng(2)
    columns = np.arange(1 << 14)
    rows, at = np.concatenate([np.zeros(len(columns), np.int64), np.ones(40, np.int64)]), np.concatenate([columns, rng.choice(columns, 40, False)])
    treap = ranked_search.Treap(rows, at, np.concatenate([rng.integers(1, 100, len(columns)), np.full(40, 90)]))
    opened = []
    plain = treap._children
    monkeypatch.setattr(treap, "_children", lambda nodes, slots: (opened.append(len(nodes)), plain(nodes, slots))[1])
    score, _ = treap.best(np.array([0, 1]), np.array([1, 1000]), 20, np.zeros(0, np.int64), np.zeros(0))
    assert len(score) == 20 and score.min() > 90_000 and sum(opened) < 1 << 14


def test_terms_against_the_pattern():
    rng = random.Random(5)
    texts = ["".join(rng.choice("aZ09 é日_\0-\U0001f600") for _ in range(rng.randrange(60))) for _ in range(300)] + [None, "", "x" * 100]
    for most in (1, 50, 1 << 20):
        for some in terms.chunks(pa.array(texts).slice(3), most):
            found = terms.cut(some, terms.ALPHANUMERIC)
            got = [[] for _ in range(len(some))]
            for owner, term in zip(found.owners, found.bytes()):
                got[owner].append(term.decode())
            assert got == [cut(t) for t in texts[3:][some.first : some.first + len(some)]]
            packed = found.take(np.flatnonzero(found.lengths <= 16))
            assert terms.unpack(packed.words(0), packed.words(1)) == packed.bytes()
            order = terms.radix_order(packed.words(0), packed.words(1))
            held = packed.bytes()
            assert order.tolist() == sorted(range(len(held)), key=held.__getitem__)
