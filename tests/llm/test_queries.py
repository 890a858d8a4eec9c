"""The registered queries: SQL twins, and the pipeline against a plain version of its stages."""

from __future__ import annotations

import hashlib
import math
from collections import Counter, defaultdict

import pytest
from compare import compare, connect
from test_operators import SMALL, WORDS, near_components, plain_fingerprint

import corpus_pipeline
from tessera.llm import decontaminate, quality_rules
from tessera.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, name):
    problem, rows = compare(spark, duck, QUERIES[name], ORACLES[name], SMALL)
    assert not problem and rows


def rejected(text):
    measured = dict(zip(quality_rules._FIELDS, quality_rules.measure(text)))
    return any(eval(r.failed.replace("AND", "and").replace("OR", "or"), {}, measured) for r in quality_rules.RULES)


def cleaned(docs):
    total, having = Counter(), Counter()
    for source, text in docs.values():
        total[source] += 1
        for line in {x.strip(" \t\n\v\f\r") for x in text.split("\n")} - {""}:
            having[source, line] += 1
    often = lambda s, x: having[s, x] >= 2 and having[s, x] > 0.1 * total[s]
    return {i: (s, "\n".join(x for x in t.split("\n") if not often(s, x.strip(" \t\n\v\f\r")))) for i, (s, t) in docs.items()}


def first_of_groups(docs):
    prints = {i: plain_fingerprint(t) for i, (_, t) in docs.items()}
    root = near_components(prints.values())
    least = {}
    for i, p in prints.items():
        least[root[p]] = min(least.get(root[p], i), i)
    return {i: docs[i] for i in least.values()}


def without_items(docs, items):
    found = [[decontaminate.shingles(p) for p in decontaminate.parts(t)] for t in items]

    def has(text):
        words = decontaminate.tokens(text)
        runs = {n: set(zip(*(words[i:] for i in range(n)))) for n in range(1, 6)}
        return any(all(sum(g in runs[len(g)] for g in part) >= 0.8 * len(part) for part in both) for both in found)

    return {i: d for i, d in docs.items() if not has(d[1])}


def mixed(docs, quality):
    """Copies of each document in the mix."""
    size = {i: len(WORDS.findall(t)) for i, (_, t) in docs.items()}
    per = defaultdict(list)
    for i, (source, _) in docs.items():
        per[source].append(i)
    weight = dict(zip(sorted(per), [5, 2, 1] * len(per)))
    rest, target = sum(size.values()), {}
    open_ = {s: sum(size[i] for i in ids) for s, ids in per.items()}
    while open_:
        share = {s: weight[s] * rest / sum(weight[x] for x in open_) for s in open_}
        full = [s for s in open_ if share[s] > 3 * open_[s]]
        if not full:
            target |= share
            break
        for s in full:
            target[s] = 3 * open_.pop(s)
            rest -= target[s]
    copies = {}
    for source, ids in per.items():
        whole = sum(size[i] for i in ids)
        epochs = int(target[source] // whole)
        left, reached = target[source] - epochs * whole, 0

        def key(i):
            n = int(hashlib.sha256(f"mix-1:{i}".encode()).hexdigest()[:13], 16)
            return -math.log((n + 0.5) / 2**52) / {1: 2.0, 0: 0.5, None: 1.0}[quality.get(i)]

        for i in sorted(ids, key=key):
            reached += size[i]
            copies[i] = epochs + (2 * reached - size[i] <= 2 * left and left > 0)
    return {i: n for i, n in copies.items() if n}


def test_pipeline_against_plain_python(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    docs = {r.doc_id: (r.source, r.text) for r in rows if not rejected(r.text)}
    docs = without_items(first_of_groups(cleaned(docs)), items)
    want = {(i, docs[i][1], n) for i, n in mixed(docs, quality).items()}
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert {(r.doc_id, r.text, r.copies) for r in got} == want and len(got) == len(want)
    assert all(r.n_chars == len(r.text) for r in got)
