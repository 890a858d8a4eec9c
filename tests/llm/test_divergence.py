"""Source divergence against plain counts over all terms."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.llm import divergence, terms

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, top):
    counts, having, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        found = TERM.findall((text or "").translate(FOLD))
        groups.add((lang or "", source or ""))
        counts[lang or "", source or ""].update(found)
        having[lang or ""].update(set(found))
    result = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in having[lang].items() if n >= least]
        own = sorted(s for x, s in groups if x == lang)
        share = lambda bag: {t: 1 + 10**9 * (bag[t] + 5) // (sum(bag[k] for k in kept) + 5 * len(kept)) for t in kept}
        shares = {s: share(counts[lang, s]) for s in own}
        whole = share(sum((counts[lang, s] for s in own), Counter()))
        for s in own:
            pairs = [(-sum(abs(shares[s][t] - shares[o][t]) for t in kept), o) for o in own if o != s]
            lead = [(whole[t] - shares[s][t], t) for t in kept if counts[lang, s][t] and shares[s][t] > whole[t]]
            for part, found, most in (("pair", pairs, None), ("term", lead, top)):
                ordered = sorted(found, key=lambda x: (x[0], x[1].encode()))[:most]
                result += [(lang, s, part, item, -value, rank) for rank, (value, item) in enumerate(ordered, 1)]
    return sorted(result)


def corpus(seed, n):
    rng = random.Random(seed)
    words = {k: [f"{k}{''.join(rng.choice('abcdé') for _ in range(rng.choice((1, 2, 5, 8, 9, 16, 17, 40, 130))))}" for _ in range(40)] for k in ("x", "Y")}
    rows = []
    for _ in range(n):
        lang, source = rng.choice(["en", "en", "fr", None]), rng.choice(["a", "hot", "hot", "hot", "ü", None])
        kind = words["x" if rng.random() < (0.9 if source == "hot" else 0.3) else "Y"]
        rows.append((lang, source, "".join(rng.choice(kind) + rng.choice(" 1,\n") for _ in range(rng.randint(0, 30)))))
    return rows + [("lone", "only", "few words"), ("bare", "p", None), ("bare", "q", ""), ("bare", "q", "x y"), ("", "", "")]


@pytest.mark.parametrize("chunk", [200, terms.CHUNK_BYTES])
def test_against_plain_counts(spark, monkeypatch, chunk):
    monkeypatch.setattr(divergence, "chunks", lambda column: terms.chunks(column, chunk))
    rows = corpus(chunk, 700)
    docs = spark.createDataFrame(rows, "lang string, source string, text string").withColumns({c: F.lit(1) for c in ("term", "n", "part", "rank")}).repartition(3)
    got = divergence.audit(docs, least=20, top=7)
    assert sorted(map(tuple, got.collect())) == plain(rows, 20, 7)


def test_long_text_and_empty_table(spark):
    long = " ".join(f"term{'abcdefghij'[i % 10] * (i % 23)}" for i in range(300_000)) + " " + "z" * 100_000
    rows = [("en", s, long) for s in ("a", "b")] + [("en", "b", "terma " * 50)]
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    assert sorted(map(tuple, divergence.audit(docs, least=2).collect())) == plain(rows, 2, 50)
    assert divergence.audit(docs.limit(0)).collect() == []
