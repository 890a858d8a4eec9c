"""Personal data: base spans against the plain patterns, disguises, offsets, and defined cases."""

from __future__ import annotations

import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from tessera.llm import pii
from tessera.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "phone":
        return 8 <= len(digits) <= 15
    if kind == "card":
        doubled = "".join(d if k % 2 == 0 else str(2 * int(d)) if int(d) < 5 else str(2 * int(d) - 9) for k, d in enumerate(digits[::-1]))
        return 16 <= len(digits) <= 19 and sum(map(int, doubled)) % 10 == 0
    return True


def plain_spans(text):
    return [(kind, *m.span()) for kind, pattern in PLAIN.items() for m in re.finditer(pattern, text) if passes(kind, m[0])]


def test_base_spans_of_random_texts():
    rng = random.Random(3)
    pieces = ["a@b.c", "1.2.3.4", "4111 1111 1111 1111", "+1 (555) 123-4567", "999.1.1.1.1", "@", ".", "-", " ", "+", "é", "0", "47", "x_%", "٣", "4111111111111111"]
    for _ in range(20_000):
        text = "".join(rng.choice(pieces) if rng.random() < 0.4 else rng.choice("aZ0159.@-+ ()%é") for _ in range(rng.randrange(25)))
        assert [s[:3] for s in pii.spans(text) if not s[3]] == plain_spans(text), text


def test_query_against_the_plain_patterns(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op11_pii"](spark, SMALL).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        base = plain_spans(texts[r.doc_id])
        told = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert r.base_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in base) for kind in PLAIN]
        listed = r.spans.split(",") if r.spans else []
        assert set(filter(None, told.split(","))) <= set(listed) and len(listed) == len(base) + r.n_added
        assert listed == sorted(listed, key=lambda s: (list(PLAIN).index(s.split(":")[0]), *map(int, s.split(":")[1:])))


DISGUISED = [
    ("email", "write to ", "jane [at] mail (dot) org", " now"),
    ("email", "über ", "john dot doe at example dot com", " please"),
    ("email", "(", "bob(at)example.co.uk", ")"),
    ("email", "x ", "jоhn@exаmple.com", " y"),
    ("email", "", "user​@exam​ple.com", ""),
    ("email", "m: ", "j&#64;x&#46;com", "."),
    ("email", "m: ", "ｊ０＠ｘ．ｏｒｇ", " "),
    ("email", "schreib an ", "anna at beispiel punkt de", ", bitte"),
    ("phone", "call ", "plus one two one two five five five oh one nine nine", " now"),
    ("phone", "Tel ", "+1 two one two five five five 0 1 9 9", " x"),
    ("phone", "tel ", "+3l 555 O123 44", " x"),
    ("card", "card ", "four one one one one one one one one one one one one one one one", " end"),
    ("card", "n ", "٤111 1111 1111 1111", " n"),
    ("card", "card ", "4O12 8888 8888 1881", " end"),
    ("card", "card ", "four triple one double one double one 11 1111 1111 one".replace(" 11 1111 1111 one", " double one double one double one double one"), " end"),
    ("ip", "at ", "192[.]168[.]1[.]1", " and"),
    ("ip", "host ", "one nine two dot one six eight dot one dot one", "."),
    ("ip", "host ", "10 dot 0 dot 0 dot 1", ","),
    ("ip", "host ", "１０.0.0.１", ","),
]


@pytest.mark.parametrize("kind, before, found, after", DISGUISED)
def test_disguises_come_back_with_their_place_in_the_source(kind, before, found, after):
    text = before + found + after
    assert (kind, len(before), len(before) + len(found), True) in pii.spans(text)


def test_neighbouring_cards_are_judged_one_by_one():
    text = "7536784127813050 4845168114407329"
    assert pii.spans(text) == [("card", 0, 16, True), ("card", 17, 33, True)]


@pytest.mark.parametrize(
    "text",
    [
        "Look at the dot com boom, or at example.com if you like.",
        "The three of them: one two three four, and six or seven more.",
        "Meet me at noon. dot is a word. 3 . 4 dot 5",
        "un deux trois, nous irons au bois; eins zwei drei",
        "Привет, это обычный русский текст. Καλημέρα κόσμε.",
        "½ ① ٣ 日本語 — “quoted” … at a glance (at least)",
        "I0l and O0O stay, version 1.2.3 too; stay-at-home",
    ],
)
def test_ordinary_prose_is_left_alone(text):
    assert pii.spans(text) == []


def test_long_texts_take_linear_time():
    for piece in ("a", "1", "1.", "+1 ", "one ", "a dot ", "a at ", "a@", "@", "[dot]", "a-", "0O", "Ж", "[ ", "a.b@c."):
        start = time.perf_counter()
        pii.spans(piece * (400_000 // len(piece)))
        assert time.perf_counter() - start < 20, piece


def test_tapes_lead_back():
    tape = pii.Tape("abcdefgh", [(1, 3, "X"), (4, 4, "++"), (6, 8, "")])
    assert tape.text == "aXd++ef"
    assert tape.back(0, 1) == (0, 1, False) and tape.back(0, 2) == (0, 3, True) and tape.back(1, 2) == (1, 3, True)
    assert tape.back(2, 3) == (3, 4, False) and tape.back(2, 7) == (3, 6, True) and tape.back(5, 7) == (4, 6, False)


def test_defined_cases(spark):
    long = "word " * 200_000 + "a@b.com"
    rows = [(1, None), (2, ""), (None, "a@b.com"), (3, "x a at b dot com +1 (017) 555-7713"), (3, "x a at b dot com +1 (017) 555-7713"), (4, long)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("pii", F.lit("extra"))
    clean = pii.redact(docs)
    assert clean.columns == ["doc_id", "text", "pii", "_pii"]
    told = {(r.doc_id, r.text[-40:] if r.text else r.text, len(r._pii)) for r in clean.collect()}
    assert told == {(1, None, 0), (2, "", 0), (None, "<EMAIL>", 1), (3, "x <EMAIL> <PHONE>", 2), (4, ("word " * 9)[-33:] + "<EMAIL>", 1)}
    assert clean.count() == 6 and pii.redact(docs.limit(0)).collect() == []
