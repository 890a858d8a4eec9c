"""NULLs in any column, empty and very long texts, ties and repeated rows, empty tables, clashing extra columns."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tessera.llm import decontaminate, line_dedup, mixing, quality_classifier, quality_rules, secret_scan, simhash, suffix_dedup, unit_dedup, url_filter
from tessera.llm.common import word_count

PASSAGE = "It was a bright cold day in spring and the clocks were striking thirteen while somebody slipped quickly through the glass doors of the mansions. "
LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(60_000))
# Names that operators use inside.
EXTRA = ("__measured", "__site", "__keys", "__id", "__kept", "__hits", "copies", "size", "target", "removed", "host", "score", "rank", "part")
ROWS = [
    (1, PASSAGE * 3, "en", "a", 10),
    (1, PASSAGE * 3, "en", "a", 10),
    (2, PASSAGE + "Another end follows here with several more words than before.", "en", "a", None),
    (3, None, None, None, None),
    (4, "", "en", "b", 0),
    (5, " \t\n\r\x0b\x0c ", "en", "b", 7),
    (None, PASSAGE, "en", "b", 5),
    (None, PASSAGE, "en", None, 5),
    (6, LONG, "en", "c", 9),
    (7, LONG, "en", "c", 9),
    (8, "word", "en", "", 4),
    (9, "ñandú 日本語 \U0001f600 " * 40, "es", "d", 1),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def with_extra(df):
    return df.withColumns({c: F.lit(f"extra {c}") for c in EXTRA})


@pytest.fixture(scope="module")
def docs(spark):
    return with_extra(spark.createDataFrame(ROWS, SCHEMA))


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, PASSAGE), (2, None), (3, ""), (None, "only one of the items"), (4, "word")], "item_id bigint, text string")


def ids(df, column="doc_id"):
    return sorted((r[column] for r in df.select(column).collect()), key=lambda i: (i is None, i or 0))


def test_quality_rules(docs, none):
    kept = quality_rules.filter_documents(docs)
    assert kept.columns == docs.columns
    # Words 1 repeats its passage, 9 its three words; the others are short or empty.
    assert ids(kept) == [2, None, None]
    assert quality_rules.filter_documents(none).collect() == []
    entries = quality_rules.ledger(docs, ["doc_id"])
    assert entries.count() == len(ROWS)
    assert {r.n_words for r in entries.filter("doc_id IN (3, 4, 5)").collect()} == {0}
    assert {r.n_words for r in entries.filter("doc_id IN (6, 7)").collect()} == {120_000}
    table = {r.rule: (r.n_failed, r.n_failed_alone) for r in quality_rules.ablation(entries).collect()}
    assert table["too_few_words"] == (4, 4) and table["repeated_windows"][0] == 5
    assert {r.n_failed for r in quality_rules.ablation(entries.limit(0)).collect()} == {0}


def test_line_dedup(spark, none):
    same = [(i, f"menu of the site\nown line {i}\n\n", "en", "s" if i < 20 else None, 1) for i in range(40)]
    pages = with_extra(spark.createDataFrame([*same, (99, None, None, None, None), (98, "", "en", "s", 0)], SCHEMA))
    clean = line_dedup.drop_boilerplate(pages, F.col("source"))
    assert clean.columns == pages.columns
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert texts[3] == "own line 3\n\n" and texts[30] == "own line 30\n\n"
    assert texts[99] is None and texts[98] == ""
    assert line_dedup.drop_boilerplate(none, F.col("source")).collect() == []


def test_simhash(docs, none):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    # Without words: 3, 4, 5 are one group. The passages without an id differ from 1 in five bits, so one of them stays.
    assert ids(kept) == [1, 2, 3, 6, 8, 9, None]
    assert simhash.keep_one(none).collect() == []
    assert simhash.groups(none).collect() == []


def test_decontamination(docs, none, items):
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert ids(kept) == [3, 4, 5, 6, 7, 9]
    found = {(r.doc_id, r.item_id) for r in decontaminate.find(docs, items).collect()}
    assert found == {(1, 1), (2, 1), (None, 1), (8, 4)}
    assert decontaminate.drop_contaminated(docs, items.limit(0)).count() == len(ROWS)
    assert decontaminate.find(none, items).collect() == [] == decontaminate.find(docs, items.limit(0)).collect()


def test_decontamination_in_shards(docs, items, monkeypatch):
    """A benchmark too large for one index gives the same matches, with one index at a time."""
    assert len(decontaminate.shards(items, most=40)) > 1
    cut = decontaminate.shards
    monkeypatch.setattr(decontaminate, "shards", lambda items: cut(items, most=40))
    assert {(r.doc_id, r.item_id) for r in decontaminate.find(docs, items).collect()} == {(1, 1), (2, 1), (None, 1), (8, 4)}
    assert ids(decontaminate.drop_contaminated(docs, items)) == [3, 4, 5, 6, 7, 9]


def test_mixing(docs, none):
    size = word_count(F.col("text"))
    plan = mixing.mix(docs, F.col("doc_id"), F.col("source"), size, F.lit(None).cast("double"))
    rows = plan.collect()
    assert len(rows) == len(ROWS) and all(r.taken <= 3 * r["size"] for r in rows)
    # c has nearly all words: the small sources stop at three epochs, and c gets the rest.
    assert all(r.target <= 3 * r.source_size + 1e-9 for r in rows)
    chosen = mixing.select(docs.drop("copies"), plan, "doc_id", size)
    assert chosen.columns == [*docs.drop("copies").columns, "copies"]
    assert mixing.repeat(chosen).count() == chosen.agg(F.sum("copies")).first()[0]
    assert mixing.mix(none, F.col("doc_id"), F.col("source"), size, F.lit(1.0)).collect() == []
    wordless = mixing.mix(docs.filter("doc_id IN (3, 4, 5)"), F.col("doc_id"), F.col("source"), size, F.lit(1.0))
    assert {(r.target, r.taken) for r in wordless.collect()} == {(0.0, 0)}


def test_suffix_dedup(docs, none):
    rows = suffix_dedup.report(docs).collect()
    assert len(rows) == len(ROWS)
    told = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert told[1].n_removed == 0 and told[6].n_removed == 0 and told[3].n_bytes == 0
    assert told[7].n_removed == told[7].n_bytes == len(LONG) and told[7].n_spans == 1
    assert told[2].n_removed == len(PASSAGE)
    # A NULL id is later than all others.
    assert [r.n_removed for r in rows if r.doc_id is None] == [len(PASSAGE)] * 2
    whole = suffix_dedup.remove(docs)
    assert whole.columns == docs.columns + ["kept"]  # ``removed`` was there and is replaced
    assert suffix_dedup.report(none).collect() == []


def test_unit_dedup(docs, none):
    clean = unit_dedup.remove(docs, removed="cut")
    assert clean.columns == [*docs.columns, "cut"]
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert texts[2] == "Another end follows here with several more words than before."
    assert texts[3] is None and texts[4] == ""
    assert unit_dedup.remove(none).collect() == []
    assert clean.count() == len(ROWS)


def test_url_filter(spark):
    pages = spark.createDataFrame([(1, None), (2, ""), (3, "no scheme"), (4, "http://"), (4, "http://"), (5, "https://A.COM?x"), (6, "ftp://x.net/fr/" + "a" * 100_000)], "page_id bigint, url string")
    pages = pages.withColumns({c: F.lit(c) for c in ("__host", "__grams", "label", "features", "prediction", "name")})
    rules = [url_filter.Rule("block", "net/fr/")]
    judged = url_filter.judge(pages, rules, url_filter.labelled_urls(spark))
    assert judged.columns == [*pages.columns, "host", "path", "rule", "verdict"]
    rows = {r.page_id: (r.host, r.rule, r.verdict) for r in judged.collect()}
    assert rows[1][:2] == rows[2][:2] == rows[3][:2] == rows[4][:2] == ("", None)
    assert rows[5][0] == "a.com" and rows[6] == ("x.net", "net/fr/", "block")
    assert judged.count() == 7
    unlabelled = url_filter.judge(pages, rules, url_filter.labelled_urls(spark).limit(0))
    assert {r.verdict for r in unlabelled.filter("rule IS NULL").collect()} == {"allow"}
    assert url_filter.judge(pages.limit(0), rules, url_filter.labelled_urls(spark)).collect() == []


def test_quality_classifier(docs, spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (9, 0), (8, 0), (2, 1), (None, 1), (5, None), (77, 1)], "doc_id bigint, quality int")
    model = quality_classifier.train(docs, labels)
    scores = docs.select("doc_id", quality_classifier.score("text", model).alias("s")).collect()
    assert len(scores) == len(ROWS) and all(0 <= r.s <= 1 for r in scores)
    assert quality_classifier.train(docs, labels.limit(0)) is None
    assert quality_classifier.train(docs.limit(0), labels) is None
    assert {r.s for r in docs.select(quality_classifier.score("text", None).alias("s")).collect()} == {0.5}


def test_secret_scan(docs, spark):
    more = docs.select("doc_id", F.concat("text", F.lit(' token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"')).alias("text"), F.lit("x").alias("position"), F.lit("y").alias("label"))
    found = secret_scan.scan(more, secret_scan.labelled_findings(spark))
    assert found.columns == ["doc_id", "position", "candidate", "score", "is_secret"]
    secrets = found.filter("is_secret").collect()
    assert len(secrets) == sum(r[1] is not None for r in ROWS)
    assert {r.candidate for r in secrets} == {"24be64439e3e49cf46b2d7c90f3602a3d0b907ff"}
    assert secret_scan.scan(more.limit(0), secret_scan.labelled_findings(spark)).collect() == []
    assert {r.is_secret for r in secret_scan.scan(more, secret_scan.labelled_findings(spark).limit(0)).collect()} == {True}


def test_pipeline(spark, docs, none, monkeypatch):
    """Stages take what came before and keep the columns; an empty table goes through all of them."""
    import corpus_pipeline

    for start in (spark.createDataFrame(ROWS, SCHEMA), spark.createDataFrame([], SCHEMA)):
        current = start
        for _, stage in corpus_pipeline.STAGES[:-1]:
            current = stage(spark, current, "/root/testdata/sf0.001")
            assert current.columns == start.columns
        last = corpus_pipeline.STAGES[-1][1](spark, current, "/root/testdata/sf0.001")
        assert last.columns == [*start.columns, "copies"]
        assert last.count() <= start.count()
