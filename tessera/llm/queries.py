"""The queries of this subpackage by name, and their SQL twins for DuckDB where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (
    decontaminate, divergence, line_dedup, mixing, pii, quality_classifier, quality_rules, ranked_search, secret_scan, simhash, suffix_dedup, unit_dedup, url_filter,
)
from tessera.llm.common import table, url_host, word_count, written

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def label_weight(docs: DataFrame, labels: DataFrame, identifier: str = "doc_id") -> DataFrame:
    """``id`` and ``weight`` of labelled documents: good ones are drawn twice as early as others, bad ones half."""
    marks = labels.groupBy(F.col(identifier).alias("id")).agg(F.max("quality").alias("quality"))
    return marks.select("id", F.when(F.col("quality") == 1, 2.0).otherwise(0.5).alias("weight"))


@query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents by source weights 5, 2, 1, with the words taken from each."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("n_words"))
    marks = label_weight(docs, table(spark, sf_dir, "labels"))
    weighed = docs.join(marks, docs["doc_id"] == marks["id"], "left")
    plan = mixing.mix(weighed, F.col("doc_id"), F.col("source"), F.col("n_words"), F.coalesce("weight", F.lit(1.0)))
    return plan.select(F.col("id").alias("doc_id"), "source", "size", "source_size", "target", "taken")


ORACLES["op1_mixing"] = """
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         coalesce((SELECT CASE WHEN max(quality) = 1 THEN 2.0::DOUBLE ELSE 0.5::DOUBLE END FROM labels l WHERE l.doc_id = d.doc_id HAVING count(*) > 0), 1.0::DOUBLE) AS weight
  FROM documents d),
keyed AS (
  SELECT *, -ln((('0x' || substr(sha256('mix-1:' || doc_id), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE) / weight AS key FROM sized),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM keyed GROUP BY source),
weighted AS (
  SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w, 3 * source_size AS most FROM sources),
placed AS (
  SELECT *, sum(source_size) OVER () AS total, sum(w) OVER () AS ws, row_number() OVER (ORDER BY most::DOUBLE / w, source NULLS LAST) AS place FROM weighted),
limits AS (
  SELECT *, most * (ws - coalesce(sum(w) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         <= (total - coalesce(sum(most) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * w AS limited FROM placed),
targets AS (
  SELECT source, source_size, CASE WHEN limited THEN most::DOUBLE
         ELSE (w * (total - coalesce(sum(CASE WHEN limited THEN most ELSE 0 END) OVER (), 0)))::DOUBLE
              / (sum(CASE WHEN limited THEN 0 ELSE w END) OVER ())::DOUBLE END AS target FROM limits),
summed AS (
  SELECT k.*, t.source_size, t.target, sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id, k.size ROWS UNBOUNDED PRECEDING) AS reached,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size)::BIGINT ELSE 0 END AS epochs
  FROM keyed k JOIN targets t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, source, size, source_size, target,
       (size * (epochs + CASE WHEN 2 * reached - size <= 2 * (target - epochs * source_size) AND target > epochs * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM summed"""


@query
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document without the 50-byte strings that an earlier document has."""
    return suffix_dedup.report(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item that a document contains, with its best score and overlaps."""
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


RULES = [url_filter.Rule(*r.split()) for r in ("allow com/", "block example.com/en/", "allow www.example.com/en/", "block net/es/", "block net/fr/")]


@query
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, RULES, url_filter.labelled_urls(spark)).select("page_id", "host", "path", "rule", "verdict")


@query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements, base verdict and the verdict of the current policy for every document."""
    entries = quality_rules.ledger(table(spark, sf_dir, "documents"), ["doc_id"])
    base_failed = ~quality_rules.kept_by("base")
    kept = quality_rules.kept_by("base") & quality_rules.kept_by(quality_rules.CURRENT)
    return entries.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), kept.alias("kept"), "failure_bits",
    )


ORACLES["op5_quality_rules"] = """
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
counted AS (
  SELECT doc_id, words, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper
  FROM texts),
lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, run) AS n
  FROM (SELECT doc_id, i, array_to_string(list_slice(words, i, i + 7), ' ') AS run
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM counted WHERE len(words) >= 8))),
repeated AS (SELECT doc_id, count(DISTINCT i + j) AS n_repeat_words FROM windows, range(8) t(j) WHERE n > 1 GROUP BY doc_id),
echoes AS (
  SELECT doc_id, count(*) AS n_echoes FROM (SELECT doc_id, words, unnest(range(1, len(words))) AS i FROM counted) WHERE words[i] = words[i + 1] GROUP BY doc_id),
measured AS (
  SELECT c.doc_id, n_words, word_chars, n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(n_lines, 0) AS n_lines, n_upper, coalesce(n_echoes, 0) AS n_echoes
  FROM counted c LEFT JOIN repeated r USING (doc_id) LEFT JOIN echoes e USING (doc_id) LEFT JOIN lines l USING (doc_id)),
judged AS (
  SELECT *, (CASE WHEN n_words < 20 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END)
         + (CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END) + (CASE WHEN n_lines >= 4 AND 100 * n_dup_lines > 30 * n_lines THEN 8 ELSE 0 END)
         + (CASE WHEN 100 * n_upper > 30 * word_chars THEN 16 ELSE 0 END) + (CASE WHEN 100 * n_echoes > 20 * n_words THEN 32 ELSE 0 END)
         + (CASE WHEN word_chars < 2 * n_words OR word_chars > 15 * n_words THEN 64 ELSE 0 END) AS failure_bits
  FROM measured)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, (failure_bits & 3) <> 0 AS base_failed, failure_bits = 0 AS kept, failure_bits::BIGINT AS failure_bits
FROM judged"""


@query
def quality_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every rule of the current policy: the documents that fail it, those that fail no other, and those that it alone would keep."""
    return quality_rules.ablation(quality_rules.ledger(table(spark, sf_dir, "documents"), ["doc_id"]))


_MASKS = ", ".join(f"('{r.name}', {r.mask})" for r in quality_rules.RULES if r.name in quality_rules.POLICIES[quality_rules.CURRENT])
ORACLES["quality_ablation"] = f"""
WITH judged AS ({ORACLES["op5_quality_rules"]})
SELECT rule, count(*) FILTER ((failure_bits & mask) <> 0) AS n_failed, count(*) FILTER (failure_bits = mask) AS n_failed_alone,
       count(*) FILTER ((failure_bits & mask) = 0) AS n_kept_if_only
FROM (VALUES {_MASKS}) rules(rule, mask) LEFT JOIN judged ON true GROUP BY rule"""


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of every page, without the lines that are boilerplate of its host."""
    pages = table(spark, sf_dir, "pages").select("page_id", url_host(F.col("url")).alias("host"), line_dedup.html_text(F.col("html")).alias("text"))
    clean = line_dedup.drop_boilerplate(written(pages, "page-text"), F.col("host"), dropped="n_dropped")
    return clean.select("page_id", "host", "n_dropped", "text")


ORACLES["op6_line_dedup"] = """
WITH texts AS (
  SELECT page_id, lower(regexp_extract(url, '^.*?://([^/?#]*)', 1)) AS host,
         regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(?:script|style)[^>]*>.*?</(?:script|style)>', '', 'g'),
           '(?i)</?(?:html|head|body|title|nav|header|footer|main|article|section|aside|div|p|ul|ol|li|h[1-6]|table|tr|td|th|br)(?:\\s[^>]*)?/?>', chr(10), 'g'),
           '<[^>]*>', '', 'g') AS text
  FROM pages),
lines AS (
  SELECT page_id, host, i, parts[i] AS line, trim(parts[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS trimmed
  FROM (SELECT page_id, host, parts, unnest(range(1, len(parts) + 1)) AS i FROM (SELECT page_id, host, string_split(text, chr(10)) AS parts FROM texts))),
totals AS (SELECT host, count(*) AS total FROM texts GROUP BY host),
frequent AS (
  SELECT host, trimmed FROM (SELECT host, trimmed, count(DISTINCT page_id) AS n FROM lines WHERE trimmed <> '' GROUP BY host, trimmed)
  JOIN totals USING (host) WHERE n >= 2 AND n > 0.1::DOUBLE * total),
marked AS (SELECT l.*, f.trimmed IS NOT NULL AS dropped FROM lines l LEFT JOIN frequent f USING (host, trimmed))
SELECT page_id, host, count(*) FILTER (dropped) AS n_dropped, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '') AS text
FROM marked GROUP BY page_id, host"""


@query
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; labels of held-out documents are never learned from."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    remainder = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3))
    labels = table(spark, sf_dir, "labels").filter(remainder != 1)
    model = quality_classifier.train(docs, labels, label="quality")
    scored = docs.select("doc_id", F.coalesce(remainder == 1, F.lit(False)).alias("held_out"), quality_classifier.score("text", model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query
def op8_unit_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stretches of every document that repeat a paragraph, line or long sentence of an earlier one, as ``start-end``
    in characters."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    told = unit_dedup.judged(docs, "doc_id", unit=unit_dedup.WHOLE, removed="spans").withColumn("n", F.length("text"))
    listed = F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["start"], s["end"])), ",")
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, s: total + s["end"] - s["start"])
    return told.select(
        "doc_id",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n_chars"),
        F.coalesce("n_units", F.lit(0)).alias("n_removed_units"),
        F.coalesce(removed, F.lit(0)).alias("n_removed_chars"),
        F.coalesce(listed, F.lit("")).alias("removed"),
    )


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: 3-word shingles, links at 3 differing bits or fewer."""
    found = simhash.groups(table(spark, sf_dir, "documents").select("doc_id", "text"), shingle=3, radius=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every credential candidate of every document with the forest's verdict; the candidate itself is masked, and the
    source stands for the path."""
    found = secret_scan.scan(table(spark, sf_dir, "documents"), secret_scan.labelled_findings(spark), path=F.col("source"))
    masked = F.concat(F.substring("candidate", 1, 4), F.lit("..."))
    return found.select("doc_id", "position", masked.alias("finding"), F.length("candidate").alias("n_chars"), "score", "is_secret")


@query
def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: counts and digest of the base spans, and all spans, disguised ones included."""
    found = table(spark, sf_dir, "documents").select("doc_id", pii.find(F.col("text")).alias("found"))
    told = F.transform("found", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    base = F.filter("found", lambda s: ~s["added"])
    counts = [F.expr(f"CAST(size(filter(found, s -> NOT s.added AND s.kind = '{kind}')) AS BIGINT) AS n_{kind}") for kind in pii.KINDS]
    base_told = F.array_join(F.transform(base, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select(
        "doc_id", *counts, F.sha2(base_told, 256).alias("base_sha256"), F.array_join(told, ",").alias("spans"),
        F.size(F.filter("found", lambda s: s["added"])).cast("bigint").alias("n_added"),
    )


@query
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 documents that match each benchmark item best."""
    return ranked_search.search(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), most=50)


ORACLES["op12_ranked_search"] = r"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS d, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
items AS (
  SELECT DISTINCT item_id, i, term FROM (
    SELECT item_id, row_number() OVER () AS i, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)),
lengths AS (SELECT d, any_value(doc_id) AS doc_id, count(*) AS n FROM docs GROUP BY d),
totals AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM lengths),
cells AS (SELECT d, term, count(*) AS tf FROM docs WHERE term IN (SELECT term FROM items) GROUP BY d, term),
weights AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM cells, totals GROUP BY term),
scores AS (
  SELECT item_id, i, d, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM items JOIN weights USING (term) JOIN cells USING (term) JOIN lengths USING (d), totals GROUP BY item_id, i, d, doc_id)
SELECT item_id, rank::INT AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0) WHERE rank <= 50"""


@query
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far every source is from the others of its language, and the terms that set it apart."""
    return divergence.audit(table(spark, sf_dir, "documents"))


ORACLES["op13_source_divergence"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
terms AS (SELECT d, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS of_all FROM terms GROUP BY lang, term HAVING count(DISTINCT d) >= 30),
counts AS (SELECT lang, source, term, count(*) AS n FROM terms JOIN kept USING (lang, term) GROUP BY ALL),
sources AS (
  SELECT g.lang, g.source, (SELECT count(*) FROM kept k WHERE k.lang = g.lang) AS v, coalesce((SELECT sum(n) FROM counts c WHERE c.lang = g.lang AND c.source = g.source), 0) AS total,
         coalesce((SELECT sum(of_all) FROM kept k WHERE k.lang = g.lang), 0) AS lang_total
  FROM (SELECT DISTINCT lang, source FROM docs) g),
shares AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (s.total + 5 * s.v) AS p, 1 + (1000000000::HUGEINT * (k.of_all + 5)) // (s.lang_total + 5 * s.v) AS q
  FROM sources s JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM ranked WHERE part = 'pair' OR rank <= 50"""
