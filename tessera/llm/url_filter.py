"""Judges URLs by host and path: listed rules first, else a logistic regression on character n-grams.

A rule fits a host, all its subdomains, and the paths that start with the rule's; of several the longest wins. A URL
without a rule is judged by a logistic regression on hashed character n-grams of host and path (parts are marked, so
the same letters count separately in either), trained from a small table of labelled URLs. All of it is JVM work:
SQL expressions cut and hash the n-grams, and Spark's own regression is fitted on at most ``MOST_LABELLED`` rows.

Defined cases: a URL that is NULL or has no ``://`` has empty host and path, fits no rule and has no n-grams, so the
intercept judges it. Repeated rows are judged alike. Labelled rows with NULL label or URL are left out; without both
kinds of label there is nothing to learn and everything without a rule is allowed. Extra columns pass through
``judge`` untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import fresh, url_host, url_path

GRAMS = (3, 4, 5)
FEATURES = 1 << 14
MOST_LABELLED = 10_000
REGULARISATION = 0.001


@dataclass(frozen=True)
class Rule:
    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0].lower()

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


def rule_for(host: str, path: str, rules: list[Rule]) -> Column:
    """``struct<rule, verdict>`` of the longest rule that fits the columns, NULL without any. The rules are a short
    list of the caller and travel inside the plan."""
    if not rules:
        return F.expr("CAST(NULL AS STRUCT<rule: STRING, verdict: STRING>)")
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text))

    def text(value: str) -> str:
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    listed = ", ".join(f"struct({text(r.host)} AS host, {text(r.path)} AS path, {text(r.text)} AS rule, {text(r.verdict)} AS verdict)" for r in ordered)
    fits = f"({host} = _r.host OR endswith({host}, concat('.', _r.host))) AND startswith({path}, _r.path)"
    return F.expr(f"get(filter(array({listed}), _r -> {fits}), 0)")


def grams(host: str, path: str) -> Column:
    """The n-grams of both parts, each part between marks of its own."""

    def cut(part: str, mark: str) -> str:
        # The characters are bound once by the outer transform, so long parts cost no more per n-gram than short ones.
        runs = [f"transform(sequence(1, greatest(size(_c) - {n - 1}, 1)), _i -> concat('{mark}', array_join(slice(_c, _i, {n}), '')))" for n in GRAMS]
        characters = f"split(concat('{mark}', {part}, '{mark}'), '')"
        return f"IF({part} = '', array(), flatten(transform(array({characters}), _c -> concat({', '.join(runs)}))))"

    return F.expr(f"concat({cut(host, '^')}, {cut(path, '$')})")


# Words that names of hosts are put together from, for the two labels.
_BAD = (
    "adserver adult affiliate baccarat bet betting bingo bonus cams cash casino cheats cialis clicks cracked crypto dating debt "
    "diet erotic escort fakes fetish forex gamble gambling hacks hentai hookup jackpot keygen lender loan loans lottery lotto "
    "meds milf naked payday payout pharma pharmacy phishing pills poker popunder porn prize replica roulette scam serials sex "
    "sexy slimming slots spam sportsbook steroids stream sweepstakes torrent tracker tube viagra virus wager warez webcam winner "
    "xxx"
)
_GOOD = (
    "academy aquarium archive association atlas bakery ballet bank biology books bridge cathedral chemistry cinema city climate "
    "clinic college cooking council county court dairy dentist engineering farmers festival fishing forest garden gazette geology "
    "history hospital hotel island journal kindergarten kitchen language law library lighthouse market mathematics meadow medical "
    "ministry museum music nature news observatory opera orchard parish philosophy photo physics poetry post publishing recipes "
    "research river rowing school science sculpture society stadium theatre theology times town travel university valley village "
    "weather wiki"
)
# Syllables of made-up names, which say nothing.
_SYLLABLES = "al an ar as at ce co de ed en er es ha he hi in is it ke la le li lo ma me mi na ne ng no nt on or ou pe ra re ri ro se st ta te th ti to ur ve"


def labelled_urls(spark: SparkSession) -> DataFrame:
    """A small labelled table made by rule: hosts of one word, of two words of one label, of a word and a made-up name,
    and made-up names (not to be blocked), below the usual prefixes and domains, with paths that tell nothing."""
    words = ", ".join(f"struct('{w}' AS word, {label}D AS label)" for label, listed in ((1, _BAD), (0, _GOOD)) for w in listed.split())
    every = spark.range(1).selectExpr(f"inline(array({words}))")
    syllables = "array(" + ", ".join(f"'{x}'" for x in _SYLLABLES.split()) + ")"
    size = len(_SYLLABLES.split())

    def made(seed: int) -> str:
        return "concat(" + ", ".join(f"element_at({syllables}, CAST(pmod(xxhash64(word, {seed + k}), {size}) + 1 AS INT))" for k in range(3)) + ")"

    listed = {label: "array(" + ", ".join(f"'{w}'" for w in text.split()) + ")" for label, text in ((1, _BAD), (0, _GOOD))}

    def other(k: int) -> str:
        return "IF(label = 1, " + ", ".join(f"element_at({listed[n]}, CAST(pmod(xxhash64(word, {k}), {len(text.split())}) + 1 AS INT))" for n, text in ((1, _BAD), (0, _GOOD))) + ")"

    def name(value: str, label: str = "label") -> str:
        return f"struct({value} AS name, {label} AS label)"

    forms = [name("word"), name(f"concat(word, '-', {other(1)})"), name(f"concat(word, {other(2)})")]
    forms += [name(f"concat({made(10)}, '-', word)"), name(f"concat(word, '-', {made(20)})"), name(f"concat({made(30)}, word)"), name(f"concat(word, {made(40)})")]
    forms += [name(made(50), "0D")]
    hosts = every.selectExpr("word", f"inline(array({', '.join(forms)}))").selectExpr("word", "name", "label", "explode(array('', 'www.', 'm.')) AS prefix")
    h = "pmod(xxhash64(name, prefix), 1000)"
    return hosts.selectExpr(
        f"concat('https://', prefix, name, '.', element_at(array('com', 'net', 'org'), CAST({h} % 3 + 1 AS INT)),"
        f" '/', element_at(array('en', 'fr', 'de', 'es'), CAST({h} % 4 + 1 AS INT)), '/', {h}, element_at(array('', '/', '.html'), CAST({h} % 3 + 1 AS INT))) AS url",
        "label",
    )


def judge(
    pages: DataFrame, rules: list[Rule], labelled: DataFrame, url: str = "url",
    names: tuple[str, str, str, str] = ("host", "path", "rule", "verdict"),
) -> DataFrame:
    """``pages`` with the host and path of ``url``, the rule that fits or NULL, and the verdict ``allow`` or ``block``.

    ``labelled`` has ``url`` and ``label`` (1: block). The output columns are called ``names``.
    """
    host, path, words, vector, fit, label = (fresh(c, pages, labelled) for c in ("__host", "__path", "__grams", "__vector", "__fit", "__label"))
    hashing = HashingTF(inputCol=words, outputCol=vector, numFeatures=FEATURES, binary=True)

    def prepared(df: DataFrame, column: str) -> DataFrame:
        parts = df.withColumns({host: url_host(F.col(column)), path: url_path(F.col(column))})
        return hashing.transform(parts.withColumn(words, grams(host, path)))

    known = labelled.select(F.col("url"), F.col("label").cast("double").alias(label)).dropna().orderBy("url").limit(MOST_LABELLED)
    kinds = known.agg(F.min(label), F.max(label)).first()
    judged = prepared(pages, url).withColumn(fit, rule_for(host, path, rules))
    score, raw, odds = (fresh(c, judged) for c in ("__score", "__raw", "__odds"))
    if kinds[0] is not None and kinds[0] < kinds[1]:
        learner = LogisticRegression(featuresCol=vector, labelCol=label, predictionCol=score, rawPredictionCol=raw, probabilityCol=odds, regParam=REGULARISATION, maxIter=100)
        judged = learner.fit(prepared(known, "url")).transform(judged)
    else:
        judged = judged.withColumn(score, F.lit(0.0))
    learned = F.when(F.col(score) == 1, "block").otherwise("allow")
    found = (F.col(host), F.col(path), F.col(f"{fit}.rule"), F.coalesce(F.col(f"{fit}.verdict"), learned))
    return judged.select(*[F.col(f"`{c}`") for c in pages.columns], *[c.alias(n) for c, n in zip(found, names)])
