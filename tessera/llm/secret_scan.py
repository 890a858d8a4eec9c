"""Finds credentials in texts and removes false positives with a random forest.

Candidates are runs of key characters, however many a word has: those of at least ``LEAST`` characters with a digit or
with a capital behind a small letter, and those of at least ``LEAST_ASSIGNED`` of any kind that follow ``=`` or ``:``. Each
is described by its length, the transitions between characters inside it, the share covered by dictionary words, the path
it comes from, the words around it and what its own word has next to it. Spark's own random forest, trained from
labelled findings, decides which candidates are secrets. All of it is SQL expressions and JVM work.

Defined cases: NULL and empty texts have no candidates. A NULL path is an empty one. Positions count words from 0, and
candidates of one word share its position; repeated rows give their findings once each. Labelled findings with NULL label or text are left out; without both
kinds of label every candidate counts as a secret. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import written

LEAST, LEAST_ASSIGNED = 12, 8
TREES, DEPTH, SEED = 40, 8, 7
MOST_LABELLED = 20_000
# Characters of the words before that a later run of a word keeps: they would be copied for every run of a long one.
CONTEXT = 200

_SPACE = r"[\x20\x09-\x0D]+"
_KEY = rf"[A-Za-z0-9_+/=.@-]{{{LEAST_ASSIGNED},}}"
_ODD = "[0-9]|[a-z][A-Z]"
_AFTER_ASSIGNMENT = "[=:][^A-Za-z0-9=:]*$"
_ASSIGNS = rf"^[A-Za-z][A-Za-z0-9_.-]*=[^=].{{{LEAST_ASSIGNED - 1},}}"
# Fixed values.
DICTIONARY = (
    "about access account admin agent alpha apple archive article auth before beta build cache change chapter city client code color "
    "com commit computer config content copy cover data date day default demo dev document dummy edition email event example false file "
    "first for free from game guest hello here home host house http image index info item key last letter library light line link list "
    "local login mail main master message model month music name network news note number object office online order org page paper part "
    "pass password path people phone photo picture place point post press price print private product profile project public query "
    "readme record release report request result review right sample school script search second secret section server service session "
    "set share shop site small source start state station store story street string student study system table team test text the time "
    "title token topic town track travel true update url user value version video view water web week welcome work world write year your"
).split()
_HINT = r"(?i)(token|secret|passw|api.?key|apikey|\bkey\b|credential|bearer|auth)"
_NAMED = r"(?i)^[a-z_]*(token|secret|passw|key)[a-z_]*[=:]"
_DECOY = r"(?i)(commit|sha|md5|checksum|digest|uuid|example|sample|placeholder|mail|phone|isbn|call|version)"
_TEST_PATH = r"(?i)(^|[/._-])(tests?|examples?|samples?|docs?|mocks?|fixtures?)([/._-]|$)"

FEATURES = (
    "n_chars", "transitions", "case_changes", "digits", "capitals", "distinct", "vowels", "consonants", "dictionary", "longest_letters", "hex", "dots", "slashes", "dashes", "at",
    "quoted", "assigned", "hint_before", "decoy_near", "test_path",
)


def candidates(docs: DataFrame, identifier: str = "doc_id", text: str = "text", path: Column | None = None) -> DataFrame:
    """``id, path, position, candidate, word, before, after`` for every candidate: ``word`` is the run with what stands
    between it and its neighbours in the word, ``before`` ends with what precedes the run in the word, from the run
    before it on."""
    own = docs.select(F.col(identifier).alias("id"), F.coalesce(path if path is not None else F.lit(""), F.lit("")).cast("string").alias("path"), F.col(text).alias("text"))
    # Bound once per text by the outer transform, so the text is cut once.
    picked = (
        f"filter(sequence(0, size(_w) - 1), _i -> length(_w[_i]) >= {LEAST_ASSIGNED} AND "
        f"(_w[_i] RLIKE '{_ODD}|[=:]' OR coalesce(get(_w, _i - 1) RLIKE '{_AFTER_ASSIGNMENT}', false)))"
    )
    around = (
        "struct(_i AS position, _w[_i] AS word, concat_ws(' ', get(_w, _i - 3), get(_w, _i - 2), get(_w, _i - 1)) AS before, coalesce(get(_w, _i + 1), '') AS after)"
    )
    cut = f"split(text, '{_SPACE}')".replace("\\", "\\\\")
    # White space at an end would make an empty word.
    cut = f"filter({cut}, _x -> _x <> '')"
    words = own.filter(F.col("text").rlike(f"{_ODD}|[=:]")).selectExpr("id", "path", f"inline(flatten(transform(array({cut}), _w -> transform({picked}, _i -> {around}))))")
    # The gaps of a word are what its runs leave: one before each run and one behind the last.
    cuts = words.selectExpr("id", "path", "position", "before", "after", f"regexp_extract_all(word, '{_KEY}', 0) AS runs", f"split(word, '{_KEY}', -1) AS gaps")
    parts = (
        "struct(_r AS candidate, concat(gaps[_k], _r, gaps[_k + 1]) AS word, "
        f"concat_ws(' ', nullif(IF(_k = 0, before, right(before, {CONTEXT})), ''), nullif(concat(coalesce(get(runs, _k - 1), ''), gaps[_k]), '')) AS before, "
        "IF(_k = size(runs) - 1, after, '') AS after)"
    )
    # What follows the scheme of a URL is not assigned by its colon.
    meant = (
        f"length(_c.candidate) >= {LEAST} AND _c.candidate RLIKE '{_ODD}' OR _c.candidate RLIKE '{_ASSIGNS}' "
        f"OR _c.before RLIKE '{_AFTER_ASSIGNMENT}' AND NOT startswith(_c.candidate, '//')"
    )
    return cuts.selectExpr("id", "path", "position", f"inline(filter(transform(runs, (_r, _k) -> {parts}), _c -> {meant}))")


def features(found: DataFrame) -> DataFrame:
    """The candidates with one number per entry of ``FEATURES``."""
    c, size = F.col("candidate"), F.length("candidate")

    def share(kept: str) -> Column:
        return F.length(F.regexp_replace(c, f"[^{kept}]", "")) / size

    words = "|".join(sorted(DICTIONARY, key=lambda w: (-len(w), w)))
    # One character per run of a class: letters, digits, others.
    runs = F.length(F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(c), "[a-z]+", "a"), "[0-9]+", "0"), "[^a0]+", "-"))
    letters = F.array_max(F.transform(F.split(F.lower(c), "[^a-z]+"), F.length))
    consonants = F.array_max(F.transform(F.split(F.lower(c), "[^b-df-hj-np-tv-xz]+"), F.length))
    all_letters = F.length(F.regexp_replace(F.lower(c), "[^a-z]", ""))
    values = {
        "n_chars": size,
        "transitions": (runs - 1) / size,
        "case_changes": F.regexp_count(c, F.lit("[a-z][A-Z]")) / size,
        "digits": share("0-9"),
        "capitals": share("A-Z"),
        "distinct": F.size(F.array_distinct(F.split(c, ""))) / size,
        "vowels": F.length(F.regexp_replace(F.lower(c), "[^aeiouy]", "")) / F.greatest(all_letters, F.lit(1)),
        "consonants": consonants,
        "dictionary": 1 - F.length(F.regexp_replace(F.lower(c), f"({words})", "")) / size,
        "longest_letters": letters / size,
        "hex": c.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"),
        "dots": share(".") * size,
        "slashes": share("/") * size,
        "dashes": share("_-") * size,
        "at": c.contains("@"),
        "quoted": F.col("word").rlike("[\"'`]"),
        "assigned": F.col("before").rlike(_AFTER_ASSIGNMENT) | F.col("word").rlike("^[A-Za-z_]+[=:]") | c.rlike("^[A-Za-z_]+="),
        "hint_before": F.col("before").rlike(_HINT) | F.col("word").rlike(_NAMED) | c.rlike(_NAMED),
        "decoy_near": F.concat_ws(" ", "before", "after").rlike(_DECOY),
        "test_path": F.col("path").rlike(_TEST_PATH),
    }
    return found.withColumns({name: values[name].cast("double") for name in FEATURES})


_NAMES = "token secret password passwd api_key apiKey access_key auth_token client_secret credential private_key signing_key DB_PASSWORD API_TOKEN".split()
_DECOYS = "commit sha256 md5 checksum digest uuid revision etag blob parent".split()
_NEUTRAL = "see from read called with note value file page number name build".split()


def labelled_findings(spark: SparkSession, n: int = 6_000) -> DataFrame:
    """About ``n`` labelled findings made by rule, as ``candidates`` finds them in made-up lines.

    A line is a name, a sign of assignment and a value, each drawn by hashes of its number. Values are random characters of
    eight alphabets and many lengths, words put together in five ways, or numbers of seven kinds. Random values are
    secrets behind a name of credentials, unless the path is one of tests, and those that start with a public prefix
    of keys are everywhere; random values behind names of hashes, and all words and numbers, are not.
    """

    def drawn(seed: int, most: int) -> str:
        return f"pmod(hash(id, {seed}), {most})"

    def one_of(seed: int, values: list[str]) -> str:
        listed = ", ".join("'" + v.replace("'", "\\'") + "'" for v in values)
        return f"get(array({listed}), {drawn(seed, len(values))})"

    def syllable(seed: int) -> str:
        return f"concat({one_of(seed, list('bcdfghklmnprstvw'))}, {one_of(seed + 1, list('aeiou'))}, {one_of(seed + 2, ['', '', 'n', 'r', 's', 't', 'l'])})"

    hexa = "sha2(CAST(id AS STRING), 256)"
    parts = {
        "hexa": hexa,
        "mixed": "translate(b, '+/=', 'xQ7')",
        "letters": "translate(b, '0123456789+/=', 'qwxzvkjtbnmpd')",
        "known": f"get(d, {drawn(11, len(DICTIONARY))})",
        "other": f"get(d, {drawn(12, len(DICTIONARY))})",
        "made": f"concat({syllable(20)}, {syllable(30)}, {syllable(40)})",
    }
    random = [
        f"substr(hexa, 1, 20 + {drawn(1, 45)})",
        f"upper(substr(hexa, 1, 20 + {drawn(2, 45)}))",
        f"substr(b, 1, 20 + {drawn(3, 24)})",
        f"substr(mixed, 1, 14 + {drawn(4, 28)})",
        f"upper(substr(mixed, 1, 14 + {drawn(5, 28)}))",
        f"substr(mixed, 1, 8 + {drawn(6, 6)})",
        f"substr(letters, 1, 12 + {drawn(7, 28)})",
        f"lower(substr(letters, 1, 12 + {drawn(8, 28)}))",
    ]
    # Public prefixes of keys.
    prefixed = f"concat({one_of(9, ['ghp_', 'sk_live_', 'xoxb-', 'glpat-', 'AKIA'])}, substr(mixed, 1, 16 + {drawn(10, 24)}))"
    words = [
        f"concat_ws({one_of(13, ['-', '_', '.', '/'])}, known, made, other)",
        f"concat_ws({one_of(14, ['-', '_'])}, made, known, {drawn(15, 1000)})",
        f"concat(made, initcap(known), initcap(other))",
        f"concat(made, {syllable(50)})",
        f"repeat({one_of(16, ['x', '0', '*-', 'abc', '123', 'X', '_.'])}, 12 + {drawn(17, 8)})",
    ]
    numbers = [
        f"CAST(4000000000000000L + pmod(xxhash64(id, 61), 999999999999999L) AS STRING)",
        f"concat(1 + {drawn(62, 200)}, '.', {drawn(63, 250)}, '.', {drawn(64, 250)}, '.', {drawn(65, 250)})",
        f"concat(made, '.', {drawn(66, 99)}, '@', known, '.example.com')",
        f"concat('20', 10 + {drawn(67, 20)}, '-0', 1 + {drawn(68, 9)}, '-1', {drawn(69, 9)}, 'T1', {drawn(70, 9)}, ':30')",
        f"concat(known, {drawn(71, 40)}, '/', made, '-', {drawn(72, 30)}, '/', other, '.html')",
        f"concat('v', {drawn(73, 9)}, '.', {drawn(74, 99)}, '.', {drawn(75, 999)}, '-', known, {drawn(76, 99)})",
        f"concat('+', 1 + {drawn(77, 90)}, '-555-', 1000 + {drawn(78, 9000)}, '-', 10 + {drawn(79, 90)})",
    ]
    # Kind of name, value, label. Random values behind names of credentials come three times.
    cases = [("hint", v, 1, i) for v in [*random, prefixed] for i in range(3)]
    cases += [("decoy", v, 0, 0) for v in random] + [("neutral", prefixed, 1, 0)] + [("neutral", v, 0, 0) for v in random[:2]]
    cases += [(kind, v, 0, i) for v in [*words, *numbers] for kind in ("hint", "neutral") for i in range(2)]
    names = {"hint": one_of(80, _NAMES), "decoy": one_of(81, _DECOYS), "neutral": one_of(82, _NEUTRAL)}
    opened = ["%s = \"", "%s: \"", "%s=\"", "%s : ", "%s is ", "%s=", "\"%s\":\"", "%s ", "the %s: `", "%s := "]
    lines = ", ".join(
        f"struct({v} AS planted, replace({one_of(83 + i, opened)}, '%s', {names[kind]}) AS opening, {label} AS good)" for kind, v, label, i in cases
    )
    tests = one_of(91, ["tests/data.txt", "docs/sample.md", "app/fixtures/one.json"])
    folder = one_of(90, ["src/app.py", "conf/service.yaml", "notes.txt", "", "web", "deploy/run.sh"])
    around = f"get(d, {drawn(92, len(DICTIONARY))})"
    after = one_of(93, ["and", "in", "", ";", "for the", "# set", "then"])
    # Every line draws by a number of its own.
    made_up = (
        spark.range(max(1, n // len(cases)) * len(cases))
        .selectExpr("id", f"base64(unhex({hexa})) AS b", f"split('{' '.join(DICTIONARY)}', ' ') AS d")
        .selectExpr("id", "b", "d", *[f"{v} AS {c}" for c, v in parts.items()])
        .selectExpr("id", f"get(array({lines}), CAST(id % {len(cases)} AS INT)) AS drawn", f"{around} AS around", f"{after} AS after", f"IF(pmod(id, 9) = 0, {tests}, {folder}) AS path")
        .selectExpr("id", "drawn.planted", "path", "drawn.good", "concat_ws(' ', around, concat(drawn.opening, drawn.planted, regexp_extract(drawn.opening, '[\"`]*$', 0)), after) AS line")
        .selectExpr("id", "planted", "path", "line", f"IF(path RLIKE '{_TEST_PATH}', 0D, CAST(good AS DOUBLE)) AS label")
    )
    # Written: the planner would put what is drawn into every expression that reads it.
    made_up = written(made_up, "labelled-findings")
    found = candidates(made_up, "id", "line", F.col("path"))
    return found.join(made_up.select("id", "planted", "label"), "id").filter("contains(candidate, planted)").drop("planted")


def scan(docs: DataFrame, findings: DataFrame, identifier: str = "doc_id", text: str = "text", path: Column | None = None) -> DataFrame:
    """``identifier, position, candidate, score, is_secret`` of every candidate in ``docs``.

    ``findings`` are ``candidates`` with a ``label``, like ``labelled_findings``; at most ``MOST_LABELLED`` rows of them
    are learned from.
    """
    known = findings.filter("label IS NOT NULL AND candidate <> ''").orderBy(F.xxhash64("word", "before"), "word", "before", "path", "label").limit(MOST_LABELLED)
    kinds = known.agg(F.min("label"), F.max("label")).first()
    found = features(candidates(docs, identifier, text, path))
    if kinds[0] is None or kinds[0] == kinds[1]:
        scored = found.withColumn("score", F.lit(1.0))
    else:
        assemble = VectorAssembler(inputCols=list(FEATURES), outputCol="vector")
        forest = RandomForestClassifier(featuresCol="vector", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED).fit(assemble.transform(features(known)))
        scored = forest.transform(assemble.transform(found)).withColumn("score", vector_to_array("probability")[1])
    return scored.select(F.col("id").alias(identifier), "position", "candidate", "score", (F.col("score") >= 0.5).alias("is_secret"))
