"""Quality rules as a ledger of failure bits.

Every text is read once: one pass takes the measurements and sets one bit for every rule that fails.
A policy is a named, versioned set of rules, that is a bit mask; whether a document stays under a policy, and
what each rule contributes to it, follow from the bits alone, without reading texts again.

Defined cases: a NULL text has no words and fails like an empty one. Rows are judged one by one, so repeated
rows and repeated or NULL ids keep their own verdicts. Very long texts are measured whole. Extra columns pass
through untouched, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import fresh

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_SPACE = " \t\n\v\f\r"

MEASURES = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, n_lines bigint, n_upper bigint, n_echoes bigint"
_FIELDS = tuple(m.split()[0] for m in MEASURES.split(", "))


@dataclass(frozen=True)
class Rule:
    """``failed`` is a SQL condition on the measurements. A rule never changes its bit."""

    bit: int
    name: str
    failed: str

    @property
    def mask(self) -> int:
        return 1 << self.bit


RULES = (
    Rule(0, "too_few_words", "n_words < 20"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > n_words"),
    Rule(3, "repeated_lines", "n_lines >= 4 AND 100 * n_dup_lines > 30 * n_lines"),
    Rule(4, "capitals", "100 * n_upper > 30 * word_chars"),
    Rule(5, "echoed_words", "100 * n_echoes > 20 * n_words"),
    Rule(6, "word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
)

POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("too_few_words", "repeated_windows"),
    "2025-1": ("too_few_words", "repeated_windows", "symbols", "capitals"),
    "2025-2": tuple(r.name for r in RULES),
}
CURRENT = "2025-2"


def policy_mask(policy: str) -> int:
    wanted = set(POLICIES[policy])
    return sum(r.mask for r in RULES if r.name in wanted)


def _repeated_words(words: list[bytes]) -> int:
    """Positions inside an 8-word window that the text has at least twice."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.uint64, len(words))
    # Cheap test first: if no two hashes agree, no two windows do.
    mixed, step = (ids + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15), 1
    while step < WINDOW:
        mixed = (mixed[:-step] * np.uint64(0xD6E8FEB86659FD93)) ^ (mixed[step:] + (mixed[step:] >> np.uint64(29)))
        step *= 2
    ordered = np.sort(mixed)
    if not (ordered[1:] == ordered[:-1]).any():
        return 0
    # Exact: names of 2, 4 and 8 words, each a pair of the names before.
    names, step = ids.astype(np.int64), 1
    while step < WINDOW:
        pairs = names[:-step] * (len(words) + 1) + names[step:]
        names, step = np.unique(pairs, return_inverse=True)[1], step * 2
    repeated = np.bincount(names)[names] > 1
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:-WINDOW] += repeated
    edges[WINDOW:] -= repeated
    return int((np.cumsum(edges) > 0).sum())


def measure(text: str | None) -> tuple[int, ...]:
    if not text:
        return (0,) * len(_FIELDS)
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text) - sum(text.count(c) for c in _SPACE),
        len(data) - len(data.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        _repeated_words(words),
        len(lines),
        len(data) - len(data.translate(None, _UPPER)),
        sum(a == b for a, b in zip(words, words[1:])),
    )


def _measure_all(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([measure(t) for t in texts], columns=list(_FIELDS), dtype="int64")


def measurements(text: str | Column) -> Column:
    """Struct of the measurements of one text column."""
    column = F.col(text) if isinstance(text, str) else text
    return F.pandas_udf(_measure_all, MEASURES)(column)


def failure_bits(measured: str = "") -> Column:
    """The ledger entry: one bit per failed rule. ``measured`` is the struct of the measurements; without it
    they are columns."""
    owner = f"{measured}." if measured else ""
    bits = " | ".join(f"IF({r.failed}, {r.mask}L, 0L)" for r in RULES)
    return F.expr(re.sub("|".join(rf"\b{f}\b" for f in _FIELDS), lambda m: owner + m[0], bits))


def ledger(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Keys, measurements and failure bits of every row."""
    measured = docs.select(*keys, measurements(text).alias("__m")).select(*keys, "__m.*")
    return measured.withColumn("failure_bits", failure_bits())


def kept_by(policy: str, bits: str = "failure_bits") -> Column:
    return F.col(bits).bitwiseAND(F.lit(policy_mask(policy))) == 0


def filter_documents(docs: DataFrame, policy: str = CURRENT, text: str = "text") -> DataFrame:
    """The rows that a policy keeps, with the columns they came with."""
    name = fresh("__measured", docs)
    measured = docs.withColumn(name, measurements(text))
    return measured.filter(failure_bits(name).bitwiseAND(F.lit(policy_mask(policy))) == 0).drop(name)


def ablation(entries: DataFrame, policy: str = CURRENT, bits: str = "failure_bits") -> DataFrame:
    """For every rule of a policy: the documents that fail it, those that fail no other rule of the policy
    (dropping the rule brings them back), and those that the rule alone would keep.

    The ledger is first counted by its bits, so at most one row per combination of rules goes on.
    """
    mask = policy_mask(policy)
    counts = entries.groupBy(F.col(bits).bitwiseAND(F.lit(mask)).alias("bits")).agg(F.count("*").alias("n"))
    rules = [r for r in RULES if r.mask & mask]
    sums: list[Callable[[Rule], Column]] = [
        lambda r: F.sum(F.expr(f"IF(bits & {r.mask} <> 0, n, 0L)")),
        lambda r: F.sum(F.expr(f"IF(bits = {r.mask}, n, 0L)")),
        lambda r: F.sum(F.expr(f"IF(bits & {r.mask} = 0, n, 0L)")),
    ]
    one = counts.agg(*[f(r).alias(f"{k}{r.bit}") for r in rules for k, f in zip("fsk", sums)])
    rows = ", ".join(f"struct('{r.name}' AS rule, f{r.bit} AS n_failed, s{r.bit} AS n_failed_alone, k{r.bit} AS n_kept_if_only)" for r in rules)
    return one.selectExpr(f"inline(array({rows}))").selectExpr("rule", *[f"coalesce({c}, 0L) AS {c}" for c in ("n_failed", "n_failed_alone", "n_kept_if_only")])
