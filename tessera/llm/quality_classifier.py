"""Quality by the votes of similar labelled documents.

Texts become latent-semantic vectors. Their terms are words, hashed to ``WORDS`` places, and runs of three character
classes, by which words of any language look alike. Counts are log-scaled and weighted by inverse document frequency
over all documents; words and runs weigh the same in every text. The result is projected to the leading singular
vectors of the labelled documents. The labelled vectors are broadcast; their number is bounded by ``MOST_LABELLED``
and their width by ``RANK``. For every document the cosine with all labelled ones is computed in blocks, and the
labels of the ``NEIGHBOURS`` nearest are averaged, weighted by similarity.

The labelled sample is drawn by a hash of the id, half of it from each class where there are enough rows. It reaches
the driver as term counts, never as texts, and so does one document frequency per term. Every text is read twice:
for the frequencies, and for its score.

Defined cases: a NULL or empty text has no terms; its vector is zero, is equally far from all, and its score is the
mean label of the sample. Repeated rows are scored alike; of several labels of an id the largest counts, and of several
texts the first in order. Labels that are NULL or belong to no document are left out. Without labelled documents every score is 0.5. Only the id, text and
label columns are read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_LABELLED = 2_000
RANK = 48
NEIGHBOURS = 25
SHARPNESS = 8
# Character classes: lower case, upper case, digits, bytes above 127, each character of _OWN by itself, all others.
_OWN = b" \n.,|#*$%&!"
_CLASSES = 16
_SHAPES = _CLASSES**3
# Behind the shapes: words without ASCII upper case, by their checksum.
WORDS = 1 << 12
TERMS = _SHAPES + WORDS
_BLOCK = 1_024
_CHUNK = 1 << 20


def _classes() -> np.ndarray:
    table = np.full(256, _CLASSES - 1, np.int32)
    for k, (low, high) in enumerate((("a", "z"), ("A", "Z"), ("0", "9"))):
        table[ord(low) : ord(high) + 1] = k
    table[128:] = 3
    for k, byte in enumerate(_OWN):
        table[byte] = 4 + k
    return table


_CLASS_OF = _classes()


def term_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Terms of a text in order, and how often it has each."""
    data = text.encode("utf-8", "surrogatepass") if text else b""
    counts = np.zeros(TERMS, np.int64)
    for start in range(0, max(len(data) - 2, 0), _CHUNK):
        shape = _CLASS_OF[np.frombuffer(data[start : start + _CHUNK + 2], np.uint8)]
        counts[:_SHAPES] += np.bincount((shape[:-2] * _CLASSES + shape[1:-1]) * _CLASSES + shape[2:], minlength=_SHAPES)
    for word, times in Counter(data.lower().split()).items():
        counts[_SHAPES + zlib.crc32(word) % WORDS] += times
    terms = np.flatnonzero(counts)
    return terms, counts[terms]


@dataclass
class Model:
    """Labelled vectors of length 1 with their labels, and what maps term counts to such vectors."""

    columns: np.ndarray  # place of a term in ``weights``, -1 for unknown ones
    weights: np.ndarray  # term by RANK: inverse document frequency and projection in one
    vectors: np.ndarray
    labels: np.ndarray

    @staticmethod
    def fit(samples: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, having: np.ndarray, n_docs: int, rank: int = RANK) -> Model | None:
        """Singular vectors from the Gram matrix of the samples, so the work is bounded by their number. ``having``
        counts the documents with a term, of ``n_docs`` documents."""
        labels = np.asarray(labels, float)
        known = [t for t, _ in samples if len(t)]
        if not known:
            return None
        used = np.unique(np.concatenate(known))
        columns = np.full(TERMS, -1, np.int64)
        columns[used] = np.arange(len(used))
        inverse = np.log((1 + n_docs) / (1 + having[used])) + 1
        model = Model(columns, inverse[:, None], np.zeros((0, 0)), labels)
        matrix = np.zeros((len(samples), len(used)), np.float32)
        for row, sample in zip(matrix, samples):
            at, value = model.scaled(sample)
            row[at] = value * inverse[at]
            row /= np.linalg.norm(row) or 1
        values, left = np.linalg.eigh((matrix @ matrix.T).astype(float))
        keep = np.argsort(values)[::-1][:rank]
        keep = keep[values[keep] > 1e-6 * max(values.max(), 1e-12)]
        model.weights = (inverse[:, None] * (matrix.T @ left[:, keep]) / np.sqrt(values[keep])).astype(np.float32)
        model.vectors = np.stack([model.vector(s) for s in samples])
        return model

    def scaled(self, counts: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Columns of the known terms, and their scaled counts; those of words and those of runs have length 1."""
        at = self.columns[counts[0]]
        known = at >= 0
        value, split = np.log1p(counts[1][known]), np.searchsorted(counts[0][known], _SHAPES)
        for part in (value[:split], value[split:]):
            part /= np.linalg.norm(part) or 1
        return at[known], value

    def vector(self, counts: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        at, value = self.scaled(counts)
        found = value.astype(np.float32) @ self.weights[at]
        return found / (np.linalg.norm(found) or 1)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        result = np.zeros(len(texts))
        near = min(NEIGHBOURS, len(self.labels))
        for start in range(0, len(texts), _BLOCK):
            block = texts[start : start + _BLOCK]
            cosine = np.stack([self.vector(term_counts(t)) for t in block]) @ self.vectors.T
            nearest = np.argpartition(-cosine, near - 1, axis=1)[:, :near]
            weight = np.clip(np.take_along_axis(cosine, nearest, 1), 0, 1).astype(float) ** SHARPNESS
            total = weight.sum(1)
            votes = (weight * self.labels[nearest]).sum(1) / np.where(total > 0, total, 1)
            result[start : start + len(block)] = np.where(total > 0, votes, self.labels.mean())
        return np.clip(result, 0, 1)


def frequencies(docs: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """How many documents have each term, and the number of documents. Every task adds up its own texts first."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, rows = np.zeros(TERMS + 1, np.int64), 0
        for batch in batches:
            for value in batch["text"]:
                total[term_counts(value)[0]] += 1
            rows += len(batch)
        total[TERMS] = rows
        terms = np.flatnonzero(total)
        yield pd.DataFrame({"term": terms, "n": total[terms]})

    counted = docs.select(F.col(text).alias("text")).mapInPandas(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    having = np.zeros(TERMS + 1, np.int64)
    for row in counted.collect():
        having[row.term] = row.n
    return having[:TERMS], int(having[TERMS])


def labelled_sample(docs: DataFrame, labels: DataFrame, identifier: str, text: str, label: str, most: int = MOST_LABELLED) -> list:
    """At most ``most`` rows of ``(label, terms, counts)``, half of each class where there are enough."""
    marks = labels.groupBy(F.col(identifier).alias("id")).agg(F.max(label).cast("int").alias("label")).filter("id IS NOT NULL AND label IN (0, 1)")
    own = docs.select(F.col(identifier).alias("own"), F.col(text).alias("text"))
    both = [marks.filter(F.col("label") == k).orderBy(F.xxhash64("id"), "id").limit(most // 2) for k in (0, 1)]
    chosen = own.join(both[0].unionByName(both[1]), F.col("own") == F.col("id")).groupBy("id", "label").agg(F.min("text").alias("text"))

    def count(texts: pd.Series) -> pd.DataFrame:
        found = [term_counts(t) for t in texts]
        return pd.DataFrame({"terms": [t for t, _ in found], "counts": [c for _, c in found]})

    counted = F.pandas_udf(count, "terms array<bigint>, counts array<bigint>")("text")
    return chosen.select("id", "label", counted.alias("c")).select("id", "label", "c.terms", "c.counts").orderBy("id").collect()


def train(docs: DataFrame, labels: DataFrame, identifier: str = "doc_id", text: str = "text", label: str = "quality") -> Model | None:
    rows = labelled_sample(docs, labels, identifier, text, label)
    if not rows:
        return None
    samples = [(np.array(r.terms, np.int64), np.array(r.counts, np.int64)) for r in rows]
    return Model.fit(samples, np.array([r.label for r in rows]), *frequencies(docs, text))


def score(text: str | Column, model: Model | None) -> Column:
    """Score of a text column from 0 to 1, higher where label 1 is likelier."""
    if model is None:
        return F.lit(0.5)

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(list(texts)))

    return F.pandas_udf(run, "double")(F.col(text) if isinstance(text, str) else text)
