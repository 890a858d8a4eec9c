"""Near duplicates by SimHash and covering locality-sensitive hashing.

Every text becomes a 64-bit fingerprint. Fingerprints within a bit distance are found through a family of bit
masks built so that for any two fingerprints within the radius some mask leaves out every differing bit: bit
``i`` carries a vector ``m(i)`` over {0, 1}, and the mask of ``v`` keeps the bits with odd ``<m(i), v>``. As many
differing bits as the radius span too little to leave no ``v`` that is orthogonal to all of them, so no pair is
missed. Only distinct fingerprints are compared. A crowded bucket is cut by masks over the bits its own mask
leaves out, which lose no pair for the same reason, until it is small or no bits are left.

Defined cases: a text without words (NULL, empty, only white space) has fingerprint 0, which links like any
other. Fewer words than a shingle make one shingle. Rows with equal ids share what is found for either. Rows
with a NULL id are grouped but never name a group. Extra columns pass through ``keep_one`` untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tessera.llm.common import fresh, same, written
from tessera.llm.components import components

BITS = 64
SEED = 42
SHINGLE = 3
RADIUS = 3
# Fingerprints in a bucket that are compared with each other directly; a bucket with more is cut first.
CROWDED = 1_024
_LEVELS = 3
_ALL = (1 << BITS) - 1


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bit ``i`` is set if it is set in more than half of the hashes of the word shingles, repeats included."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxh64_intdigest(b" ".join(words), SEED)]
    else:
        runs = zip(*(words[i:] for i in range(shingle)))
        hashes = [xxh64_intdigest(b" ".join(run), SEED) for run in runs]
    counts = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 1 << 15):
        block = np.array(hashes[start : start + (1 << 15)], "<u8")
        counts += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(text: str | Column, shingle: int = SHINGLE) -> Column:
    """Fingerprint of a text column as a signed 64-bit number."""

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    return F.pandas_udf(run, "bigint")(F.col(text) if isinstance(text, str) else text)


def covering_masks(radius: int, free: int = _ALL) -> list[int]:
    """Masks over the bits of ``free``: any ``radius`` of them are all left out by at least one mask."""
    bits = [i for i in range(BITS) if free >> i & 1]
    vectors = (1 << (radius + 1)) - 1
    return [sum(1 << b for k, b in enumerate(bits) if bin((k % vectors + 1) & v).count("1") % 2) for v in range(1, vectors + 1)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _longs(masks: list[int]) -> str:
    return f"array({', '.join('CAST(-9223372036854775808 AS BIGINT)' if m == 1 << (BITS - 1) else f'{_signed(m)}L' for m in masks)})"


def links(prints: DataFrame, radius: int = RADIUS, crowded: int = CROWDED) -> DataFrame:
    """Links ``a, b`` between the distinct fingerprints of ``prints(fp)``: at least a spanning set of all pairs
    within the radius."""
    keep = [covering_masks(radius)]
    rows = prints.selectExpr("fp", f"posexplode({_longs(keep[0])}) AS (path, mask)").selectExpr("fp", "path", "fp & mask AS key")
    paths = keep[0]
    found = None
    for level in range(_LEVELS):
        # Buckets of one fingerprint end here; the size of the others decides how they go on.
        rows = written(rows, "buckets")
        sizes = rows.groupBy("path", "key").agg(F.count("*").alias("n")).filter("n > 1")
        sizes = written(sizes, "bucket-sizes")
        last = level == _LEVELS - 1
        shared = rows.join(sizes if last else sizes.filter(F.col("n") <= crowded), ["path", "key"])
        near = _near(shared.select("path", "key", "fp"), radius)
        found = near if found is None else found.unionByName(near)
        if last or sizes.filter(F.col("n") > crowded).isEmpty():
            break
        finer = [covering_masks(radius, _ALL & ~p) for p in paths]
        table = ", ".join(_longs([p | m for m in masks]) for p, masks in zip(paths, finer))
        paths = [p | m for p, masks in zip(paths, finer) for m in masks]
        width = len(finer[0])
        rows = (
            rows.join(sizes.filter(F.col("n") > crowded), ["path", "key"])
            .selectExpr("fp", "path", f"posexplode(array({table})[path]) AS (step, mask)")
            .selectExpr("fp", f"path * {width} + step AS path", "fp & mask AS key")
        )
    return found.distinct()


def _near(members: DataFrame, radius: int) -> DataFrame:
    """Spanning links inside every bucket. Buckets arrive sorted, so a task holds some of them at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            block = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)])
            held.append(block)
            here = np.concatenate(held, axis=1)
            # The last bucket may go on in the next batch.
            open_ = (here[0] == here[0, -1]) & (here[1] == here[1, -1]) if here.shape[1] else np.zeros(0, bool)
            held = [here[:, open_]]
            if not open_.all():
                yield _spanning(here[:, ~open_], radius)
        if held and held[0].shape[1] > 1:
            yield _spanning(held[0], radius)

    ordered = members.repartition("path", "key").sortWithinPartitions("path", "key")
    return ordered.mapInArrow(run, "a bigint, b bigint")


def _spanning(block: np.ndarray, radius: int) -> pa.RecordBatch:
    path, key, prints = block
    starts = np.flatnonzero(np.r_[True, (path[1:] != path[:-1]) | (key[1:] != key[:-1])]) if len(path) else np.zeros(0, int)
    ends = np.repeat(np.r_[starts[1:], len(path)], np.diff(np.r_[starts, len(path)]))
    label = np.arange(len(path))
    at, shift = np.arange(len(path)), 1
    while True:
        at = at[at + shift < ends[at]]
        if not len(at):
            break
        near = at[np.bitwise_count((prints[at] ^ prints[at + shift]).view(np.uint64)) <= radius]
        if len(near):
            label = _merge(label, near, near + shift)
        shift += 1
    moved = np.flatnonzero(label != np.arange(len(path)))
    return pa.RecordBatch.from_arrays([pa.array(prints[moved]), pa.array(prints[label[moved]])], ["a", "b"])


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Joins the groups of ``a[i]`` and ``b[i]``; a group is named by its first member."""
    while True:
        x, y = label[a], label[b]
        if (x == y).all():
            return label
        low = np.minimum(x, y)
        np.minimum.at(label, x, low)
        np.minimum.at(label, y, low)
        while (label[label] != label).any():
            label = label[label]


def _rooted(narrow: DataFrame, radius: int) -> DataFrame:
    """``fp``, its ``root`` and the smallest id of the group, for every fingerprint of ``narrow(id, fp)``."""
    first = written(narrow.groupBy("fp").agg(F.min("id").alias("first")), "distinct-fingerprints")
    roots = components(links(first.select("fp"), radius))
    rooted = first.join(roots, first["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    rooted = written(rooted, "rooted")
    # Written, so that a root with very many fingerprints can be split in the join.
    least = written(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    return written(rooted.join(least, "root").select("fp", "root", "component_id"), "components")


def groups(docs: DataFrame, identifier: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per document: its id, its fingerprint ``fp``, and ``component_id``, the smallest id reachable."""
    narrow = written(docs.select(F.col(identifier).alias("id"), fingerprints(text, shingle).alias("fp")), "fingerprints")
    found = _rooted(narrow, radius).select("fp", "component_id")
    return narrow.join(found, "fp").select(F.col("id").alias(identifier), "fp", "component_id")


def keep_one(docs: DataFrame, identifier: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The document with the smallest id of each group, with the columns it came with.

    A NULL id comes after all others; among NULL ids the hash of the text decides. Of rows that share id and
    group one stays.
    """

    def name(df: DataFrame) -> Column:
        return F.struct(df[identifier].isNull().alias("missing"), F.coalesce(df[identifier], F.xxhash64(df[text])).alias("id"))

    narrow = written(docs.select(name(docs).alias("id"), fingerprints(text, shingle).alias("fp")), "fingerprints")
    found = _rooted(narrow, radius)
    chosen = narrow.join(found, "fp").filter(F.col("id") == F.col("component_id"))
    kept, rows, group = (fresh(c, docs) for c in ("__kept", "__rows", "__group"))
    # A name whose rows have several fingerprints may lie in several groups, also when it is kept in one only.
    several = narrow.groupBy("id").agg(F.count("*").alias(rows), F.min("fp").alias("low"), F.max("fp").alias("high"))
    several = several.filter(F.col(rows) > 1).select(F.col("id").alias(group), F.when(F.col("low") == F.col("high"), F.lit(1)).otherwise(F.col(rows)).alias("spread"))
    counted = chosen.groupBy(F.col("id").alias(kept)).agg(F.count("*").alias(rows))
    counted = counted.join(several.hint("merge"), F.col(kept) == F.col(group), "left")
    names = written(counted.select(kept, F.greatest(rows, "spread").alias(rows)), "kept")
    # Sorted and merged at every size: nothing bounds the number of documents that stay.
    once = docs.join(names.filter(F.col(rows) == 1).hint("merge"), name(docs) == F.col(kept), "left_semi")
    if names.filter(F.col(rows) > 1).isEmpty():
        return once
    again = docs.join(names.filter(F.col(rows) > 1), name(docs) == F.col(kept), "left_semi").withColumn(group, fingerprints(docs[text], shingle))
    roots = found.select(F.col("fp").alias(group), F.struct("root", "component_id").alias(kept))
    several = again.join(roots, group).withColumn(rows, F.struct(name(docs).alias("name"), F.col(f"{kept}.root").alias("root")))
    several = several.filter(F.col(f"{rows}.name") == F.col(f"{kept}.component_id")).dropDuplicates([rows])
    return once.unionByName(several.select(*[docs[c] for c in docs.columns]))
