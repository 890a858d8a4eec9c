"""Removes every byte covered by a string of ``WIDTH`` bytes that also starts in an earlier document.

Equal strings are found by an induced suffix sort, carried out in shards that no equal strings straddle.

* Anchors. Of the ``ANCHOR``-byte strings inside a window of ``WIDTH`` bytes the one with the smallest hash is its
  anchor, so equal windows have equal anchors at equal places. Neighbouring windows mostly share one, and such a run
  of windows travels as one fragment: the bytes to the left and right of the anchor that its windows cover.
* Recurring anchors. Anchors are first counted by their hashes alone; a window whose anchor occurs in one document
  only cannot be in another. Only fragments with recurring anchors go on. Anchors wait in queues by hash, which are
  judged one after the other; the number of parts grows with the bytes of the corpus.
* Induced sort. A shard holds all fragments whose anchors hash to it. The suffixes that start at the anchors are
  sorted with their common prefixes. Every further step moves one byte to the left: reading the tuples in order and
  appending each to the queue of the byte before it yields the order of the suffixes one byte longer, and a common
  prefix becomes one more than the least common prefix passed on the way. Where it reaches ``WIDTH``, windows are
  equal, and all but those of the smallest document are removed. The queues of a step share ``QUEUE_BYTES`` and go
  to disk beyond, and the first sort merges sorted runs from disk through a heap, so a shard may be far larger than memory.

Equal fragments of one batch are reduced to the earliest document before they are shuffled (the others are covered
by it), which keeps passages that very many documents share small. An anchor with more than one fragment in
``HOT_SHARE`` has its windows dealt out one by one; there are at most ``HOT_SHARE`` such anchors.

Defined cases: texts are their UTF-8 bytes, NULL is empty. Windows never cross documents. A NULL id ranks after
all others. Rows with equal ids are one document for the question which is earlier, so they do not remove from each
other, but each row keeps its own bytes. Extra columns pass through ``remove`` untouched.
"""

from __future__ import annotations

import hashlib
import heapq
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import fresh, same, written

WIDTH = 50
ANCHOR = 20
LEFT = WIDTH - ANCHOR  # bytes of a window before its anchor, at most
HOT_SHARE = 10_000
HOT_LEAST = 20_000
QUEUE_BYTES = 64 << 20
RUN_FRAGMENTS = 400_000
# Bytes of text that a part stands for at most; there are more parts than shuffle partitions if the corpus needs them.
PART_BYTES = 64 << 20
# Beyond, parts grow instead (they spill): every batch sends something to every part.
MOST_PARTS = 4_096
_BUCKETS = 16
_SEGMENT = 1 << 20
_PLACE = np.uint64((1 << 21) - 1)
_SLICE = 50_000
_LAST = np.iinfo(np.int64).max
_MIX = np.random.default_rng(42).integers(1, 1 << 63, size=(2, WIDTH + LEFT + 2), dtype=np.uint64) | np.uint64(1)

#: A suffix in a queue: the bytes before its anchor (nearest first), how many of them its fragment has, its document
#: and row, where the fragment starts, which of its windows go, and its common prefix with the suffix before it.
SUFFIX = np.dtype([("left", "u1", LEFT), ("lead", "u1"), ("rank", "<i8"), ("row", "<i8"), ("start", "<i8"), ("gone", "<u4"), ("common", "u1")])


# Bytes and blobs ------------------------------------------------------------------------------


def _buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column, and where each row starts, with the end behind."""
    column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _numbers(column: pa.Array, null: int) -> np.ndarray:
    return pc.fill_null(column.cast(pa.int64()), null).to_numpy(zero_copy_only=False)


def _pack(*arrays: np.ndarray) -> bytes:
    raw = b"".join(len(a).to_bytes(8, "little") + a.tobytes() for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _unpack(blob: bytes, *kinds: str) -> list[np.ndarray]:
    raw, at, arrays = zstandard.ZstdDecompressor().decompress(blob), 0, []
    for kind in kinds:
        n = int.from_bytes(raw[at : at + 8], "little")
        arrays.append(np.frombuffer(raw, kind, n, at + 8))
        at += 8 + arrays[-1].nbytes
    return arrays


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one range after the other."""
    return np.arange(counts.sum()) + np.repeat(starts - (np.cumsum(counts) - counts), counts)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(29))


# Queues ---------------------------------------------------------------------------------------


class Room:
    """Bytes of memory that some queues share."""

    def __init__(self, left: int) -> None:
        self.left = left


class Queue:
    """First in, first out, in blocks of records; what finds no room in memory goes to a file of the task."""

    def __init__(self, room: Room) -> None:
        self.room, self.size, self.blocks, self.file = room, 0, [], None

    def push(self, block: np.ndarray) -> None:
        if not len(block):
            return
        if block.nbytes > self.room.left:
            self.file = self.file or tempfile.TemporaryFile()
            at = self.file.seek(0, 2)
            block.tofile(self.file)
            self.blocks.append((at, len(block), block.dtype))
        else:
            self.room.left -= block.nbytes
            self.size += block.nbytes
            # A view would keep the whole array it is cut from.
            self.blocks.append(block.copy())

    def pop_all(self) -> Iterator[np.ndarray]:
        for block in self.blocks:
            if isinstance(block, tuple):
                self.file.seek(block[0])
                block = np.fromfile(self.file, block[2], block[1])
            yield block
        if self.file:
            self.file.close()
        self.room.left += self.size
        self.blocks, self.size, self.file = [], 0, None


# Anchors --------------------------------------------------------------------------------------


def _rolling(data: np.ndarray) -> np.ndarray:
    """Hash of the ``ANCHOR`` bytes from every place, put together from hashes of 16 and 4 bytes."""
    hashes, step = {1: data.astype(np.uint64) + np.uint64(1)}, 1
    while step < 16:
        one = hashes[step]
        hashes[2 * step] = one[:-step] * _MIX[0, step] + one[step:]
        step *= 2
    whole = hashes[16][: len(data) - ANCHOR + 1] * _MIX[1, 0] + hashes[ANCHOR - 16][16:]
    return _mixed(whole)


def runs(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of neighbouring windows with one anchor: hash, document, first window in it, bytes from there to the
    anchor, number of windows."""
    found: list[tuple[np.ndarray, ...]] = []
    for first in range(0, max(len(data) - WIDTH + 1, 0), _SEGMENT):
        segment = data[first : first + _SEGMENT + WIDTH - 1]
        hashes = _rolling(segment)
        least = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
        size = 1
        while 2 * size <= LEFT + 1:
            least, size = np.minimum(least[:-size], least[size:]), 2 * size
        rest = LEFT + 1 - size
        least = np.minimum(least[: len(least) - rest], least[rest:])
        # Windows that end inside their document.
        low, high = np.searchsorted(starts, first, "right") - 1, np.searchsorted(starts, first + len(least), "left")
        edges = np.clip(starts[low : high + 1], first, first + len(least))
        room = np.clip(np.minimum(starts[low + 1 : high + 1] - WIDTH + 1, first + len(least)) - edges[:-1], 0, None)
        at = _ranges(edges[:-1] - first, room)
        if not len(at):
            continue
        owner = np.repeat(np.arange(low, high), room)
        place = (least[at] & _PLACE).astype(np.int64)
        new = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1) | (owner[1:] != owner[:-1])])
        own = owner[new]
        found.append((hashes[place[new]], own, at[new] + first - starts[own], place[new] - at[new], np.diff(np.r_[new, len(at)])))
    if not found:
        return tuple(np.zeros(0, kind) for kind in (np.uint64, np.int64, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(x) for x in zip(*found))


def _grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal keys together, and where each group starts in it."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    return order, np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(keys) else np.zeros(0, np.int64)


def _anchor_blobs(batch: pa.RecordBatch, parts: int) -> Iterator[tuple[int, bytes]]:
    """Anchors of a batch by part. An anchor that several documents of the batch have goes as a count, and its runs
    are settled here: they go along in a list of their own."""
    data, starts = _buffer(batch.column(1))
    keys = _numbers(batch.column(0), 0)
    hashes, owner, first, lead, count = runs(data, starts)
    order, groups = _grouped(hashes)
    if not len(order):
        return
    sizes = np.diff(np.r_[groups, len(order)])
    own = keys[owner[order]]  # equal rows have one key, and are one document
    several = np.minimum.reduceat(own, groups) != np.maximum.reduceat(own, groups)
    shared = np.zeros(len(order), bool)
    shared[order] = np.repeat(several, sizes)
    known, known_counts = hashes[order][groups][several], sizes[several]
    run = (first << 16) | (lead << 8) | count
    part = (hashes % np.uint64(parts)).astype(np.int64)
    known_part = (known % np.uint64(parts)).astype(np.int64)
    # A settled run may go to any part; its document's keeps a document together.
    part[shared] = keys[owner[shared]] % parts
    by_part, known_by_part = np.argsort(part, kind="stable"), np.argsort(known_part, kind="stable")
    cuts = np.searchsorted(part[by_part], np.arange(parts + 1))
    known_cuts = np.searchsorted(known_part[known_by_part], np.arange(parts + 1))
    for p in range(parts):
        mine, counted = by_part[cuts[p] : cuts[p + 1]], known_by_part[known_cuts[p] : known_cuts[p + 1]]
        if not len(mine) and not len(counted):
            continue
        arrays = [known[counted], known_counts[counted].astype(np.uint32)]
        for chosen in (mine[~shared[mine]], mine[shared[mine]]):
            docs, at = np.unique(owner[chosen], return_index=True)
            arrays += [keys[docs], np.diff(np.r_[at, len(chosen)]).astype(np.uint32), run[chosen]]
        arrays.append(hashes[mine[~shared[mine]]])
        yield p, _pack(*arrays)


_ANCHOR_KINDS = ("<u8", "<u4", "<i8", "<u4", "<i8", "<i8", "<u4", "<i8", "<u8")


#: An anchor of one document's run, or (``run`` -1) the number of runs of an anchor that several documents have.
MET = np.dtype([("hash", "<u8"), ("key", "<i8"), ("run", "<i8"), ("n", "<i8")])


def _recurring(blobs: Iterator[bytes], parts: int, budget: int = QUEUE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None]]:
    """``key, run, n`` of a part: runs whose anchors recur, without ``n``; the most frequent anchors and all runs, with
    key 0. Settled runs go on as they arrive, the others wait by hash in queues, which are judged one by one."""
    room = Room(budget)
    queues = [Queue(room) for _ in range(_BUCKETS)]
    held, size = [], 0

    def deal() -> None:
        met = np.concatenate(held)
        bucket = (met["hash"] // np.uint64(parts) % np.uint64(_BUCKETS)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        met, cuts = met[order], np.searchsorted(bucket[order], np.arange(_BUCKETS + 1))
        for queue, start, stop in zip(queues, cuts, cuts[1:]):
            queue.push(met[start:stop])

    for blob in blobs:
        known, known_counts, keys, per_key, run, settled_keys, settled_per, settled, hashes = _unpack(blob, *_ANCHOR_KINDS)
        if len(settled):
            yield np.repeat(settled_keys, settled_per), settled, None
        met = np.zeros(len(hashes) + len(known), MET)
        met["hash"], met["key"][: len(hashes)] = np.concatenate([hashes, known]), np.repeat(keys, per_key)
        met["run"], met["n"] = np.concatenate([run, np.full(len(known), -1)]), np.concatenate([np.ones(len(hashes), np.int64), known_counts])
        held.append(met)
        size += len(met)
        if size >= _SEGMENT // 4:
            deal()
            held, size = [], 0
    if held:
        deal()
        held = []
    for queue in queues:
        blocks = list(queue.pop_all())
        if blocks:
            yield from _judged(np.concatenate(blocks))


def _judged(met: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None]]:
    order, groups = _grouped(met["hash"])
    met = met[order]
    alone = met["run"] >= 0
    low, high = np.where(alone, met["key"], -_LAST), np.where(alone, met["key"], _LAST)
    again = np.minimum.reduceat(low, groups) != np.maximum.reduceat(high, groups)
    marked = np.repeat(again, np.diff(np.r_[groups, len(met)])) & alone
    yield met["key"][marked], met["run"][marked], None
    totals = np.add.reduceat(met["n"], groups)
    often = totals >= HOT_LEAST
    yield np.zeros(often.sum() + 1, np.int64), np.r_[0, met["hash"][groups][often].view(np.int64)], np.r_[totals.sum(), totals[often]]


def _candidates(rows: DataFrame, parts: int) -> DataFrame:
    """``key, run`` of the runs of ``rows(key, text)`` whose anchors recur. Rows without a key are counts of runs:
    ``run`` is the hash of a frequent anchor, or 0 for all, and ``n`` its number."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dealt = list(_anchor_blobs(batch, parts))
            if dealt:
                yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in dealt], pa.int32()), pa.array([b for _, b in dealt], pa.binary())], ["part", "blob"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = (b.as_py() for batch in batches for b in batch.column(1))
        for keys, run, n in _recurring(blobs, parts):
            for at in range(0, len(keys), _SEGMENT):
                some = slice(at, at + _SEGMENT)
                if n is None:
                    columns = [pa.array(keys[some]), pa.array(run[some]), pa.nulls(len(keys[some]), pa.int64())]
                else:
                    columns = [pa.nulls(len(keys[some]), pa.int64()), pa.array(run[some]), pa.array(n[some])]
                yield pa.RecordBatch.from_arrays(columns, ["key", "run", "n"])

    dealt = rows.select("key", "text").mapInArrow(deal, "part int, blob binary")
    return dealt.repartitionById(parts, F.col("part")).mapInArrow(meet, "key bigint, run bigint, n bigint")


# Fragments ------------------------------------------------------------------------------------


def _fragments(data: np.ndarray, places: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The bytes of every fragment as a row, padded with zeros."""
    wide = WIDTH + LEFT
    at = np.minimum(places[:, None] + np.arange(wide), len(data) - 1)
    return np.where(np.arange(wide) < lengths[:, None], data[at], 0).astype(np.uint8)


def _fragment_blobs(batch: pa.RecordBatch, parts: int, hot: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Fragments of a batch of ``rank, row, text, runs`` by part, and the windows that are settled here: part -1."""
    rank, row = _numbers(batch.column(0), _LAST), _numbers(batch.column(1), 0)
    data, starts = _buffer(batch.column(2))
    listed = batch.column(3)
    every = listed.flatten().to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(listed)), pc.fill_null(pc.list_value_length(listed), 0).to_numpy(zero_copy_only=False))
    first, lead, count = every >> 16, (every >> 8) & 255, every & 255
    # Keys of rows may collide; a run from elsewhere must not reach beyond the text.
    inside = starts[owner] + first + count + WIDTH - 1 <= starts[owner + 1]
    owner, first, lead, count = (x[inside] for x in (owner, first, lead, count))
    for at in range(0, len(owner), _SLICE):
        some = slice(at, at + _SLICE)
        yield from _dealt(data, starts, rank, row, *(x[some] for x in (owner, first, lead, count)), parts, hot)


def _dealt(data, starts, rank, row, owner, first, lead, count, parts, hot) -> Iterator[tuple[int, bytes]]:
    place = starts[owner] + first
    hashes = _anchor_hashes(data, place + lead)
    crowded = np.isin(hashes, hot)
    if crowded.any():
        # One fragment for every window of a hot anchor.
        times = np.where(crowded, count, 1)
        step = _ranges(np.zeros(len(times), np.int64), times)
        crowded = np.repeat(crowded, times)
        owner, first, lead, count, hashes = (np.repeat(x, times) for x in (owner, first, lead, count, hashes))
        first, lead, count = first + step, lead - step, np.where(crowded, 1, count)
        place = starts[owner] + first
    lengths = count + WIDTH - 1
    rows = _fragments(data, place, lengths)
    wide = rows.astype(np.uint64)
    ends = np.stack([lengths, lead], 1).astype(np.uint64)
    whole = [_mixed(wide @ m[:-2] + ends @ m[-2:]) for m in _MIX]
    hashes = np.where(crowded, whole[0], hashes)
    # Equal fragments: the smallest document's stay, later ones are covered as a whole.
    order = np.lexsort((whole[1], whole[0]))
    new = np.r_[True, (whole[0][order][1:] != whole[0][order][:-1]) | (whole[1][order][1:] != whole[1][order][:-1])]
    least = np.repeat(np.minimum.reduceat(rank[owner[order]], np.flatnonzero(new)), np.diff(np.r_[np.flatnonzero(new), len(order)]))
    covered = np.zeros(len(order), bool)
    covered[order] = rank[owner[order]] > least
    if covered.any():
        gone = (np.uint64(1) << count[covered].astype(np.uint64)) - np.uint64(1)
        yield -1, _pack(rank[owner[covered]], row[owner[covered]], first[covered], gone.astype(np.uint32))
    left = np.flatnonzero(~covered)
    part = (hashes[left] % np.uint64(parts)).astype(np.int64)
    left = left[np.argsort(part, kind="stable")]
    cuts = np.searchsorted(np.sort(part), np.arange(parts + 1))
    inside = np.arange(WIDTH + LEFT) < lengths[:, None]
    for p in np.flatnonzero(np.diff(cuts)):
        mine = left[cuts[p] : cuts[p + 1]]
        arrays = rank[owner[mine]], row[owner[mine]], first[mine], lead[mine].astype(np.uint8), count[mine].astype(np.uint8)
        yield int(p), _pack(*arrays, rows[mine][inside[mine]])


_FRAGMENT_KINDS = ("<i8", "<i8", "<i8", "u1", "u1", "u1")
_GONE_KINDS = ("<i8", "<i8", "<i8", "<u4")


def _anchor_hashes(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The same hashes as in the first pass, for some places only."""
    hashes, step = {1: data[places[:, None] + np.arange(ANCHOR)].astype(np.uint64) + np.uint64(1)}, 1
    while step < 16:
        one = hashes[step]
        hashes[2 * step] = one[:, :-step] * _MIX[0, step] + one[:, step:]
        step *= 2
    return _mixed(hashes[16][:, 0] * _MIX[1, 0] + hashes[ANCHOR - 16][:, 16])


# Induced sort ---------------------------------------------------------------------------------


def _sorted_run(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes at the anchors of some fragments in order, and their bytes from the anchor on as rows."""
    rank, row, first, lead, count, data = (np.concatenate(x) for x in zip(*(_unpack(b, *_FRAGMENT_KINDS) for b in blobs)))
    lead, count = lead.astype(np.int64), count.astype(np.int64)
    lengths = count + WIDTH - 1
    anchors = np.cumsum(lengths) - lengths + lead
    after = lengths - lead
    right = np.where(np.arange(WIDTH) < after[:, None], data[np.minimum(anchors[:, None] + np.arange(WIDTH), len(data) - 1)], 0).astype(np.uint8)
    suffixes = np.zeros(len(rank), SUFFIX)
    back = np.arange(1, LEFT + 1)
    suffixes["left"] = np.where(back <= lead[:, None], data[np.maximum(anchors[:, None] - back, 0)], 0)
    for name, values in (("lead", lead), ("rank", rank), ("row", row), ("start", first)):
        suffixes[name] = values
    # The common prefix field holds the length of the suffix until the order is known.
    suffixes["common"] = after
    words = np.ascontiguousarray(np.pad(right, ((0, 0), (0, -WIDTH % 8)))).view(">u8").astype(np.uint64)
    # A suffix that another goes on from in zero bytes looks like it when padded; the shorter one comes first.
    order = np.lexsort((np.minimum(after, WIDTH), *words.T[::-1]))
    return suffixes[order], right[order]


def _common(right: np.ndarray, lengths: np.ndarray, before: np.ndarray, length_before: int) -> np.ndarray:
    """Common prefix of every row with the row before it."""
    above = np.concatenate([before[None], right[:-1]])
    differ = above != right
    at = np.where(differ.any(1), differ.argmax(1), WIDTH)
    return np.minimum(at, np.minimum(lengths, np.r_[length_before, lengths[:-1]])).astype(np.uint8)


def sorted_anchors(blobs: Iterator[bytes], run_fragments: int = RUN_FRAGMENTS) -> Iterator[np.ndarray]:
    """All suffixes that start at anchors, in order and with common prefixes. Runs that do not fit into memory wait
    in files and are merged through a heap."""
    held, size, files = [], 0, []

    def spill() -> None:
        file = tempfile.TemporaryFile()
        suffixes, right = _sorted_run(held)
        np.concatenate([suffixes.view(np.uint8).reshape(len(suffixes), -1), right], axis=1).tofile(file)
        files.append(file)

    for blob in blobs:
        held.append(blob)
        size += len(_unpack(blob, "<i8")[0])
        if size >= run_fragments:
            spill()
            held, size = [], 0
    before, length_before = np.zeros(WIDTH, np.uint8), 0
    if not files:
        if not held:
            return
        blocks: Iterator[tuple[np.ndarray, np.ndarray]] = iter([_sorted_run(held)])
    else:
        if held:
            spill()
        blocks = _merged(files)
    for suffixes, right in blocks:
        lengths = suffixes["common"].copy()
        suffixes["common"] = _common(right, lengths, before, length_before)
        before, length_before = right[-1], int(lengths[-1])
        yield suffixes


def _merged(files: list) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    wide = SUFFIX.itemsize + WIDTH

    # The bytes and the length decide, as in a run.
    length = SUFFIX.fields["common"][1]

    def rows(file) -> Iterator[tuple[bytes, bytes]]:
        file.seek(0)
        while chunk := file.read(wide * 4096):
            for at in range(0, len(chunk), wide):
                yield chunk[at + SUFFIX.itemsize : at + wide], chunk[at : at + SUFFIX.itemsize]
        file.close()

    held: list[tuple[bytes, bytes]] = []

    def block() -> tuple[np.ndarray, np.ndarray]:
        suffixes = np.frombuffer(b"".join(s for _, s in held), SUFFIX).copy()
        return suffixes, np.frombuffer(b"".join(r for r, _ in held), np.uint8).reshape(-1, WIDTH)

    for pair in heapq.merge(*(rows(f) for f in files), key=lambda x: (x[0], min(x[1][length], WIDTH))):
        held.append(pair)
        if len(held) == _SLICE:
            yield block()
            held = []
    if held:
        yield block()


def _least_between(common: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least of ``common[low + 1 .. high]`` for every pair, from minima over stretches of powers of two."""
    length = high - low
    level = np.frexp(length)[1] - 1
    result, table, size = np.empty(len(low), np.uint8), common, 1
    for k in range(int(level.max(initial=-1)) + 1):
        mine = level == k
        result[mine] = np.minimum(table[low[mine] + 1], table[high[mine] - size + 1])
        if size < len(common):
            table, size = np.minimum(table[:-size], table[size:]), 2 * size
    return result


def induce(order: Iterator[np.ndarray], level: int, budget: int = QUEUE_BYTES) -> Iterator[np.ndarray]:
    """The order of the suffixes one byte longer: ``level`` bytes of each are before its anchor. Suffixes whose
    fragment has no byte left end here."""
    room = Room(budget)
    queues = [Queue(room) for _ in range(256)]
    # The least common prefix since the last suffix that went to each queue; none went to an empty one.
    passed, used = np.full(256, 255, np.uint8), np.zeros(256, bool)
    for block in order:
        common = block["common"]
        going = np.flatnonzero(block["lead"] >= level)
        byte = block["left"][going, level - 1]
        by_byte = np.argsort(byte, kind="stable")
        at, byte = going[by_byte], byte[by_byte]
        first = np.r_[True, byte[1:] != byte[:-1]] if len(byte) else np.zeros(0, bool)
        moved = block[at]
        inner = ~first
        new = np.zeros(len(at), np.uint8)
        new[inner] = np.minimum(_least_between(common, at[:-1][inner[1:]], at[1:][inner[1:]]), 254) + 1
        # The first of a byte in this block looks back to the blocks before; the last one resets what is passed.
        least = np.minimum.accumulate(common)
        heads = np.flatnonzero(first)
        new[heads] = np.where(used[byte[heads]], np.minimum(np.minimum(passed[byte[heads]], least[at[heads]]), 254) + 1, 0)
        moved["common"] = new
        passed = np.minimum(passed, least[-1])
        tails = np.r_[heads[1:] - 1, len(at) - 1] if len(heads) else heads
        behind = np.r_[np.minimum.accumulate(common[::-1])[::-1][1:], 255].astype(np.uint8)
        passed[byte[tails]] = behind[at[tails]]
        used[byte[heads]] = True
        for start, stop in zip(heads, np.r_[heads[1:], len(at)]):
            queues[byte[start]].push(moved[start:stop])
    for queue in queues:
        yield from queue.pop_all()


def _blocks(order: Iterator[np.ndarray], size: int = 4 * _SLICE) -> Iterator[np.ndarray]:
    """The same suffixes in blocks of about ``size`` that hold whole groups of equal windows. Equal fragments of a
    batch are one, and frequent anchors are dealt out by window, so groups are far smaller than the corpus."""
    held: list[np.ndarray] = []
    n = 0
    for block in order:
        held.append(block)
        n += len(block)
        if n >= size:
            whole = np.concatenate(held)
            ends = np.flatnonzero(whole["common"] < WIDTH)
            cut = int(ends[-1]) if len(ends) and ends[-1] else 0
            if cut:
                yield whole[:cut]
            held, n = [whole[cut:].copy()], len(whole) - cut
    if held:
        yield np.concatenate(held)


def _mark(block: np.ndarray, level: int) -> None:
    """Sets the windows that start ``level`` bytes before their anchors and are in an earlier document as well."""
    heads = np.flatnonzero(np.r_[True, block["common"][1:] < WIDTH])
    sizes = np.diff(np.r_[heads, len(block)])
    least = np.repeat(np.minimum.reduceat(block["rank"], heads), sizes)
    later = block["rank"] > least
    block["gone"][later] |= np.uint32(1) << (block["lead"][later] - level).astype(np.uint32)


def covered(blobs: Iterator[bytes], run_fragments: int = RUN_FRAGMENTS, budget: int = QUEUE_BYTES) -> Iterator[np.ndarray]:
    """Suffixes of the shard's fragments with their removed windows in ``gone``, one level after the other: a
    suffix comes out when its fragment has no more bytes to the left."""
    order: Iterator[np.ndarray] = sorted_anchors(blobs, run_fragments)
    for level in range(LEFT + 1):
        queue = Queue(Room(budget))
        for block in _blocks(order):
            block = block.copy()
            _mark(block, level)
            done = block[(block["lead"] == level) & (block["gone"] > 0)]
            if len(done):
                yield done
            queue.push(block)
        if not queue.blocks:
            return
        order = induce(queue.pop_all(), level + 1, budget)


# Operator -------------------------------------------------------------------------------------


def removals(docs: DataFrame, identifier: str = "doc_id", text: str = "text") -> DataFrame:
    """``rank, row, start, gone``: in the document ``rank`` (its id, the largest number for NULL) and the row with
    the text hash ``row``, the windows ``start + i`` for every bit ``i`` of ``gone`` are to be removed."""
    spark = docs.sparkSession
    rows = docs.select(F.col(identifier).cast("bigint").alias("rank"), F.xxhash64(text).alias("row"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    keyed = rows.filter(F.octet_length("text") >= WIDTH).withColumn("key", F.xxhash64("rank", "row"))
    n_bytes = keyed.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(-(-n_bytes // PART_BYTES), MOST_PARTS))
    found = written(_candidates(keyed, parts), "anchors")
    counts = found.filter("key IS NULL")
    total = counts.filter("run = 0").agg(F.sum("n")).first()[0] or 0
    hot = counts.filter(F.col("run") != 0).filter(F.col("n") > max(HOT_LEAST, total // HOT_SHARE)).select("run").collect()
    hot = np.array([r.run for r in hot], np.int64).view(np.uint64)
    listed = found.filter("key IS NOT NULL").groupBy("key").agg(F.collect_set("run").alias("runs"))
    # Equal rows are one document here; the rows come back with the report. Both sides are dealt by the key alone.
    texts = keyed.dropDuplicates(["key"]).join(listed, "key").select("rank", "row", "text", "runs")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, blob in _fragment_blobs(batch, parts, hot):
                where = part if part >= 0 else int.from_bytes(hashlib.blake2b(blob, digest_size=4).digest()) % parts
                columns = [pa.array([where], pa.int32()), pa.array([part >= 0]), pa.array([blob], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["part", "fragments", "blob"])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # What is settled waits in a file of the task until the fragments are through.
        settled, sizes = tempfile.TemporaryFile(), []

        def fragments() -> Iterator[bytes]:
            for batch in batches:
                for whole, blob in zip(batch.column(1), batch.column(2)):
                    if whole.as_py():
                        yield blob.as_py()
                    else:
                        sizes.append(settled.write(blob.as_py()))

        for block in covered(fragments()):
            yield _record([block[c] for c in ("rank", "row", "start", "gone")])
        settled.seek(0)
        for size in sizes:
            yield _record(_unpack(settled.read(size), *_GONE_KINDS))
        settled.close()

    dealt = texts.mapInArrow(deal, "part int, fragments boolean, blob binary")
    gone = dealt.repartitionById(parts, F.col("part")).mapInArrow(sort, "rank bigint, row bigint, start bigint, gone bigint")
    return written(gone, "removals")


def _record(columns: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c).astype(np.int64)) for c in columns], ["rank", "row", "start", "gone"])


def spans(starts: np.ndarray, gone: np.ndarray) -> list[tuple[int, int]]:
    """Maximal stretches covered by the windows, in order."""
    if not len(starts):
        return []
    bits = np.arange(LEFT + 1)
    at = np.unique((starts[:, None] + bits)[(gone[:, None] >> bits) & 1 == 1])
    new = np.flatnonzero(np.r_[True, at[1:] > at[:-1] + WIDTH])
    return list(zip(at[new].tolist(), (at[np.r_[new[1:], len(at)] - 1] + WIDTH).tolist()))


def _cut(texts: pd.Series, starts: pd.Series, gone: pd.Series) -> Iterator[tuple[bytes, list[tuple[int, int]]]]:
    for text, s, g in zip(texts, starts, gone):
        data = text.encode("utf-8", "surrogatepass") if text else b""
        stretches = spans(np.asarray(s, np.int64), np.asarray(g, np.int64)) if s is not None else []
        edges = [0, *(x for stretch in stretches for x in stretch), len(data)]
        yield b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])), stretches


def _report(texts: pd.Series, starts: pd.Series, gone: pd.Series) -> pd.DataFrame:
    rows = [
        (len(kept) + sum(b - a for a, b in stretches), sum(b - a for a, b in stretches), len(stretches), hashlib.sha256(kept).hexdigest())
        for kept, stretches in _cut(texts, starts, gone)
    ]
    return pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _kept(texts: pd.Series, starts: pd.Series, gone: pd.Series) -> pd.DataFrame:
    rows = [(kept, [{"start": a, "end": b} for a, b in stretches]) for kept, stretches in _cut(texts, starts, gone)]
    return pd.DataFrame(rows, columns=["kept", "removed"])


def _with_windows(docs: DataFrame, identifier: str, text: str) -> tuple[DataFrame, Column, Column]:
    """``docs`` with the removed windows of every row, as two columns of lists."""
    gone = removals(docs, identifier, text).groupBy("rank", "row").agg(F.collect_list("start").alias("starts"), F.collect_list("gone").alias("gone"))
    names = [fresh(c, docs) for c in ("__rank", "__row", "__starts", "__gone")]
    gone = gone.toDF(*names)
    rank = F.coalesce(docs[identifier].cast("bigint"), F.lit(_LAST))
    both = docs.join(gone, same(rank, F.col(names[0])) & (F.xxhash64(docs[text]) == F.col(names[1])), "left")
    return both, F.col(names[2]), F.col(names[3])


def report(docs: DataFrame, identifier: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``identifier, n_bytes, n_removed, n_spans, kept_sha256``."""
    both, starts, gone = _with_windows(docs, identifier, text)
    told = F.pandas_udf(_report, "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")(docs[text], starts, gone)
    return both.select(docs[identifier], told.alias("told")).select(identifier, "told.*")


def remove(docs: DataFrame, identifier: str = "doc_id", text: str = "text", kept: str = "kept", removed: str = "removed") -> DataFrame:
    """``docs`` with the remaining bytes (a cut may fall inside a character) and the removed stretches."""
    both, starts, gone = _with_windows(docs, identifier, text)
    told = F.pandas_udf(_kept, "kept binary, removed array<struct<start:bigint,end:bigint>>")(docs[text], starts, gone)
    name = fresh("__told", docs)
    return both.select(*[docs[c] for c in docs.columns], told.alias(name)).withColumns({kept: F.col(f"{name}.kept"), removed: F.col(f"{name}.removed")}).drop(name)
