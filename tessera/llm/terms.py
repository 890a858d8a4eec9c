"""Terms of texts as packed bytes, cut, sorted and run-counted in numpy, for use inside tasks.

A table of 256 entries says which bytes belong to a term and what they fold to; 0 ends a term. Bytes from 0x80 on
always belong to one, so a term never cuts a character. A term of up to 8 bytes is one unsigned 64-bit word, one of up
to 16 bytes two; the words order like the bytes. Longer terms are bytes in buckets by width. No term holds a zero
byte, so padding with zeros keeps different terms apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SHORT, PACKED = 8, 16
# Bytes of text that are cut and sorted at once; a longer text is a chunk of its own.
CHUNK_BYTES = 8 << 20
_MASKS = np.array([0] + [((1 << 8 * n) - 1) << 8 * (8 - n) for n in range(1, 9)], np.uint64)


def byte_table(digits: bool) -> np.ndarray:
    """Letters, with A-Z folded, all that is not ASCII, and on request digits."""
    table = np.zeros(256, np.uint8)
    for first, last in ((0x61, 0x7A), (0x80, 0xFF), *(((0x30, 0x39),) if digits else ())):
        table[first : last + 1] = np.arange(first, last + 1)
    table[0x41:0x5B] = table[0x61:0x7B]
    return table


LETTERS, ALPHANUMERIC = byte_table(False), byte_table(True)


@dataclass
class Texts:
    """Neighbouring texts of a batch: their bytes, and where each begins and the last ends."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[Texts]:
    """The texts of a column in runs of about ``most`` bytes; NULL is empty."""
    column = column.fill_null("")
    if not len(column):
        return
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, places, content = column.buffers()
    offsets = np.frombuffer(places, wide)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(content, np.uint8) if content is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield Texts(at, data[offsets[at] : offsets[upto]], offsets[at : upto + 1] - offsets[at])
        at = upto


@dataclass
class Cut:
    """Terms of some texts in reading order: folded bytes, first byte, length and text of each."""

    folded: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    owners: np.ndarray

    def take(self, chosen: np.ndarray) -> Cut:
        return Cut(self.folded, self.starts[chosen], self.lengths[chosen], self.owners[chosen])

    def words(self, number: int) -> np.ndarray:
        """The first (0) or second (1) eight bytes of every term as unsigned words."""
        windows = np.lib.stride_tricks.sliding_window_view(self.folded, SHORT)
        left = np.clip(self.lengths - number * SHORT, 0, SHORT)
        at = np.where(left > 0, self.starts + number * SHORT, 0)
        return windows[at].view(">u8").ravel().astype(np.uint64) & _MASKS[left]

    def bytes(self) -> list[bytes]:
        content = self.folded.tobytes()
        return [content[s : s + n] for s, n in zip(self.starts.tolist(), self.lengths.tolist())]


def cut(texts: Texts, table: np.ndarray) -> Cut:
    folded = np.zeros(len(texts.data) + SHORT, np.uint8)
    folded[: len(texts.data)] = table[texts.data]
    inside = folded[: len(texts.data)] != 0
    edge = np.zeros(len(inside) + 1, bool)
    edge[texts.offsets] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(first)
    return Cut(folded, starts, np.flatnonzero(last) + 1 - starts, np.searchsorted(texts.offsets, starts, "right") - 1)


def radix_order(*words: np.ndarray) -> np.ndarray:
    """Stable order by the words, the first counting most: one counting pass per 16 bits that differ."""
    order = np.arange(len(words[0]))
    for word in reversed(words):
        spread = int(np.bitwise_or.reduce(word ^ word[0])) if len(word) else 0
        for shift in range(0, 64, 16):
            if spread >> shift & 0xFFFF:
                digit = (word >> np.uint64(shift)).astype(np.uint16)
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def runs(*sorted_keys: np.ndarray) -> np.ndarray:
    """Where a new value begins in sorted keys."""
    change = np.ones(len(sorted_keys[0]), bool)
    change[1:] = False
    for key in sorted_keys:
        change[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(change)


def unpack(*words: np.ndarray) -> list[bytes]:
    """The bytes of packed terms."""
    wide = np.ascontiguousarray(np.column_stack(words).astype(">u8"))
    return wide.view(f"S{SHORT * len(words)}").ravel().tolist()
