"""Words of text columns as numpy arrays: places and 64-bit hashes, taken from
Arrow's buffers without a Python string per word. Used inside tasks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SPACES = b" \t\n\v\f\r"
BLOCK_BYTES = 1 << 20
#: Bytes of a segment that is hashed along with others, place by place.
SHORT = 32
#: Odd multipliers of the polynomial hash and of its final mixing.
BASE = 0x9E3779B97F4A7C15
MIX_A, MIX_B = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
SPACE, LETTER, DIGIT, OTHER = range(4)


def _table(words_only: bool) -> np.ndarray:
    """Class of each byte; with ``words_only`` all but white space is a letter."""
    table = np.full(256, LETTER if words_only else OTHER, np.uint8)
    table[128:] = LETTER
    for first, last in (b"az", b"AZ"):
        table[first:last + 1] = LETTER
    if not words_only:
        table[b"0"[0]:b"9"[0] + 1] = DIGIT
    table[list(SPACES)] = SPACE
    return table


def _powers(n: int = 1 << 16) -> np.ndarray:
    out = np.full(n, BASE, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(MIX_A)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(MIX_B)
    return h ^ (h >> np.uint64(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column's bytes and its rows' offsets in them; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    """Words of some rows: ``row`` counts from the block's first row."""

    first: int           # the block's first row in the batch
    rows: int
    row: np.ndarray
    start: np.ndarray    # in the block's bytes
    end: np.ndarray
    hash: np.ndarray     # uint64
    data: np.ndarray     # the block's bytes

    def bounds(self) -> np.ndarray:
        """Where each row's words begin, and one past the last."""
        return np.searchsorted(self.row, np.arange(self.rows + 1))


def segment_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, powers: np.ndarray) -> np.ndarray:
    """Hashes of byte segments (in order, apart from each other). Short ones,
    the longest first, add up their bytes of one place at a time; of longer
    ones some ``BLOCK_BYTES`` are spread out at a time."""
    out = np.zeros(len(start), np.uint64)
    length = end - start
    short = np.flatnonzero(length <= SHORT)
    order = short[np.argsort(length[short].astype(np.uint8), kind="stable")[::-1]]
    longer = np.cumsum(np.bincount(length[order], minlength=SHORT + 1)[::-1])[::-1]    # segments of so many bytes or more
    at, sums = start[order], np.zeros(len(order), np.uint64)
    values = np.arange(1, 257, dtype=np.uint64)
    for k in range(SHORT):
        n = longer[k + 1] if k + 1 < len(longer) else 0
        if not n:
            break
        sums[:n] += (values * powers[k]).take(data.take(at[:n]))
        at[:n] += 1
    out[order] = sums
    rest = np.flatnonzero(length > SHORT)
    out[rest] = _spread_out(data, start[rest], length[rest], powers)
    return mix(out + length.astype(np.uint64))


def _spread_out(data: np.ndarray, start: np.ndarray, length: np.ndarray, powers: np.ndarray) -> np.ndarray:
    """Sums of the segments' bytes times the powers of their places."""
    out = np.zeros(len(start), np.uint64)
    through = np.cumsum(length)
    at = 0
    while at < len(start):
        to = max(at + 1, int(np.searchsorted(through, (through[at - 1] if at else 0) + BLOCK_BYTES, "right")))
        n = length[at:to]
        begin = np.cumsum(n) - n
        place = np.arange(int(n.sum()))
        inside = place - np.repeat(begin, n)
        value = (data[place + np.repeat(start[at:to] - begin, n)].astype(np.uint64) + np.uint64(1)) * powers[inside & 0xFFFF]
        if n.max(initial=0) > 0xFFFF:
            value += mix((inside >> 16).astype(np.uint64)) * (inside > 0xFFFF)
        out[at:to] = np.add.reduceat(value, begin)
        at = to
    return out


def blocks(offsets: np.ndarray, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about so many bytes; a longer row is alone."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, min(to, n)
        at = to


class Splitter:
    """Splits text columns into words: runs of bytes of one class (letters and
    all beyond ASCII, digits, others), or with ``words_only`` runs without
    white space."""

    def __init__(self, words_only: bool = False):
        self.table, self.powers = _table(words_only), _powers()
        self.classes = self.table.tobytes()

    def words(self, column: pa.Array) -> Iterator[Words]:
        data, offsets = buffers(column)
        for lo, hi in blocks(offsets):
            part, edges = data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
            if not len(part):
                none = np.zeros(0, np.int64)
                yield Words(lo, hi - lo, none, none, none, none.astype(np.uint64), part)
                continue
            kind = np.frombuffer(part.tobytes().translate(self.classes), np.uint8)
            new = np.empty(len(part), bool)
            new[0] = True
            np.not_equal(kind[1:], kind[:-1], out=new[1:])
            new[edges[:-1][edges[:-1] < len(part)]] = True
            start = np.flatnonzero(new)
            end = np.append(start[1:], len(part))
            word = np.flatnonzero(kind.take(start) != SPACE)
            start, end = start.take(word), end.take(word)
            row = np.repeat(np.arange(hi - lo), np.diff(np.searchsorted(start, edges)))
            yield Words(lo, hi - lo, row, start, end, segment_hashes(part, start, end, self.powers), part)
