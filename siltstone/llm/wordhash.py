"""Word boundaries and word hashes of whole Arrow string columns, without a loop over words.

A word is a maximal run of bytes outside ``\\x20 \\x09-\\x0D``; as those are all ASCII, bytes and
code points give the same words. Words of up to 64 bytes are hashed in blocks of 8 bytes, each mixed into the hash of those before;
longer ones by a cryptographic hash. Two lanes with constants of their own give 128 independent bits where 64 are too few. A hash
depends on the word's bytes alone, never on the process or the batch.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Words of more bytes are hashed one by one, which their length makes up for.
LONG = 64
#: Text bytes that one slice of a batch may hold (one longer text makes a slice alone).
SLICE_BYTES = 4 << 20

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
#: Another way to cut: words of ASCII letters and digits and of all characters beyond ASCII.
IS_MARK = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: For each lane what a hash begins with and what blocks and neighbours are multiplied by (odd).
_SEED = (U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F))
_MUL = (U64(0xD6E8FEB86659FD93), U64(0xA0761D6478BD642F))
#: Masks of the first 0 to 8 bytes of a block.
_FIRST = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=U64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that each input bit reaches each output bit."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


def _then(a: np.ndarray, b: np.ndarray, lane: int) -> np.ndarray:
    """The hash of what ``a`` and then ``b`` stand for; not linear in either, and their order counts."""
    x = (a ^ (a >> U64(29))) * _MUL[lane] + b
    x = (x ^ (x >> U64(32))) * _MUL[lane]
    return x ^ (x >> U64(29))


class Words:
    """The words of one slice of texts: hashes, the row of each, and where its bytes lie."""

    __slots__ = ("count", "data", "end", "first", "hash", "lanes", "row", "rows", "start")

    def __init__(self, texts: pa.Array, lower: bool = False, breaks: np.ndarray = IS_SPACE, lanes: int = 1):
        data, offsets = _buffers(texts)
        self.rows = len(texts)
        self.data = data
        base, top = int(offsets[0]), int(offsets[-1])
        body = data[base:top]
        inside = ~breaks[body]
        opens = inside.copy()
        opens[1:] &= ~inside[:-1]
        closes = inside.copy()
        closes[:-1] &= ~inside[1:]
        edges = offsets - base
        at = edges[:-1][edges[:-1] < len(body)]
        opens[at] |= inside[at]
        at = edges[1:][edges[1:] > 0] - 1
        closes[at] |= inside[at]
        self.start = np.flatnonzero(opens) + base
        self.end = np.flatnonzero(closes) + base + 1
        #: Index of each row's first word, and one more at the end.
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)
        self.row = np.repeat(np.arange(self.rows), self.count)
        self.lanes = self._hashes(_LOWER[body] if lower else body, base, lanes)
        self.hash = self.lanes[0]

    def _hashes(self, body: np.ndarray, base: int, lanes: int) -> list[np.ndarray]:
        size = self.end - self.start
        out = [mix(size.astype(U64) + _SEED[k]) for k in range(lanes)]
        if not len(size):
            return out
        padded = np.zeros(len(body) + 8, dtype=np.uint8)
        padded[: len(body)] = body
        blocks = np.ndarray((len(body) + 1,), dtype="<u8", buffer=padded, strides=(1,))  # at every byte
        live = np.flatnonzero(size <= LONG) if int(size.max()) > LONG else None
        low, left = self.start - base, size
        if live is not None:
            for k in np.flatnonzero(size > LONG).tolist():
                a = int(low[k])
                digest = hashlib.blake2b(padded[a : a + int(size[k])].tobytes(), digest_size=16).digest()
                for lane in range(lanes):
                    out[lane][k] = U64(int.from_bytes(digest[8 * lane : 8 * lane + 8], "little"))
            low, left = low[live], left[live]
        while len(left):
            block = blocks[low] & _FIRST[np.minimum(left, 8)]
            for lane in range(lanes):
                if live is None:
                    out[lane] = _then(out[lane], block, lane)
                else:
                    out[lane][live] = _then(out[lane][live], block, lane)
            more = np.flatnonzero(left > 8)
            live = more if live is None else live[more]
            low, left = low[more] + 8, left[more] - 8
        return out

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The first word of each window of ``size`` words inside one row, and the windows' hashes."""
        n = len(self.hash)
        if n < size:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=U64)
        starts = np.flatnonzero(self.row[: n - size + 1] == self.row[size - 1 :])
        return starts, self.window_hashes(starts, size)

    def window_hashes(self, starts: np.ndarray, size: int, lane: int = 0) -> np.ndarray:
        """Hashes of the windows that begin at some words, by doubling: windows of 1, 2, 4, ... words, and the sum of those that make ``size``."""
        if not len(starts):
            return np.empty(0, dtype=U64)
        power, width, done = self.lanes[lane], 1, 0
        out = None
        while True:
            if size & width:  # the next ``width`` words
                part = power[starts + done]
                out = _then(part, U64(size), lane) if out is None else _then(out, part, lane)
                done += width
            if width * 2 > size:
                return mix(out)
            power = _then(power[: len(power) - width], power[width:], lane)
            width *= 2

    def text(self, k: int) -> bytes:
        return self.data[self.start[k] : self.end[k]].tobytes()


def give_back() -> None:
    """Return what a task has freed to the system; Python workers stay and would hold it against the next stage."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and offsets of a string array; nulls are made empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    if len(texts) == 0 or offsets is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    own = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    body = np.zeros(0, dtype=np.uint8) if data is None else np.frombuffer(data, dtype=np.uint8)
    return body, own.astype(np.int64)


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Parts of a batch that hold at most SLICE_BYTES of text, or a single row."""
    _, offsets = _buffers(batch.column(column))
    k = 0
    while k < batch.num_rows:
        stop = max(k + 1, int(np.searchsorted(offsets, offsets[k] + SLICE_BYTES, side="right")) - 1)
        yield batch.slice(k, stop - k)
        k = stop
