"""Vectorised text kernels that the Arrow functions of this subpackage share.

A batch is cut into chunks of about CHUNK bytes (a longer document makes a chunk of its own, whose
wide working arrays are cut once more), so memory stays a small multiple of the longest document.  Words are found on the
UTF-8 bytes: every word class used here is defined by ASCII bytes, and all other bytes belong to
words, so bytes and code points agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 18

_BYTE = np.arange(256)
#: words [^\x20\x09-\x0D]+
NOT_SPACE = ~((_BYTE == 0x20) | ((_BYTE >= 0x09) & (_BYTE <= 0x0D)))
#: words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after A-Z became a-z
ALNUM = ((_BYTE >= 0x30) & (_BYTE <= 0x39)) | ((_BYTE >= 0x61) & (_BYTE <= 0x7A)) | (_BYTE >= 0x80)
LOWER = np.where((_BYTE >= 0x41) & (_BYTE <= 0x5A), _BYTE + 32, _BYTE).astype(np.uint8)

#: odd constants of the hashes
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit values."""
    h = h ^ (h >> np.uint64(30))
    h = h * _M1
    h = h ^ (h >> np.uint64(27))
    h = h * _M2
    return h ^ (h >> np.uint64(31))


def _joined(left: np.ndarray, right: np.ndarray, seed: np.uint64) -> np.ndarray:
    """A hash of two neighbouring hashes, in order."""
    h = left * np.uint64(BASES[1]) + (right ^ seed) * np.uint64(BASES[2])
    h ^= h >> np.uint64(32)
    h *= _M1
    return h ^ (h >> np.uint64(29))


def run_hashes(values: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive values (fewer than n values: none), by doubling: every step scrambles, so it is no polynomial either."""
    count = max(0, len(values) - n + 1)
    out = np.empty(count, np.uint64)
    for at in range(0, count, CHUNK):
        h, span, step = values[at : at + CHUNK + n - 1], 1, n
        while span < n:
            more = min(span, n - span)
            step = (step * BASES[0] + 1) & 0xFFFFFFFFFFFFFFFF
            h = _joined(h[:-more], h[more:], np.uint64(step))
            span += more
        out[at : at + CHUNK] = h if n > 1 else mix(h + np.uint64(1))
    return out


def sliding_min(values: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each run of w consecutive values, by doubling."""
    if len(values) < w:
        return np.zeros(0, values.dtype)
    out, span = values, 1
    while span * 2 <= w:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    if span < w:
        out = np.minimum(out[: len(values) - w + 1], out[w - span : w - span + len(values) - w + 1])
    return out


def _placed(place: np.ndarray, byte: np.ndarray) -> np.ndarray:
    return mix((place.astype(np.uint64) << np.uint64(8)) + byte + np.uint64(BASES[0]))


class Words:
    """The words of a chunk of documents: byte spans, 64-bit hashes, and each document's range of words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray, lower: bool):
        if lower:
            data = LOWER[data]
        self.data = data
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = table[data]
        cut = np.zeros(len(data) + 1, bool)  # a document begins here: no word runs across
        cut[offsets] = True
        left, here = inside[:-1], inside[1:]
        self.start = np.flatnonzero(here & (~left | cut))
        self.end = np.flatnonzero(left & (~here | cut))
        self.bounds = np.searchsorted(self.start, offsets)
        self.hash = self._hash()

    def _hash(self) -> np.ndarray:
        """Of each word the sum of a scrambled value for each of its bytes and their places, scrambled again with its length: no polynomial, so patterns in the bytes don't cancel."""
        out = np.empty(len(self.start), np.uint64)
        first = 0
        while first < len(out):  # parts of about CHUNK bytes, whole words each
            last = max(first + 1, int(np.searchsorted(self.end, int(self.start[first]) + CHUNK, "right")))
            size = self.end[first:last] - self.start[first:last]
            if size[0] > 4 * CHUNK:  # one very long word
                out[first] = self._long(int(self.start[first]), int(size[0]))
                first += 1
                continue
            begin = np.cumsum(size) - size
            place = np.arange(int(size.sum())) - np.repeat(begin, size)
            byte = self.data[place + np.repeat(self.start[first:last], size)]
            out[first:last] = mix(np.add.reduceat(_placed(place, byte), begin) ^ (size.astype(np.uint64) * np.uint64(BASES[2])))
            first = last
        return out

    def _long(self, start: int, size: int) -> np.uint64:
        total = np.zeros(1, np.uint64)
        for at in range(0, size, CHUNK):
            byte = self.data[start + at : start + min(size, at + CHUNK)]
            total += _placed(np.arange(at, at + len(byte)), byte).sum(dtype=np.uint64)
        return mix(total ^ (np.array([size], np.uint64) * np.uint64(BASES[2])))[0]


def texts(column: pa.Array) -> pa.Array:
    """A string column with null as empty text and 64-bit offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def spans(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the n + 1 offsets of a column made by texts()."""
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data, offsets


def byte_sizes(column: pa.Array) -> list[int]:
    """Bytes of each text of a column made by texts()."""
    return np.diff(spans(column)[1]).tolist()


def chunks(column: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets within them) of parts of about size bytes."""
    if not len(column):
        return
    data, offsets = spans(column)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        last = min(last, len(column))
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """A list column from one array a row."""
    sizes = np.fromiter((len(p) for p in parts), np.int64, len(parts))
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, kind))
