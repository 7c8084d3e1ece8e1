"""Array views of text columns: word spans, line spans and span digests of whole batches at once."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SLICE_BYTES = 1 << 19
BASE = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1
PRIME = (1 << 31) - 1
BASES = (1_540_483_477, 461_845_907)
_POWERS: dict[int, np.ndarray] = {}


def release_memory() -> None:
    """Gives freed memory back to the machine. Python workers live on between tasks, and what they
    keep counts against their executor."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def byte_set(inside: bytes | range | list[int]) -> np.ndarray:
    flags = np.zeros(256, bool)
    flags[list(inside)] = True
    return flags


WHITE_BYTES = byte_set(b" \t\n\x0b\f\r")
WORD_BYTES = ~WHITE_BYTES
#: Each byte with A-Z lower-cased.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and where each begins (one more entry at the end)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]] if body is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def text_lengths(column: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one row that is longer."""
    ends = np.cumsum(text_lengths(column))
    start, used = 0, 0
    while start < len(ends):
        stop = max(start + 1, int(np.searchsorted(ends, used + limit, "right")))
        yield start, stop
        start, used = stop, int(ends[stop - 1])


def word_spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray = WORD_BYTES):
    """Starts and ends of the maximal runs of ``inside`` bytes, and each text's range among them."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    flag = inside[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    begins = flag & cut[:-1]
    begins[1:] |= flag[1:] & ~flag[:-1]
    finish = flag & cut[1:]
    finish[:-1] |= flag[:-1] & ~flag[1:]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(finish) + 1, np.searchsorted(starts, offsets)


def mixed_bits(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every bit depends on every other."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    """base ** i modulo PRIME for i up to n at least, kept between batches."""
    have = _POWERS.get(base)
    if have is None or len(have) <= n:
        size = 1 << max(16, int(n).bit_length())
        have = np.ones(size, np.uint64)
        done = 1
        while done < size:
            have[done : 2 * done] = have[:done] * np.uint64(pow(base, done, PRIME)) % np.uint64(PRIME)
            done *= 2
        _POWERS[base] = have
    return have


def _folded(x: np.ndarray) -> np.ndarray:
    """The same number modulo PRIME below 2^31 + 2, for numbers below 2^63; without a division."""
    prime, bits = np.uint64(PRIME), np.uint64(31)
    x = (x & prime) + (x >> bits)
    return (x & prime) + (x >> bits)


class SpanDigests:
    """Digests of any spans of one byte array: two polynomials modulo the prime 2^31 - 1, from prefix sums.

    A polynomial modulo a power of two gives one digest to some regular strings, such as the
    Thue-Morse word and its mirror image, whatever its base; modulo a prime it does not.
    """

    def __init__(self, data: np.ndarray):
        n = len(data)
        values = data.astype(np.uint64) + np.uint64(1)
        self.lanes = []
        for base in BASES:
            terms = values * _powers(base, n)[:n]
            if n > 1 << 24:  # else the sum of n terms below 2^39 stays below 2^63
                terms %= np.uint64(PRIME)
            prefix = np.zeros(n + 1, np.uint64)
            np.cumsum(terms, out=prefix[1:])
            self.lanes.append((prefix, _powers(pow(base, -1, PRIME), n)))

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        lanes = (_folded(_folded(prefix[ends] - prefix[starts]) * back[starts]) for prefix, back in self.lanes)
        one, two = (np.minimum(x, x - np.uint64(PRIME)) for x in lanes)  # the smaller one did not wrap around
        sizes = (ends - starts).astype(np.uint64)
        return mixed_bits((one << np.uint64(32) | two) ^ mixed_bits(sizes))


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of the values between the offsets."""
    total = np.zeros(len(flags) + 1, np.float64 if flags.dtype.kind == "f" else np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def shingle_digests(words: np.ndarray, ranges: np.ndarray, width: int):
    """Digests of ``width`` neighbouring words inside each text, and the texts' ranges among them.

    A text of fewer words, but one or more, has one shingle of all its words.
    """
    counts = np.diff(ranges)
    sizes = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    out_ranges = np.concatenate([[0], np.cumsum(sizes)])
    first = np.repeat(ranges[:-1] - out_ranges[:-1], sizes) + np.arange(out_ranges[-1])
    last = np.repeat(ranges[1:], sizes)
    digest = np.zeros(len(first), np.uint64)
    for k in range(width):
        at = first + k
        word = np.where(at < last, words[np.minimum(at, max(len(words) - 1, 0))], np.uint64(0)) if len(words) else digest
        digest = digest * np.uint64(BASE) + word
    return mixed_bits(digest), out_ranges


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts' code points in a row, and where each text begins among them."""
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    seen = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=seen[1:])
    return points, seen[offsets]
