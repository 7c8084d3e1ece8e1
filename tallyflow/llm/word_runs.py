"""Periodic runs of words, from the maximal pairs of a bottom-up LCP-interval tree."""

from __future__ import annotations

import sys
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import ArrowUDFType, arrow_udf

from tallyflow.llm import spans
from tallyflow.llm.tables import whole_row

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Shortest run in words, and how often its period fits into it at least.
MIN_WORDS, EXPONENT = 6, 4
#: Places that wait to be merged into a node's long list.
LATE = 1000

RESULT = "n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def word_numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The same number for equal words; by the bytes themselves, not by a digest."""
    sizes = ends - starts
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    body = data[np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])]
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(body)])
    return words.dictionary_encode().indices.to_numpy().astype(np.int64)


class Suffixes:
    """Suffix order of many texts at once, no suffix beyond its text, and longest common prefixes.

    Ranks of the first 1, 2, 4, ... words by doubling. A place whose words so far occur once in its
    text is settled and leaves the sorting; ``order`` keeps only places that repeat ``least`` words.
    The ranks of every step stay, one 32-bit number a word and step, to read prefixes off them.
    """

    def __init__(self, words: np.ndarray, ranges: np.ndarray, least: int):
        n = len(words)
        text = np.repeat(np.arange(len(ranges) - 1), np.diff(ranges))
        self.stop = ranges[1:][text]
        self.levels: list[tuple[int, np.ndarray]] = []
        key = text * (int(words.max(initial=0)) + 1) + words
        order = np.argsort(key, kind="stable")
        rank = np.zeros(n, np.int64)
        open_, slots = self._grouped(order, key[order], np.arange(n), rank)
        self.order = np.zeros(0, np.int64)
        step, seeds = 1, None
        while len(open_):
            self.levels.append((step, rank.astype(np.int32 if n < 1 << 31 else np.int64)))
            if step * 2 > least and seeds is None:
                seeds = np.sort(open_)
            after = open_ + step
            inside = after < self.stop[open_]
            second = np.where(inside, rank[np.where(inside, after, 0)] + 1, 0)
            # open_ lies in the order of its ranks, so the sort moves places within their group's slots
            sub = np.lexsort((second, rank[open_]))
            open_, slots = self._grouped(open_[sub], (rank[open_] * (n + 1) + second)[sub], slots, rank)
            step *= 2
        if seeds is not None:
            self.order = seeds[np.argsort(rank[seeds])]

    @staticmethod
    def _grouped(order: np.ndarray, key: np.ndarray, slots: np.ndarray, rank: np.ndarray):
        """Sets the rank of each place to its group's first slot; returns groups of two or more with their slots."""
        if not len(order):
            return order, slots
        at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        sizes = np.diff(np.append(at, len(order)))
        rank[order] = np.repeat(slots[at], sizes)
        more = np.repeat(sizes > 1, sizes)
        return order[more], slots[more]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that the suffixes at ``a`` and ``b`` share, from the ranks of falling powers of two."""
        size = np.zeros(len(a), np.int64)
        last = len(self.stop) - 1
        for step, rank in reversed(self.levels):
            x, y = a + size, b + size
            inside = (x < self.stop[a]) & (y < self.stop[b])
            size += step * (inside & (rank[np.minimum(x, last)] == rank[np.minimum(y, last)]))
        return size


class Places:
    """The places below one interval in rising order; new ones wait in a short list of their own."""

    __slots__ = ("late", "main")

    def __init__(self, place: int):
        self.main, self.late = [place], []

    def __len__(self) -> int:
        return len(self.main) + len(self.late)

    def __iter__(self) -> Iterator[int]:
        yield from self.main
        yield from self.late

    def beside(self, place: int) -> Iterator[int]:
        """The nearest places on both sides."""
        for own in (self.main, self.late):
            at = bisect_left(own, place)
            if at:
                yield own[at - 1]
            if at < len(own):
                yield own[at]

    def add(self, others: Places) -> None:
        if len(others) * 8 > len(self) or len(others) > LATE:
            self.main = sorted([*self.main, *self.late, *others])
            self.late = []
            return
        for place in others:
            insort(self.late, place)
        if len(self.late) > LATE:
            self.main += self.late
            self.main.sort()  # two rising runs: linear
            self.late = []


def maximal_pairs(order, common, left, min_words: int = MIN_WORDS, exponent: int = EXPONENT):
    """{(start, length): period} of the maximal pairs that are runs, among places in suffix order.

    ``common[k]`` is the prefix shared by ``order[k]`` and ``order[k + 1]``; ``left`` gives the class of
    a place, the word to its left. The LCP intervals are closed bottom-up; where two children meet at depth l,
    places of different children share exactly l words, and if their left words differ the pair can't
    be prolonged on either side. At distance d it is a stretch of l + d words with period d.

    Only distances up to l / (exponent - 1) count, at most l / 2. Occurrences of one string that near
    to each other are equally spaced, and all but the first follow the same word, so the lists of the
    left-word classes are kept as one list in text order: the nearest place of
    another class is a neighbour, or there is none. Smaller lists are merged into larger ones. Pairs at a
    multiple of the period give the same stretch; the least distance is its period.
    """
    found: dict[tuple[int, int], int] = {}

    def joined(one: Places, other: Places, depth: int) -> Places:
        big, small = (one, other) if len(one) >= len(other) else (other, one)
        reach = depth // (exponent - 1)
        for place in small:
            for near in big.beside(place):
                distance = abs(place - near)
                if distance <= reach and distance + depth >= min_words and left[place] != left[near]:
                    stretch = (min(place, near), depth + distance)
                    found[stretch] = min(distance, found.get(stretch, distance))
        big.add(small)
        return big

    open_: list[tuple[int, Places]] = []
    node = Places(order[0])
    for place, depth in zip([*order[1:], None], [*common, -1], strict=True):
        while open_ and open_[-1][0] > depth:
            above, places = open_.pop()
            node = joined(places, node, above)
        if place is None:
            break
        if open_ and open_[-1][0] == depth:
            open_[-1] = (depth, joined(open_[-1][1], node, depth))
        else:
            open_.append((depth, node))
        node = Places(place)
    return found


def least_common(min_words: int, exponent: int) -> int:
    """The fewest words that the two places of a run's pair share."""
    return min(max(min_words - q, (exponent - 1) * q) for q in range(1, min_words + 1))


def runs_of_texts(words: np.ndarray, ranges: np.ndarray, min_words: int = MIN_WORDS, exponent: int = EXPONENT) -> np.ndarray:
    """(start, length, period) rows of all runs, starts counted over all texts, by start and period.

    Intervals below ``least_common`` words are never closed. Of the rest, those whose nearest two places are
    farther apart than their longest common prefix allows hold no run and are passed over.
    """
    none = np.zeros((0, 3), np.int64)
    least = least_common(min_words, exponent)
    suffixes = Suffixes(words, ranges, least)
    order = suffixes.order
    if len(order) < 2:
        return none
    common = suffixes.common(order[:-1], order[1:])
    cut = np.flatnonzero(common < least) + 1
    firsts = np.concatenate([[0], cut])
    cluster = np.zeros(len(order), np.int64)
    cluster[cut] = 1
    cluster = np.cumsum(cluster)
    in_text = np.lexsort((order, cluster))
    gap = np.diff(order[in_text], prepend=0)
    gap[firsts] = len(words)
    nearest = np.minimum.reduceat(gap, firsts)
    longest = np.maximum.reduceat(np.append(np.where(common < least, 0, common), 0), firsts)
    lasts = np.append(firsts[1:], len(order))
    left = np.concatenate([[-1], words[:-1]])
    left[ranges[:-1][ranges[:-1] < len(words)]] = -1
    found = []
    for k in np.flatnonzero(nearest * (exponent - 1) <= longest).tolist():
        a, b = int(firsts[k]), int(lasts[k])
        own = order[a:b].tolist()
        classes = dict(zip(own, left[order[a:b]].tolist(), strict=True))
        pairs = maximal_pairs(own, common[a : b - 1].tolist(), classes, min_words, exponent)
        found += [(start, length, period) for (start, length), period in pairs.items()]
    if not found:
        return none
    # a stretch may be met in several intervals, at different multiples of its period
    runs = np.array(found, np.int64)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.concatenate([[True], (runs[1:, :2] != runs[:-1, :2]).any(axis=1)])
    runs = runs[new]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def collapsed_texts(data, starts, ends, ranges, runs) -> pa.Array:
    """The words outside all runs' repeats, joined by one blank, of each text."""
    marks = np.zeros(len(starts) + 1, np.int64)
    np.add.at(marks, runs[:, 0] + runs[:, 2], 1)
    np.add.at(marks, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(marks[:-1]) == 0
    before = np.concatenate([[0], np.cumsum(kept)])[ranges]
    begin, sizes = starts[kept], (ends - starts)[kept] + 1
    at = np.concatenate([[0], np.cumsum(sizes)])
    body = np.append(data, np.uint8(32))[np.repeat(begin - at[:-1], sizes) + np.arange(at[-1])]
    body[at[1:] - 1] = 32
    counts = np.diff(before)
    full = np.flatnonzero(counts > 0)
    blank = np.ones(len(body), bool)
    blank[at[before[full + 1]] - 1] = False  # no blank after a text's last word
    lengths = at[before[1:]] - at[before[:-1]] - (counts > 0)
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    texts = pa.Array.from_buffers(pa.large_string(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(body[blank])])
    return texts.cast(pa.string())


def run_column(min_words: int, exponent: int):
    """A column function: text -> RESULT."""

    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            parts = []
            for a, b in spans.slices(column):
                data, offsets = spans.flat(column[a:b])
                starts, ends, ranges = spans.word_spans(data, offsets)
                runs = runs_of_texts(word_numbers(data, starts, ends), ranges, min_words, exponent)
                cuts = np.searchsorted(runs[:, 0], ranges)
                own = np.repeat(ranges[:-1], np.diff(cuts))
                items = pa.StructArray.from_arrays(
                    [pa.array(runs[:, 0] - own), pa.array(runs[:, 1]), pa.array(runs[:, 2])], fields=list(RUN)
                )
                lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), items)
                texts = collapsed_texts(data, starts, ends, ranges, runs)
                parts.append(pa.StructArray.from_arrays([pa.array(np.diff(ranges)), lists, texts], ["n_words", "runs", "collapsed"]))
            kind = pa.struct([("n_words", pa.int64()), ("runs", pa.list_(RUN)), ("collapsed", pa.string())])
            yield pa.concat_arrays([p.cast(kind) for p in parts]) if parts else pa.array([], kind)
            spans.release_memory()

    return arrow_udf(scan, RESULT, ArrowUDFType.SCALAR_ITER)


def with_runs(docs: DataFrame, text: str = "text", min_words: int = MIN_WORDS, exponent: int = EXPONENT) -> DataFrame:
    """The documents with ``n_words``, ``runs`` (start, length, period; by start, then period) and ``collapsed``.

    Words are what stands between ASCII white space, numbered from 0. A run is a stretch of neighbouring
    words whose smallest period fits into it ``exponent`` times (3 or more) and which has ``min_words``
    or more, as long as that period lasts. ``collapsed`` keeps a run's first period and the words outside runs.

    A null or empty text has no words, no run and an empty ``collapsed``. Every row is judged alone, so
    repeated rows, null ids and an empty table need no rule; input columns of the new names are replaced.
    Rows are mapped where they lie, without a shuffle; a task holds slices of spans.SLICE_BYTES, or
    one longer text with its ranks.
    """
    if exponent < 3:
        raise ValueError("exponent must be 3 or more")
    if min_words < 2:
        raise ValueError("min_words must be 2 or more")
    new = ("n_words", "runs", "collapsed")
    scanned = docs.select(whole_row(docs), run_column(min_words, exponent)(F.col(f"`{text}`")).alias("_found"))
    rest = [F.col(f"_row.`{c}`").alias(c) for c in docs.columns if c not in new]
    return scanned.select(*rest, *[F.col(f"_found.{c}").alias(c) for c in new])
