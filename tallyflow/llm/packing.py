"""Documents packed into training sequences by online bin packing with least sums of squares."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.llm import spans
from tallyflow.llm.encoding import SLICE_BYTES, CachedEncoder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEQUENCE = 4096
MOST_OPEN = 1024
PIECE = "_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class Piece:
    """Some neighbouring ids of one document."""

    __slots__ = ("doc", "start", "ids", "total")

    def __init__(self, doc, start: int, ids: np.ndarray, total: int):
        self.doc, self.start, self.ids, self.total = doc, start, ids, total

    def cut(self, at: int) -> tuple[Piece, Piece]:
        return (Piece(self.doc, self.start, self.ids[:at], self.total),
                Piece(self.doc, self.start + at, self.ids[at:], self.total))


class SumOfSquaresPacker:
    """Places each piece into the window that leaves the least sum of squared level counts.

    ``count[h]`` is the number of open windows that hold h ids. A piece of s ids in a window of level
    h takes one from count[h] and adds one to count[h + s], unless it fills the window; in a new window it
    adds one to count[s]. The least change of the sum of squares wins, the fullest window in a tie.

    Windows left open at the end, or when more than ``most_open`` are, are closed by cutting pieces:
    all of their ids in a row, in order of falling level, give full windows and one rest, and the
    rest is cut into windows of powers of two. So no window is padded, and few pieces are cut.
    """

    def __init__(self, size: int = SEQUENCE, most_open: int = MOST_OPEN):
        self.size, self.most_open = size, most_open
        self.count = np.zeros(size + 1, np.int64)
        self.windows: list[list[list[Piece]]] = [[] for _ in range(size + 1)]
        self.open = 0
        self.levels = np.arange(size + 1)

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        """Yields the windows that this piece fills."""
        while len(piece.ids) >= self.size:
            whole, piece = piece.cut(self.size)
            yield [whole]
            piece.ids = piece.ids.copy()  # the whole text isn't kept with it
        s = len(piece.ids)
        if not s:
            return
        level = self._level(s)
        if level:
            window = self.windows[level].pop()
            self.count[level] -= 1
            self.open -= 1
        else:
            window = []
        window.append(piece)
        if level + s == self.size:
            yield window
            return
        self.windows[level + s].append(window)
        self.count[level + s] += 1
        self.open += 1
        if self.open > self.most_open:
            yield from self.close()

    def _level(self, s: int) -> int:
        top = self.size - s
        count = self.count
        # change of the sum of squares: taking from h gives 1 - 2 N(h), adding to h + s gives 1 + 2 N(h + s)
        after = 2 * count[s : self.size + 1] + 1
        after[top] = 0  # full windows aren't counted
        change = after[: top + 1] - 2 * count[: top + 1] + 1
        change[0] = after[0]
        usable = count[: top + 1] > 0
        usable[0] = True
        best = np.where(usable, change, np.iinfo(np.int64).max)
        return int(top - np.argmin(best[::-1]))

    def close(self) -> Iterator[list[Piece]]:
        """Fills open windows by cutting pieces; powers of two for what is left."""
        rest: list[Piece] = []
        for level in range(self.size, 0, -1):
            for window in self.windows[level]:
                rest += window
            self.windows[level] = []
        self.count[:] = 0
        self.open = 0
        left = sum(len(p.ids) for p in rest)
        rest.reverse()
        while left:
            take = self.size if left >= self.size else 1 << left.bit_length() - 1
            left -= take
            window = []
            while take:
                piece = rest.pop()
                if len(piece.ids) > take:
                    piece, later = piece.cut(take)
                    rest.append(later)
                window.append(piece)
                take -= len(piece.ids)
            yield window


def pack_documents(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    end_id: int = 2,
    size: int = SEQUENCE,
    tokenizer: str | None = None,
) -> DataFrame:
    """One row per piece: (id, start, length, ids, doc_tokens, sequence_id, offset).

    A document is the ids of its whole text and ``end_id``; a null or empty text is ``end_id``
    alone. Each id lies in exactly one piece; ``ids`` are little-endian unsigned 32-bit integers.
    Each task packs the rows of its own input split in their order, so nothing is shuffled, and a task that
    runs again packs the same. Every sequence is full, or of a power of two at the end of a task, so
    none is padded. ``sequence_id`` has the task in its upper bits. Documents longer than
    ``size`` give full sequences and one shorter piece. Null ids and rows that repeat an id are documents
    of their own; an empty table has no pieces. Memory: at most MOST_OPEN open windows.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = CachedEncoder(tokenizer)
        packer = SumOfSquaresPacker(size)
        number = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []
        kind = pa.schema([("_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                          ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])

        def filled(windows: Iterator[list[Piece]]) -> None:
            nonlocal number
            for window in windows:
                at = 0
                for p in window:
                    n = len(p.ids)
                    rows.append((p.doc, p.start, n, p.ids.astype("<u4").tobytes(), p.total, number, at))
                    at += n
                number += 1

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind, strict=True)], schema=kind)

        end = np.array([end_id], np.uint32)
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for start, stop in spans.slices(batch.column(1), SLICE_BYTES):
                ids, cuts = encoder.encode_all(*spans.flat(batch.column(1)[start:stop]))
                for k in range(stop - start):
                    own = np.concatenate([ids[cuts[k] : cuts[k + 1]], end])
                    filled(packer.add(Piece(keys[start + k], 0, own, len(own))))
                if rows:
                    yield batch_of(rows)
                    rows = []
            spans.release_memory()
        filled(packer.close())
        for at in range(0, len(rows), 4096):
            yield batch_of(rows[at : at + 4096])
        del encoder, packer, rows
        spans.release_memory()

    narrow = docs.select(F.col(id).cast("long").alias("_id"), F.col(text).alias("_text"))
    return narrow.mapInArrow(pack, PIECE).withColumnRenamed("_id", id)
