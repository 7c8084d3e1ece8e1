"""Token ids of documents in one long array per block, with Elias-Fano coded document boundaries."""

from __future__ import annotations

import struct
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow.llm import encoding, spans
from tallyflow.llm.encoding import CachedEncoder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAGIC = b"TKB1"
HEADER = "<4sBBHQQQ"  # magic, bytes per id, low bits, select step, documents, ids, upper bytes
BLOCK_IDS = 1 << 18
SELECT_STEP = 64


class EliasFano:
    """A rising sequence of n numbers up to a bound, in n * (2 + log2(bound / n)) bits.

    The low bits of each number are packed; its high part adds to a bit array with a one for each
    number and a zero for each step of the high part. ``select`` finds the place of a one from
    samples of every ``step``-th and a short scan.
    """

    def __init__(self, n: int, low_bits: int, low: np.ndarray, upper: np.ndarray, samples: np.ndarray, step: int):
        self.n, self.low_bits, self.low, self.upper, self.samples, self.step = n, low_bits, low, upper, samples, step

    @classmethod
    def encode(cls, values: np.ndarray, bound: int, step: int = SELECT_STEP) -> EliasFano:
        n = len(values)
        values = values.astype(np.uint64)
        low_bits = max(0, int(bound // n).bit_length() - 1) if n else 0
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        bits[ones] = 1
        return cls(n, low_bits, low, np.packbits(bits, bitorder="little"), ones[::step].astype(np.uint32), step)

    def select(self, k: int) -> int:
        """The place of the k-th one of the upper bits."""
        at = int(self.samples[k // self.step])
        left = k % self.step
        byte, within = divmod(at, 8)
        word = int(self.upper[byte]) >> within << within
        while left >= word.bit_count():
            left -= word.bit_count()
            byte += 1
            word = int(self.upper[byte])
        for _ in range(left):
            word &= word - 1
        return byte * 8 + (word & -word).bit_length() - 1

    def __getitem__(self, k: int) -> int:
        low = 0
        if self.low_bits:
            first = k * self.low_bits
            part = int.from_bytes(self.low[first // 8 : (first + self.low_bits + 7) // 8].tobytes(), "little")
            low = part >> first % 8 & ((1 << self.low_bits) - 1)
        return (self.select(k) - k) << self.low_bits | low

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.upper, bitorder="little"))[: self.n]
        high = (ones - np.arange(self.n)) << self.low_bits
        if not self.low_bits:
            return high
        bits = np.unpackbits(self.low, bitorder="little")[: self.n * self.low_bits].reshape(self.n, self.low_bits)
        return high + (bits.astype(np.int64) << np.arange(self.low_bits)).sum(axis=1)


def pack_block(ids: np.ndarray, ends: np.ndarray) -> bytes:
    """File image of a block: header, samples, low bits, upper bits, ids (2 bytes each if they fit)."""
    width = 2 if not len(ids) or int(ids.max()) < 1 << 16 else 4
    marks = EliasFano.encode(ends, len(ids))
    head = struct.pack(HEADER, MAGIC, width, marks.low_bits, marks.step, len(ends), len(ids), len(marks.upper))
    return b"".join([head, marks.samples.tobytes(), marks.low.tobytes(), marks.upper.tobytes(), ids.astype(f"<u{width}").tobytes()])


def unpack_block(block: bytes) -> tuple[EliasFano, np.ndarray]:
    """The ends of the block's documents among its ids, and the ids."""
    magic, width, low_bits, step, n, total, upper_bytes = struct.unpack_from(HEADER, block)
    if magic != MAGIC:
        raise ValueError("not a token block")
    at = struct.calcsize(HEADER)
    sizes = (-(-n // step) * 4, -(-n * low_bits // 8), upper_bytes, total * width)
    parts = []
    for size in sizes:
        parts.append(block[at : at + size])
        at += size
    samples, low, upper = np.frombuffer(parts[0], "<u4"), np.frombuffer(parts[1], np.uint8), np.frombuffer(parts[2], np.uint8)
    return EliasFano(n, low_bits, low, upper, samples, step), np.frombuffer(parts[3], f"<u{width}")


def write_token_store(
    docs: DataFrame,
    path: str,
    id: str = "doc_id",
    text: str = "text",
    end_id: int = 1,
    tokenizer: str | None = None,
    block_ids: int = BLOCK_IDS,
) -> None:
    """Encodes every whole text, adds ``end_id``, and writes the ids in ascending order of ``id``.

    The store is a Parquet folder that Spark writes, so it may be in any of its file systems. Each
    row is a block: the task's place in the order, the block's place in the task, the ids in the
    task before it, the documents' ids and the file image. A block ends with the document that
    brings it to ``block_ids``; a document is never cut. Texts are dealt out by ranges of the id
    and sorted there, so no task holds more than its range. A null or empty text has the end id
    alone; null ids come first; rows that repeat an id follow each other in order of their texts; an
    empty table gives an empty store. The order is one of the rows, so a lost task writes the same.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = CachedEncoder(tokenizer)
        part, number, before = TaskContext.get().partitionId(), 0, 0
        names: list = []
        held: list[np.ndarray] = []
        ends: list[int] = []
        used = 0

        def block() -> pa.RecordBatch:
            image = pack_block(np.concatenate(held), np.array(ends))
            row = {"part": part, "block": number, "before": before, "n_ids": used, "ids": names, "image": image}
            return pa.RecordBatch.from_pylist([row], schema=kind)

        kind = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("before", pa.int64()), ("n_ids", pa.int64()),
                          ("ids", pa.list_(pa.int64())), ("image", pa.binary())])
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for start, stop in spans.slices(batch.column(1), encoding.SLICE_BYTES):
                ids, cuts = encoder.encode_all(*spans.flat(batch.column(1)[start:stop]))
                for k in range(stop - start):
                    held.append(ids[cuts[k] : cuts[k + 1]])
                    held.append(np.array([end_id], np.uint32))
                    used += int(cuts[k + 1] - cuts[k]) + 1
                    ends.append(used)
                    names.append(keys[start + k])
                    if used >= block_ids:
                        yield block()
                        number, before, used = number + 1, before + used, 0
                        names, held, ends = [], [], []
            spans.release_memory()
        if ends:
            yield block()
        del encoder
        spans.release_memory()

    ordered = docs.select(F.col(id).cast("long").alias("_id"), F.col(text).alias("_text"))
    ordered = ordered.repartitionByRange(F.col("_id").asc_nulls_first()).sortWithinPartitions(
        F.col("_id").asc_nulls_first(), "_text"
    )
    schema = "part int, block int, before long, n_ids long, ids array<long>, image binary"
    ordered.mapInArrow(blocks, schema).write.option("compression", "zstd").parquet(path)


def read_token_store(spark: SparkSession, path: str, id: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids): ``start`` counts the ids of all documents before it, over the
    whole store; ``ids`` are little-endian unsigned 32-bit integers.

    Only one total for each writing task is gathered, to place the tasks one after the other.
    """
    blocks = spark.read.schema("part int, block int, before long, n_ids long, ids array<long>, image binary").parquet(path)
    totals = sorted((r["part"], r["n"]) for r in blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    first, at = {}, 0
    for part, n in totals:
        first[part] = at
        at += n

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                marks, ids = unpack_block(row["image"])
                ends = marks.all()
                starts = np.concatenate([[0], ends[:-1]])
                body = ids.astype("<u4").tobytes()
                cut = [body[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["ids"], pa.int64()), pa.array(starts + first[row["part"]] + row["before"]),
                     pa.array(ends - starts), pa.array(cut, pa.binary())],
                    ["_id", "start", "n_tokens", "ids"],
                )

    found = blocks.select("part", "before", "ids", "image").mapInArrow(
        documents, "_id long, start long, n_tokens long, ids binary"
    )
    return found.withColumnRenamed("_id", id)
