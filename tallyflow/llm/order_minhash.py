"""Order MinHash fingerprints: signatures of texts that follow their edit distance."""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.llm import spans
from tallyflow.llm.tables import staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Units in a k-mer, k-mers in a tuple, tuples in a fingerprint, bytes of a long word in a unit.
K = 2
PICK = 2
TUPLES = 64
UNIT_BYTES = 4
FEATURE_CHUNK = 1 << 15


def _multipliers(n: int, seed: int) -> np.ndarray:
    numbers = np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)
    return spans.mixed_bits(numbers * np.uint64(spans.BASE)) | np.uint64(1)


def unit_digests(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Digests of the words of each text; words over UNIT_BYTES go in pieces of that many bytes."""
    starts, ends, ranges = spans.word_spans(data, offsets)
    parts = -(-(ends - starts) // UNIT_BYTES)
    if len(parts) and parts.max() > 1:
        before = np.concatenate([[0], np.cumsum(parts)])
        within = np.arange(before[-1]) - np.repeat(before[:-1], parts)
        starts, ends = np.repeat(starts, parts) + within * UNIT_BYTES, np.repeat(ends, parts)
        ends = np.minimum(starts + UNIT_BYTES, ends)
        ranges = before[ranges]
    return spans.SpanDigests(data)(starts, ends), ranges


def occurrence_numbered(kmers: np.ndarray) -> np.ndarray:
    """Digests of (k-mer, how many equal ones stand before it), in text order."""
    order = np.argsort(kmers, kind="stable")
    ranked = kmers[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    first = np.maximum.accumulate(np.where(new, np.arange(len(ranked)), 0))
    count = np.empty(len(kmers), np.uint64)
    count[order] = (np.arange(len(ranked)) - first).astype(np.uint64)
    return spans.mixed_bits(kmers + count * np.uint64(0xD1B54A32D192ED03))


def signature(features: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """For each factor, the PICK features that it hashes lowest, in text order, as a 16-bit digest.

    A text with fewer features has them all in each tuple; one without any has the zero tuple.
    """
    n = len(features)
    if not n:
        return np.zeros(len(factors), np.uint16)
    pick = min(PICK, n)
    best = np.full((len(factors), 0), 0, np.int64)
    low = np.zeros((len(factors), 0), np.uint64)
    for at in range(0, n, FEATURE_CHUNK):
        part = features[at : at + FEATURE_CHUNK]
        hashed = part[None, :] * factors[:, None]
        for _ in range(min(pick, len(part))):
            place = hashed.argmin(axis=1)
            rows = np.arange(len(factors))
            best = np.concatenate([best, (place + at)[:, None]], axis=1)
            low = np.concatenate([low, hashed[rows, place][:, None]], axis=1)
            hashed[rows, place] = np.uint64(0xFFFFFFFFFFFFFFFF)
        if best.shape[1] > pick:
            keep = np.lexsort((best, low), axis=1)[:, :pick]
            best, low = np.take_along_axis(best, keep, 1), np.take_along_axis(low, keep, 1)
    best = np.sort(best, axis=1)
    digest = np.full(len(factors), np.uint64(pick))
    for k in range(pick):
        digest = spans.mixed_bits(digest * np.uint64(spans.BASE) + features[best[:, k]])
    return (digest >> np.uint64(48)).astype(np.uint16)


def fingerprints(texts: list[bytes], factors: np.ndarray) -> list[np.ndarray]:
    """The signatures of UTF-8 texts."""
    column = pa.array(texts, pa.binary())
    out = []
    for start, stop in spans.slices(column):
        units, ranges = unit_digests(*spans.flat(column[start:stop]))
        kmers, cuts = spans.shingle_digests(units, ranges, K)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            out.append(signature(occurrence_numbered(kmers[a:b]) if b > a else kmers[a:b], factors))
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of equal tuples, which estimates the order-aware similarity."""
    return float(np.mean(a == b))


def as_text(print_: np.ndarray) -> str:
    return print_.astype(">u2").tobytes().hex()


def edited(text: str, next_text: str) -> str:
    """The last quarter of the code points replaced by as many (or all) first ones of the next text."""
    n = len(text) // 4
    return text[: len(text) - n] + next_text[:n]


ROW = (
    "_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    "near_edited double, near_next double, part int, edge int, edge_text string"
)


def fingerprint_report(docs: DataFrame, id: str = "doc_id", text: str = "text", seed: int = 5) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and likenesses.

    The edited text takes its last quarter from the next document in ascending order of the id
    (after the last: the first), ``near_next`` compares with that document. Texts are dealt out by
    ranges of the id and sorted there once. Each task pairs neighbours as they pass; the first and
    last text of a task go to a table of task ends, one row each, from which the pairs across
    tasks are made. A single document is its own next. Null texts are empty; null ids come first; rows that
    repeat an id follow in order of their texts; an empty table gives an empty report. Texts
    without words have one fixed fingerprint, so equal texts always agree.
    """

    def rows_of(pairs: list[tuple], factors: np.ndarray) -> list[tuple]:
        """From (id, text, next text), where the next text is mostly that of the next entry."""
        texts, plan = [], []
        for _, own, following in pairs:
            changed = edited(own, following)
            plan.append((len(texts), changed))
            texts += [own.encode(), changed.encode()]
        prints = fingerprints(texts, factors)
        out = []
        for k, (key, own, following) in enumerate(pairs):
            at, changed = plan[k]
            mine, other = prints[at], prints[at + 1]
            if k + 1 < len(pairs) and pairs[k + 1][1] == following:
                after = prints[at + 2]
            else:
                after = fingerprints([following.encode()], factors)[0]
            digest = hashlib.sha256(changed.encode()).hexdigest()
            out.append((key, len(own), digest, as_text(mine), as_text(other), likeness(mine, other), likeness(mine, after)))
        return out

    kind = pa.schema([
        ("_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
        ("part", pa.int32()), ("edge", pa.int32()), ("edge_text", pa.string()),
    ])

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind, strict=True)], schema=kind)

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = _multipliers(TUPLES, seed)
        part = TaskContext.get().partitionId()
        held = None
        for batch in batches:
            for start, stop in spans.slices(batch.column(1)):
                keys = batch.column(0)[start:stop].to_pylist()
                texts = [t or "" for t in batch.column(1)[start:stop].to_pylist()]
                pairs = []
                for key, own in zip(keys, texts, strict=True):
                    if held is None:
                        yield batch_of([(key, None, None, None, None, None, None, part, 0, own)])
                    else:
                        pairs.append((*held, own))
                    held = (key, own)
                if pairs:
                    yield batch_of([(*row, part, None, None) for row in rows_of(pairs, factors)])
        if held is not None:
            yield batch_of([(held[0], None, None, None, None, None, None, part, 1, held[1])])

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = _multipliers(TUPLES, seed)
        for batch in batches:
            for row in batch.to_pylist():
                found = rows_of([(row["_id"], row["edge_text"], row["following"])], factors)
                yield batch_of([(*found[0], None, None, None)])

    narrow = docs.select(F.col(id).cast("long").alias("_id"), F.col(text).alias("_text"))
    order = F.col("_id").asc_nulls_first()
    sorted_docs = narrow.repartitionByRange(order).sortWithinPartitions(order, "_text")
    done = staged(sorted_docs.mapInArrow(inside, ROW))
    first = done.where("edge = 0").select("part", F.col("edge_text").alias("following"))
    last = done.where("edge = 1").select("_id", "part", "edge_text")
    parts = sorted(r["part"] for r in first.select("part").collect())
    following = {p: parts[(k + 1) % len(parts)] for k, p in enumerate(parts)}
    spark = docs.sparkSession
    table = spark.createDataFrame([(int(p), int(q)) for p, q in following.items()], "part int, next_part int")
    pairs = last.join(table, "part").join(first.withColumnRenamed("part", "next_part"), "next_part")
    stitched = pairs.select("_id", "edge_text", "following").mapInArrow(across, ROW)
    both = done.where(F.col("edge").isNull()).unionByName(stitched)
    return both.drop("part", "edge", "edge_text").withColumnRenamed("_id", id)
