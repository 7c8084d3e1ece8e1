"""Near-duplicate classes by ProbMinHash signatures of weighted shingles, banding and verification."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import ArrowUDFType, arrow_udf

from tallyflow.llm import spans
from tallyflow.llm.components import component_labels
from tallyflow.llm.tables import staged, text_or_empty

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WIDTH = 5
SIMILARITY = 0.8
#: 42 bands of 6 of the 256 registers: a pair at 0.8 is missed once in 300,000.
REGISTERS = 256
BAND_ROWS = 6
BANDS = REGISTERS // BAND_ROWS
#: Centres of a bucket in the second round; the third compares all pairs that agree in enough registers.
CENTRES = 4
#: Share of the pairs at the asked similarity that may agree in fewer registers than the third round asks for.
MISSED = 1e-6
#: Texts of a block of a bucket, on average.
BLOCK = 1024
STEP = np.uint64(0x9E3779B97F4A7C15)


def weighted_shingles(data: np.ndarray, offsets: np.ndarray):
    """Sorted digests of each text's different shingles, how often each occurs, and the texts' ranges."""
    lower = spans.LOWER[data]
    starts, ends, ranges = spans.word_spans(lower, offsets)
    shingles, cuts = spans.shingle_digests(spans.SpanDigests(lower)(starts, ends), ranges, WIDTH)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(cuts))
    order = np.lexsort((shingles, text))
    shingles, text = shingles[order], text[order]
    new = np.ones(len(shingles), bool)
    new[1:] = (shingles[1:] != shingles[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    return shingles[at], np.diff(np.append(at, len(shingles))), np.searchsorted(text[at], np.arange(len(offsets)))


def signatures(shingles: np.ndarray, weights: np.ndarray, ranges: np.ndarray) -> np.ndarray:
    """For each text and register, the shingle whose arrival there is the earliest.

    The arrivals of a shingle are a Poisson process with its weight as rate, each at a register
    chosen by chance; both follow from the shingle's digest alone. A shingle is done with when its
    next arrival comes after the last of the text's registers was taken.
    """
    texts = len(ranges) - 1
    first = np.full(texts * REGISTERS, np.inf)
    winner = np.zeros(texts * REGISTERS, np.uint64)
    owner = np.repeat(np.arange(texts), np.diff(ranges))
    active = np.arange(len(shingles))
    clock = np.zeros(len(shingles))
    step = 0
    while len(active):
        many = int(np.clip(30_000 // len(active), 1, 64))
        turns = (np.arange(step + 1, step + many + 1, dtype=np.uint64) * STEP)[None, :]
        bits = spans.mixed_bits(shingles[active][:, None] + turns)
        gaps = -np.log(((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weights[active][:, None]
        times = clock[active][:, None] + np.cumsum(gaps, axis=1)
        place = owner[active][:, None] * REGISTERS + (bits & np.uint64(REGISTERS - 1)).astype(np.int64)
        early = times < first[place]
        at, when = place[early], times[early]
        np.minimum.at(first, at, when)
        won = first[at] == when
        winner[at[won]] = np.broadcast_to(shingles[active][:, None], early.shape)[early][won]
        clock[active] = times[:, -1]
        last = first.reshape(texts, REGISTERS).max(axis=1)
        active = active[clock[active] < last[owner[active]]]
        step += many
    return winner.reshape(texts, REGISTERS)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum over common elements d of 1 / sum over all e of max(a_e / a_d, b_e / b_d)."""
    keys = np.union1d(a[0], b[0])
    x, y = np.zeros(len(keys)), np.zeros(len(keys))
    x[np.searchsorted(keys, a[0])] = a[1]
    y[np.searchsorted(keys, b[0])] = b[1]
    if not len(keys):
        return 0.0
    ratio = np.full(len(keys), np.inf)
    np.divide(x, y, out=ratio, where=y > 0)
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    above = x.sum() - np.cumsum(x)
    below = np.cumsum(y)
    upto = np.searchsorted(ratio, ratio, "right") - 1
    both = (x > 0) & (y > 0)
    return float((1.0 / (above[upto][both] / x[both] + below[upto][both] / y[both])).sum())


def least_agreeing(similarity: float) -> int:
    """So many registers agree for all but MISSED of the pairs at ``similarity``; registers agree independently."""
    if not 0 < similarity < 1:
        return REGISTERS if similarity >= 1 else 0
    below = 0.0
    for k in range(REGISTERS + 1):
        chance = math.lgamma(REGISTERS + 1) - math.lgamma(k + 1) - math.lgamma(REGISTERS - k + 1)
        below += math.exp(chance + k * math.log(similarity) + (REGISTERS - k) * math.log(1 - similarity))
        if below > MISSED:
            return k
    return REGISTERS


def bands_column():
    """A column function: text -> BANDS digests, none without words, and a byte of each register."""
    kind = [pa.field("bands", pa.list_(pa.int64())), pa.field("sketch", pa.binary())]

    def sign(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            parts = []
            for start, stop in spans.slices(column):
                shingles, weights, ranges = weighted_shingles(*spans.flat(column[start:stop]))
                winners = signatures(shingles, weights.astype(np.float64), ranges)
                full = np.diff(ranges) > 0
                band = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(winners), BANDS))
                for k in range(BAND_ROWS):
                    band = band * np.uint64(spans.BASE) + winners[:, k : BANDS * BAND_ROWS : BAND_ROWS]
                band = spans.mixed_bits(band)[full].astype(np.int64)
                ends = np.concatenate([[0], np.cumsum(full * BANDS)]).astype(np.int32)
                bands = pa.ListArray.from_arrays(pa.array(ends), pa.array(band.ravel()))
                sketch = spans.mixed_bits(winners[full]).astype(np.uint8)
                ends = np.concatenate([[0], np.cumsum(full * REGISTERS)]).astype(np.int32)
                sketch = pa.Array.from_buffers(pa.binary(), len(full), [None, pa.py_buffer(ends), pa.py_buffer(sketch.tobytes())])
                parts.append(pa.StructArray.from_arrays([bands, sketch], fields=kind))
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.struct(kind))
            spans.release_memory()

    return arrow_udf(sign, "struct<bands:array<bigint>,sketch:binary>", ArrowUDFType.SCALAR_ITER).asNondeterministic()


def similarity_column():
    """A column function: (id a, text a, text b) -> probability Jaccard of their weighted shingles."""

    def vectors(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        out = []
        for start, stop in spans.slices(column):
            shingles, weights, ranges = weighted_shingles(*spans.flat(column[start:stop]))
            out += [(shingles[i:j], weights[i:j].astype(np.float64)) for i, j in zip(ranges[:-1], ranges[1:], strict=True)]
        return out

    def compare(ids: pa.Array, a: pa.Array, b: pa.Array) -> pa.Array:
        found = []
        for start, stop in spans.slices(b):
            keys, at, which = np.unique(ids[start:stop].to_numpy(zero_copy_only=False), return_index=True, return_inverse=True)
            centres = vectors(a[start:stop].take(pa.array(at)))
            found += [probability_jaccard(centres[c], v) for c, v in zip(which, vectors(b[start:stop]), strict=True)]
        spans.release_memory()
        return pa.array(found, pa.float64())

    # not deterministic to the planner, which would else compare again for the filter
    return arrow_udf(compare, "double", ArrowUDFType.SCALAR).asNondeterministic()


def _starred(rows: DataFrame, order: list, centres: int) -> DataFrame:
    """Pairs (a, b) of each bucket's first texts in ``order`` with its others of different classes."""
    best = Window.partitionBy("bucket").orderBy(*order)
    chosen = (
        rows.withColumn("_rank", F.row_number().over(best))
        .where(F.col("_rank") <= centres)
        .select("bucket", F.col("rep").alias("a"), F.col("label").alias("_a_label"))
    )
    met = rows.join(chosen, "bucket").where((F.col("rep") != F.col("a")) & (F.col("label") != F.col("_a_label")))
    return met.select("a", F.col("rep").alias("b")).distinct()


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose shingles are as similar as asked for."""
    full = pairs.join(texts.withColumnsRenamed({"_id": "b", "_text": "_tb"}), "b").join(
        texts.withColumnsRenamed({"_id": "a", "_text": "_ta"}), "a"
    )
    scored = full.select("a", "b", similarity_column()(F.col("a"), F.col("_ta"), F.col("_tb")).alias("similarity"))
    return staged(scored.where(F.col("similarity") >= similarity))


def _joined_labels(links: DataFrame, labels: DataFrame) -> DataFrame:
    """Components of new links and of what has been joined before."""
    if links.isEmpty():
        return labels
    before = labels.where("node != label").select(F.col("node").alias("a"), F.col("label").alias("b"))
    return component_labels(links.select("a", "b").unionAll(before))


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    known = rows.drop("label").join(labels, F.col("rep") == F.col("node"), "left")
    return staged(known.withColumn("label", F.coalesce("label", "rep")).drop("node"))


def agreeing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """In how many bytes the sketches (rows) agree."""
    lanes = (x == y).view(np.uint64).sum(axis=1, dtype=np.uint64)
    half = np.uint64(0x00FF00FF00FF00FF)
    lanes = (lanes & half) + ((lanes >> np.uint64(8)) & half)
    return ((lanes * np.uint64(0x0001000100010001)) >> np.uint64(48)).astype(np.int64)


def vector_column():
    """A column function: text -> its sorted shingle digests and their counts, as bytes."""
    kind = [pa.field("keys", pa.binary()), pa.field("counts", pa.binary())]

    def vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            keys, counts = [], []
            for start, stop in spans.slices(column):
                shingles, weights, ranges = weighted_shingles(*spans.flat(column[start:stop]))
                weights = weights.astype(np.uint32)
                for a, b in zip(ranges[:-1], ranges[1:], strict=True):
                    keys.append(shingles[a:b].tobytes())
                    counts.append(weights[a:b].tobytes())
            yield pa.StructArray.from_arrays([pa.array(keys, pa.binary()), pa.array(counts, pa.binary())], fields=kind)
            spans.release_memory()

    return arrow_udf(vectors, "struct<keys:binary,counts:binary>", ArrowUDFType.SCALAR_ITER).asNondeterministic()


def candidates(k: int, last: int, label, own, cross, bands, band, sketch, least: int) -> np.ndarray:
    """Rows in (k, last) that row k of the same group is compared with, those that agree in most registers first.

    Their classes differ, their blocks too where the group is one of two blocks, enough registers agree, and no
    earlier band does, so that each pair is compared in one bucket only.
    """
    others = np.arange(k + 1, last)
    others = others[label[others] != label[k]]
    if cross[k]:
        others = others[own[others] != own[k]]
    if not len(others):
        return others
    agree = agreeing(sketch[others], sketch[k])
    others, agree = others[agree >= least], agree[agree >= least]
    first = (bands[others] == bands[k]).argmax(axis=1) == band[k]
    return others[first][np.argsort(-agree[first], kind="stable")]


def _by_group(found, schema: pa.Schema):
    """A function over batches in order of ``group`` that calls ``found`` with whole groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            group = rows.column("group").to_numpy()
            last = int(np.searchsorted(group, group[-1]))
            # the last group may go on in the next batch
            held = rows.slice(last)
            if last:
                yield pa.RecordBatch.from_pydict(found(rows.slice(0, last)), schema)
        if held is not None:
            yield pa.RecordBatch.from_pydict(found(held), schema)
        spans.release_memory()

    return run


def _columns(rows: pa.Table):
    names = ("group", "rep", "label", "own", "cross", "band")
    group, rep, label, own, cross, band = (rows.column(c).to_numpy(zero_copy_only=False) for c in names)
    sketch = spans.flat(rows.column("sketch"))[0].reshape(-1, REGISTERS)
    bands = rows.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    return group, rep, label.copy(), own, cross, band, sketch, bands, starts, np.append(starts[1:], len(group))


def _met(least: int):
    """(group, rep) of the rows that agree enough with another row of their group."""

    def found(rows: pa.Table) -> dict:
        group, rep, label, own, cross, band, sketch, bands, starts, ends = _columns(rows)
        wanted = np.zeros(len(group), bool)
        for start, end in zip(starts.tolist(), ends.tolist(), strict=True):
            for k in range(start, end - 1):
                with_k = candidates(k, end, label, own, cross, bands, band, sketch, least)
                if len(with_k):
                    wanted[k] = wanted[with_k] = True
        return {"group": group[wanted], "rep": rep[wanted]}

    return _by_group(found, pa.schema([("group", pa.int64()), ("rep", pa.int64())]))


def _links(least: int, similarity: float):
    """Verified links (a, b) of each group that join two of its classes: fewer than its rows."""

    def found(rows: pa.Table) -> dict:
        group, rep, label, own, cross, band, sketch, bands, starts, ends = _columns(rows)
        keys, counts = rows.column("keys"), rows.column("counts")
        out: list[tuple[int, int]] = []
        for start, end in zip(starts.tolist(), ends.tolist(), strict=True):
            vectors: dict[int, tuple[np.ndarray, np.ndarray]] = {}

            def vector(k: int):
                if k not in vectors:
                    body, weights = keys[k].as_buffer(), counts[k].as_buffer()
                    vectors[k] = np.frombuffer(body, np.uint64), np.frombuffer(weights, np.uint32).astype(np.float64)
                return vectors[k]

            mine = label[start:end]
            for k in range(start, end - 1):
                for j in candidates(k, end, label, own, cross, bands, band, sketch, least).tolist():
                    if label[j] != label[k] and probability_jaccard(vector(k), vector(j)) >= similarity:
                        out.append((min(rep[k], rep[j]), max(rep[k], rep[j])))
                        mine[mine == label[j]] = label[k]
        return {"a": [a for a, _ in out], "b": [b for _, b in out]}

    return _by_group(found, pa.schema([("a", pa.int64()), ("b", pa.int64())]))


def _verified_in_blocks(rows: DataFrame, texts: DataFrame, wanted: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b), a < b, that join all texts of one bucket and different classes that are similar enough.

    Large buckets are cut into blocks by chance, and each two blocks are compared by themselves, so no
    task has a whole bucket. A first pass over the sketches names the texts that agree enough with another one;
    only their shingles travel to the second, which verifies pairs where they meet, those whose classes
    it has joined left out. So a group writes fewer links than it has rows, however many of its pairs agree.
    """
    several = rows.groupBy("bucket").agg(F.min("label").alias("_l"), F.max("label").alias("_m"), F.count(F.lit(1)).alias("_size"))
    several = several.where("_l != _m").select("bucket", F.ceil(F.col("_size") / BLOCK).cast("int").alias("_blocks"))
    own = F.pmod(F.xxhash64("rep", "bucket"), F.col("_blocks")).cast("int")
    met = rows.join(several, "bucket").select("bucket", "rep", "label", own.alias("own"), "_blocks")
    signs = texts.where(F.col("rep").isNotNull()).select("rep", "sketch", "bands")
    signed = met.join(signs, "rep").withColumn("band", F.array_position("bands", F.col("bucket")) - 1)
    dealt = signed.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    group = F.xxhash64("bucket", F.least("own", "_other"), F.greatest("own", "_other"))
    keyed = dealt.select(
        group.alias("group"), "own", (F.col("own") != F.col("_other")).alias("cross"), "rep", "label", "band", "sketch", "bands"
    )
    least = least_agreeing(similarity)
    ordered = keyed.repartition("group").sortWithinPartitions("group", "rep")
    agreeing_rows = staged(ordered.mapInArrow(_met(least), "group long, rep long"))
    reps = agreeing_rows.select(F.col("rep").alias("_id")).distinct()
    vectors = wanted.join(reps, "_id", "left_semi").select(F.col("_id").alias("rep"), vector_column()(F.col("_text")).alias("_v"))
    vectors = staged(vectors.select("rep", "_v.*"))
    full = keyed.join(agreeing_rows, ["group", "rep"]).join(vectors, "rep")
    full = full.repartition("group").sortWithinPartitions("group", "rep")
    return staged(full.mapInArrow(_links(least, similarity), "a long, b long"))


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """(id, class_id, copies, n_links) for every document.

    Documents are of one class if their texts are equal or if links between different texts join
    them. A link is a verified probability Jaccard of at least ``similarity`` over shingles of five
    words (split at ASCII white space, A-Z lower-cased), weighted by how often they occur; a text
    of one to four words has one shingle of all. ``class_id`` is the smallest id of the class,
    ``copies`` the number of documents with the same text, ``n_links`` the links that joined it.
    Null texts are empty, all empty texts are one class; texts of white space only meet by equality.
    Null ids are left out of candidates but get their own class unless their text has another holder.
    Rows that repeat an id stay rows; an empty table gives an empty one.

    Equal texts are one text from the start: its smallest id stands for it. Texts that share a band
    meet in a bucket. In a bucket, texts are compared with its centre, the text with the most
    neighbours over all buckets, so a large group of copies costs one comparison for each member.
    Where a bucket still holds several classes, its next centres follow. Then all pairs of a bucket that
    are of different classes are compared by their registers, and those that agree in enough of them are
    verified where they meet, unless their texts were joined before. A pair at ``similarity`` is lost if it shares no band, or agrees in too few registers
    (MISSED); none for the size of its buckets.
    """
    signed = docs.select(
        F.col(id).cast("long").alias("_id"), F.md5(text_or_empty(text)).alias("_digest"), F.col(text).alias("_text")
    )
    own = staged(signed.select("_id", "_digest", bands_column()(F.col("_text")).alias("_signed")))
    texts = staged(
        own.groupBy("_digest").agg(
            F.min("_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.any_value("_signed").alias("_signed")
        ).select("_digest", "rep", "copies", "_signed.*")
    )
    rows = texts.where(F.col("rep").isNotNull()).select("rep", F.explode("bands").alias("bucket"))
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    rows = staged(rows.join(sizes, "bucket"))
    degrees = rows.groupBy("rep").agg(F.sum("size").alias("degree"))
    rows = staged(rows.select("bucket", "rep").join(degrees, "rep").withColumn("label", F.col("rep")))
    members = rows.select(F.col("rep").alias("_rep")).distinct().hint("merge")
    wanted = signed.select("_id", "_text").join(members, F.col("_id") == F.col("_rep"), "left_semi")
    wanted = staged(wanted.dropDuplicates(["_id"]))

    by_degree = [F.desc("degree"), F.col("rep")]
    pairs = staged(_starred(rows, by_degree, 1))
    first = _verified(pairs, wanted, similarity)
    labels = component_labels(first.select("a", "b"))
    rows = _labelled(rows, labels)
    again = staged(_starred(rows, by_degree, CENTRES).join(pairs, ["a", "b"], "left_anti"))
    second = _verified(again, wanted, similarity)
    labels = _joined_labels(second, labels)
    third = _verified_in_blocks(_labelled(rows, labels), texts, wanted, similarity)
    labels = _joined_labels(third, labels)
    links = first.unionAll(second).select("a", "b").unionAll(third)

    links = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    ends = F.explode(F.array("a", "b")).alias("node")
    degree = links.select(ends).groupBy("node").agg(F.count(F.lit(1)).alias("_links"))
    known = labels.join(degree, "node")
    classes = texts.select("_digest", "copies", "rep").join(known, F.col("rep") == F.col("node"), "left")
    classes = staged(classes.select(
        "_digest", "copies", F.coalesce("label", "rep").alias("class_id"), F.coalesce("_links", F.lit(0)).alias("n_links")
    ))
    return own.select("_id", "_digest").join(classes, "_digest").select(F.col("_id").alias(id), "class_id", "copies", "n_links")


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One document of each class, that with the smallest id; columns as before.

    Rows that repeat the id and text of the one kept are kept too where they differ in another column.
    """
    found = near_duplicates(docs.select(id, text), id, text, similarity)
    gone = found.where(F.col(id) != F.col("class_id")).select(F.col(id).alias("_gone")).distinct()
    return docs.join(gone, docs[id] == gone["_gone"], "left_anti")
