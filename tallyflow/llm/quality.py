"""Quality rules: counts of a text, and perplexity bands by language under a language model.

The model of each language is an interpolated modified Kneser-Ney model of order 4 over the code
points of its texts, none of them merged. Spark counts the n-grams of all texts and fits the model
as tables that are partitioned by n-gram or context and grow with the input; nothing of it passes
through the driver. Texts lie in blocks of about 32 MB. Each block asks for its distinct n-grams
and receives their log probabilities, which its task keeps as an array sorted by hash.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyflow.llm import spans
from tallyflow.llm.tables import staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ORDER = 4
#: Bits of a code point in an n-gram's two numbers, which hold its first one and its last three.
POINT_BITS = 21
#: Bytes of text in a block.
BLOCK = 1 << 25
#: The alphabet that the plain form ``fit_kneser_ney`` packs into one number.
CLASSES = 32
BITS = 5
#: Fences of a language: this many quartile distances beyond the quartiles of the log perplexity of a word,
#: with a least distance so that a language of a few like documents rejects no others.
FENCE = 4.0
LEAST_SPREAD = 0.1

SYMBOLS = spans.byte_set(b"#*$%&|<>")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SCORE_TYPE = f"struct<{','.join(f'{c}:bigint' for c in COUNTS)},log_perplexity:double>"


@dataclass
class Grams:
    """N-grams as two numbers each, with their language's hash and a count."""

    lang: np.ndarray
    high: np.ndarray
    low: np.ndarray
    n: np.ndarray

    def keys(self) -> np.ndarray:
        """A hash of each n-gram and its language."""
        mixed = spans.mixed_bits(self.low.view(np.uint64) ^ spans.mixed_bits(self.lang.view(np.uint64)))
        return spans.mixed_bits(mixed + self.high.view(np.uint64)).view(np.int64)

    def distinct(self, keys: np.ndarray | None = None) -> Grams:
        first, group = _groups(self.keys() if keys is None else keys)
        n = np.bincount(group, weights=self.n, minlength=len(first)).astype(np.int64)
        return Grams(self.lang[first], self.high[first], self.low[first], n)

    def in_order(self) -> Grams:
        by = np.lexsort((self.low, self.high, self.lang))
        return Grams(self.lang[by], self.high[by], self.low[by], self.n[by])

    @staticmethod
    def together(parts: list[Grams]) -> Grams:
        return Grams(*[np.concatenate([getattr(p, name) for p in parts]) for name in ("lang", "high", "low", "n")])


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct key, and the number of its key for each place."""
    coded = pa.array(keys).dictionary_encode()
    group = coded.indices.to_numpy()
    first = np.zeros(len(coded.dictionary), np.int64)
    first[group] = np.arange(len(group))
    return first, group


def point_grams(data: np.ndarray, offsets: np.ndarray, langs: np.ndarray) -> tuple[Grams, np.ndarray]:
    """The n-gram that ends at each code point, with ends of text before each text; the texts' ranges.

    A code point counts from 1; 0 is the place before the text.
    """
    points, ranges = spans.code_points(data, offsets)
    counts = np.diff(ranges)
    pad = ORDER - 1
    padded = np.zeros(len(points) + pad * len(counts), np.int64)
    place = np.arange(len(points)) + pad * (np.repeat(np.arange(len(counts)), counts) + 1)
    padded[place] = points.astype(np.int64) + 1
    at = [padded[place - pad + k] for k in range(ORDER)]
    low = at[1] << 2 * POINT_BITS | at[2] << POINT_BITS | at[3]
    lang = np.repeat(langs.astype(np.int64), counts)
    return Grams(lang, at[0], low, np.ones(len(low), np.int64)), ranges


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Slices of the rows with the number of their block, which depends on the task and the texts' sizes alone."""
    block, size = TaskContext.get().partitionId() << 32, 0
    for batch in batches:
        lengths = spans.text_lengths(batch.column("_text"))
        for start, stop in spans.slices(batch.column("_text")):
            yield block, batch.slice(start, stop - start)
            size += int(lengths[start:stop].sum())
            if size >= BLOCK:
                block, size = block + 1, 0


def _grams_of(batch: pa.RecordBatch) -> tuple[Grams, np.ndarray]:
    langs = batch.column("_l").to_numpy(zero_copy_only=False)
    return point_grams(*spans.flat(batch.column("_text")), langs)


def _asked(rows: DataFrame) -> DataFrame:
    """The distinct n-grams of each block with their counts, in order."""

    def counted(block: int, found: list[Grams]) -> Iterator[pa.RecordBatch]:
        grams = Grams.together(found).distinct().in_order()
        for at in range(0, len(grams.n), 1 << 16):
            to = slice(at, at + (1 << 16))
            values = [pa.array(v[to]) for v in (grams.lang, grams.high, grams.low, grams.n)]
            numbers = pa.array(np.full(len(values[0]), block))
            yield pa.RecordBatch.from_arrays([numbers, *values], ["_block", "_l", "_high", "_low", "_n"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, found, held = None, [], 0
        for block, batch in _blocks(batches):
            if found and block != now:
                yield from counted(now, found)
                found, held = [], 0
            now = block
            found.append(_grams_of(batch)[0].distinct())
            held += len(found[-1].n)
            if held > 1 << 20:
                found, held = [Grams.together(found).distinct()], 0
        if found:
            yield from counted(now, found)
        spans.release_memory()

    return staged(rows.mapInArrow(ask, "_block long, _l long, _high long, _low long, _n long"))


def _pieces(rows: DataFrame) -> DataFrame:
    """The rows in compressed pieces of blocks, which keep the shuffle of the texts small."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))
        for block, batch in _blocks(batches):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema, options=options) as out:
                out.write_batch(batch)
            piece = pa.array([sink.getvalue().to_pybytes()], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([block]), piece], ["_block", "_piece"])

    return rows.mapInArrow(pack, "_block long, _piece binary")


def _discount_columns(grams: DataFrame) -> DataFrame:
    """(_l, _d1, _d2, _d3, _size): what ``_discounts`` says of each language's counts, and their number."""
    ones = [F.count_if(F.col("_n") == k).cast("double").alias(f"_n{k}") for k in (1, 2, 3, 4)]
    n1, n2, n3, n4 = (F.col(f"_n{k}") for k in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2)
    told = F.least(n1, n2, n3, n4) > 0

    def clipped(value: Column, most: float) -> Column:
        return F.when(told, F.greatest(F.lit(0.05), F.least(F.lit(most), value))).otherwise(0.5)

    return grams.groupBy("_l").agg(*ones, F.count(F.lit(1)).alias("_size")).select(
        "_l",
        clipped(1 - 2 * y * F.try_divide(n2, n1), 0.95).alias("_d1"),
        clipped(2 - 3 * y * F.try_divide(n3, n2), 1.95).alias("_d2"),
        clipped(3 - 4 * y * F.try_divide(n4, n3), 2.95).alias("_d3"),
        "_size",
    )


def fit_tables(counts: DataFrame) -> DataFrame:
    """(_l, _high, _low, _log) for the n-grams (_l, _high, _low, _n) of each language.

    Lower orders count distinct continuations. Every suffix of an n-gram is an n-gram of the lower
    order, so each order joins the one below; a context's sums are a window over at most as many
    rows as there are code points.
    """
    tables = {ORDER: counts}
    for order in range(ORDER - 1, 0, -1):
        # the last three points are the second number
        low = F.col("_low").bitwiseAND((1 << POINT_BITS * order) - 1)
        longer = tables[order + 1].select("_l", F.lit(0).cast("long").alias("_high"), low.alias("_low"))
        tables[order] = longer.groupBy("_l", "_high", "_low").agg(F.count(F.lit(1)).alias("_n"))
        if order > 1:
            tables[order] = staged(tables[order])
    below = None
    for order in range(1, ORDER + 1):
        grams = tables[order].join(_discount_columns(tables[order]), "_l")
        n = F.col("_n")
        discount = F.when(n == 1, F.col("_d1")).when(n == 2, F.col("_d2")).otherwise(F.col("_d3"))
        context = Window.partitionBy("_l", "_high", F.shiftright("_low", POINT_BITS))
        sums = grams.withColumn("_d", discount).withColumns(
            {"_total": F.sum("_n").over(context), "_rest": F.sum("_d").over(context)}
        )
        if below is None:
            joined = sums.withColumn("_below", 1 / F.col("_size"))
        else:
            suffix = F.col("_low").bitwiseAND((1 << POINT_BITS * (order - 1)) - 1)
            shorter = below.select("_l", F.col("_low").alias("_suffix"), F.col("_p").alias("_below"))
            joined = sums.withColumn("_suffix", suffix).join(shorter, ["_l", "_suffix"])
        share = (F.greatest(n - F.col("_d"), F.lit(0.0)) + F.col("_rest") * F.col("_below")) / F.col("_total")
        below = joined.withColumn("_p", share)
    return below.select("_l", "_high", "_low", F.log("_p").cast("float").alias("_log"))


@dataclass
class KneserNey:
    """For each order the sorted hashes of its n-grams and their log probabilities, and for each
    context the sorted hashes and the log weight of the lower order."""

    hashes: list[np.ndarray]
    log_prob: list[np.ndarray]
    context_hashes: list[np.ndarray]
    log_rest: list[np.ndarray]

    @staticmethod
    def hash(codes: np.ndarray, order: int) -> np.ndarray:
        return spans.mixed_bits(codes.astype(np.uint64) * np.uint64(8) + np.uint64(order))

    def log_probability(self, codes: np.ndarray) -> np.ndarray:
        """Of the last class of each n-gram after the others, in nats."""
        out = np.zeros(len(codes))
        todo = np.arange(len(codes))
        for order in range(ORDER, 0, -1):
            part = codes[todo] & ((1 << BITS * order) - 1)
            at, hit = _look_up(self.hashes[order], self.hash(part, order))
            out[todo[hit]] += self.log_prob[order][at[hit]]
            todo, part = todo[~hit], part[~hit]
            at, hit = _look_up(self.context_hashes[order], self.hash(part >> BITS, order - 1))
            out[todo[hit]] += self.log_rest[order][at[hit]]
        out[todo] -= np.log(CLASSES)
        return out


def _look_up(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _discounts(counts: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts of counts 1, 2 and 3 or more; halves where they can't be told."""
    n1, n2, n3, n4 = (float((counts == k).sum()) for k in (1, 2, 3, 4))
    if min(n1, n2, n3, n4) == 0:
        return np.array([0.0, 0.5, 0.5, 0.5])
    y = n1 / (n1 + 2 * n2)
    found = np.array([0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3])
    return np.clip(found, [0, 0.05, 0.05, 0.05], [0, 0.95, 1.95, 2.95])


def fit_kneser_ney(grams: np.ndarray, counts: np.ndarray, alphabet: int = CLASSES) -> KneserNey:
    """The model of n-gram counts (codes of ORDER classes). Lower orders count distinct continuations.

    Without any n-gram every class is equally likely. This is the plain form of ``fit_tables`` over
    a small alphabet, with the lower orders that n-grams never seen need.
    """
    model = KneserNey([np.zeros(0, np.uint64)], [np.zeros(0)], [np.zeros(0, np.uint64)], [np.zeros(0)])
    by = np.argsort(grams)
    tables = {ORDER: (grams[by].astype(np.int64), counts[by].astype(np.int64))}
    for order in range(ORDER - 1, 0, -1):
        longer = tables[order + 1][0]
        tables[order] = np.unique(longer & ((1 << BITS * order) - 1), return_counts=True)
    lower_codes, lower = np.zeros(1, np.int64), np.full(1, 1.0 / alphabet)
    for order in range(1, ORDER + 1):
        codes, n = tables[order]
        seen, context = np.unique(codes >> BITS, return_inverse=True)
        discount = _discounts(n)[np.minimum(n, 3)]
        total = np.bincount(context, weights=n, minlength=len(seen))
        weight = np.bincount(context, weights=discount, minlength=len(seen)) / total
        below = lower[np.searchsorted(lower_codes, codes & ((1 << BITS * (order - 1)) - 1))]
        prob = np.maximum(n - discount, 0) / total[context] + weight[context] * below
        lower_codes, lower = codes, prob
        for keys, values, where in (
            (model.hash(codes, order), np.log(prob), (model.hashes, model.log_prob)),
            (model.hash(seen, order - 1), np.log(np.maximum(weight, 1e-12)), (model.context_hashes, model.log_rest)),
        ):
            by = np.argsort(keys)
            where[0].append(keys[by])
            where[1].append(values[by].astype(np.float32))
    return model


def text_counts(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Words, their code points, symbols, repeated lines and words in repeated 3-word windows."""
    texts = len(offsets) - 1
    starts, ends, ranges = spans.word_spans(data, offsets)
    digests = spans.SpanDigests(data)
    inside = spans.WORD_BYTES[data]
    chars = spans.per_text(inside & ((data & 0xC0) != 0x80), offsets)
    symbols = spans.per_text(SYMBOLS[data], offsets)
    # lines: a text begins one, and so does the byte after each line feed
    feeds = np.flatnonzero(data == 10)
    owner = np.searchsorted(offsets, feeds, "right") - 1
    lines = np.bincount(owner, minlength=texts) + 1
    of = np.repeat(np.arange(texts), lines)
    line_ranges = np.concatenate([[0], np.cumsum(lines)])
    line_starts = np.empty(line_ranges[-1], np.int64)
    first = np.zeros(line_ranges[-1], bool)
    first[line_ranges[:-1]] = True
    line_starts[first] = offsets[:-1]
    line_starts[~first] = feeds + 1
    line_ends = np.empty_like(line_starts)
    line_ends[:-1] = line_starts[1:] - 1
    last = line_ranges[1:] - 1
    line_ends[last] = offsets[1:]
    words_before = np.zeros(len(data) + 1, np.int64)
    np.cumsum(inside, out=words_before[1:])
    full = words_before[line_ends] > words_before[line_starts]
    keys, of = digests(line_starts[full], line_ends[full]), of[full]
    by = np.lexsort((keys, of))
    same = (keys[by][1:] == keys[by][:-1]) & (of[by][1:] == of[by][:-1])
    again = np.bincount(of[by][1:][same], minlength=texts)
    # words of 3-word windows that occur twice
    counts = np.diff(ranges)
    words = digests(starts, ends)
    covered = np.zeros(len(words), bool)
    if len(words) > 2:
        text_of = np.repeat(np.arange(texts), counts)
        window = words[:-2]
        for k in (1, 2):
            window = window * np.uint64(spans.BASE) + words[k : len(words) - 2 + k]
        window = spans.mixed_bits(window) ^ spans.mixed_bits(text_of[:-2].astype(np.uint64))
        at = np.flatnonzero(text_of[:-2] == text_of[2:])
        by = at[np.argsort(window[at], kind="stable")]
        twin = window[by][1:] == window[by][:-1]
        found = np.zeros(len(by), bool)
        found[1:] |= twin
        found[:-1] |= twin
        for k in range(3):
            covered[by[found] + k] = True
    repeats = spans.per_text(covered, ranges)
    return [counts, chars, symbols, again, repeats]


def with_scores(rows: DataFrame, keep_text: bool) -> DataFrame:
    """The rows (_row, _lang, _text) with ``_q`` of SCORE_TYPE; a text without words has a null log perplexity.

    The rows are read twice, and must come in the same tasks and order both times, as the rows of
    files do. Other rows raise an error, since a block then lacks n-grams that it did not ask for;
    no score can differ, as an n-gram has one probability in all blocks.
    """
    hashed = rows.withColumn("_l", F.xxhash64("_lang"))
    asked = _asked(hashed)
    counts = asked.groupBy("_l", "_high", "_low").agg(F.sum("_n").alias("_n"))
    answers = asked.withColumnRenamed("_block", "_to").drop("_n").join(fit_tables(staged(counts)), ["_l", "_high", "_low"])
    names = ["_row", "_lang", "_text"] if keep_text else ["_row", "_lang"]
    kind = [pa.field(n, pa.int64()) for n in COUNTS] + [pa.field("log_perplexity", pa.float64())]

    def score(pieces: pa.Table, found: pa.Table) -> pa.Table:
        model = Grams(*[found.column(c).to_numpy() for c in ("_l", "_high", "_low")], np.zeros(0, np.int64))
        keys = model.keys()
        order = np.argsort(keys)
        keys, logs = keys[order], found.column("_log").to_numpy()[order].astype(np.float64)
        parts, own = [], []
        for piece in pieces.column("_piece"):
            batch = pa.ipc.open_stream(piece.as_buffer()).read_next_batch()
            own.append(batch.select(names))
            values = text_counts(*spans.flat(batch.column("_text")))
            grams, ranges = _grams_of(batch)
            wanted = grams.keys()
            first, place = _groups(wanted)
            at, hit = _look_up(keys, wanted[first])
            if not hit.all():
                raise ValueError("the texts of a block differ from those that its n-grams were taken of")
            total = spans.per_text(logs[at][place] if len(place) else np.zeros(0), ranges)
            mean = pa.array(-total / np.maximum(values[0], 1), mask=values[0] == 0)
            counts = [pa.array(v.astype(np.int64)) for v in values]
            parts.append(pa.StructArray.from_arrays([*counts, mean], fields=kind))
        scores = pa.chunked_array(parts, pa.struct(kind))
        out = pa.Table.from_batches(own).append_column("_q", scores)
        spans.release_memory()
        return out

    schema = StructType([*rows.select(*names).schema.fields, *StructType.fromDDL(f"_q {SCORE_TYPE}").fields])
    return _pieces(hashed).groupBy("_block").cogroup(answers.groupBy("_to")).applyInArrow(score, schema)


def base_failed(q: str = "_q") -> Column:
    words, repeats = F.col(f"{q}.n_words"), F.col(f"{q}.n_repeat_words")
    return (words < 50) | (100 * repeats > 50 * words)


def language_bands(scored: DataFrame, lang: str = "_lang", q: str = "_q") -> DataFrame:
    """(language, low, high) of the log perplexity, over documents that pass the base rules.

    Quartiles are taken of values rounded to hundredths, so a task sends a few hundred counts for a
    language, however many documents it has. Callers write the bands out, so that the engine knows
    their size: one row a language, which it sends to all tasks unless they are very many.
    """
    logs = F.round(F.col(f"{q}.log_perplexity"), 2)
    quartiles = F.percentile(logs, F.array(F.lit(0.25), F.lit(0.75)))
    bands = scored.where(~base_failed(q)).groupBy(F.col(lang).alias("_band_lang")).agg(quartiles.alias("_quartiles"))
    low, high = F.get("_quartiles", F.lit(0)), F.get("_quartiles", F.lit(1))
    spread = FENCE * F.greatest(high - low, F.lit(LEAST_SPREAD))
    return bands.select("_band_lang", (low - spread).alias("_low"), (high + spread).alias("_high"))


def _judged(scored: DataFrame, bands: DataFrame, lang: str, q: str = "_q") -> DataFrame:
    logs = F.col(f"{q}.log_perplexity")
    inside = F.coalesce(logs.between(F.col("_low"), F.col("_high")), F.lit(False))
    return scored.join(bands, F.col(lang).eqNullSafe(F.col("_band_lang")), "left").withColumn(
        "_kept", ~base_failed(q) & inside
    )


def quality_report(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per document: counts, log perplexity, the band of its language, verdicts.

    A document fails the base rules with fewer than 50 words, or if over half of its words lie in
    3-word windows that occur twice or more in it. Others are kept if their mean log perplexity
    per character lies inside the band of their language. A null text has no words, a null
    language is a language of its own, repeated rows are documents of their own; an empty table
    gives an empty report. Input columns besides the three named are not carried.
    """
    own = F.struct(F.col(id).alias("_id"))
    rows = docs.select(own.alias("_row"), F.col(lang).alias("_lang"), F.col(text).alias("_text"))
    scored = staged(with_scores(rows, keep_text=False).select("_row._id", "_lang", "_q"))
    return _judged(scored, staged(language_bands(scored)), "_lang").select(
        F.col("_id").alias(id),
        "_q.*",
        F.col("_low").alias("band_low"),
        F.col("_high").alias("band_high"),
        base_failed().alias("base_failed"),
        F.col("_kept").alias("kept"),
    )


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents that ``quality_report`` keeps, columns as before.

    The texts pass one shuffle, to meet the n-grams of their block, and are written once with
    their scores.
    """
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text])
    rows = docs.select(own.alias("_row"), F.col(lang).alias("_lang"), F.col(text).alias("_text"))
    scored = staged(with_scores(rows, keep_text=True))
    bands = staged(language_bands(scored.select("_lang", "_q")))
    columns = [F.col("_text").alias(c) if c == text else F.col(f"_row.`{c}`").alias(c) for c in docs.columns]
    return _judged(scored, bands, "_lang").where("_kept").select(*columns)
