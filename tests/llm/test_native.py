import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallyflow.llm.line_dedup import drop_common_lines
from tallyflow.llm.mixing import mixed, with_copies, word_count

WHITE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_line_dedup(rows):
    """Each row is a document; ids may repeat or be null (smallest)."""
    holders = defaultdict(list)
    keys = []
    for n, (i, text) in enumerate(rows):
        own = [line.strip(WHITE).translate(LOWER) for line in (text or "").split("\n")]
        keys.append(own)
        for k in {k for k in own if len(k) >= 40}:
            holders[k].append(n)
    out = []
    for n, (i, text) in enumerate(rows):
        kept = []
        for key, line in zip(keys[n], (text or "").split("\n"), strict=True):
            ids = [rows[m][0] for m in holders.get(key, [])]
            last = max((x for x in ids if x is not None), default=None)
            gone = len(ids) >= 5 and last is not None and (i is None or i < last)
            if not gone:
                kept.append(line)
        out.append((i, "\n".join(kept), len(keys[n]), len(keys[n]) - len(kept)))
    return out


def as_set(rows):
    return sorted(map(tuple, rows), key=str)


def test_lines_of_odd_rows(clashing):
    got = drop_common_lines(clashing)
    assert set(got.columns) == set(clashing.columns)
    rows = [(r["doc_id"], r["text"]) for r in clashing.select("doc_id", "text").collect()]
    found = got.select("doc_id", "text", "n_lines", "n_dropped").collect()
    assert as_set(found) == as_set(plain_line_dedup(rows))
    assert any(r["n_dropped"] for r in found)
    assert {r["_row"] for r in got.select("_row").collect()} == {"own _row"}


def test_lines_of_the_corpus(corpus):
    rows = [(r["doc_id"], r["text"]) for r in corpus.collect()]
    got = drop_common_lines(corpus, min_docs=5).select("doc_id", "text", "n_lines", "n_dropped").collect()
    assert as_set(got) == as_set(plain_line_dedup(rows))


def test_lines_of_an_empty_table(odd):
    assert drop_common_lines(odd.where("false")).count() == 0


def water_fill(sizes, weights, share, most):
    """Targets by resharing the excess until none is above its limit."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    limit = {s: most * sizes[s] for s in names}
    left, full = share * sum(sizes.values()), set()
    while True:
        rest = [s for s in names if s not in full]
        part = {s: left * w[s] / sum(w[r] for r in rest) for s in rest}
        over = [s for s in rest if part[s] >= limit[s]]
        if not over:
            return {**part, **{s: limit[s] for s in full}}
        full |= set(over)
        left -= sum(limit[s] for s in over)
        if len(full) == len(names):
            return limit


def test_targets_and_copies(corpus):
    sized = corpus.select("doc_id", "source", word_count().alias("size"))
    rows = with_copies(sized, piece_rows=3).collect()
    texts = {r["doc_id"]: r["text"] for r in corpus.collect()}
    sizes = defaultdict(int)
    for r in rows:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", texts[r["doc_id"]] or ""))
        assert 0 <= r["copies"] <= 2
        sizes[r["source"]] += r["size"]
    targets = water_fill(sizes, (5, 2, 1), 1.5, 2)
    for r in rows:
        assert r["target"] == pytest.approx(targets[r["source"]])
        assert r["source_size"] == sizes[r["source"]]
    again = with_copies(sized.repartition(7), piece_rows=3).collect()
    assert as_set(rows) == as_set(again)


def test_taken_words_come_near_the_targets(spark):
    sized = spark.range(20000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 6)).alias("source"),
        (F.pow(F.lit(2.0), (F.col("id") * 7919 % 1000) / 100)).cast("long").alias("size"),
    )
    rows = with_copies(sized, piece_rows=500).groupBy("source", "target").agg(F.sum(F.col("copies") * F.col("size")).alias("taken"))
    for r in rows.collect():
        assert r["taken"] == pytest.approx(r["target"], rel=0.01)


def test_mix_keeps_odd_columns(clashing):
    got = mixed(clashing)
    assert got.columns == clashing.columns
    copies = with_copies(clashing.select("doc_id", "source", word_count().alias("size"))).collect()
    want = defaultdict(int)
    for r in copies:
        want[r["doc_id"]] += r["copies"]
    have = defaultdict(int)
    for r in got.collect():
        have[r["doc_id"]] += 1
        assert r["size"] == "own size"
    assert {k: v for k, v in want.items() if v} == dict(have)
    assert mixed(clashing.where("false")).count() == 0


def test_no_python_in_native_plans(corpus):
    for df in (drop_common_lines(corpus), mixed(corpus)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
