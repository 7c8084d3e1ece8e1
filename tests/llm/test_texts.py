"""Operators on single texts against plain Python."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest_rows import texts_of
from pyspark.sql import functions as F

from tallyflow.llm import spans
from tallyflow.llm.encoding import CachedEncoder, default_path
from tallyflow.llm.licences import PHRASES, LicenceScanner, SuffixAutomaton, scan_licences
from tallyflow.llm.packing import SumOfSquaresPacker, Piece, pack_documents
from tallyflow.llm.quality import (
    CLASSES,
    ORDER,
    fit_kneser_ney,
    keep_good,
    fit_tables,
    quality_report,
)
from tallyflow.llm.token_store import EliasFano, pack_block, read_token_store, unpack_block, write_token_store

WORD = r"[^\x20\x09-\x0D]+"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_path())


def plain_ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def mirror_words(size=4096):
    """The Thue-Morse word of two letters and its mirror image, which polynomials modulo 2^64 take for one."""
    word = "a"
    while len(word) < size:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_regular_words_have_digests_of_their_own(make, tokenizer):
    import pyarrow as pa

    for size in (1024, 4096, 16_384):
        one, two = mirror_words(size)
        digests = spans.SpanDigests(np.frombuffer((one + two).encode(), np.uint8))(np.array([0, size]), np.array([size, 2 * size]))
        assert digests[0] != digests[1]
    one, two = mirror_words()
    ids, cuts = CachedEncoder().encode_all(*spans.flat(pa.array([one, two])))
    assert [ids[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:])] == [plain_ids(tokenizer, one), plain_ids(tokenizer, two)]
    row = quality_report(make([(1, f"{one}\n{two}\n{one}", "en", "a")])).collect()[0]
    assert row["n_dup_lines"] == 1


def test_digests_do_not_depend_on_the_place():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 5000).astype(np.uint8)
    starts = rng.integers(0, 4900, 300)
    ends = starts + rng.integers(0, 100, 300)
    got = spans.SpanDigests(data)(starts, ends)
    again = spans.SpanDigests(data[1:])(np.maximum(starts, 1) - 1, np.maximum(ends, 1) - 1)
    assert (got == again)[starts > 0].all()
    by = {}
    for g, a, b in zip(got.tolist(), starts, ends):
        assert by.setdefault(g, data[a:b].tobytes()) == data[a:b].tobytes()


# quality


def base_counts(text):
    text = text or ""
    words = re.findall(WORD, text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for k in range(len(words) - 2):
        if windows[tuple(words[k : k + 3])] > 1:
            covered |= {k, k + 1, k + 2}
    lines = [line for line in text.split("\n") if re.search(WORD, line)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


@pytest.mark.parametrize("table", ["corpus", "odd"])
def test_base_counts(table, request):
    docs = request.getfixturevalue(table)
    report = quality_report(docs)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = Counter((r["doc_id"], *[r[n] for n in names]) for r in report.collect())
    assert got == Counter((i, *base_counts(t)) for i, t in texts_of(docs))
    for r in report.collect():
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])


def test_kept_documents(corpus, clashing):
    kept = {r["doc_id"] for r in quality_report(corpus).where("kept").collect()}
    assert {r["doc_id"] for r in keep_good(corpus).collect()} == kept
    assert keep_good(clashing).columns == clashing.columns
    assert keep_good(clashing.where("false")).count() == 0
    assert quality_report(clashing.where("false")).count() == 0


def test_bands_reject_junk(spark, corpus):
    prose = [(r["doc_id"], r["text"], r["lang"]) for r in corpus.where("length(text) > 600 and lang = 'en'").collect()]
    junk = [(10_000 + k, re.sub(r"\S+", lambda m: m[0] + "###", t), "en") for k, (_, t, _) in enumerate(prose[:5])]
    docs = spark.createDataFrame(prose + junk, "doc_id long, text string, lang string")
    report = {r["doc_id"]: r for r in quality_report(docs).collect()}
    assert not any(report[i]["kept"] for i, _, _ in junk)
    passed = [report[i] for i, _, _ in prose if not report[i]["base_failed"]]
    assert sum(r["kept"] for r in passed) >= 0.9 * len(passed)


def test_kneser_ney_is_a_distribution():
    rng = np.random.default_rng(1)
    text = rng.integers(1, 6, 4000)
    grams = Counter(tuple(text[k : k + ORDER]) for k in range(len(text) - ORDER + 1))
    codes = {sum(int(c) << 5 * (ORDER - 1 - k) for k, c in enumerate(g)): n for g, n in grams.items()}
    model = fit_kneser_ney(np.array(list(codes)), np.array(list(codes.values())))
    for context in (0, 1 << 10 | 2 << 5 | 3, 30 << 10 | 4 << 5 | 1, 31 << 10 | 31 << 5 | 31):
        total = np.exp(model.log_probability(context * CLASSES + np.arange(CLASSES))).sum()
        assert total == pytest.approx(1, abs=1e-4)
    assert all((np.diff(h.astype(object)) > 0).all() for h in model.hashes)
    empty = fit_kneser_ney(np.zeros(0, np.int64), np.zeros(0, np.int64))
    assert np.exp(empty.log_probability(np.arange(4))) == pytest.approx(1 / CLASSES)


def test_tables_of_the_model_equal_its_plain_form(spark):
    rng = np.random.default_rng(2)
    rows, want = [], {}
    for lang in (7, 8):
        text = rng.choice(np.arange(1, 9), 3000, p=[0.3, 0.25, 0.15, 0.1, 0.08, 0.06, 0.04, 0.02])
        grams = Counter(tuple(int(c) for c in text[k : k + ORDER]) for k in range(len(text) - ORDER + 1))
        codes = np.array([sum(c << 5 * (ORDER - 1 - k) for k, c in enumerate(g)) for g in grams])
        plain = fit_kneser_ney(codes, np.array(list(grams.values())), alphabet=len({g[-1] for g in grams}))
        for (g, n), log in zip(grams.items(), plain.log_probability(codes)):
            want[lang, g[0], g[1] << 42 | g[2] << 21 | g[3]] = log
            rows.append((lang, g[0], g[1] << 42 | g[2] << 21 | g[3], n))
    counts = spark.createDataFrame(rows, "_l long, _high long, _low long, _n long")
    got = {(r["_l"], r["_high"], r["_low"]): r["_log"] for r in fit_tables(counts).collect()}
    assert got == pytest.approx(want, abs=1e-4)


def test_letters_of_other_scripts_are_told_apart(make):
    rng = np.random.default_rng(3)
    letters = [chr(c) for c in range(0x430, 0x450)]
    words = ["".join(rng.choice(letters, 6)) for _ in range(60)]
    prose = [" ".join(rng.choice(words, 80)) for _ in range(40)]
    junk = re.sub(r"\S", lambda m: str(rng.choice(letters)), prose[0])
    report = {r["doc_id"]: r for r in quality_report(make([(k, t, "ru") for k, t in enumerate([*prose, junk])])).collect()}
    assert not report[40]["kept"]
    assert all(report[k]["kept"] for k in range(40) if not report[k]["base_failed"])
    assert not any(report[k]["base_failed"] for k in (0, 40))


# licences


def plain_phrases(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places = [(k, label) for p, label in PHRASES.items() for k in range(len(words)) if words[k : k + len(p.split())] == p.split()]
    return len(words), sorted(places)


@pytest.mark.parametrize("table", ["corpus", "odd", "licensed"])
def test_phrases(table, request):
    docs = request.getfixturevalue(table)
    got = [(r["doc_id"], r["n_words"], tuple((p["start"], p["label"]) for p in r["phrases"])) for r in scan_licences(docs).collect()]
    want = [(i, n, tuple(p)) for i, t in texts_of(docs) for n, p in [plain_phrases(t)]]
    assert Counter(got) == Counter(want)


@pytest.fixture(scope="module")
def licensed(make):
    return make([
        (1, "x Apache  License apache license, MIT-License! CC BY cc.by ccby"),
        (2, "GNU General Public License GNU general GNU General Public License"),
        (3, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the Software), to deal in the Software without restriction"),
        (4, "Permission is hereby granted, free of all charge, to any person obtaining one copy of this software and associated "
            "documentation files (the Software), to deal in the Software without restriction"),
        (5, "licensed under the stars"),
    ])


def test_template_spans(licensed):
    spans_of = {r["doc_id"]: {(s["label"], round(s["cover"], 1)) for s in r["spans"]} for r in scan_licences(licensed).collect()}
    assert spans_of[3] == {("mit", 1.0)}
    assert {label for label, _ in spans_of[4]} == {"mit"}
    assert spans_of[5] == set()


def test_matching_statistics():
    rng = np.random.default_rng(2)
    for _ in range(30):
        sequences = [rng.integers(0, 3, rng.integers(1, 9)).tolist() for _ in range(3)]
        text = rng.integers(0, 4, 30).tolist()
        machine = SuffixAutomaton(sequences)
        pieces = {tuple(s[a:b]) for s in sequences for a in range(len(s)) for b in range(a + 1, len(s) + 1)}
        for k, (state, size) in enumerate(machine.statistics(text)):
            longest = max((n for n in range(k + 2) if n == 0 or tuple(text[k + 1 - n : k + 1]) in pieces))
            assert size == longest
            if size:
                match = tuple(text[k + 1 - size : k + 1])
                ends = {(n, b - 1) for n, s in enumerate(sequences) for b in range(size, len(s) + 1) if tuple(s[b - size : b]) == match}
                assert machine.ends[state] == ends
    assert LicenceScanner().scan(np.zeros(0, np.int64), np.zeros(0, np.int64)) == ([], [])


# token ids


ODD_TEXTS = ["", " ", "a<|endoftext|>b <|startoftext|>", "x\x1cq \x85 \xa0é ́a", "ΑΣ ΣΑΣ İ ﬁ ½ 日本語", "a'll 's '  s don't'", "\r\n\t x\x0b",
             "A" * 500 + " b " + "é" * 100, "e ̈ ö", ". , , a. b.,### !?", "word,### wörd*** x!!"]


def test_encoder_agrees_with_the_library(tokenizer, corpus):
    import pyarrow as pa

    texts = ODD_TEXTS + [t for _, t in texts_of(corpus)]
    small = CachedEncoder(most=300)
    for encoder in (CachedEncoder(), small):
        for start in range(0, len(texts), 7):
            part = texts[start : start + 7]
            ids, cuts = encoder.encode_all(*spans.flat(pa.array([t or "" for t in part])))
            for k, text in enumerate(part):
                assert ids[cuts[k] : cuts[k + 1]].tolist() == plain_ids(tokenizer, text)


def test_elias_fano():
    rng = np.random.default_rng(3)
    for n, most in ((0, 5), (1, 0), (1, 9), (700, 3), (700, 10**6), (5, 2**40)):
        values = np.sort(rng.integers(0, most + 1, n))
        code = EliasFano.encode(values, most)
        assert code.all().tolist() == values.tolist()
        assert [code[k] for k in range(n)] == values.tolist()
        assert 8 * (len(code.low) + len(code.upper)) <= n * (2 + max(1, most // max(n, 1)).bit_length()) + 24
    for ids in ([], [7], [70_000, 3]):
        marks, back = unpack_block(pack_block(np.array(ids, np.uint32), np.array([len(ids)])))
        assert back.tolist() == ids and marks[0] == len(ids)


@pytest.mark.parametrize("table", ["corpus", "odd"])
def test_token_store(table, request, spark, tokenizer, tmp_path):
    docs = request.getfixturevalue(table)
    write_token_store(docs, str(tmp_path / "store"), end_id=1, block_ids=500)
    got = sorted(read_token_store(spark, str(tmp_path / "store")).collect(), key=lambda r: r["start"])
    order = sorted(texts_of(docs), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    at = 0
    for row, (i, text) in zip(got, order, strict=True):
        ids = np.frombuffer(row["ids"], "<u4").tolist()
        assert (row["doc_id"], row["start"], row["n_tokens"]) == (i, at, len(ids))
        assert ids == [*plain_ids(tokenizer, text), 1]
        at += len(ids)


def test_empty_stores(spark, odd, tmp_path):
    write_token_store(odd.where("false"), str(tmp_path / "none"))
    assert read_token_store(spark, str(tmp_path / "none")).count() == 0
    assert pack_documents(odd.where("false")).count() == 0


@pytest.mark.parametrize("table", ["corpus", "odd"])
def test_packing(table, request, tokenizer):
    docs = request.getfixturevalue(table)
    pieces = pack_documents(docs).collect()
    own = Counter()
    for r in pieces:
        if r["start"] == 0:
            own[r["doc_id"]] += 1
    assert own == Counter(i for i, _ in texts_of(docs))
    fills = {}
    for r in sorted(pieces, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == fills.get(r["sequence_id"], 0)
        assert len(r["ids"]) == 4 * r["length"]
        fills[r["sequence_id"]] = r["offset"] + r["length"]
    assert all(n == 4096 or n & (n - 1) == 0 and n < 4096 for n in fills.values())
    if table == "corpus":
        for i, text in texts_of(docs)[:60]:
            mine = sorted((r for r in pieces if r["doc_id"] == i), key=lambda r: r["start"])
            ids = b"".join(r["ids"] for r in mine)
            assert np.frombuffer(ids, "<u4").tolist() == [*plain_ids(tokenizer, text), 2]
            assert {r["doc_tokens"] for r in mine} == {len(ids) // 4}


def test_sum_of_squares_choice():
    rng = np.random.default_rng(4)
    packer = SumOfSquaresPacker(64, most_open=40)
    total, closed = 0, 0
    for k in range(2000):
        s = int(rng.integers(1, 64))
        before = packer.count.copy()
        levels = [h for h in range(1, 65 - s) if before[h]]

        def squares(h):
            after = before.copy()
            after[h] -= h > 0
            after[h + s] += h + s < 64
            return int((after[1:64] ** 2).sum())

        best = min(squares(h) for h in [0, *levels])
        assert squares(packer._level(s)) == best
        total += s
        closed += sum(len(p.ids) for w in packer.add(Piece(k, 0, np.zeros(s, np.uint32), s)) for p in w)
        assert packer.open == packer.count.sum() <= 40
    closed += sum(len(p.ids) for w in packer.close() for p in w)
    assert closed == total


def test_crc_of_stored_ids(spark, odd, tmp_path, tokenizer):
    write_token_store(odd.where("doc_id = 9"), str(tmp_path / "one"))
    row = read_token_store(spark, str(tmp_path / "one")).select(F.crc32("ids").alias("c"), "ids").first()
    assert row["c"] == zlib.crc32(row["ids"])
