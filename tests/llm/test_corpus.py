"""Operators over whole tables against plain Python."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest_rows import texts_of
from pyspark.sql import functions as F

import corpus_pipeline
from tallyflow.llm import repeats, toxicity
from tallyflow.llm.bwt_merge import Shard, merge
from tallyflow.llm.components import component_labels
from tallyflow.llm.order_minhash import _multipliers, edited, fingerprint_report, fingerprints, likeness
from tallyflow.llm import prob_minhash
from tallyflow.llm.prob_minhash import near_duplicates, one_of_each, probability_jaccard, signatures
from tallyflow.llm.repeats import remove_repeats
from tallyflow.llm.tables import read_table

SF = "/root/testdata/sf0.001"

# repeats


def plain_removal(rows):
    """(id, bytes) in order of position; equal ids with equal texts are one document."""
    seen, out = set(), {}
    for key, body in rows:
        if (key, body) in out:
            continue
        gone = np.zeros(len(body), bool)
        for k in range(len(body) - repeats.WIDTH + 1):
            window = body[k : k + repeats.WIDTH]
            if window in seen:
                gone[k : k + repeats.WIDTH] = True
            seen.add(window)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[key, body] = (int(gone.sum()), spans, np.frombuffer(body, np.uint8)[~gone].tobytes())
    return out


def check_removal(docs):
    rows = sorted(((i, (t or "").encode()) for i, t in texts_of(docs)), key=lambda r: (r[0] is not None, r[0] or 0))
    want = plain_removal(rows)
    found = remove_repeats(docs).collect()
    have = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in found)
    assert have == Counter((i, len(b), *want[i, b]) for i, b in rows)
    return sum(r["n_removed"] for r in found)


@pytest.fixture(scope="module")
def passages(make):
    """Edited copies, passages at odd places, runs of one byte, repeats inside one text."""
    rng = np.random.default_rng(5)
    words = [f"{w:x}" for w in rng.integers(1 << 8, 1 << 20, 400)]

    def text(n):
        return " ".join(words[k] for k in rng.integers(0, 400, n))

    base, passage = text(120), text(40)
    rows = [(k, base[:k] + chr(97 + k) + base[k + k % 3 :]) for k in range(0, 300, 11)]
    rows += [(1000 + k, text(k) + passage + text(k) + passage) for k in range(12)]
    rows += [(2000, "a" * 700), (2001, "b" + "a" * 400), (2002, base[:99]), (2003, base[:100]), (2004, "é" * 200), (2004, "é" * 200),
             (None, base), (None, base), (2005, None), (2006, "")]
    return make(rows)


def test_removal(corpus, passages, odd):
    assert check_removal(corpus) > 0
    assert check_removal(passages) > 0
    unique = odd.where("doc_id is null or doc_id != 8")
    check_removal(unique)
    assert remove_repeats(odd.where("false")).count() == 0


def test_removal_with_hot_anchors_in_small_batches(spark, passages, monkeypatch):
    """Every anchor with two runs is refined, and anchors are longer than a batch."""
    monkeypatch.setattr(repeats, "HOT", 1)
    monkeypatch.setattr(repeats, "BATCH", 500)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert check_removal(passages) > 0
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_merged_transforms():
    rng = np.random.default_rng(6)
    for depth in (8, 13, 40):
        lengths = [rng.integers(2, 30, n) for n in (3, 4)]
        parts = []
        for sizes in lengths:
            symbols = rng.integers(1, 3, sizes.sum()).astype(np.uint8)
            symbols[np.cumsum(sizes) - 1] = 0
            parts.append((symbols, sizes))
        shards = [Shard(s, n, depth) for s, n in parts]
        rows, block = merge(*shards, depth, prune=3)

        def rotation(which, place):
            symbols, sizes = parts[which]
            ends = np.cumsum(sizes)
            k = int(np.searchsorted(ends, place, "right"))
            own = symbols[ends[k] - sizes[k] : ends[k]].tolist()
            at = place - (ends[k] - sizes[k])
            return tuple(((own[at:] + own[:at]) * (depth // len(own) + 2))[:depth])

        n = len(shards[0].rows)
        every = [rotation(int(k >= n), int(p)) for k, p in enumerate(np.concatenate([s.rows for s in shards]))]
        assert every[:n] == sorted(every[:n]) and every[n:] == sorted(every[n:])
        both = set(every[:n]) & set(every[n:])
        assert sorted(rows.tolist()) == [k for k, r in enumerate(every) if r in both]
        merged = [every[k] for k in rows]
        assert merged == sorted(merged)
        number = {r: k for k, r in enumerate(sorted(both))}
        assert [number[r] for r in merged] == block.tolist()


# near-duplicates


def plain_similarity(a, b):
    both = set(a) & set(b)
    keys = set(a) | set(b)
    return sum(1 / sum(max(a.get(e, 0) / a[d], b.get(e, 0) / b[d]) for e in keys) for d in both)


def shingles(text):
    words = text.lower().split()
    return Counter(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else Counter()


def plain_classes(rows):
    """Smallest id of each class, by comparing all pairs."""
    texts = {t or "" for _, t in rows}
    sets = {t: shingles(t) for t in texts}
    least = {t: min(i for i, u in rows if (u or "") == t) for t in texts}
    label = {t: least[t] for t in texts}
    names = sorted(texts)
    links = [(a, b) for k, a in enumerate(names) for b in names[:k] if sets[a] and sets[b] and plain_similarity(sets[a], sets[b]) >= 0.8]
    for _ in range(len(names)):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return {i: label[t or ""] for i, t in rows}


@pytest.fixture(scope="module")
def copies(make):
    """Copies of a text with few edits each, a chain of edits, others, repeated and short texts."""
    rng = np.random.default_rng(7)

    def text(n):
        return [f"v{k}" for k in rng.integers(0, 5000, n)]

    base, rows = text(150), []
    for k in range(40):
        own = list(base)
        for place in rng.choice(150, 2, replace=False):
            own[place] = f"x{k}{place}"
        rows.append((100 - k, " ".join(own)))
    chain = text(120)
    for k in range(12):
        chain = list(chain)
        chain[8 * k] = f"c{k}"
        rows.append((200 + k, " ".join(chain)))
    rows += [(300 + k, " ".join(text(60))) for k in range(10)]
    rows += [(400 + k, " ".join(base[:50] + text(100))) for k in range(6)]
    rows += [(500, "one two"), (501, "One  two"), (502, "one two three"), (503, ""), (504, None), (505, " "), (506, "same " * 40), (507, "same " * 39),
             (508, " ".join(base)), (509, " ".join(base))]
    return make(rows)


def test_classes(copies):
    rows = texts_of(copies)
    got = near_duplicates(copies).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == plain_classes(rows)
    counts = Counter(t or "" for _, t in rows)
    texts = dict(rows)
    for r in got:
        assert r["copies"] == counts[texts[r["doc_id"]] or ""]
    kept = {r["doc_id"] for r in one_of_each(copies).collect()}
    assert kept == set(plain_classes(rows).values())


def test_links_far_from_the_centres_are_found(make):
    """Texts of one bucket that are near to one other text each, and to no centre."""
    shared, rows = [f"s{k}" for k in range(170)], []
    for k in range(80):
        own = shared + [f"o{k}x{i}" for i in range(36)]
        twin = list(own)
        for place in (172, 180, 188, 196):
            twin[place] = f"t{k}"
        rows += [(2 * k, " ".join(own)), (2 * k + 1, " ".join(twin))]
    sets = [shingles(t) for _, t in rows[:3]]
    assert plain_similarity(sets[0], sets[1]) >= 0.8 > plain_similarity(sets[0], sets[2])
    got = {r["doc_id"]: r["class_id"] for r in near_duplicates(make(rows)).collect()}
    assert got == {k: k - k % 2 for k, _ in rows}


def test_pairs_of_blocks():
    """Every pair of a group that differs in class and block is met in its first common band alone."""
    rng = np.random.default_rng(22)
    n = 90
    own, label = rng.integers(0, 2, n), rng.integers(0, 4, n)
    sketch = rng.integers(0, 3, (n, prob_minhash.REGISTERS)).astype(np.uint8)
    bands = rng.integers(0, 4, (n, prob_minhash.BANDS))
    bands[:, 5] = 1
    for cross in (np.zeros(n, bool), np.ones(n, bool)):
        want = {
            (i, j) for i in range(n) for j in range(i + 1, n)
            if label[i] != label[j] and not (cross[i] and own[i] == own[j]) and (sketch[i] == sketch[j]).sum() >= 88
            and not (bands[i, :5] == bands[j, :5]).any()
        }
        got = [(k, j) for k in range(n) for j in prob_minhash.candidates(k, n, label, own, cross, bands, np.full(n, 5), sketch, 88).tolist()]
        assert set(got) == want and len(got) == len(want) and want
    same = np.full((1, prob_minhash.REGISTERS), 7, np.uint8)
    assert prob_minhash.agreeing(same, same)[0] == prob_minhash.REGISTERS


def test_classes_of_odd_rows(odd, clashing):
    got = near_duplicates(odd)
    assert got.count() == odd.count()
    by = defaultdict(set)
    for r in got.collect():
        by[r["class_id"]].add(r["doc_id"])
    assert by[9] == {9, 10} and by[1] == {1, 2}
    assert one_of_each(clashing).columns == clashing.columns
    assert near_duplicates(odd.where("false")).count() == 0


def test_probability_jaccard():
    rng = np.random.default_rng(8)
    for _ in range(50):
        a, b = ({int(k): int(rng.integers(1, 5)) for k in rng.choice(12, rng.integers(1, 9), replace=False)} for _ in range(2))
        arrays = [(np.array(sorted(x), np.uint64), np.array([x[k] for k in sorted(x)], float)) for x in (a, b)]
        assert probability_jaccard(*arrays) == pytest.approx(plain_similarity(a, b))


def test_signatures_estimate_the_similarity():
    rng = np.random.default_rng(9)
    keys = rng.integers(1, 1 << 62, 300).astype(np.uint64)
    shared = []
    for _ in range(12):
        keys = rng.integers(1, 1 << 62, 300).astype(np.uint64)
        a, b = np.sort(keys[:260]), np.sort(keys[40:])
        weights = {int(k): float(w) for k, w in zip(keys, rng.integers(1, 6, 300), strict=True)}
        wa, wb = (np.array([weights[int(k)] for k in x]) for x in (a, b))
        signs = signatures(np.concatenate([a, b]), np.concatenate([wa, wb]), np.array([0, 260, 520]))
        shared.append((signs[0] == signs[1]).mean() - probability_jaccard((a, wa), (b, wb)))
    assert abs(np.mean(shared)) < 0.03


def test_components(spark):
    rng = np.random.default_rng(10)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2)) if a != b] + [(k, k + 1) for k in range(1000, 1040)]
    label = {n: n for e in edges for n in e}
    for _ in range(60):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = component_labels(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["label"] for r in got} == label and len(got) == len(label)


# fingerprints


@pytest.mark.parametrize("table", ["corpus", "odd"])
def test_fingerprints(table, request, spark):
    docs = request.getfixturevalue(table)
    rows = sorted(texts_of(docs), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    factors = _multipliers(64, 5)
    prints = fingerprints([(t or "").encode() for _, t in rows], factors)
    found = defaultdict(list)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for r in fingerprint_report(docs).collect():
            found[r["doc_id"]].append(r)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for k, (i, text) in enumerate(rows):
        text, following = text or "", rows[(k + 1) % len(rows)][1] or ""
        changed = edited(text, following)
        n = len(text)
        assert changed == text[: n - n // 4] + following[: n // 4]
        want = (n, hashlib.sha256(changed.encode()).hexdigest(), prints[k].astype(">u2").tobytes().hex())
        rows_i = [r for r in found[i] if (r["n_chars"], r["edited_sha256"], r["fingerprint"]) == want]
        assert rows_i
        other = fingerprints([changed.encode()], factors)[0]
        assert rows_i[0]["near_edited"] == likeness(prints[k], other)
        assert rows_i[0]["near_next"] == likeness(prints[k], prints[(k + 1) % len(rows)])
    assert sum(map(len, found.values())) == len(rows)


def test_fingerprints_of_none_and_one(odd):
    assert fingerprint_report(odd.where("false")).count() == 0
    one = fingerprint_report(odd.where("doc_id = 9")).first()
    assert one["near_next"] == 1.0


def test_fingerprints_follow_edits():
    words = [f"word{k}" for k in range(400)]
    factors = _multipliers(64, 5)
    texts = [" ".join(w) for w in (words, words[:380] + ["new"] * 20, words[200:] + words[:200], words[:200] + [f"z{k}" for k in range(200)], words[::-1])]
    a, few, swapped, half, back = fingerprints([t.encode() for t in texts], factors)
    assert likeness(a, few) > 0.7 > likeness(a, half) > likeness(a, back)
    assert likeness(a, swapped) < likeness(a, few)


# toxicity


def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = read_table(spark, folder, "documents"), read_table(spark, folder, "labels")
    scores = toxicity.toxicity_scores(docs, labels)
    rows = scores.join(labels.select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    positive = [r["score"] for r in rows if r["toxic"]]
    negative = [r["score"] for r in rows if not r["toxic"]]
    auc = np.mean([(p > q) + 0.5 * (p == q) for p in positive for q in negative])
    assert auc > 0.85
    assert np.mean([r["predicted"] == r["toxic"] for r in rows]) > 0.93
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)


def edits(a, b):
    """Levenshtein distance with swaps of neighbours (each letter changed once)."""
    d = {(i, -1): i + 1 for i in range(-1, len(a))} | {(-1, j): j + 1 for j in range(-1, len(b))}
    for i in range(len(a)):
        for j in range(len(b)):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i] != b[j]))
            if i and j and a[i] == b[j - 1] and a[i - 1] == b[j]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a) - 1, len(b) - 1]


def test_automaton_finds_misspellings():
    terms = [("idiot", False, 3.0), ("disgusting", False, 4.0), ("moron", False, 2.0), ("cat", False, 1.0), ("vequ", True, 2.5)]
    machine = toxicity.build_automaton(terms)
    odds = np.array([t[2] for t in terms])
    table = toxicity.letter_table(machine.alphabet)
    rng = np.random.default_rng(11)
    words = ["idiot", "idoit", "1diot", "idiots", "idi", "moran", "mroon", "cat", "car", "vequxyz", "vequ", "disgsutin", "zzz"]
    for term, _, _ in terms:
        for _ in range(60):
            w = list(term)
            for _ in range(rng.integers(0, 4)):
                k = int(rng.integers(0, len(w) + 1))
                w[k : k + int(rng.integers(0, 2))] = [chr(97 + int(rng.integers(0, 26)))] * int(rng.integers(0, 2))
            words.append("".join(w) or "q")
    for word in words:
        plain = "".join(toxicity.DISGUISES.get(c, c) for c in word)
        classes = table[np.array([ord(c) for c in word])]
        term, fuzzy = toxicity.find_terms(machine, odds, classes, np.array([0]), np.array([len(word)]))
        fits = [k for k, (t, stem, _) in enumerate(terms)
                if (plain.startswith(t) if stem else edits(plain, t) <= toxicity.allowed_edits(t, False))]
        if not fits:
            assert term[0] == -1, word
        else:
            assert term[0] in fits, word
            if not terms[term[0]][1]:
                assert fuzzy[0] == (plain != terms[term[0]][0]), word


def test_quotation_is_told_from_abuse():
    import pyarrow as pa

    machine = toxicity.build_automaton([("idiot", False, 3.0)])
    of = toxicity._batch_features(machine, np.array([3.0]))
    column = pa.array(["you idiot", 'they wrote "you idiot" there', "idoit idiot", None, ""])
    ((text, _, value), context), = of(column)
    assert text.tolist() == [0, 2] and value.tolist() == [1.0, 1.0]
    assert (context[:, 0] > 0).tolist() == [False, True, False, False, False]


def test_misspelled_words_beside_their_beginnings(spark):
    """Words whose beginning marks toxic texts too are found with a letter swapped, replaced, left out or extra."""
    rng = np.random.default_rng(31)
    insults = ["idiot", "worthless", "pathetic"]
    wrong = ["idoit", "itiot", "wrothless", "worhless", "patethic", "pahtetic"]

    def prose(word=None):
        words = [f"{'bdfgklmnrs'[k % 10]}{'aeou'[k // 10 % 4]}{'bdfgklmnrs'[k // 40]}{'aeou'[k % 4]}" for k in rng.integers(0, 400, 40)]
        return " ".join(words if word is None else [*words[:20], word, *words[20:]])

    rows = [(k, prose(insults[k % 3] if k % 2 else None), k % 2) for k in range(240)]
    labels = spark.createDataFrame([(k, toxic) for k, _, toxic in rows], "doc_id long, toxic int")
    texts = [(k, text) for k, text, _ in rows] + [(1000 + k, prose(w)) for k, w in enumerate(wrong)] + [(2000 + k, prose()) for k in range(6)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    terms = toxicity.learn_lexicon(docs.join(labels, "doc_id"), "toxic", "text")
    assert {t for t, stem, _ in terms if not stem} >= set(insults)
    score = {r["doc_id"]: r["score"] for r in toxicity.toxicity_scores(docs, labels).collect()}
    assert min(score[1000 + k] for k in range(6)) > 0.5 > max(score[2000 + k] for k in range(6))


def test_toxicity_of_odd_rows(spark, odd):
    labels = spark.createDataFrame([(9, 1), (4, 0), (None, 1), (5, None)], "doc_id long, toxic int")
    assert toxicity.toxicity_scores(odd, labels).count() == odd.count()
    none = labels.where("false")
    assert toxicity.toxicity_scores(odd, none).where("score between 0 and 1").count() == odd.count()
    assert toxicity.toxicity_scores(odd.where("false"), labels).count() == 0


# pipeline


def test_pipeline_stages(spark):
    from tallyflow.llm.mixing import with_copies, word_count
    from tallyflow.llm.quality import quality_report
    from test_native import plain_line_dedup

    docs = read_table(spark, SF, "documents")
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality"](spark, docs, SF).cache()
    assert {r["doc_id"] for r in good.collect()} == {r["doc_id"] for r in quality_report(docs).where("kept").collect()}
    lines = stages["line_dedup"](spark, good, SF).cache()
    want = {i: t for i, t, _, _ in plain_line_dedup(texts_of(good))}
    assert dict(texts_of(lines)) == want
    single = stages["near_dedup"](spark, lines, SF).cache()
    label = plain_classes(texts_of(lines))
    assert {i for i, _ in texts_of(single)} == set(label.values())
    mix = stages["mix"](spark, single, SF).cache()
    copies = with_copies(single.select("doc_id", "source", word_count().alias("size"))).collect()
    assert Counter(i for i, _ in texts_of(mix)) == Counter({r["doc_id"]: r["copies"] for r in copies if r["copies"]})
    for stage in (good, lines, single, mix):
        assert stage.columns == docs.columns
    packed = corpus_pipeline.run(spark, SF)
    starts = packed.where("start = 0").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).collect()
    assert {r["doc_id"]: r["n"] for r in starts} == {r["doc_id"]: r["copies"] for r in copies if r["copies"]}


def test_pipeline_of_nothing(spark):
    docs = read_table(spark, SF, "documents").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
