import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest_rows import texts_of
from tallyflow.llm import prefix_trie as pt
from tallyflow.llm.host_reputation import RULES, Rule, host_reputations, judged, levels_of
from tallyflow.llm.queries import op12_prefix_trie, op13_word_runs
from tallyflow.llm.word_runs import runs_of_texts, with_runs

# ---- runs of words


def plain_runs(words, min_words=6, exponent=4):
    """Every maximal stretch of every period; the least period of each stretch."""
    found = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i > start and i - start + q >= max(min_words, exponent * q):
                found.setdefault((start, i - start + q), q)
            i += i == start
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("limits", [(6, 4), (4, 3), (10, 5), (2, 3)])
def test_maximal_pairs_are_the_runs(limits):
    rng = random.Random(7)
    for _ in range(300):
        texts = []
        for _ in range(rng.randint(0, 4)):
            kinds, n = rng.choice([1, 2, 3, 8]), rng.randint(0, 40)
            words = [rng.randrange(kinds) for _ in range(n)]
            unit = [rng.randrange(kinds + 1) for _ in range(rng.randint(1, 6))]
            at = rng.randint(0, n)
            texts.append(words[:at] + [unit[i % len(unit)] for i in range(rng.randint(0, 30))] + words[at:])
        ranges = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        got = runs_of_texts(np.array(sum(texts, []), np.int64), ranges, *limits)
        want = [(s + int(r), n, q) for r, t in zip(ranges, texts) for s, n, q in plain_runs(t, *limits)]
        assert [tuple(x) for x in got.tolist()] == want


def test_long_runs():
    n = 30_000
    assert runs_of_texts(np.zeros(n, np.int64), np.array([0, n])).tolist() == [[0, n, 1]]
    assert runs_of_texts(np.arange(n) % 3001, np.array([0, n])).tolist() == [[0, n, 3001]]


@pytest.mark.parametrize("table", ["corpus", "odd"])
def test_runs_and_collapsed_texts(table, request, make):
    docs = request.getfixturevalue(table)
    rows = texts_of(docs)
    rows += [(50, "a b a b a b a b c"), (51, " x" * 9 + " x y x y x y x y\n"), (52, "é é é é é é 漢 漢"), (53, "a b c " * 40), (53, "a b c " * 40)]
    got = with_runs(make(rows)).collect()
    assert len(got) == len(rows)
    left = defaultdict(list)
    for i, text in rows:
        left[i, text].append(1)
    for r in got:
        left[r["doc_id"], r["text"]].pop()
        words = re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")
        if len(words) > 6500:
            continue
        runs = plain_runs(words)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        assert (r["n_words"], [tuple(x) for x in r["runs"]]) == (len(words), runs)
        assert r["collapsed"] == " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_keep_odd_columns(clashing):
    docs = clashing.select("*", F.lit("own runs").alias("runs"))
    got = with_runs(docs)
    assert {*got.columns} == {*docs.columns, "n_words", "collapsed"}
    assert got.count() == docs.count() and {r["_row"] for r in got.collect()} == {"own _row"}
    assert with_runs(docs.where("false")).count() == 0
    with pytest.raises(ValueError):
        with_runs(docs, exponent=2)


def test_runs_query(spark):
    got = {r["doc_id"]: r for r in op13_word_runs(spark, "/root/testdata/sf0.001").collect()}
    rows = texts_of(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    assert len(got) == len(rows)
    rewritten = 0
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h, n = zlib.crc32(str(i).encode()), len(words)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
            rewritten += 1
        if n > 4000:
            continue
        runs = plain_runs(words)
        gone = {k for s, m, q in runs for k in range(s + q, s + m)}
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        best = max(((m, -s, -q) for s, m, q in runs), default=None)
        want = (-best[1], best[0], -best[2], 1000 * best[0] // -best[2]) if best else (None,) * 4
        r = got[i]
        assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == want and r["n_runs"] == len(runs)
        assert r["runs_sha256"] == sha("".join(f"{s},{m},{q}\n" for s, m, q in runs))
        assert r["collapsed_sha256"] == sha(" ".join(w for k, w in enumerate(words) if k not in gone))
    assert rewritten


# ---- prefix trie


def plain_trie(texts):
    """{conv: [(role, text), ...]} to the rows of the trie."""
    members = defaultdict(list)
    for c in sorted(texts):
        for d in range(len(texts[c]) + 1):
            members[tuple(texts[c][:d])].append(c)
    kids = defaultdict(list)
    for key in members:
        if key:
            kids[key[:-1]].append(key)
    rows = {}
    for key in sorted(members, key=len, reverse=True):
        own = members[key]
        leaves, saved = int(not kids[key]), (len(own) - 1) * (len(key[-1][1].encode()) if key else 0)
        for k in kids[key]:
            leaves, saved = leaves + rows[k][5], saved + rows[k][6]
        ends = ",".join(str(c) for c in own if len(texts[c]) == len(key))
        parent = members[key[:-1]][0] if key else None
        rows[key] = (own[0], len(key), parent, len(own), len(kids[key]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest())
    return sorted(rows.values())


def plain_turns(rows):
    """Turns by number (null first), role, digest of the text."""
    found = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            found[c].append((turn is not None, turn or 0, role or "", hashlib.sha256((text or "").encode()).hexdigest(), text or ""))
    return {c: [(t[2], t[4]) for t in sorted(turns)] for c, turns in found.items()}


def trie_of(spark, texts):
    turns = [(c, k, r, x) for c, own in texts.items() for k, (r, x) in enumerate(own, 1)]
    return pt.prefix_trie(
        spark.createDataFrame([(c,) for c in texts], "conv_id long"),
        spark.createDataFrame(turns, "conv_id long, pos long, role string, text string"),
    )


def as_rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_trie_of_random_conversations(spark):
    rng = random.Random(5)
    texts = {}
    for c in rng.sample(range(-40, 9000), 90):
        texts[c] = [(rng.choice("ua"), rng.choice(["", "é", "yes", "no"])) for _ in range(rng.choice([0, 1, 2, 3, 7]))]
    for k in range(40):  # one conversation that many hold
        texts[20_000 + k] = [("u", "hello"), ("a", "hi")]
    assert as_rows(trie_of(spark, texts)) == plain_trie(texts)


def test_trie_of_long_chains(spark, monkeypatch):
    monkeypatch.setattr(pt, "CHUNK", 4)
    long = [("u" if k % 2 else "a", f"turn {k % 7}") for k in range(90)]
    texts = {1: long, 2: long[:50] + [("u", "other")] * 20, 3: long[:33], 4: long[:33], 5: [], 6: [("u", "turn 0")] * 70}
    assert as_rows(trie_of(spark, texts)) == plain_trie(texts)


def test_trie_of_none_and_one(spark):
    assert trie_of(spark, {7: []}).collect() == [(7, 0, None, 1, 0, 1, 0, hashlib.sha256(b"7").hexdigest())]
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    turns = pt.numbered_turns(none)
    assert pt.prefix_trie(turns.select("conv_id").distinct(), turns).count() == 0


def test_prefix_keys_tell_sequences_apart(spark, monkeypatch):
    monkeypatch.setattr(pt, "CHUNK", 3)
    rng = random.Random(2)
    texts = {c: [rng.choice("ab") for _ in range(rng.randint(1, 40))] for c in range(60)}
    texts[60] = texts[3] + ["a"]
    rows = [(c, k, x) for c, own in texts.items() for k, x in enumerate(own, 1)]
    got = pt.prefix_keys(spark.createDataFrame(rows, "conv_id long, pos long, digest string")).collect()
    by_key, by_prefix = defaultdict(set), defaultdict(set)
    for r in got:
        prefix = tuple(texts[r["conv_id"]][: r["pos"]])
        by_key[r["key"]].add(prefix)
        by_prefix[prefix].add(r["key"])
    assert len(got) == len(rows)
    assert all(len(v) == 1 for v in [*by_key.values(), *by_prefix.values()])


def test_trie_query_on_odd_rows(spark, tmp_path):
    rng = random.Random(11)
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "b", None, ""])) for c in range(60) if c % 7 for t in range(rng.randint(1, 12))]
    rows += [(3, None, "user", "first"), (3, 2, "user", "tie"), (3, 2, "user", "tie"), (None, 1, "user", "no conversation"), (10**12, 0, None, None)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    table.select("*", F.lit(1).alias("pos"), F.lit("x").alias("key")).write.parquet(str(tmp_path / "conversations.parquet"))
    turns = plain_turns(rows)
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = turns.get(c - c % 5, [])[:h] + own[h:]
    assert as_rows(op12_prefix_trie(spark, str(tmp_path))) == plain_trie(built)


# ---- host reputation


def plain_reputation(pages, confidence=0.9):
    """{host: (n, bad, rate, low)} from (host, suffix, domain, bad) rows."""
    counts = defaultdict(lambda: [0, 0])
    place = {}
    for host, suffix, domain, bad in pages:
        place[host] = (suffix, domain)
        counts[host][0] += bad is not None
        counts[host][1] += bad or 0
    grouped = lambda name: {k: [sum(x) for x in zip(*[counts[h] for h in place if name(h) == k])] for k in {name(h) for h in place}}
    n, bad = sum(c[0] for c in counts.values()), sum(c[1] for c in counts.values())
    above = {None: ((bad + 1) / (n + 2), n + 2.0)}
    for name, parent in ((lambda h: place[h][0], lambda k: None), (lambda h: place[h], lambda k: k[0]), (lambda h: h, lambda k: place[k])):
        rows = {k: (*v, *above[parent(k)]) for k, v in grouped(name).items()}
        spread = sum((b - m * a) ** 2 - m * a * (1 - a) for m, b, a, _ in rows.values())
        noise = sum((m - 1) * m * a * (1 - a) for m, b, a, _ in rows.values())
        inner = max(spread, 0) / noise if noise else None
        raw = 1 / inner - 1 if inner else None
        above = {}
        for k, (m, b, a, size) in rows.items():
            w = min(max(size if raw is None else raw, 1.0), size)
            above[k] = ((b + w * a) / (m + w), m + w)
    odds = confidence / (1 - confidence)
    return {
        h: (*counts[h], rate, max(0.0, rate - math.sqrt(odds * rate * (1 - rate) / (size + 1)))) for h, (rate, size) in above.items()
    }


def test_hosts_shrink_to_their_domains(spark):
    rng = random.Random(1)
    rows = []
    for k in range(40):
        host, suffix = f"h{k}.d{k % 6}.{'com' if k % 2 else 'net'}", "com" if k % 2 else "net"
        share = rng.random() ** 3
        rows += [(host, suffix, f"d{k % 6}.{suffix}", rng.choice([None, int(rng.random() < share)])) for _ in range(rng.randint(1, 60))]
    rows += [("new.d1.com", "com", "d1.com", None), ("bad.d1.com", "com", "d1.com", 1)] + [("worst.d3.com", "com", "d3.com", 1)] * 300
    got = host_reputations(spark.createDataFrame([(r[0], r[3]) for r in rows], "host string, bad int")).collect()
    want = plain_reputation(rows)
    assert len(got) == len(want)
    found = {}
    for r in got:
        found[r["host"]] = r
        assert (r["n"], r["bad"]) == want[r["host"]][:2]
        assert (r["rate"], r["low"]) == pytest.approx(want[r["host"]][2:], abs=1e-9)
    assert found["worst.d3.com"]["low"] > 0.8
    assert found["bad.d1.com"]["rate"] > found["new.d1.com"]["rate"] > 0 and found["bad.d1.com"]["low"] < 0.5


def plain_place(url):
    if url is None or "://" not in url:
        return "", ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
    return "".join(c.lower() if c.isascii() else c for c in host), path


URLS = [
    None, "", "no scheme/es/", "http://A.Example.ORG/es/x?y#z", "http://example.org/en/12", "http://example.org/en/2", "http://example.org",
    "http://myexample.org/es/", "https://x.com/fr/?q=://", "https://x.com/de/", "https://com/de/a", "https://x.com?u=/de/", "ftp://ÄB.net/a://b",
    "http://user@Host.co.uk:80/p", "http://10.0.0.1/x", "http://x.com/de", "://", "http:///fr/", "http://a\nb.com/fr/\nx", "http://.com/fr/",
]


def test_rules_and_places_of_odd_urls(spark):
    rows = [(k, u, f"own {k}") for k, u in enumerate([*URLS, *URLS[:3]])]
    pages = spark.createDataFrame(rows, "page_id long, url string, verdict string").select("*", F.lit(1).alias("_host"), F.lit(2).alias("n"))
    got = judged(pages).collect()
    assert len(got) == len(rows)
    for r in got:
        host, path = plain_place(r["url"])
        fits = [x for x in RULES if (host == x.host or host.endswith("." + x.host)) and path.startswith(x.path)]
        rule = max(fits, key=lambda x: len(x.name), default=None)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule and rule.name), r["url"]
        assert r["verdict"] == (rule.verdict if rule else "allow") and r["_host"] == 1 and r["n"] == 2
    assert judged(pages.where("false")).count() == 0


def test_bad_hosts_are_blocked(spark):
    rows = [(f"http://spam.a.net/{k}", 1) for k in range(40)] + [("http://spam.a.net/new", None)]
    rows += [(f"http://good{k % 9}.b.net/{k}", 0) for k in range(90)] + [("http://fresh.c.org/", None), ("http://one.d.net/", 1), ("http://one.d.net/2", None)]
    pages = spark.createDataFrame(rows, "url string, spam int")
    got = {r["url"]: r["verdict"] for r in judged(pages, outcome="spam", rules=[Rule("block", "b.net", "/8")]).collect()}
    assert got["http://spam.a.net/new"] == "block" and got["http://fresh.c.org/"] == "allow"
    assert got["http://one.d.net/2"] == "allow"  # one page shows nothing
    assert all(v == ("block" if "/8" in u else "allow") for u, v in got.items() if ".b.net" in u)


def test_suffixes_and_domains(spark):
    rows = [("a.b.co.uk", "co.uk", "b.co.uk"), ("u@a.b.com:80", "com", "b.com"), ("10.0.0.1:8", "", "10.0.0.1"), ("com", "com", "com"), ("", "", "")]
    suffix, domain = levels_of(F.col("host"))
    got = spark.createDataFrame(rows, "host string, s string, d string").select("s", "d", suffix.alias("a"), domain.alias("b")).collect()
    assert all((r["s"], r["d"]) == (r["a"], r["b"]) for r in got)
