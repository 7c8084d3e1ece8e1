"""Toxicity scores from a learned lexicon, found through misspellings, weighed by context windows."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import ArrowUDFType, arrow_udf

from tallyflow.llm import spans
from tallyflow.llm.tables import staged, text_or_empty

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bounds of the fit: labelled rows of each class (by digest of the id), candidate terms, terms kept.
TOXIC_ROWS = 4_000
CLEAN_ROWS = 6_000
CANDIDATES = 6_000
LEXICON = 500
STEM_LENGTHS = (3, 4, 5, 6, 7, 8)
LEAST_DOCS = 4
LEAST_ODDS = 1.5
WINDOW = 10
FUZZY_VALUE = 0.6
#: Marks that stand for letters in disguised words.
DISGUISES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a"}
QUOTES = "\"“”„«»‘’"
CONTEXT = ("quoted", "dense", "window", "fuzzy")


def letter_table(alphabet: str) -> np.ndarray:
    """Class of a code point: 0 what parts words, 1 letters outside the alphabet, 2 and on its letters in either case."""
    known = {c: k + 2 for k, c in enumerate(alphabet)}
    table = np.zeros(1 << 16, np.uint8)
    for point in range(1 << 16):
        letter = chr(point)
        if letter.isalpha():
            table[point] = known.get(letter.lower(), 1)
    for mark, letter in DISGUISES.items():
        table[ord(mark)] = known.get(letter, 1)
    return table


def allowed_edits(term: str, stem: bool) -> int:
    """Edits that a misspelling of the term may have."""
    if stem:
        return 0
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Automaton:
    """Levenshtein automata of all terms, run together along the trie of the lexicon.

    A state is a set of (trie node, edits so far, letter owed by a swap). A letter moves along a
    branch, or with one more edit stands for another letter, is extra, was left out, or is swapped
    with the next. Only nodes above a term that allows so many edits are followed.

    The driver builds the trie alone. Sets become numbered states when a word first comes to them, so a task
    works out the steps that its own words take, each once; state 0 is the empty set, 1 the start. ``stem``
    and ``word`` are the terms (or -1) that a word has as its beginning, or is, when it comes to a state.
    """

    def __init__(self, terms: Sequence[tuple[str, bool, float]]):
        self.terms = list(terms)
        self.alphabet = "".join(sorted({c for term, _, _ in terms for c in term}))
        self.children: list[dict[int, int]] = [{}]
        self.ends: list[list[tuple[int, int]]] = [[]]
        self.most = [0]
        for number, (term, stem, _) in enumerate(terms):
            node, edits = 0, allowed_edits(term, stem)
            self.most[0] = max(self.most[0], edits)
            for letter in term:
                code = self.alphabet.index(letter) + 2
                if code not in self.children[node]:
                    self.children.append({})
                    self.ends.append([])
                    self.most.append(0)
                    self.children[node][code] = len(self.children) - 1
                node = self.children[node][code]
                self.most[node] = max(self.most[node], edits)
            self.ends[node].append((edits, number))
        self.numbers: dict[frozenset, int] = {}
        self.states: list[frozenset] = []
        self.step = np.zeros((0, len(self.alphabet) + 2), np.int32)
        self.stem, self.word, self.fuzzy = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        self._numbered(frozenset())
        self._numbered(self._closed({(0, 0): 0}))
        self.step[0] = 0

    def _numbered(self, state: frozenset) -> int:
        at = self.numbers.get(state)
        if at is None:
            at = self.numbers[state] = len(self.states)
            self.states.append(state)
            if at >= len(self.step):
                more = max(64, at)
                self.step = np.concatenate([self.step, np.full((more, self.step.shape[1]), -1, np.int32)])
                self.stem, self.word = (np.concatenate([x, np.full(more, -1)]) for x in (self.stem, self.word))
                self.fuzzy = np.concatenate([self.fuzzy, np.zeros(more, bool)])
            self.stem[at], self.word[at], self.fuzzy[at] = self._verdict(state)
        return at

    def _closed(self, found: dict[tuple[int, int], int]) -> frozenset:
        """With left-out letters; for each node and owed letter the fewest edits."""
        todo = list(found.items())
        while todo:
            (node, owed), e = todo.pop()
            if owed or found[node, owed] < e:
                continue
            for child in self.children[node].values():
                if e < self.most[child] and e + 1 < found.get((child, 0), 9):
                    found[child, 0] = e + 1
                    todo.append(((child, 0), e + 1))
        return frozenset((n, o, e) for (n, o), e in found.items())

    def _moved(self, state: frozenset, code: int) -> frozenset:
        found: dict[tuple[int, int], int] = {}

        def put(node: int, owed: int, e: int) -> None:
            if e <= self.most[node] and e < found.get((node, owed), 9):
                found[node, owed] = e

        for node, owed, e in state:
            if owed:
                if owed == code:
                    put(node, 0, e)
                continue
            if e < self.most[node]:
                for letter, child in self.children[node].items():
                    put(child, 0, e + (letter != code))
                    after = self.children[child].get(code)
                    if after is not None and letter != code:
                        put(after, letter, e + 1)
                put(node, 0, e + 1)
            elif code in self.children[node]:
                put(self.children[node][code], 0, e)
        return self._closed(found)

    def _verdict(self, state: frozenset) -> tuple[int, int, bool]:
        """The likeliest stem and whole word here, and whether the word is misspelled."""
        stem, word, rank = -1, -1, (False, -1.0)
        for node, owed, e in state:
            for edits, number in self.ends[node]:
                if owed or e > edits:
                    continue
                odds = self.terms[number][2]
                if self.terms[number][1]:
                    stem = number if stem < 0 or odds > self.terms[stem][2] else stem
                elif (e == 0, odds) > rank:
                    word, rank = number, (e == 0, odds)
        return stem, word, word >= 0 and not rank[0]

    def after(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The next states; steps that no word has taken yet are worked out."""
        now = self.step[states, codes]
        new = np.flatnonzero(now < 0)
        if len(new):
            width = self.step.shape[1]
            for pair in np.unique(states[new].astype(np.int64) * width + codes[new]).tolist():
                state, code = divmod(pair, width)
                to = self._numbered(self._moved(self.states[state], code))
                self.step[state, code] = to
            now = self.step[states, codes]
        return now


def build_automaton(terms: Sequence[tuple[str, bool, float]]) -> Automaton:
    return Automaton(terms)


def find_terms(automaton: Automaton, odds: np.ndarray, classes: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """For each word its likeliest term or -1, and whether misspelled. All words take their next letter together."""
    rank = np.append(odds, -np.inf)  # at -1: no term
    state = np.ones(len(starts), np.int32)
    term = np.full(len(starts), -1)
    active = np.arange(len(starts))
    place = starts.copy()
    while len(active):
        now = automaton.after(state[active], classes[place[active]])
        state[active] = now
        place[active] += 1
        stem = automaton.stem[now]
        better = rank[stem] > rank[term[active]]
        term[active[better]] = stem[better]
        active = active[(now != 0) & (place[active] < ends[active])]
    word = np.where(place == ends, automaton.word[state], -1)
    whole = (word >= 0) & (rank[word] >= rank[term])
    return np.where(whole, word, term), whole & automaton.fuzzy[state]


def text_features(automaton: Automaton, odds: np.ndarray, data: np.ndarray, offsets: np.ndarray, table: np.ndarray, quotes: np.ndarray):
    """(text, term, value) of the different terms of each text outside quotations, and its CONTEXT.

    A hit counts as quoted if an odd number of quotation marks stands before it in its window of
    words and one more follows. ``quoted`` sums such hits, ``dense`` is about the others per word, ``window``
    about the most hits in one window, ``fuzzy`` about misspelled ones.
    """
    points, cuts = spans.code_points(data, offsets)
    limited = np.minimum(points, 0xFFFF)
    classes = table[limited]
    starts, ends, ranges = spans.word_spans(classes, cuts, np.arange(256) > 0)
    term, fuzzy = find_terms(automaton, odds, classes, starts, ends)
    hits = np.flatnonzero(term >= 0)
    texts = len(offsets) - 1
    out = np.zeros((texts, len(CONTEXT)))
    if not len(hits):
        none = np.zeros(0, np.int64)
        return (none, none, np.zeros(0)), out
    text = np.searchsorted(ranges, hits, "right") - 1
    marks = np.zeros(len(points) + 1, np.int64)
    np.cumsum(quotes[limited], out=marks[1:])
    low = np.maximum(hits - WINDOW, ranges[text])
    high = np.minimum(hits + WINDOW, ranges[text + 1] - 1)
    before = marks[starts[hits]] - marks[starts[low]]
    after = marks[ends[high]] - marks[ends[hits]]
    quoted = (before % 2 == 1) & (after > 0)
    near = np.searchsorted(hits, high, "right") - np.searchsorted(hits, low, "left")
    words = np.maximum(np.diff(ranges), 1)
    np.add.at(out[:, 0], text, quoted.astype(float))
    out[:, 1] = np.sqrt(100.0 * np.bincount(text[~quoted], minlength=texts) / words)
    np.maximum.at(out[:, 2], text, near * ~quoted)
    np.add.at(out[:, 3], text, fuzzy[hits].astype(float))
    for k in (0, 2, 3):
        out[:, k] = np.log1p(out[:, k])
    value = np.where(fuzzy[hits], FUZZY_VALUE, 1.0)[~quoted]
    pair = (text * len(odds) + term[hits])[~quoted]
    found, which = np.unique(pair, return_inverse=True)
    best = np.zeros(len(found))
    np.maximum.at(best, which, value)
    return (found // len(odds), found % len(odds), best), out


def _batch_features(automaton: Automaton, odds: np.ndarray) -> object:
    """A function from a text column to the text_features of its slices, with their first rows."""
    table = letter_table(automaton.alphabet)
    quotes = np.zeros(1 << 16, bool)
    quotes[[ord(c) for c in QUOTES]] = True

    def of(column: pa.Array) -> Iterator[tuple]:
        for start, stop in spans.slices(column):
            yield text_features(automaton, odds, *spans.flat(column[start:stop]), table, quotes)

    return of


def sparse_column(automaton: Automaton, odds: np.ndarray):
    """A column function: text -> struct<terms:array<int>,values:array<double>,context:array<double>>."""
    shape = "struct<terms:array<int>,values:array<double>,context:array<double>>"

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.struct([("terms", pa.list_(pa.int32())), ("values", pa.list_(pa.float64())), ("context", pa.list_(pa.float64()))])
        features = _batch_features(automaton, odds)
        for column in batches:
            rows = []
            for (text, term, value), context in features(column):
                cuts = np.searchsorted(text, np.arange(len(context) + 1))
                for k in range(len(context)):
                    a, b = cuts[k], cuts[k + 1]
                    rows.append({"terms": term[a:b], "values": value[a:b], "context": context[k]})
            yield pa.array(rows, kind)

    return arrow_udf(score, shape, ArrowUDFType.SCALAR_ITER)


def score_column(model: ToxicityModel):
    """A column function: text -> probability."""

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        features = _batch_features(model.automaton, model.odds)
        n = len(model.odds)
        for column in batches:
            parts = [np.zeros(0)]
            for (text, term, value), context in features(column):
                total = context @ model.beta[n:-1] + model.beta[-1]
                np.add.at(total, text, value * model.beta[term])
                parts.append(1 / (1 + np.exp(-np.clip(total, -50, 50))))
            yield pa.array(np.concatenate(parts))

    return arrow_udf(score, "double", ArrowUDFType.SCALAR_ITER)


def _fit_logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 0.5, steps: int = 50) -> np.ndarray:
    """Weights and constant of a ridge logistic regression by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    beta = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (w * (y - p)) - penalty * beta
        hessian = (x * (w * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        move = np.clip(np.linalg.solve(hessian, gradient), -4, 4)
        beta += move
        if np.abs(move).max() < 1e-6:
            break
    return beta


@dataclass
class ToxicityModel:
    """Lexicon (term, stem?, log odds), its automaton, and the weights of terms, CONTEXT and constant."""

    terms: list[tuple[str, bool, float]]
    automaton: Automaton
    odds: np.ndarray
    beta: np.ndarray


def learn_lexicon(rows: DataFrame, toxic: str, text: str) -> list[tuple[str, bool, float]]:
    """(term, stem?, log odds): words and word beginnings that mark toxic texts.

    Counted once a text, in Spark. Of the CANDIDATES that toxic texts have most surely, a longer
    beginning or a word is kept only if it is clearly likelier than every kept beginning of it; at most LEXICON terms.
    Beside these, a word that may be misspelled stays with each beginning in the lexicon that stands for it, as a
    beginning allows no edits; its odds are at least that one's, so that it comes first where both match.
    """
    words = F.array_distinct(F.split(F.regexp_replace(F.lower(text_or_empty(text)), r"[^\p{L}]+", " "), " "))
    forms = F.transform(
        words,
        lambda w: F.concat(
            F.array(F.concat(w, F.lit("$"))),
            F.transform(
                F.filter(F.array(*[F.lit(n) for n in STEM_LENGTHS]), lambda n: n < F.length(w)), lambda n: F.substr(w, F.lit(1), n)
            ),
        ),
    )
    counted = (
        rows.select(F.col(toxic).alias("_toxic"), F.explode(F.array_distinct(F.flatten(forms))).alias("term"))
        .groupBy("term")
        .agg(F.sum("_toxic").alias("bad"), F.sum(1 - F.col("_toxic")).alias("good"))
        .where((F.col("bad") >= LEAST_DOCS) & (F.length("term") >= min(STEM_LENGTHS)))
    )
    totals = rows.agg(F.sum(toxic).alias("bad"), F.sum(1 - F.col(toxic)).alias("good")).first()
    bad_all, good_all = totals["bad"] or 0, totals["good"] or 0
    odds = F.log((F.col("bad") + 0.5) / (bad_all + 1.0)) - F.log((F.col("good") + 0.5) / (good_all + 1.0))
    likely = counted.withColumn("odds", odds).where(F.col("odds") >= LEAST_ODDS)
    top = likely.orderBy(F.desc(F.col("bad") * F.col("odds")), "term").limit(CANDIDATES).collect()
    kept: dict[str, float] = {}
    beside: dict[str, list[str]] = {}
    for row in sorted(top, key=lambda r: (len(r["term"]), r["term"])):
        term, odds_of = row["term"], float(row["odds"])
        begins = [term[:n] for n in STEM_LENGTHS if n < len(term) and term[:n] in kept]
        if all(odds_of > kept[stem] + 0.5 for stem in begins):
            kept[term] = odds_of
        elif term.endswith("$") and allowed_edits(term[:-1], False):
            beside[term] = begins
    chosen = {r["term"]: r["bad"] * r["odds"] for r in top if r["term"] in kept}
    best = sorted(chosen, key=lambda t: (-chosen[t], t))[:LEXICON]
    own = {r["term"]: float(r["odds"]) for r in top}
    found = {t: kept[t] for t in best}
    for term, begins in beside.items():
        likelier = [kept[stem] for stem in begins if stem in best]
        if likelier:
            found[term] = max(own[term], *likelier)
    return sorted((t.rstrip("$"), not t.endswith("$"), odds) for t, odds in found.items())


def fit_toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", toxic: str = "toxic") -> ToxicityModel:
    """The model of the documents (_id, text) with labels (_id, toxic 0/1): at most TOXIC_ROWS and CLEAN_ROWS.

    The rows are chosen among the labels, by digest of the id, so only their ids, a bounded number, go to
    the tasks that read the texts. Without toxic or without clean rows the lexicon is empty and
    every score is the share of toxic rows.
    """
    counts = {r[toxic]: r["n"] for r in labels.groupBy(toxic).agg(F.count(F.lit(1)).alias("n")).collect()}
    order = [F.md5(F.col("_id").cast("string")), F.col("_id")]
    parts = [labels.where(F.col(toxic) == c).orderBy(*order).limit(n) for c, n in ((1, TOXIC_ROWS), (0, CLEAN_ROWS))]
    chosen = parts[0].unionByName(parts[1])
    rows = staged(docs.join(F.broadcast(chosen), "_id").select(text, toxic))
    terms = learn_lexicon(rows, toxic, text) if len(counts) == 2 else []
    automaton = build_automaton(terms)
    odds = np.array([t[2] for t in terms])
    seen = rows.select(F.col(toxic).alias("y"), sparse_column(automaton, odds)(F.col(text)).alias("x")).collect()
    y = np.array([r["y"] for r in seen], float)
    x = np.zeros((len(seen), len(terms) + len(CONTEXT)))
    for k, r in enumerate(seen):
        x[k, r["x"]["terms"]] = r["x"]["values"]
        x[k, len(terms) :] = r["x"]["context"]
    taken = {label: max(1, int((y == label).sum())) for label in (0, 1)}
    w = np.array([counts.get(int(v), 1) / taken[int(v)] for v in y])
    return ToxicityModel(terms, automaton, odds, _fit_logistic(x, y, w))


def toxicity_scores(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", toxic: str = "toxic") -> DataFrame:
    """(id, held_out, score, predicted) for every document.

    Only labels of ids whose crc32 (of the id as text) modulo 5 isn't 0 are learned from; only the text is scored. A
    null text is empty; a text without lexicon words, such as an empty one, has the score of such
    texts. Null labels are left out; a null id is held out. Rows that repeat an id stay rows, an empty table gives
    an empty one.
    """
    held = F.coalesce(F.crc32(F.col(id).cast("string")) % 5 == 0, F.lit(True))
    known = labels.select(F.col(id).alias("_id"), F.col(toxic).cast("int").alias("toxic")).where(F.col(toxic).isin(0, 1))
    train = known.where(F.crc32(F.col("_id").cast("string")) % 5 != 0).select("_id", "toxic")
    model = fit_toxicity(docs.select(F.col(id).alias("_id"), F.col(text).alias("text")), train)
    scored = docs.select(F.col(id), held.alias("held_out"), score_column(model)(F.col(text)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
