"""Toxicity: Levenshtein automata intersected with a lexicon trie, and context-window scores.

The lexicon is learned: beginnings of words, and whole words, whose share among toxic training
texts is far above their share among the others. A stem stands for all words that begin with it.
All terms form a trie; an automaton walks it with up to one edit (words of 5 letters or more,
stems of 7) or two (words of 9 or more), reading common look-alikes as their letters. The automaton
is made deterministic as words are met and run over the distinct words of a batch in step, one
letter at a time, so that most words leave it after a few letters. Each hit then gets a score from
its surroundings: an opening quotation mark before it and the matching one after it point to a
quotation, further hits in the window of words around it to abuse. A logistic model over a text's sums of these scores
gives the probability.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm import words as W
from contrail.llm.common import fold, mix64, released
from contrail.llm.op6_quality import train_ids

#: Most labelled rows to learn from, words on each side of a hit.
SAMPLE, WINDOW = 20_000, 6
#: Bytes of text that a task reads at a time: its arrays of code points take many times that.
BLOCK_BYTES = 2 << 20
#: A term has at least this lift, log-likelihood ratio (G) and these letters; a stem gives way to a
#: longer one that has SAME of its texts.
LIFT, LEAST_G, SHORTEST, LONGEST, SAME = 15.0, 25.0, 3, 16, 0.9
ONE_EDIT, TWO_EDITS, STEM_EDIT = 5, 9, 7
#: Distance of the fullwidth forms, which are read as their ASCII characters.
FULLWIDTH = 0xFEE0
#: Look-alikes that are read as letters, marks that quote.
ALIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
QUOTES = "\"“”„«»‘’"
#: The marks that close what each mark opens; some languages open with what others close with.
CLOSING = {'"': '"', "“": "”", "”": "”", "„": "“”", "«": "»", "»": "«", "‘": "’"}
FEATURES = ("any", "exact", "near", "quoted", "crowded", "density", "distinct")

_EDGE = np.zeros(256, dtype=bool)
_EDGE[[i for i in range(33, 127) if not chr(i).isalnum() and chr(i) not in "@$"]] = True


class Automaton:
    """Deterministic automaton of "within the allowed edits of a term", built as it is used.

    A term that ends with "*" is a stem: it is met by a word as soon as a beginning of the word is.
    """

    def __init__(self, terms: list[str]):
        self.terms = terms
        self.child: list[dict[str, int]] = [{}]
        self.term_at: list[int] = [-1]
        self.reach: list[int] = [0]  # most edits allowed by a term at or below the node
        for t, term in enumerate(terms):
            node = 0
            for c in term.removesuffix("*"):
                self.reach[node] = max(self.reach[node], self.allowed(term))
                if c not in self.child[node]:
                    self.child[node][c] = len(self.child)
                    self.child.append({})
                    self.term_at.append(-1)
                    self.reach.append(0)
                node = self.child[node][c]
            self.reach[node] = max(self.reach[node], self.allowed(term))
            self.term_at[node] = t
        letters = sorted({c for t in terms for c in t.removesuffix("*")})
        self.code = {c: i + 1 for i, c in enumerate(letters)}
        self.letters = [None, *letters]
        classes = {ord(c.upper()): i for c, i in self.code.items() if len(c.upper()) == 1} | {ord(c): i for c, i in self.code.items()}
        for c, as_ in ALIKE.items():
            if c not in self.code and as_ in self.code:
                classes[ord(c)] = self.code[as_]
        for x, i in list(classes.items()):
            if 0x20 < x < 0x7F:
                classes.setdefault(x + FULLWIDTH, i)
        self.points = np.array(sorted(classes), np.int64)  # all code points that stand for a letter of a term
        self.classes = np.array([classes[x] for x in self.points.tolist()], np.int32)
        self.states: dict[frozenset, int] = {frozenset(): 0}
        self.sets: list[frozenset] = [frozenset()]
        self.next = np.zeros((1, len(self.letters)), np.int32)
        self.hit = [(-1, 0)]
        self.settled = np.zeros(0, dtype=bool)
        self.start = self._state(self._closed({0: 0}))
        self.longest = max((len(t) + self.allowed(t) for t in terms), default=0)
        self.stems = any(t.endswith("*") for t in terms)

    @staticmethod
    def allowed(term: str) -> int:
        if term.endswith("*"):
            return int(len(term) > STEM_EDIT)
        return 2 if len(term) >= TWO_EDITS else 1 if len(term) >= ONE_EDIT else 0

    def letter(self, points: np.ndarray) -> np.ndarray:
        """Letter class of each code point, 0 for those that are in no term."""
        if not len(self.points):
            return np.zeros(len(points), np.int32)
        at = np.minimum(np.searchsorted(self.points, points), len(self.points) - 1)
        return np.where(self.points[at] == points, self.classes[at], 0)

    def _closed(self, edits: dict[int, int]) -> frozenset:
        """With letters left out of the word; each node with its fewest edits."""
        best = dict(edits)
        todo = list(best.items())
        while todo:
            node, e = todo.pop()
            if best[node] < e:
                continue
            for to in self.child[node].values():
                if e + 1 <= self.reach[to] and best.get(to, 99) > e + 1:
                    best[to] = e + 1
                    todo.append((to, e + 1))
        return frozenset(best.items())

    def _state(self, key: frozenset) -> int:
        if key in self.states:
            return self.states[key]
        s = self.states[key] = len(self.sets)
        self.sets.append(key)
        self.next = np.vstack([self.next, np.full((1, len(self.letters)), -1, np.int32)]) if s >= len(self.next) else self.next
        if s + 1 >= len(self.next):
            self.next = np.vstack([self.next, np.full((len(self.next), len(self.letters)), -1, np.int32)])
        ends = [(e, self.term_at[n]) for n, e in key if self.term_at[n] >= 0 and e <= self.allowed(self.terms[self.term_at[n]])]
        e, t = min(ends, default=(0, -1))
        self.hit.append((t, e))
        return s

    def _step(self, state: int, letter: int) -> int:
        out: dict[int, int] = {}

        def add(node, e):
            if e <= self.reach[node] and out.get(node, 99) > e:
                out[node] = e

        c = self.letters[letter]
        for node, e in self.sets[state]:
            add(node, e + 1)  # a letter too many
            if self.term_at[node] >= 0 and self.terms[self.term_at[node]].endswith("*") and e <= self.allowed(self.terms[self.term_at[node]]):
                add(node, e)  # the rest of a word that began with the stem
            for x, to in self.child[node].items():
                add(to, e if x == c else e + 1)
        return self._state(self._closed(out)) if out else 0

    def _settle(self) -> np.ndarray:
        """States that a stem without an edit has settled: no further letter can change the hit."""
        self.settled = np.array([any(e == 0 and self.term_at[n] >= 0 and self.terms[self.term_at[n]].endswith("*") for n, e in s) for s in self.sets])
        return self.settled

    def run(self, points: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Term (-1: none) and edits of each word, given as code points from ``start``."""
        state = np.full(len(start), self.start, np.int64)
        if not self.stems:
            state[size > self.longest] = 0
        going = np.flatnonzero((state > 0) & (size > 0))
        for k in range(int(size.max()) if len(size) else 0):
            done = self.settled[state[going]] if len(self.settled) == len(self.sets) else self._settle()[state[going]]
            going = going[(size[going] > k) & (state[going] > 0) & ~done]
            if not len(going):
                break
            p = points[start[going] + k].astype(np.int64)
            letter = self.letter(p)
            to = self.next[state[going], letter]
            new = to < 0
            if new.any():
                for s, c in np.unique(np.stack([state[going][new], letter[new]]), axis=1).T.tolist():
                    target = self._step(s, c)
                    self.next[s, c] = target
                to = self.next[state[going], letter]
            state[going] = to
        term = np.array([t for t, _ in self.hit], np.int64)[state]
        edits = np.array([e for _, e in self.hit], np.int64)[state]
        return np.where(size > 0, term, -1), edits


def _trimmed(words: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges of the words without punctuation at either end (up to three marks)."""
    start, end = words.start.copy(), words.end.copy()
    for _ in range(3):
        on = start < end
        start[on] += _EDGE[words.data[start[on]]]
        on = start < end
        end[on] -= _EDGE[words.data[end[on] - 1]]
    return start, end


def hits(column: pa.Array, automaton: Automaton):
    """Words of a block, and the place, term and edits of those that hit the lexicon."""
    words = W.split(column)
    start, end = _trimmed(words)
    none = np.zeros(0, np.int64)
    if not len(start) or not automaton.terms:
        return words, none, none, none
    uniq, first, back = np.unique(words.hash, return_index=True, return_inverse=True)
    data, at = W.utf8(column)
    lo, hi = int(at[0]), int(at[-1])
    b = data[lo:hi]
    points = np.frombuffer(b.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    place = np.zeros(len(b) + 1, np.int32)
    np.cumsum((b & 0xC0) != 0x80, out=place[1:])
    s, e = place[start[first] - lo].astype(np.int64), place[end[first] - lo].astype(np.int64)
    del place
    term, edits = automaton.run(points, s, e - s)
    got = np.flatnonzero(term[back] >= 0)
    return words, got, term[back][got], edits[back][got]


@dataclass
class Model:
    terms: list[str]
    weights: np.ndarray
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.weights + self.bias, -30, 30)))


_QUOTE_BYTES = [q.encode() for q in QUOTES]
_MARK = re.compile(f"[{QUOTES}]|\n[ \t\r]*\n")


def quotations(text: str) -> list[tuple[int, int]]:
    """Places of the opening and the closing mark of each quotation; a quotation ends with its paragraph.

    Apostrophes are no marks: one between letters, or a closing one that nothing opened. A straight mark opens
    or closes by what it touches; if that does not tell, by whether one is open. A mark that is opened again
    before it was closed starts anew.
    """
    open_: list[tuple[str, int]] = []
    out = []
    for m in _MARK.finditer(text):
        c, k = m.group()[0], m.start()
        if c == "\n":
            open_ = []
            continue
        left, right = text[k - 1 : k], text[k + 1 : k + 2]
        if c in "‘’" and left.isalpha() and right.isalpha():
            continue
        begins, ends = not left.isalnum() and right.isalnum(), left.isalnum() and not right.isalnum()
        straight = c in "\"”"
        at = next((i for i in range(len(open_) - 1, -1, -1) if c in CLOSING[open_[i][0]]), None)
        if at is not None and not (straight and begins):
            out.append((open_[at][1], k))
            del open_[at:]
        elif c in CLOSING and not (straight and ends):
            again = next((i for i, (x, _) in enumerate(open_) if x == c), len(open_))
            del open_[again:]
            open_.append((c, k))
    return out


def _quoted(words: W.Words, first: int, last: int, at: np.ndarray) -> np.ndarray:
    """Whether the letters of each of the words ``at`` lie within a quotation of their text, words ``first`` to ``last``."""
    lo, hi = int(words.start[first]), int(words.end[last])
    data = words.data[lo:hi].tobytes()
    out = np.zeros(len(at), dtype=bool)
    if not any(q in data for q in _QUOTE_BYTES):
        return out
    text = data.decode("utf-8", "replace")
    inside = np.zeros(len(text) + 1, np.int32)
    for a, z in quotations(text):
        inside[a + 1] += 1
        inside[z] -= 1
    inside = np.cumsum(inside) > 0
    place = np.cumsum((words.data[lo:hi] & 0xC0) != 0x80) - 1
    for i, k in enumerate(at.tolist()):
        a, z = int(place[words.start[k] - lo]), int(place[words.end[k] - 1 - lo])
        letters = [x for x in range(a, z + 1) if text[x].isalnum()] or [a]
        out[i] = inside[letters[0]] and inside[letters[-1]]
    return out


def features(column: pa.Array, automaton: Automaton) -> np.ndarray:
    """Sums over a text's hits of context-window scores; zeros without hits."""
    n = len(column)
    out = np.zeros((n, len(FEATURES)))
    words, at, term, edits = hits(column, automaton)
    if not len(at):
        return out
    row = words.row[at]
    total = np.bincount(words.row, minlength=n)
    begin = np.concatenate([[0], np.cumsum(total)[:-1]])
    quoted = np.zeros(len(at), dtype=bool)
    crowded = np.zeros(len(at), dtype=bool)
    crowded[1:] |= (at[1:] - at[:-1] <= WINDOW) & (row[1:] == row[:-1])
    crowded[:-1] |= crowded[1:]
    edges = np.flatnonzero(np.diff(row, prepend=-1, append=n))
    for a, z in zip(edges[:-1].tolist(), edges[1:].tolist()):
        r = row[a]
        quoted[a:z] = _quoted(words, begin[r], begin[r] + total[r] - 1, at[a:z])
    plain = ~quoted
    per = lambda w: np.bincount(row, w, n)
    exact, near = per(plain & (edits == 0)), per(plain & (edits > 0))
    sure = plain & (edits == 0)
    _, kinds = np.unique(np.stack([row[sure], term[sure]]), axis=1, return_index=True)
    out[:, 0], out[:, 1], out[:, 2], out[:, 3] = exact > 0, np.minimum(np.log1p(exact), 4), np.minimum(np.log1p(near), 3), np.log1p(per(quoted))
    out[:, 4] = np.log1p(per(sure & crowded))
    out[:, 5] = np.minimum((exact + near) / np.maximum(total, 1) * 20, 2)
    out[:, 6] = np.log1p(np.bincount(row[sure][kinds], minlength=n))
    return out


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: number of toxic and other texts that hold each word."""
    text: dict[int, bytes] = {}
    keys, counts = [], []
    for batch in batches:
        for block in W.blocks(batch, size=BLOCK_BYTES):
            words = W.split(block.column("text"))
            start, end = _trimmed(words)
            y = block.column("y").to_numpy(zero_copy_only=False) > 0
            _, first = np.unique(mix64(words.hash + words.row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
            h, at, back = np.unique(words.hash[first], return_index=True, return_inverse=True)
            toxic = y[words.row[first]]
            keys.append(h)
            counts.append(np.stack([np.bincount(back, toxic, len(h)), np.bincount(back, ~toxic, len(h))]))
            for k, i in zip(h.tolist(), first[at].tolist()):
                if k not in text:
                    text[k] = words.data[start[i] : end[i]].tobytes()
    if keys:
        h, back = np.unique(np.concatenate(keys), return_inverse=True)
        n = np.concatenate(counts, axis=1)
        term = [text[k].decode("utf-8", "replace").lower() for k in h.tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(term, pa.string()), *[pa.array(np.bincount(back, x, len(h)).astype(np.int64)) for x in n]], names=["term", "toxic", "other"])


def lexicon(counts: DataFrame, toxic: int, others: int) -> list[str]:
    """Terms from (term, toxic, other) counts: the shortest beginnings that qualify, as long as they keep their texts.

    ``$`` marks the end of a word. Counts of a beginning add up those of its words. All qualifying
    beginnings of the sample's words come to the driver, and all terms are used.
    """
    if not toxic or not others:
        return []
    words = counts.groupBy("term").agg(F.sum("toxic").alias("a"), F.sum("other").alias("b")).where(F.length("term") >= SHORTEST)
    size = F.least(F.length("term"), F.lit(LONGEST))
    starts = F.transform(F.sequence(F.lit(SHORTEST), size), lambda k: F.substring(F.col("term"), F.lit(1), k))
    begun = (words.select("a", "b", F.explode(F.concat(starts, F.array(F.concat("term", F.lit("$"))))).alias("term"))
             .groupBy("term").agg(F.sum("a").cast("double").alias("a"), F.sum("b").cast("double").alias("b")).where("a >= 3"))
    share = toxic / (toxic + others)
    part = lambda x, e: F.when(x > 0, x * F.log(x / e)).otherwise(0.0)
    n = F.col("a") + F.col("b")
    g = 2 * (part(F.col("a"), n * share) + part(F.col("b"), n * (1 - share)))
    lift = (F.col("a") / toxic) / ((F.col("b") + 0.5) / others)
    rows = begun.where((lift >= LIFT) & (g >= LEAST_G)).collect()
    found = {r.term: r.a for r in rows}
    longer: dict[str, list[str]] = {}
    for t in found:
        longer.setdefault(t[:-1], []).append(t)
    out = set()
    for t in found:
        if any(t[:k] in found for k in range(SHORTEST, len(t))):
            continue
        while (to := max(longer.get(t, []), key=lambda x: (found[x], x), default=None)) and found[to] >= SAME * found[t]:
            t = to
        out.add((found[t], t.removesuffix("$") if t.endswith("$") else t + "*"))
    return sorted(t for _, t in out)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> tuple[np.ndarray, float]:
    """Newton steps on the penalised log likelihood; the bias is not penalised.

    A hit outside quotations never speaks against toxicity: features whose weight would be below
    zero (but for ``quoted``) are left out and the rest fitted again.
    """
    use = np.ones(x.shape[1], dtype=bool)
    free = FEATURES.index("quoted")
    while True:
        a = np.column_stack([x[:, use], np.ones(len(x))])
        w = np.zeros(a.shape[1])
        w[-1] = np.log((y.sum() + 1) / (len(y) - y.sum() + 1))
        penalty = np.diag([ridge] * int(use.sum()) + [1e-6])
        for _ in range(50 if len(y) else 0):
            p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
            step = np.linalg.solve(a.T @ (a * np.maximum(p * (1 - p), 1e-6)[:, None]) + penalty, a.T @ (p - y) + penalty @ w)
            w = w - np.clip(step, -5, 5)
            if np.abs(step).max() < 1e-8:
                break
        out = np.zeros(x.shape[1])
        out[use] = w[:-1]
        below = (out < 0) & (np.arange(x.shape[1]) != free)
        if not below.any():
            return out, float(w[-1])
        use &= ~below


def train(docs: DataFrame, labels: DataFrame, use: Column, label_col: str = "toxic", sample: int = SAMPLE) -> Model:
    """Lexicon and weights from a bounded sample of labelled rows; ``use`` picks the labels that may be learned from.

    Copies of a text count once. Without toxic or without other rows the lexicon is empty and the
    score a smoothed share.
    """
    spark = docs.sparkSession
    rows = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(train_ids(labels, label_col, use, sample)), "doc_id"))
    firsts = rows.groupBy(F.xxhash64("text").alias("h"), "y").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))  # at most the sampled rows
    once = rows.join(F.broadcast(firsts.select("doc_id").distinct()), "doc_id", "left_semi")
    sizes = firsts.groupBy().agg(F.sum("y").alias("p"), F.count("*").alias("n")).first()
    p, q = sizes.p or 0, (sizes.n or 0) - (sizes.p or 0)
    counts = once.select("text", "y").mapInArrow(released(_term_counts), "term string, toxic long, other long")
    terms = lexicon(counts, int(p), int(q))
    shared = spark.sparkContext.broadcast(Automaton(terms))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in W.blocks(batch, size=BLOCK_BYTES):
                x = features(block.column("text"), shared.value)
                yield pa.RecordBatch.from_arrays([block.column("doc_id"), block.column("y"), pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "y", "x"])

    got = once.mapInArrow(released(run), "doc_id long, y double, x array<double>").sort("doc_id", "x").toPandas()  # at most the sampled rows
    weights, bias = _logistic(np.array(got["x"].tolist()).reshape(-1, len(FEATURES)), got["y"].to_numpy(float))
    return Model(terms, weights, bias)


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the score (0 to 1) of each text; null counts as empty, which has the score of no hits.

    All rows and columns stay; a column that is named like ``out`` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model, Automaton(model.terms)))
    kept = docs.drop(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, automaton = shared.value
        for batch in batches:
            for block in W.blocks(batch, text_col, BLOCK_BYTES):
                s = model.score(features(block.column(text_col), automaton))
                yield pa.RecordBatch.from_arrays([*block.columns, pa.array(s)], names=[*block.schema.names, out])

    return kept.mapInArrow(released(run), kept.select("*", F.lit(0.0).alias(out)).schema)


def held_out(doc_id: Column) -> Column:
    return fold(doc_id, 3) == 1
