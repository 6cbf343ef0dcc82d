"""Toxicity by a learned lexicon, misspellings and context.

1. From labelled rows (at most about ``TRAIN_ROWS``, drawn evenly by a hash of
   the number; near copies count once) words and word beginnings that mark
   toxic texts are taken into a lexicon, with their log odds as weights.
2. The words of the lexicon form a trie. Intersected with a Levenshtein
   automaton (one edit from five letters, two from eight) it is a finite
   automaton over characters; its states are built when first needed. It finds
   misspelled terms in one step for each character. A term's misspellings have
   a weight of their own, held down by how often clean texts have them.
3. A hit inside quotation marks, or near words that report speech, counts as
   quotation, else as abuse. The score is a logistic function of the sums of
   both kinds, fitted on the same rows.

Scores use the text alone. Labels of held-out rows are never read.

Defined results: null and empty texts get the score of a text without hits; a
number with several labels counts as toxic if one says so; null numbers have
no label and are not held out; without labelled rows, or with one class only,
every score is the share of toxic rows (0.5 where there are none); other
columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import vectors as V
from quire.llm.sieve import sieved
from quire.session import materialize

TRAIN_ROWS = 20000
#: Labelled texts are near copies if so many least hashes agree.
LEAST_HASHES = 6
#: Entries of the lexicon, best first; a term needs this many texts and odds.
LEXICON = 2000
LEAST_TEXTS, LEAST_SHARE, LEAST_WEIGHT, CHANCE = 3, 0.01, 3.0, 0.0
STEMS = (4, 5, 6)
FUZZY = 0.6
WINDOW = 6
_STRIP = ".,;:!?\"'()[]{}<>«»„“”‘’…|*#$%&-_/\\"
_OPEN, _CLOSE = "\"“„«‘", "\"”“»’"
_REPORT = frozenset("said says wrote writes quote quoted quoting called term word slur".split())
_LEET = str.maketrans("013457@$", "oieastas")


def held_out(doc_id):
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


class Lexicon:
    """Terms and stems with weights, and the trie's automaton."""

    def __init__(self, terms: dict[str, float], stems: dict[str, float], fuzzy: dict[str, float] | None = None):
        self.terms, self.stems, self.fuzzy = terms, stems, fuzzy
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.most: list[int] = [0]
        for t in sorted(terms):
            limit = 2 if len(t) >= 8 else 1 if len(t) >= 5 else 0
            node = 0
            for c in t:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                    self.most.append(0)
                self.most[node] = max(self.most[node], limit)
                node = self.children[node][c]
            self.most[node] = max(self.most[node], limit)
            self.term[node] = t
        self.start = self._close({0: 0})
        self.steps: dict = {}

    def _close(self, state: dict[int, int]):
        """Add nodes reached by leaving out characters of a term."""
        todo = list(state.items())
        while todo:
            node, e = todo.pop()
            for child in self.children[node].values():
                if e + 1 <= self.most[child] and e + 1 < state.get(child, 9):
                    state[child] = e + 1
                    todo.append((child, e + 1))
        return frozenset(state.items())

    def _step(self, state: frozenset, c: str) -> frozenset:
        out: dict[int, int] = {}

        def add(node, e):
            if e <= self.most[node] and e < out.get(node, 9):
                out[node] = e

        for node, e in state:
            add(node, e + 1)
            for d, child in self.children[node].items():
                add(child, e + (d != c))
        return self._close(out)

    def misspelled(self, word: str) -> str | None:
        """The term that ``word`` is within its edits of (the nearest; ties:
        the first in order), or None."""
        state = self.start
        for c in word:
            key = (state, c)
            after = self.steps.get(key)
            if after is None:
                if len(self.steps) > 200000:
                    self.steps.clear()
                after = self.steps[key] = self._step(state, c)
            if not after:
                return None
            state = after
        found = [(e, self.term[n]) for n, e in state if self.term[n] is not None
                 and e <= (2 if len(self.term[n]) >= 8 else 1 if len(self.term[n]) >= 5 else 0)]
        return min(found)[1] if found else None

    def match(self, token: str) -> tuple[str, float] | None:
        """(entry, weight) of a token; fuzzy entries begin with ``~``."""
        word = token.strip(_STRIP)
        if not word:
            return None
        best = self.terms.get(word)
        hit = (word, best) if best is not None else None
        for k in STEMS:
            w = self.stems.get(word[:k]) if len(word) >= k else None
            if w is not None and (hit is None or w > hit[1]):
                hit = (word[:k] + "*", w)
        if hit is None:
            term = self.misspelled(word.translate(_LEET)) if len(word) >= 4 else None
            if term is not None:
                w = FUZZY * self.terms[term] if self.fuzzy is None else self.fuzzy.get(term, FUZZY * self.terms[term])
                hit = ("~" + term, w) if w > 0 else None
        return hit


class _Cache(dict):
    """Tokens seen by this worker; started again when large."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon

    def __missing__(self, token):
        if len(self) > 300000:
            self.clear()
        m = self[token] = self.lexicon.match(token)
        return m


def quoted(tokens: list[str], k: int) -> bool:
    """Whether token ``k`` stands in quotation marks or reported speech."""
    before, after = tokens[max(0, k - WINDOW):k + 1], tokens[k:k + WINDOW + 1]
    opened = next((True for t in reversed(before) if t[:1] in _OPEN), False)
    closed = any(t.rstrip(".,;:!?")[-1:] in _CLOSE for t in after if t)
    return (opened and closed) or any(t.strip(_STRIP) in _REPORT for t in before + after)


def evidence(text: str | None, cache: _Cache) -> tuple[float, float, list[str]]:
    """Sums of weights of different entries, as abuse and as quotation."""
    tokens = (text or "").lower().split()
    abuse: dict[str, float] = {}
    quote: dict[str, float] = {}
    for k, m in enumerate(map(cache.__getitem__, tokens)):
        if m is not None:
            into = quote if quoted(tokens, k) else abuse
            into[m[0]] = m[1]
    return sum(abuse.values()), sum(w for e, w in quote.items() if e not in abuse), sorted(abuse.keys() | quote.keys())


def _features(text: str | None):
    words = {t.strip(_STRIP) for t in (text or "").lower().split()}
    out = {("w", w) for w in words if len(w) >= 4}
    out.update(("p", w[:k]) for w in words for k in STEMS if len(w) > k)
    return out


def training_rows(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """(text, toxic) of labelled rows that are not held out, one for each
    group of near copies (``LEAST_HASHES`` least hashes of three words agree; of
    texts of fewer than three words, those that are equal)."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")) \
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))) \
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = materialize(known)
    n = max(known.count(), 1)
    drawn = materialize(known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(min(1.0, rows / n) * (1 << 30))))
    texts = sieved(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), drawn, ["doc_id"]).join(drawn, "doc_id")

    def least(batches):
        for b in batches:
            data, off = V.utf8(b.column("text"))
            d, o = data[off[0]:off[-1]], off - off[0]
            s, e, bounds = V.words(d, o)
            p = V.Prefix(V.byte_prefix(d).span(s, e))
            h = np.full((len(o) - 1, LEAST_HASHES), np.iinfo(V.U).max, V.U)
            at = np.flatnonzero(V.room(bounds) >= 3) if len(s) else np.zeros(0, np.int64)
            grams = p.span(at, at + 3)
            for k in range(LEAST_HASHES):
                np.minimum.at(h[:, k], V.rows_of(bounds)[at], V.mix(grams ^ V.mix(np.array([k], V.U))))
            short = np.diff(bounds) < 3
            yield pa.RecordBatch.from_arrays(
                [b.column("text"), b.column("toxic"), pa.array([x.tobytes() for x in h], pa.binary()),
                 pc.if_else(pa.array(short), b.column("text"), pa.scalar(None, b.column("text").type))],
                ["text", "toxic", "least", "short"])

    return materialize(texts.select("text", "toxic").mapInArrow(least, "text string, toxic int, least binary, short string")
                       .dropDuplicates(["least", "short", "toxic"]).select("text", "toxic"))


def learn_lexicon(rows: DataFrame) -> Lexicon | None:
    """The lexicon of (text, toxic) rows; what reaches the driver is at most
    ``LEXICON`` entries."""
    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    pos, neg = sizes.get(1, 0), sizes.get(0, 0)
    if not pos or not neg:
        return None

    def count(batches):
        for b in batches:
            one, zero = Counter(), Counter()
            for text, toxic in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist()):
                (one if toxic == 1 else zero).update(_features(text))
            if one or zero:
                keys = list(one.keys() | zero.keys())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[0] for k in keys]), pa.array([k[1] for k in keys]),
                     pa.array([one[k] for k in keys]), pa.array([zero[k] for k in keys])], ["kind", "term", "a", "b"])

    found = rows.mapInArrow(count, "kind string, term string, a long, b long").groupBy("kind", "term").agg(
        F.sum("a").alias("a"), F.sum("b").alias("b")).where(F.col("a") >= max(LEAST_TEXTS, LEAST_SHARE * pos))
    weight = F.log((F.col("a") + 0.5) / (pos + 1.0)) - F.log((F.col("b") + 0.5) / (neg + 1.0))
    # Of many candidates some look telling by chance: the evidence (log
    # likelihood ratio against the share of toxic texts) must outweigh their number.
    found = materialize(found)
    share = pos / (pos + neg)
    t = F.col("a") + F.col("b")
    ratio = F.col("a") * F.log(F.col("a") / (t * share)) + F.when(
        F.col("b") > 0, F.col("b") * F.log(F.col("b") / (t * (1 - share)))).otherwise(0.0)
    best = found.withColumn("weight", weight).where(
        (F.col("weight") >= LEAST_WEIGHT) & (ratio >= math.log(found.count() + 1) + CHANCE)) \
        .orderBy(F.col("weight").desc(), F.col("a").desc(), "kind", "term").limit(LEXICON).collect()
    terms = {r["term"]: r["weight"] for r in best if r["kind"] == "w"}
    stems = {r["term"]: r["weight"] for r in best if r["kind"] == "p"}
    plain = Lexicon(terms, stems)
    if not terms:
        return plain

    def misses(batches):
        cache = _Cache(plain)
        for b in batches:
            one, zero = Counter(), Counter()
            for text, toxic in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist()):
                hits = {m[0][1:] for m in map(cache.__getitem__, (text or "").lower().split()) if m and m[0][0] == "~"}
                (one if toxic == 1 else zero).update(hits)
            keys = list(one.keys() | zero.keys())
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array([one[k] for k in keys]),
                                                  pa.array([zero[k] for k in keys])], ["term", "a", "b"])

    fuzzy = {}
    for r in rows.mapInArrow(misses, "term string, a long, b long").groupBy("term").agg(
            F.sum("a").alias("a"), F.sum("b").alias("b")).collect():  # at most one row for each term
        odds = math.log((r["a"] + 0.5) / (pos + 1.0)) - math.log((r["b"] + 0.5) / (neg + 1.0))
        full = FUZZY * terms[r["term"]]
        fuzzy[r["term"]] = full if not r["b"] else max(0.0, min(full, odds))
    return Lexicon(terms, stems, fuzzy)


def _sums(rows: DataFrame, lexicon: Lexicon, keep: list[str], schema: str) -> DataFrame:
    terms, stems, fuzzy = lexicon.terms, lexicon.stems, lexicon.fuzzy

    def work(batches):
        cache = _Cache(Lexicon(terms, stems, fuzzy))
        for b in batches:
            for i in range(0, b.num_rows, 500):
                t = b.slice(i, 500)
                out = [evidence(x, cache) for x in t.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(t.column(c) for c in keep), pa.array([x[0] for x in out], pa.float64()),
                     pa.array([x[1] for x in out], pa.float64()), pa.array([",".join(x[2]) for x in out])],
                    [*keep, "abuse", "quote", "hits"])

    return rows.select(*keep, "text").mapInArrow(work, f"{schema}, abuse double, quote double, hits string")


def fit(cells: list[tuple[float, float, int, int]]) -> tuple[float, float, float]:
    """Logistic weights (abuse, quote, constant) by Newton steps with a small
    ridge, over counted cells (abuse, quote, toxic, rows)."""
    x = np.array([(a, q, 1.0) for a, q, _, _ in cells])
    y, n = np.array([c[2] for c in cells], float), np.array([c[3] for c in cells], float)
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (n * (y - p)) - np.array([1.0, 1.0, 1e-3]) * w
        hess = (x * (n * p * (1 - p))[:, None]).T @ x + np.diag([1.0, 1.0, 1e-3])
        step = np.linalg.solve(hess, g)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return tuple(w.tolist())


_CELL = 40.0


def score(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted and the matched entries."""
    train = training_rows(docs, labels, rows)
    lexicon = learn_lexicon(train)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if lexicon is None:
        share = train.agg(F.coalesce(F.avg("toxic"), F.lit(0.5))).first()[0]
        out = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.lit(float(share)).alias("score"),
                          F.lit("").alias("hits"))
    else:
        def cut(c):  # whole quarters up to a bound: a bounded number of cells
            return F.least(F.round(F.col(c) * 4) / 4, F.lit(_CELL))
        cells = _sums(train, lexicon, ["toxic"], "toxic int").groupBy(
            cut("abuse").alias("a"), cut("quote").alias("q"), "toxic").count().collect()
        wa, wq, w0 = fit([(r["a"], r["q"], r["toxic"], r["count"]) for r in cells])
        line = F.least(F.col("abuse"), F.lit(_CELL)) * wa + F.least(F.col("quote"), F.lit(_CELL)) * wq + w0
        out = _sums(docs, lexicon, ["doc_id"], "doc_id long").select(
            "doc_id", held_out(F.col("doc_id")).alias("held_out"), (1 / (1 + F.exp(-line))).alias("score"), "hits")
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "hits")
