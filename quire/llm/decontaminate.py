"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman.

Words are runs of letters, digits and bytes beyond ASCII, in lower case, so
punctuation and case are no differences. The n-grams of the test items are
looked up in all texts. Those that occur are an item's seeds, less those that
the corpus shows to be common language. A count alone would take the leaks
themselves for common, so what counts is company: an occurrence is *alone* if
no second n-gram of an item stands ``NEAR`` words from it as it does in the
item. A leak, edited or not, has company; "one of the" has none. An n-gram is
common if it is alone in most of the texts that have it and in more than
``COMMON`` of all texts. Of every item the rarer half of its n-grams stays in
any case, and n-grams too near both ends of their item to have company.

A text and an item that share ``min_seeds`` seeds (all of them, for items of
fewer; one, for items that lost common n-grams or are so short that an edit in
every run of n + 1 words leaves one) are aligned locally over the part of the
text that the seeds point at; the score is the alignment's score over that of
the whole item, so an edited copy loses a little for each edit.

All work is on distinct texts. What is broadcast to find hits are two bitmaps
of bounded size (:mod:`quire.llm.sieve`); the exact join with the seeds
follows. Beyond some ten million n-grams the bitmaps fill up and occurrences
pass for company, so fewer n-grams are found common; no leak is lost by it.

Defined results: null or empty texts and items without words match nothing;
items shorter than an n-gram are one seed; equal items are items of their own;
repeated documents each get their rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm import vectors as V
from quire.llm.repeats import keyed, text_class
from quire.llm.sieve import WORDS, parted, sieved
from quire.session import materialize

N = 3
MIN_SEEDS = 2
THRESHOLD = 0.5
#: Words between two n-grams that keep each other company. The least distance
#: is past what one phrase spans (n + 3 words); in a text one more or less will do.
NEAR = range(4, 9)
#: An n-gram that is alone in more than this share of the texts may be common.
COMMON = 0.001
#: Alignment scores for an equal word, a different word and a gap.
MATCH, MISMATCH, GAP = 2, -1, -1

_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[128:] = np.arange(128, 256)
for _a, _b in ((0x30, 0x3A), (0x61, 0x7B)):
    _FOLD[_a:_b] = np.arange(_a, _b)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)


def fold(data: np.ndarray) -> np.ndarray:
    """Lower case (ASCII and Latin-1 letters) with blanks for punctuation."""
    out = _FOLD[data]
    if len(data) > 1:
        upper = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[1:][upper] += 0x20
    return out


def folded_words(data: np.ndarray, off: np.ndarray):
    """Word hashes and bounds per row."""
    data = fold(data)
    s, e, bounds = V.words(data, off)
    return V.byte_prefix(data).span(s, e), bounds


def _grams(h: np.ndarray, bounds: np.ndarray, n: int):
    """Row, place and hash of each n-gram; a shorter row is one gram."""
    p = V.Prefix(h)
    full = np.flatnonzero(V.room(bounds) >= n) if len(h) else np.zeros(0, np.int64)
    size = np.diff(bounds)
    short = np.flatnonzero((size > 0) & (size < n))
    row = np.concatenate([V.rows_of(bounds)[full], short])
    at = np.concatenate([full, bounds[:-1][short]])
    gram = np.concatenate([p.span(full, full + n), p.span(bounds[:-1][short], bounds[1:][short])])
    return row, at - bounds[row], V.signed(gram)


def item_grams(items: DataFrame, n: int) -> DataFrame:
    """One row for each n-gram of an item; ``near`` holds what it forms with
    the n-grams that keep it company."""
    def work(batches):
        for b in batches:
            data, off = V.utf8(b.column("text"))
            d, o = data[off[0]:off[-1]], off - off[0]
            h, bounds = folded_words(d, o)
            r, at, g = _grams(h, bounds, n)
            r_ = pa.array(r)
            raw = [bytes(h[a:z].tobytes()) for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            near = [[] for _ in range(len(g))]
            for i, j, both in _company(bounds[r] + at, r, g, NEAR):
                for k, v in zip(i.tolist(), both.tolist()):
                    near[k].append(v)
            yield pa.RecordBatch.from_arrays(
                [b.column("item").take(r_), b.column("item_id").take(r_), pa.array(g), pa.array(at.astype(np.int32)),
                 pa.array(raw, pa.binary()).take(r_), pa.array(near, pa.list_(pa.int64()))],
                ["item", "item_id", "gram", "at", "words", "near"])
    return items.mapInArrow(work, "item long, item_id long, gram long, at int, words binary, near array<long>")


def _company(place: np.ndarray, row: np.ndarray, gram: np.ndarray, distances):
    """For each distance, the pairs of n-grams (by index) of one row that are
    that far apart, and one hash of both. ``place`` ascends."""
    for d in distances:
        j = np.searchsorted(place, place + d)
        i = np.flatnonzero(j < len(place))
        j = j[i]
        same = (place[j] == place[i] + d) & (row[j] == row[i])
        i, j = i[same], j[same]
        yield i, j, V.signed(V.mix(V.mix(gram[i].astype(V.U)) + gram[j].astype(V.U)))


def _bitmap(values: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """As in the sieve, but over the hash ``v`` itself, which numpy has too. At
    most WORDS rows of two longs come to the driver, whatever the items are."""
    bits = values.select(F.expr(f"v & {WORDS * 64 - 1}").alias("s")).select(
        F.expr("shiftright(s, 6)").alias("w"), F.expr("shiftleft(1L, int(s & 63))").alias("b")) \
        .groupBy("w").agg(F.expr("bit_or(b)").alias("b"))
    found = bits.collect()
    return np.array([r["w"] for r in found], np.int64), np.array([r["b"] for r in found], np.int64)


def _has(table: np.ndarray, v: np.ndarray) -> np.ndarray:
    spot = v & (WORDS * 64 - 1)
    return (table[spot >> 6] >> (spot & 63) & 1).astype(bool)


def hits(texts: DataFrame, grams: DataFrame, n: int) -> DataFrame:
    """(cls, did, gram, pos, alone): n-grams of texts that may be an item's,
    and whether they lack company."""
    maps = [_bitmap(grams.select(F.col("gram").alias("v"))), _bitmap(grams.select(F.explode("near").alias("v")))]

    def work(batches):
        tables = np.zeros((2, WORDS), np.int64)
        for table, (where, value) in zip(tables, maps):
            table[where] = value
        for b in batches:
            data, off = V.utf8(b.column("text"))
            for i, j in V.slices(off):
                h, bounds = folded_words(data[off[i]:off[j]], off[i:j + 1] - off[i])
                r, at, g = _grams(h, bounds, n)
                ok = np.flatnonzero(_has(tables[0], g))
                if len(ok):
                    r, at, g = r[ok], at[ok], g[ok]
                    alone = np.ones(len(g), bool)
                    order = np.argsort(bounds[r] + at, kind="stable")
                    for x, y, both in _company((bounds[r] + at)[order], r[order], g[order],
                                               range(NEAR.start - 1, NEAR.stop + 1)):
                        known = _has(tables[1], both)
                        alone[order[x[known]]] = alone[order[y[known]]] = False
                    r_ = pa.array(r + i)
                    yield pa.RecordBatch.from_arrays(
                        [b.column("cls").take(r_), b.column("did").take(r_), pa.array(g), pa.array(at.astype(np.int32)),
                         pa.array(alone)], ["cls", "did", "gram", "pos", "alone"])
    return texts.mapInArrow(work, "cls binary, did long, gram long, pos int, alone boolean")


def rare_seeds(grams: DataFrame, found: DataFrame, n_texts: int, n: int = N, min_seeds: int = MIN_SEEDS) -> DataFrame:
    """(item, item_id, gram, at, words, need): the seeds of each item. N-grams
    that the corpus lacks (an edit broke them) are none."""
    per_item = grams.groupBy("item", "item_id", "gram", "words").agg(
        F.min("at").alias("at"),
        F.max((F.col("at") >= NEAR.start) | (F.col("at") + n + NEAR.start <= F.expr("length(words) div 8"))).alias("can"))
    # Texts first, so that a frequent n-gram is counted in many tasks.
    use = found.groupBy("gram", "cls").agg(F.min("alone").alias("alone")) \
        .groupBy("gram").agg(F.count(F.lit(1)).alias("n"), F.count_if("alone").alias("alone"))
    common = F.col("can") & (F.col("alone") * 2 > F.col("n")) & (F.col("alone") > COMMON * n_texts)
    item = Window.partitionBy("item")
    ranked = per_item.join(use, "gram").withColumn("common", common) \
        .withColumn("of", F.count(F.lit(1)).over(item)) \
        .withColumn("rank", F.row_number().over(item.orderBy("common", "alone", F.xxhash64("gram"), "gram")))
    kept = ranked.where(~F.col("common") | (F.col("rank") * 2 <= F.col("of") + 1)) \
        .withColumn("left", F.count(F.lit(1)).over(item))
    need = F.least(F.lit(min_seeds), F.col("left"), F.expr(f"length(words) div {8 * (n + 1)}"))
    need = F.when(F.col("left") < F.col("of"), F.lit(1)).otherwise(F.greatest(need, F.lit(1)))
    return kept.select("item", "item_id", "gram", "at", "words", need.alias("need"))


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Best local alignment score and the end of its part in ``text``. One
    pass for each word of the item, over all of the text at once: with a fixed
    gap price, the best way along a row is a running maximum."""
    m = len(text)
    step = -GAP * np.arange(m + 1)
    row = np.zeros(m + 1, np.int64)
    best, end = 0, 0
    for w in item:
        now = np.maximum(row + GAP, 0)
        now[1:] = np.maximum(now[1:], row[:-1] + np.where(text == w, MATCH, MISMATCH))
        now = np.maximum.accumulate(now + step) - step
        row = now
        k = int(row.argmax())
        if row[k] > best:
            best, end = int(row[k]), k
    return best, end


def _score(batches):
    for b in batches:
        out = []
        for k in range(b.num_rows):
            data = np.frombuffer((b.column("text")[k].as_py() or "").encode(), np.uint8)
            words, _ = folded_words(data, np.array([0, len(data)]))
            for c in b.column("pairs")[k].as_py():
                item = np.frombuffer(c["words"], V.U)
                a = max(0, c["lo"] - len(item) // 2 - 8)
                part = words[a:c["hi"] + len(item) + len(item) // 2 + 8]
                score, end = align(item, part)
                back, size = align(item[::-1], part[:end][::-1])
                out.append((b.column("cls")[k].as_py(), c["item_id"], score / (MATCH * len(item)),
                            a + end - size, a + end, c["seeds"]))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.int64(), pa.float64(), pa.int32(),
                                                            pa.int32(), pa.int32()))],
                ["cls", "item_id", "score", "first_word", "end_word", "n_seeds"])


def scored(docs: DataFrame, items: DataFrame, n: int = N, min_seeds: int = MIN_SEEDS) -> DataFrame:
    """(cls, item_id, score, first_word, end_word, n_seeds) of every text
    class and item that share enough seeds."""
    texts = keyed(docs)
    named = materialize(items.select(F.monotonically_increasing_id().alias("item"),
                                     F.col("item_id").cast("long").alias("item_id"), "text"))
    grams = materialize(item_grams(named, n))
    found = materialize(hits(texts, grams, n))
    seeds = materialize(rare_seeds(grams, found, docs.count(), n, min_seeds))
    pairs = found.join(seeds.select("gram", "item", "need", "at"), "gram").groupBy("cls", "did", "item").agg(
        F.countDistinct("gram").cast("int").alias("seeds"), F.first("need").alias("need"),
        F.min(F.col("pos") - F.col("at")).alias("lo"), F.max(F.col("pos") - F.col("at")).alias("hi"))
    pairs = pairs.where(F.col("seeds") >= F.col("need"))
    words = seeds.select("item", "item_id", "words").distinct()
    # One place for each distinct text (the one of the lowest number).
    first = pairs.groupBy("cls", "item").agg(F.min(F.struct("did", "seeds", "lo", "hi")).alias("p"))
    first = materialize(first.join(words, "item").select("cls", "p.*", "item_id", "words"))
    # A text's pairs travel as one list, bounded by its own hits.
    lists = first.groupBy("cls", "did").agg(F.collect_list(F.struct("item_id", "words", "lo", "hi", "seeds")).alias("pairs"))
    parts = sieved(texts, first.select("cls"), ["cls"]).join(lists, ["cls", "did"]).dropDuplicates(["cls", "did"])
    return parts.select("cls", "text", "pairs").mapInArrow(
        _score, "cls binary, item_id long, score double, first_word int, end_word int, n_seeds int")


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, **how) -> DataFrame:
    """doc_id, item_id, score and place (words) for every document and item
    whose alignment reaches the threshold."""
    leaks = materialize(scored(docs, items, **how).where(F.col("score") >= threshold))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_class().alias("cls"))
    return rows.join(leaks, "cls").select("doc_id", "item_id", "score", "first_word", "end_word", "n_seeds")


def keep_clean(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents without a leak, with their own columns. Texts that surely
    have none are not shuffled."""
    leaks = materialize(scored(docs, items).where(F.col("score") >= threshold).select("cls").distinct())
    may, sure = parted(docs.select(F.struct(*docs.columns).alias("row"), text_class().alias("cls")), leaks, ["cls"])
    return sure.select("row.*").unionByName(may.join(leaks, "cls", "left_anti").select("row.*"))
