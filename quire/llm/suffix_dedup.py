"""Removal of repeated byte strings by longest-previous-factor arrays.

The longest previous factor (LPF) of a position is the longest string there
that also starts at an earlier position. In suffix order it is the larger of
the common prefixes with the nearest suffix before and the nearest after that
start at a smaller position; with larger positions it is the longest *next*
factor. A string of ``length`` bytes has an earlier copy exactly where LPF is
``length`` or more.

A suffix array of the corpus would pass through one place; instead the
anchors of :mod:`quire.llm.repeats` cut it into buckets that hold all
suffixes which can agree in ``length`` bytes. In each bucket the suffixes are
sorted (prefix doubling), previous and next smaller positions are found by
pointer jumping, and their common prefixes give the LPF array. Equal
contexts of an anchor enter a bucket once, with their first place; the other
places are copies of it as they stand. Buckets of more than ``group_limit``
different contexts (a passage whose surroundings differ in very many
documents) are ordered by a Spark shuffle of 128-bit window hashes instead:
their suffixes written out would be 400 times their text. The result is the
same.

Defined results: a null text is an empty text; texts shorter than ``length``
bytes lose nothing; rows of equal number and text get equal results; a null
number sorts after all others; other columns are ignored, whatever their
names. Matches never cross documents.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import repeats as R
from quire.llm import vectors as V

LENGTH = 400
SEED = 64
_MAX = (1 << 63) - 1


#: Pairs of suffixes that are compared at a time.
_PAIRS = 1 << 16
#: Bytes that one 64-bit word of nine-bit symbols holds.
_WORD = 7


class Suffixes:
    """Suffixes of some texts (``data`` cut at ``off``), in order up to a depth
    of ``depth`` bytes or a little more; no suffix goes on into the next text.
    Suffixes that agree so far are in order of position. Those of fewer than
    ``least`` bytes are left out of the order."""

    def __init__(self, data: np.ndarray, off: np.ndarray, depth: int, least: int = 0):
        self.data, self.n = data, len(data)
        self.end = np.repeat(off[1:], np.diff(off))  # of the text that a position is in
        at = np.arange(self.n)
        symbols = data.astype(np.int64) + 1  # 0 is the end of a text
        key = np.zeros(self.n, np.int64)
        for k in range(_WORD):
            inside = np.minimum(at + k, self.n - 1) if self.n else at
            key = (key << 9) | np.where(at + k < self.end, symbols[inside], 0)
        self.depths, self.ranks = [_WORD], [self._ranked(key)]
        while self.depths[-1] < depth:
            d, r = self.depths[-1], self.ranks[-1].astype(np.int64)
            after = np.where(at + d < self.end, r[np.minimum(at + d, max(self.n - 1, 0))], 0) if self.n else r
            self.ranks.append(self._ranked(r * (self.n + 2) + after))
            self.depths.append(2 * d)
        live = np.flatnonzero(self.end - at >= least)
        self.order = live[np.argsort(self.ranks[-1][live] * np.int64(self.n + 1) + live)]

    @staticmethod
    def _ranked(key: np.ndarray) -> np.ndarray:
        """Ranks from 1; equal keys have equal ranks."""
        order = np.argsort(key)
        held = key[order]
        step = np.ones(len(key), np.int32)
        step[1:] = held[1:] != held[:-1]
        rank = np.empty(len(key), np.int32)
        rank[order] = np.cumsum(step)
        return rank

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of pairs of suffixes, as deep as they
        are sorted: equal ranks step over their depth, from deep to shallow."""
        ends = self.end[a], self.end[b]
        at = a.copy(), b.copy()
        out = np.zeros(len(a), np.int64)

        def inside():
            return [np.minimum(x, self.n - 1) for x in at]

        def go_on(step: np.ndarray, d: int) -> None:
            out[step] += d
            for x in at:
                x[step] += d

        for d, r in zip(reversed(self.depths), reversed(self.ranks)):
            x, y = inside()
            go_on((at[0] + d <= ends[0]) & (at[1] + d <= ends[1]) & (r[x] == r[y]), d)
        for _ in range(_WORD - 1):
            x, y = inside()
            go_on((at[0] < ends[0]) & (at[1] < ends[1]) & (self.data[x] == self.data[y]), 1)
        return out


def _nearest(values: np.ndarray) -> np.ndarray:
    """For each entry, the nearest one before it with a smaller value (-1:
    none). A pointer skips to where the larger entry that it stands on points;
    all entries between are larger, so no stack is needed."""
    at = np.arange(len(values)) - 1
    todo = np.arange(len(values))
    while True:
        todo = todo[at[todo] >= 0]
        todo = todo[values[at[todo]] > values[todo]]
        if not len(todo):
            return at
        at[todo] = at[at[todo]]


def factors(data: np.ndarray, off: np.ndarray, depth: int, least: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The longest previous and the longest next factor of every position, up
    to ``depth``; those below ``least`` come as 0, which spares the work on
    them. A string and its copy may overlap; neither leaves its text."""
    s = Suffixes(data, off, depth, least)
    place = s.order  # positions in suffix order
    # A pair that parts before the deepest rank within ``least`` is below it.
    known = [r for d, r in zip(s.depths, s.ranks) if d <= least]
    out = []
    for sign in (1, -1):
        best = np.zeros(s.n, np.int64)
        for way in (1, -1):
            p = place[::way]
            near = _nearest(sign * p)
            has = np.flatnonzero(near >= 0)
            mine, other = p[has], p[near[has]]
            if known:
                alike = known[-1][mine] == known[-1][other]
                mine, other = mine[alike], other[alike]
            for i in range(0, len(mine), _PAIRS):
                a = mine[i:i + _PAIRS]
                best[a] = np.maximum(best[a], s.common(a, other[i:i + _PAIRS]))
        out.append(np.where(best >= least, np.minimum(best, depth), 0))
    return out[0], out[1]


def _bucket(keep_first: bool, length: int):
    def work(batches):
        for t in R.grouped(batches, "anchor", 300):
            # In text order, each context once.
            t = t.sort_by([("did", "ascending"), ("cls", "ascending"), ("first", "ascending")]).combine_chunks()
            ctx = np.stack([t.column("anchor").to_numpy(), t.column("context").to_numpy()])
            _, once = np.unique(ctx, axis=1, return_index=True)
            t = t.take(pa.array(np.sort(once)))
            parts = t.column("part").to_pylist()
            off = np.concatenate([[0], np.cumsum([len(x) for x in parts], dtype=np.int64)])
            before, after = factors(np.frombuffer(b"".join(parts), np.uint8), off, length, length)
            hit = before >= length if keep_first else np.maximum(before, after) >= length
            open_ = t.column("open").to_numpy(zero_copy_only=False)
            hit &= np.repeat(open_, np.diff(off))
            item, first, n = R.found_ranges(hit, off)
            if len(item):
                yield pa.RecordBatch.from_arrays(
                    [t.column("cls").combine_chunks().take(pa.array(item)),
                     pa.array((t.column("first").to_numpy()[item] + first).astype(np.int32)),
                     pa.array(n.astype(np.int32))], ["cls", "first", "n"])
    return work


def repeated_windows(docs: DataFrame, length: int, seed: int, keep_first: bool, group_limit: int) -> DataFrame:
    """(cls, first, n): runs of window starts to remove, per class of text,
    apart from those that are removed as copies of a whole text."""
    texts = R.keyed(docs)
    found = R.repeated_runs(R.runs(texts, "byte", length, seed), R.write_once, ["cls", "first"])
    # One row for each different context: its first place and its places.
    kinds = R.write_once(found.groupBy("anchor", "context").agg(
        F.min(F.struct("did", "cls", "first", "n")).alias("at"), F.count(F.lit(1)).alias("places")))
    crowd = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    again = found.join(kinds.where("places > 1"), ["anchor", "context"])
    if keep_first:
        again = again.where((found["did"] != F.col("at.did")) | (found["cls"] != F.col("at.cls"))
                            | (found["first"] != F.col("at.first")))
    settled = again.select(found["cls"], found["first"], found["n"])
    wanted = kinds.join(R.write_once(crowd), "anchor").select(
        "anchor", "context", "at.cls", "at.did", "at.first", "at.n",
        (F.lit(True) if keep_first else F.col("places") == 1).alias("open"),
        (F.col("kinds") > group_limit).alias("hot"))
    parts = R.write_once(R.contexts(texts, wanted, "byte", length))
    schema = "cls binary, first int, n int"
    here = (parts.where("not hot").drop("hot").repartition("anchor").sortWithinPartitions("anchor")
            .mapInArrow(_bucket(keep_first, length), schema))
    rows = R.write_once(R.hot_windows(parts.where("hot").dropDuplicates(["anchor", "context"]), "byte", length))
    place = F.struct("did", "cls", "first")
    same = ["anchor", "h", "h2"]
    classes = R.write_once(rows.groupBy(*same).agg(F.min(place).alias("lo"), F.count(F.lit(1)).alias("c")).where("c > 1"))
    there = rows.where("open").join(classes, same)
    if keep_first:
        there = there.where(F.struct("did", "cls", "first") != F.col("lo"))
    there = there.select("cls", "first", F.lit(1).alias("n"))
    return settled.unionByName(here).unionByName(there)


def _apply(length: int):
    def work(batches):
        for b in batches:
            data, off = V.utf8(b.column("text"))
            for i, j in V.slices(off):
                whole, marks = (b.column(c).slice(i, j - i).to_pylist() for c in ("whole", "windows"))
                out = []
                for k in range(i, j):
                    raw = data[off[k]:off[k + 1]]
                    n = len(raw)
                    if n >= length and whole[k - i]:
                        out.append((n, n, 1, b""))
                    elif marks[k - i]:
                        gone = R.covered(marks[k - i], n, length)
                        spans = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
                        out.append((n, int(gone.sum()), spans, raw[~gone].tobytes()))
                    else:
                        out.append((n, 0, 0, raw.tobytes()))
                cols = list(zip(*out)) if out else [(), (), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(i, j - i), *(pa.array(c, pa.int64()) for c in cols[:3]),
                     pa.array(cols[3], pa.binary())],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])
    return work


def remove_repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED, keep_first: bool = True,
                   group_limit: int = R.GROUP_LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the kept bytes of each document.

    ``keep_first``: remove a string only where it has an earlier copy (order:
    document number, then position); else remove every copy, the first one
    included. Strings are judged on the input. A text that has copies loses
    all its bytes in the copies (and, without ``keep_first``, everywhere).
    """
    texts = R.keyed(docs)
    sizes = texts.groupBy("cls").agg(F.min("did").alias("owner"), F.count(F.lit(1)).alias("copies"))
    lists = R.to_ranges(repeated_windows(docs, length, seed, keep_first, group_limit))
    marks = R.write_once(sizes.join(lists, "cls", "left").where("copies > 1 or windows is not null"))
    rows = docs.select("doc_id", R.text_class().alias("cls"), "text").join(marks, "cls", "left")
    whole = (F.coalesce(F.col("doc_id").cast("long"), F.lit(_MAX)) > F.col("owner")) if keep_first else F.col("copies") > 1
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.coalesce(whole, F.lit(False)).alias("whole"), "windows").mapInArrow(
        _apply(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def digest(kept: DataFrame) -> DataFrame:
    """The query's columns: kept bytes as their SHA-256."""
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
