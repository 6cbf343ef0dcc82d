"""Strings of a fixed length that occur more than once in a corpus.

Shared by the two operators on repeated text. A *unit* is a byte or a word;
a *window* is ``length`` consecutive units of one text. Writing out every
window would multiply the corpus, so the search narrows down:

1. each window has an anchor: the run of ``seed`` units in it with the lowest
   hash (ties: the first). Equal windows have equal anchors at equal places.
   Consecutive windows with one anchor form a *run*; there is about one run
   for ``length / 2`` units. Only anchors that occur at two places go on.
   This is a plain aggregation with map-side combine: a passage that a third
   of all documents share costs one row for each task;
2. the *context* of a run is all units that its windows cover. Runs of equal
   (anchor, context) are known by hash, so copies of a passage collapse;
3. what remains are the different contexts of one anchor, where a repeated
   passage begins or ends. They are compared window by window.

Anchors and contexts are known by 64-bit hashes (see :mod:`quire.llm.vectors`),
so only contexts of one anchor could be taken for one another; what is removed
is decided on the texts themselves, or for crowded anchors on the anchor and
two independent hashes of the window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import vectors as V
from quire.llm.sieve import sieved

#: An anchor with more different contexts than this is compared through a
#: shuffle on window hashes instead of inside one task (same result).
GROUP_LIMIT = 4096


def text_class(text: str = "text"):
    """16-byte key of a text: equal texts are one class (null: empty)."""
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def _units(data: np.ndarray, off: np.ndarray, unit: str, family: int = 0):
    """Prefix hash over units, unit bounds per row, and unit spans in bytes."""
    p = V.byte_prefix(data, family)
    if unit == "byte":
        return p, off, None, None
    s, e, b = V.words(data, off)
    return V.Prefix(p.span(s, e)), b, s, e


def _runs(data: np.ndarray, off: np.ndarray, unit: str, length: int, seed: int):
    """Runs of windows with one anchor: row, anchor, context, first window
    (unit number in its row) and number of windows."""
    p, bounds, _, _ = _units(data, off, unit)
    n = int(bounds[-1])
    if n < length:
        z = np.zeros(0, np.int64)
        return z, z, z, z, z
    grams = p.span(np.arange(n - seed + 1), np.arange(seed, n + 1))
    at = V.lowest(grams, length - seed + 1)
    left = V.room(bounds)
    ok = left[:len(at)] >= length
    head = ok.copy()
    head[1:] &= ~ok[:-1] | (at[1:] != at[:-1])
    row = V.rows_of(bounds)
    head[1:] |= ok[1:] & (row[1:len(at)] != row[:len(at) - 1])
    first = np.flatnonzero(head)
    counts = np.add.reduceat(ok, first).astype(np.int64) if len(first) else first
    where = at[first]
    context = V.mix(p.span(first, first + counts + length - 1) ^ V.mix((where - first).astype(V.U)))
    return row[first], V.signed(grams[where]), V.signed(context), first - bounds[row[first]], counts


def runs(texts: DataFrame, unit: str, length: int, seed: int) -> DataFrame:
    """(cls, did, text) to one row for each run: anchor, context, cls, did, first, n."""
    schema = "anchor long, context long, cls binary, did long, first int, n int"

    def work(batches):
        for b in batches:
            data, off = V.utf8(b.column("text"))
            for i, j in V.slices(off):
                r, a, c, f, n = _runs(data[off[i]:off[j]], off[i:j + 1] - off[i], unit, length, seed)
                r = pa.array(r + i)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a), pa.array(c), b.column("cls").take(r), b.column("did").take(r),
                     pa.array(f.astype(np.int32)), pa.array(n.astype(np.int32))],
                    ["anchor", "context", "cls", "did", "first", "n"])

    return texts.select("cls", "did", "text").mapInArrow(work, schema)


def repeated_runs(all_runs: DataFrame, write, place: list[str]) -> DataFrame:
    """Runs whose anchor occurs at two places at least, one row for each
    class and run (with the lowest ``did`` of the class), written once.
    ``place``: the columns that tell one place from another."""
    spot = F.xxhash64(*place)
    twice = write(all_runs.groupBy("anchor").agg(F.min(spot).alias("lo"), F.max(spot).alias("hi"))
                  .where("lo <> hi").select("anchor"))
    kept = write(sieved(all_runs, twice, ["anchor"]).join(twice, "anchor"))
    return write(kept.groupBy("anchor", "context", "cls", "first", "n").agg(F.min("did").alias("did")))


def contexts(texts: DataFrame, wanted: DataFrame, unit: str, length: int) -> DataFrame:
    """The units of the wanted runs. ``texts``: rows (cls, did, text);
    ``wanted``: anchor, context, cls, did, first, n and two flags of the caller.

    The runs of a text travel as one list (bounded by its own length). Rows
    of equal text and number give a run more than once; callers allow for it."""
    names = ["anchor", "context", "first", "n", "open", "hot"]
    schema = "anchor long, context long, first int, n int, open boolean, hot boolean, did long, cls binary, part binary"
    lists = wanted.groupBy("cls", "did").agg(F.collect_list(F.struct(*names)).alias("runs"))

    def work(batches):
        for b in batches:
            data, off = V.utf8(b.column("text"))
            for i, j in V.slices(off):
                d, o = data[off[i]:off[j]], off[i:j + 1] - off[i]
                _, bounds, s, e = _units(d, o, unit)
                part = b.column("runs").slice(i, j - i)
                flat = part.flatten()
                r = V.rows_of(np.concatenate([[0], np.cumsum(pc.list_value_length(part).to_numpy())]))
                cols = [flat.field(k) for k in names]
                a = bounds[r] + cols[2].to_numpy()
                z = a + cols[3].to_numpy() + length - 1
                lo, hi = (a, z) if unit == "byte" else (s[a], e[z - 1])
                raw = d.tobytes()
                out = pa.array([raw[x:y] for x, y in zip(lo.tolist(), hi.tolist())], pa.binary())
                keys = [b.column(k).slice(i, j - i).take(pa.array(r)) for k in ("did", "cls")]
                yield pa.RecordBatch.from_arrays([*cols, *keys, out], [*names, "did", "cls", "part"])

    return sieved(texts, wanted, ["cls"]).join(lists, ["cls", "did"]).select("cls", "did", "text", "runs").mapInArrow(work, schema)


def window_hashes(parts: list[bytes], unit: str, length: int, family: int = 0):
    """Hashes of all windows of each part, and window bounds per part. Hashes
    of two families are independent."""
    data = np.frombuffer(b"".join(parts), np.uint8)
    off = np.concatenate([[0], np.cumsum([len(x) for x in parts], dtype=np.int64)])
    p, bounds, _, _ = _units(data, off, unit, family)
    start = np.flatnonzero(V.room(bounds) >= length)
    return V.signed(p.span(start, start + length)), np.searchsorted(start, bounds)


def to_ranges(found: DataFrame) -> DataFrame:
    """(cls, first, n) windows to one row for each class: their sorted list
    (bounded by the text's own length)."""
    return found.groupBy("cls").agg(F.collect_set(F.struct("first", "n")).alias("windows"))


def covered(windows, n: int, length: int) -> np.ndarray:
    """Which of ``n`` units a list of {first, n} window runs covers."""
    delta = np.zeros(n + 1, np.int64)
    for w in windows:
        delta[w["first"]] += 1
        delta[w["first"] + w["n"] + length - 1] -= 1
    return np.cumsum(delta[:-1]) > 0


def grouped(batches, key: str, limit: int):
    """Tables of whole groups out of batches sorted by ``key``: each has at
    least ``limit`` rows (but the last) and never splits a group."""
    held = []
    size = 0
    for b in batches:
        t = pa.Table.from_batches([b])
        if not t.num_rows:
            continue
        held.append(t)
        size += t.num_rows
        if size < limit:
            continue
        all_ = pa.concat_tables(held).combine_chunks()
        k = all_.column(key).to_numpy()
        cut = int(np.searchsorted(k, k[-1], "left"))
        if cut:
            yield all_.slice(0, cut)
        held = [all_.slice(cut)]
        size = held[0].num_rows
    if size:
        yield pa.concat_tables(held).combine_chunks()


def found_ranges(flags: np.ndarray, bounds: np.ndarray):
    """Runs of set flags inside each item: item, first (from the item's
    start) and length."""
    head = flags.copy()
    head[1:] &= ~flags[:-1]
    inner = bounds[1:-1]
    inner = inner[inner < len(flags)]
    head[inner] |= flags[inner]
    first = np.flatnonzero(head)
    if not len(first):
        return first, first, first
    counts = np.add.reduceat(flags, first).astype(np.int64)
    item = np.searchsorted(bounds, first, "right") - 1
    return item, first - bounds[item], counts


def keyed_columns(text: str = "text", doc_id: str = "doc_id"):
    """cls, the class of the text, and did, the number that orders documents
    (a null number comes after all others)."""
    return [text_class(text).alias("cls"), F.coalesce(F.col(doc_id).cast("long"), F.lit((1 << 63) - 1)).alias("did")]


def keyed(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(cls, did, text) of each document."""
    return docs.select(*keyed_columns(text, doc_id), F.col(text).alias("text"))


def hot_windows(parts: DataFrame, unit: str, length: int) -> DataFrame:
    """One row for each window ``w`` of the contexts of crowded anchors, with
    its hash in two halves."""
    schema = "anchor long, context long, h long, h2 long, w int, did long, cls binary, first int, open boolean"

    def work(batches):
        for b in batches:
            for i in range(0, b.num_rows, 512):
                t = b.slice(i, 512)
                parts_ = t.column("part").to_pylist()
                h, bounds = window_hashes(parts_, unit, length)
                h2, _ = window_hashes(parts_, unit, length, 1)
                r = V.rows_of(bounds)
                w = np.arange(len(h)) - bounds[r]
                first = t.column("first").to_numpy()[r] + w
                r = pa.array(r)
                yield pa.RecordBatch.from_arrays(
                    [t.column("anchor").take(r), t.column("context").take(r), pa.array(h), pa.array(h2),
                     pa.array(w.astype(np.int32)), t.column("did").take(r), t.column("cls").take(r),
                     pa.array(first.astype(np.int32)), t.column("open").take(r)],
                    ["anchor", "context", "h", "h2", "w", "did", "cls", "first", "open"])

    return parts.mapInArrow(work, schema)


def write_once(df: DataFrame) -> DataFrame:
    from quire.session import materialize
    return materialize(df)
