"""Exact self-join under Jaccard similarity, by regions of a metric space.

The Jaccard distance is a metric, so a pivot p with distances a and b to two
sets tells that they are at least |a - b| apart. Unrelated texts share no
shingle and are at distance 1 from every pivot and from one another: no
window of width ``2 r`` around Voronoi borders tells them apart. So the join
goes in three steps, each exact:

1. *Which sets can meet.* Two sets within r = 1 - threshold differ in at most
   D = min(|x|, |y|) * r / (1 - r) shingles. The universe of shingles is dealt
   into D + 1 parts by hash, so two such sets agree in a part at least. Sums of
   the hashes of each part are the signatures; D follows the size, in bands,
   and a set near the upper border of its band is replicated to the next one.
   (A part that is empty says nothing: there are some parts more than D + 1,
   and a set with too many empty ones is dealt again by another hash.) As all
   parts but D agree, a set that shares fewer signatures than these goes.
2. *Voronoi regions.* Each signature that several sets share takes as pivot its
   best connected set; a set belongs to the regions of the pivots of its
   signatures. Two sets within r share a signature and so a region. A region
   of up to ``block`` sets is joined as it is. Larger ones are cut into slices
   to measure each member's distance to the pivot: members within r are
   linked by that.
3. *Windows.* The members of a region form rings of width r by their distance
   to the pivot; by the triangle inequality only sets of one ring or of
   adjacent rings can be linked, so each ring is joined with itself and with
   the members replicated from the next. The innermost ring is linked already
   and needs no join with itself. A ring that is too large is cut into blocks,
   and pairs of blocks are joined; nothing is capped. Sketches of a byte for
   each of many finer parts go first and tell which sets may be near another
   at all; only these travel themselves. Inside a block, sets already
   connected are not compared.

The result is the components of the links, so a chain of links stands for the
pairs. Equal sets are one class from the start. Sets are compared as sets of
64-bit shingle hashes.

Defined results: a null or empty text has an empty set, no links and its own
number as component; rows of equal text are linked with one another; a null
number counts as larger than all others (and is null again in the result);
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import vectors as V
from quire.llm.components import components
from quire.llm.repeats import grouped, keyed, keyed_columns
from quire.llm.sieve import parted, sieved
from quire.session import materialize

SHINGLE = 3
PERCENT = 90
BLOCK = 1024
_MAX = (1 << 63) - 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SEEDS = [V.U(0xA0761D6478BD642F), V.U(0xE7037ED1A0B428DB), V.U(0x8EBC6AF09C88C6E3), V.U(0x589965CC75374CC3)]


def shingles(data: np.ndarray, off: np.ndarray, k: int):
    """Distinct shingle hashes of each row, sorted, and their bounds."""
    data = _LOWER[data]
    s, e, bounds = V.words(data, off)
    p = V.Prefix(V.byte_prefix(data).span(s, e))
    n = np.diff(bounds)
    full = np.flatnonzero(V.room(bounds) >= k) if len(s) else np.zeros(0, np.int64)
    short = np.flatnonzero((n > 0) & (n < k))
    row = np.concatenate([V.rows_of(bounds)[full], short])
    h = np.concatenate([p.span(full, full + k), p.span(bounds[:-1][short], bounds[1:][short])])
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    row, h = row[new], h[new]
    return h, np.searchsorted(row, np.arange(len(off)))


def _sums(values: np.ndarray, key: np.ndarray, size: int):
    out = np.zeros(size, V.U)
    np.add.at(out, key, values)
    return out


def _names(h: np.ndarray, bounds: np.ndarray):
    """Two 64-bit names of each row's set, independent of order."""
    row = V.rows_of(bounds)
    return [V.signed(V.mix(_sums(V.mix(h ^ x), row, len(bounds) - 1) ^ x)) for x in _SEEDS[:2]]


def bands(percent: int) -> np.ndarray:
    """Lower borders of the size bands."""
    ratio = 150 if percent >= 90 else 135
    out = [1]
    while out[-1] < 1 << 44:
        out.append(max(out[-1] + 1, out[-1] * ratio // 100))
    return np.array(out)


def part_counts(percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Borders of the bands; for each the most differences of two sets that
    meet in it, and the number of parts. Of these, at least parts - differences
    agree; that is made more than the parts that the hash leaves empty in
    nearly all sets, so that a part with items agrees."""
    border = bands(percent)
    worst = (border[1:] - 1) * (100 - percent) // percent
    parts = worst + 1
    for _ in range(4):
        empty = parts * np.exp(-np.maximum(border[:-1] * percent / 100, 1) / parts)
        parts = worst + 1 + np.where(worst > 0, np.ceil(1.2 * empty + 2 * np.sqrt(empty)), 0).astype(np.int64)
    return border, worst, parts


def signatures(h: np.ndarray, bounds: np.ndarray, percent: int):
    """Row and signature of each part of each row's set, and ``need``. Empty
    parts have none; a set with too many of them is dealt again by another hash
    (the last one keeps them).

    A set of n items within the threshold of another differs from it in at
    most n * (100 - percent) / percent items, so all parts of a deal but as
    many agree. Less its empty ones, these are the signatures it must share:
    ``need`` holds their number times 8, plus the number of the deal."""
    border, worst, number = part_counts(percent)
    size = np.diff(bounds)
    rows, out, needs = [], [], []
    own = np.searchsorted(border, size, "right") - 1
    nearby = 100 * size >= percent * border[np.minimum(own + 1, len(border) - 1)]
    for step in (0, 1):
        todo = (size > 0) & (nearby if step else True)
        for level, seed in enumerate(_SEEDS):
            r = np.flatnonzero(todo)
            if not len(r):
                break
            band = own[r] + step
            parts = number[band]
            base = np.cumsum(parts) - parts
            n = size[r]
            x = h[V.ranges(bounds[r], n)]
            item = np.repeat(np.arange(len(r)), n)
            key = base[item] + (V.mix(x ^ seed) % parts[item].astype(V.U)).astype(np.int64)
            total = int(parts.sum())
            count = np.bincount(key, minlength=total)
            sums = _sums(V.mix(x + seed), key, total)
            where = np.repeat(np.arange(len(r)), parts)
            part = np.arange(total) - base[where]
            last = level == len(_SEEDS) - 1
            keep = np.ones(total, bool) if last else count > 0
            tag = V.mix((band[where].astype(V.U) << V.U(34)) + (part.astype(V.U) << V.U(3)) + V.U(level))
            rows.append(r[where][keep])
            out.append(V.mix(sums ^ tag)[keep])
            empties = np.bincount(where[count == 0], minlength=len(r))
            agree = parts - np.minimum(worst[band], n * (100 - percent) // percent) - (0 if last else empties)
            needs.append((np.maximum(agree, 1) * 8 + step * len(_SEEDS) + level)[where][keep])
            todo = np.zeros(len(size), bool)
            todo[r[empties >= parts - worst[band]]] = True
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows), V.signed(np.concatenate(out)), np.concatenate(needs)


def _sets(batches, k: int):
    for b in batches:
        data, off = V.utf8(b.column("text"))
        for i, j in V.slices(off):
            h, bounds = shingles(data[off[i]:off[j]], off[i:j + 1] - off[i], k)
            yield b.slice(i, j - i), h, bounds


def describe(texts: DataFrame, k: int) -> DataFrame:
    """(cls, did, text) to cls, did, size, s1, s2: the name of each set."""
    def work(batches):
        for b, h, bounds in _sets(batches, k):
            s1, s2 = _names(h, bounds)
            yield pa.RecordBatch.from_arrays(
                [b.column("cls"), b.column("did"), pa.array(np.diff(bounds)), pa.array(s1), pa.array(s2)],
                ["cls", "did", "size", "s1", "s2"])
    return texts.select("cls", "did", "text").mapInArrow(work, "cls binary, did long, size long, s1 long, s2 long")


def signed_sets(texts: DataFrame, k: int, percent: int) -> DataFrame:
    """One row for each signature: sig, s1, need."""
    def work(batches):
        for _, h, bounds in _sets(batches, k):
            s1, _ = _names(h, bounds)
            row, sig, need = signatures(h, bounds, percent)
            # 48 bits are enough: a collision only makes a candidate.
            yield pa.RecordBatch.from_arrays([pa.array(sig & (1 << 48) - 1), pa.array(s1[row]), pa.array(need)],
                                             ["sig", "s1", "need"])
    return texts.select("text").mapInArrow(work, "sig long, s1 long, need long")


def _with_enough(members: DataFrame) -> DataFrame:
    """The rows (sig, s1, need) of sets that share as many signatures as they
    need, as far as another such set has the signature."""
    enough = members.groupBy("s1", "need").agg(F.count(F.lit(1)).alias("c")).where("c >= shiftright(need, 3)")
    held = materialize(members.join(materialize(enough.select("s1", "need")), ["s1", "need"]))
    several = held.groupBy("sig").agg(F.min("s1").alias("lo"), F.max("s1").alias("hi")).where("lo <> hi")
    return materialize(held.join(materialize(several.select("sig")), "sig"))


def sketch_width(size: int, percent: int) -> int:
    width = 64
    while width < 3 * (size * (100 - percent) // percent):
        width *= 2
    return width


def sketches(h: np.ndarray, bounds: np.ndarray, percent: int) -> list[bytes]:
    """For each set, sums of item hashes over parts of the universe, a byte
    each. Sets that differ in d items differ in at most d parts. A sketch
    folds to half its width by adding its halves."""
    out = []
    low = V.mix(h).astype(np.uint8)
    at = V.mix(h ^ _SEEDS[3])
    for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        width = sketch_width(z - a, percent)
        sums = np.bincount((at[a:z] % V.U(width)).astype(np.int64), low[a:z], width)
        out.append(sums.astype(np.int64).astype(np.uint8).tobytes())
    return out


def set_table(texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The sets themselves: s1, s2, items (sorted 64-bit hashes), size and sketch."""
    def work(batches):
        for _, h, bounds in _sets(batches, k):
            s1, s2 = _names(h, bounds)
            raw, at = h.tobytes(), (bounds * 8).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(s1), pa.array(s2), pa.array([raw[x:y] for x, y in zip(at[:-1], at[1:])], pa.binary()),
                 pa.array(np.diff(bounds)), pa.array(sketches(h, bounds, percent), pa.binary())],
                ["s1", "s2", "items", "size", "sketch"])
    return texts.select("text").mapInArrow(work, "s1 long, s2 long, items binary, size long, sketch binary")


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a)) if len(b) else 0


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = _overlap(a, b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def _items(col) -> list[np.ndarray]:
    return [np.frombuffer(x, V.U) for x in col.to_pylist()]


def _distances(batches):
    """Members sorted by slice, pivot first: distance of each to the pivot."""
    pivot = mark = None
    for b in batches:
        for i in range(0, b.num_rows, 512):
            t = b.slice(i, 512)
            out = []
            for p, s, is_pivot, x in zip(t.column("pivot").to_pylist(), t.column("slice").to_pylist(),
                                         t.column("first").to_pylist(), _items(t.column("items"))):
                if is_pivot and mark != (p, s):
                    pivot, mark = x, (p, s)
                both = _overlap(pivot, x)
                out.append((both, len(pivot) + len(x) - both))
            if out:
                both, either = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [*(t.column(c) for c in ("pivot", "p2", "s1", "s2")), pa.array(both, pa.int64()),
                     pa.array(either, pa.int64())], ["pivot", "p2", "s1", "s2", "both", "either"])


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def top(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x


def join_block(sets: list[np.ndarray], side: np.ndarray, dist: np.ndarray, percent: int, inner: bool,
               part: np.ndarray | None = None):
    """Links that connect a block's sets (indices). Sets of ``side`` 1 are
    not compared with one another, nor those of side 0 if ``inner`` (they are
    connected already). ``dist``: distances to the region's pivot; ``part``:
    sets of one part are compared by another task."""
    n = len(sets)
    size = np.array([len(x) for x in sets])
    most = int(size.max(initial=0)) * (100 - percent) // percent
    fine = 64
    while fine < 4 * most and fine < 1024:
        fine *= 2
    flat = np.concatenate(sets) if n else np.zeros(0, V.U)
    key = np.repeat(np.arange(n), size) * fine + (V.mix(flat ^ _SEEDS[3]) % V.U(fine)).astype(np.int64)
    table = _sums(V.mix(flat), key, n * fine).reshape(n, fine)
    forest = _Forest(n)
    if inner:
        zero = np.flatnonzero(side == 0)
        for x in zero[1:].tolist():
            forest.up[x] = int(zero[0])
    r = (100 - percent) / 100 + 1e-9
    out = []
    for i in np.flatnonzero(side == (1 if inner else 0)).tolist():
        other = np.flatnonzero((side == 0) if inner else (side == 1) | (np.arange(n) > i))
        other = other[(np.abs(dist[other] - dist[i]) <= r)
                      & (part is None or part[other] != part[i])
                      & (100 * np.minimum(size[other], size[i]) >= percent * np.maximum(size[other], size[i]))]
        if not len(other):
            continue
        unlike = (table[other] != table[i]).sum(1)
        other = other[unlike * percent <= np.minimum(size[other], size[i]) * (100 - percent)]
        for j in other.tolist():
            a, b = forest.top(i), forest.top(j)
            if a != b and _linked(sets[i], sets[j], percent):
                forest.up[max(a, b)] = min(a, b)
                out.append((i, j))
    return out


def near_flags(size: np.ndarray, sketch: list[bytes], side: np.ndarray, dist: np.ndarray, percent: int,
               inner: bool, part: np.ndarray | None = None) -> np.ndarray:
    """Which sets of a block may be within the threshold of another, by their
    sketches (see :func:`join_block` for the rest)."""
    width = np.array([len(x) for x in sketch])
    flags = np.zeros(len(size), bool)
    r = (100 - percent) / 100 + 1e-9
    for w in np.unique(width).tolist():
        own, wide = np.flatnonzero(width == w), np.flatnonzero(width == 2 * w)
        table = np.frombuffer(b"".join(sketch[i] for i in own), np.uint8).reshape(-1, w)
        if len(wide):
            double = np.frombuffer(b"".join(sketch[i] for i in wide), np.uint8).reshape(-1, 2, w)
            table = np.concatenate([table, double[:, 0] + double[:, 1]])
        all_ = np.concatenate([own, wide])
        for k, i in enumerate(own.tolist()):
            j = np.arange(k + 1, len(all_))
            o = all_[j]
            least = np.minimum(size[o], size[i])
            ok = (100 * least >= percent * np.maximum(size[o], size[i])) & (np.abs(dist[o] - dist[i]) <= r)
            ok &= (side[o] != side[i]) if inner else (side[o] == 0) | (side[i] == 0)
            if part is not None:
                ok &= part[o] != part[i]
            j, o, least = j[ok], o[ok], least[ok]
            if len(j):
                near = (table[j] != table[k]).sum(1) * percent <= least * (100 - percent)
                flags[o[near]] = True
                flags[i] |= bool(near.any())
    return flags


def _blocks_of(t: pa.Table):
    """The blocks of a table of whole tasks. A task's name is a hash; regions
    that share one are told apart here."""
    tasks = t.column("task").to_numpy()
    cuts = np.flatnonzero(np.concatenate([[True], tasks[1:] != tasks[:-1], [True]]))
    for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        g = t.slice(a, z - a)
        home = list(zip(*(g.column(c).to_pylist() for c in ("pivot", "p2", "ring", "lo", "hi"))))
        for which in dict.fromkeys(home):
            own = g if all(x == which for x in home) else g.take(pa.array([k for k, x in enumerate(home) if x == which]))
            yield own, which[2] == 0, own.column("b").to_numpy() if which[3] < which[4] else None


_TASK = "pivot long, p2 long, ring int, lo int, hi int, b int, side int, dist double, s1 long, s2 long, task long"


def _flagged(percent: int):
    names = [c.split()[0] for c in _TASK.split(", ")]

    def work(batches):
        for t in grouped(batches, "task", 1):
            for own, inner, part in _blocks_of(t):
                flags = near_flags(own.column("size").to_numpy(), own.column("sketch").to_pylist(),
                                   own.column("side").to_numpy(), own.column("dist").to_numpy(), percent, inner, part)
                if flags.any():
                    yield from own.select(names).filter(pa.array(flags)).combine_chunks().to_batches()
    return work


def _rings(percent: int):
    def work(batches):
        for t in grouped(batches, "task", 1):
            rows = []
            for own, inner, part in _blocks_of(t):
                names = list(zip(own.column("s1").to_pylist(), own.column("s2").to_pylist()))
                for i, j in join_block(_items(own.column("items")), own.column("side").to_numpy(),
                                       own.column("dist").to_numpy(), percent, inner, part):
                    rows.append((*names[i], *names[j]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["a1", "a2", "b1", "b2"])
    return work


def _ring_tasks(far: DataFrame, percent: int, block: int) -> DataFrame:
    """Members of regions to the tasks that join them.

    Task (ring, lo, hi): blocks lo and hi of the sets that ring takes part
    with: its own members (side 0) and those of the next ring (side 1). A ring
    of more than a block has blocks of its own members and, numbered after
    them, of guests. Guests are not compared with one another, nor own members
    of ring 0, so there is no task for such blocks."""
    # Ring k: distances in (k r, (k + 1) r]; ring 0 is linked to the pivot.
    ratio = (F.col("either") - F.col("both")) * 100 / (F.col("either") * (100 - percent))
    far = far.withColumn("ring", F.greatest(F.ceil(ratio) - 1, F.lit(0)).cast("int")) \
             .withColumn("dist", 1 - F.col("both") / F.col("either"))
    home = far.select("*", F.lit(0).alias("side"))
    guest = far.where("ring > 0").withColumn("ring", F.col("ring") - 1).select("*", F.lit(1).alias("side"))
    rows = home.unionByName(guest)
    counts = rows.groupBy("pivot", "p2", "ring").agg(
        F.count(F.lit(1)).alias("n"), F.sum("side").alias("guests"),
        F.sum(1 - F.col("side")).alias("own"))
    needed = counts.where("(ring = 0 and guests > 0 and own > 0) or (ring > 0 and own > 0 and n > 1)").select(
        "pivot", "p2", "ring", (F.col("n") <= block).alias("one"), F.ceil(F.col("own") / block).cast("int").alias("homes"),
        F.ceil(F.col("guests") / block).cast("int").alias("visits"))
    rows = rows.join(materialize(needed), ["pivot", "p2", "ring"])
    rows = rows.withColumn("b", F.expr("""case when one then 0 when side = 0 then int(pmod(xxhash64(s1, s2), homes))
        else homes + int(pmod(xxhash64(s1, s2), visits)) end"""))
    rows = rows.withColumn("other", F.explode(F.expr("""case when one then array(0) when side = 1 then sequence(0, homes - 1)
        when ring = 0 then sequence(homes, homes + visits - 1) else sequence(0, homes + visits - 1) end""")))
    rows = rows.withColumn("lo", F.least("b", "other")).withColumn("hi", F.greatest("b", "other"))
    return rows.select("pivot", "p2", "ring", "lo", "hi", "b", "side", "dist", "s1", "s2",
                       F.xxhash64("pivot", "p2", "ring", "lo", "hi").alias("task"))


def links(texts: DataFrame, named: DataFrame, k: int, percent: int, block: int) -> DataFrame:
    """Links (a1, a2, b1, b2) between different sets that connect all sets
    within the threshold. ``named``: the written rows of :func:`describe`."""
    sig = signed_sets(texts, k, percent)
    short = F.col("s1").bitwiseAND((1 << 40) - 1)  # to tell sets apart, in fewer bytes
    shared = materialize(sig.groupBy("sig").agg(F.min(short).alias("lo"), F.max(short).alias("hi"))
                         .where("lo <> hi").select("sig"))
    members = materialize(materialize(sieved(sig, shared, ["sig"]).join(shared, "sig")).distinct())
    for _ in range(2):  # what the first round takes away lets the second take more
        members = _with_enough(members)
    members = members.select("sig", "s1")
    crowd = materialize(members.groupBy("sig").agg(F.count(F.lit(1)).alias("c")))
    score = materialize(members.join(crowd, "sig").groupBy("s1").agg(F.sum("c").alias("score")))
    best = materialize(members.join(score, "s1").groupBy("sig").agg(F.max(F.struct("score", "s1")).alias("best")))
    region = materialize(members.join(best, "sig").select(F.col("best.s1").alias("pivot"), "s1").distinct())

    # One text of each candidate set, and its items.
    of = named.join(materialize(members.select("s1").distinct()), "s1")
    of = materialize(of.groupBy("s1", "s2").agg(F.min(F.struct("did", "cls")).alias("at")).select("at.*").distinct())
    own = sieved(texts, of, ["cls"]).join(of, ["did", "cls"]).dropDuplicates(["did", "cls"])
    sets = materialize(set_table(own, k, percent))

    # Distances to pivots, in slices of bounded size with the pivot in each.
    pairs = region.join(sets.select("s1", "s2"), "s1")
    pivots = sets.select(F.col("s1").alias("pivot"), F.col("s2").alias("p2"))
    pairs = materialize(pairs.join(pivots, "pivot"))
    sizes = materialize(pairs.groupBy("pivot", "p2").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("slices")))
    sized = pairs.join(sizes, ["pivot", "p2"])
    # A region of one slice is joined as it is, under the ring number -1.
    zero, whole = F.lit(0), F.lit(-1)
    small = sized.where("slices = 1").select(
        "pivot", "p2", whole.alias("ring"), zero.alias("lo"), zero.alias("hi"), zero.alias("b"), zero.alias("side"),
        F.lit(0.0).alias("dist"), "s1", "s2", F.xxhash64("pivot", "p2", whole, zero, zero).alias("task"))
    sizes = sizes.where("slices > 1")
    rest = sized.where("slices > 1 and (pivot <> s1 or p2 <> s2)").withColumn(
        "slice", F.pmod(F.xxhash64("s1", "s2"), F.col("slices")).cast("int")).select(
        "pivot", "p2", "slice", F.lit(False).alias("first"), "s1", "s2")
    firsts = sizes.select("pivot", "p2", F.explode(F.expr("sequence(0, slices - 1)")).alias("slice"),
                          F.lit(True).alias("first"), F.col("pivot").alias("s1"), F.col("p2").alias("s2"))
    order = ["pivot", "p2", "slice", F.col("first").desc()]
    apart = materialize(rest.unionByName(firsts))
    items = sieved(sets.select("s1", "s2", "items"), apart, ["s1", "s2"])
    far = materialize(apart.join(items, ["s1", "s2"])
                      .repartition("pivot", "p2", "slice").sortWithinPartitions(*order)
                      .mapInArrow(_distances, "pivot long, p2 long, s1 long, s2 long, both long, either long").distinct())
    star = far.where(F.col("both") * 100 >= F.col("either") * percent).select(
        F.col("pivot").alias("a1"), F.col("p2").alias("a2"), F.col("s1").alias("b1"), F.col("s2").alias("b2"))
    # Sketches first: sets travel only to blocks where they may be near another.
    tasks = materialize(small.unionByName(_ring_tasks(far, percent, block)))
    tasks = materialize(tasks.join(sets.select("s1", "s2", "size", "sketch"), ["s1", "s2"]).repartition("task")
                        .sortWithinPartitions("task").mapInArrow(_flagged(percent), _TASK))
    items = sieved(sets.select("s1", "s2", "items"), tasks, ["s1", "s2"])
    inner = tasks.join(items, ["s1", "s2"]).repartition("task") \
        .sortWithinPartitions("task").mapInArrow(_rings(percent), "a1 long, a2 long, b1 long, b2 long")
    return star.unionByName(inner)


def groups(docs: DataFrame, k: int, percent: int, block: int) -> tuple[DataFrame, DataFrame]:
    """The written rows of :func:`describe`, and for each set its group:
    s1, s2, least (number), root."""
    texts = keyed(docs)
    named = materialize(describe(texts, k))
    found = links(texts, named, k, percent, block)
    edges = found.select(F.struct(F.col("a1").alias("s1"), F.col("a2").alias("s2")).alias("u"),
                         F.struct(F.col("b1").alias("s1"), F.col("b2").alias("s2")).alias("v"))
    roots = components(edges)
    sets = named.where("size > 0").groupBy("s1", "s2").agg(F.min("did").alias("least"))
    return named, materialize(sets.withColumn("node", F.struct("s1", "s2")).join(roots, "node", "left")
                              .select("s1", "s2", "least", F.coalesce("root", "node").alias("root")))


def join(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """doc_id, text class, set size and component of each document: the
    smallest number that links lead to, its own included."""
    named, group = groups(docs, k, percent, block)
    best = materialize(group.groupBy("root").agg(F.min("least").alias("component")))
    of = materialize(group.join(best, "root").select("s1", "s2", "component"))
    rows = named.withColumnRenamed("size", "n_shingles").join(of, ["s1", "s2"], "left")
    part = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("did"))
    null_if_none = lambda c: F.when(c < _MAX, c)
    return rows.select(null_if_none(F.col("did")).alias("doc_id"), "cls", "n_shingles",
                       null_if_none(part).alias("component_id"))


def keep_one(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """One document of each group (the lowest number; among equal numbers one
    text, and one of equal rows), and every document without words. Texts that
    surely stay are not shuffled."""
    named, group = groups(docs, k, percent, block)
    full = named.where("size > 0").select("did", "cls", "s1", "s2")
    placed = materialize(full.join(group.select("s1", "s2", "root"), ["s1", "s2"]).select("did", "cls", "root"))
    best = materialize(placed.groupBy("root").agg(F.min(F.struct("did", "cls")).alias("best")))
    losers = materialize(placed.join(best, "root").where(F.struct("did", "cls") != F.col("best")).select("did", "cls").distinct())
    again = full.groupBy("did", "cls").count().where("count > 1").select("did", "cls")
    special = materialize(losers.unionByName(again).distinct())
    held = docs.select(F.struct(*docs.columns).alias("row"), *keyed_columns())
    may, sure = parted(held, special, ["did", "cls"])
    # Only the rows of equal number and text that have words are one document.
    has_words = F.coalesce(F.col("row.text").rlike(r"[^ \t\n\x0B\f\r]"), F.lit(False))
    stay = may.join(losers, ["did", "cls"], "left_anti")
    stay = stay.where(has_words).dropDuplicates(["did", "cls"]).unionByName(stay.where(~has_words))
    return sure.select("row.*").unionByName(stay.select("row.*"))


def digest(joined: DataFrame) -> DataFrame:
    return joined.select("doc_id", "n_shingles", "component_id")
