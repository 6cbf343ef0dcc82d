"""Prefix trie of conversations, built as a Z-fast trie.

A conversation is a string of turns. Every prefix has a 128-bit name (the XOR
of its turns' hashes, each with its depth), so a node is a name and any prefix
of a conversation is looked up by (conversation, depth).

The compacted trie has a row for each *extent*: a prefix at which sequences
part or one ends. A node's *handle* is its prefix at the two-fattest depth of
its edge (the depth in it that a power of two as large as possible divides).
Sequences are inserted in batches of growing size:

1. *locate*: all sequences of a batch run a fat binary search in lockstep; a
   round joins the prefixes at the fattest depth of each open interval with
   the handles, and ends after log2(longest sequence) rounds;
2. *insert*: only the turns below the located nodes, and the edges they fall
   into, are compared. Where they part or end are the new extents; each takes
   the extent before it on its path as parent, and cut edges are replaced.
   Early, small batches place the prefixes that many conversations share, so
   that later ones never travel with them;
3. members, leaves and lengths are summed upwards by doubled parent pointers;
4. *expand*: each edge gives a node for each of its depths.

No conversation and no node is gathered in one task: turns are ranked over
ranges, prefix names are sums over blocks of ``BLOCK`` turns, and the ids for
a node's digest are joined in pieces and then streamed. What a window holds at
once is a path of extents, which has at most sqrt(2 * rows) of them.

Defined results: turns of equal number are ordered by role and text; a null
number comes first; rows without conv_id belong to no conversation; repeated
rows are turns of their own; an empty table has no nodes, not even a root;
other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.ordered import ranked
from quire.session import materialize

#: Conversations that share the first turns of their group's first one.
GROUP = 100
#: At most HEADS - 1 turns are shared.
HEADS = 6
BLOCK = 1024
#: Batch k holds one in GROWTH ** (BATCHES - 1 - k) sequences.
GROWTH = 16
BATCHES = 2
_PIECE = 4096


def _blocks(first: str, last: str) -> str:
    """SQL: the blocks of depths ``first`` to ``last``."""
    return f"explode(sequence({first} div {BLOCK}, {last} div {BLOCK}))"


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, n turns) and their rebuilt turns (conv_id, d
    from 1, block, turn hash in two halves, code points)."""
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = turns.select("*", F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")
                                            .cast("binary"))).alias("t"), F.length("text").cast("long").alias("len"))
    turns = materialize(ranked(turns, "conv_id", ["turn", "role", "text"], ["t", "len"]))
    shared = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(HEADS))
    base = F.col("conv_id") - F.col("conv_id") % GROUP
    heads = turns.where((F.col("conv_id") == base) & (F.col("i") < HEADS - 1))
    sizes = heads.groupBy(F.col("conv_id").alias("base")).agg(F.count(F.lit(1)).alias("heads"))
    convs = turns.where("i = 0").select("conv_id", "n", shared.alias("h"), base.alias("base")).join(sizes, "base", "left")
    convs = materialize(convs.select("conv_id", "base", "n", "h", F.least("h", F.coalesce("heads", F.lit(0))).alias("took")))
    borrowed = convs.join(heads.select(F.col("conv_id").alias("base"), "i", "t", "len"), "base").where("i < h").select(
        "conv_id", (F.col("i") + 1).alias("d"), "t", "len")
    # Joined by block, so that a long conversation is spread.
    pieces = convs.where("n > h").select("conv_id", "h", "took", F.expr(_blocks("0L", "n")).alias("b"))
    own = turns.withColumn("b", F.expr(f"i div {BLOCK}")).join(pieces, ["conv_id", "b"]).where("i >= h").select(
        "conv_id", (F.col("i") - F.col("h") + F.col("took") + 1).alias("d"), "t", "len")
    both = borrowed.unionByName(own).select(
        "conv_id", "d", F.expr(f"d div {BLOCK}").alias("b"), F.xxhash64("d", "t").alias("g1"),
        F.xxhash64("t", "d").alias("g2"), "len")
    return convs.select("conv_id", (F.col("took") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n")), both


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, d, b, name p1 p2, name of the prefix before q1 q2, len, total
    length upto), written once."""
    inside = Window.partitionBy("conv_id", "b").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    local = turns.select("*", F.bit_xor("g1").over(inside).alias("x1"), F.bit_xor("g2").over(inside).alias("x2"),
                         F.sum("len").over(inside).alias("s"))
    earlier = Window.partitionBy("conv_id").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    blocks = turns.groupBy("conv_id", "b").agg(
        F.bit_xor("g1").alias("y1"), F.bit_xor("g2").alias("y2"), F.sum("len").alias("y"))
    blocks = blocks.select("conv_id", "b", *[
        F.coalesce(f("y" + k).over(earlier), F.lit(0)).alias("z" + k) for k, f in (("1", F.bit_xor), ("2", F.bit_xor), ("", F.sum))])
    p1, p2 = F.col("x1").bitwiseXOR(F.col("z1")), F.col("x2").bitwiseXOR(F.col("z2"))
    return materialize(local.join(blocks, ["conv_id", "b"]).select(
        "conv_id", "d", "b", p1.alias("p1"), p2.alias("p2"), p1.bitwiseXOR(F.col("g1")).alias("q1"),
        p2.bitwiseXOR(F.col("g2")).alias("q2"), "len", (F.col("s") + F.col("z")).alias("upto")))


def fattest(low: str, high: str) -> str:
    """SQL: the depth in (low, high] that the largest power of two divides."""
    bits = f"length(bin({low} ^ {high})) - 1"
    return f"shiftleft(shiftright({high}, {bits}), {bits})"


def _looked_up(rows: DataFrame, table: DataFrame, conv: str, depth: str, names: dict[str, str]) -> DataFrame:
    """Add columns of the prefix at (conv, depth), null where there is none."""
    side = table.select(F.col("conv_id").alias("_c"), F.col("d").alias("_d"), *[F.col(k).alias(v) for k, v in names.items()])
    return rows.join(side, (F.col(conv) == F.col("_c")) & (F.col(depth) == F.col("_d")), "left").drop("_c", "_d")


def locate(seqs: DataFrame, nodes: DataFrame, table: DataFrame, rounds: int) -> DataFrame:
    """(x, n) to (x, n, a, a1, a2): the deepest extent that x starts with."""
    handles = nodes.select("k1", "k2", F.col("e").alias("he"), *[F.col(c).alias("h" + c) for c in ("v1", "v2", "pe", "u1", "u2")])
    zero = F.lit(0).cast("long")
    now = seqs.select("x", "n", zero.alias("low"), F.col("n").alias("high"),
                      *[zero.alias(c) for c in ("e", "v1", "v2", "pe", "u1", "u2")])
    for _ in range(rounds):
        # Ended searches probe no depth; their keys stay apart from one another.
        now = now.withColumn("f", F.when(F.col("low") < F.col("high"), F.expr(fattest("low", "high"))).otherwise(F.lit(-1)))
        now = _looked_up(now, table, "x", "f", {"p1": "p1", "p2": "p2"})
        now = now.withColumn("s1", F.coalesce("p1", "x")).withColumn("s2", F.coalesce("p2", "x"))
        now = now.join(handles, (F.col("s1") == F.col("k1")) & (F.col("s2") == F.col("k2")), "left")
        hit = (F.col("f") > 0) & F.col("he").isNotNull()
        now = now.select("x", "n", F.when(hit, F.col("he")).otherwise(F.col("low")).alias("low"),
                         F.when((F.col("f") > 0) & ~hit, F.col("f") - 1).otherwise(F.col("high")).alias("high"),
                         *[F.when(hit, F.col("h" + c)).otherwise(F.col(c)).alias(c) for c in ("e", "v1", "v2", "pe", "u1", "u2")])
    # The last handle matched; its whole extent may not: then x leaves inside that edge.
    now = _looked_up(now, table, "x", "e", {"p1": "p1", "p2": "p2"})
    whole = (F.col("e") == 0) | F.coalesce((F.col("p1") == F.col("v1")) & (F.col("p2") == F.col("v2")), F.lit(False))
    return now.select("x", "n", *[F.when(whole, F.col(s)).otherwise(F.col(t)).alias(c)
                                  for c, s, t in (("a", "e", "pe"), ("a1", "v1", "u1"), ("a2", "v2", "u2"))])


def _below(paths: DataFrame, table: DataFrame, carry: list[str]) -> DataFrame:
    """Prefixes of x at depths (a, n], joined by block. ``paths``: x, a, n and ``carry``."""
    spread = paths.select("x", "a", "n", *carry, F.expr(_blocks("(a + 1)", "n")).alias("_b"))
    return spread.join(table, (F.col("x") == F.col("conv_id")) & (F.col("_b") == F.col("b"))) \
        .where("d > a and d <= n").drop("_b", "b", "conv_id")


def insert(located: DataFrame, nodes: DataFrame | None, table: DataFrame) -> DataFrame:
    """The trie's rows after the located sequences have been added."""
    anchor = ["a1", "a2"]
    fresh = _below(located.where("a < n"), table, anchor)
    if nodes is not None:
        fresh = materialize(fresh)
        first = fresh.where("d = a + 1").select(F.col("p1").alias("c1"), F.col("p2").alias("c2")).distinct()
        cut = materialize(nodes.join(first, ["c1", "c2"]))
        edges = cut.select(F.col("rep").alias("x"), F.col("pe").alias("a"), F.col("e").alias("n"),
                           F.col("u1").alias("a1"), F.col("u2").alias("a2"))
        fresh = fresh.unionByName(_below(edges, table, anchor))
    fresh = materialize(fresh)
    parted = fresh.where("d > a + 1").select("q1", "q2", "p1", "p2").distinct().groupBy("q1", "q2").agg(
        F.count(F.lit(1)).alias("c")).where("c > 1").select(F.col("q1").alias("p1"), F.col("q2").alias("p2"))
    extents = parted.unionByName(fresh.where("d = n").select("p1", "p2")).distinct()
    path = Window.partitionBy("x", "a").orderBy("d")
    marks = fresh.join(extents, ["p1", "p2"]).select(
        "p1", "p2", F.struct("x", F.col("d").alias("e"), F.lag("d").over(path).alias("pe"), F.lag("p1").over(path).alias("u1"),
                             F.lag("p2").over(path).alias("u2"), "a", *anchor, F.col("upto").alias("total")).alias("at"))
    links = marks.groupBy("p1", "p2").agg(F.min("at").alias("at")).select(
        F.col("p1").alias("v1"), F.col("p2").alias("v2"), F.col("at.x").alias("rep"), "at.e",
        F.coalesce("at.pe", "at.a").alias("pe"), F.coalesce("at.u1", "at.a1").alias("u1"),
        F.coalesce("at.u2", "at.a2").alias("u2"), "at.total")
    links = links.withColumn("f", F.expr(fattest("pe", "e"))).withColumn("c", F.col("pe") + 1)
    links = _looked_up(links, table, "rep", "f", {"p1": "k1", "p2": "k2"})
    links = _looked_up(links, table, "rep", "c", {"p1": "c1", "p2": "c2", "len": "_l", "upto": "_s"})
    links = links.withColumn("before", F.col("_s") - F.col("_l")).drop("f", "c", "_l", "_s")
    if nodes is not None:
        links = nodes.join(cut.select("v1", "v2"), ["v1", "v2"], "left_anti").unionByName(links)
    return materialize(links)


def build(seqs: DataFrame, table: DataFrame, longest: int, batches: int = BATCHES, growth: int = GROWTH) -> DataFrame | None:
    """The compacted trie of (x, n, p1, p2): extent v, depth e, a sequence rep
    that has it, parent u at depth pe, child key c, handle k, code points up
    to the extent (total) and before the edge. None without turns."""
    share = growth ** (batches - 1)
    size = F.pmod("p1", F.lit(share))
    batch = sum(F.when(size % growth ** (batches - 1 - k) != 0, 1).otherwise(0) for k in range(batches - 1))
    seqs = materialize(seqs.withColumn("batch", batch if batches > 1 else F.lit(0)))
    nodes = None
    for k in range(batches):
        part = seqs.where(F.col("batch") == k)
        if part.isEmpty():
            continue
        if nodes is None:
            at = part.select("x", "n", *[F.lit(0).cast("long").alias(c) for c in ("a", "a1", "a2")])
        else:
            at = materialize(locate(part, nodes, table, longest.bit_length()))
        nodes = insert(at, nodes, table)
    return nodes


def _id_pieces(batches):
    """Sorted (p1, p2, conv_id) rows to pieces of joined ids."""
    for b in batches:
        p1, p2, ids = (b.column(k).to_numpy() for k in range(3))
        head = np.ones(len(ids), bool)
        head[1:] = (p1[1:] != p1[:-1]) | (p2[1:] != p2[:-1])
        at = np.flatnonzero(head)
        end = np.append(at[1:], len(ids))
        yield pa.RecordBatch.from_arrays(
            [pa.array(p1[at]), pa.array(p2[at]), pa.array(ids[at]),
             pa.array([",".join(map(str, ids[a:z].tolist())) for a, z in zip(at, end)], pa.string())],
            ["p1", "p2", "first", "ids"])


def _id_digests(batches):
    """Sorted pieces to one digest for each node; one node's state at a time."""
    key, sha = None, None
    for b in batches:
        rows, out = zip(*(b.column(k).to_pylist() for k in (0, 1))), []
        for k, ids in zip(rows, b.column(3).to_pylist()):
            if k == key:
                sha.update(b"," + ids.encode())
                continue
            if sha is not None:
                out.append((*key, sha.hexdigest()))
            key, sha = k, hashlib.sha256(ids.encode())
        if out:
            yield _digest_rows(out)
    if sha is not None:
        yield _digest_rows([(*key, sha.hexdigest())])


def _digest_rows(out):
    a, b, c = zip(*out)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.string())],
                                      ["p1", "p2", "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """(p1, p2, conv_id) to the SHA-256 of each node's ids, in order. A piece
    is a batch's ids of a node, so a hot node is a few long rows at the end."""
    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = ends.select("p1", "p2", "conv_id").repartitionByRange(n, "p1", "p2", "conv_id").sortWithinPartitions("p1", "p2", "conv_id")
    pieces = rows.mapInArrow(_id_pieces, "p1 long, p2 long, first long, ids string")
    return pieces.repartition("p1", "p2").sortWithinPartitions("p1", "p2", "first").mapInArrow(
        _id_digests, "p1 long, p2 long, ends_sha256 string")


def totals(nodes: DataFrame) -> DataFrame:
    """Sums over subtrees (cnt, lead, edge, leaf; least member mn) by doubled
    parent pointers: a round adds what stands 2^k levels below."""
    sums = materialize(nodes.select("v1", "v2", "cnt", "lead", "edge", "leaf", "mn"))
    jump = materialize(nodes.where("e > 0").select("v1", "v2", "u1", "u2"))
    while not jump.isEmpty():
        below = jump.join(sums, ["v1", "v2"]).groupBy(F.col("u1").alias("v1"), F.col("u2").alias("v2")).agg(
            *[F.sum(c).alias("b_" + c) for c in ("cnt", "lead", "edge", "leaf")], F.min("mn").alias("b_mn"))
        sums = materialize(sums.join(below, ["v1", "v2"], "left").select(
            "v1", "v2", *[(F.col(c) + F.coalesce("b_" + c, F.lit(0))).alias(c) for c in ("cnt", "lead", "edge", "leaf")],
            F.least("mn", "b_mn").alias("mn")))
        above = jump.select(F.col("v1").alias("u1"), F.col("v2").alias("u2"), F.col("u1").alias("w1"), F.col("u2").alias("w2"))
        jump = materialize(jump.join(above, ["u1", "u2"]).select("v1", "v2", F.col("w1").alias("u1"), F.col("w2").alias("u2")))
    return sums


def trie(conversations: DataFrame, batches: int = BATCHES, growth: int = GROWTH) -> DataFrame:
    """One row for each prefix: conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens and ends_sha256."""
    convs, turns = rebuilt(conversations)
    table = prefixes(turns)
    ends = materialize(_looked_up(convs, table, "conv_id", "n", {"p1": "p1", "p2": "p2"}).select(
        "conv_id", "n", F.coalesce("p1", F.lit(0)).alias("p1"), F.coalesce("p2", F.lit(0)).alias("p2")))
    last = materialize(ends.groupBy("p1", "p2").agg(
        F.min("conv_id").alias("x"), F.first("n").alias("n"), F.count(F.lit(1)).alias("cnt")))
    seqs = last.where("n > 0").select("x", "n", "p1", "p2")
    longest = seqs.agg(F.max("n")).first()[0] or 0
    nodes = build(seqs, table, longest, batches, growth)
    columns = ["v1", "v2", "e", "rep", "pe", "u1", "u2", "before", "total"]
    zero = F.lit(0).cast("long")
    root = last.agg(F.min("x").alias("rep")).where("rep is not null").select(
        *[(F.col(c) if c == "rep" else zero).alias(c) for c in columns])
    nodes = root if nodes is None else nodes.select(*columns).unionByName(root)
    kids = nodes.where("e > 0").groupBy(F.col("u1").alias("v1"), F.col("u2").alias("v2")).agg(F.count(F.lit(1)).alias("kids"))
    members = last.select(F.col("p1").alias("v1"), F.col("p2").alias("v2"), F.col("x").alias("mn"), "cnt")
    nodes = nodes.join(kids, ["v1", "v2"], "left").join(members, ["v1", "v2"], "left")
    cnt = F.coalesce("cnt", F.lit(0))
    nodes = materialize(nodes.withColumn("kids", F.coalesce("kids", zero)).withColumn("cnt", cnt).withColumns({
        "lead": F.col("cnt") * F.col("total"), "edge": F.col("total") - F.col("before"),
        "leaf": (F.col("kids") == 0).cast("long")}))
    sums = totals(nodes)
    up = sums.select(F.col("v1").alias("u1"), F.col("v2").alias("u2"), F.col("mn").alias("parent"))
    nodes = nodes.drop("mn", "cnt", "lead", "edge", "leaf").join(sums, ["v1", "v2"]).join(up, ["u1", "u2"])
    digests = end_digests(ends).withColumnsRenamed({"p1": "v1", "p2": "v2"})
    nodes = materialize(nodes.join(digests, ["v1", "v2"], "left").withColumn(
        # Over the subtree: members times length, less what stands before the edge, less one copy of each edge.
        "saved", F.col("lead") - F.col("cnt") * F.col("before") - F.col("edge")))
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    sha = F.coalesce("ends_sha256", empty)
    top = nodes.where("e = 0").select(
        F.col("mn").alias("conv_id"), F.col("e").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"),
        F.col("cnt").alias("n_convs"), F.col("kids").alias("n_children"), F.col("leaf").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), sha.alias("ends_sha256"))
    spread = nodes.where("e > 0").select("*", F.expr(_blocks("(pe + 1)", "e")).alias("_b"))
    spread = spread.select("*", F.expr(f"explode(sequence(greatest(pe + 1, _b * {BLOCK}), least(e, _b * {BLOCK} + {BLOCK - 1})))").alias("depth"))
    every = _looked_up(spread, table, "rep", "depth", {"len": "len", "upto": "upto"})
    end = F.col("depth") == F.col("e")
    return every.select(
        F.col("mn").alias("conv_id"), "depth",
        F.when(F.col("depth") == F.col("pe") + 1, F.col("parent")).otherwise(F.col("mn")).alias("parent_conv_id"),
        F.col("cnt").alias("n_convs"), F.when(end, F.col("kids")).otherwise(1).cast("long").alias("n_children"),
        F.col("leaf").alias("n_leaves"),
        (F.col("saved") - (F.col("cnt") - 1) * (F.col("upto") - F.col("len") - F.col("before"))).alias("saved_tokens"),
        F.when(end, sha).otherwise(empty).alias("ends_sha256")).unionByName(top)
