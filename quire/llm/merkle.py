"""Merkle dataset manifest by sibling-shift self-joins.

Every row is a leaf; the leaves of a source, in order, are level 0 of its
tree, and the tops of all sources are level 0 of the tree of sources. At each
level a node's run and its slot follow from its index alone, so each sibling
is found by an equijoin of the level with itself on a computed index (index
XOR 1 for pairs, shifted slots for wider runs). Slot zero then emits the
parent. Nothing is grouped: a source with a third of all rows is spread by
index like any other.

Proofs go down the same way: a node's path (the siblings left and right of it
at each level) is its own step before its parent's path, one equijoin a level.

Defined results: nulls are written as ``-``, a null source is a source that
comes first, null numbers come first in their source; rows of equal number
are ordered by their leaf (equal rows are leaves of their own); a null number
is not tampered with; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.ordered import ranked
from quire.session import materialize

FAN = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_STEP = "array<struct<left:binary,right:binary>>"


def field(value: Column) -> Column:
    """One field of a leaf: ``-``, or its length in bytes and the value."""
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def _hash(digests: Column) -> Column:
    """SHA-256 of joined digests, taken as lowercase hexadecimal text."""
    return F.unhex(F.sha2(F.lower(F.hex(digests)), 256))


def _none() -> Column:
    return F.lit(b"")


def runs(nodes: DataFrame, fan: int) -> DataFrame:
    """Each node (g, i, n, digest and more) with the digests left and right
    of it in its run, found by ``fan - 1`` self-joins."""
    slot = F.pmod("i", F.lit(fan))
    out = nodes
    for k in range(1, fan):
        want = F.col("i").bitwiseXOR(F.lit(1)) if fan == 2 else F.col("i") - slot + F.pmod(slot + k, F.lit(fan))
        other = nodes.select(F.col("g").alias("_g"), F.col("i").alias("_i"), F.col("digest").alias(f"_d{k}"))
        out = out.withColumn("_want", want).join(
            other, (F.col("g") == F.col("_g")) & (F.col("_want") == F.col("_i")), "left").drop("_g", "_i", "_want")

    def at(t: int) -> Column:
        shifted = [F.when(F.pmod(slot + k, F.lit(fan)) == t, F.col(f"_d{k}")) for k in range(1, fan)]
        return F.coalesce(*shifted, _none())

    left = F.concat(*[F.when(slot > t, at(t)).otherwise(_none()) for t in range(fan - 1)])
    right = F.concat(*[F.when(slot < t, at(t)).otherwise(_none()) for t in range(1, fan)])
    return out.select(*nodes.columns, left.alias("left"), right.alias("right"))


def tree(leaves: DataFrame, fan: int, deepest: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """``leaves``: (g, i, n, digest and more), written. Levels with siblings
    (each written once) and, per level, the trees that end there (g, digest,
    and what the leaves have for those of one leaf). ``deepest``: the size of
    the largest tree."""
    levels, tops, nodes = [], [leaves.where("n = 1")], leaves
    while deepest > 1:
        level = materialize(runs(nodes.where("n > 1"), fan))
        levels.append(level)
        nodes = level.where(F.pmod("i", F.lit(fan)) == 0).select(
            "g", F.expr(f"i div {fan}").alias("i"), F.expr(f"(n + {fan - 1}) div {fan}").alias("n"),
            _hash(F.concat("digest", "right")).alias("digest"))
        tops.append(nodes.where("n = 1"))
        deepest = -(-deepest // fan)
    return levels, tops


def paths(levels: list[DataFrame], ends: dict[int, DataFrame], fan: int, carried: list[str]) -> DataFrame:
    """Steps from each leaf with siblings to the end of its path. ``ends``: by
    level, (g, steps, ``carried``): what follows after the trees that end there."""
    names = ["g", "i", "steps", *carried]
    ends = {k: e.withColumn("i", F.lit(0).cast("long")).select(*names) for k, e in ends.items()}
    down = ends[len(levels)]
    for k in reversed(range(len(levels))):
        above = down.withColumnsRenamed({"g": "_g", "i": "_i"})
        level = levels[k].join(above, (F.col("g") == F.col("_g")) & (F.expr(f"i div {fan}") == F.col("_i")))
        more = [c for c in levels[0].columns if c not in ("g", "i", "n", "left", "right")] if k == 0 else []
        down = level.select("g", "i", F.concat(F.array(F.struct("left", "right")), "steps").alias("steps"), *carried, *more)
        if k and k in ends:
            down = down.unionByName(ends[k])
    return down


def manifest(docs: DataFrame, fan: int = FAN) -> DataFrame:
    """doc_id, leaf, tampered (null where nothing is changed), subroot, root
    and the steps of the proof (binary digests) of each row."""
    text = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    fields = [field(F.col(c)) for c in FIELDS]
    changed = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(2)) == 0
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        # The group's name sorts like the source, null first.
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("g"),
        F.unhex(F.sha2(F.concat(*fields), 256)).alias("digest"),
        F.when(changed, F.unhex(F.sha2(F.concat(*fields[:-1], field(text)), 256))).alias("tampered"))
    leaves = materialize(ranked(rows, "g", ["doc_id", "digest"], ["doc_id", "digest", "tampered"]))
    size = leaves.agg(F.max("n")).first()[0] or 0
    levels, tops = tree(leaves, fan, size)
    ends = reduce(DataFrame.unionByName, [t.select("g", "digest", F.lit(k).alias("level")) for k, t in enumerate(tops)])
    # The tree of sources: one group, ordered by name.
    names = materialize(ranked(ends.withColumn("all", F.lit("")), "all", ["g"], ["g", "digest", "level"]).select(
        F.col("all").alias("g"), "i", "n", "digest", F.col("g").alias("name"), "level"))
    upper, top = tree(names, fan, names.count())
    end = top[-1].select("g", F.col("digest").alias("root"), F.array().cast(_STEP).alias("steps"))
    sources = paths(upper, {len(upper): end}, fan, ["root"]) if upper else names.join(end, "g")
    sources = materialize(sources.select(F.col("name").alias("g"), "level", F.col("digest").alias("subroot"), "root", "steps"))
    # At most one row for each level.
    used = [r[0] for r in sources.select("level").distinct().collect()]
    ends = {k: sources.where(F.col("level") == k).drop("level") for k in used}
    found = ["doc_id", F.col("digest").alias("leaf"), "tampered", "subroot", "root", "steps"]
    parts = [leaves.where("n = 1").join(sources.where("level = 0"), "g").select(*found)]
    if levels:
        parts.append(paths(levels, ends, fan, ["subroot", "root"]).select(*found))
    return reduce(DataFrame.unionByName, parts)


def digest(proofs: DataFrame) -> DataFrame:
    """The query's columns: proofs as their SHA-256, folded and verified."""
    def text(c):
        return F.lower(F.hex(c))

    joined = F.array_join(F.transform("steps", lambda s: F.concat(text(s["left"]), text(s["right"]))), "")
    folded = F.aggregate("steps", text(F.coalesce("tampered", "leaf")),
                         lambda acc, s: F.sha2(F.concat(text(s["left"]), acc, text(s["right"])), 256))
    return proofs.select(
        "doc_id", text("leaf").alias("leaf"), text("subroot").alias("subroot"), text("root").alias("root"),
        F.sha2(joined, 256).alias("proof_sha256"), folded.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))
