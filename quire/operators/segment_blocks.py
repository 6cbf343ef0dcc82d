"""Regex segmentation of a text that is spread over many rows.

The same rule as :mod:`quire.operators.segment`, for texts of any length. The
text is laid out in blocks with a halo (:mod:`quire.operators.blocks`). Each
block finds the matches that *could* start at its own line breaks. A search
goes on where the last match ended, so which of them count depends on where
the scan enters the block: a step function of that offset, composed over the
blocks by pointer doubling. Offsets in the whole text then make chapters: the
body of a kept match runs to the next kept one, gaps and all. Nothing is
marked inside the text, no text and no chapter is in one cell; a chapter comes
as pieces of at most ``piece`` code points.

How far a match can reach is bounded by the runs of white space, digits and
colons in it. The halo is four times the longest such run and a fixed rest; if
a text has longer runs than the halo allows, it is laid out again with a
longer one, so no match is cut. Null and empty rows are left out.
"""

from __future__ import annotations

import bisect
import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import constants as C
from quire.operators import blocks as BL
from quire.operators.scan import keyed_scan
from quire.session import materialize

REST = 256   # more than the bounded parts of any pattern
HALO = 4 * 1024 + REST
PIECE = 1 << 16
_WIDE = "[" + C.WS_CLASS[1:-1] + r"\p{Nd}:]"


def _halo(laid: DataFrame) -> int:
    """The halo that the longest run in the blocks asks for."""
    runs = F.regexp_extract_all("text", F.lit(f"({_WIDE}{{64,}}+)"), F.lit(1))
    longest = laid.select(F.array_max(F.transform(runs, F.length)).alias("x")).agg(F.max("x")).first()[0] or 64
    return 4 * longest + REST


def candidates(pattern: re.Pattern, text: str, own: int) -> list[tuple[int, int, str]]:
    """Start, end and title of the match at each own line break that has one."""
    out, at = [], text.find("\n", 0, own)
    while at >= 0:
        m = pattern.match(text, at)
        if m:
            out.append((at, m.end(), m.group(1).strip()))
        at = text.find("\n", at + 1, own)
    return out


def scan_steps(found: list[tuple[int, int, str]], own: int, halo: int) -> list[tuple[int, int]]:
    """(t, x): a scan that enters after the step before and at ``t`` or earlier
    leaves the block at offset ``x`` of the next."""
    starts = [s for s, _, _ in found]
    leave = [0] * (len(found) + 1)
    for k in reversed(range(len(found))):
        after = bisect.bisect_left(starts, found[k][1])
        leave[k] = leave[after] if after < len(found) else max(found[k][1] - own, 0)
    steps = list(zip(starts, leave)) + [(own, 0)]
    cut = next(k for k, (t, _) in enumerate(steps) if t >= halo or t == own)
    return steps[:cut] + [(max(own, halo), steps[cut][1])]


def chosen(found: list[tuple[int, int, str]], entry: int):
    """The matches that a scan from ``entry`` finds."""
    for s, e, title in found:
        if s >= entry:
            yield s, e, title
            entry = e


def title_kept(title: str) -> bool:
    low = title.lower()
    return (not any(x in low for x in C.SEGMENT_TITLE_BANNED) and len(title) >= C.SEGMENT_TITLE_MIN_LEN
            and not title.startswith(C.SEGMENT_TITLE_BANNED_PREFIX))


def around(text: str, own: int, found: list[tuple[int, int, str]]) -> list[dict]:
    """Each match with the place after the last text before it (-1: white
    space alone before it in this block) and of the first text after it (-1:
    none up to the end of the whole text)."""
    out = []
    for s, e, title in found:
        before, after = s, e
        while before and text[before - 1].isspace():
            before -= 1
        while after < len(text) and text[after].isspace():
            after += 1
        out.append({"s": s, "e": e, "title": title, "kept": title_kept(title), "before": before or -1,
                    "after": after if after < len(text) else -1})
    return out


_FOUND = "s:int,e:int,title:string,kept:boolean,before:int,after:int"


def matches(laid: DataFrame, halo: int, block: int, patterns: list[str] = C.SEGMENT_PATTERNS) -> tuple[DataFrame, DataFrame]:
    """(key_id, pattern_no, start, stop, title, kept, before, after): every
    match of every pattern, with offsets in the whole text, where the text
    before it ends and the text after it starts (both without white space; see
    :func:`around`); and (key_id, b, last): where the text of a block ends.
    The texts are read once: what could match is written down."""
    compiled = [re.compile(p, re.IGNORECASE | re.MULTILINE) for p in patterns]

    def look(r, text, own, left):
        last = len(text[:own].rstrip())
        rows = [(r.key_id, 0, r.b, None, [], r.b * block + last if last else None)]
        for k, p in enumerate(compiled, 1):
            found = candidates(p, text, own)
            steps = [{"t": t, "x": x} for t, x in scan_steps(found, own, halo)] if left > block else None
            rows.append((r.key_id, k, r.b, steps, around(text, own, found), None))
        return pd.DataFrame(rows, columns=["key_id", "pattern_no", "b", "m", "found", "last"]).astype(
            {"pattern_no": "int32", "last": "Int64"})

    seen = materialize(BL.per_block(
        laid.select("key_id", "b", "text", "n"), look, block,
        f"key_id string, pattern_no int, b long, m array<struct<t:int,x:int>>, found array<struct<{_FOUND}>>, last long"))
    ends = seen.where("pattern_no = 0 and last is not null").select("key_id", "b", "last")

    def at(m: Column, x: Column) -> Column:
        return F.get(F.filter(m, lambda s: s["t"] >= x), F.lit(0))["x"]

    maps = seen.where("m is not null").select("key_id", "pattern_no", "b", "m")
    maps = BL.composed(maps, ["key_id", "pattern_no"], laid.agg(F.max("b")).first()[0] or 0,
                       lambda before, m: F.transform(before, lambda s: F.struct(s["t"].alias("t"), at(m, s["x"]).alias("x"))))
    enter = maps.select("key_id", "pattern_no", (F.col("b") + 1).alias("b"), at(F.col("m"), F.lit(0)).alias("entry"))

    def pick(batches):
        # One block's matches at a time.
        for batch in batches:
            for i in range(batch.num_rows):
                key, no, b, found, entry = (c[i].as_py() for c in batch.columns)
                got = [(x["s"], x["e"]) for x in found]
                got = [(key, no, b, s, e) for s, e, _ in chosen([(*x, "") for x in got], entry or 0)]
                if got:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                        zip(*got), (pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.int32()))],
                        ["key_id", "pattern_no", "b", "s", "e"])

    found = seen.where("size(found) > 0").select("key_id", "pattern_no", "b", "found")
    entered = found.select("key_id", "pattern_no", "b", F.transform(
        "found", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))).alias("found")).join(
        enter, ["key_id", "pattern_no", "b"], "left")
    picked = entered.mapInArrow(pick, "key_id string, pattern_no int, b long, s int, e int")
    each = found.select("key_id", "pattern_no", "b", F.inline("found"))
    got = each.join(picked, ["key_id", "pattern_no", "b", "s", "e"])
    place = F.col("b") * block
    return materialize(got.select(
        "key_id", "pattern_no", "b", (place + F.col("s")).alias("start"), (place + F.col("e")).alias("stop"), "title",
        "kept", F.when(F.col("before") >= 0, place + F.col("before")).alias("before"),
        F.when(F.col("after") >= 0, place + F.col("after")).alias("after"))), ends


def _spread(ranges: DataFrame, laid: DataFrame, block: int) -> DataFrame:
    """Ranges [a, z) with the part of the text that each block of theirs has."""
    wide = ranges.select("*", F.expr(f"explode(sequence(a div {block}, greatest(z - 1, a) div {block}))").alias("b"))
    lo, hi = F.greatest(F.col("a"), F.col("b") * block), F.least(F.col("z"), (F.col("b") + 1) * block)
    return wide.join(laid.select("key_id", "b", F.col("text").alias("_text")), ["key_id", "b"]).select(
        *wide.columns, lo.alias("lo"),
        F.substring("_text", (lo - F.col("b") * block + 1).cast("int"), (hi - lo).cast("int")).alias("part"))


def split_into_chapters(rows: DataFrame, keys: list[str], order: list[str], title: Column, text_col: str = "text",
                        sep: str = C.PAGE_JOIN_SEPARATOR, block: int = BL.BLOCK, piece: int = PIECE,
                        halo: int = HALO, min_body: int = C.SEGMENT_MIN_BODY,
                        patterns: list[str] = C.SEGMENT_PATTERNS) -> DataFrame:
    """``keys``, pattern_no, chapter_no, title, n_chars, piece_no and the piece's
    text. ``title`` (over the keys) names a text without chapters, which is one
    chapter of pattern 0, as it stands."""
    while True:
        block = max(block, halo)
        laid = BL.layout(rows, keys, order, text_col, sep, block, halo)
        needed = _halo(laid)
        if needed <= halo:
            break
        halo = needed
    found, block_ends = matches(laid, halo, block, patterns)
    found = found.where("kept")
    winner = found.groupBy("key_id", "pattern_no").agg(F.count(F.lit(1)).alias("c")) \
        .where(F.col("c") >= C.SEGMENT_MIN_MATCHES).groupBy("key_id").agg(F.min("pattern_no").alias("pattern_no"))
    winner = materialize(winner)
    whole = laid.where("b = 0").select("key_id", "_key", "n")
    numbered = materialize(keyed_scan(found.join(winner, ["key_id", "pattern_no"]).select(
        "key_id", "pattern_no", "b", "start", "title", "before", "after"), "key_id", ["start"], index="i"))
    # Bodies are stripped: from the first text after a match to the last before
    # the next one, or of all. No run of white space is as long as a block, so
    # where a block has none before a match, the one before it has.
    earlier = block_ends.select("key_id", (F.col("b") + 1).alias("b"), "last")
    stops = numbered.join(earlier, ["key_id", "b"], "left").select(
        "key_id", "i", F.coalesce("before", "last", F.lit(0)).alias("z"))
    text_ends = block_ends.groupBy("key_id").agg(F.max("last").alias("_end"))
    nexts = stops.select("key_id", (F.col("i") - 1).alias("i"), "z")
    bodies = numbered.join(nexts, ["key_id", "i"], "left").join(text_ends, "key_id", "left").select(
        "key_id", "pattern_no", F.col("i").cast("int").alias("chapter_no"), "title", F.col("after").alias("a"),
        F.coalesce("z", "_end").alias("z"))
    ends = bodies.where((F.col("a") < F.col("z")) & (F.col("z") - F.col("a") >= min_body))
    alone = whole.join(winner, "key_id", "left_anti").select(
        "key_id", F.lit(0).alias("pattern_no"), F.lit(1).alias("chapter_no"), F.lit(None).cast("string").alias("title"),
        F.lit(0).cast("long").alias("a"), F.col("n").alias("z"))
    chapters = materialize(ends.unionByName(alone))
    cut = chapters.select("*", (F.col("z") - F.col("a")).alias("n_chars"),
                          F.expr(f"explode(sequence(0L, (z - a - 1) div {piece}))").alias("k"))
    cut = cut.withColumn("a", F.col("a") + F.col("k") * piece).withColumn("z", F.least("z", F.col("a") + piece))
    names = ["key_id", "pattern_no", "chapter_no", "title", "n_chars", "k"]
    # Most pieces are in one block, and only the others are put together.
    inside = F.expr(f"a div {block} = (z - 1) div {block}")
    pieces = _spread(cut.where(inside), laid, block).select(*names, F.col("part").alias("text")).unionByName(
        _spread(cut.where(~inside), laid, block).groupBy(*names).agg(
            F.expr("listagg(part, '') WITHIN GROUP (ORDER BY lo)").alias("text")))
    return pieces.join(whole.select("key_id", "_key.*"), "key_id").select(
        *keys, "pattern_no", "chapter_no", F.coalesce(F.col("title"), title).alias("title"),
        F.col("n_chars").cast("int").alias("n_chars"), (F.col("k") + 1).cast("int").alias("piece_no"), "text")
