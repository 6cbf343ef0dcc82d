"""Greedy chunkers over a text that is spread over many rows.

The cut rule looks at one window ahead, so where a chunk begins decides where
all later ones begin: read as it stands, one text is one task. Here a text is
laid out in blocks of ``block`` code points, each with a halo of one window
from the next:

1. row offsets are running sums (:func:`quire.operators.scan.keyed_scan`, no
   text in one task), and each row sends its characters to the blocks they
   fall in, so a group is one block and its halo, never a text;
2. a block knows the cut after *every* position of its own, hence where a text
   that enters at any offset leaves it. No chunk is longer than ``size``, so
   this is a map of ``size`` small numbers;
3. maps are composed over the blocks of a text by pointer doubling: one
   equijoin a round, log2(blocks of the longest text) rounds;
4. each block cuts from its own entry; running counts number the chunks.

The rows' texts are joined with ``sep``. Null and empty rows are left out, a
text without rows has no chunks, and ties in the order are broken by the text.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from quire.functions import arrow as AR
from quire.functions import constants as C
from quire.functions import text as T
from quire.operators.scan import keyed_scan
from quire.session import materialize

BLOCK = 1 << 17


def _last(present: np.ndarray) -> np.ndarray:
    """Position of the last hit at or before each position (-1: none)."""
    return np.maximum.accumulate(np.where(present, np.arange(len(present)), -1))


def _starts(text: str, marks: list[str]) -> np.ndarray:
    """Where any of the marks (one or two characters) starts."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    hit = np.zeros(len(codes), bool)
    for m in marks:
        if len(m) == 1:
            hit |= codes == ord(m)
        elif len(codes) > 1:
            hit[:-1] |= (codes[:-1] == ord(m[0])) & (codes[1:] == ord(m[1]))
    return hit


Rule = tuple[list[str], float, int]  # marks, strict least share of the window, added to the cut


def fixed_rules(para_ratio: float = C.FIXED_PARAGRAPH_CUT_RATIO) -> list[Rule]:
    """Before the last blank line past ``para_ratio``."""
    return [(["\n\n"], para_ratio, 0)]


def boundary_rules(para_ratio: float = C.PARAGRAPH_CUT_RATIO, sent_ratio: float = C.SENTENCE_CUT_RATIO,
                   space_ratio: float = C.SPACE_CUT_RATIO) -> list[Rule]:
    """Paragraph, then after a sentence mark, then before a space."""
    return [(["\n\n"], para_ratio, 0), (C.SENTENCE_MARKS, sent_ratio, 1), ([" "], space_ratio, 0)]


def successors(text: str, own: int, left: int, size: int, rules: list[Rule]) -> np.ndarray:
    """The end of the chunk that starts at each of the first ``own`` positions.
    ``left``: code points from the text's first position to the end of all."""
    at = np.arange(own)
    out = at + size
    for marks, ratio, after in reversed(rules):
        last = _last(_starts(text, marks))
        # The mark must end inside the window.
        got = last[np.minimum(at + size - len(marks[0]), len(last) - 1)] - at
        out = np.where(got > size * ratio, at + got + after, out)
    return np.where(at + size >= left, left, out)


def exits(nxt: np.ndarray, size: int) -> np.ndarray:
    """For each entry offset below ``size``: the offset in the next block."""
    own = len(nxt)
    jump = nxt.copy()
    while True:
        inside = jump < own
        if not inside.any():
            break
        jump[inside] = jump[jump[inside]]
    every = np.concatenate([jump, np.arange(own, own + size)])  # an entry past the block leaves at once
    return every[:size] - own


def layout(rows: DataFrame, keys: list[str], order: list[str], text_col: str = "text",
           sep: str = C.PAGE_JOIN_SEPARATOR, block: int = BLOCK, halo: int = C.TRANSLATE_CHUNK_SIZE) -> DataFrame:
    """The keys (a struct and ``key_id``, their name in later joins), block
    number ``b``, its text with the halo and the whole text's length ``n``,
    written once."""
    rows = rows.where(F.col(text_col).isNotNull() & (F.col(text_col) != "")).select(
        F.struct(*keys).alias("_key"), *order, F.col(text_col).alias("_text"))
    # Offsets come from a scan of keys and lengths alone, and travel to the
    # texts in one join. Rows of equal order are told apart by their texts, so
    # if there are any, the texts go through the scan.
    sizes = materialize(rows.select("_key", *order, F.length("_text").cast("long").alias("_n")))
    if sizes.groupBy("_key", *order).agg(F.count(F.lit(1)).alias("c")).where("c > 1").isEmpty():
        scanned = keyed_scan(sizes, "_key", order, sums={"_upto": F.col("_n")}).alias("s")
        t = rows.alias("t")
        same = [F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}")) for c in ["_key", *order]]
        placed = t.join(scanned, same).select("t.*", "s.i", "s._upto")
    else:
        placed = keyed_scan(rows, "_key", [*order, "_text"], sums={"_upto": F.length("_text").cast("long")})
    first = F.col("i") == 1
    start = F.col("_upto") - F.length("_text") + F.when(first, 0).otherwise((F.col("i") - 2) * len(sep))
    placed = placed.select("_key", start.cast("long").alias("_o"),
                           F.when(first, F.col("_text")).otherwise(F.concat(F.lit(sep), F.col("_text"))).alias("_text"))
    ends = placed.withColumn("_z", F.col("_o") + F.length("_text"))
    spread = ends.select("*", F.expr(
        f"explode(sequence(greatest(_o - {halo}, 0L) div {block}, (_z - 1) div {block}))").alias("b"))
    lo = F.greatest(F.col("_o"), F.col("b") * block)
    hi = F.least(F.col("_z"), (F.col("b") + 1) * block + halo)
    pieces = spread.where(lo < hi).select(
        "_key", "b", lo.alias("_at"), "_z",
        F.substring("_text", (lo - F.col("_o") + 1).cast("int"), (hi - lo).cast("int")).alias("_piece"))
    whole = sizes.groupBy(F.col("_key").alias("_k")).agg(
        (F.sum("_n") + (F.count(F.lit(1)) - 1) * len(sep)).alias("n"))
    blocks = pieces.groupBy("_key", "b").agg(F.expr("listagg(_piece, '') WITHIN GROUP (ORDER BY _at)").alias("text"))
    # A text may end inside the halo of its last full block: no block of its own.
    return materialize(blocks.join(whole, F.col("_key") == F.col("_k")).where(F.col("b") * block < F.col("n")).select(
        "_key", F.to_json("_key", {"ignoreNullFields": "false"}).alias("key_id"), "b", "text", "n"))


def per_block(blocks: DataFrame, fn: Callable, block: int, schema: str) -> DataFrame:
    """``fn(row, text, own, left)`` for each block: its own code points and
    those from its start to the end of the whole text. A task holds a bounded
    part of its blocks as objects, and the answer for one of them."""
    fields = to_arrow_schema(StructType.fromDDL(schema))

    def work(batches):
        for b in batches:
            for part in AR.parts(b):
                for r in part.to_pandas().itertuples():
                    out = fn(r, r.text, int(min(block, r.n - r.b * block)), int(r.n - r.b * block))
                    yield from pa.Table.from_pandas(out, fields, preserve_index=False).to_batches()

    return blocks.mapInArrow(work, schema)


def entries(blocks: DataFrame, size: int, rules: list[Rule], block: int) -> DataFrame:
    """(key_id, b, entry) for every block after the first of its text."""
    def leave(r, text, own, left):
        return pd.DataFrame({"key_id": [r.key_id], "b": [r.b], "m": [exits(successors(text, own, left, size, rules), size).tolist()]})

    maps = per_block(blocks.where(F.col("n") > block * (F.col("b") + 1)).select("key_id", "b", "text", "n"), leave, block,
                     "key_id string, b long, m array<int>")
    maps = composed(maps, ["key_id"], blocks.agg(F.max("b")).first()[0] or 0,
                    lambda before, m: F.transform(before, lambda x: F.get(m, x)))
    return maps.select("key_id", (F.col("b") + 1).alias("b"), F.get("m", F.lit(0)).alias("entry"))


def composed(maps: DataFrame, by: list[str], longest: int, after: Callable) -> DataFrame:
    """(``by``, b, m) with each map taken after all maps of the blocks before
    it, by pointer doubling. ``after(before, m)``: first ``before``, then ``m``."""
    step = 1
    while step <= longest:
        # Each map after the one that ends where it begins.
        maps = materialize(maps)
        before = maps.select(*by, (F.col("b") + step).alias("b"), F.col("m").alias("_before"))
        maps = maps.join(before, [*by, "b"], "left").select(*by, "b", F.when(
            F.col("_before").isNull(), F.col("m")).otherwise(after(F.col("_before"), F.col("m"))).alias("m"))
        step *= 2
    return maps


def _chunks(rows: DataFrame, keys: list[str], order: list[str], rules: list[Rule], size: int, strip: bool,
            text_col: str, sep: str, block: int) -> DataFrame:
    if block < size:
        raise ValueError("a block holds at least one window")
    laid = layout(rows, keys, order, text_col, sep, block, size)
    at = laid.join(entries(laid, size, rules, block), ["key_id", "b"], "left").select(
        "key_id", "b", "text", "n", F.coalesce("entry", F.lit(0)).alias("entry"))

    def cut(r, text, own, left):
        nxt, at, out = successors(text, own, left, size, rules), int(r.entry), []
        while at < own:
            out.append(text[at:nxt[at]])
            at = int(nxt[at])
        return pd.DataFrame({"key_id": r.key_id, "b": r.b, "k": range(1, len(out) + 1), "text": out}).astype(
            {"b": "int64", "k": "int64"})

    parts = materialize(per_block(at, cut, block, "key_id string, b long, k long, text string"))
    earlier = Window.partitionBy("key_id").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    counts = parts.groupBy("key_id", "b").agg(F.count(F.lit(1)).alias("c")).select(
        "key_id", "b", F.coalesce(F.sum("c").over(earlier), F.lit(0)).alias("before"),
        F.sum("c").over(Window.partitionBy("key_id")).alias("n_parts"))
    named = laid.where("b = 0").select("key_id", "_key")
    text = T.py_strip("text") if strip else F.col("text")
    numbered = parts.join(counts, ["key_id", "b"]).select(
        "key_id", (F.col("before") + F.col("k")).cast("int").alias("part_no"), F.col("n_parts").cast("int").alias("n_parts"),
        text.alias("text"))
    return numbered.join(named, "key_id").select("_key.*", "part_no", "n_parts", "text")


def chunk_boundary(rows: DataFrame, keys: list[str], order: list[str], size: int = C.TRANSLATE_CHUNK_SIZE,
                   text_col: str = "text", sep: str = C.PAGE_JOIN_SEPARATOR, block: int = BLOCK, **ratios) -> DataFrame:
    """T3 over rows: what :func:`quire.operators.chunk.chunk_boundary` gives
    for the joined text, without ever joining it."""
    return _chunks(rows, keys, order, boundary_rules(**ratios), size, True, text_col, sep, block)


def chunk_fixed(rows: DataFrame, keys: list[str], order: list[str], size: int = C.FIXED_CHUNK_SIZE,
                text_col: str = "text", sep: str = C.PAGE_JOIN_SEPARATOR, block: int = BLOCK, **ratios) -> DataFrame:
    """T2 over rows."""
    return _chunks(rows, keys, order, fixed_rules(**ratios), size, False, text_col, sep, block)
