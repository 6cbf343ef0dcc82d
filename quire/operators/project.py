"""Row-wise projections and filters over chapter tables.

P6–P9, P12, P15, P19, O2–O4, K7 names. All are narrow (no shuffle) except
the per-book limit, which Spark plans as a window group-limit: a partial
top-N runs before the shuffle so only N rows per book and map task move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import constants as C
from quire.functions import text as T


def title_and_body(text: Column) -> tuple[Column, Column]:
    """Split on the first newline; without one, title = body = text."""
    parts = F.split(text, "\n", 2)
    return F.element_at(parts, 1), F.coalesce(F.get(parts, 1), text)


def head(text: Column, n: int, ellipsis: bool = False) -> Column:
    """First ``n`` code points, optionally always followed by ``...``."""
    h = F.substring(text, 1, n)
    return F.concat(h, F.lit(C.ELLIPSIS)) if ellipsis else h


def chapter_file_names(n: Column) -> dict[str, Column]:
    """P12/F17 + K7: the per-chapter artefact names (zero-padded, never cut)."""
    pad = T.zero_pad(n)
    return {
        "chapter_file": F.concat(F.lit("chapter_"), pad, F.lit(".txt")),
        "translation_file": F.concat(F.lit("chapter_"), pad, F.lit("_cn.md")),
        "summary_file": F.concat(F.lit("chapter_"), pad, F.lit("_summary.txt")),
        "audio_full_file": F.concat(F.lit("chapter_"), pad, F.lit("_full.mp3")),
        "page_file": F.concat(F.lit("chapter_"), pad, F.lit(".html")),
        "formatted_file": F.concat(F.lit("chapter_"), pad, F.lit("_cn_formatted.md")),
    }


def rewrite_literals(text: Column, pairs: list[tuple[str, str]]) -> Column:
    """Chained literal replaces, applied in order."""
    out = text
    for a, b in pairs:
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def first_n_per_group(df: DataFrame, keys: list[str], order: list[str], n: int | None) -> DataFrame:
    """First ``n`` rows per group after sorting; ``0``/``None`` = all."""
    if not n:
        return df
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def chapter_range(df: DataFrame, start: int, end: int | None = None, col: str = "chapter_no") -> DataFrame:
    """Chapters ``start..end`` inclusive; ``end`` defaults to ``start``."""
    return df.where(F.col(col).between(start, start if end is None else end))
