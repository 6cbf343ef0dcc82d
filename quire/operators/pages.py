"""Pages → chapters: boundary detection, ranges, range join, ordered concat.

Operators P1, P2, A1, W1, J1, J2, A2, A4, O5. Every window and group is
keyed by ``book_id`` so many books run in parallel; nothing is global.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import constants as C
from quire.functions import text as T


def non_empty_pages(pages: DataFrame) -> DataFrame:
    """Pages whose text is neither NULL nor empty."""
    return pages.where(F.col("text").isNotNull() & (F.col("text") != ""))


def start_candidates(pages: DataFrame, skip: int = C.FRONT_MATTER_PAGES,
                     lo: int = C.MIN_CHAPTER_NUMBER, hi: int = C.MAX_CHAPTER_NUMBER,
                     ratio: float = C.TITLE_UPPER_RATIO, toc: DataFrame | None = None) -> DataFrame:
    """P1 + P2: pages (after the front matter) that open a chapter.

    The first line, stripped, must be a 1–2 digit number in ``[lo, hi]`` and
    more than ``ratio`` of the letters on lines 2–3 must be upper case.
    With ``toc`` (``book_id``, ``chapter_no``) the bound and the digits are
    those of the book's own largest number; ``hi``, the reference's setting,
    is then the bound of books that it lacks.
    The page filter is a plain comparison, so it reaches the Parquet scan.
    """
    p = non_empty_pages(pages.where(F.col("page_no") >= F.lit(skip)))
    most, digits = F.lit(hi), F.lit(2)
    if toc is not None:
        p = p.join(toc.groupBy("book_id").agg(F.max("chapter_no").alias("_most")), "book_id", "left")
        most = F.coalesce(F.col("_most"), most)
        digits = F.greatest(F.length(most.cast("string")), digits)
    lines = F.slice(F.split(F.col("text"), "\n"), 1, C.PAGE_LINES_SCANNED)
    first = T.ascii_digits(T.py_strip(F.element_at(lines, 1)))
    title = F.array_join(F.slice(lines, 2, 2), " ")
    number = T.try_int(first)
    ok = (first.rlike(r"^[0-9]+$") & (F.length(first) <= digits) & number.between(F.lit(lo), most)
          & T.py_upper_ratio_gt(title, ratio))
    return (p.select("book_id", "page_no", number.alias("chapter_no"), ok.alias("ok"))
            .where(F.col("ok")).drop("ok"))


def chapter_starts(pages: DataFrame, **kw) -> DataFrame:
    """A1: first qualifying page per (book, chapter number).

    ``min`` is partially aggregated map-side, so only one row per chapter and
    map task crosses the shuffle.
    """
    return (start_candidates(pages, **kw)
            .groupBy("book_id", "chapter_no")
            .agg(F.min("page_no").alias("start_page")))


def book_page_counts(pages: DataFrame) -> DataFrame:
    """Page count per book (0-based page numbers, so last index + 1)."""
    return pages.groupBy("book_id").agg((F.max("page_no") + 1).alias("n_pages"))


def chapter_ranges(starts: DataFrame, page_counts: DataFrame) -> DataFrame:
    """``[start, end)`` where end is the next chapter *number*'s start,
    or the page count for the last one. Out-of-order starts therefore give
    empty or overlapping ranges, as in the reproduced behaviour."""
    w = Window.partitionBy("book_id").orderBy("chapter_no")
    return (starts.join(page_counts, "book_id")
            .select("book_id", "chapter_no", "start_page",
                    F.coalesce(F.lead("start_page").over(w), F.col("n_pages")).alias("end_page")))


def assign_pages(pages: DataFrame, ranges: DataFrame) -> DataFrame:
    """Range join ``start <= page_no < end`` on the same book.

    ``book_id`` is the equi key, the bounds are a residual; a page meets at
    most as many ranges as its own book has chapters, so the candidate set is
    bounded. AQE turns this into a broadcast join only when the measured
    size of ``ranges`` is under the threshold; otherwise it stays a shuffled
    join whose skewed book partitions AQE splits.
    """
    p = non_empty_pages(pages).alias("p")
    r = ranges.alias("r")
    cond = ((F.col("p.book_id") == F.col("r.book_id"))
            & (F.col("p.page_no") >= F.col("r.start_page"))
            & (F.col("p.page_no") < F.col("r.end_page")))
    return p.join(r, cond, "inner").select(
        F.col("r.book_id").alias("book_id"), F.col("r.chapter_no").alias("chapter_no"),
        F.col("p.page_no").alias("page_no"), F.col("p.text").alias("text"))


def chapter_texts(pages: DataFrame, ranges: DataFrame, toc: DataFrame | None = None,
                  default_title: str = C.DEFAULT_TITLE_SCAN) -> DataFrame:
    """J1 + A2 + A4 + J2: the chapter file for every range.

    Chapters whose range holds no non-empty page keep an empty body. The TOC
    is a fixed-size inline dimension, so it is broadcast.
    """
    assigned = assign_pages(pages, ranges)
    agg = (assigned.groupBy("book_id", "chapter_no")
           .agg(F.expr("listagg(text, '\\n\\n') WITHIN GROUP (ORDER BY page_no)").alias("body"),
                F.count("*").alias("n_text_pages")))
    out = (ranges.join(agg, ["book_id", "chapter_no"], "left")
           .select("book_id", "chapter_no", "start_page", "end_page",
                   F.coalesce("body", F.lit("")).alias("body"),
                   F.coalesce("n_text_pages", F.lit(0)).alias("n_text_pages")))
    if toc is not None:
        out = out.join(toc, [c for c in ("book_id", "chapter_no") if c in toc.columns], "left")
        title = F.coalesce(F.col("title"), F.lit(default_title))
    else:
        title = F.lit(default_title)
    return out.select(
        "book_id", "chapter_no", title.alias("title"), "start_page", "end_page",
        (F.col("end_page") - F.col("start_page")).alias("page_span"),
        "n_text_pages", F.length("body").alias("n_chars"),
        F.concat(F.format_string("%d. %s", F.col("chapter_no"), title),
                 F.lit("\n\n"), F.col("body")).alias("file_text"))
