"""Catalogue, export and page building (J3, J4, A7, A11, P10, P11, P16–P18,
P22, T7, K4, K5, S8).

Per-chapter facts come from left joins of small per-chapter tables keyed by
``(book_id, chapter_no)``; per-book documents are one ``collect_list`` of
chapter structs per book (a book has tens of chapters, so the group is
bounded by the book, not by the corpus). The JSON forms use ``to_json``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import constants as C
from quire.functions import text as T
from quire.operators.lines import markdown_to_html
from quire.sinks.stream import stream_files

#: Bytes of a book export that a task reads.
READ_BYTES = 32 << 20


def preview(summary: Column, n: int = C.PREVIEW_CHARS) -> Column:
    """P10: stripped summary cut to ``n`` chars plus ``...``; missing ⇒ literal."""
    s = T.py_strip(summary)
    return F.when(summary.isNull(), F.lit(C.NO_SUMMARY_TEXT)).otherwise(
        F.when(F.length(s) > n, F.concat(F.substring(s, 1, n), F.lit(C.ELLIPSIS))).otherwise(s))


def title_keys(toc: DataFrame) -> list[str]:
    """Titles are keyed by book and chapter, or by chapter where one table of
    contents holds for all books."""
    return [c for c in ("book_id", "chapter_no") if c in toc.columns]


def catalogue(spark: SparkSession, translations: DataFrame, summaries: DataFrame,
              merged: DataFrame, toc: DataFrame) -> DataFrame:
    """J3 + J4 + A7 + P10 + P11 + P18: one catalogue row per translated
    chapter, whatever the book's size.

    ``translations(book_id, chapter_no, text)``, ``summaries(book_id,
    chapter_no, text)`` (no row = no summary), ``merged(book_id, chapter_no)``
    (a full audio file exists), ``toc([book_id,] chapter_no, title)``.
    """
    k = ["book_id", "chapter_no"]
    return (translations.select(*k, T.cjk_count(F.col("text")).alias("wordCount"))
            .join(summaries.select(*k, F.col("text").alias("_summary")), k, "left")
            .join(merged.select(*k, F.lit(True).alias("_audio")), k, "left")
            .join(toc.withColumnRenamed("title", "_title"), title_keys(toc), "left")
            .select(*k,
                    F.col("chapter_no").alias("number"),
                    F.coalesce("_title", F.format_string(C.DEFAULT_TITLE_CATALOGUE, F.col("chapter_no"))).alias("title"),
                    preview(F.col("_summary")).alias("summary"),
                    F.coalesce("_audio", F.lit(False)).alias("hasAudio"),
                    "wordCount",
                    F.format_string("chapter_%02d.html", F.col("chapter_no")).alias("file")))


CATALOGUE_FIELDS = ["number", "title", "summary", "hasAudio", "wordCount", "file"]


def catalogue_json(cat: DataFrame) -> DataFrame:
    """K4 + A11: the catalogue of each book as one JSON array, by number."""
    return cat.groupBy("book_id").agg(
        F.to_json(F.array_sort(F.collect_list(F.struct(*CATALOGUE_FIELDS)))).alias("json"),
        F.count("*").alias("n_chapters"))


def export_chapter() -> Column:
    """K5: one chapter of the export; ``original`` is cut to 500 chars."""
    return F.struct(
        "number", "title",
        F.concat(F.substring("original", 1, C.EXPORT_PREVIEW_CHARS), F.lit(C.ELLIPSIS)).alias("original"),
        "translation", "summary", "audio")


def book_export(chapters: DataFrame, book_title: Column) -> DataFrame:
    """K5: nested export per book; ``original`` is always cut to 500 chars
    plus ``...``. ``chapters(book_id, number, title, original, translation,
    summary, audio)``; ``book_title``: an expression over ``book_id``."""
    ch = chapters.select("book_id", export_chapter().alias("c"))
    per_book = ch.groupBy("book_id").agg(F.array_sort(F.collect_list("c")).alias("chapters"))
    return per_book.select(
        "book_id", F.to_json(F.struct(
            book_title.alias("book_title"), F.size("chapters").alias("total_chapters"), F.col("chapters"))).alias("json"))


def write_book_export(chapters: DataFrame, book_title: Column, base: str) -> DataFrame:
    """K5 as one file a book (``base/<book_id>.json``), whatever the book's
    size: the JSON of ``book_export``, with a line for the head, one for each
    chapter and one for the end. Returns the files (name, n_bytes, n_rows)."""
    head = F.concat(F.lit('{"book_title":'), F.to_json(F.array(book_title)).substr(F.lit(2), F.length(F.to_json(F.array(book_title))) - 2),
                    F.lit(',"total_chapters":'), F.col("n_rows").cast("string"), F.lit(',"chapters":[\n'))
    return stream_files(chapters, "book_id", "number", F.to_json(export_chapter()),
                        F.format_string("%d.json", F.col("book_id")), base, head=head, between=",\n", tail="\n]}")


def read_book_export(spark: SparkSession, base: str, n_bytes: int | None = None) -> DataFrame:
    """The chapters of the files of ``write_book_export``, a line at a time:
    files are split, and no row holds more than a chapter. The folder is one
    listing: a pattern in the path would make each file a path of its own, and
    their listing a job with a task for each.

    ``n_bytes``: the size of all files, if known. Spark counts a small file as
    4 MB, so books would be read by few in a task; their tasks are then joined
    to ``READ_BYTES`` each on average, but not to fewer than a shuffle has."""
    schema = "number INT, title STRING, original STRING, translation STRING, summary STRING, audio STRING"
    lines = spark.read.option("pathGlobFilter", "*.json").text(base, lineSep="\n").select(
        F.regexp_extract(F.col("_metadata.file_name"), r"^(\d+)\.json$", 1).cast("bigint").alias("book_id"), "value")
    if n_bytes is not None:
        lines = lines.coalesce(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // READ_BYTES)))
    return lines.where(F.col("value").startswith('{"number":')).select(
        "book_id", F.from_json(_uncomma(F.col("value")), schema).alias("c")).select("book_id", "c.*")


def _uncomma(line: Column) -> Column:
    """The line without one comma at its end; a pattern would stop at each comma."""
    return F.when(line.endswith(","), F.substring(line, F.lit(1), F.length(line) - 1)).otherwise(line)


def chapter_page(number: Column, title: Column, summary_full: Column, has_audio: Column,
                 markdown: Column) -> Column:
    """page = header, summary box (full text) if any, audio box if the
    full file exists, then the body rendered by T8."""
    header = F.format_string("<header><h1>Chapter %d: %s</h1></header>", number, title)
    summary_box = F.when(summary_full.isNotNull(), F.concat(
        F.lit('<section class="summary"><h3>Summary</h3><p>'), summary_full, F.lit("</p></section>"))
    ).otherwise(F.lit(""))
    audio_box = F.when(has_audio, F.format_string(
        '<section class="audio"><audio controls src="../audio/chapter_%02d_full.mp3"></audio></section>', number)
    ).otherwise(F.lit(""))
    return F.concat_ws("\n", header, summary_box, audio_box,
                       F.concat(F.lit("<article>\n"), markdown_to_html(markdown), F.lit("\n</article>")))


def book_status_class(status: Column) -> Column:
    """Completed vs in-progress badge."""
    return F.when(status == C.STATUS_COMPLETED, F.lit("completed")).otherwise(F.lit("in-progress"))


def card_count_text(word_count: Column) -> Column:
    """A zero or missing count shows as ``N/A``."""
    return F.coalesce(F.nullif(word_count, F.lit(0)).cast("string"), F.lit(C.WORDCOUNT_MISSING))
