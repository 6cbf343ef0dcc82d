"""Input views derived from the driver tables (FIXTURES.md part B).

Every view is a lazy DataFrame over the given parquet tables, so its size
grows with them. ``oracle.py`` restates each one as a DuckDB CTE.
"""

from __future__ import annotations

import string

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.sources.tables import table, text_table

PAGES_PER_BOOK = 50
FIRST_MARKED_PAGE = 10
MARK_EVERY = 7
LATE_BOOK, LATE_FIRST = 4, 18

# Invented titles for the TOC dimension (chapters 1..5; 6 is missing on purpose).
TOC_ROWS = [
    (1, "Opening Moves"),
    (2, "Laying the Groundwork"),
    (3, "Holding the Line"),
    (4, "Turning the Corner"),
    (5, "Closing the Circle"),
]
AFTERWORD = (7, "Afterword")

# Site-move rewrite applied to the web pages table (three literal pairs, the
# middle one a no-op, like the restructuring step being reproduced).
PAGE_REWRITES = [
    ('href="/', 'href="../../'),
    ('<article>', '<article>'),
    ('track(', 'trackPage('),
]

FIRST_N = 2
PIECE = 10_000
CHUNK_BLOCK = 1 << 16   # several blocks for most books
PAGE_CHARS, PAGES_APART = 997, 100_000
PAGED_SPLIT = 1 << 24
RANGE_START, RANGE_END = 3, 7


def _book_of(doc_id) -> "F.Column":
    return F.floor(F.col(doc_id) / F.lit(float(PAGES_PER_BOOK))).cast("bigint")


def _upper(c):
    # Engines disagree on the capital of "ß" (SS vs the capital sharp s);
    # spell it out first so the view is the same everywhere.
    return F.upper(F.replace(c, F.lit("ß"), F.lit("ss")))


def book_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``book_pages(book_id, page_no, text)``: 50 pages per book; pages 10, 17, …
    start with a chapter-number line and an upper-case title line. Chapters
    are numbered from 1; in every fourth book from 18, so past 19."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    page_no = (F.col("doc_id") % PAGES_PER_BOOK).cast("int")
    is_mark = (page_no >= FIRST_MARKED_PAGE) & (((page_no - FIRST_MARKED_PAGE) % MARK_EVERY) == 0)
    chap = (F.floor((page_no - FIRST_MARKED_PAGE) / F.lit(float(MARK_EVERY))) + 1).cast("bigint")
    chap = chap + F.when(_book_of("doc_id") % LATE_BOOK == LATE_BOOK - 1, LATE_FIRST - 1).otherwise(0)
    first_line = F.element_at(F.split(F.col("text"), "\n"), 1)
    heading = F.concat(chap.cast("string"), F.lit("\n"),
                       _upper(F.substring(first_line, 1, 60)), F.lit("\n"), F.col("text"))
    return d.select(
        _book_of("doc_id").alias("book_id"),
        page_no.alias("page_no"),
        F.when(is_mark, heading).otherwise(F.col("text")).alias("text"),
    )


def toc(spark: SparkSession) -> DataFrame:
    """Small inline dimension (S7); its size is fixed, so broadcasting it is safe."""
    return spark.createDataFrame(TOC_ROWS, "chapter_no int, title string")


def book_toc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``book_toc(book_id, chapter_no, title)``: each book's own table of
    contents, which grows with the books: its numbers, and titles of its own.
    The sixth chapter is not listed, though there is one."""
    books = table(spark, sf_dir, "documents").select(_book_of("doc_id").alias("book_id")).distinct()
    late = F.when(F.col("book_id") % LATE_BOOK == LATE_BOOK - 1, LATE_FIRST - 1).otherwise(0)
    # Fixed size: one row for each chapter of a book.
    rows = spark.createDataFrame([*TOC_ROWS, AFTERWORD], "chapter_no int, title string")
    return books.crossJoin(F.broadcast(rows)).select(
        "book_id", (F.col("chapter_no") + late).cast("int").alias("chapter_no"),
        F.concat("title", F.lit(", volume "), F.col("book_id").cast("string")).alias("title"))


CHAPTER_FORMS = {
    "raw": lambda t: t,
    "para": lambda t: F.replace(t, F.lit("\n"), F.lit("\n\n")),
    "space": lambda t: F.translate(t, ".!?\n", "    "),
    "hard": lambda t: F.translate(t, " .!?\n", "_____"),
}


def chapter_docs(spark: SparkSession, sf_dir: str,
                 forms: tuple[str, ...] = ("raw", "para", "space", "hard")) -> DataFrame:
    """``chapter_docs(book_id, chapter_no, form, text)``: each document as a
    chapter, in up to four forms that drive the chunkers down each cut rule
    (raw; newline doubled = paragraph cut; marks blanked = space cut;
    blanks and marks replaced = hard cut)."""
    d = text_table(spark, sf_dir, "documents", ["doc_id", "text"])
    base = d.select(_book_of("doc_id").alias("book_id"),
                    ((F.col("doc_id") % PAGES_PER_BOOK) + 1).cast("int").alias("chapter_no"),
                    F.col("text"))
    variants = F.array(*[
        F.struct(F.lit(f).alias("form"), CHAPTER_FORMS[f](F.col("text")).alias("text"))
        for f in forms])
    return (base.select("book_id", "chapter_no", F.inline(variants))
            .select("book_id", "chapter_no", "form", "text"))


def zh_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``zh_docs(book_id, chapter_no, text)``: paragraph form with CJK letters
    and full-width marks substituted in."""
    d = text_table(spark, sf_dir, "documents", ["doc_id", "text"])
    para = F.replace(F.col("text"), F.lit("\n"), F.lit("\n\n"))
    return d.select(_book_of("doc_id").alias("book_id"),
                    ((F.col("doc_id") % PAGES_PER_BOOK) + 1).cast("int").alias("chapter_no"),
                    F.translate(para, "etaoin.,!?", "的一是不了人。，！？").alias("text"))


def raw_chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``chapter_docs`` restricted to the raw form."""
    return chapter_docs(spark, sf_dir, ("raw",)).drop("form")


HEADING_PAGE_OFFSET = 3     # headings before pages 3, 10, 17, ... (k = 1..7)
LAST_PAGE = PAGES_PER_BOOK - 1   # heading k = 8 before the last page
DROPPED_HEADING = 4         # its title contains HTTP, so it is filtered out


def marked_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``marked_pages(book_id, page_no, piece)``: the pages of :func:`marked_docs`."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    page_no = (F.col("doc_id") % PAGES_PER_BOOK).cast("int")
    book = _book_of("doc_id")
    k = (F.when(page_no % MARK_EVERY == HEADING_PAGE_OFFSET,
                F.floor((page_no - HEADING_PAGE_OFFSET) / F.lit(float(MARK_EVERY))) + 1)
         .when(page_no == LAST_PAGE, F.lit(8)).cast("int"))
    pages = d.select(book.alias("book_id"), page_no.alias("page_no"), k.alias("k"), "text")
    k, book, page_no = F.col("k"), F.col("book_id"), F.col("page_no")
    show = k.isNotNull() & ((book % 4) != 3) & (((book % 4) != 2) | (k <= DROPPED_HEADING))
    heading = F.concat(F.lit("\n"), k.cast("string"), F.lit(": THE "),
                       F.when(k == DROPPED_HEADING, F.lit("HTTP ")).otherwise(F.lit("")),
                       F.lit("CHAPTER ABOUT TOPIC "), F.expr("chr(65 + k)"), F.lit("\n"))
    body = F.col("text")
    pages = pages.select("book_id", "page_no",
                         F.concat(F.when(show, heading).otherwise(F.lit("")), body).alias("piece"))
    return pages


def marked_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``marked_docs(book_id, title, text)``: each book's pages joined in order
    with blank lines, chapter headings ``k: THE CHAPTER ABOUT TOPIC <letter>``
    in front of pages 3, 10, …, 45 and 49; heading 4 mentions HTTP (dropped);
    the last chapter body is short (< 500 chars, dropped); books with
    ``book_id % 4 == 2`` keep only headings 1–4 (3 kept → fallback) and books
    with ``book_id % 4 == 3`` have none."""
    return (marked_pages(spark, sf_dir).groupBy("book_id")
            .agg(F.expr("listagg(piece, '\\n\\n') WITHIN GROUP (ORDER BY page_no)").alias("text"))
            .select("book_id", F.concat(F.lit("Book "), F.col("book_id").cast("string")).alias("title"),
                    "text"))


def zh_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``zh_files(book_id, chapter_no, text)``: translated chapter files,
    ``"N. Title"`` line, blank line, then the text (TOC title or ``Chapter N``)."""
    z = zh_docs(spark, sf_dir)
    t = F.broadcast(toc(spark))
    return z.join(t, "chapter_no", "left").select(
        "book_id", "chapter_no",
        F.concat(F.format_string("%d. %s", F.col("chapter_no"),
                                 F.coalesce(F.col("title"), F.format_string("Chapter %d", F.col("chapter_no")))),
                 F.lit("\n\n"), F.col("text")).alias("text"))


def broken_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``broken_docs(book_id, chapter_no, text, original)``: hyphen breaks and
    paragraphs broken mid-sentence put into the raw chapters."""
    r = raw_chapters(spark, sf_dir)
    broken = F.replace(F.replace(F.col("text"), F.lit("tion "), F.lit("ti-\non ")),
                       F.lit(", "), F.lit(",\n\n"))
    return r.select("book_id", "chapter_no", broken.alias("text"), F.col("text").alias("original"))


def cut_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``cut_pages(book_id, page_no, text)``: the broken chapters of a book set
    on pages of ``PAGE_CHARS`` characters; a word cut in two gets a hyphen."""
    b = broken_docs(spark, sf_dir)
    pieces = b.select("book_id", "chapter_no", "text", F.explode(F.expr(
        f"sequence(0, cast(floor(length(text) / {PAGE_CHARS}) as int))")).alias("i"))
    piece = F.expr(f"substring(text, i * {PAGE_CHARS} + 1, {PAGE_CHARS})")
    after = F.expr(f"substring(text, (i + 1) * {PAGE_CHARS} + 1, 1)")
    cut = piece.rlike(r"\p{L}\z") & after.rlike(r"^\p{L}")
    return pieces.select("book_id", (F.col("chapter_no") * PAGES_APART + F.col("i")).cast("int").alias("page_no"),
                         F.concat(piece, F.when(cut, "-").otherwise("")).alias("text"))


# --- deterministic model stand-ins (failures are a function of the key) -----------

_ASCII_UP = str.maketrans(string.ascii_lowercase, string.ascii_uppercase)
TRANSLATE_SYSTEM = "You translate English prose into Simplified Chinese for a study edition."
TRANSLATE_INSTRUCTION = ("Translate the text below into Simplified Chinese. Keep every Markdown "
                         "symbol (# ## *) exactly where it is and translate all of the text.")


class KeyedModel:
    """Succeeds on attempt ``need`` where ``need = (a*chapter_no + b*part_no) % m + 1``;
    the answer is the input with ASCII letters upper-cased. Service time is
    ``len(input) * 100`` µs per attempt."""

    def __init__(self, a: int = 1, b: int = 1, m: int = 5, binary: bool = False):
        self.a, self.b, self.m, self.binary = a, b, m, binary

    def __call__(self, batch: pd.DataFrame, attempt: int) -> pd.DataFrame:
        part = batch["part_no"] if "part_no" in batch else 0
        need = (self.a * batch["chapter_no"] + self.b * part) % self.m + 1
        ok = (need <= attempt).to_numpy()
        text = batch["input"].astype(object)
        answer = list(text)
        if self.binary:
            answer = np.array([t.encode("utf-8") for t in answer], dtype=object)
        else:
            answer = np.array([t.translate(_ASCII_UP) for t in answer], dtype=object)
        return pd.DataFrame({
            "output": np.where(ok, answer, None),
            "error": np.where(ok, None, f"attempt {attempt} failed"),
            "service_us": text.str.len().to_numpy(dtype=np.int64) * 100,
        })


TRANSLATE_MODEL = KeyedModel(1, 1, 5)
CLEAN_MODEL = KeyedModel(3, 0, 5)
REDO_CHAPTER = 3
SPEECH_MODEL = KeyedModel(1, 2, 4, binary=True)


def chunk_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``chunk_requests``: boundary chunks of the raw chapters, ``input`` = chunk,
    with the chapter's title line carried along."""
    from quire.operators.chunk import chunk_boundary
    raw = raw_chapters(spark, sf_dir).withColumn("title", F.element_at(F.split("text", "\n", 2), 1))
    ch = chunk_boundary(raw, ["book_id", "chapter_no", "title"])
    return ch.withColumnRenamed("text", "input")


# --- request and answer turns -------------------------------------------------------

def numbered_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` with ``part_no``: the number of the request (user
    turn) that a turn is or follows, 0 before the first. A running count that
    keeps no conversation in one task."""
    from quire.operators.scan import keyed_scan
    t = table(spark, sf_dir, "conversations").where("conv_id is not null").select("conv_id", "turn", "role", "text")
    asked = F.when(F.col("role") == "user", 1).otherwise(0)
    return keyed_scan(t, "conv_id", ["turn", "role", "text"], sums={"part_no": asked}).select(
        "conv_id", "turn", "role", "text", F.col("part_no").cast("int").alias("part_no"))


def turn_requests(turns: DataFrame) -> DataFrame:
    """``turn_requests(conv_id, part_no, input)``: user turns."""
    return turns.where(F.col("role") == "user").select("conv_id", "part_no", F.col("text").alias("input"))


def turn_answers(turns: DataFrame) -> DataFrame:
    """``turn_answers(conv_id, part_no, turn, output)``: assistant turns."""
    return turns.where((F.col("role") == "assistant") & (F.col("part_no") > 0)).select(
        "conv_id", "part_no", "turn", F.col("text").alias("output"))


def as_chapter(conv_id: str = "conv_id") -> list:
    """Conversation n answers the chapter made from document n."""
    return [_book_of(conv_id).alias("book_id"), ((F.col(conv_id) % PAGES_PER_BOOK) + 1).cast("int").alias("chapter_no")]


def given_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``given_summaries(book_id, chapter_no, output)``: the first answer of each
    conversation, whole; most chapters have none."""
    t = table(spark, sf_dir, "conversations").where("role = 'assistant' and text is not null")
    first = t.groupBy("conv_id").agg(F.min(F.struct("turn", "text")).alias("x"))
    return first.select(*as_chapter(), F.col("x.text").alias("output"))


# --- rate tables from events -------------------------------------------------------

OPEN_LOOP_GAP_US = 3_600_000_000     # one request per hour per user
AUDIT_QPM = 5


def _epoch_us(ts):
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {ts})")


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``arrivals(user_id, event_id, ts, at_us)``: request arrival times (µs)."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "ts")
    return e.select("user_id", "event_id", "ts", _epoch_us("ts").alias("at_us"))


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``calls(user_id, event_id, ts, service_us)``: call durations (µs, >= 0)."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "value")
    return e.select("user_id", "event_id", "ts",
                    F.greatest(F.lit(0), F.floor(F.col("value") * 1_000_000).cast("bigint")).alias("service_us"))


# --- speech parts -------------------------------------------------------------------

def speech_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speech chunks (P8 + T4) of the translated chapters."""
    from quire.operators.chunk import pack_paragraphs, strip_markdown
    # An empty translation yields no paragraphs, hence no speech chunks (P20).
    z = zh_docs(spark, sf_dir).select("book_id", "chapter_no", strip_markdown(F.col("text")).alias("text"))
    return pack_paragraphs(z, ["book_id", "chapter_no"])


def audio_parts(spark: SparkSession, sf_dir: str, chunks: DataFrame | None = None) -> DataFrame:
    """``audio_parts(book_id, chapter_no, part_no, n_parts, content)``: the
    speech chunks as bytes, with some parts missing."""
    c = speech_chunks(spark, sf_dir) if chunks is None else chunks
    return (c.where(((F.col("chapter_no") * 7 + F.col("part_no")) % 11) != 0)
            .select("book_id", "chapter_no", "part_no", "n_parts",
                    F.encode("text", "UTF-8").alias("content")))


def done_parts(spark: SparkSession, sf_dir: str, chunks: DataFrame | None = None) -> DataFrame:
    """``done_parts``: the parts produced by an earlier run."""
    return audio_parts(spark, sf_dir, chunks).where(F.col("part_no") % 2 == 0)


def cat_translations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Translated chapter files for the catalogue: all of them."""
    return zh_files(spark, sf_dir)


def chapter_part_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each chapter's speech plan paired with its stored parts in one pass
    (``posexplode_outer`` keeps chapters whose parts are all missing):
    ``(book_id, chapter_no, n_parts, part_no, content)``."""
    return _part_rows(spark, sf_dir, lambda t: F.encode(t, "UTF-8"), "content")


def chapter_part_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the size of each part (``n_bytes``) in place of its content."""
    return _part_rows(spark, sf_dir, F.octet_length, "n_bytes")


def _part_rows(spark: SparkSession, sf_dir: str, value, name: str) -> DataFrame:
    from quire.operators.chunk import paragraph_pack, strip_markdown
    z = zh_docs(spark, sf_dir).select("book_id", "chapter_no", paragraph_pack(strip_markdown(F.col("text"))).alias("c"))
    kept = F.filter(F.transform("c", lambda t, i: F.struct((i + 1).alias("p"), value(t).alias("b"))),
                    lambda x: ((F.col("chapter_no") * 7 + x["p"]) % 11) != 0)
    rows = z.select("book_id", "chapter_no", F.size("c").alias("n_parts"), F.posexplode_outer(kept).alias("_i", "_x"))
    return rows.select("book_id", "chapter_no", "n_parts", F.col("_x.p").alias("part_no"), F.col("_x.b").alias(name))
