"""Query registry: name → callable(spark, sf_dir) → DataFrame.

Each query composes fixture views (``fixtures.py``) with library operators;
``oracle.py`` holds the matching DuckDB SQL under the same name.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.operators import blocks as BL
from quire.operators import catalog as CT
from quire.operators import chunk as CH
from quire.operators import lines as LN
from quire.operators import model as MD
from quire.operators import page_borders as PB
from quire.operators import pages as PG
from quire.operators import parts as PT
from quire.operators import project as PJ
from quire.operators import rate as RT
from quire.operators import segment as SG
from quire.operators import segment_blocks as SB
from quire.operators import sweep as SW
from quire.sources.tables import table
from quire.functions import constants as C
from quire.functions import text as T
from quire.plans import fixtures as FX
from quire.session import apply_runtime_conf, materialize, scratch_path
from quire.sinks import committed as CF
from quire.sinks import files as SK
from quire.sinks import stream as ST
from quire.sources import files as SF
from quire.sources import paged as SP
from quire.streaming.arrivals import run_arrivals
from quire.streaming.incremental import run_incremental

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_runtime_conf(spark)
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return run


# --- step 1: pages -> chapters ------------------------------------------------

def _ranges(spark, sf_dir, write: bool = True):
    """Chapter ranges (small: one row per chapter) are written once, so the
    page join and the outer join for empty chapters reuse them instead of
    scanning and aggregating the pages twice."""
    pages = FX.book_pages(spark, sf_dir)
    ranges = PG.chapter_ranges(PG.chapter_starts(pages, toc=FX.book_toc(spark, sf_dir)), PG.book_page_counts(pages))
    return (materialize(ranges) if write else ranges), pages


@query
def chapter_starts(spark, sf_dir):
    """P1 + P2 + A1: first qualifying page per chapter number."""
    return PG.chapter_starts(FX.book_pages(spark, sf_dir), toc=FX.book_toc(spark, sf_dir))


@query
def chapter_ranges(spark, sf_dir):
    """Page range of each chapter."""
    return _ranges(spark, sf_dir, write=False)[0]


@query
def chapter_pages(spark, sf_dir):
    """Pages assigned to chapters by range join."""
    ranges, pages = _ranges(spark, sf_dir)
    return PG.assign_pages(pages, ranges).select(
        "book_id", "chapter_no", "page_no", F.length("text").alias("n_chars"))


@query
def chapter_pages_sweep(spark, sf_dir):
    """J1 as a sweep: equal to ``chapter_pages``, without comparing every page
    of a book with every chapter of it."""
    ranges, pages = _ranges(spark, sf_dir)
    pages = PG.non_empty_pages(pages).select("book_id", "page_no", F.length("text").alias("n_chars"))
    found = SW.sweep_join(pages, ranges, "book_id", "page_no", "start_page", "end_page", "chapter_no")
    return found.select("book_id", F.col("chapter_no").cast(ranges.schema["chapter_no"].dataType).alias("chapter_no"),
                        "page_no", "n_chars")


@query
def chapter_text(spark, sf_dir):
    """J1 + A2 + A4 + J2: chapter file text and sizes."""
    ranges, pages = _ranges(spark, sf_dir)
    return PG.chapter_texts(pages, ranges, FX.book_toc(spark, sf_dir))


# --- step 3/4: chunkers -----------------------------------------------------------

@query
def chunk_fixed(spark, sf_dir):
    """3000-char windows, cut before a late blank line; lossless."""
    return CH.chunk_fixed(FX.chapter_docs(spark, sf_dir), ["book_id", "chapter_no", "form"])


@query
def chunk_boundary(spark, sf_dir):
    """Paragraph > sentence > space > hard cut, stripped chunks."""
    return CH.chunk_boundary(FX.chapter_docs(spark, sf_dir), ["book_id", "chapter_no", "form"])


@query
def chunk_distributed(spark, sf_dir):
    """T3 over page rows: the chunks of each book's joined text, which is
    never in one row."""
    return BL.chunk_boundary(FX.book_pages(spark, sf_dir), ["book_id"], ["page_no"], block=FX.CHUNK_BLOCK)


@query
def pack_paragraphs(spark, sf_dir):
    """T4: paragraphs packed greedily up to 4000 chars."""
    return CH.pack_paragraphs(FX.chapter_docs(spark, sf_dir, ("para",)), ["book_id", "chapter_no"])


@query
def pack_sentences(spark, sf_dir):
    """T4 + T5 at 400 chars: oversize paragraphs fall back to sentences."""
    return CH.pack_paragraphs(FX.chapter_docs(spark, sf_dir, ("para",)), ["book_id", "chapter_no"],
                              max_size=400)


@query
def part_names(spark, sf_dir):
    """P8 + T4 + P13: speech chunks of translated chapters and their file names."""
    docs = FX.zh_docs(spark, sf_dir).select("book_id", "chapter_no",
                                           CH.strip_markdown(F.col("text")).alias("text"))
    parts = CH.pack_paragraphs(docs, ["book_id", "chapter_no"])
    return parts.select(
        "book_id", "chapter_no", "part_no", "n_parts", F.length("text").alias("n_chars"),
        CH.part_file_name(F.col("chapter_no"), F.col("part_no"), F.col("n_parts")).alias("file_name"),
        CH.part_file_name(F.col("chapter_no"), F.col("part_no"), F.col("n_parts"),
                          always_numbered=True).alias("file_name_numbered"))


# --- step 2: projections and filters ------------------------------------------

@query
def title_body_split(spark, sf_dir):
    """Title line and body of each chapter."""
    d = FX.raw_chapters(spark, sf_dir)
    title, body = PJ.title_and_body(F.col("text"))
    return d.select("book_id", "chapter_no", title.alias("title"), body.alias("body"))


@query
def strip_markdown(spark, sf_dir):
    """Markdown symbols removed before speech, with sizes."""
    d = FX.raw_chapters(spark, sf_dir)
    clean = CH.strip_markdown(F.col("text"))
    return d.select("book_id", "chapter_no", F.length("text").alias("n_before"),
                    F.length(clean).alias("n_after"), clean.alias("text"))


@query
def head_truncate(spark, sf_dir):
    """The four head cuts (summary input, speech input, export, old prompt)."""
    d = FX.raw_chapters(spark, sf_dir)
    t = F.col("text")
    return d.select("book_id", "chapter_no",
                    PJ.head(t, C.SUMMARY_INPUT_CHARS).alias("summary_input"),
                    PJ.head(t, C.SPEECH_INPUT_CHARS).alias("speech_input"),
                    PJ.head(t, C.EXPORT_PREVIEW_CHARS, ellipsis=True).alias("export_original"),
                    PJ.head(t, C.TRANSLATE_CHUNK_SIZE, ellipsis=True).alias("prompt_head"))


@query
def file_names(spark, sf_dir):
    """Zero-padded artefact names, also past 99 (running number)."""
    d = FX.raw_chapters(spark, sf_dir)
    seq = (F.col("book_id") * FX.PAGES_PER_BOOK + F.col("chapter_no")).alias("seq_no")
    names = PJ.chapter_file_names(F.col("seq_no"))
    return d.select("book_id", "chapter_no", seq).select(
        "book_id", "chapter_no", "seq_no", *[c.alias(k) for k, c in names.items()],
        T.zero_pad(F.col("chapter_no")).alias("chapter_tag"))


@query
def path_rewrite(spark, sf_dir):
    """Literal path rewrite across every web page."""
    p = table(spark, sf_dir, "pages").select("page_id", "html")
    new = PJ.rewrite_literals(F.col("html"), FX.PAGE_REWRITES)
    return p.select("page_id", new.alias("html"),
                    (F.length(new) - F.length("html")).alias("grown_by"))


@query
def first_n_chapters(spark, sf_dir):
    """The first N chapters of each book in file-name order (test mode N=2)."""
    d = FX.raw_chapters(spark, sf_dir).select(
        "book_id", "chapter_no", F.length("text").alias("n_chars"),
        PJ.chapter_file_names(F.col("chapter_no"))["chapter_file"].alias("chapter_file"))
    return PJ.first_n_per_group(d, ["book_id"], ["chapter_file", "chapter_no"], FX.FIRST_N)


@query
def chapter_range_filter(spark, sf_dir):
    """Chapters start..end of every book."""
    d = FX.raw_chapters(spark, sf_dir).select("book_id", "chapter_no", F.length("text").alias("n_chars"))
    return PJ.chapter_range(d, FX.RANGE_START, FX.RANGE_END)


# --- step 5: regex segmentation --------------------------------------------------

@query
def segment_regex(spark, sf_dir):
    """T1 + P3–P5 + A8 + W2: chapters cut out of each book's whole text."""
    docs = FX.marked_docs(spark, sf_dir)
    ch = SG.split_into_chapters(docs, ["book_id"])
    return ch.select("book_id", "pattern_no", "chapter_no", "title",
                     F.length("text").alias("n_chars"), "text")


@query
def segment_fallback(spark, sf_dir):
    """A8 audit: kept matches per pattern, the winning pattern (0 = one
    fallback chapter) and the number of chapters kept after P4."""
    docs = FX.marked_docs(spark, sf_dir)
    rep = SG.pattern_report(docs, ["book_id", "text", "title"])
    # The counts come once, out of a generator: the segmentation reads them.
    names = [f"kept_{i}" for i in range(1, 6)]
    rep = T.with_once(rep.select("book_id", "title", "text", F.array(*names).alias("_k")), _n=F.col("_k"))
    seg = T.with_once(rep, _s=SG.segment(F.col("text"), F.col("title"), counts=[F.get("_n", F.lit(i)) for i in range(5)]))
    kept = F.filter("_s.chapters", lambda c: (F.col("_s.pattern_no") == 0)
                    | (F.length(c["text"]) >= C.SEGMENT_MIN_BODY))
    return seg.select("book_id", *[F.get("_n", F.lit(i)).alias(name) for i, name in enumerate(names)],
                      F.col("_s.pattern_no").alias("pattern_no"), F.size(kept).alias("n_chapters"))


@query
def segment_pages(spark, sf_dir):
    """T1 over page rows: the chapters of each book's joined text, in pieces;
    no book is ever in one row."""
    return SB.split_into_chapters(FX.marked_pages(spark, sf_dir), ["book_id"], ["page_no"], text_col="piece",
                                  title=F.concat(F.lit("Book "), F.col("book_id").cast("string")),
                                  block=FX.CHUNK_BLOCK, piece=FX.PIECE)


# --- step 6: lines and blocks ------------------------------------------------------

@query
def line_format(spark, sf_dir):
    """T6 + W4: Markdown formatting of translated chapter files."""
    d = FX.zh_files(spark, sf_dir)
    out = LN.format_markdown(F.col("text"))
    return d.select("book_id", "chapter_no", F.length(out).alias("n_chars"), out.alias("text"))


@query
def markdown_blocks(spark, sf_dir):
    """HTML blocks of the formatted chapters (heading / list / paragraph)."""
    d = FX.zh_files(spark, sf_dir)
    blocks = LN.markdown_blocks(LN.format_markdown(F.col("text")))
    return d.select("book_id", "chapter_no", F.posexplode(blocks).alias("i", "b")).select(
        "book_id", "chapter_no", (F.col("i") + 1).alias("block_no"),
        F.col("b.kind").alias("kind"), F.col("b.html").alias("html"))


@query
def repair_breaks(spark, sf_dir):
    """T9 + A9: artefact repair with a before/after size audit."""
    d = FX.broken_docs(spark, sf_dir)
    fixed = LN.repair_breaks(F.col("text"))
    return d.select("book_id", "chapter_no", fixed.alias("fixed"), "text", "original").select(
        "book_id", "chapter_no", F.length("text").alias("n_before"), F.length("fixed").alias("n_after"),
        LN.size_ratio(F.length("fixed"), F.length("text")).alias("ratio"),
        (F.col("fixed") == F.col("original")).alias("restored"), F.col("fixed").alias("text"))


@query
def repair_pages(spark, sf_dir):
    """T9 over page borders: words and sentences joined across the pages of
    each book; the repaired pages and what stands before each."""
    fixed = PB.repair_pages(FX.cut_pages(spark, sf_dir))
    return fixed.select("book_id", "page_no", "glue", F.length("text").alias("n_chars"), F.md5("text").alias("md5"))


@query
def content_preserved(spark, sf_dir):
    """Only Markdown symbols / whitespace added by formatting; the repair
    step is checked too (it removes hyphens, so it may fail the rule)."""
    z = FX.zh_files(spark, sf_dir)
    fmt = z.select("book_id", "chapter_no",
                   LN.content_preserved(F.col("text"), LN.format_markdown(F.col("text"))).alias("format_ok"),
                   F.length(LN.content_key(F.col("text"))).alias("n_content"))
    b = FX.broken_docs(spark, sf_dir)
    rep = b.select("book_id", "chapter_no",
                   LN.content_preserved(F.col("text"), LN.repair_breaks(F.col("text"))).alias("repair_ok"))
    return fmt.join(rep, ["book_id", "chapter_no"])


# --- step 7: model step -----------------------------------------------------------

_CK = ["book_id", "chapter_no", "part_no"]
_SK = ["book_id", "chapter_no"]


def _translated(spark, sf_dir):
    # Model answers are written once: a lost executor or a second branch then
    # reads the same responses instead of calling the model again.
    req = FX.chunk_requests(spark, sf_dir)
    return materialize(MD.call_model(req, FX.TRANSLATE_MODEL, _CK, on_failure="sentinel", carry=["title"]))


@query
def prompts(spark, sf_dir):
    """P14 + W5: one request per chunk with ``part i of n``."""
    req = FX.chunk_requests(spark, sf_dir)
    r = MD.build_request(F.col("input"), F.col("part_no"), F.col("n_parts"),
                         FX.TRANSLATE_SYSTEM, FX.TRANSLATE_INSTRUCTION)
    return req.select(*_CK, "n_parts", r.alias("r")).select(
        *_CK, "n_parts", "r.system", "r.user", "r.temperature", "r.max_tokens")


def _pairs(spark, sf_dir, **kw):
    turns = materialize(FX.numbered_turns(spark, sf_dir))
    return MD.pair_responses(FX.turn_requests(turns), FX.turn_answers(turns), ["conv_id"], ["turn"], **kw)


@query
def turn_pairs(spark, sf_dir):
    """Every request turn with its answer; a sentinel where none came."""
    return _pairs(spark, sf_dir)


@query
def reassemble(spark, sf_dir):
    """J6 + A2 + A5 + K2: the answers of each conversation in order (a lost one
    keeps its sentinel, ``n_parts`` counts requests) and the file text."""
    ch = MD.reassemble(_pairs(spark, sf_dir), ["conv_id"])
    return ch.select(
        "conv_id", "n_parts", "n_ok", "n_failed", F.col("text").alias("translation"),
        F.concat(F.format_string("Conversation %d", F.col("conv_id")), F.lit("\n\n"), F.col("text")).alias("file_text"))


@query
def summaries(spark, sf_dir):
    """M2 + P9 + P21 + K3: one summary request for each chapter (its translation,
    else the original), paired with the given answers; a request without an
    answer has an empty summary, which is not written."""
    tr = MD.reassemble(_pairs(spark, sf_dir, on_failure="empty"), ["conv_id"]).select(*FX.as_chapter(), "text")
    orig = FX.raw_chapters(spark, sf_dir).select(*_SK, F.col("text").alias("original"))
    req = orig.join(tr, _SK, "left").select(
        *_SK, F.lit(1).alias("part_no"), MD.summary_input(F.col("text"), F.col("original")).alias("input"),
        (F.coalesce("text", F.lit("")) != "").alias("from_translation"))
    res = MD.pair_responses(req, FX.given_summaries(spark, sf_dir).withColumn("part_no", F.lit(1)), _SK, [],
                            on_failure="empty")
    out = res.join(req.select(*_SK, "from_translation"), _SK).select(
        *_SK, "status", "from_translation", F.length("input").alias("n_input"), T.py_strip("output").alias("text"))
    return out.where(F.col("text") != "")


@query
def clean_passthrough(spark, sf_dir):
    """M3 + A9: whole-chapter cleaning; a failed call keeps the input unchanged."""
    b = FX.broken_docs(spark, sf_dir).select("book_id", "chapter_no", F.col("text").alias("input"))
    res = MD.call_model(b, FX.CLEAN_MODEL, ["book_id", "chapter_no"], on_failure="passthrough")
    return res.join(b, ["book_id", "chapter_no"]).select(
        "book_id", "chapter_no", "status", "attempts",
        (F.col("output") == F.col("input")).alias("unchanged"),
        F.length("input").alias("n_before"), F.length("output").alias("n_after"),
        F.col("output").alias("text"))


@query
def redo_chapter(spark, sf_dir):
    """M9 + S4 + K2: answers stored in a table partitioned by chapter; one
    chapter is read alone (a pruned scan), answered again under another policy
    (a lost answer leaves the request) and replaces its own partition only."""
    turns = materialize(FX.numbered_turns(spark, sf_dir))
    path = _scratch(spark, "redo")
    answers = FX.turn_answers(turns)
    pairs = MD.pair_responses(FX.turn_requests(turns), answers, ["conv_id"], ["turn"]).select("*", *FX.as_chapter())
    SK.write_parquet(pairs.repartition("chapter_no"), path, ["chapter_no"])
    stored = SF.lookup_chapter(spark.read.parquet(path), FX.REDO_CHAPTER)
    again = MD.pair_responses(stored, answers, ["conv_id"], ["turn"], on_failure="passthrough").select("*", *FX.as_chapter())
    # The new rows are written down before they replace what they were read from.
    SK.replace_partition(materialize(again), path, ["chapter_no"])
    back = MD.reassemble(spark.read.parquet(path), ["conv_id", "chapter_no"])
    return back.select("conv_id", "chapter_no", "n_parts", "n_ok", "n_failed", F.length("text").alias("n_chars"), "text")


# --- step 8: rate schedule and audit -------------------------------------------------

_ORDER = ["ts", "event_id"]


@query
def rate_audit(spark, sf_dir):
    """R2 + R3 + W6 + W7: violations in the given arrivals and in the open-loop
    schedule of them (which must have none), and its delays, per user."""
    sched = RT.open_loop_schedule(FX.arrivals(spark, sf_dir), "user_id", "at_us", _ORDER, FX.OPEN_LOOP_GAP_US)
    # Both times in one pass of the audit.
    a = RT.audit_all(sched, "user_id", ["i"], ["at_us", "send_us"], FX.OPEN_LOOP_GAP_US, FX.AUDIT_QPM)
    delay = F.col("send_us") - F.col("at_us")
    return a.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_requests"),
        F.count_if("at_us_gap_violation").alias("raw_gap_violations"),
        F.count_if("at_us_window_violation").alias("raw_window_violations"),
        F.count_if("send_us_gap_violation").alias("sched_gap_violations"),
        F.count_if("send_us_window_violation").alias("sched_window_violations"),
        F.count_if(delay > 0).alias("n_delayed"),
        F.max(delay).alias("max_delay_us"),
        F.min("at_us_gap_us").alias("least_gap_us"),
        F.min("at_us_span_us").alias("least_span_us"))


# --- step 9: speech parts: skip, generate, merge --------------------------------------

@query
def skip_existing(spark, sf_dir):
    """J5 + M4 + U1: generate only parts not produced yet; existing parts
    count as done; failed generations stay as rows with status."""
    expected = FX.speech_chunks(spark, sf_dir)
    done = FX.done_parts(spark, sf_dir, expected)
    todo = MD.non_empty(PT.missing_parts(expected, done, _CK), "text").withColumnRenamed("text", "input")
    gen = MD.call_model(todo, FX.SPEECH_MODEL, _CK, on_failure="null", binary=True)
    old = done.select(*_CK, F.lit("existing").alias("source"), F.octet_length("content").alias("n_bytes"))
    new = gen.select(*_CK, F.col("status").alias("source"), F.octet_length("output").alias("n_bytes"))
    return old.unionByName(new)


def _merge_table(spark, sf_dir):
    # Plan and stored parts come from the same chapter row here, so they are
    # paired without a join; ``PT.gated_merge`` is the form for separate tables.
    rows = FX.chapter_part_rows(spark, sf_dir)
    # M5 + P13/P18: merge only complete chapters of more than one part.
    return PT.gate_rows(rows, _SK, min_parts=2)


def _merge_sizes(spark, sf_dir):
    # Flags and sizes only: no content in the shuffle.
    return PT.gate_sizes(FX.chapter_part_sizes(spark, sf_dir), _SK, min_parts=2)


@query
def merge_complete(spark, sf_dir):
    """J7 + A3 + M5: merge a chapter's parts only when all of them exist."""
    m = _merge_table(spark, sf_dir)
    return m.select(*_SK, "n_parts", "n_present", "complete",
                    F.col("content").isNotNull().alias("merged"),
                    F.octet_length("content").alias("merged_bytes"),
                    F.md5("content").alias("merged_md5"),
                    F.when(F.col("content").isNotNull(),
                           F.format_string("chapter_%02d_full.mp3", F.col("chapter_no"))).alias("full_file"))


@query
def merge_size(spark, sf_dir):
    """Merged size in MB and the 192 kbps duration estimate."""
    m = _merge_sizes(spark, sf_dir).where(F.col("n_bytes").isNotNull())
    mb, minutes = PT.size_estimate(F.col("n_bytes"))
    return m.select(*_SK, F.col("n_bytes").cast("int").alias("n_bytes"), mb.alias("mb"), minutes.alias("minutes"))


@query
def run_summary(spark, sf_dir):
    """A5 + M5: per book: parts expected / present, complete and merged chapters."""
    m = _merge_sizes(spark, sf_dir)
    return m.groupBy("book_id").agg(
        F.count("*").alias("n_chapters"),
        F.sum("n_parts").alias("n_parts"),
        F.sum("n_present").alias("n_present"),
        F.count_if("complete").alias("n_complete"),
        F.count_if(F.col("n_bytes").isNotNull()).alias("n_merged"),
        F.coalesce(F.sum("n_bytes"), F.lit(0)).cast("bigint").alias("merged_bytes"),
        F.bool_and("complete").alias("all_ok"))


# --- step 10: catalogue, export, pages ----------------------------------------------------

def _catalog_inputs(spark, sf_dir):
    tr = FX.cat_translations(spark, sf_dir)
    summ = (FX.given_summaries(spark, sf_dir).select(*_SK, T.py_strip("output").alias("text"))
            .where(F.col("text") != ""))
    merged = _merge_sizes(spark, sf_dir).where(F.col("n_bytes").isNotNull()).select(*_SK)
    return tr, summ, merged


def _catalogue(spark, sf_dir):
    tr, summ, merged = _catalog_inputs(spark, sf_dir)
    return CT.catalogue(spark, tr, summ, merged, FX.toc(spark))


@query
def cjk_count(spark, sf_dir):
    """CJK ideographs per translated chapter file."""
    tr = FX.cat_translations(spark, sf_dir)
    return tr.select(*_SK, T.cjk_count(F.col("text")).alias("wordCount"), F.length("text").alias("n_chars"))


@query
def catalogue(spark, sf_dir):
    """J3 + J4 + P10 + P11 + P18: catalogue rows of chapters 1..20."""
    return _catalogue(spark, sf_dir)


@query
def catalogue_json(spark, sf_dir):
    """K4 + A11: one JSON array per book."""
    return CT.catalogue_json(_catalogue(spark, sf_dir))


def _export_chapters(spark, sf_dir):
    tr, summ, merged = _catalog_inputs(spark, sf_dir)
    # Only the preview travels to the join.
    orig = FX.raw_chapters(spark, sf_dir).select(*_SK, F.substring("text", 1, C.EXPORT_PREVIEW_CHARS).alias("original"))
    return (tr.join(orig, _SK)
          .join(summ.withColumnRenamed("text", "summary"), _SK, "left")
          .join(merged.withColumn("_m", F.lit(True)), _SK, "left")
          .join(FX.toc(spark), "chapter_no", "left")
          .select("book_id", F.col("chapter_no").alias("number"),
                  F.coalesce("title", F.format_string("Chapter %d", F.col("chapter_no"))).alias("title"),
                  "original", F.col("text").alias("translation"),
                  F.coalesce("summary", F.lit("")).alias("summary"),
                  F.when(F.col("_m"), F.format_string("audio/chapter_%02d_full.mp3", F.col("chapter_no")))
                  .otherwise(F.lit("")).alias("audio")))


@query
def book_export(spark, sf_dir):
    """K5: nested per-book export (original cut to 500 + '...')."""
    return CT.book_export(_export_chapters(spark, sf_dir), F.format_string("Book %d", F.col("book_id")))


@query
def book_stream(spark, sf_dir):
    """K5 for books larger than a cell: one JSON file a book, written by many
    tasks at the offsets of its chapters and read back line by line (the head,
    then one line for each chapter)."""
    base = _scratch(spark, "book-stream")
    files = CT.write_book_export(_export_chapters(spark, sf_dir), F.format_string("Book %d", F.col("book_id")), base)
    lines = CT.read_book_export(spark, base, files.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0])
    size = files.select(F.regexp_extract("name", r"(\d+)\.json$", 1).cast("bigint").alias("book_id"),
                        F.col("n_rows").cast("int").alias("total_chapters"))
    return lines.join(size, "book_id")


@query
def chapter_page(spark, sf_dir):
    """T7 + T8 + K6: the HTML page of every catalogued chapter."""
    tr, summ, merged = _catalog_inputs(spark, sf_dir)
    page = (tr.join(summ.withColumnRenamed("text", "summary"), _SK, "left")
            .join(merged.withColumn("_m", F.lit(True)), _SK, "left")
            .join(FX.toc(spark), "chapter_no", "left"))
    html = CT.chapter_page(F.col("chapter_no"), F.coalesce("title", F.lit("")), F.col("summary"),
                           F.coalesce("_m", F.lit(False)), LN.format_markdown(F.col("text")))
    return page.select(*_SK, F.format_string("chapter_%02d.html", F.col("chapter_no")).alias("file"),
                       html.alias("html"))


@query
def book_cards(spark, sf_dir):
    """P22 + P16 + P17: the card view over the catalogue with the book's
    status badge (completed when no chapter of the book is missing)."""
    sizes = FX.raw_chapters(spark, sf_dir).groupBy("book_id").agg(F.count("*").alias("_size"))
    cat = _catalogue(spark, sf_dir).join(sizes, "book_id")
    n = F.count("*").over(Window.partitionBy("book_id"))
    status = F.when(n == F.col("_size"), F.lit(C.STATUS_COMPLETED)).otherwise(F.lit("in progress"))
    return cat.withColumn("status", status).select(
        "book_id", "number",
        F.format_string("chapters/chapter_%02d.html", F.col("number")).alias("href"),
        F.format_string("Chapter %d · %s", F.col("number"), F.col("title")).alias("heading"),
        "summary", "hasAudio",
        CT.card_count_text(F.col("wordCount")).alias("count_text"),
        CT.book_status_class(F.col("status")).alias("status_class"))


# --- step 11: files in and out, incremental runs ------------------------------------------

def _scratch(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


@query
def text_file_roundtrip(spark, sf_dir):
    """K1 + S2 + S3: chapter files written one per partition directory and
    read back whole, keys parsed from the path."""
    ranges, pages = _ranges(spark, sf_dir)
    ch = PG.chapter_texts(pages, ranges, FX.book_toc(spark, sf_dir))
    path = _scratch(spark, "chapter-files")
    SK.write_text_files(ch.withColumn("chapter", SK.chapter_dir(F.col("chapter_no"))), path,
                        "file_text", ["book_id", "chapter"])
    back = SF.read_text_files(spark, path)
    return back.select(F.col("book_id").cast("bigint").alias("book_id"),
                       SF.key_from_name(F.col("file_path")).alias("chapter_no"),
                       F.length("value").alias("n_chars"), F.col("value").alias("file_text"))


@query
def summary_files(spark, sf_dir):
    """K3 + K7: a summary file for each chapter that has a summary, none for
    the others; read back with the name of its formatted twin."""
    given = FX.given_summaries(spark, sf_dir).select(*_SK, T.py_strip("output").alias("text"))
    every = FX.raw_chapters(spark, sf_dir).select(*_SK).join(given, _SK, "left").select(
        "book_id", SK.chapter_dir(F.col("chapter_no")).alias("chapter"), F.coalesce("text", F.lit("")).alias("text"))
    path = _scratch(spark, "summaries")
    SK.write_non_empty(every, path, "text", ["book_id", "chapter"])
    back = SF.read_text_files(spark, path)
    return back.select(F.col("book_id").cast("bigint").alias("book_id"), SF.key_from_name(F.col("file_path")).alias("chapter_no"),
                       F.col("value").alias("text"),
                       SK.formatted_name(F.concat("chapter", F.lit("_summary.md"))).alias("formatted_file"))


@query
def json_roundtrip(spark, sf_dir):
    """K4 + S5: per-book catalogue JSON arrays written as files and read back."""
    cj = CT.catalogue_json(_catalogue(spark, sf_dir))
    path = _scratch(spark, "catalogue-json")
    SK.write_text_files(cj, path, "json", ["book_id"])
    schema = ("number INT, title STRING, summary STRING, hasAudio BOOLEAN, "
              "wordCount INT, file STRING")
    back = SF.read_json_arrays(spark, path, schema)
    return back.select(F.col("book_id").cast("bigint").alias("book_id"), *CT.CATALOGUE_FIELDS)


@query
def incremental_run(spark, sf_dir):
    """X1 + J5 + U1: parts arrive in two batches; a stream appends only the
    ones missing from the output (which already holds an earlier run)."""
    chunks = materialize(FX.speech_chunks(spark, sf_dir))
    parts = FX.audio_parts(spark, sf_dir, chunks).select(*_CK, F.octet_length("content").alias("n_bytes"))
    base = _scratch(spark, "incremental")
    inp, out, ck = f"{base}/in", f"{base}/out", f"{base}/checkpoint"
    SK.write_parquet(parts.where(F.col("part_no") % 2 == 0), out)
    SK.write_parquet(parts.where(F.col("part_no") % 2 == 1), inp, mode="append")
    SK.write_parquet(parts.where(F.col("part_no") % 2 == 0), inp, mode="append")
    run_incremental(spark, inp, parts.schema, out, ck, _CK)
    return spark.read.parquet(out)


@query
def incremental_arrivals(spark, sf_dir):
    """X1 with state: three arrivals, the second with parts of the first again
    (other bytes), the third with late ones; each part counts once, as it
    first came, and no output is read back."""
    # Only keys and sizes arrive, so only they are written.
    parts = materialize(FX.speech_chunks(spark, sf_dir).select(*_CK, F.octet_length("text").alias("n_bytes")))
    base = _scratch(spark, "arrivals")
    late = (F.col("chapter_no") * 7 + F.col("part_no")) % 11 == 0
    even = F.col("part_no") % 2 == 0
    again = parts.where(even & ~late).withColumn("n_bytes", -F.col("n_bytes"))
    for batch in (parts.where(even & ~late), parts.where(~even & ~late).unionByName(again), parts.where(late)):
        SK.write_parquet(batch, f"{base}/in", mode="append")
        run_arrivals(spark, f"{base}/in", parts.schema, f"{base}/out", f"{base}/checkpoint", _CK)
    return spark.read.parquet(f"{base}/out")


@query
def binary_committed(spark, sf_dir):
    """K8 + K1: merged audio written under task-attempt names, then renamed
    from the manifest; read back from the visible files."""
    m = _merge_table(spark, sf_dir).where(F.col("content").isNotNull())
    base = _scratch(spark, "committed")
    files = m.select(F.concat(F.lit("book_id="), F.col("book_id").cast("string")).alias("dir"),
                     F.format_string("chapter_%02d_full.mp3", F.col("chapter_no")).alias("name"), "content")
    CF.write_files(files, base)
    back = SF.read_binary_parts(spark, base, "*_full.mp3")
    return back.select(F.col("book_id").cast("bigint").alias("book_id"), "chapter_no", F.col("length").alias("n_bytes"),
                       F.md5("content").alias("md5"))


@query
def paged_files(spark, sf_dir):
    """S1 + S2: each book's pages in one long file with form feeds between
    them, read by byte ranges (several for each file); empty pages skipped."""
    base = _scratch(spark, "paged")
    pages = FX.book_pages(spark, sf_dir)
    ST.stream_files(pages, "book_id", "page_no", F.replace("text", F.lit("\f"), F.lit(" ")),
                    F.format_string("book_%d.txt", F.col("book_id")), base, between="\f")
    back = SP.read_pages(spark, base, split=FX.PAGED_SPLIT).where("text <> ''")
    return back.select(F.regexp_extract("file", r"book_(\d+)\.txt$", 1).cast("bigint").alias("book_id"),
                       F.col("page_no").cast("int").alias("page_no"), F.length("text").alias("n_chars"),
                       F.md5("text").alias("md5"))


# --- additions: line table, cleaning audit, binary files ----------------------------------

@query
def line_neighbours(spark, sf_dir):
    """W4 as a line table: one row per line with ``lag``/``lead`` blank flags."""
    t = LN.line_table(FX.zh_files(spark, sf_dir), ["book_id", "chapter_no"])
    return t.select("book_id", "chapter_no", "line_no", F.length("line").alias("n_chars"),
                    "prev_blank", "next_blank")


@query
def clean_audit(spark, sf_dir):
    """A9 grouped: per book, sizes before/after the repair and how many
    chapters came back to the original text."""
    d = FX.broken_docs(spark, sf_dir)
    fixed = LN.repair_breaks(F.col("text"))
    per = d.select("book_id", F.length("text").alias("b"), F.length(fixed).alias("a"),
                   (fixed == F.col("original")).alias("ok"))
    ratio = LN.size_ratio(F.col("a"), F.col("b"))
    return per.groupBy("book_id").agg(
        F.sum("b").alias("chars_before"), F.sum("a").alias("chars_after"),
        F.min(ratio).alias("min_ratio"), F.max(ratio).alias("max_ratio"),
        F.count_if("ok").alias("n_restored"), F.count("*").alias("n_chapters"))


@query
def binary_roundtrip(spark, sf_dir):
    """K8 + S6 + S3 + S9: merged audio written as one file per chapter by the
    executors, read back with the binary-file source, keys parsed from names."""
    m = _merge_table(spark, sf_dir).where(F.col("content").isNotNull())
    base = _scratch(spark, "audio")
    files = m.select(F.concat(F.lit("book_id="), F.col("book_id").cast("string")).alias("dir"),
                     F.format_string("chapter_%02d_full.mp3", F.col("chapter_no")).alias("name"), "content")
    SK.write_binary_files(files, base, "dir", "name", "content")
    back = SF.read_binary_parts(spark, base, "*_full.mp3")
    first = back.groupBy("book_id").agg(SF.first_path(back, "path").alias("first_file"))
    return back.join(first, "book_id").select(
        F.col("book_id").cast("bigint").alias("book_id"), "chapter_no",
        F.col("length").alias("n_bytes"), F.md5("content").alias("md5"),
        F.regexp_extract("first_file", r"([^/]+)$", 1).alias("first_file"))
