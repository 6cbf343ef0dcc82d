"""Line- and block-level text operators.

A chapter's lines all live in its row, so neighbour access (``lines[i-1]``,
``lines[i+1]``) is array indexing inside ``transform``: the same answer as a
``lag``/``lead`` window over a line table, without exploding the text and
shuffling it back together. :func:`line_table` gives the exploded form for
callers that want one row per line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import constants as C
from quire.functions import text as T
from quire.operators.segment import portable_pattern

_TITLE_RE = "(?d)" + portable_pattern(C.TITLE_LINE_PATTERN)
_NUMBER_RE = "(?d)" + portable_pattern(C.NUMBER_LINE_PATTERN)


def _blank(line: Column) -> Column:
    return F.coalesce(T.py_strip(line) == "", F.lit(True))


def classify_line(line: Column, i: Column, lines: Column) -> Column:
    """Markdown for line ``i`` (0-based) of ``lines``; first rule wins."""
    s = T.py_strip(line)
    n = F.size(lines)
    prev_blank = (i == 0) | _blank(F.get(lines, i - 1))
    next_blank = (i == n - 1) | _blank(F.get(lines, i + 1))
    ls = F.length(s)
    return (F.when(s == "", line)
            .when((i == 0) & s.rlike(_TITLE_RE), F.concat(F.lit("# "), s))
            .when((i < 3) & s.rlike(_NUMBER_RE), line)
            .when((i < C.EARLY_HEADING_MAX_LINE) & (ls < C.EARLY_HEADING_MAX_LEN)
                  & ~T.ends_with_any(s, C.EARLY_HEADING_BAD_ENDINGS), F.concat(F.lit("## "), s))
            .when((i < C.TAGLINE_MAX_LINE) & (ls < C.TAGLINE_MAX_LEN)
                  & (T.ends_with_any(s, C.TAGLINE_ENDINGS) | s.contains(C.TAGLINE_CONTAINS)),
                  F.concat(F.lit("*"), s, F.lit("*\n")))
            .when((ls < C.SECTION_MAX_LEN) & ~T.ends_with_any(s, C.SECTION_BAD_ENDINGS)
                  & (i > C.SECTION_MIN_LINE) & (prev_blank | next_blank),
                  F.concat(F.lit("\n## "), s, F.lit("\n")))
            .otherwise(line))


def format_markdown(text: Column) -> Column:
    """T6 over a whole text: classify every line, rejoin with ``\\n``."""
    return T.let(F.split(text, "\n", -1), lambda lines: F.array_join(
        F.transform(lines, lambda l, i: classify_line(l, i, lines)), "\n"))


def line_table(df: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """One row per line with W4 neighbour flags.

    The flags are taken from the line array of the same row before it is
    exploded (``lines[i-1]``, ``lines[i+1]``), so the table needs no window
    and no shuffle, and no chapter is ever gathered into one task."""
    def tag(lines):
        n = F.size(lines)
        return F.transform(lines, lambda l, i: F.struct(
            l.alias("line"),
            ((i == 0) | _blank(F.get(lines, i - 1))).alias("prev_blank"),
            ((i == n - 1) | _blank(F.get(lines, i + 1))).alias("next_blank")))

    tagged = T.let(F.split(F.col(text_col), "\n", -1), tag)
    return df.select(*keys, F.posexplode(tagged).alias("line_no", "_l")).select(
        *keys, "line_no", "_l.line", "_l.prev_blank", "_l.next_blank")


# --- T8: Markdown blocks -> HTML (the subset the formatter emits) ----------------

_HEADING_RE = r"^(#{1,6}) (.*)$"
_OL_RE = r"^[0-9]+\. (.*)$"


def _inline(s: Column) -> Column:
    return F.regexp_replace(s, r"\*([^*\n]+)\*", "<em>$1</em>")


def markdown_blocks(md: Column) -> Column:
    """``array<struct<kind, html>>`` for a Markdown text.

    Blank lines separate blocks, a heading line is always its own block,
    other consecutive lines form a paragraph; a paragraph that is one
    ``N. text`` line becomes an ordered list; ``*x*`` becomes ``<em>``.
    Blocks are found by a fold over line *flags* that emits index ranges
    (integers only); the lines are sliced out once per block.
    """
    bounds_t = "array<struct<a:int,n:int>>"

    def build(ss):
        init = F.struct(F.array().cast(bounds_t).alias("b"), F.lit(1).alias("ca"), F.lit(0).alias("cn"))

        def flush(a):
            return F.when(a["cn"] > 0, F.concat(a["b"], F.array(F.struct(
                a["ca"].alias("a"), a["cn"].alias("n"))))).otherwise(a["b"])

        def step(a, i):
            s = F.element_at(ss, i)
            return (F.when(s == "", F.struct(flush(a).alias("b"), (i + 1).alias("ca"), F.lit(0).alias("cn")))
                    .when(s.rlike(_HEADING_RE), F.struct(
                        F.concat(flush(a), F.array(F.struct(i.alias("a"), F.lit(1).alias("n")))).alias("b"),
                        (i + 1).alias("ca"), F.lit(0).alias("cn")))
                    .otherwise(F.struct(a["b"].alias("b"),
                                        F.when(a["cn"] == 0, i).otherwise(a["ca"]).alias("ca"),
                                        (a["cn"] + 1).alias("cn"))))

        bounds = F.aggregate(F.sequence(F.lit(1), F.size(ss)), init, step, flush)
        return F.transform(bounds, lambda r: _render(F.slice(ss, r["a"], r["n"])))

    return T.let(F.transform(F.split(md, "\n", -1), lambda l: T.py_strip(l)), build)


def _render(b: Column) -> Column:
    first = F.element_at(b, 1)
    level = F.length(F.regexp_extract(first, _HEADING_RE, 1))
    return (F.when((F.size(b) == 1) & first.rlike(_HEADING_RE), F.struct(
                F.lit("heading").alias("kind"),
                F.format_string("<h%d>%s</h%d>", level,
                                _inline(F.regexp_extract(first, _HEADING_RE, 2)), level).alias("html")))
            .when((F.size(b) == 1) & first.rlike(_OL_RE), F.struct(
                F.lit("list").alias("kind"),
                F.concat(F.lit("<ol>\n<li>"), _inline(F.regexp_extract(first, _OL_RE, 1)),
                         F.lit("</li>\n</ol>")).alias("html")))
            .otherwise(F.struct(
                F.lit("paragraph").alias("kind"),
                F.concat(F.lit("<p>"), _inline(F.array_join(b, "\n")), F.lit("</p>")).alias("html"))))


def markdown_to_html(md: Column) -> Column:
    return F.array_join(F.transform(markdown_blocks(md), lambda b: b["html"]), "\n")


# --- T9: PDF artefact repair ----------------------------------------------------

def repair_breaks(text: Column) -> Column:
    """Join hyphenated line breaks, then merge a paragraph into the
    previous one when that one does not end a sentence and this one starts
    lower-case; true paragraph breaks stay."""
    joined = F.regexp_replace(text, r"(\p{L})-\n(\p{Ll})", "$1$2")

    def glue(paras):
        # Merging paragraph i into i-1 only swaps the blank line between them
        # for a space, so each paragraph picks its own separator: O(paragraphs).
        def sep(p, i):
            prev = F.get(paras, i - 1)
            merge = ~prev.rlike(r"[.!?:]\z") & p.rlike(r"^\p{Ll}")
            return F.when(i == 0, F.lit("")).when(merge, F.lit(" ")).otherwise(F.lit("\n\n"))
        return F.array_join(F.transform(paras, lambda p, i: F.concat(sep(p, i), p)), "")

    return T.let(F.split(joined, "\n\n", -1), glue)


# --- A9: sizes before and after ---------------------------------------------------

def size_ratio(after: Column, before: Column) -> Column:
    """``after / before``. A text that was empty before has no ratio and gets
    NaN, the IEEE quotient 0/0 (the largest value for ``min`` and ``max``); in
    ANSI mode the plain division would fail the whole job."""
    return F.when(before == 0, F.lit(float("nan"))).otherwise(after / before)


# --- T10: content preservation ---------------------------------------------------

def content_key(text: Column) -> Column:
    """Text with Markdown symbols and all whitespace removed."""
    return F.regexp_replace(text, r"[#*\x{9}-\x{d}\x{1c}-\x{20}\x{85}\p{Z}]", "")


def content_preserved(before: Column, after: Column) -> Column:
    """A formatting step may add only Markdown symbols and whitespace."""
    return content_key(before) == content_key(after)
