"""Regex segmentation of whole documents into chapters.

Spark gives no match offsets, so each pattern is applied with one
``regexp_replace`` that wraps every match in private-use sentinels
(mark-and-split). Splitting on the sentinels yields, per match, the full
matched text, its title group and the text up to the next match. A fold over
those pieces then re-attaches the text of dropped matches to the previous
kept chapter. Everything stays inside the document's row: no explode, no
shuffle, and patterns after the first winning one are never evaluated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import constants as C
from quire.functions import text as T

# Private-use sentinels. Where a text has them (or the escape) itself, each
# is written as the escape and a second mark, and put back in every piece.
MATCH_START, TITLE_START, TITLE_END, ESCAPE = "\ue000", "\ue001", "\ue002", "\ue003"
_ESCAPED = [(ESCAPE, ESCAPE + "\ue007"), (MATCH_START, ESCAPE + "\ue004"),
            (TITLE_START, ESCAPE + "\ue005"), (TITLE_END, ESCAPE + "\ue006")]

_WS_INNER = C.WS_CLASS[1:-1]

CHAPTER_T = "array<struct<chapter_no:int,title:string,text:string>>"


def portable_pattern(p: str) -> str:
    """Spell a Python ``re`` pattern so Java regex (and RE2) read it the same
    way: ``\\s`` becomes Python's whitespace set, ``\\d`` Unicode digits."""
    out, in_class, i = [], False, 0
    while i < len(p):
        c = p[i]
        if c == "\\" and i + 1 < len(p):
            nxt = p[i + 1]
            if nxt == "s":
                out.append(_WS_INNER if in_class else C.WS_CLASS)
            elif nxt == "d":
                out.append(r"\p{Nd}")
            else:
                out.append(p[i:i + 2])
            i += 2
            continue
        if c == "[" and not in_class:
            in_class = True
        elif c == "]" and in_class:
            in_class = False
        out.append(c)
        i += 1
    return "".join(out)


def java_pattern(p: str) -> str:
    """Case-insensitive (Unicode), and ``.`` excludes only ``\\n`` as in Python."""
    return "(?idu)" + portable_pattern(p)


def title_kept(title: Column) -> Column:
    """Drop URL-like, short, or training-zone titles."""
    low = F.lower(title)
    ok = F.lit(True)
    for banned in C.SEGMENT_TITLE_BANNED:
        ok = ok & ~low.contains(banned)
    return ok & (F.length(title) >= C.SEGMENT_TITLE_MIN_LEN) & ~title.startswith(C.SEGMENT_TITLE_BANNED_PREFIX)


def _swap(text: Column, pairs: list[tuple[str, str]]) -> Column:
    # Bound once: each use of an expression inside a lambda computes it again.
    def swapped(t: Column) -> Column:
        out = t
        for old, new in pairs:
            out = F.replace(out, F.lit(old), F.lit(new))
        return F.when(t.contains(ESCAPE) | t.contains(MATCH_START) | t.contains(TITLE_START)
                      | t.contains(TITLE_END), out).otherwise(t)

    return T.let(text, swapped)


def _escape(text: Column) -> Column:
    return _swap(text, _ESCAPED)


def _restore(text: Column) -> Column:
    return _swap(text, [(new, old) for old, new in reversed(_ESCAPED)])


def match_pieces(text: Column, pattern: str) -> Column:
    """``array<struct<full, title, body, kept>>``: one element per match."""
    marked = F.regexp_replace(_escape(text), F.lit(java_pattern(pattern)),
                              F.lit(MATCH_START + "$0" + TITLE_START + "$1" + TITLE_END))
    split = F.split(marked, MATCH_START)
    raw = T.let(split, lambda x: F.slice(x, 2, F.size(x)))  # all but the first

    def parse(piece):
        # One mark of each kind in a piece; one pass cuts it at both.
        def named(x):
            return T.let(T.py_strip(_restore(F.element_at(x, 2))), lambda title: F.struct(
                _restore(F.element_at(x, 1)).alias("full"), title.alias("title"),
                _restore(F.element_at(x, 3)).alias("body"), title_kept(title).alias("kept")))

        return T.let(F.split(piece, f"[{TITLE_START}{TITLE_END}]", 3), named)

    return F.transform(raw, parse)


def chapters_from_pieces(pieces: Column) -> Column:
    """W2 + gaps-and-islands: body of a kept match runs to the next *kept*
    match; dropped matches (and their text) stay inside the previous body.
    Numbers count kept matches, so later length filtering leaves gaps.

    Index arithmetic instead of a fold: the kept positions are listed once,
    and each chapter joins its own slice of pieces, so the work is linear in
    the text however many matches are dropped."""
    def build(kept_idx):
        n = F.size(pieces)
        m = F.size(kept_idx)

        def chapter(k, j):
            nxt = F.when(j + 1 < m, F.element_at(kept_idx, j + 2)).otherwise(n + 1)
            head = F.element_at(pieces, k)
            tail = F.slice(pieces, k + 1, nxt - k - 1)
            body = F.concat(head["body"], F.array_join(
                F.transform(tail, lambda p: F.concat(p["full"], p["body"])), ""))
            return F.struct((j + 1).cast("int").alias("chapter_no"), head["title"].alias("title"),
                            T.py_strip(body).alias("text"))

        return F.transform(kept_idx, chapter)

    idx = F.filter(F.sequence(F.lit(1), F.greatest(F.size(pieces), F.lit(1))),
                   lambda i: F.coalesce(F.element_at(pieces, i)["kept"], F.lit(False)))
    return F.when(F.size(pieces) == 0, F.array().cast(CHAPTER_T)).otherwise(T.let(idx, build))


def n_kept(pieces: Column) -> Column:
    return F.size(F.filter(pieces, lambda p: p["kept"]))


def segment(text: Column, fallback_title: Column,
            patterns: list[str] = C.SEGMENT_PATTERNS,
            min_matches: int = C.SEGMENT_MIN_MATCHES, counts: list[Column] | None = None) -> Column:
    """A8 + P5: ``struct<pattern_no, chapters>`` from the first pattern with at
    least ``min_matches`` kept matches; else one chapter holding the whole
    text (pattern_no 0). Later patterns are evaluated only if needed.
    ``counts``: the kept matches of each pattern where they are known already
    (:func:`pattern_report`); then only the winning pattern is evaluated."""
    fallback = F.struct(F.lit(0).alias("pattern_no"), F.array(F.struct(
        F.lit(1).alias("chapter_no"), fallback_title.alias("title"), text.alias("text"))
    ).cast(CHAPTER_T).alias("chapters"))

    def won(k: int, pcs: Column) -> Column:
        return F.struct(F.lit(k + 1).alias("pattern_no"), chapters_from_pieces(pcs).alias("chapters"))

    def chain(k: int) -> Column:
        if k == len(patterns):
            return fallback
        if counts is not None:
            return F.when(counts[k] >= min_matches,
                          T.let(match_pieces(text, patterns[k]), lambda pcs: won(k, pcs))).otherwise(chain(k + 1))
        return T.let(match_pieces(text, patterns[k]), lambda pcs: F.when(
            n_kept(pcs) >= min_matches, won(k, pcs)).otherwise(chain(k + 1)))

    return chain(0)


def split_into_chapters(docs: DataFrame, keys: list[str], text_col: str = "text",
                        title_col: str = "title", min_body: int = C.SEGMENT_MIN_BODY) -> DataFrame:
    """One row per chapter; pattern chapters shorter than ``min_body``
    after strip are dropped (P4), the fallback chapter never is."""
    seg = docs.select(*keys, segment(F.col(text_col), F.col(title_col)).alias("_s"))
    out = seg.select(*keys, F.col("_s.pattern_no").alias("pattern_no"),
                     F.inline("_s.chapters"))
    return out.where((F.col("pattern_no") == 0) | (F.length("text") >= min_body))


def pattern_report(docs: DataFrame, keys: list[str], text_col: str = "text",
                   patterns: list[str] = C.SEGMENT_PATTERNS) -> DataFrame:
    """A8 audit: kept matches per pattern for every document."""
    return docs.select(*keys, *[n_kept(match_pieces(F.col(text_col), p)).alias(f"kept_{i + 1}")
                                for i, p in enumerate(patterns)])
