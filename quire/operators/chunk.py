"""Size-bounded text chunkers (T2–T5) as bounded folds in the JVM.

A greedy chunker is sequential *within* one text but independent *across*
texts, so each text is one row and the whole loop runs as a Spark
higher-order ``aggregate`` over a bounded step sequence: no Python, no
shuffle, one output row per chunk after ``posexplode``. The folds carry cut
offsets (integers), not strings, so the accumulator stays small; chunk text
is cut out once at the end.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import constants as C
from quire.functions import text as T

CUT_TYPE = "array<struct<s:int,e:int>>"


def _rfind_rev(rev_window: Column, wlen: Column, pattern: str) -> Column:
    """``window.rfind(pattern)`` from the reversed window: a forward search
    that stops at the first hit, i.e. at the last occurrence."""
    hit = F.instr(rev_window, pattern[::-1])
    return F.when(hit == 0, F.lit(-1)).otherwise(wlen - hit + 1 - len(pattern))


def _fold_cuts(text: Column, size: int, min_advance: int, next_cut) -> Column:
    """Run the greedy window rule until the text is consumed; return the
    cuts as ``(s, e)`` *byte* offsets into the UTF-8 text.

    Each step looks at one window of ``size`` code points. The text is
    encoded once and the window is taken as a byte slice (at most 4 bytes a
    code point) from the current byte offset, so a step costs O(window) no
    matter how far into a long text it is (a character-indexed substring
    would walk from the start every time). ``next_cut(rfind)`` returns the
    relative cut for a full window; ``min_advance`` is the smallest such
    cut, so ``ceil(n / min_advance) + 1`` steps always suffice.
    """
    def run(bn):
        b, n, nb = bn["b"], bn["n"], F.octet_length(bn["b"])
        steps = F.sequence(F.lit(1), F.greatest(F.lit(1), (F.ceil(n / F.lit(float(min_advance))) + 1).cast("int")))
        init = F.struct(F.lit(0).alias("pos"), F.lit(0).alias("bpos"), F.array().cast(CUT_TYPE).alias("cuts"))

        def step(acc, _):
            pos, bpos = acc["pos"], acc["bpos"]
            last = pos + size >= n
            window = F.substring(F.substring(b, bpos + 1, 4 * size).cast("string"), 1, size)

            def advance(w):
                rel = F.when(last, n - pos).otherwise(
                    T.let(F.reverse(w), lambda r: next_cut(lambda p: _rfind_rev(r, F.lit(size), p))))

                def emit(er):
                    nbpos = F.when(last, nb).otherwise(bpos + F.octet_length(F.substring(w, 1, er)))
                    return T.let(nbpos, lambda e1: F.struct(
                        (pos + er).alias("pos"), e1.alias("bpos"),
                        F.concat(acc["cuts"], F.array(F.struct(bpos.alias("s"), e1.alias("e")))).alias("cuts")))

                return T.let(rel, emit)

            return F.when(pos >= n, acc).otherwise(T.let(window, advance))

        return F.aggregate(steps, init, step, lambda acc: acc["cuts"])

    return T.let(F.struct(F.encode(text, "UTF-8").alias("b"), F.length(text).alias("n")), run)


def fixed_cuts(text: Column, size: int = C.FIXED_CHUNK_SIZE,
               para_ratio: float = C.FIXED_PARAGRAPH_CUT_RATIO) -> Column:
    """T2 cut offsets: cut before the last ``\\n\\n`` past ``para_ratio``."""
    limit = size * para_ratio

    def next_cut(rf):
        return T.let(rf("\n\n"), lambda lp: F.when(lp > F.lit(limit), lp).otherwise(F.lit(size)))

    return _fold_cuts(text, size, math.floor(limit) + 1, next_cut)


def boundary_cuts(text: Column, size: int = C.TRANSLATE_CHUNK_SIZE,
                  para_ratio: float = C.PARAGRAPH_CUT_RATIO,
                  sent_ratio: float = C.SENTENCE_CUT_RATIO,
                  space_ratio: float = C.SPACE_CUT_RATIO) -> Column:
    """T3 cut offsets: paragraph > sentence mark > space > hard cut, strict."""
    lim_p, lim_s, lim_w = size * para_ratio, size * sent_ratio, size * space_ratio

    def next_cut(rf):
        last_sent = F.greatest(*[rf(m) for m in C.SENTENCE_MARKS])
        return T.let(rf("\n\n"), lambda lp: F.when(lp > F.lit(lim_p), lp).otherwise(
            T.let(last_sent, lambda ls: F.when(ls > F.lit(lim_s), ls + 1).otherwise(
                T.let(rf(" "), lambda lw: F.when(lw > F.lit(lim_w), lw).otherwise(F.lit(size)))))))

    min_adv = min(math.floor(lim_p) + 1, math.floor(lim_s) + 2, math.floor(lim_w) + 1, size)
    return _fold_cuts(text, size, min_adv, next_cut)


def explode_cuts(df: DataFrame, text_col: str, cuts: Column, keys: list[str],
                 strip: bool) -> DataFrame:
    """One row per chunk: ``part_no`` (1-based), ``n_parts`` and the text.

    Cuts are byte offsets, so each chunk is an O(chunk) byte slice of the
    encoded text; the strings are cut out *before* the explode, so each
    output row carries only its own chunk."""
    def pieces(b):
        def cut(c):
            piece = F.substring(b, c["s"] + 1, c["e"] - c["s"]).cast("string")
            return T.py_strip(piece) if strip else piece
        return F.transform(cuts, cut)

    return _explode_chunks(df.select(*keys, T.let(F.encode(F.col(text_col), "UTF-8"), pieces).alias("_c")), keys)


def _explode_chunks(df: DataFrame, keys: list[str]) -> DataFrame:
    # The chunk array is referenced once (by the generator): n_parts rides in
    # each element, so the optimizer never copies the fold expression.
    tagged = T.let(F.col("_c"), lambda cs: F.transform(
        cs, lambda x: F.struct(x.alias("text"), F.size(cs).alias("n"))))
    return df.select(*keys, F.posexplode(tagged).alias("_i", "_x")).select(
        *keys, (F.col("_i") + 1).alias("part_no"), F.col("_x.n").alias("n_parts"),
        F.col("_x.text").alias("text"))


def chunk_fixed(df: DataFrame, keys: list[str], text_col: str = "text", **kw) -> DataFrame:
    """Lossless chunks (concatenation gives the text back)."""
    return explode_cuts(df, text_col, fixed_cuts(F.col(text_col), **kw), keys, strip=False)


def chunk_boundary(df: DataFrame, keys: list[str], text_col: str = "text", **kw) -> DataFrame:
    """Stripped chunks; an all-blank chunk stays as ``''``."""
    return explode_cuts(df, text_col, boundary_cuts(F.col(text_col), **kw), keys, strip=True)


# --- paragraph packer (T4) with sentence fallback (T5) ------------------------

def _first_present(p: Column, delims: list[str]) -> Column:
    out = F.lit(None).cast("string")
    for d in reversed(delims):
        out = F.when(F.instr(p, d) > 0, F.lit(d)).otherwise(out)
    return out


BOUNDS_T = "array<struct<a:int,n:int>>"


def _ranges_fold(lengths: Column, step_rule) -> Column:
    """Fold over item *lengths* only, producing ``(first index, count)``
    ranges; strings are joined once afterwards. The accumulator holds
    integers, so each step stays cheap however long the text is."""
    init = F.struct(F.array().cast(BOUNDS_T).alias("b"), F.lit(1).alias("ca"),
                    F.lit(0).alias("cn"), F.lit(0).alias("sz"))

    def finish(acc):
        return F.when(acc["cn"] > 0, F.concat(acc["b"], F.array(F.struct(
            acc["ca"].alias("a"), acc["cn"].alias("n"))))).otherwise(acc["b"])

    def run(ls):
        idx = F.sequence(F.lit(1), F.size(ls))
        return F.when(F.size(ls) == 0, F.array().cast(BOUNDS_T)).otherwise(
            F.aggregate(idx, init, lambda acc, i: step_rule(acc, i, F.element_at(ls, i), finish), finish))

    # Bind the length array once; referenced inside the lambda it would be
    # rebuilt at every step.
    return T.let(lengths, run)


def _state(b, ca, cn, sz):
    return F.struct(b.alias("b"), ca.alias("ca"), cn.alias("cn"), sz.alias("sz"))


def sentence_groups(p: Column, max_size: int,
                    delims: list[str] = C.SENTENCE_DELIMITERS) -> Column:
    """T5: split an oversize paragraph on the first delimiter present (kept on
    its sentence) and greedily regroup with plain concatenation."""
    def on_delim(d):
        parts = F.split(p, F.concat(F.lit("\\Q"), d, F.lit("\\E")), -1)
        sents = F.when(d.isNull(), F.array(p)).otherwise(
            T.let(parts, lambda ps: F.transform(
                ps, lambda s, i: F.when(i < F.size(ps) - 1, F.concat(s, d)).otherwise(s))))

        def rule(acc, i, ln, finish):
            flush = (acc["sz"] + ln > max_size) & (acc["cn"] > 0)
            return F.when(flush, _state(finish(acc), i, F.lit(1), ln)).otherwise(
                _state(acc["b"], F.when(acc["cn"] == 0, i).otherwise(acc["ca"]), acc["cn"] + 1, acc["sz"] + ln))

        def build(ss):
            bounds = _ranges_fold(F.transform(ss, lambda x: F.length(x)), rule)
            return F.transform(bounds, lambda b: F.array_join(F.slice(ss, b["a"], b["n"]), ""))

        return T.let(sents, build)

    return T.let(_first_present(p, delims), on_delim)


def paragraph_pack(text: Column, max_size: int = C.SPEECH_CHUNK_SIZE,
                   join_cost: int = C.PARAGRAPH_JOIN_COST) -> Column:
    """T4 chunk array: split on blank lines, strip, drop blanks, pack greedily.

    A paragraph appended to the buffer costs ``len + join_cost``; one that
    opens a new buffer after a flush costs ``len``; an oversize paragraph
    flushes the buffer and goes through :func:`sentence_groups`. The fold
    sees only paragraph lengths and emits index ranges (``n = 0`` marks an
    oversize paragraph); the chunk strings are joined once at the end.
    """
    def rule(acc, i, ln, finish):
        big = ln > max_size
        over = acc["sz"] + ln + join_cost > max_size
        return (F.when(big, _state(F.concat(finish(acc), F.array(F.struct(i.alias("a"), F.lit(0).alias("n")))),
                                   i + 1, F.lit(0), F.lit(0)))
                .when(over, _state(finish(acc), i, F.lit(1), ln))
                .otherwise(_state(acc["b"], F.when(acc["cn"] == 0, i).otherwise(acc["ca"]),
                                  acc["cn"] + 1, acc["sz"] + ln + join_cost)))

    def build(ps):
        bounds = _ranges_fold(F.transform(ps, lambda x: F.length(x)), rule)
        return F.flatten(F.transform(bounds, lambda b: F.when(
            b["n"] > 0, F.array(F.array_join(F.slice(ps, b["a"], b["n"]), "\n\n"))
        ).otherwise(sentence_groups(F.element_at(ps, b["a"]), max_size))))

    paras = F.filter(F.transform(T.split_literal(text, "\n\n"), lambda s: T.py_strip(s)),
                     lambda s: s != "")
    return T.let(paras, build)


def pack_paragraphs(df: DataFrame, keys: list[str], text_col: str = "text",
                    max_size: int = C.SPEECH_CHUNK_SIZE) -> DataFrame:
    """One row per packed chunk: ``part_no``, ``n_parts``, ``text``."""
    return _explode_chunks(df.select(*keys, paragraph_pack(F.col(text_col), max_size).alias("_c")), keys)


def strip_markdown(text: Column) -> Column:
    """Drop ``#`` and ``*`` then strip."""
    # Two searches copy what lies between the marks; ``translate`` makes a
    # string of every character.
    return T.py_strip(F.replace(F.replace(text, F.lit("#"), F.lit("")), F.lit("*"), F.lit("")))


def part_file_name(chapter_no: Column, part_no: Column, n_parts: Column,
                   always_numbered: bool = False, ext: str = "mp3") -> Column:
    """``chapter_NN.ext`` for a single chunk, else ``chapter_NN_partMM.ext``."""
    many = F.format_string(f"chapter_%02d_part%02d.{ext}", chapter_no, part_no)
    if always_numbered:
        return many
    return F.when(n_parts == 1, F.format_string(f"chapter_%02d.{ext}", chapter_no)).otherwise(many)
