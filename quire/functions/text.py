"""Column-level text helpers (all built-in Spark expressions, JVM-side).

Each helper reproduces one Python ``str`` behaviour exactly on code points:
``strip`` (Unicode whitespace), ``rfind`` (-1 when absent), ``split``
with a literal separator, zero padding without truncation, and character
class counts.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.constants import CJK_FIRST, CJK_LAST, PY_WHITESPACE


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """``str.strip()``: remove Unicode whitespace at both ends."""
    return F.trim(col(c), F.lit(PY_WHITESPACE))


def split_literal(c, sep: str, limit: int = -1) -> Column:
    """``str.split(sep)`` with a literal separator (regex-quoted)."""
    return F.split(col(c), re.escape(sep), limit)


def let(expr: Column, body) -> Column:
    """Bind ``expr`` once and use it several times inside ``body``.

    SQL lambdas have no ``let``; wrapping the value in a one-element array
    makes Spark evaluate it once per row.
    """
    return F.element_at(F.transform(F.array(expr), body), 1)


def zero_pad(n, width: int = 2) -> Column:
    """``f'{n:0{width}d}'``: pads, never truncates (unlike ``lpad``)."""
    return F.format_string(f"%0{width}d", col(n))


def cjk_count(c) -> Column:
    """Number of code points in the CJK unified ideographs block."""
    return F.regexp_count(col(c), F.lit(f"[{CJK_FIRST}-{CJK_LAST}]"))


def ends_with_any(c, suffixes: list[str]) -> Column:
    c = col(c)
    out = F.lit(False)
    for s in suffixes:
        out = out | c.endswith(s)
    return out


def py_upper_ratio_gt(c, ratio: float) -> Column:
    """``letters > 0 and upper / letters > ratio`` (``isupper``/``isalpha``)."""
    c = col(c)
    upper = F.regexp_count(c, F.lit(r"\p{IsUppercase}"))
    letters = F.regexp_count(c, F.lit(r"\p{L}"))
    return (letters > 0) & ((upper / letters) > F.lit(ratio))


# Every decimal digit of Unicode and its value, built by rule.
_DIGITS = [ch for ch in map(chr, range(0x110000)) if ch.isdecimal()]
_VALUES = "".join(str(int(ch)) for ch in _DIGITS)


def ascii_digits(c) -> Column:
    """Decimal digits of any script as 0-9, as ``int()`` reads them."""
    return F.translate(col(c), "".join(_DIGITS), _VALUES)


def try_int(c) -> Column:
    """``int(s)`` that yields NULL instead of raising."""
    return col(c).try_cast("int")


def with_once(df, **cols):
    """Add columns computed exactly once per row, even when later
    projections reference them several times: they come out of a one-row
    ``inline`` generator, which the optimizer never inlines into consumers."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))))
