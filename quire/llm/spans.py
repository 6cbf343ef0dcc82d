"""Spans of regular expressions in texts, with SQL functions only.

``split`` gives the text between matches and ``regexp_extract_all`` the
matches; their lengths (code points) add up to positions. The sums are a
window over the matches of one text, so a text with very many matches costs
time in proportion.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Pattern:
    """``regex``: Java syntax; ``sieve``: a condition on ``text`` that every
    text with a match meets (cheap, tried first)."""
    kind: str
    regex: str
    sieve: str


def suspects(rows: DataFrame, patterns: list[Pattern]) -> DataFrame:
    return rows.where(" or ".join(f"({p.sieve})" for p in patterns))


def matches(texts: DataFrame, key: str, patterns: list[Pattern], around: int = 0) -> DataFrame:
    """key, kind, start, end, match and, with ``around``, up to so many
    characters before and after. ``texts``: one row (key, text) per text."""
    found = None
    for p in patterns:
        hit = texts.where(p.sieve).where(F.col("text").rlike(p.regex))
        one = hit.select(key, F.lit(p.kind).alias("kind"), F.arrays_zip(
            F.split("text", p.regex, -1).alias("gap"),
            F.regexp_extract_all("text", F.lit(p.regex), F.lit(0)).alias("match")).alias("z"))
        one = one.select(key, "kind", F.posexplode(F.expr(
            "transform(z, (x, i) -> named_struct('gap', length(x.gap), 'match', x.match"
            + (f", 'before', right(x.gap, {around}), 'after', left(get(z, i + 1).gap, {around})" if around else "") + "))")))
        found = one if found is None else found.unionByName(one)
    upto = Window.partitionBy(key, "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("col.gap") + F.coalesce(F.length("col.match"), F.lit(0))).over(upto)
    more = [F.col("col.before").alias("before"), F.coalesce(F.col("col.after"), F.lit("")).alias("after")] if around else []
    return found.withColumn("end", end).where("col.match is not null").select(
        key, "kind", (F.col("end") - F.length("col.match")).cast("long").alias("start"),
        F.col("end").cast("long").alias("end"), F.col("col.match").alias("match"), *more)


def joined(spans: Column) -> Column:
    """``kind:start:end`` of an array of spans (start, rank, kind, end), in
    that order, joined by commas."""
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
