"""Binary part sets: incremental generation and completeness-gated merge.

J5 (skip what exists), U1 (existing ∪ new), J7 (all parts 1..n present),
A3 (ordered binary concat), A5 (success counts / all-ok gate), A6 (size and
duration estimate), M5 (merge only when every part succeeded).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions import constants as C


def missing_parts(expected: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Expected parts that are not produced yet (``left_anti``)."""
    return expected.join(existing.select(*keys), keys, "left_anti")


def complete_sets(parts: DataFrame, expected: DataFrame, set_keys: list[str],
                  part_col: str = "part_no", n_col: str = "n_parts",
                  content_col: str = "content") -> DataFrame:
    """J7 + A5: per set, how many of the expected parts ``1..n`` exist.

    ``expected`` has one row per set with ``n_col``; a set is complete when
    every part number ``1..n`` is present (duplicates and strays ignored). A
    part whose content is NULL (a failed one) is not present.
    """
    if content_col in parts.columns:
        parts = parts.where(F.col(content_col).isNotNull())
    present = (parts.where(F.col(part_col) >= 1).select(*set_keys, part_col).distinct()
               .join(expected.select(*set_keys, n_col), set_keys)
               .where(F.col(part_col) <= F.col(n_col))
               .groupBy(*set_keys).agg(F.count("*").alias("n_present")))
    return (expected.select(*set_keys, n_col).join(present, set_keys, "left")
            .select(*set_keys, n_col, F.coalesce("n_present", F.lit(0)).alias("n_present"))
            .withColumn("complete", F.col("n_present") == F.col(n_col)))


def merge_parts(parts: DataFrame, set_keys: list[str], part_col: str = "part_no",
                content_col: str = "content") -> DataFrame:
    """A3: ordered concatenation of the binary parts of each set."""
    return parts.groupBy(*set_keys).agg(
        F.expr(f"listagg({content_col}) WITHIN GROUP (ORDER BY {part_col})").alias("content"))


def gated_merge(parts: DataFrame, expected: DataFrame, set_keys: list[str], part_col: str = "part_no",
                n_col: str = "n_parts", content_col: str = "content", min_parts: int = 1) -> DataFrame:
    """J7 + A3 + M5 in one join and one aggregation: per expected set, the
    number of parts ``1..n`` present, ``complete``, and the ordered
    concatenation when complete and at least ``min_parts`` long (else NULL).

    A part is present when it has content; of several rows of one part the
    least content counts.
    """
    j = expected.select(*set_keys, n_col).join(parts.select(*set_keys, part_col, content_col), set_keys, "left")
    return gate_rows(j, set_keys, part_col, n_col, content_col, min_parts)


def gate_rows(rows: DataFrame, set_keys: list[str], part_col: str = "part_no", n_col: str = "n_parts",
              content_col: str = "content", min_parts: int = 1) -> DataFrame:
    """The aggregation half of :func:`gated_merge`, for rows that already pair
    each expected set (``n_col``) with its parts (NULL part when none), e.g.
    from ``posexplode_outer`` when plan and parts live in the same row."""
    valid = F.col(part_col).between(F.lit(1), F.col(n_col)) & F.col(content_col).isNotNull()
    one = rows.groupBy(*set_keys, part_col).agg(
        F.max(n_col).alias(n_col), F.min(F.when(valid, F.col(content_col))).alias(content_col))
    agg = one.groupBy(*set_keys).agg(
        F.max(n_col).alias(n_col),
        F.count(content_col).alias("n_present"),
        F.expr(f"listagg({content_col}) WITHIN GROUP (ORDER BY {part_col})").alias("_all"))
    complete = F.col("n_present") == F.col(n_col)
    return agg.select(*set_keys, n_col, "n_present", complete.alias("complete"),
                      F.when(complete & (F.col(n_col) >= min_parts), F.col("_all")).alias("content"))


def gate_sizes(rows: DataFrame, set_keys: list[str], part_col: str = "part_no", n_col: str = "n_parts",
               bytes_col: str = "n_bytes", min_parts: int = 1) -> DataFrame:
    """The same gate where only the flag and the merged size are wanted: no
    content moves. ``bytes_col`` is the size of a part's content (NULL: not
    present); of several rows of one part the smallest counts."""
    valid = F.col(part_col).between(F.lit(1), F.col(n_col))
    one = rows.groupBy(*set_keys, part_col).agg(
        F.max(n_col).alias(n_col), F.min(F.when(valid, F.col(bytes_col))).alias(bytes_col))
    agg = one.groupBy(*set_keys).agg(F.max(n_col).alias(n_col), F.count(bytes_col).alias("n_present"),
                                     F.sum(bytes_col).alias("_all"))
    complete = F.col("n_present") == F.col(n_col)
    return agg.select(*set_keys, n_col, "n_present", complete.alias("complete"),
                      F.when(complete & (F.col(n_col) >= min_parts), F.col("_all")).alias(bytes_col))


def size_estimate(n_bytes, kbps: int = C.AUDIO_KBPS):
    """Size in MB and the duration estimate ``MB * 8 * 1024 / (kbps * 60)``."""
    mb = n_bytes / F.lit(1024.0 * 1024.0)
    return mb, (mb * 8 * 1024) / F.lit(float(kbps * 60))
