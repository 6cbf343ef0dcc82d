"""Positions in a sorted table, however large one of its groups is.

The rows are cut into ranges of their sort order and numbered inside them; a
group's offset in each range comes from one row for each group and range. A
group that holds a third of all rows is spread over a third of the ranges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.session import materialize


def ranked(rows: DataFrame, key: str, order: list[str], keep: list[str]) -> DataFrame:
    """``key``, ``keep``, the place ``i`` (from 0) in the order of the group and
    the group's size ``n``. Nulls of ``key`` are a group; nulls sort first.
    The sorted rows are written once, as the ranges are physical; columns that
    are only sorted by are not written."""
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = materialize(rows.repartitionByRange(ranges, key, *order).sortWithinPartitions(key, *order).select(
        key, *keep, F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().alias("_seq")))
    earlier = Window.partitionBy("_key").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    slices = cut.groupBy(F.col("_range").alias("_at"), F.col(key).alias("_key")).agg(
        F.min("_seq").alias("_first"), F.count(F.lit(1)).alias("_rows")).select(
        "_at", "_key", "_first", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_rows").over(Window.partitionBy("_key")).alias("n"))
    return cut.join(slices, (F.col("_range") == F.col("_at")) & F.col(key).eqNullSafe(F.col("_key"))).select(
        key, *keep, (F.col("_before") + F.col("_seq") - F.col("_first")).alias("i"), "n")
