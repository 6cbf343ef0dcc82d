"""Shards of near equal size by sampled splitters.

Records are ordered by (hash of the text, number, row), so equal texts stand
together. A sample drawn in proportion to size gives quantile splitters; they
cut the order into ranges, and ranges with too many rows are subdivided by
splitters from a second, even draw (the row number tells equal rows apart, so
any range can be cut). Running sums inside ranges plus the ranges' totals give
each record its exact place in the order by bytes and by rows; a shard is an
eighth of the bytes. No step holds a shard or a group of copies in one task.

The law is ``bytes``: shard sizes differ from an even share by a record, plus
``slack`` of a share, the most that a cut moves to keep equal texts in one
shard. Groups of more than that are cut.

Defined results: a null text has no bytes (size 1); a null number sorts last;
equal rows are rows of their own; other columns are ignored.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.session import materialize

SHARDS = 8
#: Sampled rows for each range; at most about twice as many reach the driver.
SAMPLE = 32
SLACK = 0.01
_KEY = ["h", "did", "row"]


def _draw(rows: DataFrame, chance, salt: int) -> list[tuple]:
    u = F.pmod(F.xxhash64(*_KEY, F.lit(salt)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return sorted(tuple(r) for r in rows.where(u < chance).select(*_KEY).collect())


def _place(rows: DataFrame, splitters: list[tuple]) -> DataFrame:
    """Add the number of the range (splitters at or before the key)."""
    heads = np.array([s[0] for s in splitters], np.int64)

    def work(batches):
        for b in batches:
            h = b.column("h").to_numpy()
            low, high = np.searchsorted(heads, h, "left"), np.searchsorted(heads, h, "right")
            for k in np.flatnonzero(low != high).tolist():
                low[k] = bisect.bisect_right(splitters, tuple(b.column(c)[k].as_py() for c in _KEY))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(low.astype(np.int32))], [*b.schema.names, "part"])

    return rows.mapInArrow(work, f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in rows.schema)}, part int")


def shard(docs: DataFrame, shards: int = SHARDS, ranges: int | None = None, sample: int = SAMPLE,
          slack: float = SLACK) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of each row."""
    spark = docs.sparkSession
    ranges = ranges or max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    text = F.coalesce("text", F.lit(""))
    rows = materialize(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("did"),
        F.xxhash64(text).alias("h"), F.monotonically_increasing_id().alias("row"),
        (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")))
    total, count = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    if not count:
        splitters = []
    else:
        drawn = _draw(rows, F.col("size") * (ranges * sample / total), 1)
        splitters = sorted({drawn[len(drawn) * k // ranges] for k in range(1, ranges)}) if drawn else []
        loads = _place(rows, splitters).groupBy("part").count().collect()  # at most ``ranges`` rows
        full = [r["part"] for r in loads if r["count"] > 2 * count / ranges]
        if full:
            even = _draw(_place(rows, splitters).where(F.col("part").isin(full)), F.lit(ranges * sample / count), 2)
            splitters = sorted({*splitters, *even[sample - 1::sample]})
    placed = materialize(_place(rows, splitters))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each range, some hundreds: their running totals fit one task.
    offsets = placed.groupBy("part").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("c")).select(
        "part", F.coalesce(F.sum("b").over(before), F.lit(0)).alias("bytes0"),
        F.coalesce(F.sum("c").over(before), F.lit(0)).alias("rows0"))
    inside = Window.partitionBy("part").orderBy(*_KEY)
    ranked = placed.withColumn("rank", F.row_number().over(inside)).withColumn(
        "upto", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    ranked = materialize(ranked.join(offsets, "part").select(
        "doc_id", "size", "text_crc32", "h", (F.col("rows0") + F.col("rank") - 1).alias("rank"),
        (F.col("bytes0") + F.col("upto") - F.col("size")).alias("start")))
    groups = materialize(ranked.groupBy("h").agg(F.min("start").alias("g0"), F.sum("size").alias("g"), F.count(F.lit(1)).alias("c"))
                         .where((F.col("c") > 1) & (F.col("g") <= slack * total / shards)).select("h", "g0", "g"))
    middle = F.coalesce(2 * F.col("g0") + F.col("g"), 2 * F.col("start") + F.col("size")).cast("decimal(30,0)")
    cut = ranked.join(groups, "h", "left").withColumn(
        "shard", F.floor(middle * shards / F.lit(max(2 * total, 1)).cast("decimal(30,0)")).cast("int"))
    cut = materialize(cut.select("doc_id", "size", "text_crc32", "shard", "rank"))
    firsts = cut.groupBy("shard").agg(F.min("rank").alias("rank0"))
    return cut.join(F.broadcast(firsts), "shard").select(  # one row for each shard
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("rank") - F.col("rank0")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
