"""A bounded broadcast bitmap that keeps most rows without a partner out of
an exact join's shuffle.

The bitmap has ``WORDS`` words of 64 bits, so what is broadcast is at most
``WORDS`` rows of two longs (16 MB) whatever the data. Beyond some ten million
keys it lets most rows pass and the exact join does all the work; it never
drops a row that has a partner.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS = 1 << 20


def _tagged(rows: DataFrame, keys: DataFrame, by: list[str]) -> DataFrame:
    spot = F.pmod(F.xxhash64(*by), F.lit(WORDS * 64))
    bits = keys.select(spot.alias("_spot")).select(
        F.expr("shiftright(_spot, 6)").alias("_word"), F.expr("shiftleft(1L, int(_spot & 63))").alias("_bit")) \
        .groupBy("_word").agg(F.expr("bit_or(_bit)").alias("_bits"))
    rows = rows.withColumn("_spot", spot).withColumn("_word", F.expr("shiftright(_spot, 6)"))
    return rows.join(F.broadcast(bits), "_word", "left").withColumn(
        "_may", F.coalesce(F.expr("shiftright(_bits, int(_spot & 63)) & 1 = 1"), F.lit(False)))


def sieved(rows: DataFrame, keys: DataFrame, by: list[str]) -> DataFrame:
    """Rows whose ``by`` columns may occur in ``keys``."""
    return _tagged(rows, keys, by).where("_may").select(*rows.columns)


def parted(rows: DataFrame, keys: DataFrame, by: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose ``by`` columns may occur in ``keys``, and those that cannot:
    the latter need no join."""
    tagged = _tagged(rows, keys, by)
    return tagged.where("_may").select(*rows.columns), tagged.where("not _may").select(*rows.columns)
