"""Skew-safe ordered scans per key (running index, sums, maxima, lags).

A plain ``Window.partitionBy(key).orderBy(ts)`` sends every row of a key to
one task; if one key holds a third of the data, that task holds a third of
the data. Instead:

1. ``repartitionByRange(key, order…)`` cuts the sorted sequence into
   contiguous slices, so a hot key spans many partitions; the slice id is
   checkpointed with the rows (it is physical, so it must be fixed once);
2. a window over ``(partition id, key)`` computes *local* running values
   (its shuffle is keyed by the partition id too, so it is not skewed);
3. one summary row per ``(partition id, key)`` (at most #keys + #partitions
   rows) gives each slice its offsets through a tiny window;
4. the summary is joined back (AQE broadcasts it when its measured size is
   small) and local values are shifted by the offsets.

Neighbour access (``lag(x, k)``) then becomes an equi-join on
``(key, i - k)``: one partner per row, hash-distributed by the index.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.session import materialize


def _n_parts(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def keyed_scan(df: DataFrame, key: str, order: list[str], sums: dict[str, Column] | None = None,
               linear_max: dict[str, tuple[Column, int]] | None = None,
               index: str = "i", n_slices: int | None = None) -> DataFrame:
    """Add the 1-based position ``index`` of each row within its key (in
    ``order``), inclusive running sums (``sums``: name → value) and inclusive
    running maxima of ``x - index * c`` (``linear_max``: name → (x, c)),
    without collecting any key into one task."""
    sums = sums or {}
    linear_max = linear_max or {}
    # The slice id is physical, so it is written down once (checkpoint) and
    # every branch below reads the same assignment, also after task retries.
    r = materialize(df.repartitionByRange(_n_parts(df, n_slices), F.col(key), *[F.col(o) for o in order])
                    .withColumn("_pid", F.spark_partition_id()))
    w = Window.partitionBy("_pid", key).orderBy(*order)
    wr = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = r.withColumn("_li", F.row_number().over(w))
    local = local.select(
        "*",
        *[F.sum(v).over(wr).alias(f"_ls_{n}") for n, v in sums.items()],
        *[F.max(x - F.col("_li") * c).over(wr).alias(f"_lm_{n}") for n, (x, c) in linear_max.items()])

    summ = local.groupBy("_pid", key).agg(
        F.count("*").alias("_cnt"),
        *[F.sum(v).alias(f"_tot_{n}") for n, v in sums.items()],
        *[F.max(x - F.col("_li") * c).alias(f"_pm_{n}") for n, (x, c) in linear_max.items()])
    before = Window.partitionBy(key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    summ = summ.withColumn("_off", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
    summ = summ.select(
        "_pid", key, "_off",
        *[F.coalesce(F.sum(f"_tot_{n}").over(before), F.lit(0)).alias(f"_so_{n}") for n in sums],
        *[F.max(F.col(f"_pm_{n}") - F.col("_off") * c).over(before).alias(f"_pmax_{n}")
          for n, (_, c) in linear_max.items()])
    j = local.join(summ, ["_pid", key])
    out = j.select(
        *df.columns,
        (F.col("_off") + F.col("_li")).alias(index),
        *[(F.col(f"_so_{n}") + F.col(f"_ls_{n}")).alias(n) for n in sums],
        *[F.greatest(F.col(f"_pmax_{n}"), F.col(f"_lm_{n}") - F.col("_off") * c).alias(n)
          for n, (_, c) in linear_max.items()])
    return out


def lag_by_index(df: DataFrame, key, index: str, cols: list[str], k: int = 1,
                 suffix: str = "_prev") -> DataFrame:
    """``lag(col, k)`` per key via a 1:1 equi-join on ``(key…, index - k)``
    (``k < 0`` gives ``lead``). Rows are hash-distributed by the index too, so
    one huge key is spread over all tasks."""
    keys = [key] if isinstance(key, str) else list(key)
    prev = df.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)],
                     (F.col(index) + k).alias("_j"), *[F.col(c).alias(c + suffix) for c in cols])
    cond = F.col(index) == F.col("_j")
    for i, c in enumerate(keys):
        cond = cond & (F.col(c) == F.col(f"_k{i}"))
    return df.join(prev, cond, "left").drop(*[f"_k{i}" for i in range(len(keys))], "_j")


def halo_lags(df: DataFrame, key: str, order: list[str], cols: list[str], lags: list[int],
              n_slices: int | None = None) -> DataFrame:
    """Add ``lag(col, k)`` per key, in ``order``, as ``<col>_lag<k>`` for each
    ``k`` of ``lags``. No index and no self-join: rows are range-partitioned by
    ``(key, order)`` and each slice takes the last ``max(lags)`` rows of the
    key before it as a halo, so all lags are one window inside the slice and
    rows are shuffled twice, however many lags there are.

    What travels beside the rows is the last ``max(lags)`` rows of each slice
    and key. A null key is a key of its own; ties in ``order`` give either
    order, as a plain window does; an empty table gives an empty one."""
    k = max(lags)
    rows = materialize(df.repartitionByRange(_n_parts(df, n_slices), F.col(key), *[F.col(o) for o in order])
                       .withColumn("_pid", F.spark_partition_id()))
    need = list(dict.fromkeys([*order, *cols]))
    counts = rows.groupBy("_pid", key).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    counts = materialize(counts.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0))))
    # The ranking is cut to k rows before the shuffle (window group limit).
    back = Window.partitionBy("_pid", key).orderBy(*[F.col(o).desc() for o in order])
    tails = rows.select("_pid", key, *[c for c in need if c != key]) \
        .withColumn("_r", F.row_number().over(back)).where(F.col("_r") <= k)
    c, t = counts.alias("c"), tails.alias("t")
    placed = t.join(c, F.col(f"t.{key}").eqNullSafe(F.col(f"c.{key}")) & (F.col("t._pid") == F.col("c._pid"))).select(
        "t.*", (F.col("c._off") + F.col("c._n") - F.col("t._r") + 1).alias("_i"))
    # Row i is in the halo of the slices that start after i, ..., i + k - 1 rows.
    reach = placed.select("*", F.explode(F.expr(f"sequence(_i, _i + {k - 1})")).alias("_at")).alias("h")
    halo = reach.join(c, F.col(f"h.{key}").eqNullSafe(F.col(f"c.{key}")) & (F.col("h._at") == F.col("c._off"))
                      & (F.col("c._pid") > F.col("h._pid")))
    halo = halo.select(F.col("c._pid").alias("_pid"), F.col(f"h.{key}").alias(key),
                       *[F.col(f"h.{x}").alias(x) for x in need if x != key], F.lit(True).alias("_halo"))
    both = rows.withColumn("_halo", F.lit(False)).unionByName(halo, allowMissingColumns=True)
    w = Window.partitionBy("_pid", key).orderBy(F.col("_halo").desc(), *order)
    lagged = both.select("*", *[F.lag(x, n).over(w).alias(f"{x}_lag{n}") for x in cols for n in lags])
    return lagged.where(~F.col("_halo")).select(*df.columns, *[f"{x}_lag{n}" for x in cols for n in lags])
