"""J1 as a sweep: which ranges hold each point, for keys of any size.

``pages.assign_pages`` joins on the book and checks the bounds, which compares
every page with every chapter of its book. Here starts, ends and points are
sorted together and passed once, with the set of open ranges as state:

1. starts, ends and points are range-partitioned by ``(key, position)``; the
   slice of every row is written down, so a book of very many pages is spread
   over many tasks;
2. a range that is open when a slice begins is known from the slices of its
   start and its end; one row for each such slice carries it in;
3. each slice is passed in order. Between two events the open ranges are the
   same, so all points there are answered at once.

The work is rows plus results plus carried ranges; nothing is compared that
does not meet.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quire.session import materialize

_CARRIED, _END, _START, _POINT = range(4)


def _pass(range_id: str, names: list[str]):
    def work(batches):
        slice_no, open_ = None, {}
        for b in batches:
            pid, kind = b.column("_pid").to_numpy(), b.column("_kind").to_numpy()
            event = kind != _POINT
            new = np.ones(len(pid), bool)
            new[1:] = pid[1:] != pid[:-1]
            stops = np.flatnonzero(event | new)
            # Ranges are read only where there is an event.
            at = pa.array(stops)
            rid, value = b.column("_rid").take(at).to_pylist(), b.column("_value").take(at).to_pylist()
            rows, values, done = [], [], 0
            for n, e in enumerate([*stops.tolist(), len(pid)]):
                if open_ and e > done:
                    for v in open_.values():
                        rows.append(np.arange(done, e))
                        values.append(np.full(e - done, v, np.int64))
                if e == len(pid):
                    break
                if pid[e] != slice_no:
                    slice_no, open_ = pid[e], {}
                done = e
                if event[e]:
                    done = e + 1
                    if kind[e] == _END:
                        open_.pop(rid[n], None)
                    else:
                        open_[rid[n]] = value[n]
            if rows:
                found = b.column("_row").take(pa.array(np.concatenate(rows)))
                yield pa.RecordBatch.from_arrays([*found.flatten(), pa.array(np.concatenate(values))], [*names, range_id])
    return work


def sweep_join(points: DataFrame, ranges: DataFrame, key: str, at: str, start: str, end: str, range_id: str,
               n_slices: int | None = None) -> DataFrame:
    """The rows of ``points``, each with the ``range_id`` (long) of every range
    of its key with ``start <= at < end``.

    Empty and reversed ranges hold nothing; overlapping ones each give a row,
    also equal ones; a null key, bound or position meets nothing; an empty
    table gives no rows. The state of a task is the ranges open at once."""
    n = n_slices or int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    r = materialize(ranges.where(F.col(key).isNotNull() & (F.col(start) < F.col(end))).select(
        F.col(key).alias("_key"), F.col(start).cast("long").alias("_s"), F.col(end).cast("long").alias("_e"),
        F.col(range_id).cast("long").alias("_value"), F.monotonically_increasing_id().alias("_rid")))
    row = F.struct(*[F.col(c) for c in points.columns])
    rows = points.where(F.col(key).isNotNull() & F.col(at).isNotNull()).select(
        F.col(key).alias("_key"), F.col(at).cast("long").alias("_pos"), F.lit(_POINT).alias("_kind"), row.alias("_row"))
    for kind, pos in ((_START, "_s"), (_END, "_e")):
        rows = rows.unionByName(r.select("_key", F.col(pos).alias("_pos"), F.lit(kind).alias("_kind"), "_rid", "_value"),
                                allowMissingColumns=True)
    placed = materialize(rows.repartitionByRange(n, "_key", "_pos", "_kind").withColumn("_pid", F.spark_partition_id()))
    carried = placed.where(F.col("_kind") != _POINT).groupBy("_rid").agg(
        F.first("_key").alias("_key"), F.first("_value").alias("_value"),
        F.min("_pid").alias("_a"), F.max("_pid").alias("_z")).where("_a < _z").select(
        "_rid", "_key", "_value", F.lit(_CARRIED).alias("_kind"), F.explode(F.expr("sequence(_a + 1, _z)")).alias("_pid"))
    sweep = placed.unionByName(carried, allowMissingColumns=True).repartition(n, "_pid") \
        .sortWithinPartitions("_pid", "_key", F.col("_pos").asc_nulls_first(), "_kind")
    schema = StructType([*points.schema.fields, StructField(range_id, LongType())])
    return sweep.select("_pid", "_kind", "_rid", "_value", "_row").mapInArrow(_pass(range_id, points.columns), schema)
