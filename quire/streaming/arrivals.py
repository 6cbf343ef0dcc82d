"""Arrivals of parts with a state store (X1 = J5 + U1 as a stream).

Which parts are already there is kept as state by key, next to the stream's
offsets, so a run reads neither its output nor old input. Each batch of new
files is first cut to the least row of a key (an aggregation of the batch
alone); these rows are the input of a second stream, whose state drops keys
that came before. The output is Spark's own exactly-once file sink: files of a
batch become visible together, and a batch that dies is done again from the
same offsets and state. All steps are Spark's own, with no Python for a key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def least_rows(batch: DataFrame, keys: list[str]) -> DataFrame:
    """One row of each key: the least, compared column by column (nulls last),
    so the result does not hang on the order of rows."""
    rest = [c for c in batch.columns if c not in keys]
    if not rest:
        return batch.select(*keys).distinct()
    value = F.struct(*[F.struct(F.col(c).isNull().alias("none"), F.col(c).alias("v")).alias(f"c{i}")
                       for i, c in enumerate(rest)])
    least = batch.groupBy(*keys).agg(F.min(value).alias("_least"))
    out = {c: F.col(f"_least.c{i}.v").alias(c) for i, c in enumerate(rest)}
    return least.select(*[out.get(c, F.col(c)) for c in batch.columns])


def first_arrivals(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of a stream whose batches hold a key once: each key's row, as it first
    came. The keys are the state."""
    return rows.dropDuplicates(keys)


def run_arrivals(spark: SparkSession, input_dir: str, schema: T.StructType, output_dir: str,
                 checkpoint_dir: str, keys: list[str]) -> None:
    """Take in every file that came since the last run and end. Input files
    are Parquet; a file that is listed twice is read once. Of several rows of
    one key in a batch the least counts. At scale set
    ``spark.sql.streaming.stateStore.providerClass`` to the RocksDB provider."""
    least = f"{checkpoint_dir}/least"

    def take(batch: DataFrame, epoch: int) -> None:
        # A batch that is done again leaves the same rows once more, and their
        # keys are in the state by then. The next one starts after this one's
        # rows are taken, so no two batches meet in the second stream.
        least_rows(batch, keys).write.mode("append").parquet(least)
        new = spark.readStream.schema(schema).parquet(least)
        (first_arrivals(new, keys).writeStream.format("parquet").option("path", output_dir)
         .option("checkpointLocation", f"{checkpoint_dir}/first").outputMode("append")
         .trigger(availableNow=True).start().awaitTermination())

    rows = spark.readStream.schema(schema).parquet(input_dir)
    (rows.writeStream.foreachBatch(take).option("checkpointLocation", f"{checkpoint_dir}/arrived")
     .trigger(availableNow=True).start().awaitTermination())
