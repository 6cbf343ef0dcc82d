"""Sinks (K1–K8): partitioned text / JSON / Parquet writes.

Every sink writes a DataFrame in one distributed job, partitioned by the
book and chapter keys so that re-running one chapter replaces only its
directory (dynamic partition overwrite, K2/M9). Nothing passes through
the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import text as T


def chapter_dir(number: Column) -> Column:
    """Directory value that carries the file stem ``chapter_NN``."""
    return F.concat(F.lit("chapter_"), T.zero_pad(number))


def write_text_files(df: DataFrame, path: str, text_col: str, partition_cols: list[str],
                     mode: str = "overwrite") -> None:
    """K1/K2/K6: one text value per partition directory. With
    ``partitionOverwriteMode=dynamic`` only the written partitions change."""
    (df.select(*partition_cols, F.col(text_col).alias("value"))
       .repartition(*partition_cols)
       .write.mode(mode).partitionBy(*partition_cols).text(path))


def write_non_empty(df: DataFrame, path: str, text_col: str, partition_cols: list[str]) -> None:
    """K3: write only rows whose text is non-empty."""
    write_text_files(df.where(F.col(text_col) != ""), path, text_col, partition_cols)


def write_parquet(df: DataFrame, path: str, partition_cols: list[str] | None = None,
                  mode: str = "overwrite") -> None:
    """K8 and every intermediate table: Parquet (BINARY columns included)."""
    w = df.write.mode(mode)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(path)


def replace_partition(fresh: DataFrame, path: str, partition_cols: list[str]) -> None:
    """K2/M9: the partitions that ``fresh`` has rows for are replaced, all
    other files of the table stay as they are."""
    (fresh.repartition(*partition_cols).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols).parquet(path))


def formatted_name(file_name: Column) -> Column:
    """K7: ``{stem}_formatted.md`` next to the source file."""
    return F.concat(F.regexp_replace(file_name, r"\.[^.]*$", ""), F.lit("_formatted.md"))


def write_binary_files(df: DataFrame, base: str, dir_col: str, name_col: str, content_col: str) -> None:
    """K8 at the edge: one file per row (``base/<dir>/<name>``), written by the
    executors through ``pyarrow.fs`` (local, HDFS or object-store URIs), so
    no bytes pass through the driver."""
    def write(rows):
        from pyarrow import fs as pafs
        filesystem, root = pafs.FileSystem.from_uri(base)
        for r in rows:
            folder = f"{root}/{r[dir_col]}"
            filesystem.create_dir(folder, recursive=True)
            with filesystem.open_output_stream(f"{folder}/{r[name_col]}") as out:
                out.write(bytes(r[content_col]))

    df.select(dir_col, name_col, content_col).foreachPartition(write)
