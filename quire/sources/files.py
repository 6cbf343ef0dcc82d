"""File sources (S2–S6, S9): whole-text files, JSON arrays, binary parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def key_from_name(name: Column, prefix: str = "chapter") -> Column:
    """S3: ``int(stem.split('_')[1])`` as a NULL-safe parse of ``prefix_NN``."""
    return F.regexp_extract(name, rf"{prefix}_(\d+)", 1).try_cast("int")


def read_text_files(spark: SparkSession, path: str, glob: str | None = None,
                    strip_final_newline: bool = True) -> DataFrame:
    """One row per file (``wholetext``), with its path and name.

    Partition directories (``key=value``) become columns. The text sink
    ends every value with a newline, which is removed again here.
    """
    r = spark.read
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.text(path, wholetext=True)
    value = F.regexp_replace("value", r"\n\z", "") if strip_final_newline else F.col("value")
    return df.select("*", F.col("_metadata.file_path").alias("file_path"),
                     F.col("_metadata.file_name").alias("file_name")).withColumn("value", value)


def read_json_arrays(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON files each holding an array of objects → one row per object."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_binary_parts(spark: SparkSession, path: str, glob: str = "*.mp3") -> DataFrame:
    """Binary part files with S3 keys parsed from their names."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return df.select("*",
                     key_from_name(name, "chapter").alias("chapter_no"),
                     F.regexp_extract(name, r"_part(\d+)", 1).try_cast("int").alias("part_no"))


def lookup_chapter(df: DataFrame, chapter_no: int, col: str = "chapter_no") -> DataFrame:
    """One chapter by its partition column; a missing one is an error
    the caller sees (the check is a cheap ``isEmpty`` on a pruned scan)."""
    out = df.where(F.col(col) == chapter_no)
    if out.isEmpty():
        raise FileNotFoundError(f"chapter {chapter_no} not found")
    return out


def first_path(df: DataFrame, path_col: str = "file_path") -> Column:
    """A deterministic 'first file found' (smallest path)."""
    return F.min(path_col)
