"""Files that appear whole or not at all (K1, K8).

Each task writes its files under ``_attempts/<run>/`` with a name of its own
for every attempt, and returns one manifest row for each. Spark keeps the rows
of successful attempts only, so when all files are written the manifest names
exactly one copy of each. Then the copies are renamed, in parallel; a rename
that is repeated finds its work done. What a killed attempt leaves has a name
that no manifest lists, in a folder that readers skip.
"""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MANIFEST = "dir string, name string, attempt string, n_bytes long"


def write_attempts(files: DataFrame, base: str, run: str) -> DataFrame:
    """Write (dir, name, content) rows under attempt names; the manifest."""
    def write(batches):
        from pyarrow import fs as pafs
        from pyspark import TaskContext
        task = TaskContext.get()
        filesystem, root = pafs.FileSystem.from_uri(base)
        folder = f"{root}/_attempts/{run}"
        filesystem.create_dir(folder, recursive=True)
        mark = f"{task.partitionId()}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        n = 0
        for pdf in batches:
            rows = []
            for r in pdf.itertuples():
                attempt = f"{folder}/{mark}-{n}"
                n += 1
                with filesystem.open_output_stream(attempt) as out:
                    out.write(bytes(r.content))
                rows.append((r.dir, r.name, attempt, len(r.content)))
            yield pd.DataFrame(rows, columns=["dir", "name", "attempt", "n_bytes"])

    return files.select("dir", "name", "content").mapInPandas(write, MANIFEST)


def commit(manifest: DataFrame, base: str) -> None:
    """Give every listed copy its final name; safe to repeat."""
    def rename(rows):
        from pyarrow import fs as pafs
        filesystem, root = pafs.FileSystem.from_uri(base)
        for r in rows:
            folder = f"{root}/{r['dir']}"
            filesystem.create_dir(folder, recursive=True)
            if filesystem.get_file_info(r["attempt"]).type != pafs.FileType.NotFound:
                filesystem.move(r["attempt"], f"{folder}/{r['name']}")
            elif filesystem.get_file_info(f"{folder}/{r['name']}").size != r["n_bytes"]:
                raise FileNotFoundError(r["attempt"])

    manifest.foreachPartition(rename)


def write_files(files: DataFrame, base: str) -> DataFrame:
    """One file for each row (``base/<dir>/<name>``); returns the manifest,
    which stays in ``base/_manifests/``. Names must differ: a job with two rows
    of one name fails before anything is visible. ``base`` is a folder that
    all executors see."""
    run = uuid.uuid4().hex
    spark = files.sparkSession
    path = f"{base.rstrip('/')}/_manifests/{run}"
    write_attempts(files, base, run).write.parquet(path)
    manifest = spark.read.parquet(path)
    twice = manifest.groupBy("dir", "name").agg(F.count("*").alias("n")).where("n > 1")
    if not twice.isEmpty():
        raise ValueError(f"two contents for one file: {twice.first()}")
    commit(manifest, base)
    return manifest
