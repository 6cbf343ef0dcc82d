"""Long files from many rows (K5, K1): one file for each key, written by many
tasks at once.

A file's rows are never in one cell, group or task. The sizes of the rows
(keys and numbers only) are scanned in slices, which gives every row its place
in its file; then the rows are sorted in range partitions, and each task
streams its stretch of bytes to that place. The same row goes to the same place
whichever attempt writes it, so a repeated or a second, late attempt changes
nothing. Files get their names only when all bytes are there.

Writing at a place needs a folder that every executor mounts; stores that can
only write a file from its start are refused by an error.
"""

from __future__ import annotations

import os
import uuid
from urllib.parse import unquote, urlparse

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.operators.scan import keyed_scan
from quire.session import materialize

#: Bytes that a task gathers before it writes them.
BUFFER = 4 << 20


def mounted(path: str) -> str:
    """The folder of a ``file:`` URI or plain path."""
    u = urlparse(path)
    if u.scheme not in ("", "file"):
        raise ValueError(f"files are written at offsets, which {u.scheme}: does not allow")
    return unquote(u.path) if u.scheme else path


def stream_files(rows: DataFrame, key: str, order: str, text: Column, name: Column, base: str,
                 head: Column | None = None, between: str = "\n", tail: str = "",
                 n_slices: int | None = None) -> DataFrame:
    """Write ``head + text + between + text + … + tail`` of each ``key``, in
    ``order``, to ``base/<name>``; returns the files (name, n_bytes, n_rows).

    ``name`` is an expression of ``key``; ``head`` may also use ``n_rows``, the
    key's number of rows. Null texts are empty ones; a null key is a key of its
    own if ``name`` names it. Each ``(key, order)`` is one row, else ValueError:
    ties would have no defined place. No rows, no files."""
    folder = mounted(base).rstrip("/")
    head = F.lit("") if head is None else head
    pieces = rows.select(F.col(key).alias("_key"), F.col(order).alias("_order"), F.coalesce(text, F.lit("")).alias("_text"))
    # The sizes are written beside the texts, so that the scans of keys and
    # sizes below read no text.
    pieces = materialize(pieces.withColumn("_n", (F.octet_length("_text") + len(between.encode())).cast("long")))
    sizes = pieces.select("_key", "_order", "_n")
    # A null key gets a value of its own that no text can be, so that the
    # scan's joins keep it.
    sizes = sizes.withColumn("_k", F.to_json(F.struct("_key")))
    placed = keyed_scan(sizes, "_k", ["_order"], {"_end": F.col("_n")}, index="_i", n_slices=n_slices)
    placed = materialize(placed.select("_k", "_order", "_i", (F.col("_end") - F.col("_n")).alias("_at")))
    twice = placed.groupBy("_k", "_order").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not twice.isEmpty():
        raise ValueError(f"two rows for one place: {twice.first()}")
    heads = sizes.groupBy("_k", F.col("_key").alias(key)).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("_n").alias("_body"))
    heads = heads.select("_k", "n_rows", "_body", name.alias("_name"), F.coalesce(head, F.lit("")).alias("_head"))
    heads = materialize(heads)
    clash = heads.groupBy("_name").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or _name is null")
    if not clash.isEmpty():
        raise ValueError(f"two files of one name: {clash.first()}")
    # A row's place travels to it as a row of its own, sorted just before it:
    # the texts are shuffled once, and by range.
    first, last = F.col("_i") == 1, F.col("_i") == F.col("n_rows")
    places = placed.join(heads, "_k").select(
        "_k", "_order", F.lit(None).cast("string").alias("_text"), "_name",
        (F.col("_at") + F.when(first, 0).otherwise(F.octet_length("_head"))).alias("_at"),
        F.when(first, F.col("_head")).otherwise("").alias("_before"), F.when(last, F.lit(tail)).otherwise(between).alias("_after"))
    texts = pieces.select(F.to_json(F.struct("_key")).alias("_k"), "_order", "_text")
    run = uuid.uuid4().hex
    parts = [n_slices] if n_slices else []
    both = places.unionByName(texts, allowMissingColumns=True)
    written = both.repartitionByRange(*parts, "_k", "_order").sortWithinPartitions("_k", "_order", F.col("_text").isNotNull()) \
        .select("_text", "_name", "_at", "_before", "_after").mapInPandas(_writer(f"{folder}/_attempts/{run}"), "name string, n long")
    written = materialize(written).groupBy("name").agg(F.sum("n").alias("n_bytes"))
    want = heads.select(F.col("_name").alias("name"), "n_rows", (
        F.octet_length("_head") + F.col("_body") - len(between.encode()) + len(tail.encode())).alias("_want"))
    files = materialize(want.join(written, "name", "left"))
    short = files.where(~F.col("n_bytes").eqNullSafe(F.col("_want")))
    if not short.isEmpty():
        raise OSError(f"incomplete: {short.first()}")
    files.select("name", "n_bytes").foreachPartition(_namer(f"{folder}/_attempts/{run}", folder))
    return files.select("name", "n_bytes", "n_rows")


def _writer(folder: str):
    def write(batches):
        """Stretches of one file go out in buffers; yields the bytes written."""
        name, at, buffer, out, total, spot = None, 0, bytearray(), None, 0, None

        def flush():
            nonlocal at
            view = memoryview(bytes(buffer))
            while view:
                n = os.pwrite(out, view, at)
                at, view = at + n, view[n:]
            buffer.clear()

        def close():
            flush()
            os.fsync(out)
            os.close(out)
            return pd.DataFrame([(name, total)], columns=["name", "n"])

        for pdf in batches:
            for text, file, place, before, after in pdf.itertuples(index=False):
                if not isinstance(text, str):
                    spot = (file, place, before, after)
                    continue
                file, place, before, after = spot
                if file != name:
                    if out is not None:
                        yield close()
                    path = f"{folder}/{file}"
                    os.makedirs(os.path.dirname(path), exist_ok=True)
                    name, total, out = file, 0, os.open(path, os.O_WRONLY | os.O_CREAT, 0o644)
                    at = int(place)
                data = f"{before}{text}{after}".encode()
                buffer += data
                total += len(data)
                if len(buffer) >= BUFFER:
                    flush()
        if out is not None:
            yield close()

    return write


def _namer(attempts: str, folder: str):
    def rename(rows):
        for r in rows:
            source, target = f"{attempts}/{r['name']}", f"{folder}/{r['name']}"
            os.makedirs(os.path.dirname(target), exist_ok=True)
            if os.path.exists(source):
                if os.path.getsize(source) != r["n_bytes"]:
                    raise OSError(f"{source}: {os.path.getsize(source)} bytes, not {r['n_bytes']}")
                os.replace(source, target)
            elif not os.path.exists(target) or os.path.getsize(target) != r["n_bytes"]:
                raise FileNotFoundError(source)

    return rename
