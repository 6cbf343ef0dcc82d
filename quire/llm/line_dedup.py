"""Removal of lines that many documents share.

Normalised lines are exploded and hashed (128 bits), the distinct documents of
each hash are counted, and lines of a hash at or over the threshold go; what
is left is put together by position. Only hashes travel in the count (a
document sends each of its lines once, and counts are combined before the
shuffle); only (text, position) of dropped lines travel afterwards, and equal
texts share them.

A line's key is the line without blanks and \\x09-\\x0D at both ends, A-Z in
lower case. Keys shorter than ``least`` code points are never dropped.

Defined results: a null text is one empty line; a document is a number, so
rows of equal number count once, and all rows of null number count as one
document; rows of equal text get equal results; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.repeats import text_class
from quire.llm.sieve import sieved
from quire.session import materialize

LEAST = 1
DOCUMENTS = 10
#: White space cut from both ends of a line.
BLANK = b"\x20\x09\x0a\x0b\x0c\x0d"


def keys(text: str | None, least: int) -> list[bytes | None]:
    """The hash of each line's key, None for keys that are too short."""
    # bytes.lower() changes A-Z alone.
    lines = [x.strip(BLANK) for x in (text or "").encode().lower().split(b"\n")]
    return [hashlib.blake2b(x, digest_size=16).digest()
            if len(x) >= 4 * least or len(x.decode()) >= least else None for x in lines]


def _lines(least: int, once: bool):
    def work(batches):
        for b in batches:
            name = b.schema.names[0]
            for k, text in enumerate(b.column("text").to_pylist()):
                found = keys(text, least)
                if once:
                    hashes, at = list({h for h in found if h is not None}), None
                else:
                    at = [p for p, h in enumerate(found) if h is not None]
                    hashes = [found[p] for p in at]
                if not hashes:
                    continue
                cols = [b.column(name).take(pa.array(np.full(len(hashes), k))), pa.array(hashes, pa.binary())]
                cols += [] if once else [pa.array(at, pa.int32())]
                yield pa.RecordBatch.from_arrays(cols, [name, "h"] + ([] if once else ["at"]))
    return work


def common_lines(docs: DataFrame, least: int, documents: int) -> DataFrame:
    """(h): hashes of keys found in ``documents`` documents at least."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("did"), "text")
    spread = rows.mapInArrow(_lines(least, True), "did long, h binary")
    return spread.groupBy("h").agg(F.count_distinct("did").alias("c")).where(F.col("c") >= documents).select("h")


def _rebuild(batches):
    for b in batches:
        out = []
        for text, gone in zip(b.column("text").to_pylist(), b.column("gone").to_pylist()):
            lines = (text or "").split("\n")
            drop = set(gone or ())
            out.append((len(lines), len(drop), "\n".join(x for p, x in enumerate(lines) if p not in drop)))
        cols = list(zip(*out)) if out else [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:2]), pa.array(cols[2], pa.string())],
            ["doc_id", "n_lines", "n_dropped", "kept"])


def drop_lines(docs: DataFrame, least: int = LEAST, documents: int = DOCUMENTS) -> DataFrame:
    """doc_id, n_lines, n_dropped and the kept lines of each document."""
    common = materialize(common_lines(docs, least, documents))
    texts = docs.select(text_class().alias("cls"), "text")
    places = sieved(texts.mapInArrow(_lines(least, False), "cls binary, h binary, at int"), common, ["h"])
    # A list is as long as its text has lines at most.
    marks = materialize(places.join(common, "h").groupBy("cls").agg(F.collect_set("at").alias("gone")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_class().alias("cls"), "text")
    return rows.join(marks, "cls", "left").select("doc_id", "text", "gone").mapInArrow(
        _rebuild, "doc_id long, n_lines long, n_dropped long, kept string")


def digest(kept: DataFrame) -> DataFrame:
    """The query's columns: kept lines as their SHA-256."""
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
