"""Files written at offsets and paged files read by byte ranges."""

import io
import json
import random

import pytest
from pyspark.sql import functions as F

from quire.operators import catalog as CT
from quire.plans import queries as Q
from quire.sinks import stream as ST
from quire.sources import paged as SP


def _written(folder):
    return {p.name: p.read_bytes().decode() for p in folder.iterdir() if p.is_file() and not p.name.startswith((".", "_"))}


@pytest.mark.parametrize("n_slices, buffer", [(1, 1), (7, 50), (40, 1 << 20)])
def test_stream_files(spark, tmp_path, monkeypatch, n_slices, buffer):
    """A hot key over many tasks, one-row keys, a null key, null, empty and
    many-byte texts."""
    monkeypatch.setattr(ST, "BUFFER", buffer)
    r = random.Random(n_slices)
    rows = [(k, i, r.choice([None, "", "a", "ü€😀" * r.randrange(9)]), "x") for k, n in ((1, 300), (2, 1), (None, 3), (5, 20))
            for i in r.sample(range(1000), n)]
    df = spark.createDataFrame(rows, "k int, o int, t string, _name string").repartition(6)
    files = ST.stream_files(df, "k", "o", F.col("t"), F.concat(F.lit("f"), F.coalesce(F.col("k").cast("string"), F.lit("none"))),
                            str(tmp_path), head=F.concat(F.lit("é"), F.col("n_rows").cast("string"), F.lit(":")),
                            between=" ¦ ", tail="$", n_slices=n_slices)
    want = {}
    for k in (1, 2, None, 5):
        texts = [t or "" for kk, o, t, _ in sorted((x for x in rows if x[0] == k), key=lambda x: x[1])]
        want[f"f{'none' if k is None else k}"] = f"é{len(texts)}:" + " ¦ ".join(texts) + "$"
    assert _written(tmp_path) == want
    assert {(f.name, f.n_bytes) for f in files.collect()} == {(k, len(v.encode())) for k, v in want.items()}


def test_stream_files_refuses(spark, tmp_path):
    df = spark.createDataFrame([(1, 1, "a"), (1, 1, "b")], "k int, o int, t string")
    with pytest.raises(ValueError, match="one place"):
        ST.stream_files(df, "k", "o", F.col("t"), F.lit("f"), str(tmp_path))
    with pytest.raises(ValueError, match="one name"):
        ST.stream_files(df.withColumn("k", F.col("t")), "k", "o", F.col("t"), F.lit("f"), str(tmp_path))
    with pytest.raises(ValueError, match="offsets"):
        ST.stream_files(df, "k", "o", F.col("t"), F.lit("f"), "s3://bucket/x")
    assert ST.stream_files(df.limit(0), "k", "o", F.col("t"), F.lit("f"), str(tmp_path)).count() == 0
    assert _written(tmp_path) == {}


def test_a_second_attempt_changes_nothing(tmp_path):
    import pandas as pd
    rows = pd.DataFrame([(None, "a", 3, "", "y"), ("x", *[None] * 4), (None, "a", 5, "", ""), ("z", *[None] * 4),
                         (None, "b", 0, "q", ""), ("", *[None] * 4)], columns=["_text", "_name", "_at", "_before", "_after"])
    for _ in range(2):
        assert pd.concat(ST._writer(str(tmp_path))([rows])).values.tolist() == [["a", 3], ["b", 1]]
    assert (tmp_path / "a").read_bytes() == b"\0\0\0xyz"
    ST._namer(str(tmp_path), str(tmp_path / "out"))([{"name": "b", "n_bytes": 1}])
    ST._namer(str(tmp_path), str(tmp_path / "out"))([{"name": "b", "n_bytes": 1}])
    with pytest.raises(OSError):
        ST._namer(str(tmp_path), str(tmp_path / "out"))([{"name": "a", "n_bytes": 9}])


def test_book_stream_is_the_export(spark, small, tmp_path):
    chapters = Q._export_chapters(spark, small)
    title = F.format_string('Book "%d"\\', F.col("book_id"))
    CT.write_book_export(chapters, title, str(tmp_path))
    want = {f"{r.book_id}.json": json.loads(r.json) for r in CT.book_export(chapters, title).collect()}
    assert {k: json.loads(v) for k, v in _written(tmp_path).items()} == want


def test_many_books_are_one_listing(spark, tmp_path):
    """The files are listed without a job, small ones read in few tasks, and
    each line loses one comma, whatever its text ends with."""
    n = 40
    chapters = spark.range(2 * n).select(
        (F.col("id") % n).alias("book_id"), (F.col("id") / n).cast("int").alias("number"), F.lit("t,").alias("title"),
        F.lit("o").alias("original"), F.lit(",,\n,").alias("translation"), F.lit("").alias("summary"), F.lit(",").alias("audio"))
    n_bytes = CT.write_book_export(chapters, F.lit("b"), str(tmp_path)).agg(F.sum("n_bytes")).first()[0]
    (tmp_path / "other.txt").write_text('{"number":9}\n')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
        spark.sparkContext.setJobGroup("listing", "listing")
        lines = CT.read_book_export(spark, str(tmp_path), n_bytes)
        spark.sparkContext.setJobGroup("rest", "rest")
        assert not list(spark.sparkContext.statusTracker().getJobIdsForGroup("listing"))
        assert lines.rdd.getNumPartitions() <= int(spark.conf.get("spark.sql.shuffle.partitions")) < n
        got = sorted(tuple(r) for r in lines.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == sorted((b, k, "t,", "o...", ",,\n,", "", ",") for b in range(n) for k in range(2))


@pytest.mark.parametrize("separator", [b"\f", b"\n-", b"\r\n-"])
def test_pages_of_ranges(separator):
    """Every page once, for all ways to cut small files, with separators over
    the borders of ranges and blocks."""
    r = random.Random(len(separator))
    for _ in range(300):
        pages = [bytes(r.choice(b"ab\r\n-") for _ in range(r.choice([0, 1, 2, 9]))) for _ in range(r.randrange(1, 7))]
        data = separator.join(pages)
        cut, want, at = data.split(separator), [], 0
        for p in cut:
            want.append((at, p))
            at += len(p) + len(separator)
        if not cut[-1]:
            want.pop()
        size, block = r.randrange(1, 12), r.randrange(1, 6)
        got = [x for a in range(0, len(data), size)
               for x in SP.pages_of_range(io.BytesIO(data), a, min(a + size, len(data)), separator, block)]
        assert got == want, (data, size, block)


def test_ranges_are_packed():
    ranges = [("a", 0, 100), ("a", 100, 150), *[(c, 0, 1) for c in "bcdefgh"]]
    lists = SP.packed(ranges, 100)
    assert [r for x in lists for r in x] == ranges
    assert all(len(x) == 1 or sum(z - a for _, a, z in x) <= 100 for x in lists)
    assert SP.packed([], 100) == []
    assert len(SP.packed([(str(i), 0, 10) for i in range(1000)], 64 << 20)) == 1


def test_read_pages(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.txt").write_bytes("é\f\fz\n\f".encode())
    (tmp_path / "sub" / "b.txt").write_bytes(b"x" * 5000 + b"\f\xffy")
    (tmp_path / "empty.txt").write_bytes(b"")
    (tmp_path / "_hidden").write_bytes(b"no")
    rows = {(r.file.rsplit("/", 1)[1], r.page_no): r.text for r in SP.read_pages(spark, str(tmp_path), split=3).collect()}
    assert rows == {("a.txt", 1): "é", ("a.txt", 2): "", ("a.txt", 3): "z\n", ("b.txt", 1): "x" * 5000, ("b.txt", 2): "�y"}
    with pytest.raises(ValueError, match="overlap"):
        SP.PagedReader({"path": str(tmp_path), "separator": "--"})
    (tmp_path / "none").mkdir()
    assert SP.read_pages(spark, str(tmp_path / "none")).count() == 0
