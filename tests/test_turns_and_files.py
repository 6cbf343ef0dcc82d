"""Request/response pairing, size gates, partition replacement, arrivals with
state and committed files."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from quire.functions import constants as C
from quire.operators import model as MD
from quire.operators import parts as PT
from quire.sinks import committed as CF
from quire.sinks import files as SK
from quire.sources import files as SF
from quire.streaming.arrivals import run_arrivals


@pytest.fixture
def turns(spark):
    req = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 3, None), (2, 1, ""), (None, 1, "no key")],
                                "conv_id long, part_no int, input string")
    res = spark.createDataFrame(
        [(1, 1, 5, "late"), (1, 1, 3, "B"), (1, 1, 3, "A"), (1, 3, 1, None), (1, 9, 1, "to no request"), (7, 1, 1, "stray"),
         (None, 1, 1, "x"), (2, 1, 0, "")], "conv_id long, part_no int, turn long, output string")
    return req, res


@pytest.mark.parametrize("policy,lost", [("sentinel", C.FAILED_CHUNK_TEXT % 2), ("empty", ""), ("passthrough", "b"), ("null", None)])
def test_every_request_has_its_answer(turns, policy, lost):
    got = {(r.conv_id, r.part_no): r for r in MD.pair_responses(*turns, ["conv_id"], ["turn"], on_failure=policy).collect()}
    assert set(got) == {(1, 1), (1, 2), (1, 3), (2, 1)}
    assert got[1, 1].output == "A" and got[1, 1].status == "ok"  # first turn, ties by text
    assert got[1, 2].output == lost and got[1, 2].status == "failed"
    assert got[1, 3].status == "failed"  # a null answer is none
    assert got[2, 1].output == "" and got[2, 1].status == "ok"
    assert [got[1, k].n_parts for k in (1, 2, 3)] == [3, 3, 3]


def test_a_lost_answer_stays_in_the_text(turns):
    r = MD.reassemble(MD.pair_responses(*turns, ["conv_id"], ["turn"]), ["conv_id"]).where("conv_id = 1").first()
    assert (r.n_parts, r.n_ok, r.n_failed) == (3, 1, 2)
    assert r.text == "\n\n".join(["A", C.FAILED_CHUNK_TEXT % 2, C.FAILED_CHUNK_TEXT % 3])


def test_no_turns(turns):
    req, res = turns
    assert MD.pair_responses(req.limit(0), res, ["conv_id"], ["turn"]).collect() == []
    assert {r.status for r in MD.pair_responses(req, res.limit(0), ["conv_id"], ["turn"]).collect()} == {"failed"}


def test_sizes_gate_like_contents(spark):
    rows = spark.createDataFrame(
        [(1, 2, 1, b"aa"), (1, 2, 2, b"b"), (2, 2, 1, b"c"), (3, 1, 1, b"only"), (4, 3, None, None), (5, 2, 1, b"x"), (5, 2, 1, b"x"),
         (5, 2, 2, None), (6, 2, 1, b""), (6, 2, 2, b""), (6, 2, 7, b"stray")], "k int, n_parts int, part_no int, content binary")
    whole = {r.k: (r.n_parts, r.n_present, r.complete, None if r.content is None else len(r.content))
             for r in PT.gate_rows(rows, ["k"], min_parts=2).collect()}
    sizes = {r.k: (r.n_parts, r.n_present, r.complete, r.n_bytes) for r in PT.gate_sizes(
        rows.withColumn("n_bytes", F.octet_length("content")), ["k"], min_parts=2).collect()}
    assert whole == sizes


def test_one_partition_is_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    SK.write_parquet(spark.createDataFrame([(n, f"old {n}") for n in range(5)] * 2, "chapter_no int, text string"), path, ["chapter_no"])
    before = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/chapter_no=*/*.parquet")}
    one = SF.lookup_chapter(spark.read.parquet(path), 3)
    plan = one._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters: [isnotnull(chapter_no" in plan and "(chapter_no" in plan.split("PartitionFilters")[1].split("\n")[0]
    with pytest.raises(FileNotFoundError):
        SF.lookup_chapter(spark.read.parquet(path), 99)
    SK.replace_partition(spark.createDataFrame([(3, "new")], "chapter_no int, text string"), path, ["chapter_no"])
    after = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/chapter_no=*/*.parquet")}
    assert {f: t for f, t in before.items() if "=3/" not in f} == {f: t for f, t in after.items() if "=3/" not in f}
    assert [r.text for r in spark.read.parquet(path).where("chapter_no = 3").collect()] == ["new"]
    SK.replace_partition(spark.createDataFrame([], "chapter_no int, text string"), path, ["chapter_no"])
    assert spark.read.parquet(path).count() == 9


def test_arrivals(spark, tmp_path):
    schema = "k int, part int, text string"
    inp, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))

    def arrive(rows):
        SK.write_parquet(spark.createDataFrame(rows, schema).coalesce(1), inp, mode="append")
        run_arrivals(spark, inp, spark.createDataFrame([], schema).schema, out, ck, ["k", "part"])
        return sorted(tuple(r) for r in spark.read.parquet(out).collect())

    assert arrive([(1, 1, "b"), (1, 1, "a"), (2, 1, "x")]) == [(1, 1, "a"), (2, 1, "x")]
    assert arrive([(1, 1, "replayed"), (1, 2, "new")]) == [(1, 1, "a"), (1, 2, "new"), (2, 1, "x")]
    assert arrive([(1, 2, "again"), (0, 9, "late")]) == [(0, 9, "late"), (1, 1, "a"), (1, 2, "new"), (2, 1, "x")]
    run_arrivals(spark, inp, spark.createDataFrame([], schema).schema, out, ck, ["k", "part"])  # nothing came
    assert spark.read.parquet(out).count() == 4


def visible(base):
    return sorted(os.path.relpath(f, base) for f in glob.glob(f"{base}/**/*.mp3", recursive=True))


def test_files_appear_whole(spark, tmp_path):
    base = str(tmp_path / "files")
    os.makedirs(base)
    files = spark.createDataFrame([("book_id=1", f"chapter_{n:02d}.mp3", bytes([n] * (n + 1))) for n in range(9)],
                                  "dir string, name string, content binary")
    # A task that dies after some of its files: nothing is visible.
    dying = files.coalesce(1).withColumn("content", F.when(F.col("name") == "chapter_07.mp3", F.lit(None)).otherwise(F.col("content")))
    with pytest.raises(Exception, match="NoneType"):
        CF.write_files(dying, base)
    assert visible(base) == [] and glob.glob(f"{base}/_attempts/*/*")
    manifest = CF.write_files(files, base)
    assert visible(base) == [f"book_id=1/chapter_{n:02d}.mp3" for n in range(9)]
    CF.commit(manifest, base)  # done again: no change
    back = {r.chapter_no: bytes(r.content) for r in SF.read_binary_parts(spark, base).collect()}
    assert back == {n: bytes([n] * (n + 1)) for n in range(9)}
    with pytest.raises(ValueError):
        CF.write_files(files.unionByName(files.limit(1)), str(tmp_path / "twice"))
    assert visible(str(tmp_path / "twice")) == []


def test_a_lost_copy_is_noticed(spark, tmp_path):
    base = str(tmp_path)
    files = spark.createDataFrame([("d", "chapter_01.mp3", b"x")], "dir string, name string, content binary")
    manifest = CF.write_attempts(files, base, "r").cache()
    os.remove(manifest.first().attempt)
    with pytest.raises(Exception, match="FileNotFound"):
        CF.commit(manifest, base)
    manifest.unpersist()


def test_arrivals_of_many_keys(spark, tmp_path):
    """Rows of a key in several files of a batch, nulls, and a batch done again;
    nothing runs in Python for each key."""
    schema = "k int, part int, n int, text string"
    inp, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    struct = spark.createDataFrame([], schema).schema

    def arrive(rows):
        SK.write_parquet(spark.createDataFrame(rows, schema).repartition(3), inp, mode="append")
        run_arrivals(spark, inp, struct, out, ck, ["k", "part"])
        return sorted(tuple(r) for r in spark.read.parquet(out).where("k < 100 or k is null").na.fill(-1).collect())

    many = [(100 + i, j, i * 7 % 5, f"t{j}") for i in range(500) for j in range(3)]
    first = arrive(many + [(1, 1, None, "a"), (1, 1, 4, "c"), (1, 1, 4, "b"), (None, 1, 2, "x"), (None, 1, 2, None), (2, 2, None, None)])
    assert first == [(-1, 1, 2, "x"), (1, 1, 4, "b"), (2, 2, -1, None)]
    # The end of the batch is lost: it is done again, with the same result.
    last = max(glob.glob(f"{ck}/arrived/commits/[0-9]*"), key=lambda f: int(os.path.basename(f)))
    os.remove(last)
    os.remove(f"{ck}/arrived/commits/.{os.path.basename(last)}.crc")
    assert arrive([(1, 1, 0, "late"), (3, 3, 1, "new")]) == [*first, (3, 3, 1, "new")]
    back = spark.read.parquet(out).where("k >= 100")
    assert sorted((r.k, r.part, r.n, r.text) for r in back.collect()) == many
    from quire.streaming import arrivals
    assert not hasattr(arrivals, "pd")
    streamed = arrivals.first_arrivals(spark.readStream.schema(struct).parquet(inp), ["k", "part"])
    plan = streamed._jdf.queryExecution().logical().toString()
    assert "Deduplicate" in plan and "Python" not in plan and "Pandas" not in plan
