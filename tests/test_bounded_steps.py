"""Python steps hold a bounded part of a batch, however long the table is."""

import pandas as pd
import pyarrow as pa

from quire.functions import arrow as AR
from quire.llm import suffix_dedup as SD
from quire.llm import vectors as V
from quire.operators import blocks as BL
from quire.operators import model as MD
from quire.plans import fixtures as FX


def test_parts_are_bounded_and_whole():
    texts = ["a" * 10, None, "", "ü" * 30, "b" * 500, "c", "d" * 99, "e" * 2]
    batch = pa.RecordBatch.from_pydict({"k": list(range(8)), "text": texts, "raw": [None] * 7 + [b"xy"]})
    got = list(AR.parts(batch, 100))
    assert [x for p in got for x in p.column("k").to_pylist()] == list(range(8))
    assert [x for p in got for x in p.column("text").to_pylist()] == texts
    assert all(p.num_rows == 1 or p.num_rows + sum(len((x or "").encode()) for x in p.column("text").to_pylist()) <= 100 for p in got)
    assert list(AR.parts(batch.slice(0, 0))) == []


def test_model_batches_are_bounded(spark):
    def sized(batch, attempt):  # the service time is the size of the batch
        n = int(batch["input"].str.len().sum())
        return pd.DataFrame({"output": batch["input"].astype(object), "error": None, "service_us": [n] * len(batch)})

    rows = spark.range(1200).coalesce(1).selectExpr("id as chapter_no", "repeat('x', 4000) as input")
    got = MD.call_model(rows, sized, ["chapter_no"], on_failure="null").collect()
    assert sorted(r.chapter_no for r in got) == list(range(1200))
    assert all(r.status == "ok" and len(r.output) == 4000 for r in got)
    assert max(r.service_us for r in got) <= AR.PART


def test_spoken_parts_are_bounded(spark):
    """Binary answers, of texts that take several bytes a character."""
    def sized(batch, attempt):
        out = FX.SPEECH_MODEL(batch, attempt)
        return out.assign(service_us=int(batch["input"].str.len().sum()) * 3)

    rows = spark.range(600).coalesce(1).selectExpr("id as chapter_no", "1 as part_no", "repeat('的', 2000) as input")
    got = MD.call_model(rows, sized, ["chapter_no", "part_no"], on_failure="null", binary=True).collect()
    want = {n: "的".encode() * 2000 if (n + 2) % 4 + 1 <= 3 else None for n in range(600)}
    assert {r.chapter_no: None if r.output is None else bytes(r.output) for r in got} == want
    assert {r.chapter_no: r.attempts for r in got} == {n: min((n + 2) % 4 + 1, 3) for n in range(600)}
    assert max(r.service_us / r.attempts for r in got) <= AR.PART


def test_blocks_are_taken_in_parts(spark):
    """The frames that hold blocks as objects are bounded, with nothing lost."""
    rows = spark.range(400).coalesce(1).selectExpr("string(id) as key_id", "0L as b", "repeat('x', 9000) as text", "9000L as n")

    def seen(r, text, own, left):
        import sys
        held = sys._getframe(1).f_locals["part"].num_rows if "part" in sys._getframe(1).f_locals else -1
        return pd.DataFrame({"key_id": [r.key_id], "own": [own], "held": [held]})

    got = BL.per_block(rows, seen, 1 << 16, "key_id string, own long, held long").collect()
    assert sorted(int(r.key_id) for r in got) == list(range(400))
    assert {r.own for r in got} == {9000} and 0 < max(r.held for r in got) * 9000 <= AR.PART


def test_repeats_are_removed_in_parts():
    """The kept bytes of a batch are not held together."""
    n = V.SLICE_BYTES // 100_000 * 3
    rows = {"doc_id": list(range(n)), "text": [str(k) + "x" * 100_000 for k in range(n)], "whole": [k % 5 == 4 for k in range(n)],
            "windows": [[{"first": 10, "n": 1}] if k % 5 == 3 else None for k in range(n)]}
    schema = pa.schema({"doc_id": pa.int64(), "text": pa.string(), "whole": pa.bool_(),
                        "windows": pa.list_(pa.struct({"first": pa.int32(), "n": pa.int32()}))})
    got = list(SD._apply(400)([pa.RecordBatch.from_pydict(rows, schema)]))
    sizes = [len(t) for t in rows["text"]]
    gone = [sizes[k] if k % 5 == 4 else 400 if k % 5 == 3 else 0 for k in range(n)]
    for name, want in (("doc_id", list(range(n))), ("n_bytes", sizes), ("n_removed", gone), ("n_spans", [int(x > 0) for x in gone])):
        assert [x for b in got for x in b.column(name).to_pylist()] == want
    kept = [x for b in got for x in b.column("kept").to_pylist()]
    assert kept == [b"" if k % 5 == 4 else (t[:10] + t[410:]).encode() if k % 5 == 3 else t.encode() for k, t in enumerate(rows["text"])]
    assert len(got) > 1 and max(b.column("kept").nbytes for b in got) <= 2 * V.SLICE_BYTES


def test_batches_of_python_steps_are_bounded(spark):
    """The bytes that Spark hands a Python step at a time, in a session that
    someone else made."""
    from quire.session import BOUNDED_CONF, apply_runtime_conf

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "size"])

    for k in BOUNDED_CONF:
        spark.conf.unset(k)
    apply_runtime_conf(spark)
    rows = spark.range(9000).coalesce(1).selectExpr("id", "repeat('x', 4000) as input")
    got = rows.mapInArrow(sizes, "n long, size long").collect()
    assert sum(r.n for r in got) == 9000 and max(r.size for r in got) <= (4 << 20) + 8000
