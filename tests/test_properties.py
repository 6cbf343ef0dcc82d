"""Properties and hand-written goldens on the small fixture (sf0.001) and on
made-up edge texts; the DuckDB oracles compare the full tables."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from quire.functions import constants as C
from quire.operators import chunk as CH
from quire.operators import model as MD
from quire.operators import parts as PT
from quire.operators import rate as RT
from quire.operators import scan as SC
from quire.operators import segment as SG
from quire.plans import fixtures as FX


def _by_key(df, keys):
    got = {}
    for r in df.orderBy(*keys, "part_no").collect():
        got.setdefault(tuple(r[k] for k in keys), []).append(r["text"])
    return got


def test_open_loop_properties(spark, small):
    s = RT.open_loop_schedule(FX.arrivals(spark, small), "user_id", "at_us", ["ts", "event_id"],
                              FX.OPEN_LOOP_GAP_US)
    a = RT.audit(s, "user_id", ["i"], "send_us", FX.OPEN_LOOP_GAP_US, FX.AUDIT_QPM)
    assert s.where(F.col("send_us") < F.col("at_us")).count() == 0
    assert a.where("gap_violation OR window_violation").count() == 0


def test_keyed_scan_on_a_hot_key(spark):
    # One key holds most rows; slices must still give exact global positions.
    hot = spark.range(0, 20000).select(
        F.when(F.col("id") % 10 < 8, F.lit(1)).otherwise(F.col("id") % 7).alias("k"),
        F.col("id").alias("t"), (F.col("id") % 13).alias("v"))
    out = SC.keyed_scan(hot, "k", ["t"], sums={"cs": F.col("v")},
                        linear_max={"m": (F.col("v"), 1)}, n_slices=16)
    pdf = hot.toPandas().sort_values(["k", "t"])
    pdf["i"] = pdf.groupby("k").cumcount() + 1
    pdf["cs"] = pdf.groupby("k")["v"].cumsum()
    pdf["m"] = (pdf["v"] - pdf["i"]).groupby(pdf["k"]).cummax()
    got = out.toPandas().sort_values(["k", "t"]).reset_index(drop=True)
    want = pdf.reset_index(drop=True)
    assert (got["i"].to_numpy() == want["i"].to_numpy()).all()
    assert (got["cs"].to_numpy() == want["cs"].to_numpy()).all()
    assert (got["m"].to_numpy() == want["m"].to_numpy()).all()


def test_incremental_rerun_adds_nothing(spark, small, tmp_path):
    from quire.streaming.incremental import run_incremental
    parts = FX.audio_parts(spark, small).select("book_id", "chapter_no", "part_no",
                                                 F.octet_length("content").alias("n_bytes"))
    inp, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    parts.write.parquet(inp)
    run_incremental(spark, inp, parts.schema, out, ck, ["book_id", "chapter_no", "part_no"])
    n1 = spark.read.parquet(out).count()
    assert run_incremental(spark, inp, parts.schema, out, ck, ["book_id", "chapter_no", "part_no"]) == 0
    assert spark.read.parquet(out).count() == n1 == parts.count()


def test_pinned_counts_sf001(spark):
    # FIXTURES part C: T3 = 1,383 / 1,404 / 1,378 / 1,378; T4 = 1,230 at 4000, 9,085 (32 empty) at 400.
    sf = "/root/testdata/sf0.01"
    keys = ["book_id", "chapter_no", "form"]
    c = {r["form"]: r["count"] for r in CH.chunk_boundary(FX.chapter_docs(spark, sf), keys)
         .groupBy("form").count().collect()}
    assert c == {"raw": 1383, "para": 1404, "space": 1378, "hard": 1378}
    d = FX.chapter_docs(spark, sf, ("para",))
    assert CH.pack_paragraphs(d, ["book_id", "chapter_no"]).count() == 1230
    p400 = CH.pack_paragraphs(d, ["book_id", "chapter_no"], max_size=400)
    assert p400.count() == 9085 and p400.where("text = ''").count() == 32


def _texts(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "k int, text string")


def test_fixed_chunks_are_lossless_and_bounded(spark, small):
    keys = ["book_id", "chapter_no", "form"]
    docs = FX.chapter_docs(spark, small)
    got = _by_key(CH.chunk_fixed(docs, keys), keys)
    for r in docs.collect():
        parts = got.get((r.book_id, r.chapter_no, r.form), [])
        assert "".join(parts) == r.text
        assert all(0 < len(p) <= 3000 for p in parts)
        # A cut is at the size, or late in the window at a blank line.
        assert all(len(p) == 3000 or (len(p) > 2100 and rest.startswith("\n\n"))
                   for p, rest in zip(parts, parts[1:]))


def test_boundary_chunks_keep_all_words(spark, small):
    keys = ["book_id", "chapter_no", "form"]
    docs = FX.chapter_docs(spark, small)
    got = _by_key(CH.chunk_boundary(docs, keys), keys)
    for r in docs.collect():
        parts = got.get((r.book_id, r.chapter_no, r.form), [])
        assert "".join("".join(parts).split()) == "".join(r.text.split())
        assert all(len(p) <= 3000 and p == p.strip() for p in parts)
        # No window is left before half its size while text follows.
        assert all(len(p) > 1400 for p in parts[:-1])


def test_boundary_goldens(spark):
    x, y = "x" * 2000, "y" * 2000
    texts = [f"{x}\n\n{y}", f"{x}. {y}", f"{x} {y}", f"{'x' * 2500} {y}", "", "a" * 3001]
    want = [[x, y], [x + ".", y], [x + " " + "y" * 999, "y" * 1001], ["x" * 2500, y], [], ["a" * 3000, "a"]]
    got = _by_key(CH.chunk_boundary(_texts(spark, texts), ["k"]), ["k"])
    assert [got.get((k,), []) for k in range(len(texts))] == want


def test_packer_bounds_and_order(spark, small):
    d = FX.chapter_docs(spark, small, ("para",))
    for limit in (4000, 400):
        got = _by_key(CH.pack_paragraphs(d, ["book_id", "chapter_no"], max_size=limit), ["book_id", "chapter_no"])
        for r in d.collect():
            parts = got.get((r.book_id, r.chapter_no), [])
            assert "".join("".join(parts).split()) == "".join(r.text.split())
            whole = {p.strip() for p in r.text.split("\n\n")}
            # The next paragraph would not have fitted (with its separators).
            assert all(len(a) + len(b.split("\n\n")[0]) + 4 > limit for a, b in zip(parts, parts[1:])
                       if set(a.split("\n\n")) <= whole and set(b.split("\n\n")) <= whole)


def test_packer_goldens(spark):
    texts = ["aa\n\nbb\n\n\n\ncc", "a" * 12 + "\n\nbb", ""]
    got = _by_key(CH.pack_paragraphs(_texts(spark, texts), ["k"], max_size=8), ["k"])
    assert got[(0,)] == ["aa\n\nbb", "cc"]
    assert got[(1,)][-1] == "bb" and "".join(got[(1,)][:-1]) == "a" * 12
    assert (2,) not in got


def test_long_document(spark):
    # 600k code points with multi-byte letters in one row.
    text = "".join(f"alpha béta 的一是 δέλτα {i}{'. ' if i % 7 else chr(10) * 2}" for i in range(24000))
    df = _texts(spark, [text])
    fixed = [r["text"] for r in CH.chunk_fixed(df, ["k"]).orderBy("part_no").collect()]
    assert "".join(fixed) == text and max(map(len, fixed)) <= 3000
    soft = [r["text"] for r in CH.chunk_boundary(df, ["k"]).orderBy("part_no").collect()]
    assert "".join("".join(soft).split()) == "".join(text.split()) and max(map(len, soft)) <= 3000


_BODY = ("Lorem ipsum dolor sit amet. " * 25).strip()


def _chapters(spark, text):
    df = spark.createDataFrame([(1, "Book", text)], "book_id int, title string, text string")
    return sorted((r.pattern_no, r.chapter_no, r.title, r.text) for r in SG.split_into_chapters(df, ["book_id"]).collect())


def _heading(k):
    return f"Chapter {k}: The heading of number {k} of this book"


def test_segmentation_golden(spark):
    text = "Front matter\n" + "".join(f"\n{_heading(k)}\n{_BODY}\n" for k in range(1, 6))
    got = _chapters(spark, text)
    assert len({r[0] for r in got}) == 1 and got[0][0] > 0
    assert [r[1] for r in got] == [1, 2, 3, 4, 5]
    assert all(r[3] == _BODY for r in got)
    assert _chapters(spark, "No headings here") == [(0, 1, "Book", "No headings here")]


def test_segmentation_keeps_private_use_characters(spark):
    # The same chapters with and without the characters that mark matches.
    marks = "\ue000 \ue001\ue002 \ue003\ue004\ue003 "
    plain = "".join(f"\n{_heading(k)}\n{_BODY}\n" for k in range(1, 6))
    marked = "".join(f"\n{_heading(k)}\n{marks}{_BODY}\n" for k in range(1, 6))
    a, b = _chapters(spark, plain), _chapters(spark, marked)
    assert [r[:3] for r in a] == [r[:3] for r in b]
    assert [r[3] for r in b] == [(marks + _BODY).strip()] * 5


def test_merge_gate_needs_every_part_with_content(spark):
    parts = spark.createDataFrame(
        [(1, 1, b"a"), (1, 1, b"a"), (2, 1, b"x"), (2, 2, None), (3, 1, b"p"), (3, 2, b"q"), (3, 2, b"q"), (3, 9, b"z")],
        "s int, part_no int, content binary")
    plan = spark.createDataFrame([(1, 2), (2, 2), (3, 2), (4, 1)], "s int, n_parts int")
    got = {r.s: (r.n_present, r.complete, r.content and bytes(r.content))
           for r in PT.gated_merge(parts, plan, ["s"]).collect()}
    assert got == {1: (1, False, None), 2: (1, False, None), 3: (2, True, b"pq"), 4: (0, False, None)}
    sets = {r.s: (r.n_present, r.complete) for r in PT.complete_sets(parts, plan, ["s"]).collect()}
    assert sets == {k: v[:2] for k, v in got.items()}


def test_a_raising_model_fails_rows_only(spark):
    def model(pdf, attempt):
        if (pdf["input"] == "bad").any():
            raise RuntimeError("no")
        return pd.DataFrame({"output": pdf["input"].str.upper(), "error": None, "service_us": 1})

    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "bad"), (1, 3, "c")], "k int, part_no int, input string")
    got = {r.part_no: (r.status, r.output, r.error)
           for r in MD.call_model(df, model, ["k", "part_no"], parallelism=1).collect()}
    assert got[1] == ("ok", "A", None) and got[3] == ("ok", "C", None)
    assert got[2][0] == "failed" and "RuntimeError: no" in got[2][2]
