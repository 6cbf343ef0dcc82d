"""Edge tables (small inline inputs) for each quirk of the reproduced behaviour."""

import pandas as pd
from pyspark.sql import functions as F

from quire.functions import constants as C
from quire.functions import text as T
from quire.operators import catalog as CT
from quire.operators import chunk as CH
from quire.operators import lines as LN
from quire.operators import model as MD
from quire.operators import pages as PG
from quire.operators import parts as PT
from quire.operators import project as PJ
from quire.operators import segment as SG


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_chapter_numbers_up_to_the_books_own_contents(spark):
    pages = spark.createDataFrame([(b, C.FRONT_MATTER_PAGES + n, f"{n}\nLOUD TITLE\ntext") for b in (1, 2, 3) for n in range(1, 121)],
                                  "book_id long, page_no int, text string")
    toc = spark.createDataFrame([(1, n) for n in range(1, 111)] + [(2, n) for n in range(1, 6)], "book_id long, chapter_no int")
    got = rows(PG.chapter_starts(pages, toc=toc), "book_id", "chapter_no")
    assert got == [(b, n) for b, most in ((1, 110), (2, 5), (3, 19)) for n in range(C.MIN_CHAPTER_NUMBER, most + 1)]
    plain = rows(PG.chapter_starts(pages), "book_id", "chapter_no")
    assert plain == [(b, n) for b in (1, 2, 3) for n in range(C.MIN_CHAPTER_NUMBER, 20)]


def test_chapter_numbers_in_digits_of_any_script(spark):
    pages = spark.createDataFrame([(1, 10, "１２\nLOUD TITLE"), (1, 11, "٣\nLOUD TITLE"), (1, 12, "𝟕\nLOUD TITLE"), (1, 13, "²\nLOUD TITLE"),
                                   (1, 14, "٣x\nLOUD TITLE")], "book_id long, page_no int, text string")
    assert rows(PG.chapter_starts(pages), "chapter_no", "start_page") == [(3, 11), (7, 12), (12, 10)]


def test_range_join_out_of_order_starts(spark):
    starts = spark.createDataFrame([(1, 1, 20), (1, 2, 15), (1, 3, 30)],
                                   "book_id bigint, chapter_no int, start_page int")
    counts = spark.createDataFrame([(1, 40)], "book_id bigint, n_pages int")
    ranges = PG.chapter_ranges(starts, counts)
    assert rows(ranges, "chapter_no", "start_page", "end_page") == [(1, 20, 15), (2, 15, 30), (3, 30, 40)]
    pages = spark.createDataFrame([(1, p, f"p{p}") for p in range(40)], "book_id bigint, page_no int, text string")
    got = PG.assign_pages(pages, ranges).groupBy("chapter_no").agg(
        F.min("page_no").alias("lo"), F.max("page_no").alias("hi"), F.count("*").alias("n"))
    assert rows(got, "chapter_no", "lo", "hi", "n") == [(2, 15, 29, 15), (3, 30, 39, 10)]
    texts = PG.chapter_texts(pages, ranges)
    assert rows(texts.where("chapter_no = 1"), "n_text_pages", "n_chars") == [(0, 0)]


def _page(n, title):
    return f"{n}\n{title}\nbody text"


def test_first_qualifying_page_and_ratio(spark):
    data = [
        (1, 12, _page(4, "mostly lower case words here")),   # chapter 4 fails the ratio
        (1, 14, _page(4, "THE REAL TITLE")),
        (1, 18, _page(4, "ANOTHER TITLE")),
        (1, 20, "5\nABcdefgh"),                                # exactly 25 % upper: rejected
        (1, 21, "6\n1234 ----"),                               # no letters: rejected
        (1, 22, _page(0, "ZERO")),                            # 0: out of range
        (1, 23, _page(20, "TWENTY")),                         # 20: out of range
        (1, 24, " 7 \nSEVEN UP\nmore"),                       # stripped number accepted
        (1, 5, _page(8, "FRONT MATTER")),                     # before page 10
    ]
    pages = spark.createDataFrame(data, "book_id bigint, page_no int, text string")
    got = rows(PG.chapter_starts(pages), "chapter_no", "start_page")
    assert got == [(4, 14), (7, 24)]


def _marked(bodies, titles):
    parts = ["intro text"]
    for t, b in zip(titles, bodies):
        parts.append(f"\n{t}\n{b}")
    return "\n".join(parts)


def test_segment_gaps_and_gate(spark):
    long_body = "x" * 600
    titles = [f"{k}: THE CHAPTER ABOUT TOPIC {chr(65 + k)}" for k in range(1, 5)]
    four = _marked([long_body, "y" * 499, long_body, long_body], titles)
    three = _marked([long_body] * 3, titles[:3])
    df = spark.createDataFrame([(1, "B1", four), (2, "B2", three)], "book_id int, title string, text string")
    out = SG.split_into_chapters(df, ["book_id"])
    assert rows(out.where("book_id = 1"), "chapter_no") == [(1,), (3,), (4,)]
    fb = out.where("book_id = 2").collect()
    assert len(fb) == 1 and fb[0]["pattern_no"] == 0 and fb[0]["text"] == three


def test_boundary_thresholds_are_strict(spark):
    # A blank line exactly at offset 1800 (0-based) must not cut at 1800.
    t1 = "a" * 1800 + "\n\n" + "b" * 2000
    # A sentence mark exactly at 1500 must not cut there either.
    t2 = "a" * 1500 + ". " + "b" * 2000
    # A space exactly at 2100 must not cut there.
    t3 = "a" * 2100 + " " + "b" * 2000
    df = spark.createDataFrame([(1, t1), (2, t2), (3, t3)], "k int, text string")
    out = CH.chunk_boundary(df, ["k"]).where("part_no = 1")
    assert all(len(r["text"]) == 3000 for r in out.collect())


def test_sentence_fallback_empty_tail_and_delimiter(spark):
    long_sentence = "w" * 450 + "."
    mixed = "甲" * 300 + "？" + "乙" * 300 + ". tail"
    df = spark.createDataFrame([(1, long_sentence), (2, mixed)], "k int, text string")
    out = CH.pack_paragraphs(df, ["k"], max_size=400)
    assert [r["text"] for r in out.where("k = 1").orderBy("part_no").collect()] == [long_sentence, ""]
    assert [r["text"] for r in out.where("k = 2").orderBy("part_no").collect()] == \
        ["甲" * 300 + "？", "乙" * 300 + ". tail"]


def test_line_ten_versus_eleven(spark):
    lines = ["正文很长的一段。"] * 12
    lines[9] = ""
    lines[10] = "小节"
    a = "\n".join(lines)
    lines2 = ["正文很长的一段。"] * 13
    lines2[10] = ""
    lines2[11] = "小节"
    b = "\n".join(lines2)
    df = spark.createDataFrame([(1, a), (2, b)], "k int, text string")
    out = {r["k"]: r["f"].split("\n") for r in df.select("k", LN.format_markdown(F.col("text")).alias("f")).collect()}
    assert "小节" in out[1]
    assert "## 小节" in out[2]


def test_title_split_without_newline(spark):
    df = spark.createDataFrame([("single line",), ("a\nb\nc",)], "t string")
    title, body = PJ.title_and_body(F.col("t"))
    assert rows(df.select(title.alias("x"), body.alias("y")), "x", "y") == \
        [("a", "b\nc"), ("single line", "single line")]


def test_preview_rule(spark):
    df = spark.createDataFrame([("a" * 200,), ("b" * 201,), ("   ",), (None,)], "s string")
    got = [r["p"] for r in df.select(CT.preview(F.col("s")).alias("p")).collect()]
    assert got == ["a" * 200, "b" * 200 + "...", "", C.NO_SUMMARY_TEXT]


def test_zero_pad_never_truncates(spark):
    df = spark.createDataFrame([(7,), (99,), (100,)], "n int")
    assert [r[0] for r in df.select(T.zero_pad(F.col("n"))).collect()] == ["07", "99", "100"]


def test_single_part_naming(spark):
    df = spark.createDataFrame([(3, 1, 1), (3, 2, 2)], "c int, p int, n int")
    got = [r[0] for r in df.select(CH.part_file_name(F.col("c"), F.col("p"), F.col("n"))).collect()]
    assert got == ["chapter_03.mp3", "chapter_03_part02.mp3"]


def test_no_merge_with_a_missing_part(spark):
    parts = spark.createDataFrame([(1, 1, 1, b"a"), (1, 1, 3, b"c"), (1, 2, 1, b"x"), (1, 2, 2, b"y")],
                                  "book_id int, chapter_no int, part_no int, content binary")
    sets = spark.createDataFrame([(1, 1, 3), (1, 2, 2)], "book_id int, chapter_no int, n_parts int")
    st = PT.complete_sets(parts, sets, ["book_id", "chapter_no"])
    assert rows(st, "chapter_no", "n_present", "complete") == [(1, 2, False), (2, 2, True)]
    merged = PT.merge_parts(parts.where("chapter_no = 2"), ["book_id", "chapter_no"]).collect()
    assert bytes(merged[0]["content"]) == b"xy"


def test_stop_at_first_failure(spark):
    class FailPart2:
        def __call__(self, batch, attempt):
            ok = (batch["part_no"] != 2).to_numpy()
            return pd.DataFrame({"output": [t if o else None for t, o in zip(batch["input"], ok)],
                                 "error": [None if o else "boom" for o in ok],
                                 "service_us": [1] * len(batch)})

    df = spark.createDataFrame([(1, p, f"t{p}") for p in range(1, 5)], "chapter_no int, part_no int, input string")
    r = MD.stop_at_first_failure(MD.call_model(df, FailPart2(), ["chapter_no", "part_no"]), ["chapter_no"])
    assert rows(r, "part_no", "status") == [(1, "ok"), (2, "failed"), (3, "not_attempted"), (4, "not_attempted")]


def test_retry_backoff(spark):
    class NeedsAttempts:
        def __call__(self, batch, attempt):
            ok = (batch["part_no"] <= attempt).to_numpy()
            return pd.DataFrame({"output": [t if o else None for t, o in zip(batch["input"], ok)],
                                 "error": [None if o else "later" for o in ok],
                                 "service_us": [1] * len(batch)})

    df = spark.createDataFrame([(1, p, "x") for p in range(1, 5)], "chapter_no int, part_no int, input string")
    r = MD.call_model(df, NeedsAttempts(), ["chapter_no", "part_no"], on_failure="sentinel")
    got = rows(r, "part_no", "attempts", "backoff_s", "status", "output")
    assert got == [(1, 1, 0, "ok", "x"), (2, 2, 1, "ok", "x"), (3, 3, 3, "ok", "x"),
                   (4, 3, 3, "failed", C.FAILED_CHUNK_TEXT % 4)]


def test_first_n_limit(spark):
    df = spark.createDataFrame([(1, c) for c in range(1, 6)], "b int, c int")
    assert df.transform(lambda d: PJ.first_n_per_group(d, ["b"], ["c"], 0)).count() == 5
    assert rows(PJ.first_n_per_group(df, ["b"], ["c"], 2), "c") == [(1,), (2,)]
    assert df.transform(lambda d: PJ.first_n_per_group(d, ["b"], ["c"], None)).count() == 5


def test_gated_merge_join_form(spark):
    parts = spark.createDataFrame([(1, 1, 1, b"a"), (1, 1, 3, b"c"), (1, 2, 1, b"x"), (1, 2, 2, b"y"),
                                   (1, 3, 1, b"s")],
                                  "book_id int, chapter_no int, part_no int, content binary")
    sets = spark.createDataFrame([(1, 1, 3), (1, 2, 2), (1, 3, 1), (1, 4, 2)],
                                 "book_id int, chapter_no int, n_parts int")
    got = {r["chapter_no"]: (r["n_present"], r["complete"], None if r["content"] is None else bytes(r["content"]))
           for r in PT.gated_merge(parts, sets, ["book_id", "chapter_no"], min_parts=2).collect()}
    # missing part -> no merge; complete -> merged; single part -> never merged; no parts -> 0 present
    assert got == {1: (2, False, None), 2: (2, True, b"xy"), 3: (1, True, None), 4: (0, False, None)}


def test_dynamic_partition_overwrite(spark, tmp_path):
    from quire.sinks import files as SK
    from quire.sources import files as SF
    path = str(tmp_path / "chapters")
    df = spark.createDataFrame([(1, 1, "one"), (1, 2, "two"), (2, 1, "three")],
                               "book_id int, chapter_no int, text string")
    SK.write_text_files(df.withColumn("chapter", SK.chapter_dir(F.col("chapter_no"))), path, "text",
                        ["book_id", "chapter"])
    redo = spark.createDataFrame([(1, 2, "TWO")], "book_id int, chapter_no int, text string")
    SK.write_text_files(redo.withColumn("chapter", SK.chapter_dir(F.col("chapter_no"))), path, "text",
                        ["book_id", "chapter"])
    back = SF.read_text_files(spark, path)
    got = sorted((r["book_id"], r["chapter"], r["value"]) for r in back.collect())
    assert got == [(1, "chapter_01", "one"), (1, "chapter_02", "TWO"), (2, "chapter_01", "three")]


def test_point_lookup_missing_chapter(spark):
    import pytest
    from quire.sources import files as SF
    df = spark.createDataFrame([(1, 1)], "book_id int, chapter_no int")
    assert SF.lookup_chapter(df, 1).count() == 1
    with pytest.raises(FileNotFoundError):
        SF.lookup_chapter(df, 9)
