"""Segmentation over rows against Python's finditer on the joined text."""

import random
import re

import pytest
from pyspark.sql import functions as F

from quire.functions import constants as C
from quire.operators import segment_blocks as SB


def whole(text, title, min_body):
    """Expected chapters of one joined text."""
    for no, p in enumerate(C.SEGMENT_PATTERNS, 1):
        kept = [m for m in re.finditer(p, text, re.IGNORECASE | re.MULTILINE) if SB.title_kept(m.group(1).strip())]
        if len(kept) > 3:
            stops = [m.start() for m in kept[1:]] + [len(text)]
            out = [(no, k, m.group(1).strip(), text[m.end():z].strip()) for k, (m, z) in enumerate(zip(kept, stops), 1)]
            return [x for x in out if len(x[3]) >= min_body]
    return [(0, 1, title, text)]


def made_up(seed):
    r = random.Random(seed)
    lines = ["Chapter 3: A Long Enough Title Here", "CHAPTER 12   THE SECOND LONG TITLE", "12\nTHE CAPITALS OF A TITLE LINE",
             "PART 4\nsome title of twenty letters", "7. ANOTHER TITLE IN CAPITALS", "Chapter 5: see http://example.org/abc/def",
             "Zone 1 TRAINING CHAPTER", "plain words é😀 here", "", "   ", "\t", "x" * 30, "9"]
    rows = []
    for b in range(6):
        some = r.sample(lines, 6) + ["more text"] * 3
        rows += [(b, p, "\n".join(r.choice(some) for _ in range(r.randrange(1, 25)))) for p in range(r.randrange(1, 8))]
    return rows


@pytest.mark.parametrize("seed,block,halo", [(1, 500, 500), (2, 400, 330), (3, 1 << 17, 4352)])
def test_rows_split_like_the_joined_text(spark, seed, block, halo):
    rows = made_up(seed) + [(90, 0, None), (91, 0, "\n"), (92, 0, "\n" + " " * 700 + "Chapter 1: After A Long Run Of Blanks\n" + "w" * 40)]
    rows += [(92, 1, ("\nChapter 2: One Line After Another Here" * 6) + "\n" + "v" * 30)]
    got = {}
    df = spark.createDataFrame(rows, "book_id long, page_no int, text string")
    out = SB.split_into_chapters(df, ["book_id"], ["page_no"], F.concat(F.lit("Book "), F.col("book_id").cast("string")),
                                 block=block, halo=halo, piece=37, min_body=20)
    for r in out.collect():
        got.setdefault((r.book_id, r.pattern_no, r.chapter_no, r.title, r.n_chars), []).append((r.piece_no, r.text))
    joined = {}
    for b, _, t in rows:
        if t:
            joined[b] = joined[b] + "\n\n" + t if b in joined else t
    want = {(b, no, k, title, len(t)): t for b, text in joined.items() for no, k, title, t in whole(text, f"Book {b}", 20)}
    assert len({k[1] for k in want}) > 2
    assert {k: "".join(t for _, t in sorted(v)) for k, v in got.items()} == want
    assert all(len(t) == 37 for v in got.values() for _, t in sorted(v)[:-1])


def test_steps_follow_the_scan():
    text = ("\nChapter 1: One Line After Another Here" * 5) + "\n" + "z" * 50
    pattern = re.compile(C.SEGMENT_PATTERNS[0], re.IGNORECASE)
    own = 100
    found = SB.candidates(pattern, text, own)
    assert len(found) == 3
    for entry in range(own):
        ends = [e for _, e, _ in SB.chosen(found, entry)]
        x = next(x for t, x in SB.scan_steps(found, own, 60) if t >= entry) if entry < 60 else None
        assert x is None or x == max([e - own for e in ends] + [0])


def test_pieces_are_cut_once_and_losing_patterns_are_spared(spark):
    """Marks inside texts are kept, known counts give the same chapters, and
    no part of a piece is computed again for each use of it."""
    from quire.operators import segment as SG
    odd = "abcdef"
    rows = [(b, t + odd) for b, t in enumerate("\n".join(x[2] for x in made_up(seed)) for seed in range(8))]
    rows += [(50, f"{odd}\nChapter 1: Long Enough Title {odd}\n{odd}" * 5), (51, None), (52, "")]
    docs = spark.createDataFrame(rows, "book_id long, text string").withColumn("title", F.lit("T"))
    counted = SG.pattern_report(docs, ["book_id", "text", "title"])
    counts = [F.col(f"kept_{i}") for i in range(1, 6)]
    both = counted.select("book_id", "text", SG.segment(F.col("text"), F.col("title")).alias("a"),
                          SG.segment(F.col("text"), F.col("title"), counts=counts).alias("b")).collect()
    assert all(r.a == r.b for r in both) and len(both) == len(rows)
    for r in both:
        if r.text:
            want = whole(r.text, "T", 0)
            assert [(r.a.pattern_no, c.chapter_no, c.title, c.text) for c in r.a.chapters] == want
    assert {r.a.pattern_no for r in both} >= {0, 1}
    made = SG.match_pieces(F.col("text"), C.SEGMENT_PATTERNS[0])._jc.toString()
    assert made.count("substring_index") == 0 and made.count("regexp_replace") == 1


def test_texts_are_read_once_and_moved_by_join(spark, monkeypatch):
    """The scan of the offsets sees lengths alone, one step reads the blocks,
    and pages of one number are put in the order of their texts as before."""
    from quire.operators import blocks as BL
    scanned, steps = [], []
    scan, per_block = BL.keyed_scan, BL.per_block
    monkeypatch.setattr(BL, "keyed_scan", lambda df, *a, **kw: scanned.append(df.columns) or scan(df, *a, **kw))
    monkeypatch.setattr(BL, "per_block", lambda *a: steps.append(a[1].__name__) or per_block(*a))
    title = F.concat(F.lit("Book "), F.coalesce(F.col("book_id").cast("string"), F.lit("none")))
    heads = "".join(f"\n \nChapter {k}: One Line After Another Here\n" + "  \n " * 30 + f"body {k} " * 9 + " \n\t" * 40 for k in range(1, 7))
    rows = [(1, 2, heads), (1, 1, "before it all"), (None, 1, "no number" + "\n" * 200), (None, None, heads), (3, 7, " \n" * 9)]

    def split(some):
        df = spark.createDataFrame(some, "book_id long, page_no int, text string")
        out = SB.split_into_chapters(df, ["book_id"], ["page_no"], title, block=700, halo=700, piece=50, min_body=1)
        got = {}
        for r in out.collect():
            got.setdefault((r.book_id, r.pattern_no, r.chapter_no, r.title, r.n_chars), []).append((r.piece_no, r.text))
        return {k: "".join(t for _, t in sorted(v)) for k, v in got.items()}

    want = {}
    for book, text in ((1, "before it all\n\n" + heads), (None, heads + "\n\nno number" + "\n" * 200), (3, " \n" * 9)):
        name = "Book none" if book is None else f"Book {book}"
        want |= {(book, no, k, t, len(x)): x for no, k, t, x in whole(text, name, 1)}
    assert split(rows) == want
    assert all("_text" not in c for c in scanned) and steps == ["look"]
    # Ties: the scan has to order them by their texts.
    tied = [(5, 1, "b second"), (5, 1, "a first"), (5, 1, "a first"), (5, 0, "start")]
    joined = "start\n\na first\n\na first\n\nb second"
    assert split(tied) == {(5, 0, 1, "Book 5", len(joined)): joined}
    assert any("_text" in c for c in scanned)
