"""Chunkers over rows against the single-row forms and a plain loop."""

import random

import numpy as np
import pytest

from quire.functions import constants as C
from quire.operators import blocks as BL
from quire.operators import chunk as CH


def texts(seed):
    r = random.Random(seed)
    words = ["alpha", "bet", "é😀", "x" * 9, "end.", "stop!", "why?", "line.\n", "\n\n", " ", "y" * 40]
    return [(b, p, "".join(r.choice(words) + r.choice(["", " ", " "]) for _ in range(r.randrange(0, 60))))
            for b in range(4) for p in range(r.randrange(1, 9))]


def loop(text, size):
    out, i = [], 0
    while i < len(text):
        w = text[i:i + size]
        cut = len(w)
        if i + size < len(text):
            para, space = w.rfind("\n\n"), w.rfind(" ")
            sent = max(w.rfind(m) for m in C.SENTENCE_MARKS)
            cut = (para if para > size * .6 else sent + 1 if sent > size * .5 else space if space > size * .7 else size)
        out.append(w[:cut].strip())
        i += cut
    return out


@pytest.mark.parametrize("seed,size,block", [(1, 50, 64), (2, 50, 50), (3, 37, 1000), (4, 20, 21)])
def test_rows_cut_like_the_joined_text(spark, seed, size, block):
    rows = texts(seed) + [(9, 0, None), (9, 1, ""), (10, 0, "a" * (3 * block)), (11, 0, "b" * block), (12, 0, "c" * (block + 1)),
                          (None, 0, "no key here"), (13, 2, "tie"), (13, 2, "also tied")]
    df = spark.createDataFrame(rows, "book_id long, page_no int, text string")
    by = {}
    for b, p, t in sorted(rows, key=lambda x: (x[0] or -1, x[1], x[2] or "")):
        if t:
            by[b] = by[b] + "\n\n" + t if b in by else t
    got = {}
    for r in BL.chunk_boundary(df, ["book_id"], ["page_no"], size=size, block=block).collect():
        got.setdefault(r.book_id, []).append((r.part_no, r.n_parts, r.text))
    want = {b: loop(t, size) for b, t in by.items()}
    assert {b: [t for _, _, t in sorted(v)] for b, v in got.items()} == want
    assert all([p for p, n, _ in sorted(v) if n == len(v)] == list(range(1, len(v) + 1)) for v in got.values())


def test_fixed_rows_are_lossless(spark):
    rows = [r for r in texts(7) if r[2]]
    df = spark.createDataFrame(rows, "book_id long, page_no int, text string")
    got = {}
    for r in BL.chunk_fixed(df, ["book_id"], ["page_no"], size=30, block=40).collect():
        got.setdefault(r.book_id, []).append((r.part_no, r.text))
    joined = {}
    for b, _, t in sorted(rows):
        joined[b] = joined[b] + "\n\n" + t if b in joined else t
    assert {b: "".join(t for _, t in sorted(v)) for b, v in got.items()} == joined
    one = spark.createDataFrame(list(joined.items()), "book_id long, text string")
    single = {}
    for r in CH.chunk_fixed(one, ["book_id"], size=30).collect():
        single.setdefault(r.book_id, []).append((r.part_no, r.text))
    assert {b: sorted(v) for b, v in got.items()} == {b: sorted(v) for b, v in single.items()}


def test_a_block_map_follows_the_cuts():
    text = texts(11)[0][2] * 5
    size, own = 20, len(text) - 20
    nxt = BL.successors(text, own, len(text) + 99, size, BL.boundary_rules())
    at = 3
    while at < own:
        at = int(nxt[at])
    assert BL.exits(nxt, size)[3] == at - own
    assert np.all(nxt > np.arange(own)) and np.all(nxt <= np.arange(own) + size)
