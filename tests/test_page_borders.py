"""Repair across page borders, against a loop over the pages of each key."""

import random
import re

import pytest
from pyspark.sql import functions as F

from quire.operators.page_borders import repair_pages


def _repair(text):
    paras = re.sub(r"([^\W\d_])-\n([a-zé])", r"\1\2", text).split("\n\n")
    out = paras[0]
    for a, b in zip(paras, paras[1:]):
        out += (" " if not re.search(r"[.!?:]\Z", a) and re.match("[a-zé]", b) else "\n\n") + b
    return out


def _brute(rows):
    want = {}
    for key in {r[0] for r in rows}:
        pages = [(p, t.strip()) for k, p, t in sorted((r for r in rows if r[0] == key), key=lambda r: r[1]) if t and t.strip()]
        old = None
        for p, t in pages:
            small = re.match("[a-zé]", t)
            if old is None:
                glue = ""
            elif small and re.search(r"[^\W\d_]-\Z", pages[old][1]):
                glue = ""
                k = (key, pages[old][0])
                want[k] = (want[k][0], want[k][1][:-1])
            else:
                glue = " " if small and not re.search(r"[.!?:]\Z", pages[old][1]) else "\n\n"
            want[(key, p)] = (glue, t)
            old = 0 if old is None else old + 1
    return {k: (g, _repair(t)) for k, (g, t) in want.items()}


@pytest.mark.parametrize("n_slices", [1, 6, 50])
def test_repair_pages(spark, n_slices):
    """A hot key over many slices, runs of blank pages over slice borders, a
    null key, pages of one character, words over three pages."""
    r = random.Random(n_slices)
    parts = ["a", "é", "B", "-", "b-", "3-", ".", "end.", "and", "\n\n", "x-\ny", " ", "", None, "so, \n\nthen", "Ü:"]
    rows = [(k, p, r.choice([None, "", " \n", *["".join(x or "" for x in r.choices(parts, k=3))] * 5]))
            for k, n in ((1, 400), (2, 3), (None, 30)) for p in r.sample(range(-50, 2000), n)]
    df = spark.createDataFrame(rows, "book_id int, page_no int, text string").repartition(5)
    got = repair_pages(df, n_slices=n_slices).collect()
    assert {(x.book_id, x.page_no): (x.glue, x.text) for x in got} == _brute(rows)
    assert len(got) == len(_brute(rows))


def test_words_over_three_pages(spark):
    rows = [(1, 1, "A hy-"), (1, 2, "phe-"), (1, 3, None), (1, 4, "nated word"), (1, 5, "goes on. End."), (1, 6, "New")]
    df = spark.createDataFrame(rows, "book_id int, page_no int, text string").withColumn("glue", F.lit("clash"))
    got = sorted((x.page_no, x.glue + x.text) for x in repair_pages(df).collect())
    assert "".join(t for _, t in got) == "A hyphenated word goes on. End.\n\nNew"


def test_repeated_and_no_pages(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 1, "b")], "book_id int, page_no int, text string")
    with pytest.raises(ValueError, match="twice"):
        repair_pages(df)
    assert repair_pages(df.limit(0)).count() == 0
