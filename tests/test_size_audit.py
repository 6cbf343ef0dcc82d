"""Size audits (A9) of chapters without any text."""

import math

import duckdb

from quire.plans.oracle import ORACLE
from quire.plans.queries import QUERIES

TEXTS = {
    0: "", 1: "a, b. Nation x", 2: "\n\n", 3: "a-\nb",   # book 0: an empty chapter among others
    50: "", 51: "",                                      # book 1: nothing but empty chapters
    100: "plain",                                        # book 2: none
}


def _documents(spark, path):
    spark.createDataFrame(list(TEXTS.items()), "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    return str(path)


def _key(row):
    return tuple("nan" if isinstance(v, float) and math.isnan(v) else v for v in row)


def _oracle(path, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/documents.parquet/*.parquet')")
    rel = con.sql(ORACLE[name])
    return rel.columns, sorted(map(_key, rel.fetchall()))


def test_clean_audit_of_empty_chapters(spark, tmp_path):
    path = _documents(spark, tmp_path)
    got = QUERIES["clean_audit"](spark, path)
    rows = {r.book_id: r for r in got.collect()}
    assert {b: (r.n_chapters, r.n_restored) for b, r in rows.items()} == {0: (4, 3), 1: (2, 2), 2: (1, 1)}
    assert (rows[0].min_ratio, rows[2].min_ratio, rows[2].max_ratio) == (0.5, 1.0, 1.0)
    assert all(math.isnan(x) for x in (rows[0].max_ratio, rows[1].min_ratio, rows[1].max_ratio))
    assert (got.columns, sorted(map(_key, rows.values()))) == _oracle(path, "clean_audit")


def test_repair_breaks_of_empty_chapters(spark, tmp_path):
    path = _documents(spark, tmp_path)
    got = QUERIES["repair_breaks"](spark, path)
    rows = {(r.book_id, r.chapter_no): r for r in got.collect()}
    assert {k for k, r in rows.items() if math.isnan(r.ratio)} == {(0, 1), (1, 1), (1, 2)}
    assert all((r.n_before, r.n_after, r.text, r.restored) == (0, 0, "", True) for r in rows.values() if math.isnan(r.ratio))
    assert {k: r.ratio for k, r in rows.items() if not math.isnan(r.ratio)} == {(0, 2): 14 / 17, (0, 3): 1.0, (0, 4): 0.5, (2, 1): 1.0}
    assert (got.columns, sorted(map(_key, rows.values()))) == _oracle(path, "repair_breaks")
