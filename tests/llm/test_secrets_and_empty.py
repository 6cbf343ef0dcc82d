"""Redaction and added secret kinds against plain Python; empty side tables."""

import re
import uuid

from pyspark.sql import functions as F

from quire.llm import decontaminate, oracle, secret_scan, toxicity
from quire.session import materialize, scratch_path

TOKEN = "eyJ" + "a" * 12 + "." + "b" * 12 + "." + "c" * 12
TEXTS = {
    1: None, 2: "", 3: "nothing here", 4: f"é😀 token = '{TOKEN}' end",  # assign and jwt overlap
    5: "password: " + "0123456789abcdef" * 3 + " tail",                # assign and hex overlap
    6: "-----BEGIN RSA PRIVATE KEY-----\nghp_" + "A1" * 18 + " xoxb-" + "1" * 12,
    7: "AKIA" + "A" * 11 + " AKIA" + "B" * 16 + "AKIA" + "C" * 3, 8: "secret=short api_key=longenough1 PassWD : 'longenough2'",
    9: "f" * 31 + " " + "f" * 32, 10: "ß" * 3000 + " apikey=" + "x" * 5000}


def spans(text):
    """All findings in order, by Python's own regular expressions."""
    out = []
    for rank, (kind, form, least, group) in enumerate(oracle._SECRETS):
        out += [(m.start(), rank, kind, m.end()) for m in re.finditer(form, text or "") if len(m.group(group)) >= least]
    return sorted(out)


def frame(spark):
    df = spark.createDataFrame([(i, t, len(t or "")) for i, t in TEXTS.items()], "doc_id long, text string, n_chars long")
    return materialize(df.withColumns({c: F.lit(7) for c in ("row", "spans", "blob", "kind", "start", "end")}))


def ledger(spark):
    return scratch_path(spark, f"ledger-{uuid.uuid4().hex}")


def test_all_kinds(spark):
    got = {r.doc_id: [tuple(x) for x in sorted(r.spans)] for r in secret_scan.document_findings(frame(spark), ledger(spark)).collect()}
    want = {i: [(a, rank, kind, z) for a, rank, kind, z in spans(t)] for i, t in TEXTS.items()}
    assert {k for v in want.values() for _, _, k, _ in v} == {k for k, *_ in oracle._SECRETS}
    assert got == want


def test_redaction(spark):
    docs = frame(spark)
    out = secret_scan.redact(docs, ledger(spark))
    assert out.columns == docs.columns
    for r in out.collect():
        text, at, new = TEXTS[r.doc_id], 0, ""
        for a, _, _, z in spans(text):
            if a >= at:
                new += text[at:a] + "[SECRET]"
            at = max(at, z)
        new = None if text is None else new + text[at:]
        assert r.text == new and r.n_chars == len(new or "") and r.row == r.spans == r.blob == 7


def test_a_second_run_scans_nothing_new(spark):
    path = ledger(spark)
    first = sorted(map(str, secret_scan.document_findings(frame(spark), path).collect()))
    scanned = spark.read.parquet(f"{path}/scanned").count()
    assert sorted(map(str, secret_scan.document_findings(frame(spark), path).collect())) == first
    assert spark.read.parquet(f"{path}/scanned").count() == scanned


def test_empty_side_tables(spark):
    docs = frame(spark).withColumns({"lang": F.lit("en"), "source": F.lit("s")})
    labels = spark.createDataFrame([], "doc_id long, quality long, toxic long")
    assert {(r.score, r.predicted) for r in toxicity.score(docs, labels).collect()} == {(0.5, 1)}
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(docs, items).collect() == []
    assert decontaminate.keep_clean(docs, items).count() == len(TEXTS)
