"""Secret scan with an incremental blob ledger.

Every version of every path is addressed by the SHA-256 of its content. The
ledger (two Parquet tables under one folder) records for each blob the
rule versions it has been scanned with, and the findings. A run scans only the
pairs of blob and rule version that the ledger lacks, appends its findings,
then the scanned pairs (a run that dies in between is repeated; findings are
read as a set), and joins all findings back to all paths and versions with
that content. A rule's version is a hash of its definition, so a changed rule
is scanned anew over all blobs and an unchanged one is not.

SQL functions only. Texts leave their scan only where a cheap condition says
that a rule may match; everything else moves as hashes.

Defined results: null content is the empty blob and has no findings; equal
rows are rows of their own; columns other than the ones named are ignored;
offsets are code points, the end exclusive.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.sieve import parted, sieved
from quire.llm.spans import Pattern, joined, matches


@dataclass(frozen=True)
class Rule:
    """``least``: characters that ``group`` (0: the whole match) must have."""
    kind: str
    regex: str
    sieve: str
    group: int = 0
    least: int = 1

    @property
    def version(self) -> str:
        return f"{self.kind}@{hashlib.sha256(repr((self.regex, self.group, self.least)).encode()).hexdigest()[:12]}"


#: The contract's kinds, in order.
BASE = [
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]++)""",
         r"text rlike '(?i:password|passwd|secret|token|api_?key)'", 1, 8),
    Rule("access", r"AKIA[A-Z0-9]{12,}+", "contains(text, 'AKIA')", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}+", "text rlike '[0-9a-f]{32}'", 0, 32),
]
#: Further kinds with a form of their own.
MORE = [
    Rule("pem", r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----", "contains(text, 'PRIVATE KEY-----')"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+", "contains(text, 'eyJ')"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}+", "text rlike 'gh[pousr]_'"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}+", "contains(text, 'xox')"),
]
RULES = BASE + MORE


def blob():
    return F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256))


def _read(spark, path: str, schema: str) -> DataFrame:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
    return spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)


def update_ledger(versions: DataFrame, ledger: str, rules: list[Rule] = RULES) -> DataFrame:
    """Scan what the ledger lacks of the blobs of ``versions`` (a ``text``
    column); returns all its findings for these rules: blob, kind, start, end."""
    spark = versions.sparkSession
    scanned = f"{ledger.rstrip('/')}/scanned", "blob binary, rules array<string>"
    findings = f"{ledger.rstrip('/')}/findings", "blob binary, rule string, kind string, start long, end long"
    wanted = F.array(*[F.lit(r.version) for r in rules])
    seen = _read(spark, *scanned).groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("rules"))
    content = versions.select(blob().alias("blob"), "text")
    todo = content.select("blob").distinct().join(seen, "blob", "left").select(
        "blob", F.array_except(wanted, F.coalesce("rules", F.array().cast("array<string>"))).alias("rules")).where("size(rules) > 0")
    from quire.session import materialize
    todo = materialize(todo)
    patterns = [Pattern(r.version, r.regex, r.sieve) for r in rules]
    may = " or ".join(f"({p.sieve})" for p in patterns)
    texts = sieved(content, todo, ["blob"]).where(may).join(todo, "blob").dropDuplicates(["blob"])
    texts = materialize(texts)
    # A rule that a blob has been scanned with is not run on it again.
    open_ = [Pattern(p.kind, p.regex, f"array_contains(rules, '{p.kind}') and ({p.sieve})") for p in patterns]
    passed = F.lit(False)
    for r in rules:
        part = F.length(F.regexp_extract("match", r.regex, r.group)) if r.group else F.length("match")
        passed = F.when(F.col("kind") == r.version, part >= r.least).otherwise(passed)
    found = matches(texts, "blob", open_).where(passed).select(
        "blob", F.col("kind").alias("rule"), F.substring_index("kind", "@", 1).alias("kind"), "start", "end")
    found.write.mode("append").parquet(findings[0])
    todo.write.mode("append").parquet(scanned[0])
    return _read(spark, *findings).where(F.col("rule").isin([r.version for r in rules])) \
        .select("blob", "kind", "start", "end").distinct()


def scan(versions: DataFrame, ledger: str, rules: list[Rule] = RULES) -> DataFrame:
    """Findings of every path and version: ``path``, ``version``, blob, kind,
    start, end. ``versions``: columns path, version, text."""
    found = update_ledger(versions, ledger, rules)
    return versions.select("path", "version", blob().alias("blob")).join(found, "blob")


def per_blob(found: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """blob, spans: the findings of a blob in order (bounded by its length)."""
    rank = F.lit(len(rules))
    for k, r in enumerate(rules):
        rank = F.when(F.col("kind") == r.kind, k).otherwise(rank)
    return found.groupBy("blob").agg(F.collect_list(F.struct("start", rank.alias("rank"), "kind", "end")).alias("spans"))


def document_findings(docs: DataFrame, ledger: str, rules: list[Rule] = RULES) -> DataFrame:
    """doc_id and spans (start, rank, kind, end) of each row of ``docs``."""
    from quire.session import materialize
    lists = materialize(per_blob(update_ledger(docs, ledger, rules), rules))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), blob().alias("blob")).join(lists, "blob", "left") \
        .select("doc_id", F.coalesce("spans", F.expr("array()").cast(lists.schema["spans"].dataType)).alias("spans"))


def _is(kind: str):
    return lambda x: x["kind"] == kind


def digest(found: DataFrame) -> DataFrame:
    """The query's columns."""
    base = F.filter("spans", lambda x: x["rank"] < len(BASE))
    counts = [F.size(F.filter("spans", _is(r.kind))).cast("long").alias(f"n_{r.kind}") for r in BASE]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, ledger: str, rules: list[Rule] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """The documents with every finding replaced by ``mark``; overlapping
    findings count as one. Columns stay, ``n_chars`` (if there) is renewed."""
    from quire.session import materialize
    lists = materialize(per_blob(update_ledger(docs, ledger, rules), rules))
    names = docs.columns
    held = docs.select(F.struct(*names).alias("row"), "text", blob().alias("blob"))
    may, sure = parted(held, lists, ["blob"])
    # Keep the text before each finding that starts after all earlier ones end.
    fold = F.expr(f"""aggregate(array_sort(spans), named_struct('at', 0L, 'out', ''),
        (a, x) -> named_struct('at', greatest(a.at, x.end), 'out', if(x.start >= a.at,
            concat(a.out, substring(text, int(a.at + 1), int(x.start - a.at)), '{mark}'), a.out)),
        a -> concat(a.out, substring(text, int(a.at + 1))))""")
    hit = may.join(lists, "blob", "left").withColumn("text", F.when(F.col("spans").isNotNull(), fold).otherwise(F.col("text")))

    def renewed(name: str):
        if name == "text":
            return F.col("text")
        if name == "n_chars":
            kind = docs.schema["n_chars"].dataType
            return F.when(F.col("spans").isNotNull(), F.length("text").cast(kind)).otherwise(F.col("row.n_chars")).alias(name)
        return F.col("row").getField(name).alias(name)

    return sure.select("row.*").unionByName(hit.select(*[renewed(c) for c in names]))
