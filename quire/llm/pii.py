"""Personal data: candidate spans, gradient boosting, calibrated thresholds.

Generators with high recall propose spans, which may overlap: the four base
forms, and looser ones (spelled-out mail addresses, national phone numbers,
grouped identity numbers, account numbers, any long group of digits). A
candidate is described by its format (form, length, digits, separators, the
checks it passes) and its context (characters around it, telling words before
it), all as a few small whole numbers.

No spans are labelled, so the boosted trees learn from the candidates
themselves: one that a check with strong evidence confirms (a mail address, an
address of four parts up to 255, a Luhn sum, an international number) is
positive, one of the same kind that fails it negative, and forms without a
check are scored by what they share with these. The checks' own outcomes are no
features. Candidates are counted by their features first, so training sees a
bounded table of counts, whatever the corpus. Half of the texts train; the
other half sets the threshold: the lowest with a precision of ``PRECISION``.
If none reaches it, or one class is missing, nothing is added.

Redacted spans are all base spans, and those other candidates over the
threshold that overlap no base span and no earlier added one. SQL functions
and the DataFrame-based trees of Spark ML only.

Defined results: null and empty texts have no spans; equal rows are rows of
their own; other columns are ignored; offsets are code points, end exclusive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.repeats import text_class
from quire.llm.spans import Pattern, joined, matches, suspects
from quire.session import materialize

#: Base forms, in order. Possessive loops and the look-behind (or the end of
#: the last match, \\G) keep long runs linear and change no match.
BASE = [
    Pattern("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "contains(text, '@')"),
    Pattern("ip", r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}+", r"text rlike '[0-9]\\.[0-9]'"),
    Pattern("card", r"[0-9](?:[\x20-]?[0-9]){11,}+", r"text rlike '[0-9](?:[ -]?[0-9]){11}'"),
    Pattern("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"text rlike '\\+[0-9]'"),
]
MORE = [
    Pattern("mail", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++\x20?[(\[]at[)\]]\x20?[A-Za-z0-9-]++"
            r"(?:\x20?(?:\.|[(\[]dot[)\]])\x20?[A-Za-z0-9-]++)++", r"text rlike '[(\\[]at[)\\]]'"),
    Pattern("national", r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
            r"text rlike '[0-9]{3}[ .-][0-9]{4}'"),
    Pattern("identity", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", r"text rlike '[0-9]-[0-9]{2}-[0-9]'"),
    Pattern("account", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}+", r"text rlike '[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}'"),
    Pattern("digits", r"[0-9](?:[\x20().-]{0,2}[0-9]){8,}+", r"text rlike '[0-9](?:[ ().-]{0,2}[0-9]){8}'"),
]
PATTERNS = BASE + MORE
AROUND = 24
PRECISION = 0.98
ROUNDS, DEPTH = 10, 3
FEATURES = ["kind_no", "length_no", "digits_no", "parts_no", "marks_no", "before_no", "after_no", "word_no"]
_RANK = {p.kind: k for k, p in enumerate(PATTERNS)}


def candidates(texts: DataFrame, key: str = "cls") -> DataFrame:
    """All proposed spans with the outcome of their check (``passes``; null
    where the form has none) and their features."""
    rows = matches(texts, key, PATTERNS, AROUND)
    rows = rows.withColumn("digits", F.regexp_replace("match", "[^0-9]", ""))
    # Luhn: every second digit from the right doubled, nines cast out.
    luhn = F.expr("""aggregate(transform(split(reverse(digits), ''), (d, i) ->
        if(d = '', 0, if(i % 2 = 1, int(d) * 2 - if(int(d) > 4, 9, 0), int(d)))), 0, (a, x) -> a + x) % 10 = 0""")
    octets = F.expr(r"forall(split(match, '\\.'), x -> length(ltrim('0', x)) <= 3 and int(concat('0', ltrim('0', x))) <= 255)")
    size = F.length("digits")
    rows = rows.withColumn("passes", F.when(F.col("kind") == "email", F.lit(True)).when(F.col("kind") == "ip", octets)
                           .when(F.col("kind") == "card", (size >= 12) & (size <= 19) & luhn)
                           .when(F.col("kind") == "phone", (size >= 9) & (size <= 15)))
    rank = F.lit(len(PATTERNS))
    for kind, k in _RANK.items():
        rank = F.when(F.col("kind") == kind, k).otherwise(rank)

    def group(c, *at):
        """Number of borders that the value reaches."""
        return sum((F.when(c >= x, 1).otherwise(0) for x in at), F.lit(0))

    def edge(c):
        return F.when(c == "", 0).when(c.rlike(r"^\s$"), 1).when(c.rlike("^[0-9]$"), 2).when(c.rlike(r"^[\p{L}]$"), 3).otherwise(4)

    near = F.lower(F.substring_index("before", "\n", -1))
    return rows.withColumns({
        "rank": rank, "kind_no": rank, "length_no": group(F.length("match"), 8, 11, 13, 15, 17, 20, 26, 40),
        "digits_no": group(size, 1, 7, 9, 11, 12, 13, 16, 17, 20, 32),
        "parts_no": F.least(F.size(F.split("match", r"[\x20().-]+")), F.lit(7)),
        "marks_no": F.when(F.col("match").contains("@"), 1).otherwise(0) + F.when(F.col("match").startswith("+"), 2).otherwise(0)
        + F.when(F.col("match").contains("("), 4).otherwise(0),
        "before_no": edge(F.right("before", F.lit(1))), "after_no": edge(F.left("after", F.lit(1))),
        "word_no": F.when(near.rlike("mail|contact|write to"), 1).when(near.rlike("phone|tel|call|fax|mobile|cell"), 2)
        .when(near.rlike("card|visa|credit|account|iban|payment"), 3).when(near.rlike("ssn|social|passport|birth"), 4)
        .when(near.rlike("host|server|addr|version|from ip"), 5).otherwise(0),
    }).select(key, "kind", "rank", "start", "end", "passes", *FEATURES)


def learn(found: DataFrame, key: str = "cls"):
    """Scores of feature rows and the calibrated threshold, or None. ``found``
    must be written: its folds are a hash of the text's key."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    fold = F.pmod(F.xxhash64(key), F.lit(2))
    cells = found.groupBy(*FEATURES).agg(*[
        F.count(F.when((fold == f) & (F.col("passes") == y), 1)).cast("double").alias(f"n{f}{int(y)}")
        for f in (0, 1) for y in (False, True)])
    cells = materialize(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(cells).select(
        *FEATURES, "features", "n00", "n01", "n10", "n11"))
    train = cells.select("features", F.explode(F.array(
        F.struct(F.lit(0.0).alias("label"), F.col("n00").alias("weight")),
        F.struct(F.lit(1.0).alias("label"), F.col("n01").alias("weight")))).alias("x")).select("features", "x.*").where("weight > 0")
    train = materialize(train.coalesce(1))  # a bounded table: one row for each cell and label
    if train.select("label").distinct().count() < 2:
        return None
    model = GBTClassifier(maxIter=ROUNDS, maxDepth=DEPTH, weightCol="weight", seed=7, checkpointInterval=-1).fit(train)
    scored = materialize(model.transform(cells).select(
        *FEATURES, "n10", "n11", vector_to_array("probability")[1].alias("p")))
    steps = scored.withColumn("t", F.explode(F.array(*[F.lit(k / 20) for k in range(10, 20)]))).where("p >= t")
    best = steps.groupBy("t").agg(F.sum("n11").alias("yes"), F.sum("n10").alias("no")).where(
        F.col("yes") >= PRECISION * (F.col("yes") + F.col("no"))).where("yes > 0").agg(F.min("t")).first()[0]
    return None if best is None else (scored.select(*FEATURES, "p"), best)


def chosen(docs: DataFrame) -> DataFrame:
    """(cls, spans): base and added spans of each distinct text that has any."""
    texts = suspects(docs.select(text_class().alias("cls"), "text"), PATTERNS).dropDuplicates(["cls"])
    found = materialize(candidates(materialize(texts)))
    base = found.where(F.col("passes")).select("cls", "kind", "rank", "start", "end")
    model = learn(found)
    if model is not None:
        scores, threshold = model
        extra = found.where(F.col("rank") >= len(BASE)).join(scores, FEATURES).where(F.col("p") >= threshold)
        # An added span stays if no base span touches it (the furthest end of
        # those that start before, the first start of those after) and no
        # added one that starts before it reaches over its start.
        both = base.withColumn("p", F.lit(2.0)).unionByName(extra.select("cls", "kind", "rank", "start", "end", "p"))
        order = Window.partitionBy("cls").orderBy("start", F.col("end").desc(), "rank")
        both = both.withColumn("reach", F.max(F.when(F.col("p") > 1, F.col("end"))).over(
            order.rowsBetween(Window.unboundedPreceding, -1)))
        both = both.withColumn("next", F.min(F.when(F.col("p") > 1, F.col("start"))).over(
            order.rowsBetween(1, Window.unboundedFollowing)))
        free = both.where((F.col("p") > 1) | ((F.coalesce("reach", F.lit(0)) <= F.col("start"))
                                              & (F.coalesce("next", F.col("end")) >= F.col("end"))))
        last = F.max(F.when(F.col("p") <= 1, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
        base = free.withColumn("last", last).where((F.col("p") > 1) | (F.coalesce("last", F.lit(0)) <= F.col("start"))) \
            .select("cls", "kind", "rank", "start", "end")
    return materialize(base.groupBy("cls").agg(F.collect_list(F.struct("start", "rank", "kind", "end")).alias("spans")))


def find(docs: DataFrame) -> DataFrame:
    """doc_id and spans (start, rank, kind, end) of each row of ``docs``."""
    lists = chosen(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_class().alias("cls"))
    return rows.join(lists, "cls", "left").select(
        "doc_id", F.coalesce("spans", F.expr("array()").cast(lists.schema["spans"].dataType)).alias("spans"))


def _is(kind: str):
    return lambda x: x["kind"] == kind


def digest(found: DataFrame) -> DataFrame:
    """The query's columns."""
    base = F.filter("spans", lambda x: x["rank"] < len(BASE))
    counts = [F.size(F.filter("spans", _is(p.kind))).cast("long").alias(f"n_{p.kind}") for p in BASE]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
