"""Quality rules: base counts, then robust multivariate outliers.

Each text gives a vector of transformed statistics: mean word length, shares
of symbols, of repeated lines and of repeated words, on logarithmic scales.
For each language and source the minimum-covariance-determinant estimate is
found over the documents that pass the base rules: from a start around the
coordinate medians, concentration steps keep the ``SUPPORT`` share of smallest
Mahalanobis distances and estimate mean and covariance from them anew; a last
step reweights by the cutoff. Documents farther than the cutoff are rejected.
Groups of fewer than ``LEAST`` documents are pooled by language, and then
altogether. Each coordinate has a least variance (``FLOOR``), as shares that
are zero in nearly all documents would otherwise reject any other value.

SQL functions only. Statistics are whole thousandths, and sums of them and of
their products exact, so results do not depend on partitioning; quantiles are
taken over bounded numbers of distinct values. Only one row for each group
meets the documents again.

Defined results: a null text has no words and fails; null languages or
sources are groups of their own (as the empty string); equal rows are rows of
their own; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.session import materialize

SUPPORT = 0.75
STEPS = 2
LEAST = 50
SALTS = 32
#: Squared distance beyond which a document is rejected.
CUTOFF = 36.0
#: Least standard deviation of each statistic, in thousandths. Of shares of
#: repeats it is less than the largest value (1000 log1p(100) of lines, 1000
#: log1p(50) of words that pass the base rules) over the cutoff's root, so that
#: each can reject by itself.
FLOOR = {"x_length": 80, "x_symbols": 350, "x_lines": 600, "x_words": 600}
NAMES = list(FLOOR)
_SPACE = r"[ \t\n\x0B\f\r]+"


def with_counts(rows: DataFrame) -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and
    base_failed, each from the row's own ``text``."""
    names = rows.columns
    rows = rows.withColumn("_w", F.array_remove(F.split(F.coalesce("text", F.lit("")), _SPACE), ""))
    rows = rows.withColumn("_l", F.expr(r"filter(split(coalesce(text, ''), '\n'), x -> x rlike '[^ \\t\\n\\x0B\\f\\r]')"))
    rows = rows.withColumn("_h", F.expr("""if(size(_w) < 3, array(), transform(sequence(0, size(_w) - 3),
        i -> xxhash64(_w[i], _w[i + 1], _w[i + 2])))"""))
    # Places of windows found twice: equal neighbours in the order of hashes.
    rows = rows.withColumn("_s", F.expr("""if(size(array_distinct(_h)) = size(_h), null,
        sort_array(transform(_h, (x, i) -> named_struct('h', x, 'i', i))))"""))
    rows = rows.withColumn("_p", F.expr("""sort_array(filter(transform(_s, (x, k) ->
        if(get(_s, k - 1).h <=> x.h or get(_s, k + 1).h <=> x.h, x.i, -1)), v -> v >= 0))"""))
    covered = F.expr("""aggregate(_p, named_struct('c', 0, 'e', 0), (a, x) ->
        named_struct('c', a.c + x + 3 - greatest(a.e, x), 'e', x + 3), a -> a.c)""")
    n = F.size("_w").cast("long")
    rows = rows.select(
        *names, n.alias("n_words"), F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.coalesce(F.regexp_count("text", F.lit("[#*$%&|<>]")), F.lit(0)).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"), F.size("_l").alias("_lines"))
    return rows.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def with_vector(rows: DataFrame) -> DataFrame:
    """Add the statistics (whole thousandths) and the group's language and source."""
    def share(a, b) -> Column:
        return F.log1p(100 * F.col(a) / F.greatest(F.col(b), F.lit(1)))

    def whole(x) -> Column:
        return F.round(1000 * x).cast("long")

    return rows.withColumns({
        "x_length": whole(F.log1p(F.col("word_chars") / F.greatest("n_words", F.lit(1)))),
        "x_symbols": whole(share("n_symbols", "word_chars")), "x_lines": whole(share("n_dup_lines", "_lines")),
        "x_words": whole(share("n_repeat_words", "n_words")),
        "g_lang": F.coalesce(F.col("lang").cast("string"), F.lit("")),
        "g_source": F.coalesce(F.col("source").cast("string"), F.lit(""))}).drop("_lines")


def _moments(rows: DataFrame) -> DataFrame:
    """g, mean (m_…) and the lower Cholesky factor (l_…) of each group's
    covariance with the least variances added."""
    exact = "decimal(20,0)"
    sums = [F.count(F.lit(1)).alias("n")]
    for j, a in enumerate(NAMES):
        sums.append(F.sum(F.col(a).cast(exact)).alias(f"s_{a}"))
        for b in NAMES[:j + 1]:
            sums.append(F.sum((F.col(a) * F.col(b)).cast(exact)).alias(f"s_{a}_{b}"))
    out = rows.groupBy("g").agg(*sums)
    d = lambda c: F.col(c).cast("double")
    out = out.select("g", "n", *[(d(f"s_{a}") / F.col("n")).alias(f"m_{a}") for a in NAMES],
                     *[(d(f"s_{a}_{b}") / F.col("n") - d(f"s_{a}") * d(f"s_{b}") / F.col("n") / F.col("n")
                        + (FLOOR[a] ** 2 if a == b else 0)).alias(f"c_{a}_{b}")
                       for j, a in enumerate(NAMES) for b in NAMES[:j + 1]])
    for j, a in enumerate(NAMES):
        for k, b in enumerate(NAMES[:j + 1]):
            rest = F.col(f"c_{a}_{b}")
            for c in NAMES[:k]:
                rest = rest - F.col(f"l_{a}_{c}") * F.col(f"l_{b}_{c}")
            # Rounding may take a variance below its floor.
            out = out.withColumn(f"l_{a}_{b}", F.sqrt(F.greatest(rest, F.lit(float(FLOOR[a] ** 2)))) if a == b
                                 else rest / F.col(f"l_{b}_{b}"))
    return out.select("g", *[f"m_{a}" for a in NAMES],
                      *[f"l_{a}_{b}" for j, a in enumerate(NAMES) for b in NAMES[:j + 1]])


def _meet(rows: DataFrame, groups: DataFrame, how: str = "inner") -> DataFrame:
    """Join rows with their group's row. The group's row is there ``SALTS``
    times, so a group with a large part of all rows is dealt over that many
    tasks, and an aggregation that follows combines inside them first."""
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")
    groups = groups.withColumn("_salt", F.explode(F.expr(f"sequence(0, {SALTS - 1})")))
    return rows.withColumn("_salt", salt).join(groups, ["g", "_salt"], how).drop("_salt")


def _distance(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """Add the squared Mahalanobis distance ``d2`` (forward substitution)."""
    names = rows.columns
    rows = _meet(rows, estimate, "left")
    for j, a in enumerate(NAMES):
        rest = F.col(a) - F.col(f"m_{a}")
        for b in NAMES[:j]:
            rest = rest - F.col(f"l_{a}_{b}") * F.col(f"z_{b}")
        rows = rows.withColumn(f"z_{a}", rest / F.col(f"l_{a}_{a}"))
    return rows.select(*names, sum((F.col(f"z_{a}") * F.col(f"z_{a}") for a in NAMES), F.lit(0.0)).alias("d2"))


def estimates(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Groups (g_lang, g_source, g) and their estimates, from written vectors."""
    good = vectors.where("not base_failed")
    counts = vectors.groupBy("g_lang", "g_source").agg(F.sum(F.expr("int(not base_failed)")).alias("n"))
    by_lang = counts.groupBy("g_lang").agg(F.sum(F.expr(f"if(n < {LEAST}, n, 0)")).alias("pool"))
    groups = materialize(counts.join(by_lang, "g_lang").select(
        "g_lang", "g_source", F.when(F.col("n") >= LEAST, F.to_json(F.struct("g_lang", "g_source")))
        .when(F.col("pool") >= LEAST, F.to_json(F.struct("g_lang"))).otherwise("all").alias("g")))
    good = materialize(good.join(groups, ["g_lang", "g_source"]).select("g", *NAMES))
    # Start: the documents nearest to the medians, each statistic over its floor.
    medians = materialize(good.groupBy("g").agg(*[F.percentile(a, 0.5).alias(f"p_{a}") for a in NAMES]))
    far = sum((F.abs(F.col(a) - F.col(f"p_{a}")) / FLOOR[a] for a in NAMES), F.lit(0.0))
    scored = _meet(good, medians).select("g", *NAMES, far.alias("d2"))
    for _ in range(STEPS + 1):
        scored = scored.withColumn("bin", F.least(F.floor(F.col("d2") * 64), F.lit(1 << 14)).cast("int"))
        limit = materialize(scored.groupBy("g").agg(F.percentile("bin", SUPPORT).alias("limit")))
        estimate = materialize(_moments(_meet(scored, limit).where("bin <= limit").select("g", *NAMES)))
        scored = _distance(good, estimate)
    return groups, materialize(_moments(scored.where(F.col("d2") <= CUTOFF).select("g", *NAMES)))


def _judge(vectors: DataFrame, groups: DataFrame, estimate: DataFrame) -> DataFrame:
    rows = _distance(vectors.join(groups, ["g_lang", "g_source"], "left"), estimate)
    # No estimate (no document of the pool passes the base rules): only these decide.
    # One condition over both sides of the join: a part of it pushed below
    # would run the counts again for each use of them.
    return rows.withColumn("kept", F.when(F.col("base_failed"), F.lit(False)).otherwise(
        F.coalesce("d2", F.lit(0.0)) <= CUTOFF))


_OUT = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, kept and the squared distance."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source")
    vectors = materialize(with_vector(with_counts(rows)).select("doc_id", *_OUT, *NAMES, "g_lang", "g_source"))
    return _judge(vectors, *estimates(vectors)).select("doc_id", *_OUT, "kept", F.round("d2", 3).alias("distance2"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with their own columns. The counts are
    made again from the text, which is cheaper than to shuffle it."""
    names = docs.columns
    plain = docs.select("text", "lang", "source")
    vectors = materialize(with_vector(with_counts(plain)).select("base_failed", *NAMES, "g_lang", "g_source"))
    groups, estimate = estimates(vectors)
    held = docs.select(F.struct(*names).alias("_row"), "text", "lang", "source")
    return _judge(with_vector(with_counts(held)), groups, estimate).where("kept").select("_row.*")
