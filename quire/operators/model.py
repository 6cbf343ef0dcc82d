"""Batch model step.

The original pipeline calls a remote model once per chunk, retries up to three
times with 1 s / 2 s backoff and turns a final failure into a fixed text.
Here the call is a *pluggable callable* run by ``mapInArrow`` on parts of
Arrow batches (:mod:`quire.functions.arrow`), so that a task holds a bounded
number of texts and answers. Attempts, backoff,
service time, status and error are columns, so one failing chunk never
fails a task and every policy downstream (sentinel, empty, passthrough,
stop-at-first-failure, merge-only-if-complete) is plain DataFrame logic.

A real model is non-deterministic: call :func:`materialize` on the response
table before reusing it so that a retried stage never calls it twice.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions import arrow as AR
from quire.functions import constants as C
from quire.session import materialize  # noqa: F401  (re-exported)

# model(batch, attempt) -> DataFrame[output, error, service_us] aligned with batch;
# output None means the attempt failed.
Model = Callable[[pd.DataFrame, int], pd.DataFrame]

POLICIES = ("sentinel", "empty", "passthrough", "null")


def build_request(chunk: Column, part_no: Column, n_parts: Column, system: str, instruction: str,
                  temperature: float = 0.3, max_tokens: int = 16000) -> Column:
    """The request struct (own wording) with ``Part i of n``."""
    user = F.concat(F.lit(instruction), F.lit("\n\n"),
                    F.format_string("Text (part %d of %d):", part_no, n_parts),
                    F.lit("\n\n"), chunk)
    return F.struct(F.lit(system).alias("system"), user.alias("user"),
                    F.lit(temperature).alias("temperature"), F.lit(max_tokens).alias("max_tokens"))


def call_model(df: DataFrame, model: Model, keys: list[str], input_col: str = "input",
               on_failure: str = "sentinel", part_col: str = "part_no",
               max_attempts: int = C.MAX_ATTEMPTS, binary: bool = False,
               carry: list[str] | None = None, parallelism: int | None = None) -> DataFrame:
    """M1–M4 + M8: run ``model`` over ``input_col`` with retries.

    Output columns: ``keys``, ``output``, ``status`` (ok/failed), ``attempts``,
    ``backoff_s`` (sum of ``2**k`` for every retry), ``error``, ``service_us``.
    ``on_failure`` picks the text of a failed row: the chunk sentinel
    (``sentinel``), ``''`` (``empty``), the input (``passthrough``) or NULL.
    ``carry`` columns pass through unchanged (no join back to the input).
    ``parallelism`` bounds how many batches run at once (default: the scan's
    tasks); a batch is at most ``arrow.PART`` bytes of text, or one row. A model that raises fails rows, not the job: the batch is called
    again row by row, and a row that raises has the message as its error.
    """
    carry = [c for c in (carry or []) if c not in keys]
    if on_failure not in POLICIES:
        raise ValueError(on_failure)
    out_t = T.BinaryType() if binary else T.StringType()
    key_fields = [f for f in df.schema.fields if f.name in keys + carry]
    schema = T.StructType(key_fields + [
        T.StructField("output", out_t), T.StructField("status", T.StringType()),
        T.StructField("attempts", T.IntegerType()), T.StructField("backoff_s", T.IntegerType()),
        T.StructField("error", T.StringType()), T.StructField("service_us", T.LongType())])
    cols = list(dict.fromkeys(keys + carry + [input_col] + ([part_col] if part_col in df.columns else [])))
    out_cols = [f.name for f in key_fields]

    def answer(part):
        pdf = part.to_pandas()
        n = len(pdf)
        output = np.empty(n, dtype=object)
        error = np.empty(n, dtype=object)
        attempts = np.zeros(n, dtype=np.int32)
        service = np.zeros(n, dtype=np.int64)
        ok = np.zeros(n, dtype=bool)
        pending = np.arange(n)
        for a in range(1, max_attempts + 1):
            if len(pending) == 0:
                break
            batch = pdf.iloc[pending].reset_index(drop=True)
            res = _isolated(model, batch, a)
            got = res["output"].to_numpy(dtype=object)
            success = np.array([g is not None for g in got], dtype=bool)
            attempts[pending] = a
            service[pending] += res["service_us"].to_numpy(dtype=np.int64)
            output[pending[success]] = got[success]
            ok[pending[success]] = True
            error[pending[success]] = None
            error[pending[~success]] = res["error"].to_numpy(dtype=object)[~success]
            pending = pending[~success]
        failed = ~ok
        if on_failure == "sentinel":
            nos = pdf[part_col].to_numpy() if part_col in pdf else np.zeros(n, dtype=int)
            output[failed] = [C.FAILED_CHUNK_TEXT % int(p) for p in nos[failed]]
        elif on_failure == "empty":
            output[failed] = b"" if binary else ""
        elif on_failure == "passthrough":
            output[failed] = pdf[input_col].to_numpy(dtype=object)[failed]
        else:
            output[failed] = None
        return pa.RecordBatch.from_arrays(
            [*(part.column(c) for c in out_cols),
             pa.array(output, pa.binary() if binary else pa.string(), from_pandas=True),
             pa.array(np.where(ok, "ok", "failed").tolist(), pa.string()), pa.array(attempts),
             pa.array((np.left_shift(1, np.maximum(attempts - 1, 0)) - 1).astype(np.int32)),
             pa.array(error, pa.string(), from_pandas=True), pa.array(service)], schema.names)

    def run(batches):
        for b in batches:
            for part in AR.parts(b):
                yield answer(part)

    rows = df.select(*cols)
    if parallelism is not None:
        rows = rows.repartition(parallelism, *keys)
    return rows.mapInArrow(run, schema)


def _isolated(model: Model, batch: pd.DataFrame, attempt: int) -> pd.DataFrame:
    """One attempt over a batch; an exception becomes a failed row."""
    try:
        return model(batch, attempt)
    except Exception as e:
        if len(batch) == 1:
            return pd.DataFrame({"output": [None], "error": [f"{type(e).__name__}: {e}"], "service_us": [0]})
        return pd.concat([_isolated(model, batch.iloc[[i]].reset_index(drop=True), attempt)
                          for i in range(len(batch))], ignore_index=True)


def reassemble(responses: DataFrame, keys: list[str], text_col: str = "output",
               part_col: str = "part_no", sep: str = C.PAGE_JOIN_SEPARATOR) -> DataFrame:
    """J6 + A2: chunk outputs back into one text per chapter, in part order,
    with success / failure counts (A5)."""
    sep_sql = sep.replace("\n", "\\n")
    return responses.groupBy(*keys).agg(
        F.expr(f"listagg({text_col}, '{sep_sql}') WITHIN GROUP (ORDER BY {part_col})").alias("text"),
        F.count("*").alias("n_parts"),
        F.count_if(F.col("status") == "ok").alias("n_ok"),
        F.count_if(F.col("status") != "ok").alias("n_failed"))


def pair_responses(requests: DataFrame, responses: DataFrame, keys: list[str], order: list[str],
                   part_col: str = "part_no", input_col: str = "input", output_col: str = "output",
                   on_failure: str = "sentinel") -> DataFrame:
    """Every request with its own answer, by key and part number.

    A left join from the requests, so a lost answer leaves a gap that is
    filled by the policy (see :func:`call_model`) and ``n_parts`` counts what
    was asked, not what came back. Of several answers to one request the first
    in ``order`` counts (ties: the least text); null answers and answers to no
    request are ignored, and so are requests without a key.

    Output: ``keys``, the part, ``n_parts``, the input, ``output``, ``status``.
    """
    if on_failure not in POLICIES:
        raise ValueError(on_failure)
    k = [*keys, part_col]
    first = responses.where(F.col(output_col).isNotNull()).groupBy(*k).agg(
        F.min(F.struct(*order, F.col(output_col).alias("_text"))).getField("_text").alias("_answer"))
    totals = requests.groupBy(*keys).agg(F.count("*").cast("int").alias("n_parts"))
    filled = {"sentinel": F.replace(F.lit(C.FAILED_CHUNK_TEXT), F.lit("%d"), F.col(part_col).cast("string")),
              "empty": F.lit(""), "passthrough": F.col(input_col), "null": F.lit(None).cast("string")}[on_failure]
    both = requests.select(*k, input_col).join(totals, keys).join(first, k, "left")
    return both.select(*k, "n_parts", input_col, F.coalesce("_answer", filled).alias("output"),
                       F.when(F.col("_answer").isNull(), F.lit("failed")).otherwise(F.lit("ok")).alias("status"))


def stop_at_first_failure(responses: DataFrame, keys: list[str], part_col: str = "part_no") -> DataFrame:
    """M6: parts after the first failed part of a chapter were never
    attempted: their status becomes ``not_attempted`` and output NULL.

    Calls run in parallel, so the cut is applied after the fact; the
    outcome is identical to the sequential loop."""
    w = Window.partitionBy(*keys)
    first_fail = F.min(F.when(F.col("status") != "ok", F.col(part_col))).over(w)
    late = first_fail.isNotNull() & (F.col(part_col) > first_fail)
    return responses.select(
        *[c for c in responses.columns if c not in ("status", "output", "attempts", "backoff_s")],
        F.when(late, F.lit("not_attempted")).otherwise(F.col("status")).alias("status"),
        F.when(late, F.lit(None)).otherwise(F.col("output")).alias("output"),
        F.when(late, F.lit(0)).otherwise(F.col("attempts")).alias("attempts"),
        F.when(late, F.lit(0)).otherwise(F.col("backoff_s")).alias("backoff_s"))


def non_empty(df: DataFrame, col: str) -> DataFrame:
    """P20: no speech for a chapter whose translation is empty."""
    return df.where(F.col(col).isNotNull() & (F.col(col) != ""))


def summary_input(translation: Column, original: Column, n: int = C.SUMMARY_INPUT_CHARS) -> Column:
    """P21 + P9: translation when non-empty, else the original; first ``n`` chars."""
    return F.substring(F.coalesce(F.nullif(translation, F.lit("")), original), 1, n)


def replace_partitions(table: DataFrame, fresh: DataFrame, keys: list[str]) -> DataFrame:
    """M9/K2 as a DataFrame: rows of ``fresh`` replace the rows of ``table``
    with the same keys (what a dynamic partition overwrite does on disk)."""
    return table.join(fresh.select(*keys).distinct(), keys, "left_anti").unionByName(fresh)

