"""Rate-limit scheduling and audit as window algebra.

The original pipeline throttles one process with a sleeping limiter. Here the
same rules are computed for *all* keys at once over tables of arrivals or
calls, in integer microseconds so every engine agrees exactly:

* open loop (R2):   ``s_i = max(a_i, s_{i-1} + d)``  ⇒
  ``s_i = i*d + max_{j<=i}(a_j - j*d)``  (a running max, no state);
* closed loop (R1): next send ``= previous send + max(service + pause, d)``
  ⇒ an exclusive running sum;
* audit (R3):       gap to the previous send ``< d`` (W6) and more than
  ``qpm`` sends within one window (W7, via the ``qpm``-th previous send).

Running values come from :func:`quire.operators.scan.keyed_scan` and lags from
:func:`quire.operators.scan.halo_lags`, so one very busy key is spread over
many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions import constants as C
from quire.operators.scan import halo_lags, keyed_scan

US = 1_000_000


def gap_us(qpm: int = C.SPEECH_QPM, window_s: int = C.RATE_WINDOW_S) -> int:
    """Minimum spacing ``60/QPM`` seconds in microseconds."""
    return window_s * US // qpm


def open_loop_schedule(arrivals: DataFrame, key: str, at: str, order: list[str], d_us: int,
                       n_slices: int | None = None) -> DataFrame:
    """R2: earliest send time per request given arrival ``at`` (µs) and a
    minimum spacing ``d_us``; adds ``i``, ``send_us`` and ``delay_us``. A null
    key is a key of its own."""
    # A value that no key has stands for null, so that the scan's joins keep it.
    s = keyed_scan(arrivals.withColumn("_k", F.to_json(F.struct(key))), "_k", order, linear_max={"_m": (F.col(at), d_us)}, n_slices=n_slices)
    send = F.col("i") * d_us + F.col("_m")
    return s.select(*arrivals.columns, "i", send.alias("send_us"),
                    (send - F.col(at)).alias("delay_us"))


def closed_loop_schedule(calls: DataFrame, key: str, service: str, order: list[str], d_us: int,
                         pause_us: int = C.PAUSE_AFTER_CALL_S * US,
                         n_slices: int | None = None) -> DataFrame:
    """R1 + R4: requests queued up front; each send waits for the previous
    call to end (service + fixed pause) and for the spacing ``d_us``."""
    step = F.greatest(F.col(service) + F.lit(pause_us), F.lit(d_us))
    s = keyed_scan(calls, key, order, sums={"_cum": step}, n_slices=n_slices)
    send = F.col("_cum") - F.greatest(F.col(service) + F.lit(pause_us), F.lit(d_us))
    return s.select(*calls.columns, "i", send.alias("send_us"),
                    (send + F.col(service)).alias("end_us"))


def audit(sends: DataFrame, key: str, order: list[str], t: str, d_us: int, qpm: int,
          window_us: int = C.RATE_WINDOW_S * US, n_slices: int | None = None) -> DataFrame:
    """Flag W6 (gap to the previous send below ``d_us``) and W7 (the
    ``qpm``-th previous send lies inside the window, i.e. more than ``qpm``
    sends in ``(t - window, t]``) for every row. ``span_us`` is the time that
    the last ``qpm + 1`` sends took; it and ``gap_us`` are null where a key has
    fewer."""
    s = audit_all(sends, key, order, [t], d_us, qpm, window_us, n_slices)
    return s.select(key, t, *[F.col(f"{t}_{c}").alias(c) for c in ("gap_us", "span_us", "gap_violation", "window_violation")])


def audit_all(sends: DataFrame, key: str, order: list[str], times: list[str], d_us: int, qpm: int,
              window_us: int = C.RATE_WINDOW_S * US, n_slices: int | None = None) -> DataFrame:
    """:func:`audit` of several times of the same rows in one pass; its columns
    have the time's name before them."""
    s = halo_lags(sends.select(*dict.fromkeys([key, *order, *times])), key, order, times, sorted({1, qpm}), n_slices)
    out = []
    for t in times:
        gap, span = F.col(t) - F.col(f"{t}_lag1"), F.col(t) - F.col(f"{t}_lag{qpm}")
        out += [gap.alias(f"{t}_gap_us"), span.alias(f"{t}_span_us"),
                F.coalesce(gap < d_us, F.lit(False)).alias(f"{t}_gap_violation"),
                F.coalesce(span < window_us, F.lit(False)).alias(f"{t}_window_violation")]
    return s.select(key, *times, *out)
