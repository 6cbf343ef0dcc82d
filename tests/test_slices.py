"""Lags with halos and the sweep join, against plain loops."""

import random

import pytest

from quire.operators import pages as PG
from quire.operators import scan as SC
from quire.operators import sweep as SW
from quire.plans import fixtures as FX
from quire.plans import queries as Q


@pytest.mark.parametrize("n_rows, n_slices", [(3000, 16), (40, 32), (1, 4), (0, 4)])
def test_halo_lags(spark, n_rows, n_slices):
    """A hot key over many slices, keys shorter than the lag, a null key, and
    slices of fewer rows than the lag."""
    r = random.Random(n_rows)
    rows = [(r.choice([1, 1, 1, 1, 2, None]), t, r.choice([None, t * 3])) for t in range(n_rows)]
    df = spark.createDataFrame(rows, "k int, t int, v int").repartition(5)
    got = SC.halo_lags(df, "k", ["t"], ["v", "t"], [1, 5], n_slices=n_slices)
    assert got.columns == ["k", "t", "v", "v_lag1", "v_lag5", "t_lag1", "t_lag5"]
    seen, want = {}, []
    for k, t, v in rows:
        old = seen.setdefault(k, [])
        back = [old[-n] if len(old) >= n else (None, None) for n in (1, 5)]
        want.append((k, t, v, back[0][1], back[1][1], back[0][0], back[1][0]))
        old.append((t, v))
    assert sorted(map(repr, (tuple(x) for x in got.collect()))) == sorted(map(repr, want))


def _brute(points, ranges):
    return sorted((b, p, x, c) for b, p, x in points for rb, c, s, e in ranges
                  if None not in (b, p, rb, s, e) and b == rb and s <= p < e)


@pytest.mark.parametrize("n_slices", [1, 7, 40])
def test_sweep_join(spark, n_slices):
    """Overlapping, nested, equal, empty, reversed and null ranges; repeated
    points; ranges over many slices and beyond the points of their key."""
    r = random.Random(n_slices)
    points = [(r.choice([1, 1, 1, 2, 3, None]), r.choice([None, *range(300)]), f"p{i}") for i in range(800)]
    ranges = [(r.choice([1, 1, 2, 4, None]), c, s, s + r.choice([-5, 0, 1, 2, 30, 400])) for c in range(40)
              for s in [r.randrange(-20, 310)]]
    ranges += [(1, 90, None, 50), (1, 91, 5, None), (2, 92, 10, 60), (2, 92, 10, 60), (3, 93, -100, 1000)]
    p = spark.createDataFrame(points, "book int, page int, text string").repartition(3)
    q = spark.createDataFrame(ranges, "book int, chapter long, a int, z int").repartition(3)
    got = SW.sweep_join(p, q, "book", "page", "a", "z", "chapter", n_slices=n_slices)
    assert got.columns == ["book", "page", "text", "chapter"]
    assert sorted(map(tuple, got.collect())) == _brute(points, ranges)


def test_sweep_join_of_empty_tables(spark):
    p = spark.createDataFrame([(1, 1, "x")], "book int, page int, text string")
    q = spark.createDataFrame([(1, 1, 0, 5)], "book int, chapter long, a int, z int")
    assert SW.sweep_join(p, q.limit(0), "book", "page", "a", "z", "chapter", 3).count() == 0
    assert SW.sweep_join(p.limit(0), q, "book", "page", "a", "z", "chapter", 3).count() == 0


def test_sweep_equals_range_join(spark, small):
    pages = FX.book_pages(spark, small)
    ranges = PG.chapter_ranges(PG.chapter_starts(pages), PG.book_page_counts(pages))
    want = PG.assign_pages(pages, ranges).select("book_id", "chapter_no", "page_no")
    got = SW.sweep_join(PG.non_empty_pages(pages), ranges, "book_id", "page_no", "start_page", "end_page", "chapter_no", 5)
    assert sorted(map(tuple, got.select("book_id", "chapter_no", "page_no").collect())) == sorted(map(tuple, want.collect()))


def test_rate_audit_covers_the_schedule(spark, tmp_path):
    """Arrivals too close are raw violations and delays; the schedule of them
    has none. Users without a number and arrivals without a time count too."""
    r = random.Random(5)
    rows = [(i, r.choice([None, *range(40_000)]), r.choice([1, 1, 1, 2, None])) for i in range(300)]
    events = spark.createDataFrame(rows, "event_id long, s int, user_id long")
    events.selectExpr("event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, s) as ts", "user_id") \
        .write.parquet(f"{tmp_path}/events.parquet")
    hour, minute, base = 3_600_000_000, 60_000_000, 1_704_067_200_000_000
    want = []
    for user in (1, 2, None):
        at = sorted((x[1] is not None, x[1] or 0) for x in rows if x[2] == user)
        at = [base + t * 1_000_000 if known else None for known, t in at]
        send, last = [], None
        for t in at:
            last = max([x for x in (t, None if last is None else last + hour) if x is not None], default=None)
            send.append(last)

        def steps(ts, n):
            return [b - a for a, b in zip(ts, ts[n:]) if a is not None and b is not None]

        late = [s - t for s, t in zip(send, at) if t is not None and s is not None]
        want.append((user, len(at), sum(x < hour for x in steps(at, 1)), sum(x < minute for x in steps(at, 5)),
                     sum(x < hour for x in steps(send, 1)), sum(x < minute for x in steps(send, 5)),
                     sum(x > 0 for x in late), max(late), min(steps(at, 1)), min(steps(at, 5))))
    got = Q.QUERIES["rate_audit"](spark, str(tmp_path))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    assert all(x[4] == x[5] == 0 < x[6] for x in want)
