"""The stream that reports empty windows, against a plain loop over days."""

from __future__ import annotations

import datetime as dt
from collections import Counter, defaultdict

import numpy as np
import pytest

from casecurve.streaming.complete import start_complete_windows

SCHEMA = "series_id string, event_ts timestamp"
START = dt.datetime(2024, 3, 1)


def run(spark, folder, out, checkpoint):
    events = spark.readStream.schema(SCHEMA).parquet(folder)
    start_complete_windows(events, out, checkpoint, available_now=True).awaitTermination()
    rows = spark.read.parquet(out).collect()
    assert len({(r.series_id, r.window_start) for r in rows}) == len(rows)
    return {(r.series_id, (r.window_start - START).days): r for r in rows}


def by_hand(events):
    """(series, day) -> (count, mean and std of the days before) up to the last closed day."""
    upto = (max(t for _, t in events) - dt.timedelta(days=1) - START) / dt.timedelta(days=1)
    counts, first = Counter(), defaultdict(lambda: 10**6)
    for name, t in events:
        day = (t - START).days
        counts[name, day] += 1
        first[name] = min(first[name], day)
    out = {}
    for name, lo in first.items():
        y = [counts[name, d] for d in range(lo, int(upto))]
        for i, v in enumerate(y):
            out[name, lo + i] = (v, np.mean(y[:i]) if i else None, np.std(y[:i], ddof=1) if i > 1 else None)
    return out


def events_of(rng, name, days, rate):
    return [(name, START + dt.timedelta(days=d, seconds=int(rng.integers(86_400)))) for d in days for _ in range(rng.poisson(rate))]


def same(got, want):
    assert set(got) == set(want)
    for key, (y, mean, std) in want.items():
        r = got[key]
        assert r.y == y
        assert r.mean == (None if mean is None else pytest.approx(mean))
        assert r.std == (None if std is None else pytest.approx(std, abs=1e-9))
        if std:
            assert r.z_score == pytest.approx((y - mean) / std, abs=0.0051)
            assert r.is_anomaly == (r.z_score >= 2)
    assert all(r.z_score is None and not r.is_anomaly for r in got.values() if r.n_before < 2)


def test_silent_days_are_reported_once_across_restarts(spark, tmp_path):
    rng = np.random.default_rng(3)
    folder, out, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "progress")
    first = events_of(rng, "steady", range(0, 12), 6) + events_of(rng, "rare", range(0, 12), 0.4) + [("falls silent", START)]
    spark.createDataFrame(first, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    same(run(spark, folder, out, checkpoint), by_hand(first))
    # The second run goes on from the stored state; nothing of the first is written again.
    second = events_of(rng, "steady", range(12, 30), 6) + [("new", START + dt.timedelta(days=20, hours=1))] + events_of(rng, "rare", range(25, 30), 3)
    spark.createDataFrame(second, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    got = run(spark, folder, out, checkpoint)
    same(got, by_hand(first + second))
    assert sum(r.y == 0 for (name, _), r in got.items() if name == "falls silent") == max(d for _, d in got)


def test_late_events_are_dropped_and_zero_stays(spark, tmp_path):
    folder, out, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "progress")
    rng = np.random.default_rng(4)
    first = [(n, t) for n, t in events_of(rng, "a", range(0, 10), 4) if (t - START).days != 3]
    spark.createDataFrame(first, SCHEMA).coalesce(1).write.parquet(folder)
    before = run(spark, folder, out, checkpoint)
    late = [("a", START + dt.timedelta(days=3, hours=2)), ("a", START + dt.timedelta(days=11, hours=2))]
    spark.createDataFrame(late, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    after = run(spark, folder, out, checkpoint)
    assert before["a", 3].y == after["a", 3].y == 0
    same(after, by_hand([*first, late[1]]))
