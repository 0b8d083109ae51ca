"""Metric-log scans against a plain per-run loop over the events table."""

from collections import defaultdict

from chunkwise.operators import training as TR
from chunkwise.plans import tables as TB
from tests.conftest import SF_ORACLE


def loop_early_stop(values, patience=2):
    best, count, best_step, stop = -1.0, 0, None, None
    for step, v in enumerate(values, start=1):
        if v > best:
            best, count, best_step = v, 0, step
        else:
            count += 1
        if count >= patience:
            stop = step
            break
    return best_step, (best if best_step else None), stop


def runs(spark):
    rows = TB.metric_log(spark, SF_ORACLE).collect()
    by = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["run"], r["ts"], r["event_id"])):
        by[r["run"]].append(r["metric"])
    return by


def test_early_stop_matches_loop(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "13")  # many blocks per run
    try:
        got = {r["run"]: r for r in TR.early_stop(TB.metric_log(spark, SF_ORACLE), "run", ["ts", "event_id"]).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    by = runs(spark)
    assert set(got) == set(by)
    for run, vals in by.items():
        bs, bm, stop = loop_early_stop(vals)
        r = got[run]
        assert (r["best_step"], r["stop_step"], r["n_steps"]) == (bs, stop, len(vals))
        assert (r["best_metric"] is None and bm is None) or abs(r["best_metric"] - bm) < 1e-12


def test_running_mean_matches_loop(spark):
    got = {(r["run"], r["step"]): r["running_mean"]
           for r in TR.running_mean(TB.metric_log(spark, SF_ORACLE), "run", ["ts", "event_id"]).collect()}
    exp = {}
    for run, vals in runs(spark).items():
        for i in range(10, len(vals) + 1, 10):
            exp[(run, i)] = sum(vals[:i]) / i
    assert set(got) == set(exp)
    assert all(abs(got[k] - exp[k]) < 1e-9 for k in exp)
