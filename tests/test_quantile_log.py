"""Quantiles of appended periods against numpy."""

import random
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from storecast.operators.quantile_log import QuantileLog

PROBS = [0.0, 0.25, 0.5, 0.95]


def _log(spark, periods, cols=("x", "y"), **options):
    log = QuantileLog(spark, tempfile.mkdtemp(prefix="storecast-quantiles-"), cols, **options)
    for rows in periods:
        log.append(spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols)))
    return log


def _check(log, periods):
    for v in {1, len(periods)}:
        got = log.quantiles(PROBS, as_of=v)
        for i, c in enumerate(log.columns):
            kept = [r[i] for p in periods[:v] for r in p if r[i] is not None and not np.isnan(r[i])]
            want = np.quantile(kept, PROBS).tolist() if kept else [None] * len(PROBS)
            assert got[c] == (pytest.approx(want, rel=1e-12, abs=1e-12) if kept else want), (v, c)


def _periods(seed):
    rng = random.Random(seed)

    def value():
        kind = rng.random()
        return 7.0 if kind < 0.35 else None if kind < 0.4 else float("nan") if kind < 0.42 else \
            rng.choice([-1, 1]) * 10 ** rng.uniform(-12, 12) if kind < 0.7 else rng.gauss(0, 1)
    return [[(value(), None if p == 0 else value()) for _ in range(rng.randint(1, 4000))] for p in range(3)]


@pytest.mark.parametrize("seed,options", [(1, {}), (4, {"k": 8, "inside_limit": 40})])
def test_quantiles_equal_numpy(spark, seed, options):
    periods = _periods(seed)
    _check(_log(spark, periods, **options), periods)


def test_edges(spark):
    log = _log(spark, [[], [(1.0, None)], []])
    assert log.quantiles([0.5], as_of=1) == {"x": [None], "y": [None]}
    assert log.quantiles([0.0, 0.5, 1.0]) == {"x": [1.0] * 3, "y": [None] * 3}
    assert log.iqr_bounds("x") == (1.0, 1.0) and log.iqr_bounds("y") is None
    with pytest.raises(LookupError):
        QuantileLog(spark, tempfile.mkdtemp(prefix="storecast-quantiles-"), ["x"]).quantiles([0.5])


def test_one_value_has_most_rows(spark):
    periods = [[(5.0, float(i % 3)) for i in range(3000)], [(float(i), 1.0) for i in range(50)]]
    _check(_log(spark, periods, inside_limit=2), periods)


def test_old_periods_are_read_inside_the_bracket_only(spark):
    log = QuantileLog(spark, tempfile.mkdtemp(prefix="storecast-quantiles-"), ["x"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for k in range(2):
            log.append(spark.range(200_000).select((F.col("id") * 2 + k).cast("double").alias("x")))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert log._read("blocks", None).count() == 16
    assert log.quantiles([0.5]) == {"x": [199_999.5]}
    seen = []
    read = log.inside

    def watched(brackets, as_of):
        df = read(brackets, as_of)
        seen.append((df._jdf.queryExecution().executedPlan().toString(), df.count()))
        return df
    log.inside = watched
    log.quantiles([0.5])
    assert len(seen) == 2  # counting, then the order statistics
    assert all("PushedFilters: [" in plan and "GreaterThanOrEqual(value," in plan for plan, _ in seen)
    assert seen[1][1] < 0.02 * 400_000  # the bracket
    assert seen[0][1] < 0.02 * 400_000 + 400_000 / 6  # and one block of each period
