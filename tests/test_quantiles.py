"""The bracketing exact-quantile search equals Spark's exact percentile."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from storecast.functions.stats import column_quantiles, exact_quantiles
from storecast.sources.tables import sales


def test_bracketing_matches_percentile(spark):
    s = sales(spark, SF_MID).select("billings", F.col("miles"))
    probs = [0.0, 0.25, 0.5, 0.95, 1.0]
    exact = s.agg(F.percentile("billings", F.array(*[F.lit(p) for p in probs]))).first()[0]
    # a tiny limit and a coarse sketch make the search go on for several rounds
    got = exact_quantiles(s, "billings", probs, inside_limit=500, accuracy=100)
    assert got == pytest.approx(exact, rel=1e-12)
    many = column_quantiles(s, ["billings", "miles"], [0.5], inside_limit=500)
    assert many["billings"][0] == pytest.approx(exact[2], rel=1e-12)


@pytest.mark.parametrize("case", ["dups", "tiny", "constant", "nulls"])
def test_bracketing_random_cases(spark, case):
    import numpy as np
    rng = np.random.default_rng(11)
    if case == "dups":
        vals = [float(v) for v in rng.integers(0, 20, 3000)]        # heavy ties
    elif case == "tiny":
        vals = [3.5]
    elif case == "constant":
        vals = [2.0] * 700
    else:
        vals = [None if rng.random() < 0.3 else float(v) for v in rng.normal(0, 1, 2000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.95, 1.0]
    clean = np.array([v for v in vals if v is not None])
    want = [float(np.quantile(clean, p)) for p in probs]          # linear interpolation
    got = exact_quantiles(df, "x", probs, inside_limit=50, accuracy=50)
    assert got == pytest.approx(want, rel=1e-12, abs=1e-12)


def test_profile_takes_three_passes(spark):
    """All quartiles of all columns, and the other statistics, in three scans."""
    from storecast.operators import reports as R
    df = spark.range(200_000).select(F.sin("id").alias("a"), (F.col("id") % 1000).cast("double").alias("b"),
                                     F.when(F.col("id") % 3 > 0, F.sqrt("id")).alias("c"))
    calls, plain = [], type(df).agg

    def counted(self, *exprs):
        calls.append(len(exprs))
        return plain(self, *exprs)

    type(df).agg = counted
    try:
        rows = {r.column_name: r for r in R.profile_table(df).collect()}
    finally:
        type(df).agg = plain
    assert len(calls) <= 3
    for c in ("a", "b", "c"):
        want = df.agg(F.percentile(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))).first()[0]
        assert [rows[c].q25, rows[c].q50, rows[c].q75] == pytest.approx(want, abs=1e-4)
