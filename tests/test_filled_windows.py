"""Feature windows fetch columns without nulls; which windows are full comes from running counts."""

import pytest
from pyspark.sql import functions as F

from storecast.operators import features as FE
from storecast.session import METHOD_BYTES, limit_methods

MISSING = {0: {3, 40, 41, 110}, 1: set()}
N = 130


def _rows(spark, kind):
    return spark.createDataFrame(
        [("P", str(s), i, None if i in MISSING[s] else float((i * 37 + s) % 50 + i % 3)) for s in MISSING for i in range(N)],
        "partner_code string, store_code string, i int, billings double").select(
        "partner_code", "store_code", F.date_add(F.lit("2020-01-01").cast("date"), F.col("i")).alias("date"), "i",
        *[F.lit(1).alias(c) for c in FE.TIE_BREAK], F.col("billings").cast(kind).alias("billings"))


def _windows(plan):
    found = [plan] if plan.nodeName() == "Window" else []
    return found + [w for i in range(plan.children().size()) for w in _windows(plan.children().apply(i))]


def test_window_columns_are_never_null(spark):
    df = FE.series_features(_rows(spark, "double"))
    out = [w.output().apply(i) for w in _windows(df._jdf.queryExecution().optimizedPlan()) for i in range(w.output().size())]
    fetched = {a.name(): a.nullable() for a in out if a.name().startswith("_l")}
    assert len(fetched) == 60 and not any(fetched.values())


@pytest.mark.parametrize("kind,shift,chunk", [("double", 0, None), ("double", 1, 70), ("int", 1, None), ("decimal(12,2)", 0, None)])
def test_full_windows_by_counts(spark, kind, shift, chunk):
    df = FE.series_features(_rows(spark, kind), shift=shift, chunk_rows=chunk)
    assert df.schema["billings_lag_3"].dataType == df.schema["billings"].dataType
    got = {(r.store_code, r.i): r for r in df.collect()}
    assert len(got) == 2 * N
    for (s, i), r in got.items():
        def y(j):
            return None if j < 0 or j in MISSING[int(s)] else float((j * 37 + int(s)) % 50 + j % 3)
        at = i - shift
        for k in FE.LAGS:
            assert (None if r[f"billings_lag_{k}"] is None else float(r[f"billings_lag_{k}"])) == y(at - k)
        both = None not in (y(at), y(at - 3))
        assert (r.billings_momentum_3 is not None) == both
        for n in FE.TREND_WINDOWS:
            seen = [y(at - j) for j in range(n)]
            if None in seen:
                assert [r[f"billings_{c}"] for c in (f"trend_{n}", f"volatility_{n}", *[f"rolling_{n}_{x}" for x in (
                    "mean", "std", "min", "max")])] == [None] * 6
            else:
                assert r[f"billings_rolling_{n}_mean"] == pytest.approx(sum(seen) / n)
                assert float(r[f"billings_rolling_{n}_min"]) == min(seen) and float(r[f"billings_rolling_{n}_max"]) == max(seen)
        for n in FE.RANK_WINDOWS:
            assert (r[f"billings_rank_{n}"] is None) == any(y(at - j) is None for j in range(n))
        for k in FE.AUTOCORR_LAGS:
            assert (r[f"billings_autocorr_{k}"] is None) == any(y(at - j) is None for j in range(FE.AUTOCORR_WINDOW + k))


def test_methods_that_compile_badly_are_not_generated(spark):
    limit_methods(spark)
    assert METHOD_BYTES <= 4000 and int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 4000
