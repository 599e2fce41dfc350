"""Hand-computed edge cases (expected values from the reference formulas,
computed with pandas/numpy; see FIXTURES.md part C)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from storecast.functions.exprs import quality_label
from storecast.operators import evaluation as EV
from storecast.operators import features as FE
from storecast.operators import reports as R
from storecast.operators import validation as V

SERIES = [10, 12, 0, 8, 10, 10, 14, 3]


def _series_df(spark, values, store="S"):
    rows = [("P", store, dt.date(2024, 1, 1) + dt.timedelta(days=i), i, 1, 1, float(v) if v is not None else None)
            for i, v in enumerate(values)]
    return spark.createDataFrame(
        rows, "partner_code string, store_code string, date date, l_orderkey long, l_linenumber int, "
              "l_partkey long, y double")


def _col(df, c):
    return [r[c] for r in df.orderBy("date").collect()]


def _approx(got, want, tol=1e-5):
    assert len(got) == len(want)
    for g, w in zip(got, want):
        if w is None:
            assert g is None
        else:
            assert g is not None and g == pytest.approx(w, rel=tol, abs=tol)


def test_trend_volatility_momentum(spark):
    f = FE.series_features(_series_df(spark, SERIES), "y", ["trend", "volatility", "momentum_pct"],
                           chunk_rows=None)
    _approx(_col(f, "y_trend_3"), [None, None, -7.333333, 1.333333, 4, 0.666667, 2.666667, -6])
    _approx(_col(f, "y_volatility_3"), [None, None, 0.876696, 0.916515, 0.881917, 0.123718, 0.203771, 0.61864])
    _approx(_col(f, "y_momentum_pct_1"), [None, 20, -100, 8e10, 25, 0, 40, -78.571429])


def test_rank_and_zscore(spark):
    f = FE.series_features(_series_df(spark, SERIES), "y", ["rank", "zscore", "is_outlier"], chunk_rows=None)
    _approx(_col(f, "y_rank_7"), [None] * 6 + [1.0, 0.285714])
    _approx(_col(f, "y_zscore_7"), [None] * 6 + [1.091299, -1.032512])
    assert _col(f, "y_is_outlier_7") == [0] * 8


def test_autocorr_constant_is_null(spark):
    f = FE.series_features(_series_df(spark, [5.0] * 60), "y", ["autocorr"], chunk_rows=None)
    assert all(v is None for v in _col(f, "y_autocorr_7"))


def test_iqr_bounds(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 100)], "billings double")
    assert FE.iqr_bounds(df, "billings", 2.0) == (-2.0, 8.0)
    assert sorted(r[0] for r in FE.iqr_filter(df, "billings").collect()) == [1, 2, 3, 4]


def test_bfill_ffill_zero(spark):
    df = _series_df(spark, [None, 1, None, 3, None])
    out = FE.bfill_ffill_zero(df, ["y"])
    assert _col(out, "y") == [1, 1, 3, 3, 3]
    allnull = FE.bfill_ffill_zero(_series_df(spark, [None, None]), ["y"])
    assert _col(allnull, "y") == [0, 0]


def test_smape_r2_precision(spark):
    df = spark.createDataFrame([(0.0, 0.0), (100.0, 110.0), (200.0, 150.0)], "y double, p double")
    m = df.agg(*[e.alias(k) for k, e in EV._metrics(F.col("y"), F.col("p")).items()]).first()
    assert m["smape"] == pytest.approx(12.698413, rel=1e-6)
    assert m["r2"] == pytest.approx(0.87, rel=1e-9)
    assert m["mae"] == pytest.approx(20.0)
    assert m["rmse"] == pytest.approx(29.439203, rel=1e-6)
    prec = R.kpi_precision(df.withColumnsRenamed({"y": "ventas_reales", "p": "ventas_predichas"})).first()[0]
    assert prec == pytest.approx(0.825)


def test_monthly_sales_fills_empty_month(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 10), 5.0), (dt.date(2024, 3, 2), 7.0)], "date date, v double")
    out = {r[0]: r[1] for r in R.monthly_sales(df, "date", "v").collect()}
    assert out == {dt.date(2024, 1, 31): 5.0, dt.date(2024, 2, 29): 0.0, dt.date(2024, 3, 31): 7.0}


def test_weekday_missing_is_null(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(6)]   # Mon..Sat
    df = spark.createDataFrame([(d, 1.0) for d in days], "date date, v double")
    out = {r["day_name"]: r["total_sales"] for r in R.sales_by_weekday(df, "date", "v").collect()}
    assert out["Domingo"] is None and out["Lunes"] == 1.0


def test_quality_labels(spark):
    df = spark.createDataFrame([(0.81,), (0.8,), (0.6,), (0.4,), (None,)], "r2 double")
    got = [r[0] for r in df.select(quality_label("r2")).collect()]
    assert got == ["EXCELENTE", "BUENO", "REGULAR", "POBRE", "POBRE"]


def test_null_and_negative_target(spark):
    df = spark.createDataFrame([(None,), (-5.0,)], "billings double")
    assert [r[0] for r in V.clip_negative(V.fill_target_zero(df)).collect()] == [0.0, 0.0]


def test_log_target_and_clamp(spark):
    df = spark.createDataFrame([(None,), (-1.0,), (0.0,)], "billings double")
    t3 = [r[0] for r in FE.log_target(df).select("billings").collect()]
    assert t3[0] is None and t3[1] == 0.0 and t3[2] == 0.0
    t4 = [r[0] for r in FE.target_transform(df).select("billings_log").collect()]
    import math
    assert t4[0] is None and t4[1] == pytest.approx(math.log1p(0.1)) and t4[2] == pytest.approx(math.log1p(0.1))


def test_store_min_rows_split(spark):
    rows = []
    for store, n in (("A", 49), ("B", 50)):
        rows += [("P", store, dt.date(2024, 1, 1) + dt.timedelta(days=i), i, 1, 1, 1.0) for i in range(n)]
    df = spark.createDataFrame(rows, "partner_code string, store_code string, date date, l_orderkey long, "
                                     "l_linenumber int, l_partkey long, y double")
    out = EV.temporal_split(df).groupBy("store_code", "split").count().collect()
    got = {(r[0], r[1]): r[2] for r in out}
    assert got == {("B", "train"): 40, ("B", "test"): 10}


def test_bad_date_and_number_counted(spark):
    df = spark.createDataFrame([("2024-13-01", "x", "P", "1")] + [("2024-01-02", "5", "P", "1")] * 40,
                               "date string, billings string, partner_code string, store_code string")
    clean, report = V.validate_sales(df)
    r = report.first()
    assert r["bad_dates"] == 1 and r["bad_numbers"] == 1 and r["error"].startswith("Invalid date")
    assert clean.filter(F.col("date").isNull()).count() == 1


def test_store_list_parse(spark):
    got = sorted(tuple(r) for r in V.parse_store_list(spark, "P1_7, bad ,P2_8_9").collect())
    assert got == [("P1", "7"), ("P2", "8_9")]


def test_model_not_found_status(spark):
    from storecast.operators import forecast as FC
    req = spark.createDataFrame([("P", "A"), ("P", "B")], "partner_code string, store_code string")
    reg = spark.createDataFrame([("P", "A", "BUENO", 0.7, 5.0)],
                                "partner_code string, store_code string, quality string, test_r2 double, test_smape double")
    st = {r["store_code"]: r["status"] for r in FC.forecast_status(req, reg, req).collect()}
    assert st == {"A": "success", "B": "model_not_found"}
