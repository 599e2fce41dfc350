"""Plan shape: the properties the design relies on, read from the physical plan."""

import __spark_entry__ as E
from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_features_share_one_exchange(spark):
    plan = _plan(E.queries()["feat_all"](spark, SF_SMALL))
    # the dimension tables are broadcast; the windows need one hash exchange
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Window [") >= 2


def test_dashboard_filter_reaches_scan(spark):
    plan = _plan(E.queries()["dashboard_filter"](spark, SF_SMALL))
    assert "PushedFilters: [In(r_name" in plan or "In(r_name" in plan


def test_top_n_limits_before_shuffle(spark):
    plan = _plan(E.queries()["recent_sample"](spark, SF_SMALL))
    assert plan.count("WindowGroupLimit") == 2     # partial (pre-shuffle) and final


def test_aggregates_are_partial(spark):
    plan = _plan(E.queries()["sales_by_country"](spark, SF_SMALL))
    assert plan.count("HashAggregate") >= 2 and "partial_sum" in plan


def test_scan_prunes_columns(spark):
    plan = _plan(E.queries()["sales_by_country"](spark, SF_SMALL))
    li = [l for l in plan.splitlines() if "lineitem" in l and "ReadSchema" in l][0]
    assert "l_quantity" not in li and "l_tax" not in li


def test_evaluation_pipeline_single_shuffle(spark):
    """Features, the split's row numbers/counts and the per-store metrics all
    reuse one hash partitioning by store."""
    from storecast.operators import evaluation as EV
    from storecast.plans.evaluation_q import predictions
    plan = _plan(EV.model_results(predictions(spark, SF_SMALL)))
    assert plan.count("Exchange hashpartitioning") == 1


def test_date_filter_reaches_lineitem_scan(spark):
    """``date`` is cast(l_shipdate as date) in the view; a range on it is
    pushed into the parquet scan as a timestamp bound."""
    from pyspark.sql import functions as F
    from storecast.sources.tables import sales
    df = sales(spark, SF_SMALL).filter(F.col("date") < F.lit("2000-01-01").cast("date")).select("billings")
    assert "LessThan(l_shipdate" in _plan(df)


def test_features_take_no_sliding_frames(spark):
    """Spark starts a sliding frame's aggregates anew in every row; the windows only fetch rows before."""
    import re
    fields = "spark.sql.debug.maxToStringFields"
    before = spark.conf.get(fields)
    try:
        spark.conf.set(fields, "1000")
        for name in ("feat_all", "median_impute", "temporal_split"):
            plan = spark._jvm.PythonSQLUtils.explainString(
                E.queries()[name](spark, SF_SMALL)._jdf.queryExecution(), "extended")
            frames = re.findall(r"RowFrame, -(\d+), (\S+?)\)", plan)
            assert all(end == f"-{start}" for start, end in frames), name
    finally:
        spark.conf.set(fields, before)


def test_sums_over_fetched_rows_lose_nothing(spark):
    """Equal values have a deviation of exactly 0, and a far level costs no digits."""
    import numpy as np
    from pyspark.sql import functions as F
    from storecast.operators import features as FE
    y = [0.1] * 70 + [1e6 + 1e-3 * ((i * i) % 17) for i in range(70)]
    df = spark.createDataFrame([("P", "1", i, v) for i, v in enumerate(y)], "partner_code string, store_code string, date int, billings double")
    got = FE.series_features(df, order=["date"], chunk_rows=None).orderBy("date").toPandas()
    assert got["billings_rolling_30_std"][29:70].eq(0).all() and got["billings_autocorr_7"][:70].isna().all()
    for i in range(106, 140):
        win, past = np.array(y[i - 29:i + 1]), np.array(y[i - 36:i - 6])
        assert abs(got["billings_rolling_30_std"][i] / win.std(ddof=1) - 1) < 1e-7
        assert abs(got["billings_autocorr_7"][i] - np.corrcoef(win, past)[0, 1]) < 1e-6
    assert FE.series_features(df, order=["date"], families=["is_outlier"], chunk_rows=None, shift=1).where(
        F.col("billings_is_outlier_7").isNull()).count() == 1            # only the first row has no row before


def test_rows_are_dealt_by_store_before_columns_are_added(spark):
    for query in ("feat_all", "feature_lists"):
        plan = _plan(E.queries()[query](spark, SF_SMALL))
        assert plan.count("Exchange hashpartitioning(partner_code") == 1, query
        below = plan[plan.index("Exchange hashpartitioning(partner_code"):]
        assert "Window" not in below and "year" not in below and "LN" not in below.upper().replace("LINE", ""), query


def test_scaler_of_stores_that_are_not_hot_needs_no_join(spark):
    from pyspark.sql import functions as F
    from storecast.operators import evaluation as EV
    rows = spark.range(400).select(
        F.lit("P").alias("partner_code"), (F.col("id") % 3).cast("string").alias("store_code"), "id", F.sin("id").alias("a"),
        F.lit(2.0).alias("b"), F.when(F.col("id") % 3 == 2, "test").when(F.col("id") % 5 == 0, "test").otherwise("train").alias("split"))
    here, apart = EV.standard_scale(EV.fit_scaler(rows, ["a", "b"], hot=None), ["a", "b"]), EV.standard_scale(rows, ["a", "b"])
    assert here.columns == apart.columns and "Join" not in _plan(here) and "Join" in _plan(apart)
    got, want = ([x.select("id", "split", *[F.round(c, 9).alias(c) for c in "ab"]) for x in (here, apart)])
    assert got.count() == 400 and got.exceptAll(want).count() == 0 and got.where("a is null").count() == 133
    plan = _plan(E.queries()["standard_scale"](spark, SF_SMALL))
    assert "Exchange" not in plan and "Join" not in plan            # the rows are not dealt again after they are written
