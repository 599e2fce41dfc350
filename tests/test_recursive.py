"""The recursive horizon against a plain recomputation over the whole history."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from storecast.operators import features as FE
from storecast.operators import recursive as RC
from storecast.plans import recursive_q as R
from storecast.plans.features_q import model_input
from storecast.plans.models_q import KEY


@pytest.fixture(scope="module")
def history(spark):
    return model_input(spark, SF_SMALL).where("store_code in ('1', '2', '3')").cache()


def mean_of_features(rows):
    """A predictor that reads long and short features and the calendar."""
    return rows.select(*KEY, "date", (F.col("billings_rolling_30_mean") + 0.1 * F.col("billings_autocorr_30")
                                      + 0.01 * F.col("dayofweek") + 0.001 * F.col("miles")).alias("prediction"))


def test_constant_state_gives_what_the_whole_history_gives(spark, history):
    fam = ["rolling", "autocorr"]
    got = {(r.store_code, r.date): r.prediction for r in RC.recursive_forecast(history, 3, mean_of_features, fam, ["miles"]).collect()}
    whole, want = history.select(*KEY, "date", *RC.TIE_BREAK, "billings", "miles").withColumn(RC.STEP, F.lit(0)), {}
    for step in range(1, 4):
        day = mean_of_features(RC.next_day(whole, fam, ["miles"])).collect()
        want |= {(r.store_code, r.date): r.prediction for r in day}
        last = {r.store_code: r for r in RC.next_day(whole, fam, ["miles"]).select("store_code", "date", "miles").collect()}
        new = spark.createDataFrame([(r.partner_code, r.store_code, r.date, 0, 0, 0, r.prediction, last[r.store_code].miles, step) for r in day],
                                    whole.schema)
        whole = whole.unionByName(new).checkpoint()
    assert got.keys() == want.keys() and len(got) == 9
    assert all(abs(got[k] - want[k]) < 1e-9 for k in got)


def test_state_stays_at_its_size(history):
    state = RC.horizon_state(history, ["miles"])
    assert {r[1] for r in state.groupBy("store_code").count().collect()} == {FE.LOOKBACK + 1}
    with pytest.raises(ValueError):
        RC.recursive_forecast(history, 1, mean_of_features, ["trend"], keep=10)


def test_short_unknown_and_empty_stores(spark, history):
    short = history.where("store_code = '1'").limit(5).withColumn("store_code", F.lit("short"))
    known = RC.line_predictor(history.withColumn("billings_trend_7", F.col("miles")).where("store_code <> '3'"), "billings_trend_7")
    got = RC.recursive_forecast(history.unionByName(short), 2, known, ["trend"])
    assert {(r.store_code, r.step) for r in got.collect()} == {(s, d) for s in "12" for d in (1, 2)}
    assert RC.recursive_forecast(history.where("false"), 1, known, ["trend"]).count() == 0


def test_forests_in_the_loop(spark):
    f = R.forest_horizon(spark, SF_SMALL, days=2).collect()
    assert len(f) == 20 and all(r.prediction > 0 for r in f)


def test_a_step_needs_no_window(spark, history):
    state = RC.store_series(RC.horizon_state(history, ["miles"]), ["miles"])
    assert state.count() == 3 and state.selectExpr(f"max(size({RC.VALUES}))").first()[0] == FE.LOOKBACK + 1
    day = RC.next_day(RC.write_table(state, "test-series"), FE.FAMILIES, ["miles"])
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan


def test_last_features_are_those_of_the_whole_series(history):
    holes = history.withColumn("billings", F.when(F.col("l_linenumber") < 7, F.col("billings")))
    rows = holes.unionByName(history.withColumn("store_code", F.concat("store_code", F.lit("x"))))
    place = F.struct("date", *RC.TIE_BREAK)
    names = FE.feature_names()
    want = FE.series_features(rows.select(*KEY, "date", *RC.TIE_BREAK, "billings"), "billings").groupBy(*KEY).agg(
        F.max_by(F.struct(*names), place).alias("f")).select(*KEY, "f.*")
    got = RC.next_day(RC.horizon_state(rows), FE.FAMILIES).select(*KEY, *names)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str) and got.count() == 6


def test_the_first_of_tied_last_rows_counts(history):
    last = history.groupBy(*KEY).agg(F.max(F.struct("date", *RC.TIE_BREAK)).alias("p")).select(*KEY, "p.*")
    twice = history.unionByName(history.join(last, last.columns, "left_semi"))
    rows = [sorted(map(tuple, RC.next_day(RC.horizon_state(h), ["trend"]).collect())) for h in (history, twice)]
    assert rows[0] == rows[1]
