"""The forest runs: invariants, saved models, selections (values have no oracle)."""

import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from storecast.operators import forecast as FC
from storecast.operators import models as MD
from storecast.plans import models_q as M
from storecast.plans.features_q import REFERENCE_FEATURES

TINY = MD.ForestParams(num_trees=3, max_depth=4)


@pytest.fixture(scope="module")
def fl(spark):
    return M.fleet(spark, SF_SMALL, params=TINY, root=tempfile.mkdtemp(prefix="storecast-fleet-"))


def test_fleet_covers_every_store(spark, fl):
    reg = fl["registry"].collect()
    assert len(reg) == 10 and all(r.train_samples > r.test_samples > 0 and r.model_saved for r in reg)
    f = M.band(spark, SF_SMALL, fl)
    assert f.count() == 10 * M.HORIZON_DAYS
    p = F.col("predicted_billings")
    assert f.filter((p < 0) | (F.col("confidence_lower") > p) | (p > F.col("confidence_upper")) | p.isNull()).count() == 0
    assert abs(fl["importances"].agg(F.sum("importance")).first()[0] - 1) < 1e-6


def test_horizon_uses_last_features_and_differs_by_day(fl):
    h = fl["horizon"]
    own = h.groupBy(*M.KEY).agg(*[F.count_distinct(c).alias(c) for c in M.OWN]).collect()
    assert all(r[c] == 1 for r in own for c in M.OWN)          # known on the last row, never filled with 0
    assert h.filter(" or ".join(f"{c} is null" for c in M.OWN)).count() == 0
    days = h.groupBy(*M.KEY).agg(F.count_distinct("prediction").alias("n")).collect()
    assert all(r.n > 1 for r in days)


def test_shifted_features_are_those_of_the_row_before(spark):
    from storecast.operators import features as FE
    from storecast.plans.features_q import ROW_KEY, model_input
    x = model_input(spark, SF_SMALL)
    a = FE.series_features(x, "billings", ["trend", "rank"], shift=1, also_shift=["miles"])
    b = FE.series_features(x, "billings", ["trend", "rank"])
    w = FE.Window.partitionBy(*M.KEY).orderBy(*ROW_KEY[2:])
    names = [*FE.feature_names(["trend", "rank"]), "miles"]
    b = b.withColumns({n: F.lag(n, 1).over(w) for n in names})
    cols = ROW_KEY + names
    assert a.select(cols).exceptAll(b.select(cols)).count() == 0
    split = FE.series_features(x, "billings", ["trend", "rank"], shift=1, also_shift=["miles"], chunk_rows=60)
    assert split.select(cols).exceptAll(a.select(cols)).count() == 0


def test_new_session_scores_new_rows_with_the_saved_model(spark, fl):
    other = spark.newSession()
    rows = other.read.parquet(f"{fl['root']}/scores/horizon").drop("prediction")
    again = MD.score(rows.limit(50), fl["root"], REFERENCE_FEATURES)
    want = {(r.partner_code, r.store_code, r.date): r.prediction for r in fl["horizon"].collect()}
    got = again.collect()
    assert len(got) == 50 and all(abs(want[r.partner_code, r.store_code, r.date] - r.prediction) < 1e-9 for r in got)


def test_equal_run_is_read_and_other_parameters_are_not(spark, fl):
    base = fl["root"].rsplit("/", 1)[0]
    M._FLEETS.clear()                                   # a new driver: no memo
    assert M.fleet(spark, SF_SMALL, params=TINY, root=base)["root"] == fl["root"]
    other = M.fleet(spark, SF_SMALL, params=MD.ForestParams(num_trees=2, max_depth=4), root=base)
    assert other["root"] != fl["root"]
    assert MD.RandomForestRegressionModel.load(other["root"] + "/model").getNumTrees == 2


def test_store_fleet_widens_on_the_same_folder(spark):
    root = tempfile.mkdtemp(prefix="storecast-stores-")
    one = M.store_fleet(spark, SF_SMALL, 1, params=TINY, root=root)
    assert one["results"].count() == 1
    M._FLEETS.clear()
    three = M.store_fleet(spark, SF_SMALL, 3, params=TINY, root=root)
    assert [f["status"] for f in three["fits"]] == ["success"] * 3
    assert three["results"].count() == three["status"].count() == 3
    sums = three["importances"].groupBy("store_id").agg(F.sum("importance").alias("s")).collect()
    assert all(abs(r["s"] - 1.0) < 1e-6 for r in sums)
    more = M.store_fleet(spark, SF_SMALL, 3, params=MD.ForestParams(num_trees=2, max_depth=3), root=root)
    assert MD.RandomForestRegressionModel.load(more["fits"][0]["model_path"]).getNumTrees == 2


def test_failing_store_has_a_status(spark):
    fl = M.store_fleet(spark, SF_SMALL, 1, params=TINY)
    fits = MD.fit_store_forests(spark, fl["table"], [fl["store_ids"][0], "P0_missing"], REFERENCE_FEATURES,
                                tempfile.mkdtemp(prefix="storecast-fail-"), params=TINY, parallelism=2)
    rows = {r.store_id: r for r in MD.status_frame(spark, fits).collect()}
    assert rows["P0_missing"].status == "failed" and rows["P0_missing"].error
    assert rows[fl["store_ids"][0]].status == "success"


def test_every_status(spark):
    key = "partner_code string, store_code string"
    req = spark.createDataFrame([("P", s) for s in "abcdef"], key)
    reg = spark.createDataFrame([("P", s, s != "b", "BUENO", 0.7, 5.0, 33) for s in "bcdef"],
                                key + ", model_saved boolean, quality string, test_r2 double, test_smape double, n_features int")
    hist = spark.createDataFrame([("P", s) for s in "abdef"], key)
    horizon = spark.createDataFrame([("P", "d", 0, 0), ("P", "e", 31, 0), ("P", "f", 31, 28)],
                                    key + ", n_features int, n_predicted int")
    got = {r.store_code: (r.status, r.features_used) for r in FC.forecast_status(req, reg, hist, horizon).collect()}
    assert got == {"a": ("model_not_found", None), "b": ("model_load_error", None), "c": ("no_data", None),
                   "d": ("no_features", None), "e": ("prediction_error", None), "f": ("success", 33)}
