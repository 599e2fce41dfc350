"""Wide projections: no interpreted methods, no wide rows in checkpoints or twice on disk."""

import __spark_entry__ as E
from conftest import SF_SMALL
from storecast.plans import models_q as M
from storecast.session import METHOD_BYTES
from storecast.sources.tables import read_table

LIMIT = "spark.sql.codegen.hugeMethodLimit"


def test_large_methods_are_not_interpreted(spark):
    before = spark.conf.get(LIMIT)
    try:
        spark.conf.set(LIMIT, "65535")
        read_table(spark, SF_SMALL, "lineitem")
        assert int(spark.conf.get(LIMIT)) == METHOD_BYTES
        spark.conf.set(LIMIT, "4000")                       # a lower limit of the user stays
        read_table(spark, SF_SMALL, "lineitem")
        assert int(spark.conf.get(LIMIT)) == 4000
    finally:
        spark.conf.set(LIMIT, before)


def test_scaler_reads_a_written_table(spark):
    df = E.queries()["standard_scale"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in plan and any("scale-rows" in f for f in df.inputFiles())


def test_pooled_scores_of_the_history_hold_no_features(spark):
    h = M.fleet(spark, SF_SMALL)["history"]
    assert h.columns == [*M.ROW_KEY, "split", "billings", "prediction"]
