"""The preprocessing pipeline and its fitted model can be written and loaded."""

import tempfile

from pyspark.ml import Pipeline, PipelineModel

from conftest import SF_SMALL
from storecast.operators import features as FE
from storecast.operators.pipeline import IQRBoundsModel, preprocessing_pipeline
from storecast.plans.features_q import ROW_KEY
from storecast.sources.tables import sales


def test_saved_pipeline_gives_the_same_rows(spark):
    s = sales(spark, SF_SMALL).select(*ROW_KEY, "miles", "billings")
    pipe = preprocessing_pipeline(families=["trend", "rank"])
    path = tempfile.mkdtemp(prefix="storecast-pipe-")
    pipe.write().overwrite().save(f"{path}/pipeline")
    model = Pipeline.load(f"{path}/pipeline").fit(s)
    model.write().overwrite().save(f"{path}/model")
    loaded = PipelineModel.load(f"{path}/model")
    assert isinstance(loaded.stages[0], IQRBoundsModel)
    assert loaded.stages[0].value("bounds") == list(FE.iqr_bounds(s, "billings", 2.0))
    a, b = loaded.transform(s), pipe.fit(s).transform(s)
    assert a.columns == b.columns and a.count() == b.count() > 0 and a.exceptAll(b).count() == 0


def test_unfitted_fence_passes_rows_through(spark):
    df = spark.createDataFrame([(1.0,)], "other double")
    assert preprocessing_pipeline().getStages()[0].fit(df).transform(df).count() == 1
