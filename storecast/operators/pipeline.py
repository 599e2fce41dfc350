"""``pyspark.ml`` stages for the preprocessing pipeline.

``IQROutlierRemover`` is an Estimator whose fitted model keeps the fence as
two numbers; ``TargetTransformer`` and ``FeatureEngineer`` are column-only
Transformers.  ``preprocessing_pipeline()`` chains them in the reference's
order: fence -> clamp + log column -> log target, calendar and rolling
features per store -> optional fill.  All settings are ``Param``s, so stages,
pipelines and fitted pipelines can be written and loaded like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from storecast.operators import features as FE
from storecast.sources.tables import STORE_KEY


class _Stage(Params, DefaultParamsReadable, DefaultParamsWritable):
    target = Param(Params._dummy(), "target", "target column", TypeConverters.toString)

    def __init__(self, **values):
        super().__init__()
        self._set(**{k: v for k, v in values.items() if v is not None})

    def value(self, name: str):
        return self.getOrDefault(name) if self.hasParam(name) and self.isDefined(name) else None


class IQRBoundsModel(_Stage, Model):
    bounds = Param(Params._dummy(), "bounds", "lower and upper fence; unset: nothing was fitted", TypeConverters.toListFloat)

    def __init__(self, target: str = "billings", bounds: Sequence[float] | None = None):
        super().__init__(target=target, bounds=None if bounds is None else list(bounds))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        # unfitted (no target column when fitted) -> pass-through
        if self.value("target") not in dataset.columns:
            return dataset
        return FE.apply_bounds(dataset, self.value("bounds"), self.value("target"))


class IQROutlierRemover(_Stage, Estimator):
    """Fence [Q1 - f*IQR, Q3 + f*IQR] fitted once, reused on new data."""
    factor = Param(Params._dummy(), "factor", "fence width in IQRs", TypeConverters.toFloat)

    def __init__(self, target: str = "billings", factor: float = 2.0):
        super().__init__(target=target, factor=factor)

    def _fit(self, dataset: DataFrame) -> IQRBoundsModel:
        target = self.value("target")
        bounds = FE.iqr_bounds(dataset, target, self.value("factor")) if target in dataset.columns else None
        return IQRBoundsModel(target, bounds)


class TargetTransformer(_Stage, Transformer):
    """T4: ``log_plus_one`` (clamp + ``<t>_log``) or ``sqrt``."""
    method = Param(Params._dummy(), "method", "log_plus_one or sqrt", TypeConverters.toString)
    clamp = Param(Params._dummy(), "clamp", "smallest target of log_plus_one", TypeConverters.toFloat)

    def __init__(self, target: str = "billings", method: str = "log_plus_one", clamp: float = 0.1):
        super().__init__(target=target, method=method, clamp=clamp)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        if self.value("target") not in dataset.columns:
            return dataset
        return FE.target_transform(dataset, self.value("target"), self.value("method"), self.value("clamp"))


class FeatureEngineer(_Stage, Transformer):
    """T3 + W1 + W2..W11 per store, then optional T7 fill."""
    families = Param(Params._dummy(), "families", "feature families", TypeConverters.toListString)
    fill = Param(Params._dummy(), "fill", "bfill_ffill, or unset", TypeConverters.toString)
    chunkRows = Param(Params._dummy(), "chunkRows", "rows of a chunk of a hot store", TypeConverters.toInt)

    def __init__(self, target: str = "billings", families: Sequence[str] = FE.FAMILIES,
                 fill: str | None = "bfill_ffill", chunk_rows: int | None = None):
        super().__init__(target=target, families=list(families), fill=fill, chunkRows=chunk_rows)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        from storecast.operators.series import DEFAULT_CHUNK_ROWS, hot_keys
        target, families = self.value("target"), self.value("families")
        chunk = self.value("chunkRows") or DEFAULT_CHUNK_ROWS
        hot = hot_keys(dataset, STORE_KEY, "date", chunk)     # once, on the input
        x = FE.calendar_features(FE.log_target(dataset, target))
        x = FE.series_features(x, target, families, chunk_rows=chunk, hot=hot)
        if self.value("fill") == "bfill_ffill":
            x = FE.bfill_ffill_zero(x, FE.feature_names(families, target), chunk_rows=chunk, hot=hot)
        return x


def preprocessing_pipeline(target: str = "billings", factor: float = 2.0,
                           families: Sequence[str] = FE.FAMILIES,
                           fill: str | None = "bfill_ffill") -> Pipeline:
    """T8 as a ``pyspark.ml.Pipeline``."""
    return Pipeline(stages=[IQROutlierRemover(target, factor), TargetTransformer(target),
                            FeatureEngineer(target, families, fill)])
