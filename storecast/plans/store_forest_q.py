"""Registered queries of the per-store forests.

One run (``store_run``) trains a forest for every store in one sequence of jobs, scores
history, horizon and template days, and writes rows with their scores, trees and registry.  The registered
queries grow the reference's forest (``QUERY_FOREST``: 200 trees of depth 15, the defaults of
``StoreForestParams``), whose every split, prediction and metric the DuckDB SQL states too.
Features are those of the row before (D5); horizon days take the last row's own features
(direct horizon).
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from storecast.functions.exprs import half_away
from storecast.operators import evaluation as EV
from storecast.operators import features as FE
from storecast.operators import forecast as FC
from storecast.operators import forest as FO
from storecast.operators import models as MD
from storecast.operators import validation as V
from storecast.plans.catalog import register
from storecast.plans.evaluation_q import D, _feature_sql, _metric_sql, _quality_sql, _rsel
from storecast.plans.features_q import MODEL_INPUT_SQL, REFERENCE_FEATURES, ROW_KEY, model_input
from storecast.plans.forecast_q import HORIZON_DAYS, STATS_SQL, TEMPLATE_SQL, _cal_sql
from storecast.plans.models_q import (_CAL, _OVER, _REQUESTED, KEY, OWN, SHIFT, SPLIT_CTE, VERSION, band, history_rows,
                                      horizon_rows, input_state, last_input, statuses, template_rows)
from storecast.session import scratch_path, write_table
from storecast.sources.tables import sales

QUERY_FOREST = FO.StoreForestParams()
HORIZON_KEY = [*KEY, "date"]
BACKTEST_N = 5
_RUNS: dict[tuple, dict] = {}


def store_run(spark, sf_dir, params=QUERY_FOREST, min_samples=1, root=None):
    """Train, score and write one forest per store, or read an equal run (same data, selection,
    features and parameters) under ``root``.  Features are computed in the pass that grows the trees and
    are not written; a store's rows, scores and trees are written once, in one table."""
    key = (spark.sparkContext.applicationId, sf_dir, params, min_samples, root)
    if key in _RUNS:
        return _RUNS[key]
    path = sf_dir if "://" in sf_dir else os.path.abspath(sf_dir)
    at = (f"{root or scratch_path(spark, 'store-forests')}/"
          f"{MD.digest(path, input_state(spark, sf_dir), params, min_samples, REFERENCE_FEATURES, SHIFT, VERSION)}")
    model = FO.StoreForest(at, tuple(REFERENCE_FEATURES), params)
    if not MD.path_exists(spark, f"{at}/registry/_SUCCESS"):       # the registry is written last
        kept = ["split", "billings"]
        # the days ahead are scored in the pass that grows the trees
        tail = last_input(spark, sf_dir)
        ahead = write_table(horizon_rows(spark, sf_dir, tail=tail).withColumn("kind", F.lit("horizon")).unionByName(
            template_rows(spark, sf_dir, tail=tail).withColumn("kind", F.lit("template"))), "forest-ahead")
        # growing takes far longer than the rows' bytes tell
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        FO.train(history_rows(spark, sf_dir, min_samples, parts), REFERENCE_FEATURES, ROW_KEY, params, root=at,
                 train_on=F.col("split") == "train", keep=kept, ahead=ahead,
                 sizes=model_input(spark, sf_dir).where("billings is not null"))
        res = EV.model_results(_scores(spark, model)[0], n_features=len(REFERENCE_FEATURES))
        res.select("*", F.lit(at).alias("model_file"), F.lit(MD.path_exists(spark, f"{at}/binned/_SUCCESS")).alias("model_saved"),
                   F.array(*[F.lit(c) for c in REFERENCE_FEATURES]).alias("features"),
                   F.lit(VERSION).alias("version")).write.mode("overwrite").parquet(f"{at}/registry")
    out = {"root": at, "model": model, "registry": spark.read.parquet(f"{at}/registry")}
    out["history"], ahead = _scores(spark, model)
    out |= {k: ahead.where(F.col("kind") == k).drop("kind") for k in ("horizon", "template")}
    _RUNS[key] = out
    return out


def _scores(spark, model):
    """Predictions of the history rows and of the days ahead, which have their features too; those
    of small stores are read from the trained table, where the trees' values are added up."""
    history = FO.score_binned(model.binned(spark), model, [*ROW_KEY, "split", "billings"])
    return history, FO.score_binned(model.ahead(spark), model, [*HORIZON_KEY, "kind", *REFERENCE_FEATURES])


# ------------------------------------------------------------------ SQL text

_SOURCE = f"fsrc as (select {', '.join(ROW_KEY)}, split, billings, {', '.join(REFERENCE_FEATURES)} from ev"
_LAST_CTE = f"""
hl as (select partner_code, store_code, cast(date + 1 as date) as start_date, {', '.join(OWN)}
       from (select *, row_number() over (partition by partner_code, store_code
                                          order by date desc, l_orderkey desc, l_linenumber desc, l_partkey desc) as rn
             from ({_feature_sql()}) f) x where rn = 1),
hd as ({_cal_sql(HORIZON_DAYS, 'start_date')} from hl)"""


def _ahead() -> str:
    own = ", ".join(OWN)
    return (f"{_LAST_CTE}, hf as (select partner_code, store_code, date, {own}, {FE.calendar_sql('date')} from hd),\n"
            f"{_SOURCE} union all select partner_code, store_code, date, -1, -1, -1, 'future', null::double, "
            f"{', '.join(REFERENCE_FEATURES)} from hf)")


def _template() -> str:
    """The template days after each store's rows, with the features of the row before."""
    both = (f"(select *, {FE.calendar_sql('date')} from (select {', '.join(ROW_KEY)}, miles, billings, false as _new from {MODEL_INPUT_SQL} "
            "union all select partner_code, store_code, date, null, null, null, miles, ln(1 + greatest(billings, 0.1)), true from tpl) b) c")
    features = FE.series_features_sql(both, "billings", FE.FAMILIES, digits=None, select_cols=["*"])
    shifted = ", ".join(f"lag({c}, {SHIFT}) {_OVER} as {c}" for c in OWN)
    return (f"{TEMPLATE_SQL},\ntf as (select partner_code, store_code, date, _new, {', '.join(_CAL)}, {shifted} from ({features}) f),\n"
            f"{_SOURCE} union all select partner_code, store_code, date, -1, -1, -1, 'future', null::double, "
            f"{', '.join(REFERENCE_FEATURES)} from tf where _new)")


def _sql(body: str, horizon: bool = False, more: str = "", template: bool = False) -> str:
    source = _template() if template else _ahead() if horizon else f"{_SOURCE})"
    forest = FO.forest_sql("fsrc", REFERENCE_FEATURES, ROW_KEY, QUERY_FOREST)
    return f"with {SPLIT_CTE},\n{source},{forest}{more}\n{body}"


_ERR = f"""
fscored as (select fsrc.*, prediction from fsrc join fpred using ({', '.join(ROW_KEY)})),
fres0 as (
  select partner_code, store_code, {", ".join(_metric_sql("billings", "prediction", "split = 'train'", "train")
                                              + _metric_sql("billings", "prediction", "split = 'test'", "test"))}
  from fscored where split <> 'future' group by all),
fres as (select *, {_quality_sql('test_r2')} as quality, {len(REFERENCE_FEATURES)} as n_features from fres0)"""
_BAND = f""",{STATS_SQL},
fband as (
  select partner_code, store_code, date, p as predicted_billings,
         greatest(p - {FC.BAND_Z} * hist_std, 0.0) as confidence_lower, p + {FC.BAND_Z} * hist_std as confidence_upper
  from (select fsrc.*, greatest(exp(prediction) - 1, 0.0) as p from fsrc join fpred using ({', '.join(ROW_KEY)})
        where split = 'future') x join st using (partner_code, store_code))"""
_MONEY = "round(predicted_billings, 4) as predicted_billings, round(confidence_lower, 4) as confidence_lower, " \
         "round(confidence_upper, 4) as confidence_upper"
_METRICS = [f"{s}_{m}" for s in ("train", "test") for m in ("mae", "rmse", "r2", "smape")]


def _money():
    return [F.round(c, 4).alias(c) for c in ("predicted_billings", "confidence_lower", "confidence_upper")]


# ------------------------------------------------------------------ queries

@register("store_forest", _sql(
    f"select partner_code, store_code, train_samples, test_samples, n_features, {_rsel(_METRICS)}, quality from fres",
    more="," + _ERR))
def q_store_forest(spark, sf_dir):
    """M3, M4: every store's forest, its errors on train and test rows, and its label."""
    reg = EV.rounded(store_run(spark, sf_dir)["registry"])
    return reg.select(*KEY, "train_samples", "test_samples", "n_features", *_METRICS, "quality")


@register("store_forest_splits", _sql(f"""
select partner_code, store_code, tree, level, node::bigint as node, [{', '.join(f"'{c}'" for c in REFERENCE_FEATURES)}][f + 1] as feature,
       bin::int as bin, n, nl, s, sl, round(gain / n / {FO.UNITS ** 2}, 8) as impurity_decrease from fsplits"""))
def q_store_forest_splits(spark, sf_dir):
    """M3: the split table of every store's trees."""
    run = store_run(spark, sf_dir)
    names = F.array(*[F.lit(c) for c in REFERENCE_FEATURES])
    return run["model"].splits(spark).select(
        *KEY, F.col("tree").cast("long").alias("tree"), "level", F.col("node").cast("long").alias("node"),
        F.get(names, F.col("f")).alias("feature"),
        F.col("bin").cast("int").alias("bin"), "n", "nl", "s", "sl",
        half_away(F.col("gain") / F.col("n") / FO.UNITS ** 2, 8).alias("impurity_decrease"))


@register("store_forest_predictions", _sql(f"""
select {', '.join(ROW_KEY)}, split, round(billings, {D}) as billings, round(prediction, {D}) as prediction
from fsrc join fpred using ({', '.join(ROW_KEY)})"""))
def q_store_forest_predictions(spark, sf_dir):
    """M3: the forest's value for every history row, on the log target."""
    return store_run(spark, sf_dir)["history"].select(
        *ROW_KEY, "split", F.round("billings", D).alias("billings"), half_away("prediction", D).alias("prediction"))


@register("feature_importance", _sql(f"""
select *, row_number() over (partition by partner_code, store_code order by importance desc, feature)::int as rank
from (select partner_code, store_code, feature, round(importance, {D}) as importance from fimp)"""))
def q_feature_importance(spark, sf_dir):
    """M7: importance and rank of every feature in every store's forest."""
    imp = FO.importances(spark, store_run(spark, sf_dir)["model"]).withColumn("importance", F.round("importance", D))
    best = FO.Window.partitionBy(*KEY).orderBy(F.desc("importance"), "feature")
    return imp.select(*KEY, "feature", "importance", F.row_number().over(best).alias("rank"))


_SUMMARY = ["avg_r2", "std_r2", "best_r2", "avg_smape", "std_smape", "best_smape"]


@register("train_all_stores", _sql(f"""
select successful_models, total_stores_attempted,
       round(100.0 * successful_models / total_stores_attempted, {D}) as success_rate,
       {', '.join(f'round({c}, {D}) as {c}' for c in _SUMMARY)},
       (avg_r2 >= {EV.TARGET_R2})::int as r2_target_achieved, (avg_smape <= {EV.TARGET_SMAPE})::int as smape_target_achieved
from (select count(*) as successful_models, avg(test_r2) as avg_r2, stddev_pop(test_r2) as std_r2, max(test_r2) as best_r2,
             avg(test_smape) as avg_smape, stddev_pop(test_smape) as std_smape, min(test_smape) as best_smape,
             (select count(*) from (select distinct partner_code, store_code from sales)) as total_stores_attempted
      from fres) x""", more="," + _ERR))
def q_train_all_stores(spark, sf_dir):
    """M8: the summary of the training run over all stores, with the target flags."""
    s = EV.training_summary(store_run(spark, sf_dir)["registry"], V.distinct_stores(sales(spark, sf_dir)))
    flags = {"r2_target_achieved": (F.col("avg_r2") >= EV.TARGET_R2).cast("int"),
             "smape_target_achieved": (F.col("avg_smape") <= EV.TARGET_SMAPE).cast("int")}
    return s.withColumns(flags).select("successful_models", "total_stores_attempted", *[
        F.round(c, D).alias(c) for c in ["success_rate", *_SUMMARY]], *flags)


@register("model_registry", _sql(f"""
select partner_code, store_code, train_samples, test_samples as val_samples, n_features, '{VERSION}' as version,
       true as model_saved, round(test_mae, {D}) as mae, round(test_rmse, {D}) as rmse from fres""", more="," + _ERR))
def q_model_registry(spark, sf_dir):
    """The written registry, one row per store with a model."""
    return store_run(spark, sf_dir)["registry"].select(
        *KEY, "train_samples", F.col("test_samples").alias("val_samples"), F.size("features").alias("n_features"),
        "version", "model_saved", F.round("test_mae", D).alias("mae"), F.round("test_rmse", D).alias("rmse"))


@register("forecast_store", _sql(f"""
select partner_code, store_code, date, {_MONEY}
from fband join (select partner_code, store_code from sales group by 1, 2
                 order by count(*) desc, partner_code, store_code limit 1) top using (partner_code, store_code)""",
                                 horizon=True, more=_BAND))
def q_forecast_store(spark, sf_dir):
    """M9: the horizon forecast of one store (the largest) with its band."""
    top = V.store_sizes(sales(spark, sf_dir)).orderBy(F.desc("n_rows"), *KEY).first()
    f = V.filter_store(band(spark, sf_dir, store_run(spark, sf_dir)), top["partner_code"], top["store_code"])
    return f.select(*KEY, "date", *_money())


@register("bulk_forecast_forest", _sql(f"""
select req.partner_code, req.store_code, case when md.partner_code is null then 'model_not_found' else 'success' end as status,
       case when md.partner_code is not null then {len(REFERENCE_FEATURES)} end as features_used, date, {_MONEY}
from (select distinct partner_code, store_code from sales
      union select * from (values {_REQUESTED}) v(partner_code, store_code)) req
left join md using (partner_code, store_code) left join fband using (partner_code, store_code)""", horizon=True, more=_BAND))
def q_bulk_forecast_forest(spark, sf_dir):
    """One status for every requested store, and the horizon of each that succeeds."""
    run = store_run(spark, sf_dir)
    return statuses(spark, sf_dir, run).select(*KEY, "status", "features_used").join(
        band(spark, sf_dir, run).select(*KEY, "date", *_money()), KEY, "left")


@register("backtest_forest", _sql(f"""
select {', '.join(ROW_KEY)}, round(exp(billings) - 1, 4) as actual, round(exp(prediction) - 1, 4) as predicted,
       round((exp(billings) - 1) - (exp(prediction) - 1), 4) as error
from (select *, row_number() over (partition by partner_code, store_code
                                   order by date desc, l_orderkey desc, l_linenumber desc, l_partkey desc) as rn
      from fsrc) x join fpred using ({', '.join(ROW_KEY)}) where rn <= {BACKTEST_N}"""))
def q_backtest_forest(spark, sf_dir):
    """M17 with the forest: the last 5 history rows of each store."""
    bt = EV.backtest_recent(store_run(spark, sf_dir)["history"], F.expm1("billings"), F.expm1("prediction"), BACKTEST_N)
    return bt.select(*ROW_KEY, *[F.round(c, 4).alias(c) for c in ("actual", "predicted", "error")])


@register("generate_forecast", _sql(f"""
select strftime(date, '%Y-%m-%d') as date, partner_code, store_code, dayname(date) as day_of_week,
       cast(month(date) as integer) as month, cast(quarter(date) as integer) as quarter, prediction is not null as predicted,
       round(greatest(exp(prediction) - 1, 0.0), 4) as predicted_monto
from fsrc join fpred using ({', '.join(ROW_KEY)}) where split = 'future'""", template=True))
def q_generate_forecast(spark, sf_dir):
    """Template rows -> features -> the store's forest -> daily rows with the amount, day name,
    month and quarter."""
    p = F.greatest(F.expm1("prediction"), F.lit(0.0))
    return store_run(spark, sf_dir)["template"].select(
        F.date_format("date", "yyyy-MM-dd").alias("date"), *KEY, F.date_format("date", "EEEE").alias("day_of_week"),
        F.month("date").alias("month"), F.quarter("date").alias("quarter"), F.col("prediction").isNotNull().alias("predicted"),
        F.round(p, 4).alias("predicted_monto"))
