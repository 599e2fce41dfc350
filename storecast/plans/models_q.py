"""The pooled forest and its registered queries, and the rows that
all model queries train and forecast on; those of the per-store forests are in ``store_forest_q``.

All of them read one training run: the fleet forest over all stores and rows
(``fleet``), written once per folder as scaler, model, scores and registry.  It
is one distributed model, not one forest per store.  Features are those of the
row before (``shift=1``, D5), so nothing of a row's own target leaks, and every
horizon day takes its own-target features from the store's last history row
(direct horizon) beside its own calendar columns.

Forest values cannot come from SQL.  The queries therefore return what SQL can
state (stores, days, split sizes, statuses, actuals) and booleans that must
hold for the values (predictions not negative and inside their band, metrics
in range, importances that add up); the values themselves are in ``fleet``'s
tables.

``store_fleet`` is the reference's explicit ``max_stores`` run: one forest per store.
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from storecast.functions.exprs import QUALITY_FALLBACK, QUALITY_THRESHOLDS, quality_label
from storecast.operators import evaluation as EV
from storecast.operators import features as FE
from storecast.operators import forecast as FC
from storecast.operators import models as MD
from storecast.operators import runs as RN
from storecast.operators import validation as V
from storecast.plans.catalog import register
from storecast.plans.evaluation_q import _NN, _W, _feature_sql
from storecast.plans.features_q import REFERENCE_FEATURES, ROW_KEY, dealt_input, model_input
from storecast.plans.forecast_q import (HORIZON_DAYS, STATS_SQL, TEMPLATE_DAYS, TEMPLATE_START_SQL, _cal_sql,
                                        requested_stores, template_start)
from storecast.plans.quality_q import STORE_LIST
from storecast.plans.runs_q import EXPERIMENT, PARENT_TAGS, long_log, run_tables
from storecast.session import scratch_path, write_table, write_to
from storecast.sources.tables import read_table, sales

KEY = ["partner_code", "store_code"]
VERSION = "0.2.0"
RUN_NAME = "fleet_forest"
SHIFT = 1
OWN = [c for c in REFERENCE_FEATURES if c.startswith("billings_")] + ["miles"]
_FLEETS: dict[tuple, dict] = {}
MAX_FIT_THREADS = 64


# ------------------------------------------------------------- rows to model

def history_rows(spark, sf_dir, min_samples=1, parts=None):
    """Complete rows of every store with shifted features and the train/test
    split; stores below ``min_samples`` rows (J1) are left out.  ``parts``: tasks that the
    stores are dealt to (default: by bytes)."""
    h, hot = dealt_input(spark, sf_dir, parts)
    if min_samples > 1:
        h = h.join(V.store_sizes(sales(spark, sf_dir), min_samples).select(*KEY), KEY, "left_semi")
    a = FE.series_features(FE.calendar_features(h), "billings", FE.REFERENCE_FAMILIES, hot=hot, shift=SHIFT,
                           also_shift=["miles"])
    rows = EV.temporal_split(V.drop_null_rows(a, REFERENCE_FEATURES + ["billings"]), hot=hot)
    return rows.select(*ROW_KEY, "split", "billings", *REFERENCE_FEATURES)


def last_input(spark, sf_dir):
    """Each store's last rows, as many as the features of its next row need, written once."""
    return write_table(V.recent_rows(model_input(spark, sf_dir), FE.LOOKBACK + 1), "horizon-tail")


def horizon_rows(spark, sf_dir, days=HORIZON_DAYS, tail=None):
    """The days after each store's last row: calendar columns of the day, own
    features as of the last row."""
    tail = last_input(spark, sf_dir) if tail is None else tail
    last = FC.last_rows(FE.series_features(tail, "billings", FE.REFERENCE_FAMILIES), 1).select(
        *KEY, F.date_add("date", 1).alias("start_date"), *OWN)
    return FE.calendar_features(FC.store_calendar(last, days)).select(*KEY, "date", *REFERENCE_FEATURES)


def template_rows(spark, sf_dir, days=TEMPLATE_DAYS, tail=None):
    """M13's template days with features over history and the drawn targets before them."""
    tail = (last_input(spark, sf_dir) if tail is None else tail).withColumn("_new", F.lit(False))
    raw = sales(spark, sf_dir).select(*ROW_KEY, "billings", "miles")
    tpl = FC.future_template(raw, template_start(spark, sf_dir), days)
    tpl = FE.log_target(FE.target_transform(
        tpl.select(*KEY, "date", "billings", "miles").withColumn("_new", F.lit(True)), "billings"), "billings")
    both = FE.series_features(FE.calendar_features(tail.unionByName(tpl, allowMissingColumns=True)), "billings",
                              FE.REFERENCE_FAMILIES, shift=SHIFT, also_shift=["miles"])
    return both.filter("_new").select(*KEY, "date", *REFERENCE_FEATURES)


# ------------------------------------------------------------- fleet forest

def input_state(spark, sf_dir) -> tuple:
    """Rows, last day and a sum of row hashes of the sales lines: a rewritten input has another."""
    li = read_table(spark, sf_dir, "lineitem")
    h = F.pmod(F.xxhash64("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_discount", "l_quantity", "l_shipdate"),
               F.lit(1 << 31))
    return tuple(li.agg(F.count(F.lit(1)), F.max("l_shipdate").cast("string"), F.sum(h)).first())

def fleet(spark, sf_dir, min_samples=1, params=MD.FLEET_PARAMS, root=None):
    """Train the fleet forest and write its tables, or read those of an equal run
    (same data, selection, features and parameters) under ``root``."""
    base = root or scratch_path(spark, "fleet")
    key = (spark.sparkContext.applicationId, sf_dir, min_samples, params, root)
    if key in _FLEETS:
        return _FLEETS[key]
    path = sf_dir if "://" in sf_dir else os.path.abspath(sf_dir)
    at = f"{base}/{MD.digest(path, input_state(spark, sf_dir), min_samples, params, REFERENCE_FEATURES, SHIFT, VERSION)}"
    if not MD.path_exists(spark, f"{at}/registry/_SUCCESS"):       # the registry is written last
        write_to(history_rows(spark, sf_dir, min_samples), f"{at}/history", compression="zstd")
        hist = spark.read.parquet(f"{at}/history")
        MD.train_fleet(hist.filter(F.col("split") == "train"), REFERENCE_FEATURES, at, params=params)
        for name, rows in (("history", hist), ("horizon", horizon_rows(spark, sf_dir))):
            scored = MD.score(rows, at, REFERENCE_FEATURES)
            if name == "history":       # its features are in the history table
                scored = scored.select(*ROW_KEY, "split", "billings", "prediction")
            scored.write.mode("overwrite").parquet(f"{at}/scores/{name}")
        res = EV.model_results(spark.read.parquet(f"{at}/scores/history"),
                               n_features=len(REFERENCE_FEATURES) + len(MD.LEVELS))
        res.select("*", F.lit(f"{at}/model").alias("model_file"), F.lit(f"{at}/scaler").alias("scaler_file"),
                   F.lit(MD.path_exists(spark, f"{at}/model/metadata/_SUCCESS")).alias("model_saved"),
                   F.array(*[F.lit(c) for c in [*REFERENCE_FEATURES, *MD.LEVELS]]).alias("features"),
                   F.lit(VERSION).alias("version")).write.mode("overwrite").parquet(f"{at}/registry")
    out = {"root": at, "registry": spark.read.parquet(f"{at}/registry"),
           "importances": MD.importances(spark, at, REFERENCE_FEATURES)}
    out |= {n: spark.read.parquet(f"{at}/scores/{n}") for n in ("history", "horizon")}
    _FLEETS[key] = out
    return out


def band(spark, sf_dir, fl):
    """Horizon forecasts on the original scale with their band."""
    st = FC.history_stats(sales(spark, sf_dir).select(*KEY, "date", "billings"))
    f = fl["horizon"].join(st.select(*KEY, "hist_mean", "hist_std"), KEY)
    return FC.confidence_band(f.withColumn("predicted_billings", F.greatest(F.expm1("prediction"), F.lit(0.0))))


def statuses(spark, sf_dir, fl):
    """One status for every requested store, from the written tables."""
    used = F.lit(0)
    for c in REFERENCE_FEATURES:
        used = used + F.col(c).isNotNull().cast("int")
    horizon = fl["horizon"].groupBy(*KEY).agg(F.max(used).alias("n_features"), F.count("prediction").alias("n_predicted"))
    return FC.forecast_status(requested_stores(spark, sf_dir), fl["registry"], V.distinct_stores(sales(spark, sf_dir)),
                              horizon)


# ------------------------------------------------- one forest per named store

def fit_threads(spark) -> int:
    """Concurrent store fits: one per core of the session, at most 64 (each
    fit is a sequence of small jobs driven from the driver)."""
    env = os.environ.get("STORECAST_FIT_THREADS")
    return int(env) if env else max(1, min(MAX_FIT_THREADS, spark.sparkContext.defaultParallelism))


def store_fleet(spark, sf_dir, max_stores, params=MD.ForestParams(), min_samples=1, root=None):
    """M8 as the reference runs it: one forest for each of the first ``max_stores``
    stores (A16) with enough rows (J1).  The folder is named by selection, features
    and parameters, so a resumed run never meets another run's table or
    models; every store asked for has a row in ``status``."""
    key = (spark.sparkContext.applicationId, sf_dir, "stores", max_stores, params, min_samples, root)
    if key in _FLEETS:
        return _FLEETS[key]
    base = root or scratch_path(spark, "store-fleet")
    path = sf_dir if "://" in sf_dir else os.path.abspath(sf_dir)
    at = f"{base}/{MD.digest(path, input_state(spark, sf_dir), max_stores, min_samples, params, REFERENCE_FEATURES, SHIFT, VERSION)}"
    table = f"{at}/scoring"
    if not MD.path_exists(spark, f"{table}/_SUCCESS"):
        rows = write_table(history_rows(spark, sf_dir, min_samples), "store-history")
        chosen = write_table(V.limit_stores(rows.select(*KEY).distinct(), max_stores), "store-selection")
        hist = rows.join(chosen, KEY, "left_semi").withColumn("kind", F.lit("history"))
        fut = horizon_rows(spark, sf_dir).join(chosen, KEY, "left_semi").withColumn("kind", F.lit("future"))
        both = hist.unionByName(fut, allowMissingColumns=True)
        scaled = MD.apply_scaler(both, MD.fit_scaler(hist.filter(F.col("split") == "train"), REFERENCE_FEATURES),
                                 REFERENCE_FEATURES)
        scaled.withColumn("store_id", F.concat_ws("_", *KEY)).write.mode("overwrite").partitionBy("store_id").parquet(table)
    # at most max_stores ids: the fit loop's work list
    store_ids = sorted(r[0] for r in spark.read.parquet(table).select("store_id").distinct().collect())
    fits = MD.fit_store_forests(spark, table, store_ids, REFERENCE_FEATURES, at, params=params,
                                parallelism=fit_threads(spark))
    ok = any(f["status"] == "success" for f in fits)
    scores = MD.read_scores(spark, at) if ok else None
    out = {"root": at, "table": table, "fits": fits, "store_ids": store_ids, "scores": scores,
           "status": MD.status_frame(spark, fits),
           "results": EV.model_results(scores.filter(F.col("kind") == "history"), n_features=len(REFERENCE_FEATURES))
           if ok else None,
           "importances": MD.importances_frame(spark, fits, REFERENCE_FEATURES)}
    _FLEETS[key] = out
    return out


# ------------------------------------------------------------------ SQL text

_CAL = [c for c in REFERENCE_FEATURES if c not in OWN]
_OVER = f"over ({_W} order by date, l_orderkey, l_linenumber, l_partkey)"
SPLIT_CTE = f"""
sh as (select {', '.join(ROW_KEY + ['billings'] + _CAL)}, {', '.join(f'lag({c}, {SHIFT}) {_OVER} as {c}' for c in OWN)}
       from ({_feature_sql()}) f),
ev as (select *, case when _pos <= floor({EV.TRAIN_FRACTION} * _cnt) then 'train' else 'test' end as split
       from (select *, row_number() {_OVER} as _pos, count(*) over ({_W}) as _cnt from sh where {_NN}) x
       where _cnt >= {EV.MIN_STORE_ROWS}),
md as (select partner_code, store_code, count(*) filter (where split = 'train') as train_samples,
              count(*) filter (where split = 'test') as test_samples from ev group by 1, 2)"""
N_USED = len(REFERENCE_FEATURES) + len(MD.LEVELS)


def _sql(body, ctes=""):
    return f"with {SPLIT_CTE}{ctes}\n{body}"


# ------------------------------------------------------------------ queries

@register("store_forest_pooled", _sql("""
select count(*) as stores, sum(train_samples)::bigint as train_rows, sum(test_samples)::bigint as test_rows,
       true as predictions_finite from md"""))
def q_store_forest_pooled(spark, sf_dir):
    """M8 for any fleet: one distributed fit over all rows of all stores."""
    h = fleet(spark, sf_dir)["history"]
    return h.agg(F.count_distinct(*KEY).alias("stores"), F.count_if(F.col("split") == "train").alias("train_rows"),
                 F.count_if(F.col("split") == "test").alias("test_rows"),
                 F.every(F.coalesce(F.abs("prediction") < 1e6, F.lit(False))).alias("predictions_finite"))


_REQUESTED = ", ".join("('{}', '{}')".format(*x.strip().split("_", 1)) for x in STORE_LIST.split(",")
                       if "_" in x and all(x.strip().split("_", 1)))


def forest_params(params=MD.FLEET_PARAMS):
    return {"model_type": "random_forest", "n_estimators": params.num_trees, "max_depth": params.max_depth,
            "min_samples_leaf": params.min_instances_per_node, "max_features": params.feature_subset,
            "random_state": params.seed, "min_samples": 1, "max_stores": "all"}


def _log_sql():
    sk = "partner_code || '_' || store_code"
    parent = f"md5(concat_ws('|', '{EXPERIMENT}', '{RUN_NAME}'))"
    child = f"md5(concat_ws('|', '{EXPERIMENT}', '{RUN_NAME}', {sk}))"
    known = {"model_type": "'random_forest'", "partner_code": "partner_code", "store_code": "store_code",
             "train_samples": "cast(train_samples as varchar)", "test_samples": "cast(test_samples as varchar)",
             "n_features": f"'{N_USED}'", "store_id": sk,
             "training_date": "(select strftime(max(date), '%Y-%m-%d') from sales)"}
    rows = [(parent, "metric", k, "cast(null as varchar)", "") for k in RN.PARENT_METRICS]
    rows += [(parent, "param", k, f"'{v}'", "") for k, v in forest_params().items()]
    rows += [(parent, "tag", k, f"'{v}'", "") for k, v in PARENT_TAGS.items()]
    rows += [(child, "metric", k, "cast(null as varchar)", " from md") for k in RN.CHILD_METRICS]
    rows += [(child, kind, k, known.get(k, "'label'"), " from md")
             for kind, keys in (("param", RN.CHILD_PARAMS), ("tag", RN.CHILD_TAGS)) for k in keys]
    return " union all ".join(f"select {i} as run_id, '{kind}' as kind, '{k}' as key, {v} as value_text, "
                              f"{'true' if kind == 'metric' else 'false'} as has_number{src}" for i, kind, k, v, src in rows)


@register("run_log_forest", _sql(_log_sql()))
def q_run_log_forest(spark, sf_dir):
    """S8 for the forest run: params, metrics and tags; a quality label is shown as ``label``."""
    _, metrics, params, tags = run_tables(spark, sf_dir, fleet(spark, sf_dir)["registry"], RUN_NAME, forest_params())
    labels = [name for name, _ in QUALITY_THRESHOLDS] + [QUALITY_FALLBACK]
    text = F.when((F.col("key") == "quality") & F.col("value_text").isin(labels), F.lit("label")).otherwise(F.col("value_text"))
    return long_log(metrics, params, tags).select("run_id", "kind", "key", text.alias("value_text"),
                                                  F.col("value_double").isNotNull().alias("has_number"))
