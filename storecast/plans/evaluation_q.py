"""Registered evaluation queries (SURVEY §2.7 M1, M2, M4-M6, M17, M18 and
§2.4 A20-A24, A35).

Two deterministic predictors are evaluated, so every metric has an exact SQL
oracle and more than one run and quality label occur: the seasonal naive
forecast (the store's value seven rows earlier, on the log target) and a
per-store least-squares line on the 7-row trend, fitted on the train rows
(with the same-row leakage of the reference's features, D5).  The forests
are evaluated by the same operators in ``models_q``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from storecast.functions.exprs import (DOCUMENTED_QUALITY, QUALITY_FALLBACK, QUALITY_THRESHOLDS, ZERO_GUARD,
                                       documented_label)
from storecast.operators import evaluation as EV
from storecast.operators import validation as V
from storecast.plans.catalog import register
from storecast.plans.features_q import REFERENCE_FEATURES, ROW_KEY, feature_table
from storecast.session import memo_checkpoint, write_table
from storecast.sources.tables import sales

PREDICTOR_COL = "billings_lag_7"
LINE_COL = "billings_trend_7"
NAIVE, LINE = "seasonal_naive_7", "linear_trend_7"
PREDICTORS = {NAIVE: PREDICTOR_COL, LINE: LINE_COL}
BACKTEST_N = 5
TOP_K = 5
LISTING_N = 10
D = EV.METRIC_DIGITS


def predictions(spark, sf_dir, with_hot=False):
    """Feature table -> complete rows (P12) -> temporal split (M1) ->
    seasonal naive prediction."""
    f, hot = feature_table(spark, sf_dir, with_hot=True)
    f = V.drop_null_rows(f, REFERENCE_FEATURES + ["billings"])
    p = EV.temporal_split(f, hot=hot).withColumn("prediction", F.col(PREDICTOR_COL))
    return (p, hot) if with_hot else p


def with_lines(p):
    """(predictor, row) for both predictors; ``p`` is read three times."""
    train = p.filter(F.col("split") == "train").groupBy(*V.STORE_KEY).agg(
        F.regr_slope("billings", LINE_COL).alias("_slope"), F.regr_intercept("billings", LINE_COL).alias("_cut"))
    line = p.join(train, list(V.STORE_KEY)).withColumn("prediction", F.col("_cut") + F.col("_slope") * F.col(LINE_COL))
    cols = [*V.STORE_KEY, "split", "billings", "prediction"]
    return p.select(F.lit(NAIVE).alias("predictor"), *cols).unionByName(
        line.select(F.lit(LINE).alias("predictor"), *cols))


def results(spark, sf_dir, predictor=None):
    """Per-store results of each predictor (not rounded), written once per
    session; ``predictor`` picks one run."""
    def build():
        p = write_table(predictions(spark, sf_dir).select(
            *V.STORE_KEY, "split", "billings", "prediction", LINE_COL), "predictions")
        return EV.model_results(with_lines(p), key=["predictor", *V.STORE_KEY], n_features=len(REFERENCE_FEATURES))
    res = memo_checkpoint(spark, ("results", sf_dir), build)
    return res if predictor is None else res.filter(F.col("predictor") == predictor).drop("predictor")


# ------------------------------------------------------------------ SQL text

def _feature_sql():
    from storecast.operators import features as FE
    from storecast.plans.features_q import MODEL_INPUT_SQL
    return FE.series_features_sql(f"(select *, {FE.calendar_sql('date')} from {MODEL_INPUT_SQL}) c",
                                  "billings", FE.FAMILIES, digits=None, select_cols=["*"])


_NN = " and ".join(f"{c} is not null" for c in REFERENCE_FEATURES + ["billings"])
_W = "partition by partner_code, store_code"
EVAL_CTE = f"""
eb as (
  select *, case when _pos <= floor({EV.TRAIN_FRACTION} * _cnt) then 'train' else 'test' end as split,
         {PREDICTOR_COL} as prediction
  from (select *, row_number() over ({_W} order by date, l_orderkey, l_linenumber, l_partkey) as _pos,
               count(*) over ({_W}) as _cnt
        from ({_feature_sql()}) f where {_NN}) x
  where _cnt >= {EV.MIN_STORE_ROWS})"""


def _metric_sql(y, p, cond, prefix, suffix="", with_n=True):
    yy, pp = f"(case when {cond} then {y} end)", f"(case when {cond} then {p} end)"
    sse = f"sum(pow({yy} - {pp}, 2))"
    sst = f"(var_pop({yy}) * count({yy}))"
    den = f"((abs({yy}) + abs({pp})) / 2)"
    out = [f"count({yy}) as {prefix}_samples"] if with_n else []
    return out + [
        f"avg(abs({yy} - {pp})) as {prefix}_mae{suffix}",
        f"sqrt(avg(pow({yy} - {pp}, 2))) as {prefix}_rmse{suffix}",
        f"case when {sst} = 0 then (case when {sse} = 0 then 1.0 else 0.0 end) "
        f"else 1 - {sse} / {sst} end as {prefix}_r2{suffix}",
        f"100 * avg(abs({yy} - {pp}) / (case when {den} = 0 then {ZERO_GUARD} else {den} end)) as {prefix}_smape{suffix}"]


def _quality_sql(c):
    whens = " ".join(f"when {c} > {t} then '{label}'" for label, t in QUALITY_THRESHOLDS)
    return f"case {whens} else '{QUALITY_FALLBACK}' end"


RESULTS_CTE = EVAL_CTE + f""",
line as (select partner_code, store_code, regr_slope(billings, {LINE_COL}) as slope,
                regr_intercept(billings, {LINE_COL}) as cut from eb where split = 'train' group by 1, 2),
pr as (select '{NAIVE}' as predictor, partner_code, store_code, split, billings, prediction from eb
       union all
       select '{LINE}' as predictor, eb.partner_code, eb.store_code, eb.split, eb.billings,
              line.cut + line.slope * eb.{LINE_COL} as prediction
       from eb join line on eb.partner_code = line.partner_code and eb.store_code = line.store_code),
res0 as (
  select predictor, partner_code, store_code,
         {", ".join(_metric_sql("billings", "prediction", "split = 'train'", "train")
                    + _metric_sql("billings", "prediction", "split = 'test'", "test")
                    + _metric_sql("(exp(billings) - 1)", "(exp(prediction) - 1)", "split = 'test'", "test",
                                  "_original", with_n=False))}
  from pr group by predictor, partner_code, store_code),
resall as (select *, {_quality_sql('test_r2')} as quality, {len(REFERENCE_FEATURES)} as n_features from res0),
res as (select * exclude (predictor) from resall where predictor = '{LINE}')"""


def _rsel(cols):
    """SQL twin of ``EV.rounded`` for a column list."""
    def one(c):
        if c.endswith("_original"):
            return f"round({c}, 4) as {c}"
        return f"round({c}, {D}) as {c}" if c.rpartition("_")[2] in ("mae", "rmse", "r2", "smape", "rate") else c
    return ", ".join(map(one, cols))


def _with_results(sql):
    return f"with {RESULTS_CTE}\n{sql}"


# ------------------------------------------------------------------ queries

@register("temporal_split", f"with {EVAL_CTE}\nselect {', '.join(ROW_KEY)}, split from eb")
def q_temporal_split(spark, sf_dir):
    return predictions(spark, sf_dir).select(*ROW_KEY, "split")


SCALE_COLS = REFERENCE_FEATURES


@register("standard_scale", f"""with {EVAL_CTE},
st as (select partner_code, store_code,
              {", ".join(f"avg({c}) as m_{c}, stddev_pop({c}) as s_{c}" for c in SCALE_COLS)}
       from eb where split = 'train' group by 1, 2)
select {", ".join("eb." + c for c in ROW_KEY)}, eb.split,
       {", ".join(f"round((eb.{c} - st.m_{c}) / (case when st.s_{c} = 0 then 1.0 else st.s_{c} end), 6) as {c}"
                  for c in SCALE_COLS)}
from eb left join st on eb.partner_code = st.partner_code and eb.store_code = st.store_code""")
def q_standard_scale(spark, sf_dir):
    rows, hot = predictions(spark, sf_dir, with_hot=True)
    rows = rows.select(*ROW_KEY, "split", *SCALE_COLS)
    if hot is None:         # mean and std, equal in all rows of a store, take next to nothing in the table
        rows = EV.fit_scaler(rows, SCALE_COLS, hot=hot)
    # the scaler of hot stores reads its input twice (train stats, then every row): write it once
    scaled = EV.standard_scale(write_table(rows, "scale-rows", compression="zstd"), SCALE_COLS)
    return scaled.select(*ROW_KEY, "split", *[F.round(c, 6).alias(c) for c in SCALE_COLS])


_M4 = ["train_samples", "train_mae", "train_rmse", "train_r2", "test_samples", "test_mae",
       "test_rmse", "test_r2", "test_mae_original", "test_rmse_original", "test_r2_original"]


RUN = ["predictor", *V.STORE_KEY]


def _metrics_query(cols):
    def q(spark, sf_dir):
        return EV.rounded(results(spark, sf_dir).select(*RUN, *cols))
    return q


for _key, _cols in (("reg_metrics", _M4), ("smape", ["train_smape", "test_smape", "test_smape_original"])):
    register(_key, _with_results(f"select {_rsel(RUN + _cols)} from resall"))(_metrics_query(_cols))


_DOC_LABEL = "case " + " ".join(f"when test_r2 >= {r} and test_smape <= {m} then '{name}'"
                                for name, r, m in DOCUMENTED_QUALITY) + f" else '{QUALITY_FALLBACK}' end"


@register("quality_label", _with_results(
    f"select {_rsel(RUN + ['test_r2', 'quality'])}, {_DOC_LABEL} as documented_quality from resall"))
def q_quality_label(spark, sf_dir):
    """M6, and the rule of the documentation."""
    return EV.rounded(results(spark, sf_dir).select(
        *RUN, "test_r2", "quality", documented_label("test_r2", "test_smape").alias("documented_quality")))


@register("quality_distribution", _with_results(f"""
select predictor, quality, count(*) as models,
       round(100.0 * count(*) / sum(count(*)) over (partition by predictor), {D}) as pct
from resall group by predictor, quality"""))
def q_quality_distribution(spark, sf_dir):
    return EV.quality_distribution(results(spark, sf_dir), ["predictor"])


SUMMARY_COLS = ["successful_models", "avg_r2", "std_r2", "best_r2", "avg_smape", "std_smape", "best_smape",
                "total_stores_attempted", "success_rate"]
SUMMARY_SQL = f"""
summ as (select *, case when total_stores_attempted > 0 then 100.0 * successful_models / total_stores_attempted
                        else 0.0 end as success_rate
         from (select predictor, count(*) as successful_models, avg(test_r2) as avg_r2,
                stddev_pop(test_r2) as std_r2, max(test_r2) as best_r2,
                avg(test_smape) as avg_smape, stddev_pop(test_smape) as std_smape,
                min(test_smape) as best_smape,
                (select count(*) from (select distinct partner_code, store_code from sales)) as total_stores_attempted
         from resall group by predictor))"""


def summary(spark, sf_dir):
    return EV.training_summary(results(spark, sf_dir), V.distinct_stores(sales(spark, sf_dir)), ["predictor"])


@register("training_summary", _with_results(f""", {SUMMARY_SQL.strip()}
select predictor, {_rsel(SUMMARY_COLS)} from summ"""))
def q_training_summary(spark, sf_dir):
    return EV.rounded(summary(spark, sf_dir)).select("predictor", *SUMMARY_COLS)


@register("target_achievement", _with_results(f""", {SUMMARY_SQL.strip()}
select predictor, {_rsel(["avg_r2", "avg_smape"])},
       coalesce(cast(avg_r2 >= {EV.TARGET_R2} as integer), 0) as r2_target_achieved,
       coalesce(cast(avg_smape <= {EV.TARGET_SMAPE} as integer), 0) as smape_target_achieved from summ"""))
def q_target_achievement(spark, sf_dir):
    return EV.rounded(EV.target_achievement(summary(spark, sf_dir), by=["predictor"]))


@register("good_plus_share", _with_results(f"""
select predictor, count(*) filter (where quality = 'EXCELENTE') as excellent_models,
       count(*) filter (where quality in ('EXCELENTE', 'BUENO')) as good_plus_models,
       round(100.0 * count(*) filter (where quality = 'EXCELENTE') / count(*), {D}) as excellent_pct,
       round(100.0 * count(*) filter (where quality in ('EXCELENTE', 'BUENO')) / count(*), {D}) as good_plus_pct
from resall group by predictor"""))
def q_good_plus_share(spark, sf_dir):
    return EV.good_plus_share(results(spark, sf_dir), ["predictor"])


@register("top5_stores", _with_results(f"""
select store_key, {_rsel(["test_r2"])}, cast(row_number() over (order by test_r2 desc, store_key) as integer) as rank
from (select partner_code || '_' || store_code as store_key, max(test_r2) as test_r2 from res group by 1) t
order by rank limit {TOP_K}"""))
def q_top5_stores(spark, sf_dir):
    return EV.rounded(EV.top_stores(results(spark, sf_dir, LINE), TOP_K))


@register("trained_listing", _with_results(f"""
select store_key, {_rsel(["test_r2", "test_smape"])}, quality
from (select partner_code || '_' || store_code as store_key, * from res) t order by store_key limit {LISTING_N}"""))
def q_trained_listing(spark, sf_dir):
    return EV.rounded(EV.trained_listing(results(spark, sf_dir, LINE), LISTING_N))


BACKTEST_SQL = f"""
bt as (select {', '.join(ROW_KEY)}, actual, predicted, actual - predicted as error,
              (actual - predicted) / (case when actual <> 0 then actual end) * 100 as error_pct
       from (select *, exp(billings) - 1 as actual, exp({PREDICTOR_COL}) - 1 as predicted,
                    row_number() over ({_W} order by date desc, l_orderkey desc, l_linenumber desc,
                                       l_partkey desc) as rn
             from ({_feature_sql()}) f) x
       where rn <= {BACKTEST_N})"""


def backtest(spark, sf_dir):
    f = feature_table(spark, sf_dir)
    return EV.backtest_recent(f, F.expm1("billings"), F.expm1(PREDICTOR_COL), BACKTEST_N)


@register("backtest_recent", f"""with {BACKTEST_SQL}
select {', '.join(ROW_KEY)}, round(actual, 4) as actual, round(predicted, 4) as predicted,
       round(error, 4) as error, round(error_pct, 4) as error_pct from bt""")
def q_backtest_recent(spark, sf_dir):
    bt = backtest(spark, sf_dir)
    return bt.select(*ROW_KEY, *[F.round(c, 4).alias(c) for c in ("actual", "predicted", "error", "error_pct")])


@register("backtest_metrics", f"""with {BACKTEST_SQL}
select partner_code, store_code, round(avg(abs(error)), 4) as mae, round(sqrt(avg(pow(error, 2))), 4) as rmse,
       round(avg(abs(error_pct)), 4) as mape from bt group by 1, 2""")
def q_backtest_metrics(spark, sf_dir):
    return EV.backtest_metrics(backtest(spark, sf_dir))
