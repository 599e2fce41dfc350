"""Registered queries of the recursive horizon.

The predictor is each store's least-squares line on the 7-row trend of the row before, so
the whole recursion has exact SQL; ``forest_horizon`` runs the same loop with the per-store
forests.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from storecast.operators import features as FE
from storecast.operators import forest as FO
from storecast.operators import recursive as RC
from storecast.plans.catalog import register
from storecast.plans.evaluation_q import LINE_COL
from storecast.plans.features_q import model_input
from storecast.plans.forecast_q import HORIZON_DAYS
from storecast.plans.models_q import KEY, SPLIT_CTE, history_rows
from storecast.plans.store_forest_q import HORIZON_KEY, QUERY_FOREST, store_run
from storecast.session import memo_checkpoint

WINDOW = 7      # rows of LINE_COL


def line_horizon(spark, sf_dir, days=HORIZON_DAYS):
    """``days`` recursive days of all stores with a model."""
    def build():
        train = history_rows(spark, sf_dir).where("split = 'train'")
        return RC.recursive_forecast(model_input(spark, sf_dir), days, RC.line_predictor(train, LINE_COL), ["trend"])
    return memo_checkpoint(spark, ("line-horizon", sf_dir, days), build)


def forest_horizon(spark, sf_dir, days=HORIZON_DAYS, params=QUERY_FOREST):
    """The same with the per-store forests: every day is scored by the stores' written trees."""
    model = store_run(spark, sf_dir, params)["model"]
    return RC.recursive_forecast(model_input(spark, sf_dir), days, lambda rows: FO.score(rows, model, HORIZON_KEY),
                                 FE.REFERENCE_FAMILIES, extra=["miles"])


_SQL = f"""with recursive {SPLIT_CTE},
line as (select partner_code, store_code, regr_slope(billings, {LINE_COL}) as slope, regr_intercept(billings, {LINE_COL}) as cut
         from ev where split = 'train' group by 1, 2),
tails as (
  select partner_code, store_code, max(date) as last_date, list(billings order by rn desc) as ys
  from (select *, row_number() over (partition by partner_code, store_code
                                     order by date desc, l_orderkey desc, l_linenumber desc, l_partkey desc) as rn
        from (select partner_code, store_code, date, l_orderkey, l_linenumber, l_partkey,
                     ln(1 + greatest(billings, 0.1)) as billings from sales) s) x
  where rn <= {WINDOW} group by 1, 2),
ahead as (
  select partner_code, store_code, last_date, 0 as step, ys, null::double as prediction, cut, slope from tails join line using (partner_code, store_code)
  union all
  select partner_code, store_code, last_date, step + 1, list_append(ys[2:], p), p, cut, slope
  from (select *, cut + slope * (ys[{WINDOW}] - list_sum(ys) / {WINDOW}) as p from ahead where step < {HORIZON_DAYS}) x)"""


@register("forecast_recursive", f"""{_SQL}
select partner_code, store_code, cast(last_date + step as date) as date, step::int as step, round(prediction, 6) as prediction,
       round(greatest(exp(prediction) - 1, 0.0), 4) as predicted_billings
from ahead where step > 0""")
def q_forecast_recursive(spark, sf_dir):
    """M9: 28 days of every store, each day from features that hold the days before it."""
    return line_horizon(spark, sf_dir).select(
        *KEY, "date", F.col("step").cast("int").alias("step"), F.round("prediction", 6).alias("prediction"),
        F.round(F.greatest(F.expm1("prediction"), F.lit(0.0)), 4).alias("predicted_billings"))


@register("generate_forecast_recursive", f"""{_SQL}
select strftime(d, '%Y-%m-%d') as date, partner_code, store_code, dayname(d) as day_of_week, month(d)::int as month,
       quarter(d)::int as quarter, round(greatest(exp(prediction) - 1, 0.0), 4) as predicted_monto
from (select *, cast(last_date + step as date) as d from ahead where step between 1 and 7) x""")
def q_generate_forecast_recursive(spark, sf_dir):
    """A week of daily rows with day name, month and quarter."""
    f = line_horizon(spark, sf_dir).where("step <= 7")
    return f.select(F.date_format("date", "yyyy-MM-dd").alias("date"), *KEY, F.date_format("date", "EEEE").alias("day_of_week"),
                    F.month("date").alias("month"), F.quarter("date").alias("quarter"),
                    F.round(F.greatest(F.expm1("prediction"), F.lit(0.0)), 4).alias("predicted_monto"))
