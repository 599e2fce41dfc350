"""Registered forecast queries (SURVEY §2.3 J2-J6, §2.4 A17-A19, A25-A30,
§2.7 M10-M14, M16, §2.1 S4, S7).

The deterministic forecaster is the weekday baseline (M16); the model
registry holds the evaluation results of ``evaluation_q`` (one entry per
store that had enough complete rows).
"""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from storecast.operators import evaluation as EV
from storecast.operators import forecast as FC
from storecast.operators import validation as V
from storecast.plans.catalog import register
from storecast.plans.evaluation_q import LINE, RESULTS_CTE, results
from storecast.plans.quality_q import STORE_LIST
from storecast.session import scratch_path
from storecast.sources import csv_io as C
from storecast.sources.tables import sales

HORIZON_DAYS = 28         # forecast days of the bulk path
TEMPLATE_DAYS = 7         # days of the template path
MONEY = 4
JITTER_COLS = ["miles"]
TEMPLATE_NUMERIC = ["billings", "miles", "year", "month", "day", "quarter", "week_of_year",
                    "day_of_week", "day_of_month", "is_weekend", "is_month_start", "is_month_end"]
KEY = ["partner_code", "store_code"]


def _r(c, d=MONEY):
    return F.round(c, d).alias(c)


def history(spark, sf_dir):
    return sales(spark, sf_dir).select(*KEY, "date", "l_orderkey", "l_linenumber", "l_partkey",
                                       "billings", "miles")


def stats(spark, sf_dir):
    return FC.history_stats(history(spark, sf_dir))


def baseline(spark, sf_dir, days=HORIZON_DAYS):
    return FC.confidence_band(FC.weekday_baseline(stats(spark, sf_dir), days))


def registry(spark, sf_dir):
    r = EV.rounded(results(spark, sf_dir, LINE))
    return r.select(*KEY, F.col("test_mae").alias("mae"), F.col("test_rmse").alias("rmse"), "quality",
                    "test_r2", "test_smape", "train_samples", F.col("test_samples").alias("val_samples"),
                    "n_features",
                    F.concat(F.lit("models/store_"), F.concat_ws("_", *KEY)).alias("model_file"))


def requested_stores(spark, sf_dir):
    """All stores with history plus the stores of the request list."""
    listed = V.parse_store_list(spark, STORE_LIST)
    return V.distinct_stores(sales(spark, sf_dir)).unionByName(listed).distinct()


def status(spark, sf_dir):
    return FC.forecast_status(requested_stores(spark, sf_dir), registry(spark, sf_dir),
                              V.distinct_stores(sales(spark, sf_dir)))


def bulk(spark, sf_dir):
    st = status(spark, sf_dir).filter(F.col("status") == "success")
    f = baseline(spark, sf_dir).join(st, KEY)
    return f.select("date", _r("predicted_billings"), _r("confidence_lower"), _r("confidence_upper"),
                    *KEY, FC.store_key_col().alias("store_key"), F.col("quality").alias("model_quality"),
                    "test_r2", "test_smape")


def template_start(spark, sf_dir):
    return sales(spark, sf_dir).agg(F.date_add(F.max("date"), 1)).first()[0]


def template(spark, sf_dir):
    return FC.future_template(history(spark, sf_dir), template_start(spark, sf_dir), TEMPLATE_DAYS)


# ------------------------------------------------------------------ SQL text

MULTS = "[" + ", ".join(str(m) for m in FC.WEEKDAY_MULTIPLIERS) + "]"
TWO_PI = repr(2 * math.pi)


SKEY = "partner_code || '_' || store_code"


def _u(*parts):
    """SQL twin of ``md5_uniform``: parts joined by '|', md5, first 32 bits."""
    return (f"(('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 8))"
            f"::UBIGINT / 4294967296.0)")


def _z(stream):
    u1 = _u("cast(date as varchar)", SKEY, f"'{stream}1'")
    u2 = _u("cast(date as varchar)", SKEY, f"'{stream}2'")
    return f"(sqrt(-2.0 * ln(1.0 - {u1})) * cos({TWO_PI} * {u2}))"


STATS_SQL = """
st as (select partner_code, store_code, avg(billings) as hist_mean, stddev_samp(billings) as hist_std,
              count(*) as hist_rows, max(date) as last_date from sales group by 1, 2)"""


def _cal_sql(days, start="last_date + 1"):
    return (f"select *, cast(unnest(generate_series(cast({start} as timestamp), "
            f"cast({start} + {days - 1} as timestamp), interval 1 day)) as date) as date")


BASE_SQL = STATS_SQL + f""",
cal as ({_cal_sql(HORIZON_DAYS)} from st),
fc0 as (select *, greatest(0.0, hist_mean * {MULTS}[isodow(date)]
                           + {_z('b')} * {FC.BASELINE_NOISE} * coalesce(hist_std, 0.0)) as predicted_billings
        from cal),
fc as (select *, (predicted_billings - hist_mean) / (case when hist_mean <> 0 then hist_mean end) * 100 as variation_pct,
              greatest(predicted_billings - {FC.BAND_Z} * hist_std, 0.0) as confidence_lower,
              predicted_billings + {FC.BAND_Z} * hist_std as confidence_upper
       from fc0)"""


def _store_list_values():
    pairs = []
    for item in STORE_LIST.split(","):
        item = item.strip()
        if "_" in item:
            p, s = item.split("_", 1)
            if p and s:
                pairs.append(f"('{p}', '{s}')")
    return ", ".join(pairs)


STATUS_SQL = RESULTS_CTE + f""",
req as (select distinct partner_code, store_code from sales
        union select * from (values {_store_list_values()}) v(partner_code, store_code)),
hs as (select distinct partner_code, store_code from sales),
stat as (select req.partner_code, req.store_code, res.quality, round(res.test_r2, 6) as test_r2,
                round(res.test_smape, 6) as test_smape,
                case when res.partner_code is null then 'model_not_found'
                     when hs.partner_code is null then 'no_data' else 'success' end as status,
                case when res.partner_code is not null and hs.partner_code is not null then res.n_features end
                  as features_used
         from req left join res on req.partner_code = res.partner_code and req.store_code = res.store_code
                  left join hs on req.partner_code = hs.partner_code and req.store_code = hs.store_code)"""

BULK_SQL = STATUS_SQL + ", " + BASE_SQL.strip() + f""",
bulk as (select fc.date, round(fc.predicted_billings, 4) as predicted_billings,
                round(fc.confidence_lower, 4) as confidence_lower, round(fc.confidence_upper, 4) as confidence_upper,
                fc.partner_code, fc.store_code, fc.partner_code || '_' || fc.store_code as store_key,
                stat.quality as model_quality, stat.test_r2, stat.test_smape
         from fc join stat on fc.partner_code = stat.partner_code and fc.store_code = stat.store_code
         where stat.status = 'success')"""


# ------------------------------------------------------------------ queries

@register("history_stats", f"""with {STATS_SQL}
select partner_code, store_code, round(hist_mean, 4) as hist_mean, round(hist_std, 4) as hist_std,
       hist_rows from st""")
def q_history_stats(spark, sf_dir):
    return stats(spark, sf_dir).select(*KEY, _r("hist_mean"), _r("hist_std"), "hist_rows")


@register("last_date", f"""with {STATS_SQL}
select partner_code, store_code, last_date, last_date + 1 as horizon_start from st""")
def q_last_date(spark, sf_dir):
    return stats(spark, sf_dir).select(*KEY, "last_date", F.date_add("last_date", 1).alias("horizon_start"))


@register("weekday_profile", """
select partner_code, store_code, cast(isodow(date) - 1 as integer) as weekday, round(avg(billings), 4) as wd_mean,
       round(coalesce(stddev_samp(billings), 0.0), 4) as wd_std from sales group by 1, 2, 3""")
def q_weekday_profile(spark, sf_dir):
    return FC.weekday_profile(history(spark, sf_dir)).select(*KEY, "weekday", _r("wd_mean"), _r("wd_std"))


@register("store_calendar", f"""with {STATS_SQL}, cal as ({_cal_sql(HORIZON_DAYS)} from st)
select partner_code, store_code, date from cal""")
def q_store_calendar(spark, sf_dir):
    st = stats(spark, sf_dir).withColumn("start_date", F.date_add("last_date", 1))
    return FC.store_calendar(st, HORIZON_DAYS).select(*KEY, "date")


TEMPLATE_START_SQL = "(select max(date) + 1 from sales)"
LOOKUP_SQL = STATS_SQL + f""",
prof as (select partner_code, store_code, isodow(date) - 1 as weekday, avg(billings) as wd_mean,
                coalesce(stddev_samp(billings), 0.0) as wd_std from sales group by 1, 2, 3),
lastrow as (select * from (select *, row_number() over (partition by partner_code, store_code
              order by date desc, l_orderkey desc, l_linenumber desc, l_partkey desc) as rn from sales) where rn = 1),
tcal as (select lr.partner_code, lr.store_code, lr.miles, lr.partner_name, lr.store_name,
                cast(unnest(generate_series(cast({TEMPLATE_START_SQL} as timestamp),
                     cast({TEMPLATE_START_SQL} + {TEMPLATE_DAYS - 1} as timestamp), interval 1 day)) as date) as date
         from lastrow lr),
look as (select tcal.*, coalesce(prof.wd_mean, st.hist_mean) as day_mean, coalesce(prof.wd_std, st.hist_std) as day_std
         from tcal left join prof on tcal.partner_code = prof.partner_code and tcal.store_code = prof.store_code
                                 and isodow(tcal.date) - 1 = prof.weekday
                   left join st on tcal.partner_code = st.partner_code and tcal.store_code = st.store_code)"""


@register("weekday_lookup", f"""with {LOOKUP_SQL}
select partner_code, store_code, date, round(day_mean, 4) as day_mean, round(day_std, 4) as day_std from look""")
def q_weekday_lookup(spark, sf_dir):
    h = history(spark, sf_dir)
    st = FC.history_stats(h)
    cal = FC.store_calendar(st.select(*KEY).withColumn("start_date", F.lit(template_start(spark, sf_dir))),
                            TEMPLATE_DAYS)
    look = FC.weekday_lookup(cal, FC.weekday_profile(h), st)
    return look.select(*KEY, "date", _r("day_mean"), _r("day_std"))


TEMPLATE_SQL = LOOKUP_SQL + f""",
tpl as (select partner_code, store_code, date, miles,
               greatest(0.0, day_mean + {_z('t')} * {FC.TEMPLATE_NOISE} * day_std) as billings,
               cast(year(date) as integer) as year, cast(month(date) as integer) as month,
               cast(day(date) as integer) as day, cast(quarter(date) as integer) as quarter,
               cast(weekofyear(date) as integer) as week_of_year, cast(isodow(date) - 1 as integer) as day_of_week,
               cast(day(date) as integer) as day_of_month, cast(isodow(date) - 1 >= 5 as integer) as is_weekend,
               cast(day(date) <= {FC.TEMPLATE_MONTH_START} as integer) as is_month_start,
               cast(day(date) >= {FC.TEMPLATE_MONTH_END} as integer) as is_month_end
        from look)"""
TPL_COLS = ["partner_code", "store_code", "date", "billings", "miles", "year", "month", "day", "quarter",
            "week_of_year", "day_of_week", "day_of_month", "is_weekend", "is_month_start", "is_month_end"]


@register("future_template", f"""with {TEMPLATE_SQL}
select {', '.join('round(billings, 4) as billings' if c == 'billings' else c for c in TPL_COLS)} from tpl""")
def q_future_template(spark, sf_dir):
    t = template(spark, sf_dir)
    return t.select(*[_r(c) if c == "billings" else c for c in TPL_COLS])


@register("future_extras", f"""with {TEMPLATE_SQL}
select partner_code, store_code, date,
       cast({_u("'promo'", "cast(date as varchar)", SKEY)} < {FC.PROMO_RATE} as integer) as promocion_activa,
       round(miles * ({FC.JITTER_LOW} + {_u("'jitter'", "'miles'", "cast(date as varchar)", SKEY)}
                      * {FC.JITTER_HIGH - FC.JITTER_LOW}), 4) as miles
from tpl""")
def q_future_extras(spark, sf_dir):
    t = FC.future_extras(template(spark, sf_dir), "promocion_activa", JITTER_COLS)
    return t.select(*KEY, "date", "promocion_activa", _r("miles"))


@register("history_plus_future", f"""with {STATS_SQL}, cal as ({_cal_sql(HORIZON_DAYS)} from st)
select partner_code, store_code, date, billings, false as is_future from sales
union all
select partner_code, store_code, date, cast(null as double) as billings, true as is_future from cal""")
def q_history_plus_future(spark, sf_dir):
    st = stats(spark, sf_dir).withColumn("start_date", F.date_add("last_date", 1))
    fut = FC.store_calendar(st, HORIZON_DAYS).select(*KEY, "date", F.lit(True).alias("is_future"))
    hist = history(spark, sf_dir).select(*KEY, "date", "billings", F.lit(False).alias("is_future"))
    return FC.history_plus_future(hist, fut).select(*KEY, "date", "billings", "is_future")


@register("weekday_baseline", f"""with {BASE_SQL}
select partner_code, store_code, date, round(predicted_billings, 4) as predicted_billings,
       round(variation_pct, 4) as variation_pct from fc""")
def q_weekday_baseline(spark, sf_dir):
    b = FC.weekday_baseline(stats(spark, sf_dir), HORIZON_DAYS)
    return b.select(*KEY, "date", _r("predicted_billings"), _r("variation_pct"))


@register("confidence_band", f"""with {BASE_SQL}
select partner_code, store_code, date, round(predicted_billings, 4) as predicted_billings,
       round(confidence_lower, 4) as confidence_lower, round(confidence_upper, 4) as confidence_upper from fc""")
def q_confidence_band(spark, sf_dir):
    return baseline(spark, sf_dir).select(*KEY, "date", _r("predicted_billings"), _r("confidence_lower"),
                                          _r("confidence_upper"))


@register("forecast_summary", f"""with {BASE_SQL}
select partner_code, store_code, round(sum(predicted_billings), 4) as total_forecast,
       round(avg(predicted_billings), 4) as avg_daily_forecast, round(any_value(hist_mean), 4) as avg_historical,
       round(case when any_value(hist_mean) > 0
                  then (avg(predicted_billings) - any_value(hist_mean)) / any_value(hist_mean) * 100 else 0.0 end, 4)
         as trend_vs_historical_pct,
       {HORIZON_DAYS} as forecast_period_days, cast({FC.CONFIDENCE_LEVEL} as double) as confidence_level
from fc group by 1, 2""")
def q_forecast_summary(spark, sf_dir):
    s = FC.forecast_summary(baseline(spark, sf_dir), HORIZON_DAYS)
    return s.select(*KEY, _r("total_forecast"), _r("avg_daily_forecast"), _r("avg_historical"),
                    _r("trend_vs_historical_pct"), "forecast_period_days", "confidence_level")


@register("forecast_status", f"""with {STATUS_SQL}
select partner_code, store_code, status, quality, test_r2, test_smape, features_used from stat""")
def q_forecast_status(spark, sf_dir):
    return status(spark, sf_dir).select(*KEY, "status", "quality", "test_r2", "test_smape",
                                       "features_used")


@register("model_lookup", f"""with {STATUS_SQL}
select req.partner_code, req.store_code, res.partner_code is not null as has_model,
       case when res.partner_code is not null then 'models/store_' || req.partner_code || '_' || req.store_code end
         as model_file
from req left join res on req.partner_code = res.partner_code and req.store_code = res.store_code""")
def q_model_lookup(spark, sf_dir):
    reg = registry(spark, sf_dir).select(*KEY, "model_file", F.lit(True).alias("_m"))
    out = requested_stores(spark, sf_dir).join(reg, KEY, "left")
    return out.select(*KEY, F.col("_m").isNotNull().alias("has_model"), "model_file")


@register("bulk_forecast", f"with {BULK_SQL}\nselect * from bulk")
def q_bulk_forecast(spark, sf_dir):
    return bulk(spark, sf_dir)


@register("union_results", f"""with {BULK_SQL}
select date, predicted_billings, partner_code, store_code, 'success' as status from bulk
union all
select cast(null as date) as date, cast(null as double) as predicted_billings, partner_code, store_code, status
from stat where status <> 'success'""")
def q_union_results(spark, sf_dir):
    ok = bulk(spark, sf_dir).select("date", "predicted_billings", *KEY, F.lit("success").alias("status"))
    failed = status(spark, sf_dir).filter(F.col("status") != "success").select(*KEY, "status")
    return ok.unionByName(failed, allowMissingColumns=True).select(
        "date", "predicted_billings", *KEY, "status")


@register("bulk_summary", f"""with {BULK_SQL}
select count(*) as total_stores, count(*) filter (where status = 'success') as successful,
       100.0 * count(*) filter (where status = 'success') / count(*) as success_rate_pct,
       (select round(sum(predicted_billings), 4) from bulk) as total_forecast,
       (select round(avg(predicted_billings), 4) from bulk) as avg_daily
from stat""")
def q_bulk_summary(spark, sf_dir):
    s = FC.bulk_summary(status(spark, sf_dir), bulk(spark, sf_dir))
    return s.select("total_stores", "successful", "success_rate_pct", _r("total_forecast"), _r("avg_daily"))


@register("forecast_totals", f"""with {BASE_SQL}
select partner_code || '_' || store_code as store_key, date, round(sum(predicted_billings), 4) as total
from fc group by rollup (partner_code || '_' || store_code, date)""")
def q_forecast_totals(spark, sf_dir):
    return FC.forecast_totals(baseline(spark, sf_dir)).select("store_key", "date", _r("total"))


@register("forecast_range", f"""with {BASE_SQL}
select partner_code, store_code, round(sum(predicted_billings), 4) as total, round(avg(predicted_billings), 4) as mean,
       round(min(predicted_billings), 4) as min, round(max(predicted_billings), 4) as max,
       round((avg(predicted_billings) - any_value(hist_mean)) / (case when any_value(hist_mean) <> 0
             then any_value(hist_mean) end) * 100, 4) as vs_historical_pct
from fc group by 1, 2""")
def q_forecast_range(spark, sf_dir):
    r = FC.forecast_range(baseline(spark, sf_dir))
    return r.select(*KEY, _r("total"), _r("mean"), _r("min"), _r("max"), _r("vs_historical_pct"))


@register("weekend_vs_workday", f"""with {BASE_SQL}
select * from (select partner_code, store_code,
                      round(avg(case when isodow(date) - 1 < 5 then predicted_billings end), 4) as workday_avg,
                      round(avg(case when isodow(date) - 1 >= 5 then predicted_billings end), 4) as weekend_avg
               from fc group by 1, 2) where workday_avg is not null and weekend_avg is not null""")
def q_weekend_vs_workday(spark, sf_dir):
    w = FC.weekend_vs_workday(baseline(spark, sf_dir))
    return w.select(*KEY, _r("workday_avg"), _r("weekend_avg"))


@register("feature_variability", f"""with {TEMPLATE_SQL}
select partner_code, store_code,
       round({' + '.join(f'coalesce(stddev_samp({c}), 0.0)' for c in TEMPLATE_NUMERIC)}, 4) as variability
from tpl group by 1, 2""")
def q_feature_variability(spark, sf_dir):
    v = FC.feature_variability(template(spark, sf_dir), TEMPLATE_NUMERIC)
    return v.select(*KEY, _r("variability"))


@register("sink_forecast_csv", f"""with {BULK_SQL}
select count(*) as rows, count(distinct (partner_code, store_code)) as stores, min(date) as min_date,
       max(date) as max_date from bulk""")
def q_sink_forecast_csv(spark, sf_dir):
    path = scratch_path(spark, "forecast-csv")
    C.write_csv(bulk(spark, sf_dir), path)
    back = spark.read.option("header", True).csv(path).withColumn("date", F.to_date("date"))
    return C.csv_report(back, KEY, "date")


@register("available_stores", f"""with {RESULTS_CTE}
select partner_code, store_code, round(test_mae, 6) as mae, round(test_rmse, 6) as rmse from res""")
def q_available_stores(spark, sf_dir):
    return registry(spark, sf_dir).select(*KEY, "mae", "rmse")
