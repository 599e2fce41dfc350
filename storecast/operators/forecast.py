"""Forecast building blocks (J2-J6, A17-A19, A25-A30, M10, M11, M13, M14,
M16).

All stores are handled in one plan: per-store statistics are aggregates, the
future calendar is a per-store ``explode(sequence(..))`` (no cross join),
and lookups are equi-joins on the store key.  Random draws are
deterministic: uniforms come from the md5 of (date, store, stream), so a
re-run (or a re-executed task) gives the same numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storecast.functions.exprs import md5_uniform, std_normal
from storecast.sources.tables import STORE_KEY, TIE_BREAK

# Fixed values of the reference: weekday multipliers of the baseline
# (Mon..Sun), its noise share, the template noise share, the band width, the
# promotion rate and the jitter range, and the template's month start/end days.
WEEKDAY_MULTIPLIERS = [1.0, 0.9, 0.9, 0.95, 1.1, 1.3, 1.2]
BASELINE_NOISE = 0.05
TEMPLATE_NOISE = 0.3
BAND_Z = 1.96
PROMO_RATE = 0.2
JITTER_LOW, JITTER_HIGH = 0.95, 1.05
TEMPLATE_MONTH_START, TEMPLATE_MONTH_END = 3, 28
CONFIDENCE_LEVEL = 95.0


def store_key_col():
    return F.concat_ws("_", *STORE_KEY)


def history_stats(df: DataFrame, y: str = "billings") -> DataFrame:
    """A18 + A19: per store mean, sample std, rows and last date."""
    return df.groupBy(*STORE_KEY).agg(
        F.avg(y).alias("hist_mean"), F.stddev_samp(y).alias("hist_std"),
        F.count(F.lit(1)).alias("hist_rows"), F.max("date").alias("last_date"))


def store_calendar(starts: DataFrame, days: int, start_col: str = "start_date") -> DataFrame:
    """One row per (store, day) for ``days`` days from ``start_col``."""
    return starts.withColumn("date", F.explode(F.sequence(
        F.col(start_col), F.date_add(F.col(start_col), days - 1))))


def weekday_profile(df: DataFrame, y: str = "billings") -> DataFrame:
    """Per store x weekday mean and sample std (a missing std is 0)."""
    return df.groupBy(*STORE_KEY, F.weekday("date").alias("weekday")).agg(
        F.avg(y).alias("wd_mean"), F.coalesce(F.stddev_samp(y), F.lit(0.0)).alias("wd_std"))


def weekday_lookup(calendar: DataFrame, profile: DataFrame, stats: DataFrame) -> DataFrame:
    """Weekday mean/std of each future day, falling back to the store's
    overall mean and std."""
    cal = calendar.withColumn("weekday", F.weekday("date"))
    return (cal.join(profile, list(STORE_KEY) + ["weekday"], "left")
            .join(stats.select(*STORE_KEY, "hist_mean", "hist_std"), list(STORE_KEY), "left")
            .withColumns({"day_mean": F.coalesce("wd_mean", "hist_mean"),
                          "day_std": F.coalesce(F.col("wd_std"), F.col("hist_std"))}))


def _noise(stream: str):
    key = store_key_col()
    return std_normal(md5_uniform(F.col("date"), key, F.lit(stream + "1")),
                      md5_uniform(F.col("date"), key, F.lit(stream + "2")))


def weekday_baseline(stats: DataFrame, days: int, noise: bool = True) -> DataFrame:
    """Historical mean x weekday multiplier + N(0, 0.05 std), clipped
    at 0, for ``days`` days after each store's last date; variation percent
    against the mean."""
    cal = store_calendar(stats.withColumn("start_date", F.date_add("last_date", 1)), days)
    mult = F.element_at(F.array(*[F.lit(m) for m in WEEKDAY_MULTIPLIERS]), F.weekday("date") + 1)
    eps = _noise("b") * F.lit(BASELINE_NOISE) * F.coalesce(F.col("hist_std"), F.lit(0.0)) if noise else F.lit(0.0)
    pred = F.greatest(F.lit(0.0), F.col("hist_mean") * mult + eps)
    return cal.withColumn("predicted_billings", pred).withColumn(
        "variation_pct", (F.col("predicted_billings") - F.col("hist_mean"))
        / F.when(F.col("hist_mean") != 0, F.col("hist_mean")) * 100)


def confidence_band(forecast: DataFrame, std_col: str = "hist_std", z: float = BAND_Z) -> DataFrame:
    """Prediction -/+ z * historical std; the lower bound is clipped at 0."""
    p, s = F.col("predicted_billings"), F.col(std_col)
    return forecast.withColumns({"confidence_lower": F.greatest(p - z * s, F.lit(0.0)),
                                 "confidence_upper": p + z * s})


def forecast_summary(forecast: DataFrame, days: int) -> DataFrame:
    """A25 per store: total, mean daily, historical mean, trend percent
    against it (0 when the mean is <= 0), days, confidence level."""
    g = forecast.groupBy(*STORE_KEY).agg(
        F.sum("predicted_billings").alias("total_forecast"),
        F.avg("predicted_billings").alias("avg_daily_forecast"),
        F.first("hist_mean").alias("avg_historical"))
    trend = F.when(F.col("avg_historical") > 0,
                   (F.col("avg_daily_forecast") - F.col("avg_historical")) / F.col("avg_historical") * 100
                   ).otherwise(F.lit(0.0))
    return g.withColumns({"trend_vs_historical_pct": trend, "forecast_period_days": F.lit(days),
                          "confidence_level": F.lit(CONFIDENCE_LEVEL)})


def forecast_status(requested: DataFrame, registry: DataFrame, history_stores: DataFrame,
                    horizon: DataFrame | None = None) -> DataFrame:
    """One status per requested store, the first that applies:
    ``model_not_found`` without a registry entry, ``model_load_error`` if its
    model is not saved (registry column ``model_saved``), ``no_data`` without
    history, ``no_features`` if ``horizon`` (store, n_features, n_predicted) has no
    feature value for it, ``prediction_error`` if it has no prediction, else
    ``success``; with the model's quality, test metrics and features used."""
    saved = F.col("model_saved") if "model_saved" in registry.columns else F.lit(True)
    used = F.col("n_features") if "n_features" in registry.columns else F.lit(None)
    reg = registry.select(*STORE_KEY, saved.alias("_saved"), "quality", "test_r2", "test_smape",
                          used.cast("int").alias("_used"))
    hist = history_stores.select(*STORE_KEY, F.lit(True).alias("_has_data"))
    out = (requested.select(*STORE_KEY).distinct()
           .join(reg, list(STORE_KEY), "left").join(hist, list(STORE_KEY), "left"))
    status = (F.when(F.col("_saved").isNull(), "model_not_found").when(~F.col("_saved"), "model_load_error")
              .when(F.col("_has_data").isNull(), "no_data"))
    if horizon is not None:
        out = out.join(horizon.select(*STORE_KEY, F.col("n_features").alias("_nf"), F.col("n_predicted").alias("_np")),
                       list(STORE_KEY), "left")
        status = (status.when(F.coalesce("_nf", F.lit(0)) == 0, "no_features")
                  .when(F.coalesce("_np", F.lit(0)) == 0, "prediction_error"))
    out = out.withColumn("status", status.otherwise("success"))
    return out.withColumn("features_used", F.when(F.col("status") == "success", F.col("_used"))).drop("_saved", "_has_data", "_used", "_nf", "_np")


def bulk_summary(status: DataFrame, forecast: DataFrame) -> DataFrame:
    """Stores, successes, success percent; total and mean forecast."""
    s = status.agg(F.count(F.lit(1)).alias("total_stores"),
                   F.count_if(F.col("status") == "success").alias("successful"))
    totals = forecast.agg(F.sum("predicted_billings").cast("double").alias("total_forecast"),
                          F.avg("predicted_billings").cast("double").alias("avg_daily"))
    return s.crossJoin(F.broadcast(totals)).select(      # one row each
        "*", (100.0 * F.col("successful") / F.col("total_stores")).alias("success_rate_pct")).select(
        "total_stores", "successful", "success_rate_pct", "total_forecast", "avg_daily")


def forecast_totals(forecast: DataFrame) -> DataFrame:
    """Per-store daily rows, store totals and the grand total at once
    (``rollup``: date null = store total, both null = grand total)."""
    return forecast.rollup(store_key_col().alias("store_key"), "date").agg(
        F.sum("predicted_billings").alias("total"))


def forecast_range(forecast: DataFrame) -> DataFrame:
    """A28 per store: total, mean, min, max, percent against history."""
    g = forecast.groupBy(*STORE_KEY).agg(
        F.sum("predicted_billings").alias("total"), F.avg("predicted_billings").alias("mean"),
        F.min("predicted_billings").alias("min"), F.max("predicted_billings").alias("max"),
        F.first("hist_mean").alias("hist_mean"))
    return g.withColumn("vs_historical_pct", (F.col("mean") - F.col("hist_mean"))
                        / F.when(F.col("hist_mean") != 0, F.col("hist_mean")) * 100)


def weekend_vs_workday(forecast: DataFrame) -> DataFrame:
    """Mean forecast on workdays and on Sat/Sun, for stores with both."""
    wknd = F.weekday("date") >= 5
    g = forecast.groupBy(*STORE_KEY).agg(
        F.avg(F.when(~wknd, F.col("predicted_billings"))).alias("workday_avg"),
        F.avg(F.when(wknd, F.col("predicted_billings"))).alias("weekend_avg"))
    return g.filter(F.col("workday_avg").isNotNull() & F.col("weekend_avg").isNotNull())


def last_rows(df: DataFrame, n: int = 1) -> DataFrame:
    w = Window.partitionBy(*STORE_KEY).orderBy(*[F.col(c).desc() for c in ("date",) + TIE_BREAK])
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def future_template(history: DataFrame, start_date, days: int, y: str = "billings",
                    month_start: int = TEMPLATE_MONTH_START, month_end: int = TEMPLATE_MONTH_END) -> DataFrame:
    """Each store's last row copied to every future day from
    ``start_date``; target drawn from N(weekday mean, 0.3 weekday std)
    (store mean/std when the weekday never occurred), clipped at 0; calendar
    columns reset for the new date."""
    stats = history_stats(history, y)
    profile = weekday_profile(history, y)
    last = last_rows(history, 1).drop("date")
    cal = store_calendar(last.withColumn("start_date", F.lit(start_date).cast("date")), days).drop("start_date")
    cal = weekday_lookup(cal, profile, stats)
    draw = F.col("day_mean") + _noise("t") * F.lit(TEMPLATE_NOISE) * F.col("day_std")
    d = F.col("date")
    dom = F.dayofmonth(d)
    out = cal.withColumns({
        y: F.greatest(F.lit(0.0), draw),
        "year": F.year(d), "month": F.month(d), "day": dom, "quarter": F.quarter(d),
        "week_of_year": F.weekofyear(d), "day_of_week": F.weekday(d), "day_of_month": dom,
        "is_weekend": (F.weekday(d) >= 5).cast("int"),
        "is_month_start": (dom <= month_start).cast("int"),
        "is_month_end": (dom >= month_end).cast("int")})
    return out.drop("wd_mean", "wd_std", "hist_mean", "hist_std", "day_mean", "day_std", "weekday")


def future_extras(template: DataFrame, promo_col: str | None = "promocion_activa",
                  jitter_cols: Sequence[str] = ()) -> DataFrame:
    """A 20 % promotion flag per (date, store) and a U(0.95, 1.05)
    factor on the listed numeric columns that exist."""
    key = store_key_col()
    out = template
    if promo_col:
        out = out.withColumn(promo_col, (md5_uniform(F.lit("promo"), F.col("date"), key)
                                         < PROMO_RATE).cast("int"))
    for c in jitter_cols:
        if c in out.columns:
            u = md5_uniform(F.lit("jitter"), F.lit(c), F.col("date"), key)
            out = out.withColumn(c, F.col(c) * (F.lit(JITTER_LOW) + u * F.lit(JITTER_HIGH - JITTER_LOW)))
    return out


def history_plus_future(history: DataFrame, future: DataFrame) -> DataFrame:
    """Future rows (target null) appended to the history by name."""
    return history.unionByName(future, allowMissingColumns=True)


def feature_variability(frame: DataFrame, features: Sequence[str]) -> DataFrame:
    """A30 per store: sum over features of their sample std (null std -> 0)."""
    parts = [F.coalesce(F.stddev_samp(c), F.lit(0.0)) for c in features]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return frame.groupBy(*STORE_KEY).agg(total.alias("variability"))
