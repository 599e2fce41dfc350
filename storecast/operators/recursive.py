"""Recursive horizon (M9, J4): every forecast day becomes history for the next one.

The state is a written table of each store's last ``keep`` targets, whatever the length of
its history; ``FE.LOOKBACK`` + 1 are all that a feature of the next day can see.  It has one
row a store with the targets as an array, the latest first, so a step needs no window: it
computes the features of every store's last row (the same columns as in training), adds
the next day's calendar columns, asks the predictor for all stores at once, and writes the
next state: the new target in, the oldest out.  A step's cost depends on the number of
stores only, and a lost executor costs tasks of one step.

Edge cases: a store without a complete feature row has no prediction (the predictor gives
none for it); its day is appended with a null target and its later days have none either.
An empty history gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storecast.operators import features as FE
from storecast.session import write_table
from storecast.sources.tables import STORE_KEY, TIE_BREAK

STEP = "_step"
VALUES, AHEAD = "_values", "_ahead"     # the last targets and the predictions so far, the latest first
TIED = "_tied"                          # rows that agree with the last one in date and tie-breaks, itself included


def horizon_state(history: DataFrame, extra: Sequence[str] = (), y: str = "billings", keep: int = FE.LOOKBACK + 1) -> DataFrame:
    """Each store's last ``keep`` rows: key, date, tie-breaks, target, ``extra``; written."""
    last = Window.partitionBy(*STORE_KEY).orderBy(*[F.col(c).desc() for c in ("date", *TIE_BREAK)])
    rows = history.select(*STORE_KEY, "date", *TIE_BREAK, F.col(y).cast("double").alias(y), *extra)
    return write_table(rows.withColumn("_r", F.row_number().over(last)).where(F.col("_r") <= keep).drop("_r")
                       .withColumn(STEP, F.lit(0)), "horizon-state")


def store_series(rows: DataFrame, extra: Sequence[str] = (), y: str = "billings") -> DataFrame:
    """A row per store of a bounded ``horizon_state``: the last row's date and ``extra``, ``VALUES`` and ``TIED``."""
    place = [F.col(c) for c in ("date", *TIE_BREAK)]
    in_order = F.sort_array(F.collect_list(F.struct(*place, F.col(y).alias("_y"), *[F.col(c).alias(f"_x_{c}") for c in extra])),
                            asc=False)
    s = rows.groupBy(*STORE_KEY).agg(in_order.alias("_rows"))
    last = F.col("_rows")[0]
    tied = F.size(F.filter("_rows", lambda r: reduce(lambda a, b: a & b, [
        r[c].eqNullSafe(last[c]) for c in ("date", *TIE_BREAK)])))
    return s.select(*STORE_KEY, last["date"].alias("date"), F.col("_rows")["_y"].alias(VALUES), tied.alias(TIED),
                    *[last[f"_x_{c}"].alias(c) for c in extra])


def next_day(state: DataFrame, families: Sequence[str], extra: Sequence[str] = (), y: str = "billings") -> DataFrame:
    """The day after each store's last row: its calendar columns, and the features and
    ``extra`` columns as of that last row (what ``shift=1`` gives in training); of tied last rows
    the first one counts."""
    series = state if VALUES in state.columns else store_series(state, extra, y)
    series = series.withColumn(VALUES, F.slice(VALUES, F.col(TIED), F.size(VALUES)))
    return FE.calendar_features(FE.last_features(series, VALUES, families, y).select(
        *STORE_KEY, F.date_add("date", 1).alias("date"), *extra, *FE.feature_names(families, y)))


def recursive_forecast(history: DataFrame, days: int, predict: Callable[[DataFrame], DataFrame], families: Sequence[str],
                       extra: Sequence[str] = (), y: str = "billings", keep: int = FE.LOOKBACK + 1) -> DataFrame:
    """(store, date, step, prediction) of ``days`` days after each store's last row.

    ``predict`` gets one row a store (key, date, calendar and series features, ``extra``) and
    returns (key, date, prediction) for the stores it knows, on the scale of ``y``."""
    if keep < FE.LOOKBACK + 1:
        raise ValueError(f"the features of a day look back {FE.LOOKBACK + 1} rows")
    key = list(STORE_KEY)
    state = write_table(store_series(horizon_state(history, extra, y, keep), extra, y).withColumn(
        AHEAD, F.array().cast("array<double>")), "horizon-series")
    for _ in range(days):
        # written: predictors plan over the features' columns, not their expressions
        ahead = write_table(next_day(state, families, extra, y), "horizon-day")
        value = predict(ahead).select(*key, F.col("prediction").cast("double").alias("_new"))
        state = write_table(state.join(value, key, "left").select(
            *key, F.date_add("date", 1).alias("date"), F.slice(F.concat(F.array("_new"), VALUES), 1, keep).alias(VALUES),
            F.lit(1).alias(TIED), *extra,
            F.concat(F.array("_new"), AHEAD).alias(AHEAD)), "horizon-series")
    return state.select(*key, F.col("date").alias("_last"), F.posexplode(AHEAD).alias("_back", "prediction")).where(
        F.col("prediction").isNotNull()).select(*key, F.date_sub("_last", F.col("_back")).alias("date"),
                                                (F.lit(days) - F.col("_back")).alias("step"), "prediction")


def line_predictor(train: DataFrame, feature: str, y: str = "billings") -> Callable[[DataFrame], DataFrame]:
    """A least-squares line on one feature per store, fitted once on ``train`` and written."""
    key = list(STORE_KEY)
    lines = write_table(train.groupBy(*key).agg(F.regr_slope(y, feature).alias("_slope"),
                                                F.regr_intercept(y, feature).alias("_cut")), "horizon-lines")

    def predict(rows: DataFrame) -> DataFrame:
        return rows.join(lines, key).select(*key, "date", (F.col("_cut") + F.col("_slope") * F.col(feature)).alias("prediction"))
    return predict
