"""Model evaluation over a predictions table (M1, M2, M4-M6, M17, M18,
A20-A24, A35).

Everything is a per-store aggregate (partial aggregation, one shuffle of
partial results) or a per-row expression; the per-store row numbering of the
temporal split uses the skew-safe ``series.positions``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storecast.functions.exprs import quality_label, smape_term
from storecast.operators.series import UNSET, positions
from storecast.sources.tables import STORE_KEY, TIE_BREAK

# Fixed values of the reference: split share, minimum rows per store, targets.
TRAIN_FRACTION = 0.8
MIN_STORE_ROWS = 50
TARGET_R2 = 0.8
TARGET_SMAPE = 10.0
ORDER = ("date",) + TIE_BREAK
METRIC_DIGITS = 6


def temporal_split(df: DataFrame, train_fraction: float = TRAIN_FRACTION,
                   min_rows: int = MIN_STORE_ROWS, key: Sequence[str] = STORE_KEY,
                   order: Sequence[str] = ORDER, chunk_rows: int | None = None,
                   hot=UNSET) -> DataFrame:
    """M1: first floor(f * n) rows of each store are 'train', the rest
    'test'; stores with fewer than ``min_rows`` rows are left out."""
    from storecast.operators.series import DEFAULT_CHUNK_ROWS
    p = positions(df, key, order, chunk_rows or DEFAULT_CHUNK_ROWS, hot=hot)
    split = F.when(F.col("_pos") <= F.floor(F.lit(train_fraction) * F.col("_cnt")), "train").otherwise("test")
    return p.filter(F.col("_cnt") >= min_rows).withColumn("split", split).drop("_pos", "_cnt")


def fit_scaler(df: DataFrame, features: Sequence[str], key: Sequence[str] = STORE_KEY,
               split_col: str = "split", fit_on: str = "train", hot=UNSET) -> DataFrame:
    """``df`` with the mean and *population* std of the store's train rows beside every row.
    ``hot`` None says that no store is hot: they are then taken over the store's rows where these
    lie, so rows that are dealt by store are read once and not dealt again.  Otherwise they are a
    per-store aggregate joined back (AQE splits a hot store's side of the join)."""
    of_train = F.col(split_col) == fit_on
    stats = {f"_{p}_{c}": f(F.when(of_train, F.col(c))) for c in features for p, f in (("m", F.avg), ("s", F.stddev_pop))}
    if hot is None:
        w = Window.partitionBy(*key)
        return df.withColumns({name: c.over(w) for name, c in stats.items()})
    return df.join(df.filter(of_train).groupBy(*key).agg(*[c.alias(name) for name, c in stats.items()]), list(key), "left")


def standard_scale(df: DataFrame, features: Sequence[str], key: Sequence[str] = STORE_KEY,
                   split_col: str = "split", fit_on: str = "train") -> DataFrame:
    """M2: per store, (x - mean) / std with mean and *population* std of the
    train rows; a zero std scales by 1.  ``df`` may have them already (``fit_scaler``)."""
    stats = [f"_{p}_{c}" for p in "ms" for c in features]
    out = df if {*stats} <= {*df.columns} else fit_scaler(df, features, key, split_col, fit_on)
    scaled = {c: (F.col(c) - F.col(f"_m_{c}")) /
              F.when(F.col(f"_s_{c}") == 0, F.lit(1.0)).otherwise(F.col(f"_s_{c}")) for c in features}
    return out.withColumns(scaled).drop(*stats)


def _metrics(y: Column, p: Column, cond: Column | None = None) -> dict[str, Column]:
    """MAE, RMSE, R2 (sklearn: constant y gives 1 or 0), SMAPE, n."""
    def w(e):
        return e if cond is None else F.when(cond, e)
    yy, pp = w(y), w(p)
    n = F.count(yy)
    sse = F.sum(F.pow(yy - pp, 2))
    sst = F.var_pop(yy) * n
    r2 = F.when(sst == 0, F.when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0))).otherwise(1 - sse / sst)
    return {"n": n, "mae": F.avg(F.abs(yy - pp)), "rmse": F.sqrt(F.avg(F.pow(yy - pp, 2))),
            "r2": r2, "smape": 100 * F.avg(smape_term(yy, pp))}


def model_results(pred: DataFrame, y: str = "billings", p: str = "prediction",
                  key: Sequence[str] = STORE_KEY, split_col: str = "split",
                  n_features: int | None = None) -> DataFrame:
    """M4-M6 per store: train/test MAE, RMSE, R2, SMAPE (log scale, the
    model's target) plus test metrics on the original scale (expm1), sample
    counts and the quality label of the test R2.  Metrics are not rounded:
    means over them would be rounded twice (see ``rounded``)."""
    aggs = []
    for s in ("train", "test"):
        cond = F.col(split_col) == s
        for name, e in _metrics(F.col(y), F.col(p), cond).items():
            aggs.append(e.cast("bigint").alias(f"{s}_samples") if name == "n" else e.alias(f"{s}_{name}"))
    for name, e in _metrics(F.expm1(y), F.expm1(p), F.col(split_col) == "test").items():
        if name != "n":
            aggs.append(e.alias(f"test_{name}_original"))
    out = pred.groupBy(*key).agg(*aggs).withColumn("quality", quality_label("test_r2"))
    if n_features is not None:
        out = out.withColumn("n_features", F.lit(n_features))
    return out


def rounded(df: DataFrame) -> DataFrame:
    """``df`` with its metric columns rounded for output."""
    def digits(c: str) -> int | None:
        if c.endswith("_original"):
            return 4
        metric = c.rpartition("_")[2] in ("mae", "rmse", "r2", "smape", "rate")
        return METRIC_DIGITS if metric else None

    return df.withColumns({c: F.round(c, digits(c)) for c in df.columns if digits(c) is not None})


def quality_distribution(results: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Models per label (and group ``by``), count and percent."""
    counts = results.groupBy(*by, "quality").agg(F.count(F.lit(1)).alias("models"))
    # at most one row per label and run: the total over the (tiny) table is safe
    total = F.sum("models").over(Window.partitionBy(*by))
    return counts.select(*by, "quality", "models",
                         F.round(100.0 * F.col("models") / total, METRIC_DIGITS).alias("pct"))


def training_summary(results: DataFrame, attempted: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A21, per group ``by``: attempted stores, successful models, success rate,
    mean / population std / best of test R2 and SMAPE (not rounded)."""
    r = results.groupBy(*by).agg(
        F.count(F.lit(1)).alias("successful_models"),
        F.avg("test_r2").alias("avg_r2"), F.stddev_pop("test_r2").alias("std_r2"), F.max("test_r2").alias("best_r2"),
        F.avg("test_smape").alias("avg_smape"), F.stddev_pop("test_smape").alias("std_smape"),
        F.min("test_smape").alias("best_smape"))
    total = attempted.agg(F.count(F.lit(1)).alias("total_stores_attempted"))
    return r.crossJoin(F.broadcast(total)).withColumn(      # one row
        "success_rate", F.when(F.col("total_stores_attempted") > 0,
                               100.0 * F.col("successful_models") / F.col("total_stores_attempted"))
        .otherwise(F.lit(0.0)))


def target_achievement(summary: DataFrame, target_r2: float = TARGET_R2,
                       target_smape: float = TARGET_SMAPE, by: Sequence[str] = ()) -> DataFrame:
    """1/0 flags for avg R2 >= target and avg SMAPE <= target."""
    return summary.select(
        *by, "avg_r2", "avg_smape",
        F.coalesce((F.col("avg_r2") >= target_r2).cast("int"), F.lit(0)).alias("r2_target_achieved"),
        F.coalesce((F.col("avg_smape") <= target_smape).cast("int"), F.lit(0)).alias("smape_target_achieved"))


def good_plus_share(results: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """EXCELENTE and EXCELENTE+BUENO counts and percent of models."""
    exc = F.count_if(F.col("quality") == "EXCELENTE")
    good = F.count_if(F.col("quality").isin("EXCELENTE", "BUENO"))
    n = F.count(F.lit(1))
    return results.groupBy(*by).agg(exc.alias("excellent_models"), good.alias("good_plus_models"),
                                    F.round(100.0 * exc / n, METRIC_DIGITS).alias("excellent_pct"),
                                    F.round(100.0 * good / n, METRIC_DIGITS).alias("good_plus_pct"))


def top_stores(results: DataFrame, k: int = 5, metric: str = "test_r2") -> DataFrame:
    """Top-k stores by a metric (one value per store), numbered."""
    per_store = results.select(F.concat_ws("_", *STORE_KEY).alias("store_key"), metric)
    top = per_store.groupBy("store_key").agg(F.max(metric).alias(metric)).orderBy(
        F.desc(metric), "store_key").limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(metric), "store_key")))


def trained_listing(results: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` trained stores with R2, SMAPE and label."""
    return (results.select(F.concat_ws("_", *STORE_KEY).alias("store_key"), "test_r2", "test_smape",
                           "quality").orderBy("store_key").limit(n))


def backtest_recent(df: DataFrame, actual: Column, predicted: Column, n: int = 5,
                    key: Sequence[str] = STORE_KEY) -> DataFrame:
    """Last ``n`` rows per store: actual, predicted, error, error
    percent (null when the actual is 0)."""
    w = Window.partitionBy(*key).orderBy(*[F.col(c).desc() for c in ORDER])
    last = df.withColumns({"actual": actual, "predicted": predicted}).withColumn(
        "_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")
    err = F.col("actual") - F.col("predicted")
    return last.withColumns({"error": err,
                             "error_pct": err / F.when(F.col("actual") != 0, F.col("actual")) * 100})


def backtest_metrics(bt: DataFrame, key: Sequence[str] = STORE_KEY) -> DataFrame:
    """MAE, RMSE, MAPE per store over the backtest rows."""
    return bt.groupBy(*key).agg(
        F.round(F.avg(F.abs("error")), 4).alias("mae"),
        F.round(F.sqrt(F.avg(F.pow("error", 2))), 4).alias("rmse"),
        F.round(F.avg(F.abs("error_pct")), 4).alias("mape"))
