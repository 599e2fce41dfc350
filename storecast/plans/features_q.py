"""Registered feature and transform queries.

The model input is the sales view with the pipeline's target transform:
``billings`` becomes log1p(max(billings, 0.1)) (T4 clamp, then T3).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from storecast.functions.exprs import fixed, fixed_sql
from storecast.operators import features as FE
from storecast.plans.catalog import register
from storecast.session import write_table
from storecast.sources.tables import sales

ROW_KEY = ["partner_code", "store_code", "date", "l_orderkey", "l_linenumber", "l_partkey"]
FEATURE_DIGITS = 6

# the reference's 31 computed model features (W1 subset, miles, W2-W9)
REFERENCE_FEATURES = (
    ["year", "month", "day", "dayofweek", "quarter", "week_of_year", "is_weekend",
     "is_month_start", "is_month_end", "miles"]
    + [f"billings_trend_{n}" for n in FE.TREND_WINDOWS]
    + [f"billings_volatility_{n}" for n in (7, 30)]
    + [n for k in FE.MOMENTUM_LAGS for n in (f"billings_momentum_{k}", f"billings_momentum_pct_{k}")]
    + [f"billings_rank_{n}" for n in FE.RANK_WINDOWS]
    + [f"billings_autocorr_{k}" for k in FE.AUTOCORR_LAGS]
    + [n for w in FE.ZSCORE_WINDOWS for n in (f"billings_zscore_{w}", f"billings_is_outlier_{w}")])

# the 53 declared numeric features (improved list minus ids, date and target)
DECLARED_FEATURES = (
    ["miles", "year", "month", "day", "dayofweek", "quarter", "week_of_year", "is_weekend",
     "is_month_start", "is_month_end"]
    + [f"billings_lag_{k}" for k in FE.LAGS]
    + [f"billings_rolling_{n}_{s}" for n in FE.ROLLING_WINDOWS for s in ("mean", "std", "min", "max")]
    + [f"billings_trend_{n}" for n in FE.TREND_WINDOWS]
    + [f"billings_volatility_{n}" for n in (7, 30)]
    + [n for k in FE.MOMENTUM_LAGS for n in (f"billings_momentum_{k}", f"billings_momentum_pct_{k}")]
    + [f"billings_rank_{n}" for n in FE.RANK_WINDOWS]
    + [f"billings_autocorr_{k}" for k in FE.AUTOCORR_LAGS]
    + [n for w in FE.ZSCORE_WINDOWS for n in (f"billings_zscore_{w}", f"billings_is_outlier_{w}")])

# the compact list of 42: nine calendar columns, and every feature but the rolling
# statistics other than mean and std over 7 and 30 rows
COMPACT_FEATURES = (
    ["year", "month", "day_of_week", "day_of_month", "quarter", "week_of_year", "is_weekend", "is_month_start",
     "is_month_end"]
    + [n for n in FE.feature_names(FE.FAMILIES) if "_rolling_" not in n
       or n in [f"billings_rolling_{w}_{s}" for w in (7, 30) for s in ("mean", "std")]])

MODEL_INPUT_SQL = (
    "(select partner_code, store_code, date, l_orderkey, l_linenumber, l_partkey, miles, "
    "greatest(billings, 0.1) as billings_original, ln(1 + greatest(billings, 0.1)) as billings_log, "
    "ln(1 + greatest(billings, 0.1)) as billings from sales) src")


def model_input(spark, sf_dir, dealt=False, parts=None):
    """The sales with their target columns.  ``dealt``: rows are dealt by store before these are
    added, so the shuffle that every window by store needs carries the raw columns only; ``parts``
    is a fixed number of tasks (default: by bytes)."""
    x = raw_input(spark, sf_dir)
    if dealt:
        x = x.repartition(*([parts] if parts else []), "partner_code", "store_code")
    return with_target(x)


def raw_input(spark, sf_dir):
    return sales(spark, sf_dir).select(*ROW_KEY, "miles", "billings")


def with_target(x):
    return FE.log_target(FE.target_transform(x, "billings"), "billings")


def _round(cols, digits=FEATURE_DIGITS):
    return [fixed(c, digits).alias(c) for c in cols]


def _rsql(name, digits=FEATURE_DIGITS):
    return f"{fixed_sql(name, digits)} as {name}"


def _family_query(families, keep=None):
    names = [n for n in FE.feature_names(families) if keep is None or keep(n)]

    def q(spark, sf_dir):
        f = FE.series_features(model_input(spark, sf_dir), "billings", families)
        return f.select(*ROW_KEY, *_round(["billings"]), *_round(names))

    def sql():
        body = FE.series_features_sql(MODEL_INPUT_SQL, "billings", families, digits=None,
                                      select_cols=ROW_KEY + ["billings"])
        cols = ", ".join(ROW_KEY + [_rsql("billings")] + [_rsql(n) for n in names])
        return f"select {cols} from ({body}) f"
    return q, sql()


for _key, _fams, _keep in (
        ("feat_trend", ["trend"], None),
        ("feat_volatility", ["volatility"], None),
        ("feat_momentum", ["momentum"], None),
        ("feat_momentum_pct", ["momentum_pct"], None),
        ("feat_rank", ["rank"], None),
        ("feat_autocorr", ["autocorr"], None),
        ("feat_zscore", ["zscore"], None),
        ("feat_is_outlier", ["zscore", "is_outlier"], lambda n: "_is_outlier_" in n),
        ("feat_lags", ["lags"], None),
        ("feat_rolling_stats", ["rolling"], None)):
    _q, _sql = _family_query(_fams, _keep)
    register(_key, _sql)(_q)


@register("feat_calendar", f"select {', '.join(ROW_KEY)}, {FE.calendar_sql('date')} from sales")
def q_feat_calendar(spark, sf_dir):
    return FE.calendar_features(sales(spark, sf_dir).select(*ROW_KEY))


def input_hot_keys(x):
    """Hot stores of the model input, computed once and passed down."""
    from storecast.operators.series import DEFAULT_CHUNK_ROWS, hot_keys
    return hot_keys(x, ["partner_code", "store_code"], "date", DEFAULT_CHUNK_ROWS)


def dealt_input(spark, sf_dir, parts=None):
    """(model input, hot stores).  Without hot stores the rows are dealt by store already; hot
    ones must be cut into chunks before they are dealt."""
    x = model_input(spark, sf_dir)
    hot = input_hot_keys(x)
    return (model_input(spark, sf_dir, True, parts) if hot is None else x), hot


def feature_table(spark, sf_dir, families=FE.FAMILIES, with_hot=False):
    """Model input + calendar + all rolling features, per store."""
    x, hot = dealt_input(spark, sf_dir)
    f = FE.series_features(FE.calendar_features(x), "billings", families, hot=hot)
    return (f, hot) if with_hot else f


ALL_NAMES = FE.feature_names(FE.FAMILIES)
FEAT_ALL_SQL = (
    f"select {', '.join(ROW_KEY)}, {_rsql('billings')}, "
    f"{_rsql('billings_original', 4)}, miles, "
    + ", ".join(FE.CALENDAR) + ", "
    + ", ".join(_rsql(n) for n in ALL_NAMES)
    + " from ("
    + FE.series_features_sql(f"(select *, {FE.calendar_sql('date')} from {MODEL_INPUT_SQL}) c",
                             "billings", FE.FAMILIES, digits=None, select_cols=["*"])
    + ") f")


@register("feat_all", FEAT_ALL_SQL)
def q_feat_all(spark, sf_dir):
    f = feature_table(spark, sf_dir)
    return f.select(*ROW_KEY, *_round(["billings"]), *_round(["billings_original"], 4), "miles",
                    *FE.CALENDAR, *_round(ALL_NAMES))


FEATURE_LISTS = {"declared_53": DECLARED_FEATURES, "compact_42": COMPACT_FEATURES}
_LISTED = list(dict.fromkeys(DECLARED_FEATURES + COMPACT_FEATURES))
_FL_SQL = (
    "with f as (" + FE.series_features_sql(
        f"(select *, {FE.calendar_sql('date')} from {MODEL_INPUT_SQL}) c", "billings",
        FE.FAMILIES, digits=None, select_cols=["*"]) + "), "
    "c as (select " + ", ".join(f"count({n}) as {n}" for n in _LISTED) + " from f) "
    + " union all ".join(
        f"select '{name}' as list, {i + 1} as position, '{n}' as feature, {n} as non_null from c"
        for name, names in FEATURE_LISTS.items() for i, n in enumerate(names)))


@register("feature_lists", _FL_SQL)
def q_feature_lists(spark, sf_dir):
    """Both named feature lists, with each feature's non-null count in
    the feature table (one aggregation pass)."""
    wide = feature_table(spark, sf_dir).agg(*[F.count(n).alias(n) for n in _LISTED])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("list"), F.lit(i + 1).alias("position"), F.lit(n).alias("feature"),
                 F.col(n).alias("non_null")) for name, names in FEATURE_LISTS.items() for i, n in enumerate(names)])))


# ------------------------------------------------------------------ T1-T8

IQR_FACTOR = 2.0
FIT_CUTOFF = "2000-01-01"   # T2: bounds fitted on history before this date


def _iqr_sql(fit_where: str = "true") -> str:
    return (f"with q as (select quantile_cont(billings, 0.25) as q1, quantile_cont(billings, 0.75) as q3 "
            f"from sales where {fit_where}) "
            f"select {', '.join(ROW_KEY)}, billings from sales, q "
            f"where billings between q1 - {IQR_FACTOR} * (q3 - q1) and q3 + {IQR_FACTOR} * (q3 - q1)")


@register("iqr_filter", _iqr_sql())
def q_iqr_filter(spark, sf_dir):
    s = sales(spark, sf_dir).select(*ROW_KEY, "billings")
    return FE.iqr_filter(s, "billings", IQR_FACTOR)


@register("iqr_fit_transform", _iqr_sql(f"date < date '{FIT_CUTOFF}'"))
def q_iqr_fit_transform(spark, sf_dir):
    from storecast.operators.pipeline import IQROutlierRemover
    s = sales(spark, sf_dir).select(*ROW_KEY, "billings")
    model = IQROutlierRemover(target="billings", factor=IQR_FACTOR).fit(
        s.filter(F.col("date") < F.lit(FIT_CUTOFF).cast("date")))
    return model.transform(s)


@register("log_target", f"""
select {', '.join(ROW_KEY)}, round(billings, 4) as billings_original,
       round(ln(1 + greatest(billings, 0)), 6) as billings from sales""")
def q_log_target(spark, sf_dir):
    s = FE.log_target(sales(spark, sf_dir).select(*ROW_KEY, "billings"))
    return s.select(*ROW_KEY, F.round("billings_original", 4).alias("billings_original"),
                    F.round("billings", 6).alias("billings"))


@register("target_transformer", f"""
select {', '.join(ROW_KEY)}, round(greatest(billings, 0.1), 4) as billings,
       round(ln(1 + greatest(billings, 0.1)), 6) as billings_log,
       round(sqrt(greatest(billings, 0)), 6) as billings_sqrt from sales""")
def q_target_transformer(spark, sf_dir):
    s = sales(spark, sf_dir).select(*ROW_KEY, "billings")
    s = FE.target_transform(s, "billings", "sqrt")
    s = FE.target_transform(s, "billings", "log_plus_one")
    return s.select(*ROW_KEY, F.round("billings", 4).alias("billings"),
                    F.round("billings_log", 6).alias("billings_log"),
                    F.round("billings_sqrt", 6).alias("billings_sqrt"))


@register("inverse_target", f"""
select {', '.join(ROW_KEY)}, round(exp(ln(1 + greatest(billings, 0.1))) - 1, 4) as billings_from_log,
       round(pow(sqrt(greatest(billings, 0)), 2), 4) as billings_from_sqrt from sales""")
def q_inverse_target(spark, sf_dir):
    s = sales(spark, sf_dir).select(*ROW_KEY, "billings")
    s = FE.target_transform(FE.target_transform(s, "billings", "sqrt"), "billings", "log_plus_one")
    return s.select(*ROW_KEY,
                    F.round(FE.inverse_target("billings_log", "log_plus_one"), 4).alias("billings_from_log"),
                    F.round(FE.inverse_target("billings_sqrt", "sqrt"), 4).alias("billings_from_sqrt"))


IMPUTE_COLS = [f"billings_trend_{n}" for n in FE.TREND_WINDOWS] + \
    [f"billings_autocorr_{k}" for k in FE.AUTOCORR_LAGS] + ["billings_rank_30"]


@register("median_impute", (
    "with f as (" + FE.series_features_sql(MODEL_INPUT_SQL, "billings", FE.FAMILIES, digits=None,
                                           select_cols=["*"]) + "), "
    "m as (select " + ", ".join(f"quantile_cont({c}, 0.5) as m_{c}" for c in IMPUTE_COLS) + " from f) "
    f"select {', '.join(ROW_KEY)}, "
    + ", ".join(f"{fixed_sql(f'coalesce({c}, coalesce(m_{c}, 0))', 6)} as {c}" for c in IMPUTE_COLS)
    + " from f, m"))
def q_median_impute(spark, sf_dir):
    x = model_input(spark, sf_dir)
    f = FE.series_features(x, "billings", FE.FAMILIES, hot=input_hot_keys(x))
    # the medians take several scans: over a written table, not the windows again
    f = write_table(f.select(*ROW_KEY, *IMPUTE_COLS), "impute-features")
    out = FE.median_impute(f, IMPUTE_COLS)
    return out.select(*ROW_KEY, *_round(IMPUTE_COLS))


FILL_COLS = [c for c in REFERENCE_FEATURES if c.startswith("billings_")]


@register("bfill_ffill_zero", (
    "with f as (" + FE.series_features_sql(MODEL_INPUT_SQL, "billings", FE.FAMILIES, digits=None,
                                           select_cols=["*"]) + ") "
    f"select {', '.join(ROW_KEY)}, "
    + ", ".join(f"{fixed_sql(e.rsplit(' as ', 1)[0], 6)} as {c}"
                for e, c in zip(FE.bfill_ffill_sql(FILL_COLS), FILL_COLS))
    + " from f"))
def q_bfill_ffill_zero(spark, sf_dir):
    x = model_input(spark, sf_dir)
    hot = input_hot_keys(x)
    f = FE.series_features(x, "billings", FE.FAMILIES, hot=hot)
    out = FE.bfill_ffill_zero(f.select(*ROW_KEY, *FILL_COLS), FILL_COLS, hot=hot)
    return out.select(*ROW_KEY, *_round(FILL_COLS))


def _pipeline_sql() -> str:
    fenced = (f"(select s.* from sales s, (select quantile_cont(billings, 0.25) as q1, "
              f"quantile_cont(billings, 0.75) as q3 from sales) q "
              f"where s.billings between q1 - {IQR_FACTOR} * (q3 - q1) and q3 + {IQR_FACTOR} * (q3 - q1))")
    src = MODEL_INPUT_SQL.replace("from sales) src", f"from {fenced} fs) src")
    feats = FE.series_features_sql(f"(select *, {FE.calendar_sql('date')} from {src}) c", "billings",
                                   FE.REFERENCE_FAMILIES, digits=None, select_cols=["*"])
    fills = dict(zip(FILL_COLS, FE.bfill_ffill_sql(FILL_COLS)))
    cols = [f"{fixed_sql(fills[c].rsplit(' as ', 1)[0], 6)} as {c}" if c in fills else c
            for c in REFERENCE_FEATURES]
    return (f"select {', '.join(ROW_KEY)}, {_rsql('billings')}, {', '.join(cols)} "
            f"from ({feats}) f")


@register("preprocess_pipeline", _pipeline_sql())
def q_preprocess_pipeline(spark, sf_dir):
    from storecast.operators.pipeline import preprocessing_pipeline
    s = sales(spark, sf_dir).select(*ROW_KEY, "miles", "billings")
    model = preprocessing_pipeline(families=FE.REFERENCE_FAMILIES, fill="bfill_ffill").fit(s)
    out = model.transform(s)
    return out.select(*ROW_KEY, *_round(["billings"]),
                      *[fixed(c, 6).alias(c) if c in FILL_COLS else F.col(c) for c in REFERENCE_FEATURES])
