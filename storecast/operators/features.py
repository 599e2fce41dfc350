"""Per-store time-series features (W1-W13) and target/cleaning transforms
(T1-T8).

Rolling features are row-based (``rolling(n)`` counts rows) over the store
series ordered by date plus a unique tie-break, and follow the rule that a
rolling value needs ``n`` non-null inputs (else null).  Every window shares
one partitioning and order, so the whole feature set plans as a single
exchange + sort followed by stacked Window operators.  The windows only fetch the
rows before (``lag``); rolling statistics are plain sums over those columns, since a
sliding frame of Spark starts its aggregates anew in every row.  Series are split for
hot stores by ``series.chunk_series`` (lookback 59 rows: a 30-row
correlation against a 30-row lag).

``_staged_columns`` has the Spark columns, ``_build_specs`` the names and the SQL
text of the DuckDB oracle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storecast.functions.exprs import ZERO_GUARD, keep_null
from storecast.functions.stats import column_quantiles, exact_quantiles
from storecast.operators.series import CHUNK, UNSET, chunk_series, home_rows
from storecast.session import write_table
from storecast.sources.tables import STORE_KEY, TIE_BREAK

# Fixed values of the reference: window sizes and lags of each feature family.
TREND_WINDOWS = [3, 7, 14, 30]
VOLATILITY_WINDOWS = [3, 7, 14, 30]
MOMENTUM_LAGS = [1, 3, 7]
RANK_WINDOWS = [7, 30]
AUTOCORR_LAGS = [7, 14, 30]
AUTOCORR_WINDOW = 30
ZSCORE_WINDOWS = [7, 30]
LAGS = [1, 2, 3, 7, 14, 30]
ROLLING_WINDOWS = [3, 7, 14, 30]
OUTLIER_Z = 2
MONTH_START_DAY, MONTH_END_DAY = 5, 25
LOOKBACK = AUTOCORR_WINDOW - 1 + max(AUTOCORR_LAGS)

CALENDAR = ["year", "month", "day", "dayofweek", "day_of_week", "day_of_month", "quarter",
            "week_of_year", "is_weekend", "is_month_start", "is_month_end"]


# ------------------------------------------------- the features' SQL (oracle)

@dataclass
class Ctx:
    """Names used while building SQL text."""
    y: str
    key: list[str]
    order: list[str]

    @property
    def sql_window(self) -> str:
        return f"partition by {', '.join(self.key)} order by {', '.join(self.order)}"


@dataclass
class Feature:
    name: str
    family: str
    sql: object            # Ctx -> str
    stage: int = 1         # 0: lag helpers, 1: window features, 2: derived from stage 1


def _ws(ctx: Ctx, n: int) -> str:
    return f"over ({ctx.sql_window} rows between {n - 1} preceding and current row)"


def _gate_sql(ctx, n, e: str) -> str:
    return f"case when count({ctx.y}) {_ws(ctx, n)} = {n} then {e} end"


def _guard_sql(e: str) -> str:
    return f"(case when ({e}) = 0 then {ZERO_GUARD} else ({e}) end)"


def _guard(c: Column) -> Column:
    return F.when(c == 0, F.lit(ZERO_GUARD)).otherwise(c)


def _build_specs(y_prefix: str) -> list[Feature]:
    p = y_prefix
    specs: list[Feature] = []
    add = specs.append
    # lag helpers (also the W10 lag features)
    for k in sorted(set(LAGS) | set(MOMENTUM_LAGS) | set(AUTOCORR_LAGS)):
        add(Feature(f"{p}_lag_{k}", "lags", lambda c, k=k: f"lag({c.y}, {k}) over ({c.sql_window})", stage=0))
    for n in TREND_WINDOWS:
        add(Feature(f"{p}_trend_{n}", "trend", lambda c, n=n: _gate_sql(c, n, f"{c.y} - avg({c.y}) {_ws(c, n)}")))
    for n in VOLATILITY_WINDOWS:
        add(Feature(f"{p}_volatility_{n}", "volatility",
                    lambda c, n=n: _gate_sql(c, n, f"stddev_samp({c.y}) {_ws(c, n)} / "
                                                   + _guard_sql(f"avg({c.y}) {_ws(c, n)}"))))
    for k in MOMENTUM_LAGS:
        add(Feature(f"{p}_momentum_{k}", "momentum", lambda c, k=k: f"{c.y} - {p}_lag_{k}"))
        add(Feature(f"{p}_momentum_pct_{k}", "momentum_pct",
                    lambda c, k=k: f"({c.y} - {p}_lag_{k}) / {_guard_sql(f'{p}_lag_{k}')} * 100"))
    for n in RANK_WINDOWS:
        def rank_sql(c, n=n):
            lst = f"list({c.y}) {_ws(c, n)}"
            return _gate_sql(c, n, f"(len(list_filter({lst}, lambda v: v < {c.y})) + "
                                   f"(len(list_filter({lst}, lambda v: v = {c.y})) + 1) / 2.0) / {n}")
        add(Feature(f"{p}_rank_{n}", "rank", rank_sql))
    for k in AUTOCORR_LAGS:
        def ac_sql(c, k=k, n=AUTOCORR_WINDOW):
            x = f"{p}_lag_{k}"
            ws = _ws(c, n)
            return (f"case when count(case when {c.y} is not null then {x} end) {ws} = {n} "
                    f"then covar_pop({c.y}, {x}) {ws} / nullif(stddev_pop({c.y}) {ws} * "
                    f"stddev_pop({x}) {ws}, 0) end")
        add(Feature(f"{p}_autocorr_{k}", "autocorr", ac_sql))
    for n in ZSCORE_WINDOWS:
        add(Feature(f"{p}_zscore_{n}", "zscore",
                    lambda c, n=n: _gate_sql(c, n, f"({c.y} - avg({c.y}) {_ws(c, n)}) / "
                                                   + _guard_sql(f"stddev_samp({c.y}) {_ws(c, n)}"))))
        add(Feature(f"{p}_is_outlier_{n}", "is_outlier",
                    lambda c, n=n: f"cast(coalesce(abs({p}_zscore_{n}) > {OUTLIER_Z}, false) as integer)", stage=2))
    for n in ROLLING_WINDOWS:
        for stat, fn in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max")):
            add(Feature(f"{p}_rolling_{n}_{stat}", "rolling",
                        lambda c, n=n, fn=fn: _gate_sql(c, n, f"{fn}({c.y}) {_ws(c, n)}")))
    return specs


FAMILIES = ["lags", "trend", "volatility", "momentum", "momentum_pct", "rank", "autocorr",
            "zscore", "is_outlier", "rolling"]
# families the reference actually computes (W2-W9); lags/rolling are declared
REFERENCE_FAMILIES = ["trend", "volatility", "momentum", "momentum_pct", "rank", "autocorr",
                      "zscore", "is_outlier"]


# --------------------------------------------------------------- W1 calendar

def calendar_features(df: DataFrame, date_col: str = "date",
                      month_start: int = MONTH_START_DAY, month_end: int = MONTH_END_DAY) -> DataFrame:
    d = F.col(date_col)
    dow = F.weekday(d)
    dom = F.dayofmonth(d)
    return df.withColumns({
        "year": F.year(d), "month": F.month(d), "day": dom, "dayofweek": dow,
        "day_of_week": dow, "day_of_month": dom, "quarter": F.quarter(d),
        "week_of_year": F.weekofyear(d),
        "is_weekend": (dow >= 5).cast("int"),
        "is_month_start": (dom <= month_start).cast("int"),
        "is_month_end": (dom >= month_end).cast("int")})


def calendar_sql(date_col: str = "date") -> str:
    d = date_col
    return (f"cast(year({d}) as integer) as year, cast(month({d}) as integer) as month, "
            f"cast(day({d}) as integer) as day, cast(isodow({d}) - 1 as integer) as dayofweek, "
            f"cast(isodow({d}) - 1 as integer) as day_of_week, cast(day({d}) as integer) as day_of_month, "
            f"cast(quarter({d}) as integer) as quarter, cast(weekofyear({d}) as integer) as week_of_year, "
            f"cast(isodow({d}) - 1 >= 5 as integer) as is_weekend, "
            f"cast(day({d}) <= {MONTH_START_DAY} as integer) as is_month_start, "
            f"cast(day({d}) >= {MONTH_END_DAY} as integer) as is_month_end")


# --------------------------------------------------------------- W2-W12

def feature_names(families: Sequence[str] = FAMILIES, y_prefix: str = "billings") -> list[str]:
    return [f.name for f in _build_specs(y_prefix) if f.family in families]


def series_features(df: DataFrame, y: str = "billings", families: Sequence[str] = FAMILIES,
                    key: Sequence[str] = STORE_KEY, order: Sequence[str] = ("date",) + TIE_BREAK,
                    y_prefix: str | None = None, chunk_rows: int | None = None,
                    hot_rows: int | None = None, hot=UNSET, shift: int = 0,
                    also_shift: Sequence[str] = (), chunked: bool = False) -> DataFrame:
    """Add the rolling/lag features of ``families`` on column ``y``.

    With ``shift`` = k every feature (and the columns of ``also_shift``) is that
    of k rows earlier, so it knows nothing of the row's own target (D5).
    Lag helper columns that are not requested are dropped again.  With
    ``chunk_rows`` set, hot stores are split (see ``series.chunk_series``);
    ``chunked`` rows are split already (see ``sources.clustered``).
    """
    from storecast.operators.series import DEFAULT_CHUNK_ROWS
    prefix = y_prefix or y
    base = df if chunked else chunk_series(df, key, order, LOOKBACK + shift,
                                           chunk_rows if chunk_rows is not None else DEFAULT_CHUNK_ROWS, hot_rows, hot)
    w = Window.partitionBy(*key, CHUNK).orderBy(*order)
    none = F.lit(0).cast(base.schema[y].dataType)
    stages, names = _staged_columns(
        lambda i: F.lag(y, i + shift).over(w) if i + shift else F.col(y), prefix, families,
        F.lag(F.lit(True), shift).over(w) if shift else None, lambda c, k: F.lag(c, k).over(w),
        lambda i: F.call_function("lag", F.col("_y"), F.lit(i + shift), none).over(w) if i + shift else F.col("_y"),
        lambda n: F.count(y).over(w.rowsBetween(Window.unboundedPreceding, -n - shift)))
    out = base.withColumns({"_y": F.coalesce(y, none)} | {f"_own_{c}": F.lag(c, shift).over(w) for c in also_shift if shift})
    for cols in stages:
        out = out.withColumns(cols)
    shifted = set(also_shift) if shift else set()
    kept = [F.col(f"_own_{c}").alias(c) if c in shifted else F.col(c) for c in base.columns if c not in names]
    return home_rows(out.select(*kept, *names))


def series_names(families: Sequence[str] = FAMILIES, y: str = "billings") -> list[str]:
    """The columns that ``series_features`` adds, in its order."""
    return _staged_columns(lambda i: F.lit(0), y, families)[1]


def derived(families: Sequence[str] = FAMILIES, y: str = "billings") -> list[dict[str, Column]]:
    """The features that follow from the target and other features of their row, by the steps of
    ``_staged_columns`` (unshifted), in two stages: the second reads the first."""
    fam, p, one, two = set(families), y, {}, {}

    def rolled(n: int, stat: str) -> Column:
        return F.col(f"{p}_rolling_{n}_{stat}")
    if "lags" in fam:
        for k in MOMENTUM_LAGS:
            lagged = F.col(f"{p}_lag_{k}")
            one |= {f"{p}_momentum_{k}": F.col(y) - lagged} if "momentum" in fam else {}
            one |= {f"{p}_momentum_pct_{k}": (F.col(y) - lagged) / _guard(lagged) * 100} if "momentum_pct" in fam else {}
    if "rolling" in fam:
        if "trend" in fam:
            one |= {f"{p}_trend_{n}": F.col(y) - rolled(n, "mean") for n in TREND_WINDOWS}
        if "volatility" in fam:
            one |= {f"{p}_volatility_{n}": rolled(n, "std") / _guard(rolled(n, "mean")) for n in VOLATILITY_WINDOWS}
        if "zscore" in fam:
            one |= {f"{p}_zscore_{n}": (F.col(y) - rolled(n, "mean")) / _guard(rolled(n, "std")) for n in ZSCORE_WINDOWS}
    if "is_outlier" in fam and f"{p}_zscore_{ZSCORE_WINDOWS[0]}" in one:
        two = {f"{p}_is_outlier_{n}": _far(F.col(f"{p}_zscore_{n}")) for n in ZSCORE_WINDOWS}
    return [one, two]


def _far(zscore: Column) -> Column:
    return F.coalesce(F.abs(zscore) > OUTLIER_Z, F.lit(False)).cast("int")


def last_features(df: DataFrame, values: str, families: Sequence[str] = FAMILIES, y_prefix: str = "billings") -> DataFrame:
    """Add the features of a series' last row to rows that hold the series: ``values`` is an array,
    the latest value first.  The same columns as ``series_features``, without windows."""
    stages, names = _staged_columns(lambda i: F.get(values, F.lit(i)), y_prefix, families)
    out = df
    for cols in stages:
        out = out.withColumns(cols)
    return out.select(*[c for c in df.columns if c not in names], *names)


def _staged_columns(back: Callable[[int], Column], p: str, families: Sequence[str], before: Column | None = None,
                    earlier: Callable[[str, int], Column] | None = None, filled: Callable[[int], Column] | None = None,
                    counted: Callable[[int], Column] | None = None):
    """Spark columns in dependency stages, and the names of the features among them.

    ``back(i)`` is the series i rows before the row; ``before`` (given for shifted features) is null
    where a feature has no row; ``earlier(c, k)`` is column c k rows before.  ``_l{i}`` is ``back(i)``,
    ``_d{i}`` its distance from ``_l0``.  Sums of ``_d`` and its square give the moments without loss:
    ``_l0`` is in the window, so they are at most some 30 times the result, and a window of equal
    values has a std of exactly 0.  A sum with a missing value is null, which is the rule of n
    non-null inputs.
    Sums over columns that may be null test each of them in every step, so windows take ``filled(i)``,
    which is 0 where ``back(i)`` is null, and the rule from ``counted(n)``, the number of values up to
    n rows before: n rows are full if the counts at their ends differ by n.
    The lagged series' 30-row std is the 30-row std shifted by k rows; without ``earlier`` it is
    taken from the same distances again."""
    fam = set(families)
    y0 = F.col("_l0")

    def size_of(sizes):
        return {n for f, ns in sizes.items() if f in fam for n in ns}
    spread = size_of({"volatility": VOLATILITY_WINDOWS, "zscore": ZSCORE_WINDOWS, "is_outlier": ZSCORE_WINDOWS,
                      "rolling": ROLLING_WINDOWS, "autocorr": [AUTOCORR_WINDOW]})
    sizes = spread | size_of({"trend": TREND_WINDOWS, "rank": RANK_WINDOWS})
    lags = size_of({"lags": LAGS, "momentum": MOMENTUM_LAGS, "momentum_pct": MOMENTUM_LAGS, "autocorr": AUTOCORR_LAGS})
    reach = max(sizes, default=1) if "autocorr" not in fam else AUTOCORR_WINDOW + max(AUTOCORR_LAGS)
    seen = sorted(lags | set(range(1, reach)) | {0})
    fetched = {f"_l{i}": (filled or back)(i) for i in seen}
    own = {i: f"_l{i}" if filled is None else f"_n{i}" for i in [0, *sorted(lags)]}
    if filled is not None:
        fetched |= {own[i]: back(i) for i in own}
    full = {}                       # sizes of windows: whether all their values are there
    if counted is not None:
        ends = sizes | ({AUTOCORR_WINDOW + k for k in AUTOCORR_LAGS} if "autocorr" in fam else set())
        fetched |= {f"_c{n}": counted(n) for n in sorted(ends | {0})}
        full = {n: F.col("_c0") - F.col(f"_c{n}") == n for n in ends}
    if before is not None:          # a feature that is never null is null where there is no row before
        fetched["_before"] = before

    def add(terms):
        return " + ".join(terms)

    def val(i):
        return f"cast(_l{i} as double)"

    def when_full(n, c):
        return F.when(full[n], c) if full else c
    moved = {f"_d{i}": F.expr(f"{val(i)} - {val(0)}") for i in range(1, max(spread, default=1))}
    mean, std, sums, out = {}, {}, {}, {}
    for n in sorted(sizes):         # the oldest value first, as an average over a window adds them
        sums[f"_mean{n}"] = when_full(n, F.expr(f"({add([val(i) for i in reversed(range(n))])}) / {n}"))
        mean[n] = F.col(f"_mean{n}")
    for n in sorted(spread):
        one, two = (add([t.format(i) for i in range(1, n)]) for t in ("_d{0}", "_d{0} * _d{0}"))
        sums[f"_one{n}"], sums[f"_two{n}"] = F.expr(one), F.expr(two)
        m2 = F.col(f"_two{n}") - F.col(f"_one{n}") * F.col(f"_one{n}") / n
        std[n] = F.sqrt(m2 / (n - 1))
    if "rank" in fam:
        # 2 for each smaller value, 1 for each equal one
        for n in RANK_WINDOWS:
            sums[f"_twice{n}"] = F.expr(add(["1", *[f"(case when _l{i} < _l0 then 2 when _l{i} = _l0 then 1 else 0 end)"
                                                    for i in range(1, n)]]))
    if "rolling" in fam:
        for n in ROLLING_WINDOWS:
            every = [f"_l{i}" for i in range(n)]
            sums[f"_min{n}"], sums[f"_max{n}"] = F.least(*every), F.greatest(*every)
    if "autocorr" in fam:
        for k in AUTOCORR_LAGS:
            past = {i: f"({val(i + k)} - {val(k)})" for i in range(1, AUTOCORR_WINDOW)}
            sums[f"_past{k}"] = F.expr(add(past.values()))
            if earlier is None:
                sums[f"_square{k}"] = F.expr(add([f"{e} * {e}" for e in past.values()]))
            sums[f"_both{k}"] = F.expr(add([f"_d{i} * {e}" for i, e in past.items()]))
    later, last = {}, {}
    if "lags" in fam:
        out |= {f"{p}_lag_{k}": F.col(own[k]) for k in sorted(LAGS, key=str)}
    for k in MOMENTUM_LAGS:
        if "momentum" in fam:
            out[f"{p}_momentum_{k}"] = F.col(own[0]) - F.col(own[k])
        if "momentum_pct" in fam:
            out[f"{p}_momentum_pct_{k}"] = (F.col(own[0]) - F.col(own[k])) / _guard(F.col(own[k])) * 100
    if "trend" in fam:
        for n in TREND_WINDOWS:
            out[f"{p}_trend_{n}"] = y0 - mean[n]
    if "volatility" in fam:
        for n in VOLATILITY_WINDOWS:
            out[f"{p}_volatility_{n}"] = std[n] / _guard(mean[n])
    if fam & {"zscore", "is_outlier"}:
        for n in ZSCORE_WINDOWS:
            out[f"{p}_zscore_{n}"] = (y0 - mean[n]) / _guard(std[n])
    if "rolling" in fam:
        for n in ROLLING_WINDOWS:
            for stat, c in (("mean", mean[n]), ("std", std[n]), ("min", F.col(f"_min{n}")), ("max", F.col(f"_max{n}"))):
                out[f"{p}_rolling_{n}_{stat}"] = F.when(mean[n].isNotNull(), c)
    if "rank" in fam:
        for n in RANK_WINDOWS:
            out[f"{p}_rank_{n}"] = F.when(mean[n].isNotNull(), (F.col(f"_twice{n}") + 1) / 2.0 / n)
    if "is_outlier" in fam:
        for n in ZSCORE_WINDOWS:
            far = _far(F.col(f"{p}_zscore_{n}"))
            last[f"{p}_is_outlier_{n}"] = far if before is None else F.when(F.col("_before"), far)
    if "autocorr" in fam:
        n = AUTOCORR_WINDOW
        out["_sdp"] = F.sqrt((F.col(f"_two{n}") - F.col(f"_one{n}") * F.col(f"_one{n}") / n) / n)
        for k in AUTOCORR_LAGS:
            out[f"_cov{k}"] = when_full(n + k, (F.col(f"_both{k}") - F.col(f"_one{n}") * F.col(f"_past{k}") / n) / n)
            later[f"_sdp{k}"] = earlier("_sdp", k) if earlier else F.sqrt(
                (F.col(f"_square{k}") - F.col(f"_past{k}") * F.col(f"_past{k}") / n) / n)
            den = F.col("_sdp") * F.col(f"_sdp{k}")
            last[f"{p}_autocorr_{k}"] = F.col(f"_cov{k}") / F.when(den != 0, den)
    wanted = {f.name for f in _build_specs(p) if f.family in fam}
    return [fetched, moved, sums, out, later, last], [c for c in [*out, *last] if c in wanted]


def series_features_sql(source: str, y: str = "billings", families: Sequence[str] = FAMILIES,
                        select_cols: Sequence[str] = (), y_prefix: str | None = None,
                        digits: int | None = 6, key: Sequence[str] = STORE_KEY,
                        order: Sequence[str] = ("date",) + TIE_BREAK) -> str:
    """DuckDB/ANSI SQL computing the same columns over relation ``source``."""
    prefix = y_prefix or y
    specs = _build_specs(prefix)
    wanted = [s for s in specs if s.family in families]
    ctx = Ctx(y=y, key=list(key), order=list(order))
    lag_cols = ", ".join(f"{s.sql(ctx)} as {s.name}" for s in specs if s.stage == 0)
    s1 = ", ".join(f"{s.sql(ctx)} as {s.name}" for s in wanted if s.stage == 1)
    s2 = ", ".join(f"{s.sql(ctx)} as {s.name}" for s in wanted if s.stage == 2)

    def rnd(name):
        return f"round({name}, {digits}) as {name}" if digits is not None else name
    final = list(select_cols) + [rnd(s.name) for s in wanted]
    q0 = f"select *, {lag_cols} from {source}"
    q1 = f"select *{', ' + s1 if s1 else ''} from ({q0}) q0"
    q2 = f"select *{', ' + s2 if s2 else ''} from ({q1}) q1"
    return f"select {', '.join(final)} from ({q2}) q2"


# --------------------------------------------------------------- transforms

def log_target(df: DataFrame, target: str = "billings") -> DataFrame:
    """Keep ``<t>_original``; t = log1p(max(t, 0)); null stays null."""
    t = F.col(target)
    return df.withColumn(f"{target}_original", t).withColumn(
        target, keep_null(t, F.log1p(F.greatest(t, F.lit(0.0)))))


def target_transform(df: DataFrame, target: str = "billings", method: str = "log_plus_one",
                     clamp: float = 0.1) -> DataFrame:
    """T4: ``log_plus_one`` clamps t at ``clamp`` and adds ``<t>_log``;
    ``sqrt`` adds ``<t>_sqrt``."""
    t = F.col(target)
    if method == "log_plus_one":
        df = df.withColumn(target, keep_null(t, F.greatest(t, F.lit(clamp))))
        return df.withColumn(f"{target}_log", F.log1p(F.col(target)))
    if method == "sqrt":
        return df.withColumn(f"{target}_sqrt", keep_null(t, F.sqrt(F.greatest(t, F.lit(0.0)))))
    raise ValueError(f"unknown method {method}")


def inverse_target(c: str | Column, method: str = "log_plus_one") -> Column:
    """T5: expm1 for ``log_plus_one``, square for ``sqrt``."""
    c = F.col(c) if isinstance(c, str) else c
    if method == "log_plus_one":
        return F.expm1(c)
    if method == "sqrt":
        return F.pow(c, 2)
    return c


def iqr_bounds(df: DataFrame, target: str = "billings", factor: float = 2.0) -> tuple[float, float] | None:
    """T1/T2 fit: [Q1 - f*IQR, Q3 + f*IQR] with linear quartiles."""
    q1, q3 = exact_quantiles(df, target, [0.25, 0.75])
    if q1 is None:
        return None
    iqr = q3 - q1
    return q1 - factor * iqr, q3 + factor * iqr


def apply_bounds(df: DataFrame, bounds: tuple[float, float] | None, target: str = "billings") -> DataFrame:
    if bounds is None:
        return df
    lo, hi = bounds
    return df.filter(F.col(target).between(F.lit(lo), F.lit(hi)))


def iqr_filter(df: DataFrame, target: str = "billings", factor: float = 2.0) -> DataFrame:
    """Keep rows inside the IQR fence (null targets dropped)."""
    return apply_bounds(df, iqr_bounds(df, target, factor), target)


def median_impute(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """+-inf -> null, null -> column median (0 when the column is all
    null)."""
    inf = float("inf")
    clean = df.withColumns({c: F.when(F.abs(F.col(c)) != F.lit(inf), F.col(c)) for c in cols})
    med = {c: q[0] for c, q in column_quantiles(clean, list(cols), [0.5]).items()}
    return clean.withColumns({c: F.coalesce(F.col(c), F.lit(med.get(c) if med.get(c) is not None else 0.0))
                              for c in cols})


def bfill_ffill_zero(df: DataFrame, cols: Sequence[str], key: Sequence[str] = STORE_KEY,
                     order: Sequence[str] = ("date",) + TIE_BREAK, chunk_rows: int | None = None,
                     hot_rows: int | None = None, hot=UNSET) -> DataFrame:
    """T7 per store: +-inf -> null, back fill, then forward fill, then 0.

    Fills are running "last non-null" values (forward and in reverse order:
    growing frames, computed incrementally).  Hot stores are chunked; the
    value carried across a chunk border comes from a per-(store, chunk)
    table of first/last non-null values (bounded: stores + hot chunks)."""
    from storecast.operators.series import DEFAULT_CHUNK_ROWS
    key = list(key)
    inf = float("inf")
    out = df.withColumns({c: F.when(F.abs(F.col(c)) != F.lit(inf), F.col(c)) for c in cols})
    chunk = chunk_rows or DEFAULT_CHUNK_ROWS
    if hot is UNSET:
        from storecast.operators.series import hot_keys
        hot = hot_keys(out, key, order[0], chunk, hot_rows)
    if hot is None:                  # one chunk per store: nothing to carry
        w = Window.partitionBy(*key)
        before = w.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        after = w.orderBy(*[F.col(o).desc() for o in order]).rowsBetween(Window.unboundedPreceding, 0)
        return out.withColumns({x: F.coalesce(F.last(x, ignorenulls=True).over(after),
                                              F.last(x, ignorenulls=True).over(before),
                                              F.lit(0).cast(out.schema[x].dataType)) for x in cols})
    out = write_table(out, "series")    # a computed frame that the split reads several times
    c = chunk_series(out, key, order, 0, chunk, hot_rows, hot).drop("_home")
    part = key + [CHUNK]
    before = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    after = (Window.partitionBy(*part).orderBy(*[F.col(o).desc() for o in order])
             .rowsBetween(Window.unboundedPreceding, 0))
    filled = c.withColumns({f"_b_{x}": F.last(x, ignorenulls=True).over(after) for x in cols}).withColumns(
        {f"_f_{x}": F.last(x, ignorenulls=True).over(before) for x in cols})
    pos = F.struct(*[F.col(o) for o in order])
    edges = c.groupBy(*part).agg(
        *[F.min_by(x, F.when(F.col(x).isNotNull(), pos)).alias(f"_first_{x}") for x in cols],
        *[F.max_by(x, F.when(F.col(x).isNotNull(), pos)).alias(f"_last_{x}") for x in cols])
    wk = Window.partitionBy(*key).orderBy(CHUNK)
    carry = edges.select(
        *part,
        *[F.first(f"_first_{x}", ignorenulls=True).over(wk.rowsBetween(1, Window.unboundedFollowing))
          .alias(f"_cb_{x}") for x in cols],
        *[F.last(f"_last_{x}", ignorenulls=True).over(wk.rowsBetween(Window.unboundedPreceding, -1))
          .alias(f"_cf_{x}") for x in cols])
    res = filled.join(carry, part, "left")
    res = res.withColumns({x: F.coalesce(F.col(f"_b_{x}"), F.col(f"_cb_{x}"), F.col(f"_f_{x}"),
                                         F.col(f"_cf_{x}"), F.lit(0).cast(out.schema[x].dataType))
                           for x in cols})
    return res.drop(CHUNK, *[f"_{p}_{x}" for p in ("b", "f", "cb", "cf") for x in cols])


def bfill_ffill_sql(cols: Sequence[str], key=STORE_KEY, order=("date",) + TIE_BREAK) -> list[str]:
    w = f"partition by {', '.join(key)} order by {', '.join(order)}"
    return [f"coalesce(first_value({c} ignore nulls) over ({w} rows between current row and unbounded following), "
            f"last_value({c} ignore nulls) over ({w} rows between unbounded preceding and current row), 0) as {c}"
            for c in cols]


def preprocess(df: DataFrame, target: str = "billings", outlier_bounds=None, fill: str | None = None,
               families: Sequence[str] = FAMILIES, chunk_rows: int | None = None) -> DataFrame:
    """Outlier fence (fitted bounds) -> T4 clamp -> T3 log + W1 +
    rolling features per store -> optional T7 (``fill='bfill_ffill'``).
    With the default clamp the model target is log1p(max(billings, 0.1))."""
    from storecast.operators.series import DEFAULT_CHUNK_ROWS, hot_keys
    chunk = chunk_rows or DEFAULT_CHUNK_ROWS
    x = apply_bounds(df, outlier_bounds, target)
    hot = hot_keys(x, STORE_KEY, "date", chunk)
    x = target_transform(x, target)
    x = log_target(x, target)
    x = calendar_features(x)
    x = series_features(x, target, families, chunk_rows=chunk, hot=hot)
    if fill == "bfill_ffill":
        feats = [c for c in feature_names(families, target) if c in x.columns]
        x = bfill_ffill_zero(x, feats, chunk_rows=chunk, hot=hot)
    return x
