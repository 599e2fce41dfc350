"""EDA and dashboard reports (histogram, KDE, monthly/partner/country/weekday
sales, KPIs, daily series, store breakdown, filters, preview).

All are single aggregations over a scan: partial (map-side) aggregation, one
shuffle of partial results, small output.  Global scalars (min, max, count,
bandwidth) are computed first as one-row aggregates and used as literals, so
no cross join and no single-partition window appears in any plan.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import mul

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storecast.functions.exprs import scalar_row, weekday_name
from storecast.functions.stats import column_quantiles, exact_quantiles

MONEY_DIGITS = 4
KDE_STEP, KDE_REACH = 0.01, 9.0      # widest bin and how far a kernel reaches, in bandwidths
STAT_DIGITS = 6


def _r(c: Column, digits: int = MONEY_DIGITS) -> Column:
    return F.round(c, digits)


# ---------------------------------------------------------------- EDA

def profile_table(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``info()`` + ``describe()`` of the numeric columns, one row per column:
    dtype, non-null count, mean, sample std, min, quartiles, max."""
    numeric = ("double", "float", "int", "bigint", "smallint", "tinyint")
    fields = [f for f in df.schema.fields
              if (columns is None or f.name in columns) and f.dataType.simpleString() in numeric]
    aggs = []
    for f in fields:
        c = F.col(f.name).cast("double")
        aggs += [F.count(c).alias(f"{f.name}__n"), F.avg(c).alias(f"{f.name}__mean"),
                 F.stddev_samp(c).alias(f"{f.name}__std"), F.min(c).alias(f"{f.name}__min"),
                 F.max(c).alias(f"{f.name}__max")]
    # the statistics ride on the first of the quartiles' three passes
    qs, agg_df, row = column_quantiles(df.select(*[f.name for f in fields]), [f.name for f in fields],
                                       [0.25, 0.5, 0.75], also=aggs)
    types = {f.name: f.dataType for f in agg_df.schema.fields}
    stats = {k: v for k, v in row.items() if "__" in k and not k.startswith("_")}
    wide = df.sparkSession.range(1).select(
        *[F.lit(v).cast(types[a]).alias(a) for a, v in stats.items()],
        *[F.array(*[F.lit(v).cast("double") for v in qs[f.name]]).alias(f"{f.name}__q") for f in fields])
    rows = [F.struct(
        F.lit(f.name).alias("column_name"),
        F.lit(f.dataType.simpleString()).alias("dtype"),
        F.col(f"{f.name}__n").alias("non_null"),
        _r(F.col(f"{f.name}__mean")).alias("mean"),
        _r(F.col(f"{f.name}__std")).alias("std"),
        _r(F.col(f"{f.name}__min")).alias("min"),
        _r(F.col(f"{f.name}__q")[0]).alias("q25"),
        _r(F.col(f"{f.name}__q")[1]).alias("q50"),
        _r(F.col(f"{f.name}__q")[2]).alias("q75"),
        _r(F.col(f"{f.name}__max")).alias("max")) for f in fields]
    return wide.select(F.inline(F.array(*rows)))


def amount_histogram(df: DataFrame, c: str, bins: int = 50) -> DataFrame:
    """Equal-width bins over [min, max]; the last bin is closed; empty bins 0."""
    b = scalar_row(df.agg(F.min(c).alias("mn"), F.max(c).alias("mx")))
    mn, mx = b.get("mn"), b.get("mx")
    if mn is None:
        return df.sparkSession.createDataFrame(
            [], "bin int, bin_start double, bin_end double, n bigint")
    width = (mx - mn) / bins if mx > mn else 1.0
    idx = F.least(F.floor((F.col(c) - F.lit(mn)) / F.lit(mx - mn if mx > mn else 1.0)
                          * F.lit(bins)), F.lit(bins - 1)).cast("int")
    counts = (df.filter(F.col(c).isNotNull()).groupBy(idx.alias("bin"))
              .agg(F.count(F.lit(1)).alias("n")))
    spine = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (spine.join(counts, "bin", "left")
            .select("bin",
                    F.round(F.lit(mn) + F.col("bin") * F.lit(width), STAT_DIGITS).alias("bin_start"),
                    F.round(F.lit(mn) + (F.col("bin") + 1) * F.lit(width), STAT_DIGITS).alias("bin_end"),
                    F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n")))


def amount_kde(df: DataFrame, c: str, gridsize: int = 200, bins: int = 50) -> DataFrame:
    """Gaussian KDE on ``gridsize`` points over [min, max] (the histogram's
    curve: cut 0), Scott bandwidth ``h = std * n^(-1/5)``.

    Rows are added up once, in fine bins at most ``KDE_STEP * h`` wide: the count and the
    first five moments of the distance t from the bin's middle, in units of h.  A bin's
    part in the sum at distance u is then ``exp(-u^2 / 2) * sum(He_k(u) * M_k / k!)``, the
    kernel's Taylor series, and grid points further than ``KDE_REACH`` from a bin get
    nothing of it.  A kernel sum (at most n) is off by at most
    ``n * (15 / 720 * (KDE_STEP / 2)^6 + exp(-KDE_REACH^2 / 2))``, under 1e-15 n.  The bins
    number range / (KDE_STEP * h), so they grow with n^(1/5) only.  ``kde_count`` is the
    curve in histogram-count units (density * n * bin width).
    """
    x = F.col(c).cast("double")
    s = scalar_row(df.agg(F.count(x).alias("n"), F.min(x).alias("mn"), F.max(x).alias("mx"), F.stddev_samp(x).alias("sd")))
    n, mn, mx, sd = s.get("n", 0), s.get("mn"), s.get("mx"), s.get("sd")
    if not n or sd is None or sd == 0:
        return df.sparkSession.createDataFrame([], "grid int, x double, density double, kde_count double")
    h = sd * n ** (-1.0 / 5.0)
    step, wide = (mx - mn) / (gridsize - 1), KDE_STEP * h
    b = F.floor((x - F.lit(mn)) / F.lit(wide))
    t = (x - F.lit(mn) - (F.col("b") + 0.5) * F.lit(wide)) / F.lit(h)
    sums = (df.where(x.isNotNull()).withColumn("b", b).select("b", t.alias("t")).groupBy("b")
            .agg(F.count(F.lit(1)).alias("m0"), *[F.sum(reduce(mul, [F.col("t")] * k)).alias(f"m{k}") for k in range(1, 6)]))
    middle = (F.col("b") + 0.5) * F.lit(wide)          # from the minimum
    near = [F.ceil((middle - F.lit(KDE_REACH * h)) / F.lit(step)), F.floor((middle + F.lit(KDE_REACH * h)) / F.lit(step))]
    points = sums.withColumn("grid", F.explode(F.sequence(F.greatest(F.lit(0), near[0]), F.least(F.lit(gridsize - 1), near[1]))))
    u = (F.col("grid") * F.lit(step) - middle) / F.lit(h)
    u2, m = F.col("u") * F.col("u"), [F.col(f"m{k}") for k in range(6)]
    series = (m[0] + F.col("u") * m[1] + (u2 - 1) * m[2] / 2 + F.col("u") * (u2 - 3) * m[3] / 6
              + (u2 * (u2 - 6) + 3) * m[4] / 24 + F.col("u") * (u2 * (u2 - 10) + 15) * m[5] / 120)
    curve = points.withColumn("u", u).groupBy("grid").agg(F.sum(F.exp(-u2 / 2) * series).alias("g"))
    norm, binw = 1.0 / (n * h * math.sqrt(2 * math.pi)), (mx - mn) / bins
    spine = df.sparkSession.range(gridsize).select(F.col("id").cast("int").alias("grid"))
    density = F.coalesce("g", F.lit(0.0)) * F.lit(norm)
    return spine.join(curve.withColumn("grid", F.col("grid").cast("int")), "grid", "left").select(
        "grid", F.round(F.lit(mn) + F.col("grid") * F.lit(step), STAT_DIGITS).alias("x"), F.round(density, 12).alias("density"),
        F.round(density * F.lit(n * binw), STAT_DIGITS).alias("kde_count"))


def amount_quantile(df: DataFrame, c: str, q: float = 0.95) -> DataFrame:
    """The q-quantile (axis limit of the histogram), exact at any size."""
    (v,) = exact_quantiles(df, c, [q])
    return df.sparkSession.range(1).select(
        F.round(F.lit(v).cast("double"), STAT_DIGITS).alias(f"q{int(round(q * 100))}"))


def monthly_sales(df: DataFrame, date_col: str, amount_col: str) -> DataFrame:
    """Sum by calendar month end; months without rows give 0 (resample('M'))."""
    sums = (df.groupBy(F.last_day(date_col).alias("month_end"))
            .agg(F.sum(amount_col).alias("total")))
    b = scalar_row(df.agg(F.min(date_col).alias("d0"), F.max(date_col).alias("d1")))
    if b.get("d0") is None:
        return sums.select("month_end", _r(F.col("total")).alias("total_sales")).limit(0)
    spine = df.sparkSession.range(1).select(F.explode(F.sequence(
        F.trunc(F.lit(b["d0"]), "month"), F.trunc(F.lit(b["d1"]), "month"),
        F.expr("interval 1 month"))).alias("m")).select(F.last_day("m").alias("month_end"))
    return (spine.join(sums, "month_end", "left")
            .select("month_end", _r(F.coalesce(F.col("total"), F.lit(0.0))).alias("total_sales")))


def top_by(df: DataFrame, key: str, amount_col: str, k: int | None = 10) -> DataFrame:
    """Sum by ``key``, descending (ties by key); top ``k`` (None = all)."""
    out = (df.groupBy(key).agg(F.sum(amount_col).alias("t"))
           .select(key, _r(F.col("t")).alias("total_sales"))
           .orderBy(F.desc("total_sales"), F.asc(key)))
    return out.limit(k) if k else out


def sales_by_weekday(df: DataFrame, date_col: str, amount_col: str) -> DataFrame:
    """Sum by weekday (Mon=0) with Spanish labels in Mon..Sun order; a weekday
    without rows gives null (reindex)."""
    sums = (df.groupBy(F.weekday(date_col).alias("weekday"))
            .agg(F.sum(amount_col).alias("t")))
    spine = df.sparkSession.range(7).select(F.col("id").cast("int").alias("weekday"))
    return (spine.join(sums, "weekday", "left")
            .select("weekday", weekday_name("weekday").alias("day_name"),
                    _r(F.col("t")).alias("total_sales"))
            .orderBy("weekday"))


def calendar_columns(df: DataFrame, date_col: str) -> DataFrame:
    return df.withColumns({
        "Year": F.year(date_col), "Month": F.month(date_col),
        "DayOfWeek": F.weekday(date_col)})


# ------------------------------------------------------- dashboard

def dashboard_filter(df: DataFrame, start=None, end=None, partners=None, paises=None,
                     tiendas=None) -> DataFrame:
    """Date range (inclusive) and IN-list filters; ``None`` = not filtered.
    Plain column predicates, so they reach the parquet scan when the input
    is a table."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col("fecha") >= F.lit(start).cast("date"))
    if end is not None:
        cond = cond & (F.col("fecha") <= F.lit(end).cast("date"))
    for c, values in (("partner", partners), ("pais", paises), ("tienda", tiendas)):
        if values is not None:
            cond = cond & F.col(c).cast("string").isin(list(values))
    return df.filter(cond)


def kpi_totals(df: DataFrame) -> DataFrame:
    return df.agg(
        _r(F.coalesce(F.sum("ventas_reales"), F.lit(0.0))).alias("ventas_reales_tot"),
        _r(F.coalesce(F.sum("ventas_predichas"), F.lit(0.0))).alias("ventas_pred_tot"))


def kpi_precision(df: DataFrame, y: str = "ventas_reales", p: str = "ventas_predichas") -> DataFrame:
    """max(0, 1 - MAPE) over rows with both values; y = 0 skipped in the
    mean; no usable row -> null."""
    pairs = df.filter(F.col(y).isNotNull() & F.col(p).isNotNull())
    ape = F.abs((F.col(y) - F.col(p)) / F.when(F.col(y) != 0, F.col(y)))
    mape = F.avg(ape)
    return pairs.agg(F.round(F.when(mape.isNotNull(), F.greatest(F.lit(0.0), 1 - mape)),
                             STAT_DIGITS).alias("precision"))


def daily_real_vs_pred(df: DataFrame) -> DataFrame:
    """Per-date sums (a group whose values are all null sums to 0)."""
    return (df.groupBy("fecha")
            .agg(_r(F.coalesce(F.sum("ventas_reales"), F.lit(0.0))).alias("ventas_reales"),
                 _r(F.coalesce(F.sum("ventas_predichas"), F.lit(0.0))).alias("ventas_predichas"))
            .orderBy("fecha"))


def daily_long(daily: DataFrame) -> DataFrame:
    return daily.unpivot("fecha", ["ventas_reales", "ventas_predichas"], "serie", "valor")


def store_breakdown(df: DataFrame) -> DataFrame:
    keys = ["partner", "pais", "ciudad", "tienda"]
    return (df.dropna(subset=keys).groupBy(*keys)
            .agg(_r(F.coalesce(F.sum("ventas_reales"), F.lit(0.0))).alias("ventas_reales"),
                 _r(F.coalesce(F.sum("ventas_predichas"), F.lit(0.0))).alias("ventas_predichas"))
            .orderBy(*keys))


def filter_options(df: DataFrame, max_stores: int = 30) -> DataFrame:
    """Widget options as (option, value) rows: every partner and country
    (sorted), the first ``max_stores`` stores (sorted; a top-k), and the
    min/max date."""
    from storecast.session import cut_lineage
    # one pass over the dashboard rows: one row per (partner, country, store)
    # with its date range, written once; every option list reads that
    per_store = cut_lineage(df.groupBy("partner", "pais", "tienda").agg(
        F.min("fecha").alias("fecha_min"), F.max("fecha").alias("fecha_max")))

    def opt(name, c):
        return per_store.select(F.lit(name).alias("option"), F.col(c).cast("string").alias("value")).distinct()
    stores = opt("tienda", "tienda").orderBy("value").limit(max_stores)
    dates = per_store.agg(F.min("fecha_min").alias("fecha_min"), F.max("fecha_max").alias("fecha_max")).select(
        F.inline(F.array(
            F.struct(F.lit("fecha_min").alias("option"), F.col("fecha_min").cast("string").alias("value")),
            F.struct(F.lit("fecha_max").alias("option"), F.col("fecha_max").cast("string").alias("value")))))
    return (opt("partner", "partner").unionByName(opt("pais", "pais"))
            .unionByName(stores).unionByName(dates).orderBy("option", "value"))


def preview_rows(df: DataFrame, order: list[str], n: int = 20) -> DataFrame:
    return df.orderBy(*order).limit(n)
