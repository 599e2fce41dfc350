"""Registered EDA and dashboard queries."""

from __future__ import annotations

from storecast.operators import reports as R
from storecast.plans.catalog import register
from storecast.sources.tables import pred_vs_real, sales

# EDA view of the sales table: Transaction Date -> date, Local Amount ->
# billings, Partner Name -> partner_name, Country -> country.
PROFILE_COLUMNS = [("billings", "double"), ("miles", "double"), ("l_orderkey", "bigint"),
                   ("l_linenumber", "int"), ("l_partkey", "bigint")]

# Dashboard filter used by the registered B1 query.
DASH_START, DASH_END = "1996-01-01", "2000-12-31"
DASH_PAISES = ["AMERICA", "ASIA", "EUROPE"]


def _profile_sql() -> str:
    parts = []
    for c, t in PROFILE_COLUMNS:
        x = f"cast({c} as double)"
        parts.append(
            f"select '{c}' as column_name, '{t}' as dtype, count({x}) as non_null, "
            f"round(avg({x}), 4) as mean, round(stddev_samp({x}), 4) as std, "
            f"round(min({x}), 4) as min, round(quantile_cont({x}, 0.25), 4) as q25, "
            f"round(quantile_cont({x}, 0.5), 4) as q50, round(quantile_cont({x}, 0.75), 4) as q75, "
            f"round(max({x}), 4) as max from sales")
    return "\nunion all\n".join(parts)


@register("profile_table", _profile_sql())
def q_profile_table(spark, sf_dir):
    return R.profile_table(sales(spark, sf_dir), [c for c, _ in PROFILE_COLUMNS])


@register("amount_histogram", """
with b as (select min(billings) as mn, max(billings) as mx from sales),
c as (select cast(least(floor((s.billings - b.mn) / (b.mx - b.mn) * 50), 49) as integer) as bin,
             count(*) as n
      from sales s, b where s.billings is not null group by 1),
spine as (select cast(range as integer) as bin from range(50))
select spine.bin, round(b.mn + spine.bin * ((b.mx - b.mn) / 50), 6) as bin_start,
       round(b.mn + (spine.bin + 1) * ((b.mx - b.mn) / 50), 6) as bin_end,
       coalesce(c.n, 0) as n
from spine cross join b left join c on spine.bin = c.bin
""")
def q_amount_histogram(spark, sf_dir):
    return R.amount_histogram(sales(spark, sf_dir), "billings")


@register("amount_kde", """
with s as (select count(billings) as n, min(billings) as mn, max(billings) as mx,
                  stddev_samp(billings) as sd from sales),
p as (select n, mn, sd * pow(n, -1.0 / 5.0) as h, (mx - mn) / 199 as step,
             (mx - mn) / 50 as binw from s),
g as (select cast(range as integer) as grid, p.mn + range * p.step as x from range(200), p)
select g.grid, round(g.x, 6) as x,
       round(sum(exp(-pow((g.x - v.billings) / p.h, 2) / 2)) * (1.0 / (p.n * p.h * sqrt(2 * pi()))), 12) as density,
       round(sum(exp(-pow((g.x - v.billings) / p.h, 2) / 2)) * (1.0 / (p.n * p.h * sqrt(2 * pi())))
             * (p.n * p.binw), 6) as kde_count
from g cross join p join sales v on v.billings is not null
group by g.grid, g.x, p.n, p.h, p.binw
""")
def q_amount_kde(spark, sf_dir):
    return R.amount_kde(sales(spark, sf_dir), "billings")


@register("amount_q95", "select round(quantile_cont(billings, 0.95), 6) as q95 from sales")
def q_amount_q95(spark, sf_dir):
    return R.amount_quantile(sales(spark, sf_dir), "billings", 0.95)


@register("monthly_sales", """
with sums as (select last_day(date) as month_end, sum(billings) as total from sales group by 1),
b as (select cast(date_trunc('month', min(date)) as timestamp) as d0,
             cast(date_trunc('month', max(date)) as timestamp) as d1 from sales),
spine as (select last_day(cast(unnest(generate_series(d0, d1, interval 1 month)) as date)) as month_end from b)
select spine.month_end, round(coalesce(sums.total, 0), 4) as total_sales
from spine left join sums on spine.month_end = sums.month_end
""")
def q_monthly_sales(spark, sf_dir):
    return R.monthly_sales(sales(spark, sf_dir), "date", "billings")


@register("top_partners", """
select partner_name, round(sum(billings), 4) as total_sales from sales
group by partner_name order by total_sales desc, partner_name limit 10
""")
def q_top_partners(spark, sf_dir):
    return R.top_by(sales(spark, sf_dir), "partner_name", "billings", 10)


@register("sales_by_country", """
select country, round(sum(billings), 4) as total_sales from sales
group by country order by total_sales desc, country
""")
def q_sales_by_country(spark, sf_dir):
    return R.top_by(sales(spark, sf_dir), "country", "billings", None)


@register("sales_by_weekday", """
with sums as (select isodow(date) - 1 as weekday, sum(billings) as t from sales group by 1)
select cast(s.weekday as integer) as weekday,
       ['Lunes', 'Martes', 'Miércoles', 'Jueves', 'Viernes', 'Sábado', 'Domingo'][s.weekday + 1] as day_name,
       round(sums.t, 4) as total_sales
from (select range as weekday from range(7)) s left join sums on s.weekday = sums.weekday
order by 1
""")
def q_sales_by_weekday(spark, sf_dir):
    return R.sales_by_weekday(sales(spark, sf_dir), "date", "billings")


@register("calendar_columns", """
select store_id, l_orderkey, l_linenumber, l_partkey, date,
       cast(year(date) as integer) as "Year", cast(month(date) as integer) as "Month",
       cast(isodow(date) - 1 as integer) as "DayOfWeek"
from sales
""")
def q_calendar_columns(spark, sf_dir):
    return R.calendar_columns(
        sales(spark, sf_dir).select("store_id", "l_orderkey", "l_linenumber", "l_partkey", "date"),
        "date")


# ------------------------------------------------------------------ dashboard

@register("kpi_totals", """
select round(coalesce(sum(ventas_reales), 0), 4) as ventas_reales_tot,
       round(coalesce(sum(ventas_predichas), 0), 4) as ventas_pred_tot from pred_vs_real
""")
def q_kpi_totals(spark, sf_dir):
    return R.kpi_totals(pred_vs_real(spark, sf_dir))


@register("kpi_precision", """
select round(case when avg(abs((ventas_reales - ventas_predichas) / nullif(ventas_reales, 0))) is not null
                  then greatest(0.0, 1 - avg(abs((ventas_reales - ventas_predichas) / nullif(ventas_reales, 0)))) end, 6)
       as precision
from pred_vs_real where ventas_reales is not null and ventas_predichas is not null
""")
def q_kpi_precision(spark, sf_dir):
    return R.kpi_precision(pred_vs_real(spark, sf_dir))


DAILY_SQL = """
select fecha, round(coalesce(sum(ventas_reales), 0), 4) as ventas_reales,
       round(coalesce(sum(ventas_predichas), 0), 4) as ventas_predichas
from pred_vs_real group by fecha
"""


@register("daily_real_vs_pred", DAILY_SQL + " order by fecha")
def q_daily_real_vs_pred(spark, sf_dir):
    return R.daily_real_vs_pred(pred_vs_real(spark, sf_dir))


@register("daily_long", f"""
with d as ({DAILY_SQL})
select fecha, 'ventas_reales' as serie, ventas_reales as valor from d
union all
select fecha, 'ventas_predichas' as serie, ventas_predichas as valor from d
""")
def q_daily_long(spark, sf_dir):
    return R.daily_long(R.daily_real_vs_pred(pred_vs_real(spark, sf_dir)))


@register("store_breakdown", """
select partner, pais, ciudad, tienda,
       round(coalesce(sum(ventas_reales), 0), 4) as ventas_reales,
       round(coalesce(sum(ventas_predichas), 0), 4) as ventas_predichas
from pred_vs_real
where partner is not null and pais is not null and ciudad is not null and tienda is not null
group by 1, 2, 3, 4 order by 1, 2, 3, 4
""")
def q_store_breakdown(spark, sf_dir):
    return R.store_breakdown(pred_vs_real(spark, sf_dir))


@register("dashboard_filter", f"""
select * from pred_vs_real
where fecha >= date '{DASH_START}' and fecha <= date '{DASH_END}'
  and pais in ({", ".join(f"'{p}'" for p in DASH_PAISES)})
""")
def q_dashboard_filter(spark, sf_dir):
    return R.dashboard_filter(pred_vs_real(spark, sf_dir), DASH_START, DASH_END, paises=DASH_PAISES)


@register("filter_options", """
select * from (
  select distinct 'partner' as option, cast(partner as varchar) as value from pred_vs_real
  union all select distinct 'pais' as option, cast(pais as varchar) as value from pred_vs_real
  union all select * from (select distinct 'tienda' as option, cast(tienda as varchar) as value
                           from pred_vs_real order by value limit 30)
  union all select 'fecha_min' as option, cast(min(fecha) as varchar) as value from pred_vs_real
  union all select 'fecha_max' as option, cast(max(fecha) as varchar) as value from pred_vs_real
) order by option, value
""")
def q_filter_options(spark, sf_dir):
    return R.filter_options(pred_vs_real(spark, sf_dir), 30)


@register("preview_rows", "select * from pred_vs_real order by fecha, tienda limit 20")
def q_preview_rows(spark, sf_dir):
    return R.preview_rows(pred_vs_real(spark, sf_dir), ["fecha", "tienda"], 20)
