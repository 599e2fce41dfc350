"""Registered CSV source/sink queries.

The CSV inputs are written from the driver's tables (whole tables) into the
shared scratch folder under ``spark.checkpoint.dir``, once per session, and
read back through the loaders.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from storecast.functions.exprs import md5_uniform
from storecast.operators import reports as R
from storecast.plans.catalog import register
from storecast.plans.reports_q import DASH_END, DASH_PAISES, DASH_START
from storecast.session import scratch_path
from storecast.sources import csv_io as C
from storecast.sources.tables import pred_vs_real, sales

_WRITTEN: dict[tuple, str] = {}

# Fixed parameters of the registered CSV round trips.
EDA_CITY_REGIONS = ["AFRICA", "AMERICA"]          # files of these regions carry a City column
DASH_SEP = ";"
DASH_HEADERS = {"fecha": " Transaction Date ", "partner": "Partner Name", "pais": "COUNTRY",
                "ciudad": "City", "tienda": "Store Name", "ventas_reales": "Local Amount",
                "ventas_predichas": "Pred"}


def _once(spark, sf_dir, kind, write):
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _WRITTEN:
        path = scratch_path(spark, kind)
        write(path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


def sales_csv(spark, sf_dir) -> str:
    """The sales view as the reference's training CSV (A1 headers)."""
    cols = ["partner_code", "partner_name", "store_code", "store_name", "date", "billings", "miles"]
    inv = {v: k for k, v in C.SALES_HEADER_MAP.items()}
    return _once(spark, sf_dir, "sales-csv",
                 lambda p: C.write_csv(sales(spark, sf_dir).select(*cols), p, inv))


# Shares of rows that the dirty training CSV spoils, by the md5 of the row's key (kept
# rows are all rows): upper bounds of the draw for each fault.
DIRT = {"bad_date": 0.01, "bad_number": 0.02, "null_number": 0.03, "negative": 0.05, "no_partner": 0.06, "no_store": 0.07}


def _fault(u, name, between):
    low = [0.0, *DIRT.values()][list(DIRT).index(name)]
    return between(u, low, DIRT[name])


def dirty_csv(spark, sf_dir) -> str:
    """The training CSV with unparsable dates, text, missing and negative
    billings and missing codes in some rows."""
    def write(path):
        s = sales(spark, sf_dir)
        u = md5_uniform("l_orderkey", "l_linenumber", "l_partkey")

        def on(name):
            return _fault(u, name, lambda x, a, b: (x >= a) & (x < b))
        amount = F.when(on("negative"), -F.col("billings")).when(~on("null_number"), F.col("billings")).cast("string")
        rows = s.select(
            F.when(~on("no_partner"), F.col("partner_code")).alias("partner_code"), "partner_name",
            F.when(~on("no_store"), F.col("store_code")).alias("store_code"), "store_name",
            F.when(on("bad_date"), F.concat(F.lit("day "), F.col("date").cast("string"))).otherwise(
                F.col("date").cast("string")).alias("date"),
            F.when(on("bad_number"), F.lit("n.d.")).otherwise(amount).alias("billings"), "miles")
        C.write_csv(rows, path, {v: k for k, v in C.SALES_HEADER_MAP.items()})
    return _once(spark, sf_dir, "dirty-csv", write)


def dirty_text(spark, sf_dir):
    """The dirty CSV as text columns under the canonical names."""
    raw = spark.read.option("header", True).csv(dirty_csv(spark, sf_dir))
    return raw.withColumnsRenamed(C.SALES_HEADER_MAP)


def _sql_fault(name):
    return _fault("u", name, lambda u, a, b: f"({u} >= {a} and {u} < {b})")


#: The rows of the dirty CSV as the loaders must read them.
DIRTY_CTE = f"""
dirty as (
  select case when not {_sql_fault('no_partner')} then partner_code end as partner_code,
         case when not {_sql_fault('no_store')} then store_code end as store_code,
         case when not {_sql_fault('bad_date')} then date end as date,
         case when {_sql_fault('negative')} then -billings
              when not ({_sql_fault('bad_number')} or {_sql_fault('null_number')}) then billings end as billings,
         {_sql_fault('bad_number')} as bad_number, miles
  from (select *, ('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey)), 1, 8))::UBIGINT
                  / 4294967296.0 as u from sales) s)"""


def eda_csv_dir(spark, sf_dir) -> str:
    """EDA transaction files in two layouts (with and without City)."""
    def write(path):
        s = sales(spark, sf_dir)
        with_city = s.filter(F.col("country").isin(EDA_CITY_REGIONS))
        without = s.filter(~F.col("country").isin(EDA_CITY_REGIONS))
        C.write_csv(with_city.select("date", "partner_name", "country", "city", "billings"),
                    path, C.EDA_HEADER_MAP, mode="append")
        C.write_csv(without.select("date", "partner_name", "country", "billings"),
                    path, C.EDA_HEADER_MAP, mode="append")
    return _once(spark, sf_dir, "eda-csv", write)


def dashboard_csv(spark, sf_dir) -> str:
    return _once(spark, sf_dir, "dash-csv",
                 lambda p: C.write_csv(pred_vs_real(spark, sf_dir), p, DASH_HEADERS, DASH_SEP))


SALES_AS_CSV_SQL = """
select partner_code, partner_name, store_code, store_name, cast(date as varchar) as date,
       billings, miles, concat(partner_code, '_', store_code) as store_id from sales
"""


@register("load_sales", SALES_AS_CSV_SQL)
def q_load_sales(spark, sf_dir):
    return C.load_sales(spark, sales_csv(spark, sf_dir))


@register("load_csv_dir", f"""
select cast(date as varchar) as "Transaction Date", partner_name as "Partner Name", country as "Country",
       case when country in ({", ".join(f"'{r}'" for r in EDA_CITY_REGIONS)}) then city end as "City",
       billings as "Local Amount"
from sales""")
def q_load_csv_dir(spark, sf_dir):
    df = C.load_csv_dir(spark, eda_csv_dir(spark, sf_dir))
    return df.withColumn("Local Amount", F.col("Local Amount").try_cast("double"))


@register("load_pred_vs_real", "select * from pred_vs_real")
def q_load_pred_vs_real(spark, sf_dir):
    df = C.load_pred_vs_real(spark, dashboard_csv(spark, sf_dir), DASH_SEP)
    return df.select("partner", "pais", "ciudad", "tienda", "fecha", "ventas_reales", "ventas_predichas")


@register("export_filtered", f"""
select * from pred_vs_real
where fecha >= date '{DASH_START}' and fecha <= date '{DASH_END}'
  and pais in ({", ".join(f"'{p}'" for p in DASH_PAISES)})
""")
def q_export_filtered(spark, sf_dir):
    flt = R.dashboard_filter(pred_vs_real(spark, sf_dir), DASH_START, DASH_END, paises=DASH_PAISES)
    path = scratch_path(spark, "export")
    C.write_csv(flt, path)                       # the export itself (S5)
    back = C.load_pred_vs_real(spark, path)
    return back.select("partner", "pais", "ciudad", "tienda", "fecha", "ventas_reales", "ventas_predichas")
