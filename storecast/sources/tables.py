"""Readers for the driver's parquet tables and the two derived views.

``sales`` maps the TPC-H-like tables onto the reference's sales schema
(one row per transaction line, keyed by ``(partner_code, store_code)``);
``pred_vs_real`` is the dashboard's prediction-vs-actual table.  The SQL text
of both views is kept beside the DataFrame code so the DuckDB oracle runs the
same definition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from storecast.session import limit_methods

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# Order inside a store series: date, then these columns (unique per store).
TIE_BREAK = ("l_orderkey", "l_linenumber", "l_partkey")
STORE_KEY = ("partner_code", "store_code")
SALES_COLUMNS = ("partner_code", "partner_name", "store_code", "store_name", "country",
                 "city", "date", "billings", "miles", "store_id") + TIE_BREAK


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    limit_methods(spark)        # the feature and scaling projections are wide
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The canonical sales fact view.

    Dimension joins are plain equi-joins: nation and region are fixed-size
    (25 and 5 rows) and broadcast by the planner's size threshold; supplier
    grows with the data, so the planner (and AQE at run time) broadcasts it
    only while it is under ``spark.sql.autoBroadcastJoinThreshold`` and falls
    back to a sort-merge join beyond it.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_shipdate")
    sp = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    na = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    rg = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = (li.join(sp, li.l_suppkey == sp.s_suppkey)
           .join(na, F.col("s_nationkey") == F.col("n_nationkey"))
           .join(rg, F.col("n_regionkey") == F.col("r_regionkey")))
    partner = F.concat(F.lit("P"), F.col("n_nationkey").cast("string"))
    store = F.col("l_suppkey").cast("string")
    return j.select(
        partner.alias("partner_code"),
        F.col("n_name").alias("partner_name"),
        store.alias("store_code"),
        F.col("s_name").alias("store_name"),
        F.col("r_name").alias("country"),
        F.concat(F.col("r_name"), F.lit("-"), (F.col("l_suppkey") % 3).cast("string")).alias("city"),
        F.col("l_shipdate").cast("date").alias("date"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("billings"),
        F.floor("l_quantity").cast("double").alias("miles"),
        F.concat(partner, F.lit("_"), store).alias("store_id"),
        "l_orderkey", "l_linenumber", "l_partkey",
    )


def series_order(*extra: str) -> list[Column]:
    """Total order of a store series: date plus the unique tie-break."""
    return [F.col("date")] + [F.col(c) for c in TIE_BREAK] + [F.col(c) for c in extra]


def store_window(*, order: bool = True) -> Window:
    w = Window.partitionBy(*STORE_KEY)
    return w.orderBy(*series_order()) if order else w


def pred_vs_real(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dashboard table: daily store sums; the prediction is the sum seven
    store-days earlier (null for a store's first seven days)."""
    day = (sales(spark, sf_dir)
           .groupBy(F.col("partner_name").alias("partner"), F.col("country").alias("pais"),
                    F.col("city").alias("ciudad"), F.col("store_id").alias("tienda"),
                    F.col("date").alias("fecha"))
           .agg(F.sum("billings").alias("ventas_reales")))
    # partner, country and city are fixed per store, so partitioning by them
    # too changes nothing, but lets filters on them move below the window
    # (and into the scans); a date filter must stay above it (the lag needs
    # the earlier days)
    w = Window.partitionBy("tienda", "partner", "pais", "ciudad").orderBy("fecha")
    return day.select(
        "partner", "pais", "ciudad", "tienda", "fecha",
        F.round("ventas_reales", 4).alias("ventas_reales"),
        F.round(F.lag("ventas_reales", 7).over(w), 4).alias("ventas_predichas"))


# ---------------------------------------------------------------------------
# SQL text of the same views, for the DuckDB oracle (and spark.sql users).
# ---------------------------------------------------------------------------

SALES_SQL = """
select concat('P', cast(n.n_nationkey as string))                          as partner_code,
       n.n_name                                                            as partner_name,
       cast(l.l_suppkey as string)                                         as store_code,
       sp.s_name                                                           as store_name,
       r.r_name                                                            as country,
       concat(r.r_name, '-', cast(l.l_suppkey % 3 as string))              as city,
       cast(l.l_shipdate as date)                                          as date,
       l.l_extendedprice * (1 - l.l_discount)                              as billings,
       cast(floor(l.l_quantity) as double)                                 as miles,
       concat('P', cast(n.n_nationkey as string), '_', cast(l.l_suppkey as string)) as store_id,
       l.l_orderkey, l.l_linenumber, l.l_partkey
from lineitem l
join supplier sp on l.l_suppkey = sp.s_suppkey
join nation n on sp.s_nationkey = n.n_nationkey
join region r on n.n_regionkey = r.r_regionkey
"""

PRED_VS_REAL_SQL = """
select partner, pais, ciudad, tienda, fecha,
       round(ventas_reales, 4) as ventas_reales,
       round(lag(ventas_reales, 7) over (partition by tienda order by fecha), 4) as ventas_predichas
from (select partner_name as partner, country as pais, city as ciudad, store_id as tienda,
             date as fecha, sum(billings) as ventas_reales
      from sales group by 1, 2, 3, 4, 5) day
"""


def with_views(sql: str) -> str:
    """Prefix a query with the ``sales`` and ``pred_vs_real`` CTEs (merged
    into the query's own ``with`` list when it has one)."""
    views = f"sales as ({SALES_SQL}), pred_vs_real as ({PRED_VS_REAL_SQL})"
    head, body = f"with {views}", sql.strip()
    if body[:15].lower() == "with recursive ":
        return f"with recursive {views},\n{body[15:]}"
    if body[:5].lower() == "with ":
        return f"{head},\n{body[5:]}"
    return f"{head}\n{body}"
