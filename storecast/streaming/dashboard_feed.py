"""Incremental dashboard: the reference recomputes its KPIs, daily series
and store breakdown each time a CSV is uploaded; here the upload folder is a
Structured Streaming file source and the same aggregates are maintained as
streaming state.

Every micro-batch applies the upload rules of ``csv_io.load_pred_vs_real``
(trimmed lower-case headers, aliases, coerced date and numbers, rows without
a date dropped).  The aggregates are keyed by date, by store and globally,
so the state is bounded by days and stores, not by uploaded rows.  Each
output is re-written by ``foreachBatch`` from the complete aggregate, and
the checkpoint location (in the shared folder) makes a restarted query
resume where it stopped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from storecast.sources.csv_io import normalize_upload


def _aggregates(df: DataFrame) -> dict[str, DataFrame]:
    ape = F.abs((F.col("ventas_reales") - F.col("ventas_predichas"))
                / F.when(F.col("ventas_reales") != 0, F.col("ventas_reales")))
    both = F.col("ventas_reales").isNotNull() & F.col("ventas_predichas").isNotNull()
    return {
        "daily": df.groupBy("fecha").agg(F.sum("ventas_reales").alias("ventas_reales"),
                                         F.sum("ventas_predichas").alias("ventas_predichas")),
        "stores": df.dropna(subset=["partner", "pais", "ciudad", "tienda"])
                    .groupBy("partner", "pais", "ciudad", "tienda")
                    .agg(F.sum("ventas_reales").alias("ventas_reales"),
                         F.sum("ventas_predichas").alias("ventas_predichas")),
        "kpis": df.agg(F.sum("ventas_reales").alias("ventas_reales_tot"),
                       F.sum("ventas_predichas").alias("ventas_pred_tot"),
                       F.sum(F.when(both, ape)).alias("_ape_sum"),
                       F.count(F.when(both, ape)).alias("_ape_n")),
    }


def _finish(name: str, df: DataFrame) -> DataFrame:
    """Final projection of each aggregate (same rounding and null rules as
    the batch reports)."""
    if name == "kpis":
        mape = F.col("_ape_sum") / F.when(F.col("_ape_n") > 0, F.col("_ape_n"))
        return df.select(F.round(F.coalesce("ventas_reales_tot", F.lit(0.0)), 4).alias("ventas_reales_tot"),
                         F.round(F.coalesce("ventas_pred_tot", F.lit(0.0)), 4).alias("ventas_pred_tot"),
                         F.round(F.when(mape.isNotNull(), F.greatest(F.lit(0.0), 1 - mape)), 6).alias("precision"))
    keys = ["fecha"] if name == "daily" else ["partner", "pais", "ciudad", "tienda"]
    return df.select(*keys, *[F.round(F.coalesce(c, F.lit(0.0)), 4).alias(c)
                              for c in ("ventas_reales", "ventas_predichas")])


def start_dashboard_feed(spark: SparkSession, upload_dir: str, headers: Sequence[str], out_dir: str,
                         checkpoint_dir: str, sep: str = ",", available_now: bool = True
                         ) -> list[StreamingQuery]:
    """Start one streaming query per aggregate (daily, stores, kpis).

    ``headers`` are the raw upload column names (a streaming source needs its
    schema up front).  With ``available_now`` the queries process what is in
    the folder and stop; otherwise they keep watching it."""
    schema = StructType([StructField(h, StringType()) for h in headers])
    raw = (spark.readStream.schema(schema).option("header", True).option("sep", sep)
           .option("maxFilesPerTrigger", 100).csv(upload_dir))
    rows = normalize_upload(raw)
    queries = []
    for name, agg in _aggregates(rows).items():
        def write(batch: DataFrame, epoch: int, name=name) -> None:
            _finish(name, batch).write.mode("overwrite").parquet(f"{out_dir}/{name}")
        w = (agg.writeStream.outputMode("complete").foreachBatch(write)
             .option("checkpointLocation", f"{checkpoint_dir}/{name}"))
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
        queries.append(w.start())
    return queries
