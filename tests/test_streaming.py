"""The streaming dashboard equals the batch reports over the same uploads."""

import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from storecast.operators import reports as R
from storecast.plans.sources_q import DASH_HEADERS
from storecast.sources import csv_io as C
from storecast.sources.tables import pred_vs_real
from storecast.streaming.dashboard_feed import start_dashboard_feed


def test_stream_matches_batch(spark):
    base = tempfile.mkdtemp(prefix="storecast-stream-")
    pvr = pred_vs_real(spark, SF_SMALL)
    # two uploads, written one after the other
    C.write_csv(pvr.filter(F.col("fecha") < "1998-01-01"), f"{base}/up", DASH_HEADERS, ";", mode="append")
    C.write_csv(pvr.filter(F.col("fecha") >= "1998-01-01"), f"{base}/up", DASH_HEADERS, ";", mode="append")
    headers = [DASH_HEADERS[c] for c in pvr.columns]
    for q in start_dashboard_feed(spark, f"{base}/up", headers, f"{base}/out", f"{base}/ckpt", sep=";"):
        q.awaitTermination(300)
    daily = spark.read.parquet(f"{base}/out/daily")
    want = R.daily_real_vs_pred(pvr)
    assert daily.exceptAll(want).count() == 0 and want.exceptAll(daily).count() == 0
    stores = spark.read.parquet(f"{base}/out/stores")
    want_s = R.store_breakdown(pvr)
    assert stores.exceptAll(want_s).count() == 0 and want_s.exceptAll(stores).count() == 0
    k = spark.read.parquet(f"{base}/out/kpis").first()
    kt = R.kpi_totals(pvr).first()
    assert k["ventas_reales_tot"] == kt["ventas_reales_tot"]
    assert abs(k["precision"] - R.kpi_precision(pvr).first()[0]) < 1e-6
