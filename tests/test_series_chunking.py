"""Hot-store splitting must give exactly the unsplit features."""

from pyspark.sql import functions as F

from storecast.operators import features as FE
from storecast.plans.features_q import ROW_KEY, model_input

from conftest import SF_SMALL


def _rows(df, cols):
    return sorted(tuple(None if v is None else (round(v, 9) if isinstance(v, float) else v)
                        for v in r) for r in df.select(*cols).collect())


def test_chunked_equals_plain(spark):
    x = model_input(spark, SF_SMALL)
    names = FE.feature_names(FE.FAMILIES)
    plain = FE.series_features(x, "billings", FE.FAMILIES, chunk_rows=None)
    # every store (545-640 rows) is hot; chunks of ~40 rows are smaller than
    # the 59-row lookback, so halos span several chunks
    split = FE.series_features(x, "billings", FE.FAMILIES, chunk_rows=40, hot_rows=100)
    assert split.count() == plain.count() == x.count()
    cols = ROW_KEY + names
    assert _rows(split, cols) == _rows(plain, cols)


def test_chunking_actually_splits(spark):
    from storecast.operators.series import chunk_series
    x = model_input(spark, SF_SMALL)
    c = chunk_series(x, ["partner_code", "store_code"], "date", FE.LOOKBACK, chunk_rows=200,
                     hot_rows=100)
    per_store = c.filter("_home").groupBy("store_code").agg(F.countDistinct("_chunk").alias("k"))
    assert per_store.agg(F.min("k")).first()[0] >= 2
    # halo copies exist and are never home rows of their target chunk
    assert c.filter(~F.col("_home")).count() > 0
    assert c.filter("_home").count() == x.count()


def test_fill_chunked_equals_plain(spark):
    x = model_input(spark, SF_SMALL)
    f = FE.series_features(x, "billings", ["autocorr", "rank"], chunk_rows=None)
    cols = [c for c in f.columns if c.startswith("billings_autocorr") or c.startswith("billings_rank")]
    plain = FE.bfill_ffill_zero(f, cols, chunk_rows=None)
    split = FE.bfill_ffill_zero(f, cols, chunk_rows=40, hot_rows=100)
    assert _rows(split, ROW_KEY + cols) == _rows(plain, ROW_KEY + cols)


def test_positions_chunked_equals_plain(spark):
    from storecast.operators.series import positions
    x = model_input(spark, SF_SMALL)
    order = ["date", "l_orderkey", "l_linenumber", "l_partkey"]
    a = positions(x, ["partner_code", "store_code"], order, chunk_rows=None)
    b = positions(x, ["partner_code", "store_code"], order, chunk_rows=40, hot_rows=100)
    cols = ROW_KEY + ["_pos", "_cnt"]
    assert _rows(a, cols) == _rows(b, cols)


def test_pipeline_with_every_store_hot(spark, monkeypatch):
    """End to end (features -> split -> predictions -> per-store metrics)
    with every store split into small chunks equals the unsplit run."""
    from storecast.operators import evaluation as EV
    from storecast.operators import series
    from storecast.plans.evaluation_q import predictions
    plain = EV.model_results(predictions(spark, SF_SMALL))
    cols = plain.columns
    want = _rows(plain, cols)
    monkeypatch.setattr(series, "DEFAULT_CHUNK_ROWS", 60)     # every store (545-640 rows) is hot
    hot = series.hot_keys(model_input(spark, SF_SMALL), ["partner_code", "store_code"], "date", 60)
    assert hot is not None and hot.count() == 10
    split = EV.model_results(predictions(spark, SF_SMALL))
    assert _rows(split, cols) == want


def test_one_huge_day_is_split_and_halo_is_exact(spark):
    """One store-day of 100 chunks: groups stay near a chunk plus the halo."""
    from storecast.operators.series import chunk_series
    n, chunk = 20_000, 200
    rows = spark.range(n).select(
        F.lit("P").alias("partner_code"), F.lit("S").alias("store_code"), F.lit("2024-01-02").cast("date").alias("date"),
        F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), F.lit(1).alias("l_partkey"),
        (F.sin("id") + 2).alias("billings"))
    rows = rows.unionByName(rows.limit(30).withColumn("date", F.lit("2024-01-01").cast("date")))
    order = ["date", "l_orderkey", "l_linenumber", "l_partkey"]
    c = chunk_series(rows, ["partner_code", "store_code"], order, FE.LOOKBACK, chunk_rows=chunk).cache()
    sizes = c.groupBy("_chunk").agg(F.count("*").alias("n"), F.count_if(~F.col("_home")).alias("halo")).collect()
    assert sum(r.n - r.halo for r in sizes) == n + 30 and len(sizes) >= 70
    assert max(r.n for r in sizes) <= 1.5 * chunk + FE.LOOKBACK
    assert all(r.halo == (FE.LOOKBACK if r["_chunk"] else 0) for r in sizes)
    names = FE.feature_names(FE.FAMILIES)
    plain = FE.series_features(rows, "billings", FE.FAMILIES, chunk_rows=10**9)
    split = FE.series_features(rows, "billings", FE.FAMILIES, chunk_rows=chunk)
    assert _rows(split, order + names) == _rows(plain, order + names)
