"""Randomised series with nulls, ties and zeros against pandas rolling
semantics (the gating rules: a rolling value needs n non-null inputs; a
correlation needs 30 complete pairs), on both the plain and the split
(hot-store) layouts."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from storecast.operators import features as FE
from test_pandas_parity import _pandas_features

ROW = ["partner_code", "store_code", "date", "l_orderkey", "l_linenumber", "l_partkey"]


def _random_frame(seed=7, stores=12):
    rng = np.random.default_rng(seed)
    rows = []
    for s in range(stores):
        n = int(rng.integers(80, 220))
        y = np.round(rng.gamma(2.0, 3.0, n), 2)
        y[rng.random(n) < 0.05] = np.nan                   # missing targets
        y[rng.random(n) < 0.03] = 0.0                      # zeros (guards)
        dup = rng.random(n) < 0.1                          # repeated values (rank ties)
        y[1:][dup[1:]] = y[:-1][dup[1:]]
        # several rows per day (ordered by the tie-break inside a day)
        day = np.cumsum(rng.random(n) < 0.4)
        for i in range(n):
            rows.append(("P", f"S{s}", dt.date(2020, 1, 1) + dt.timedelta(days=int(day[i])), i, 1, 1,
                         None if np.isnan(y[i]) else float(y[i])))
    return rows


@pytest.mark.parametrize("layout", ["plain", "split"])
def test_random_series_match_pandas(spark, layout):
    df = spark.createDataFrame(_random_frame(), "partner_code string, store_code string, date date, "
                                                "l_orderkey long, l_linenumber int, l_partkey long, billings double")
    kw = {"chunk_rows": None} if layout == "plain" else {"chunk_rows": 25, "hot_rows": 50}
    names = FE.feature_names(FE.FAMILIES)
    got = FE.series_features(df, "billings", FE.FAMILIES, **kw).select(*ROW, "billings", *names).toPandas()
    got = got.sort_values(ROW).reset_index(drop=True)
    checked = 0
    for _, g in got.groupby("store_code"):
        want = _pandas_features(g["billings"].astype(float).reset_index(drop=True))
        for name in names:
            a = g[name].reset_index(drop=True).astype(float)
            b = want[name].astype(float).replace([np.inf, -np.inf], np.nan)
            assert (a.isna() == b.isna()).all(), (name, list(a.isna() != b.isna()).index(True))
            m = ~a.isna()
            assert np.allclose(a[m], b[m], rtol=1e-7, atol=1e-7), name
            checked += int(m.sum())
    assert checked > 20_000
