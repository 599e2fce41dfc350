"""Rolling features against pandas' own rolling semantics (second oracle):
same null pattern, values equal to 1e-9, on whole store series."""

import math

import numpy as np
import pandas as pd
import pytest

from conftest import SF_SMALL
from storecast.operators import features as FE
from storecast.plans.features_q import ROW_KEY, model_input

EPS = 1e-8


def _pandas_features(s: pd.Series) -> dict[str, pd.Series]:
    out = {}
    for n in FE.TREND_WINDOWS:
        out[f"billings_trend_{n}"] = s - s.rolling(n).mean()
    for n in FE.VOLATILITY_WINDOWS:
        out[f"billings_volatility_{n}"] = s.rolling(n).std() / s.rolling(n).mean().replace(0, EPS)
    for k in FE.MOMENTUM_LAGS:
        out[f"billings_momentum_{k}"] = s - s.shift(k)
        out[f"billings_momentum_pct_{k}"] = (s - s.shift(k)) / s.shift(k).replace(0, EPS) * 100
    for n in FE.RANK_WINDOWS:
        out[f"billings_rank_{n}"] = s.rolling(n).rank(pct=True)
    for k in FE.AUTOCORR_LAGS:
        out[f"billings_autocorr_{k}"] = s.rolling(FE.AUTOCORR_WINDOW).corr(s.shift(k))
    for n in FE.ZSCORE_WINDOWS:
        z = (s - s.rolling(n).mean()) / s.rolling(n).std().replace(0, EPS)
        out[f"billings_zscore_{n}"] = z
        out[f"billings_is_outlier_{n}"] = (np.abs(z) > 2).astype(int)
    for k in FE.LAGS:
        out[f"billings_lag_{k}"] = s.shift(k)
    for n in FE.ROLLING_WINDOWS:
        r = s.rolling(n)
        out[f"billings_rolling_{n}_mean"], out[f"billings_rolling_{n}_std"] = r.mean(), r.std()
        out[f"billings_rolling_{n}_min"], out[f"billings_rolling_{n}_max"] = r.min(), r.max()
    return out


def test_features_match_pandas(spark):
    names = FE.feature_names(FE.FAMILIES)
    got = FE.series_features(model_input(spark, SF_SMALL), "billings", FE.FAMILIES).select(
        *ROW_KEY, "billings", *names).toPandas()
    got = got.sort_values(ROW_KEY).reset_index(drop=True)
    checked = 0
    for _, g in got.groupby(["partner_code", "store_code"], sort=True):
        want = _pandas_features(g["billings"].reset_index(drop=True))
        for name in names:
            a = g[name].reset_index(drop=True).astype(float)
            b = want[name].astype(float)
            assert (a.isna() == b.isna()).all(), name
            m = ~a.isna()
            assert np.allclose(a[m], b[m], rtol=1e-9, atol=1e-9), name
            checked += int(m.sum())
    assert checked > 100_000
