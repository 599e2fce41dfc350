"""The binned KDE against the plain sum over all rows; one-pass validation."""

import math

import numpy as np
import pytest

from storecast.operators import reports as R
from storecast.operators import validation as V


@pytest.mark.parametrize("kind", ["normal", "heavy", "two", "ties"])
def test_kde_stays_inside_its_error_bound(spark, kind):
    rng = np.random.default_rng(5)
    x = {"normal": rng.normal(0, 1, 3000), "heavy": rng.pareto(2, 2000) * 1e6, "two": np.r_[rng.normal(0, 1e-3, 500), 1e3],
         "ties": rng.integers(0, 4, 800).astype(float)}[kind]
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "v double")
    n, h = len(x), x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min(), x.max(), 200)
    want = np.exp(-((grid[:, None] - x[None]) / h) ** 2 / 2).sum(1) / (n * h * math.sqrt(2 * math.pi))
    got = R.amount_kde(df, "v").orderBy("grid").collect()
    assert [r.grid for r in got] == list(range(200))
    bound = 15 / 720 * (R.KDE_STEP / 2) ** 6 + math.exp(-R.KDE_REACH ** 2 / 2)
    assert bound < 1e-15
    # the curve is rounded to 12 digits; sums of n doubles have an error of their own
    assert max(abs(r.density - w) for r, w in zip(got, want)) <= 0.51e-12 + 1e-13 * want.max()


def test_kde_of_nothing_and_of_one_value(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (None,)], "v double")
    assert R.amount_kde(df, "v").count() == 0 and R.amount_kde(df.where("v > 5"), "v").count() == 0


def test_validation_observes_its_own_write(spark, tmp_path):
    rows = [("P", str(i % 3), f"2024-01-{i % 28 + 1:02d}" if i % 10 else "never", "x" if i % 7 == 0 else str(i - 5)) for i in range(100)]
    df = spark.createDataFrame(rows, "partner_code string, store_code string, date string, billings string")
    clean, report = V.validate_and_write(df, str(tmp_path / "a"))
    plain, want = V.validate_sales(df)
    assert report.collect() == want.collect() and report.dtypes == want.dtypes
    assert clean.exceptAll(plain).count() == 0 and plain.exceptAll(clean).count() == 0
    few, report = V.validate_and_write(df.limit(3).where("date <> 'never'"), str(tmp_path / "b"))
    assert report.first().error == V.validate_sales(df.limit(3).where("date <> 'never'"))[1].first().error is not None
    assert V.validate_and_write(df.drop("date"), str(tmp_path / "c"))[0] is None


def test_validation_reads_its_input_once(spark, tmp_path):
    df = spark.createDataFrame([("P", "1", "2024-01-01", "3")] * 50, "partner_code string, store_code string, date string, billings string")
    df.write.csv(str(tmp_path / "in"), header=True)
    read = spark.sparkContext.accumulator(0)
    source = spark.read.csv(str(tmp_path / "in"), header=True, schema=df.schema)

    def count(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b
    V.validate_and_write(source.mapInArrow(count, source.schema), str(tmp_path / "out"))
    assert read.value == 50
