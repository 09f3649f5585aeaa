"""Randomised agreement with pandas for resampling and gap interpolation,
and layout round-trip properties."""

import datetime as dt
import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from voltaic.functions.interp import interpolate_linear
from voltaic.operators import timeseries


def _random_series(rng, n_series=40, length=60):
    rows = []
    for k in range(n_series):
        p_null = rng.choice([0.1, 0.4, 0.7, 0.95])
        for i in range(length):
            v = None if rng.random() < p_null else round(rng.uniform(-5, 20), 2)
            rows.append((k, i, v))
    return rows


def test_interpolation_matches_pandas_on_random_series(spark):
    rng = random.Random(7)
    rows = _random_series(rng)
    df = spark.createDataFrame(rows, "k int, i int, v double")
    got = interpolate_linear(df, "v", ["k"], "i", 3, "f").toPandas().sort_values(["k", "i"])
    pdf = pd.DataFrame(rows, columns=["k", "i", "v"]).sort_values(["k", "i"])
    want = pdf.groupby("k")["v"].transform(
        lambda s: s.interpolate(method="linear", limit=3, limit_direction="both"))
    a = got["f"].to_numpy(dtype="float64")
    b = want.to_numpy(dtype="float64")
    assert np.array_equal(np.isnan(a), np.isnan(b))
    m = ~np.isnan(a)
    assert np.allclose(a[m], b[m], rtol=0, atol=1e-9)


def test_resample_matches_pandas(spark):
    rng = random.Random(11)
    t0 = dt.datetime(2023, 1, 1)
    rows = []
    for metric in ("a", "b", "c"):
        for _ in range(120):
            ts = t0 + dt.timedelta(minutes=rng.randrange(0, 60 * 48))
            rows.append((1, metric, "FI", ts, round(rng.uniform(0, 10), 2)))
    df = spark.createDataFrame(rows, "dataset_id int, metric string, country string, "
                                     "recorded_at timestamp_ntz, value double")
    got = (timeseries.resample(df).toPandas()
           .sort_values(["metric", "recorded_at"]).reset_index(drop=True))
    pdf = pd.DataFrame(rows, columns=["dataset_id", "metric", "country", "recorded_at", "value"])
    want = (pdf.set_index("recorded_at").groupby(["dataset_id", "metric", "country"])
            .resample("1h")["value"].mean().reset_index()
            .sort_values(["metric", "recorded_at"]).reset_index(drop=True))
    assert len(got) == len(want)
    assert (got["recorded_at"].astype("datetime64[ns]").to_numpy()
            == want["recorded_at"].astype("datetime64[ns]").to_numpy()).all()
    a, b = got["value"].to_numpy(dtype="float64"), want["value"].to_numpy(dtype="float64")
    assert np.array_equal(np.isnan(a), np.isnan(b))
    assert np.allclose(a[~np.isnan(a)], b[~np.isnan(b)], atol=1e-9)


def test_layout_rewrite_keeps_multiset(spark, tmp_dir):
    from voltaic import adapters as A
    from voltaic.operators import layout
    from .conftest import SF_SMALL
    r = A.events_domain(spark, SF_SMALL).readings
    layout.write_layout(r, f"{tmp_dir}/l")
    back = spark.read.parquet(f"{tmp_dir}/l").drop("month")
    assert back.exceptAll(r).count() == 0 and r.exceptAll(back).count() == 0
    # every file holds one month and is sorted by (sensor, time)
    files = (spark.read.parquet(f"{tmp_dir}/l")
             .groupBy(F.input_file_name().alias("f")).agg(F.countDistinct("month").alias("m")))
    assert files.filter("m > 1").count() == 0


def test_chunked_interpolation_equals_whole_series(spark):
    from voltaic.functions.interp import interpolate_linear_chunked
    rng = random.Random(3)
    t0 = dt.datetime(2023, 1, 25)
    rows = []
    for k in range(6):
        p_null = rng.choice([0.2, 0.6, 0.9, 0.99])
        for h in range(24 * 70):          # ~70 days: crosses 3 month boundaries
            v = None if rng.random() < p_null else round(rng.uniform(-3, 9), 2)
            rows.append((k, t0 + dt.timedelta(hours=h), v))
    df = spark.createDataFrame(rows, "k int, ts timestamp_ntz, v double")
    a = (interpolate_linear(df, "v", ["k"], "ts", 3, "f").select("k", "ts", "f")
         .toPandas().sort_values(["k", "ts"]).reset_index(drop=True))
    b = (interpolate_linear_chunked(df, "v", ["k"], "ts", 3, "f", 3600, "month")
         .select("k", "ts", "f").toPandas().sort_values(["k", "ts"]).reset_index(drop=True))
    x, y = a["f"].to_numpy(dtype="float64"), b["f"].to_numpy(dtype="float64")
    assert len(x) == len(y)
    assert np.array_equal(np.isnan(x), np.isnan(y))
    assert np.allclose(x[~np.isnan(x)], y[~np.isnan(y)], atol=1e-9)


def test_resample_across_months_matches_pandas(spark):
    rng = random.Random(5)
    t0 = dt.datetime(2023, 1, 20)
    rows = [(1, m, "FI", t0 + dt.timedelta(minutes=rng.randrange(0, 60 * 24 * 75)),
             round(rng.uniform(0, 10), 2)) for m in ("a", "b") for _ in range(60)]
    df = spark.createDataFrame(rows, "dataset_id int, metric string, country string, "
                                     "recorded_at timestamp_ntz, value double")
    got = timeseries.resample(df).toPandas().sort_values(["metric", "recorded_at"])
    pdf = pd.DataFrame(rows, columns=["dataset_id", "metric", "country", "recorded_at", "value"])
    want = (pdf.set_index("recorded_at").groupby(["dataset_id", "metric", "country"])
            .resample("1h")["value"].mean().reset_index().sort_values(["metric", "recorded_at"]))
    assert len(got) == len(want)
    assert (got["recorded_at"].astype("datetime64[ns]").to_numpy()
            == want["recorded_at"].astype("datetime64[ns]").to_numpy()).all()
    assert got["value"].isna().sum() == want["value"].isna().sum()
