"""Calendar and rolling-window semantics against pandas (the source
pipeline's engine), computed independently on the same inputs."""

import datetime as dt
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.functions.calendar import calendar_columns
from ledgerline.operators.features import rolling_features


def test_calendar_matches_pandas_over_the_test_span(spark):
    days = pd.date_range("1995-01-01", "2001-12-31", freq="D")
    sdf = spark.createDataFrame([(d.date(),) for d in days], "d date").select(*calendar_columns(F.col("d")))
    got = sdf.toPandas().sort_values("full_date").reset_index(drop=True)
    want = pd.DataFrame({"full_date": days})
    assert (got["date_key"].to_numpy() == want["full_date"].dt.strftime("%Y%m%d").astype(int).to_numpy()).all()
    assert (got["week"].to_numpy() == want["full_date"].dt.isocalendar().week.astype(int).to_numpy()).all()
    assert (got["day_of_week"].to_numpy() == want["full_date"].dt.day_name().to_numpy()).all()
    assert (got["month_name"].to_numpy() == want["full_date"].dt.strftime("%B").to_numpy()).all()
    assert (got["is_weekend"].to_numpy() == (want["full_date"].dt.dayofweek >= 5).to_numpy()).all()
    assert (got["quarter"].to_numpy() == want["full_date"].dt.quarter.to_numpy()).all()
    fq = "FY" + want["full_date"].dt.year.astype(str) + "-Q" + want["full_date"].dt.quarter.astype(str)
    assert (got["fiscal_quarter"].to_numpy() == fq.to_numpy()).all()


store_days = st.lists(
    st.tuples(
        st.sampled_from(["S01", "S02", "S03"]),
        st.integers(min_value=0, max_value=60),
        st.integers(min_value=1, max_value=40),
        st.decimals(min_value=0, max_value=5000, places=2, allow_nan=False),
    ),
    min_size=1,
    max_size=60,
    unique_by=lambda t: (t[0], t[1]),
)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(store_days)
def test_rolling_matches_pandas_rolling(spark, rows):
    base = dt.date(2024, 1, 1)
    data = [(s, "C", base + dt.timedelta(days=d), n, Decimal(v)) for s, d, n, v in rows]
    sdf = spark.createDataFrame(data, "store_id string, city string, full_date date, txn_count long, net_revenue decimal(18,2)")
    got = rolling_features(sdf).toPandas().sort_values(["store_id", "full_date"]).reset_index(drop=True)
    pdf = pd.DataFrame(data, columns=["store_id", "city", "full_date", "txn_count", "net_revenue"])
    pdf["net_revenue"] = pdf["net_revenue"].astype(float)
    pdf = pdf.sort_values(["store_id", "full_date"]).reset_index(drop=True)
    for c in ("net_revenue", "txn_count"):
        want = pdf.groupby("store_id")[c].transform(lambda x: x.rolling(7, min_periods=3).mean())
        g = got[f"{c}_roll7"].astype(float).to_numpy()
        w = want.to_numpy()
        assert np.array_equal(np.isnan(g), np.isnan(w))
        assert np.allclose(g[~np.isnan(g)], w[~np.isnan(w)], rtol=1e-12, atol=1e-9)
        dev = got[f"{c}_deviation"].astype(float).to_numpy()
        assert np.allclose(dev[~np.isnan(dev)], (pdf[c].astype(float) - want).to_numpy()[~np.isnan(w)], atol=1e-9)
