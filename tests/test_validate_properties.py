"""Property test: Spark validation equals a plain pandas statement of the
same semantics on random raw lines (duplicates, NULLs, negatives, rates > 1)."""

import datetime as dt
from decimal import Decimal

import pandas as pd
from tests_support import make_raw
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerline.functions.numeric import publish
from ledgerline.operators.validate import dq_report, validate
from ledgerline.schema import KEY_COLUMNS, NUMERIC_COLUMNS, RAW_COLUMNS

money = st.one_of(st.none(), st.decimals(min_value=-50, max_value=500, places=2, allow_nan=False))
rate = st.one_of(st.none(), st.decimals(min_value=-1, max_value=3, places=2, allow_nan=False))
line = st.tuples(
    st.one_of(st.none(), st.sampled_from(["T1", "T2", "T3", "T4", "T5", "T6"])),
    st.one_of(st.none(), st.just(dt.date(2024, 1, 2))),
    st.one_of(st.none(), st.sampled_from(["S01", "S02"])),
    st.just("City"),
    st.just("Prov"),
    st.one_of(st.none(), st.sampled_from(["K1", "K2"])),
    st.just("Cat"),
    money,
    st.one_of(st.none(), st.integers(min_value=-3, max_value=9)),
    rate,
    money,
    money,
    money,
    money,
)


def pandas_validate(rows):
    df = pd.DataFrame(rows, columns=RAW_COLUMNS)
    df = df.drop_duplicates(subset=["transaction_id"], keep="first")
    df = df[~df[KEY_COLUMNS].isnull().any(axis=1)].copy()
    for c in NUMERIC_COLUMNS:
        df[c] = [0 if (v is not None and v == v and v < 0) else v for v in df[c]]
    df["discount_rate"] = [1 if (v is not None and v == v and v > 1) else v for v in df["discount_rate"]]
    return df


def norm(v):
    if v is None or (isinstance(v, float) and v != v):
        return None
    if isinstance(v, (Decimal, float, int)) and not isinstance(v, bool):
        return float(v)
    return v


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(line, min_size=1, max_size=25))
def test_validate_equals_pandas_semantics(spark, rows):
    got = publish(validate(make_raw(spark, rows))).select(*RAW_COLUMNS).collect()
    want = pandas_validate(rows)
    a = sorted(tuple(norm(v) for v in r) for r in got)
    b = sorted(tuple(norm(v) for v in r) for r in want.itertuples(index=False))
    assert a == b
    rep = dq_report(make_raw(spark, rows)).first()
    assert rep["total_rows"] == len(rows)
    assert rep["rows_accepted"] == len(want)
