"""Small builders shared by tests."""

import datetime as dt
from decimal import Decimal

from ledgerline.schema import RAW_SCHEMA

SF_SMOKE = "/root/testdata/sf0.001"


def D(x):
    return None if x is None else Decimal(str(x))


def raw_row(tid, date, store, city, sku, cat, price, qty, rate, gross, disc, net, margin, province="Coast"):
    day = dt.date.fromisoformat(date) if isinstance(date, str) else date
    money = [D(x) for x in (rate, gross, disc, net, margin)]
    return (tid, day, store, city, province, sku, cat, D(price), qty, *money)


SAMPLE = [
    raw_row("A-100", "2024-02-03", "N7", "Harbour", "TOY-9", "Toys", 12.5, 4, 0, 50, 0, 50, 21.25),
    raw_row("A-101", "2024-04-11", "N8", "Hilltop", "BK-2", "Books", 30, 1, 0.04, 30, 1.2, 28.8, 9.6),
    raw_row("A-102", "2024-05-19", "N7", "Harbour", "TOY-9", "Toys", 12.5, 10, 0.2, 125, 25, 100, 31.5),
]


def make_raw(spark, rows):
    """Local rows -> DataFrame in list order (one partition keeps the order
    visible to the source-order column)."""
    return spark.createDataFrame([tuple(r) for r in rows], RAW_SCHEMA).coalesce(1)


def staging_rows(spark, n, start=0):
    rows = [
        (f"T{i}", dt.date(2024, 1, 1) + dt.timedelta(days=i % 30), "S01", "X", "P", "K1", "C",
         Decimal("2.5"), 2, Decimal("0.05"), Decimal("5"), Decimal("0.25"), Decimal("4.75"), Decimal("1.1"))
        for i in range(start, start + n)
    ]
    return spark.createDataFrame(rows, RAW_SCHEMA)
