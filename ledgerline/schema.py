"""Explicit schemas, column lists and fixed values of the retail pipeline.

Money is stored as DECIMAL(18,4) and rates as DECIMAL(9,4) so that sums are
exact and reproducible across engines; published results are DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 4)
RATE = T.DecimalType(9, 4)

# --- fixed values: the raw point-of-sale contract ---------------------------
# The 14 required raw columns, in the order the POS export writes them.
RAW_COLUMNS = [
    "transaction_id",
    "txn_date",
    "store_id",
    "city",
    "province",
    "sku",
    "category",
    "unit_price",
    "quantity",
    "discount_rate",
    "gross_revenue",
    "discount_amount",
    "net_revenue",
    "margin",
]

# Columns whose negative values are zeroed during validation.
NUMERIC_COLUMNS = [
    "unit_price",
    "quantity",
    "discount_rate",
    "gross_revenue",
    "discount_amount",
    "net_revenue",
    "margin",
]

# Rows with a null in any of these are rejected.
KEY_COLUMNS = ["transaction_id", "txn_date", "store_id", "sku", "net_revenue"]

# Strings a pandas CSV reader treats as missing by default (public pandas
# documentation); normalised to NULL before casting.
NULL_SPELLINGS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]
# -----------------------------------------------------------------------------

RAW_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("txn_date", T.DateType()),
        T.StructField("store_id", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("province", T.StringType()),
        T.StructField("sku", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("unit_price", MONEY),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("discount_rate", RATE),
        T.StructField("gross_revenue", MONEY),
        T.StructField("discount_amount", MONEY),
        T.StructField("net_revenue", MONEY),
        T.StructField("margin", MONEY),
    ]
)

RAW_TYPES = {f.name: f.dataType for f in RAW_SCHEMA.fields}

# Name of the hidden column that carries the source order ("file order").
ROW_SEQ = "_row_seq"

DIM_DATE_COLUMNS = [
    "full_date",
    "date_key",
    "year",
    "quarter",
    "month",
    "month_name",
    "week",
    "day_of_week",
    "is_weekend",
    "fiscal_year",
    "fiscal_quarter",
]
DIM_STORE_COLUMNS = ["store_key", "store_id", "city", "province"]
DIM_PRODUCT_COLUMNS = ["product_key", "sku", "category"]
FACT_COLUMNS = [
    "transaction_id",
    "date_key",
    "store_key",
    "product_key",
    "quantity",
    "unit_price",
    "discount_rate",
    "gross_revenue",
    "discount_amount",
    "net_revenue",
    "margin",
]

FEATURE_COLUMNS = ["net_revenue", "txn_count", "avg_basket", "avg_discount_rate"]
STORE_DAY_KEYS = [
    "store_id",
    "city",
    "full_date",
    "year",
    "month",
    "day_of_week",
    "is_weekend",
]
