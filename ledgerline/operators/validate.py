"""Validation of raw POS lines into staging.

The order is part of the semantics:
schema check -> keep-first dedup -> null-key drop -> zero negatives -> clamp rate.
A bad first copy of a transaction therefore hides a good later copy, and a
zeroed measure is not recomputed from the others.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.numeric import zero_if_negative
from ledgerline.operators.dedup import keep_first
from ledgerline.schema import KEY_COLUMNS, NUMERIC_COLUMNS, RAW_COLUMNS, RAW_TYPES, ROW_SEQ

COPIES = "_copies"


class MissingColumnsError(ValueError):
    pass


def check_columns(columns: Iterable[str]) -> None:
    """Raise if a required column is missing; extra columns are allowed."""
    missing = set(RAW_COLUMNS) - set(columns)
    if missing:
        raise MissingColumnsError(f"source is missing columns: {sorted(missing)}")


def with_source_order(df: DataFrame) -> DataFrame:
    """Attach ``_row_seq`` when the source did not provide one.

    ``monotonically_increasing_id`` follows partition order, so this is only
    meaningful directly on a scan or a local collection, never after a shuffle.
    """
    if ROW_SEQ in df.columns:
        return df
    return df.withColumn(ROW_SEQ, F.monotonically_increasing_id())


def conform(df: DataFrame) -> DataFrame:
    """Check the header, then cast the 14 columns to the staging types.

    Floating NaN becomes NULL first (pandas treats NaN as missing; Spark would
    otherwise count NaN > 1.0 as true and refuse to cast it to DECIMAL).
    Extra columns pass through unchanged.
    """
    check_columns(df.columns)
    df = with_source_order(df)
    types = dict(df.dtypes)
    out = []
    for name in df.columns:
        if name in RAW_TYPES:
            c = F.col(name)
            if types[name] in ("double", "float"):
                c = F.when(~F.isnan(c), c)
            if df.schema[name].dataType != RAW_TYPES[name]:
                c = c.cast(RAW_TYPES[name])
            out.append(c.alias(name))
        else:
            out.append(F.col(name))
    return df.select(*out)


def dedup_first(df: DataFrame, dealt: bool = False) -> DataFrame:
    """Drop repeated ``transaction_id`` rows, keeping the first in source order
    (``dealt``: rows of a table in buckets by id)."""
    return keep_first(df, "transaction_id", ROW_SEQ, dealt=dealt)


def _null_key(df_cols=KEY_COLUMNS):
    cond = None
    for k in df_cols:
        c = F.col(k).isNull()
        cond = c if cond is None else (cond | c)
    return cond


def drop_null_keys(df: DataFrame) -> DataFrame:
    return df.filter(~_null_key())


def zero_negatives(df: DataFrame) -> DataFrame:
    """Negative numeric values -> 0; NULLs stay NULL; other measures untouched."""
    return df.select(
        *[
            zero_if_negative(c).cast(df.schema[c].dataType).alias(c) if c in NUMERIC_COLUMNS else F.col(c)
            for c in df.columns
        ]
    )


def clamp_discount(df: DataFrame) -> DataFrame:
    """discount_rate > 1 -> 1; NULL stays NULL."""
    rate = F.col("discount_rate")
    clamped = F.when(rate > 1, F.lit(1)).otherwise(rate).cast(df.schema["discount_rate"].dataType)
    return df.withColumn("discount_rate", clamped)


def finish_validation(firsts: DataFrame) -> DataFrame:
    """The steps after de-duplication: null-key drop, zeroing, clamping."""
    out = clamp_discount(zero_negatives(drop_null_keys(firsts)))
    return out.drop(*[c for c in (ROW_SEQ, COPIES) if c in out.columns])


def validate(df: DataFrame, dealt: bool = False) -> DataFrame:
    """Full chain; returns the raw columns (plus extras) without ``_row_seq``."""
    return finish_validation(dedup_first(conform(df), dealt))


def first_copies(df: DataFrame) -> DataFrame:
    """Keep-first rows with their copy count (``_copies``), source order
    dropped: the one intermediate both staging and the DQ report read."""
    return keep_first(conform(df), "transaction_id", ROW_SEQ, copies_col=COPIES).drop(ROW_SEQ)


def add_load_time(df: DataFrame) -> DataFrame:
    """Audit column ``loaded_at`` (UTC timestamp of the load)."""
    return df.withColumn("loaded_at", F.current_timestamp())


def dq_report(df: DataFrame) -> DataFrame:
    """One-row data-quality report of what validation did to ``df``."""
    return dq_counts(first_copies(df))


def dq_aggregates() -> list[Column]:
    """The columns of the DQ report, over keep-first rows: the copy count
    travels with each surviving row, so the raw total needs no second scan of
    the feed.  They can be observed while those rows are written."""
    bad = _null_key()
    kept = ~bad
    aggs = [
        F.sum(COPIES).cast("bigint").alias("total_rows"),
        (F.sum(COPIES) - F.count(F.lit(1))).cast("bigint").alias("duplicates_dropped"),
        F.count_if(bad).alias("null_key_rows_dropped"),
    ]
    for c in NUMERIC_COLUMNS:
        aggs.append(F.count_if(kept & (F.col(c) < 0)).alias(f"zeroed_{c}"))
    aggs += [
        F.count_if(kept & (F.col("discount_rate") > 1)).alias("rates_clamped"),
        F.count_if(kept).alias("rows_accepted"),
        (F.sum(COPIES) - F.count_if(kept)).cast("bigint").alias("rows_dropped"),
    ]
    return [a.cast("bigint").alias(name) for a, name in zip(aggs, DQ_COLUMNS, strict=True)]


DQ_COLUMNS = [
    "total_rows", "duplicates_dropped", "null_key_rows_dropped", *[f"zeroed_{c}" for c in NUMERIC_COLUMNS],
    "rates_clamped", "rows_accepted", "rows_dropped",
]
DQ_SCHEMA = ", ".join(f"{c} bigint" for c in DQ_COLUMNS)


def dq_counts(firsts: DataFrame) -> DataFrame:
    return firsts.agg(*dq_aggregates())


def observed_report(spark: SparkSession, counts: dict) -> DataFrame:
    """The DQ report from counts observed while the rows were written (sums
    over no rows are NULL, as in the aggregate)."""
    return spark.createDataFrame([tuple(counts[c] for c in DQ_COLUMNS)], DQ_SCHEMA)


def _ddl_type(t) -> str:
    return t.simpleString()


# Column list of the staging table in DDL form (raw columns + load time).
STAGING_DDL = ", ".join(
    [f"{c} {_ddl_type(RAW_TYPES[c])}" for c in RAW_COLUMNS] + ["loaded_at timestamp"]
)
