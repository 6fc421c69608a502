"""Calendar attributes of a DATE column (all built-in, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(d: Column) -> Column:
    """Integer yyyymmdd."""
    return F.date_format(d, "yyyyMMdd").cast("int")


def month_name(d: Column) -> Column:
    """Full English month name, e.g. January."""
    return F.date_format(d, "MMMM")


def day_name(d: Column) -> Column:
    """Full English weekday name, e.g. Monday."""
    return F.date_format(d, "EEEE")


def iso_week(d: Column) -> Column:
    return F.weekofyear(d)


def is_weekend(d: Column) -> Column:
    """Saturday or Sunday (``weekday`` is Monday=0)."""
    return F.weekday(d) >= 5


def fiscal_quarter(year: Column, quarter: Column) -> Column:
    """Fiscal year equals the calendar year: FY2024-Q1."""
    return F.concat(F.lit("FY"), year.cast("string"), F.lit("-Q"), quarter.cast("string"))


def calendar_columns(d: Column) -> list[Column]:
    """The dim_date attribute columns for a DATE column, in table order."""
    year = F.year(d)
    quarter = F.quarter(d)
    return [
        d.alias("full_date"),
        date_key(d).alias("date_key"),
        year.alias("year"),
        quarter.alias("quarter"),
        F.month(d).alias("month"),
        month_name(d).alias("month_name"),
        iso_week(d).alias("week"),
        day_name(d).alias("day_of_week"),
        is_weekend(d).alias("is_weekend"),
        year.alias("fiscal_year"),
        fiscal_quarter(year, quarter).alias("fiscal_quarter"),
    ]
