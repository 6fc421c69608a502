"""Broadcast only behind a size check.

A dimension that is materialised (checkpointed or written) has an exact row
count that is cheap to obtain.  The size that matters for a broadcast is
bytes, so the check is ``rows x estimated row width`` of the columns actually
joined (fixed widths from the schema, a conservative width for strings)
against ``ledgerline.maxBroadcastBytes`` (default 256 MB), and the row count
against ``ledgerline.maxBroadcastRows`` (default 20M).  Beyond either bound
the join falls back to a shuffle join planned by Catalyst (and AQE may still
convert it at runtime from real shuffle statistics).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_MAX_BROADCAST_ROWS = 20_000_000
DEFAULT_MAX_BROADCAST_BYTES = 256 * 1024 * 1024
CONF_KEY = "ledgerline.maxBroadcastRows"
CONF_BYTES_KEY = "ledgerline.maxBroadcastBytes"
STRING_WIDTH = 48  # bytes assumed per string value (hash-map overhead included)


def max_broadcast_rows(df: DataFrame) -> int:
    value = df.sparkSession.conf.get(CONF_KEY, None)
    return int(value) if value else DEFAULT_MAX_BROADCAST_ROWS


def max_broadcast_bytes(df: DataFrame) -> int:
    value = df.sparkSession.conf.get(CONF_BYTES_KEY, None)
    return int(value) if value else DEFAULT_MAX_BROADCAST_BYTES


def row_width(schema: T.StructType) -> int:
    """Estimated in-memory bytes per row of a broadcast hash relation."""
    width = 16  # row header and hash-map entry
    for f in schema.fields:
        t = f.dataType
        if isinstance(t, (T.StringType, T.BinaryType)):
            width += STRING_WIDTH
        elif isinstance(t, T.DecimalType):
            width += 8 if t.precision <= 18 else 24
        elif isinstance(t, (T.ArrayType, T.MapType, T.StructType)):
            width += 4 * STRING_WIDTH
        else:
            width += 8  # fixed-width values take one 8-byte slot in a row
    return width


class Sized:
    """A DataFrame together with its known row count."""

    def __init__(self, df: DataFrame, rows: int):
        self.df = df
        self.rows = rows

    @property
    def estimated_bytes(self) -> int:
        return self.rows * row_width(self.df.schema)

    def fits_broadcast(self, max_rows: int | None = None) -> bool:
        row_limit = max_rows if max_rows is not None else max_broadcast_rows(self.df)
        return self.rows <= row_limit and self.estimated_bytes <= max_broadcast_bytes(self.df)

    def for_join(self, max_rows: int | None = None) -> DataFrame:
        return F.broadcast(self.df) if self.fits_broadcast(max_rows) else self.df

    def __repr__(self) -> str:  # pragma: no cover
        return f"Sized(rows={self.rows}, ~{self.estimated_bytes} bytes)"


def sized(df: DataFrame) -> Sized:
    """Count a materialised (checkpointed/cached/written) DataFrame."""
    return Sized(df, df.count())


def sized_many(*dfs: DataFrame) -> list[Sized]:
    """Count several materialised DataFrames in one job."""
    from functools import reduce

    counted = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(i).alias("i"), "n") for i, df in enumerate(dfs)]
    rows = {r["i"]: r["n"] for r in reduce(DataFrame.unionByName, counted).collect()}
    return [Sized(df, rows[i]) for i, df in enumerate(dfs)]
