"""Raw POS CSV source.

Read every column as a string under its *real* header name (a user schema
would bind columns by position and silently accept a file whose header
differs), check the required header set, normalise the usual missing-value
spellings to NULL, then cast to the staging types.  ``_row_seq`` records the
file order - (file, block start, position in the split) - so keep-first
de-duplication keeps the first copy in the file.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.validate import check_columns
from ledgerline.schema import NULL_SPELLINGS, RAW_COLUMNS, RAW_TYPES, ROW_SEQ

CSV_OPTIONS = {
    "header": "true",
    "inferSchema": "false",
    # Each file's header is checked against the first one's by name: a file
    # with reordered columns fails loudly instead of loading misaligned.
    "enforceSchema": "false",
    "mode": "FAILFAST",
}

RAW_STRING_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])


def _nullify(c: Column) -> Column:
    return F.when(~F.trim(c).isin(*NULL_SPELLINGS), c)


def _strict(name: str, text: Column, parsed: Column) -> Column:
    """``parsed``, or fail the job when present text does not parse (in ANSI
    and non-ANSI sessions alike; a silent NULL would drop the row later)."""
    bad = text.isNotNull() & parsed.isNull()
    msg = F.concat(F.lit(f"malformed value in column {name}: "), text)
    return F.when(bad, F.raise_error(msg)).otherwise(parsed)


def natural_path(path: Column) -> Column:
    """A path whose text order is the natural order: every run of digits is
    padded to 20 places, so part-99999 comes before part-100000."""
    return F.regexp_replace(F.regexp_replace(path, r"(\d+)", "0" * 20 + "$1"), r"\d*(\d{20})", "$1")


def parse_pos_strings(df: DataFrame) -> DataFrame:
    """String columns -> staging types; malformed text raises.

    In steps of one select each, so that a text that several expressions read
    is trimmed, and a number parsed, once per line.
    """
    typed = {n: t for n, t in RAW_TYPES.items() if n in df.columns and not isinstance(t, T.StringType)}
    dates = [n for n, t in typed.items() if isinstance(t, T.DateType)]
    numbers = [n for n in typed if n not in dates]
    texts = [n for n in df.columns if n in RAW_TYPES and n not in typed]
    df = df.withColumns({n: F.trim(F.col(n)) for n in typed} | {n: _nullify(F.col(n)) for n in texts})
    df = df.withColumns({n: F.when(~F.col(n).isin(*NULL_SPELLINGS), F.col(n)) for n in typed})
    # "3" and "3.0" (a float column written by pandas) both load as an integer;
    # "3.7" fails instead of losing its fraction
    wide = {f"_wide_{n}": F.col(n).try_cast("decimal(38,18)") for n in numbers}
    parsed = {f"_parsed_{n}": F.try_to_timestamp(F.col(n), F.lit("yyyy-MM-dd")).cast("date") for n in dates}
    names = df.columns
    df = df.withColumns(wide | parsed)
    df = df.withColumns({f"_parsed_{n}": F.col(f"_wide_{n}").try_cast(typed[n]) for n in numbers})
    # the number, or NULL where the type would drop digits of the text
    lossless = {n: F.col(f"_parsed_{n}").cast("decimal(38,18)") == F.col(f"_wide_{n}") for n in numbers}
    value = {n: F.col(f"_parsed_{n}") for n in dates} | {n: F.when(lossless[n], F.col(f"_parsed_{n}")) for n in numbers}
    return df.select(*[_strict(n, F.col(n), value[n]).alias(n) if n in typed else F.col(n) for n in names])


def _file_ranks(df: DataFrame) -> DataFrame:
    """The files of a scan with their rank in natural order (one row per file,
    so the path is padded once per file and not once per line)."""
    # the listing writes file:///x where the rows' metadata writes file:/x
    names = {re.sub("^file:/+", "file:/", f) for f in df.inputFiles()}
    files = df.sparkSession.createDataFrame([(f,) for f in sorted(names)], "_file string")
    return files.select("_file", F.dense_rank().over(Window.orderBy(natural_path(F.col("_file")))).alias("_rank"))


def file_order(df: DataFrame) -> DataFrame:
    """Attach ``_row_seq`` = (file, block start, position) on the scan itself.

    The file is the rank of its path, a small number instead of a long text in
    every line.  The position is ``monotonically_increasing_id``, which grows
    within each input split; it is only valid before any shuffle, hence
    directly here.
    """
    lines = df.select(
        "*",
        F.regexp_replace("_metadata.file_path", "^file:/+", "file:/").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_position"),
    )
    unknown = F.raise_error(F.concat(F.lit("file appeared during the load: "), F.col("_file"))).cast("int")
    rank = F.when(F.col("_rank").isNull(), unknown).otherwise(F.col("_rank"))
    return lines.join(F.broadcast(_file_ranks(df)), "_file", "left").select(
        *df.columns, F.struct(rank.alias("f"), F.col("_block").alias("b"), F.col("_position").alias("i")).alias(ROW_SEQ)
    )


def read_pos_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Typed raw POS lines with their file order; raises on a missing path
    (PATH_NOT_FOUND) or a missing required column."""
    df = spark.read.options(**CSV_OPTIONS).csv(path)
    check_columns(df.columns)
    return parse_pos_strings(file_order(df))
