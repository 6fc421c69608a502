"""Expressions and small helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.broadcast import Sized
from ledgerline.operators.materialize import materialize, release, tracking
from ledgerline.session import ship_package
from ledgerline.sources.tables import read_table

__all__ = ["Sized", "materialize", "release", "tracking", "ship_package", "read_table"]

SPACES = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def col(name: str) -> Column:
    """A column by its literal name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_of(name: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(col(name), F.lit(""))


def fold_ascii(c: Column) -> Column:
    """A-Z in lower case, every other character unchanged."""
    return F.translate(c, UPPER, LOWER)


def word_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(WORD)).cast("bigint")


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once per row, however often the
    body names it (an expression inside a lambda is otherwise repeated)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def read_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def boxed(docs: DataFrame, *names: str) -> DataFrame:
    """The named columns plus the whole input row as one struct ``_row``, so
    that added columns never clash with columns of the input."""
    return docs.select(*[col(n).alias(n) for n in names], F.struct(*[col(c) for c in docs.columns]).alias("_row"))


def unboxed(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col("_row").getField(c).alias(c) for c in columns])


def runs(batches: Iterator, key: list[str]) -> Iterator:
    """Rows of a sorted partition, one frame per key: (key values, frame).
    The partition must be sorted by ``key``; only one key is held at a time."""
    import pandas as pd

    held: list = []
    at = None
    for batch in batches:
        if not len(batch):
            continue
        new = (batch[key] != batch[key].shift()).any(axis=1).to_numpy()
        new[0] = True
        starts = [*map(int, new.nonzero()[0]), len(batch)]
        for a, b in zip(starts, starts[1:], strict=False):
            k = tuple(batch[c].iloc[a] for c in key)
            if held and k != at:
                yield at, pd.concat(held, ignore_index=True)
                held = []
            at = k
            held.append(batch.iloc[a:b])
    if held:
        yield at, pd.concat(held, ignore_index=True)
