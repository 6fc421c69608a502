"""Keep-first de-duplication on a key.

``row_number() OVER (PARTITION BY key ORDER BY seq) = 1`` sends every copy of
a key to one task, so a key holding a third of the rows would serialise the
job.  A plain aggregate (``min_by`` over the source order) reduces the copies
on the map side, but its buffer is a row, so Spark sorts all rows of a map
task by key first: with large input splits that sort spills the whole feed.

Here the rows are dealt out by key as they are and aggregated behind that
shuffle, in partitions of bounded size.  Keys that hold many rows are split
off: the rows are counted by a hash of their key into ``SLOTS`` slots (a hash
aggregate of fixed size), and rows of slots with more than one
``HOT_SHARE``-th of all rows are reduced on the map side first.  There are
fewer than ``HOT_SHARE`` such slots, because their shares add up to one.

NULL keys form one group, matching pandas ``drop_duplicates``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = 1 << 16
HOT_SHARE = 4096
HOT_ROWS = 100_000  # a slot with fewer rows is never worth splitting off


def _slot(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(SLOTS)).cast("int")


def hot_slots(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> list[int]:
    """Slots of the key's hash that hold too many rows for one task."""
    counts = df.groupBy(_slot(key).alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    both = counts.filter(F.col("n") > hot_rows).crossJoin(F.broadcast(counts.agg(F.sum("n").alias("total"))))
    return [r["slot"] for r in both.filter(F.col("n") * HOT_SHARE > F.col("total")).select("slot").collect()]


def keep_first(
    df: DataFrame,
    key: str,
    order: str | Column,
    copies_col: str | None = None,
    hot_rows: int = HOT_ROWS,
    dealt: bool = False,
) -> DataFrame:
    """One row per ``key``: the row with the smallest ``order``.

    The result keeps all input columns (including an ``order`` column; an
    ``order`` expression is formed behind the shuffle).  With ``copies_col``
    set, also returns how many input rows shared the key.  ``dealt`` is for
    rows of a table in buckets by ``key``: they are aggregated where they are.
    """
    if dealt:
        return _firsts(df, key, order, copies_col)
    hot = hot_slots(df, key, hot_rows)
    if not hot:
        return _firsts(df.repartition(F.col(key)), key, order, copies_col)
    slots = F.broadcast(df.sparkSession.createDataFrame([(s,) for s in hot], "_slot int"))
    rows = df.withColumn("_slot", _slot(key))
    rest = rows.join(slots, "_slot", "left_anti").select(*df.columns)
    many = rows.join(slots, "_slot", "left_semi").select(*df.columns)
    firsts = _firsts(rest.repartition(F.col(key)), key, order, copies_col)
    return firsts.unionByName(_firsts(many, key, order, copies_col))


def _firsts(df: DataFrame, key: str, order: str | Column, copies_col: str | None) -> DataFrame:
    payload = [c for c in df.columns if c != key]
    aggs = [F.min_by(F.struct(*payload), F.col(order) if isinstance(order, str) else order).alias("_first")]
    if copies_col:
        aggs.append(F.count(F.lit(1)).alias(copies_col))
    out = df.groupBy(key).agg(*aggs)
    cols = {key: F.col(key)} | {c: F.col(f"_first.{c}").alias(c) for c in payload}
    # the input column order
    return out.select(*[cols[c] for c in df.columns], *([copies_col] if copies_col else []))
