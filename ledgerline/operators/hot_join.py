"""Left join to a dimension that is too large to broadcast, with hot keys.

A shuffle join deals the rows out by key, so a key that a third of all rows
share puts a third of the rows into one task.  The keys that hold more than
one ``HOT_SHARE``-th of the rows are found by an aggregate of the key alone
(partial counts, so a hot key is one row per task).  There are fewer than
``HOT_SHARE`` of them, because their shares add up to one at most: a proven
bound.  Their dimension rows are broadcast and their facts stay where they
are; only the other facts are shuffled.

NULL keys match nothing and are not shuffled either.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.broadcast import Sized
from ledgerline.operators.materialize import materialize

HOT_SHARE = 4096


def left_join(fact: DataFrame, dim: Sized, key: str) -> DataFrame:
    """``fact`` left join ``dim`` on ``key``; broadcast under the size bound,
    else by shuffle with the hot keys split off."""
    if dim.fits_broadcast():
        return fact.join(F.broadcast(dim.df), key, "left")
    counts = fact.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    counts = materialize(counts, "keycounts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = materialize(counts.filter(F.col("n") * HOT_SHARE > total).select(key), "hotkeys")
    hot_dim = materialize(dim.df.join(F.broadcast(hot), key, "left_semi"), "hotdim")
    if Sized(hot_dim, hot_dim.count()).rows > 16 * HOT_SHARE:
        # keys with many dimension rows each: no bound on the broadcast
        return fact.join(dim.df, key, "left")
    columns = [*fact.columns, *[c for c in dim.df.columns if c != key]]
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in dim.df.schema.fields if f.name != key]
    known = fact.filter(F.col(key).isNotNull())
    parts = [
        known.join(F.broadcast(hot), key, "left_semi").join(F.broadcast(hot_dim), key, "left"),
        known.join(F.broadcast(hot), key, "left_anti").join(dim.df, key, "left"),
        fact.filter(F.col(key).isNull()).select(*fact.columns, *empty),
    ]
    out = parts[0].select(*columns)
    for p in parts[1:]:
        out = out.unionByName(p.select(*columns))
    return out
