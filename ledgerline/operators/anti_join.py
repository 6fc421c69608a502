"""Rows of a (small) new delivery whose key a (huge) table does not hold yet.

A plain ``left_anti`` join shuffles both sides on the key, i.e. the whole
target table on every load.  Here the delivery's distinct keys are counted
first; under the broadcast bound (rows and estimated bytes) they are broadcast into a map-side semi-join
that keeps only the target rows sharing a key (made distinct), and the anti-join then runs between two small sides.
The target is scanned but never shuffled.  Above the bound it falls back to
the shuffle anti-join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.broadcast import Sized
from ledgerline.operators.materialize import materialize


def new_rows(delivery: DataFrame, target: DataFrame, key: str, max_rows: int | None = None) -> DataFrame:
    # the delivery is read twice (its keys, then the anti-join): write it once
    delivery = materialize(delivery, "delivery")
    keys = materialize(delivery.select(key).filter(F.col(key).isNotNull()).distinct(), "delivery_keys")
    sized_keys = Sized(keys, keys.count())
    if not sized_keys.fits_broadcast(max_rows):
        return delivery.join(target.select(key), key, "left_anti")
    # distinct: at most one row per delivery key, so bounded like the keys
    seen = target.select(key).join(F.broadcast(keys), key, "left_semi").distinct()
    return delivery.join(F.broadcast(seen), key, "left_anti")
