"""Point-of-sale feed derived from the TPC-H-like driver tables.

One lineitem row becomes one POS line:

* store = the supplier's nation (city) and region (province);
* product = the part, its category = ``p_type``;
* measures come from the line and its part, in exact decimals: the discount
  rate is the line's discount plus twice its tax, net revenue is the extended
  price times (1 - rate), the discount amount what that takes off, and the
  margin is net revenue less a unit cost of a third of the retail price plus
  the part's size, per piece.

``dirty=True`` injects deterministic defects keyed on ``l_orderkey`` so that
every validation step has real work to do.  Nothing is filtered: every
lineitem row is emitted.

The feed carries ``_row_seq``, a value-based source order (the adapter has no
file order), used by keep-first de-duplication.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.broadcast import Sized, sized, sized_many
from ledgerline.operators.materialize import bucket_count
from ledgerline.operators.star import unique_on
from ledgerline.schema import MONEY, RATE, RAW_COLUMNS, ROW_SEQ
from ledgerline.sources.tables import read_table

# --- fixed values: defect injection (modulus of l_orderkey) ------------------
DEFECT_NULL_STORE = 101
DEFECT_NULL_NET = 97
DEFECT_NEGATIVE_MARGIN = 89
DEFECT_RATE_ABOVE_ONE = 83
DEFECT_NULL_RATE = 79
# -----------------------------------------------------------------------------


PART_KEYS, SUPPLIER_KEYS = ("l_partkey", "p_partkey"), ("l_suppkey", "s_suppkey")
# columns that the rows and their order read in this type (or a narrower one) only
NARROW_TYPES = {"l_shipdate": "date", "l_quantity": "int", "l_discount": "decimal(18,4)", "l_tax": "decimal(18,4)"}
LINES_PER_PART = 250_000  # of the feed in source order
LINE_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate"]


def pos_feed(spark: SparkSession, sf_dir: str, dirty: bool = True) -> DataFrame:
    return _pos_rows(_lines(spark, sf_dir), _dimensions(spark, sf_dir), dirty)


def narrow_feed(spark: SparkSession, sf_dir: str, dirty: bool = True) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]] | None:
    """The lines alone, with their transaction id, and the step that makes POS
    rows of them (keeping further columns), for a shuffle by id that need not
    carry the texts of the dimensions.  None where that step would add rows
    (keys of part or supplier repeat) or shuffle itself."""
    dims = _dimensions(spark, sf_dir)
    for dim, key in zip(dims, ("p_partkey", "s_suppkey"), strict=True):
        if not (dim.fits_broadcast() and unique_on(dim.df, key)):
            return None
    return _lines(spark, sf_dir), lambda lines: _pos_rows(lines, dims, dirty)


def ordered_feed(spark: SparkSession, sf_dir: str, dirty: bool = True) -> DataFrame:
    """The feed in source order: by partition, and by row inside each.

    The lines are dealt out by range as they are.  Texts of dimensions that are
    broadcast, and everything formed from a line, come behind that shuffle; a
    dimension beyond the bound is joined before it, by a shuffle of its own.
    The sort stands after the joins, because Spark drops one below a join.
    """
    part, supplier = _dimensions(spark, sf_dir)
    li = read_table(spark, sf_dir, "lineitem")
    lines = li.select(
        "l_linenumber",
        # what the rows and their order read of these columns, in values that
        # take fewer bytes of a shuffle
        *[F.col(c).cast(NARROW_TYPES[c]).alias(c) if c in NARROW_TYPES else F.col(c) for c in LINE_COLUMNS],
    )
    joins = {True: [], False: []}
    for dim, keys in ((part, PART_KEYS), (supplier, SUPPLIER_KEYS)):
        joins[dim.fits_broadcast()].append((dim, *keys))
    order = line_order_columns()
    # a given number: these lines are so narrow that AQE would merge them into
    # partitions whose rows, with their texts, exceed the memory of a sort
    parts = min(bucket_count(spark), max(1, math.ceil(sized(li).rows / LINES_PER_PART)))
    rows = _joined(_joined(lines, joins[False]).repartitionByRange(parts, *order), joins[True])
    rows = rows.sortWithinPartitions(*order)
    return _pos_columns(rows.withColumn("transaction_id", _transaction_id()), dirty)


def _transaction_id() -> Column:
    return F.concat(F.lit("TXN"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(_transaction_id().alias("transaction_id"), *LINE_COLUMNS)


def _dimensions(spark: SparkSession, sf_dir: str) -> tuple[Sized, Sized]:
    """Part, and supplier with its nation and region."""
    # part and supplier grow with the data (TPC-H: 200k and 10k rows per SF).
    # Their row counts come from parquet footers; they are broadcast only
    # under the row bound and shuffle-joined beyond it.
    part, supplier = sized_many(
        read_table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size", "p_retailprice"),
        read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"),
    )
    # nation (25 rows) and region (5 rows) have a fixed size at every scale.
    geo = F.broadcast(
        read_table(spark, sf_dir, "nation")
        .select("n_nationkey", "n_name", "n_regionkey")
        .join(F.broadcast(read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")),
              F.col("n_regionkey") == F.col("r_regionkey"))
    )
    supplier_geo = supplier.df.join(geo, F.col("s_nationkey") == F.col("n_nationkey"))
    return part, Sized(supplier_geo, supplier.rows)


def line_order_columns() -> list[Column]:
    """The source order, from a line's own values."""
    return [
        F.col("l_shipdate").cast("date").alias("d"),
        F.col("l_partkey").alias("p"),
        F.col("l_suppkey").alias("s"),
        F.col("l_quantity").cast("int").alias("q"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("x"),
        F.col("l_discount").cast("decimal(18,4)").alias("c"),
        F.col("l_tax").cast("decimal(18,4)").alias("t"),
    ]


def line_order() -> Column:
    return F.struct(*line_order_columns())


def _joined(li: DataFrame, joins: list[tuple[Sized, str, str]]) -> DataFrame:
    # left joins: a line without its part or supplier stays in the feed, and
    # validation rejects and counts it for its missing key
    for dim, line_key, dim_key in joins:
        li = li.join(dim.for_join(), F.col(line_key) == F.col(dim_key), "left")
    return li


def _pos_rows(li: DataFrame, dims: tuple[Sized, Sized], dirty: bool) -> DataFrame:
    part, supplier = dims
    more = [c for c in li.columns if c not in ("transaction_id", *LINE_COLUMNS)]
    return _pos_columns(_joined(li, [(part, *PART_KEYS), (supplier, *SUPPLIER_KEYS)]), dirty, more)


def _pos_columns(joined: DataFrame, dirty: bool, more: list[str] = ()) -> DataFrame:
    qty = F.col("l_quantity").cast("int")
    gross = F.col("l_extendedprice").cast(MONEY)
    rate = (F.col("l_discount").cast(RATE) + F.lit(2) * F.col("l_tax").cast(RATE)).cast(RATE)
    unit_price = F.round(
        (gross.cast("double") / F.when(qty != 0, qty)).cast("decimal(18,6)"), 2
    ).cast(MONEY)
    net = F.round(gross * (F.lit(1) - rate).cast(RATE), 2).cast(MONEY)
    disc_amt = (gross - net).cast(MONEY)
    unit_cost = F.round((F.col("p_retailprice").cast(MONEY) + F.col("p_size")).cast(MONEY) / F.lit(3), 2).cast(MONEY)
    margin = (net - qty * unit_cost).cast(MONEY)

    pos = joined.select(
        "transaction_id",
        F.col("l_shipdate").cast("date").alias("txn_date"),
        F.concat(F.lit("S"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("store_id"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("province"),
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("sku"),
        F.col("p_type").alias("category"),
        unit_price.alias("unit_price"),
        qty.alias("quantity"),
        rate.alias("discount_rate"),
        gross.alias("gross_revenue"),
        disc_amt.alias("discount_amount"),
        net.alias("net_revenue"),
        margin.alias("margin"),
        F.col("l_orderkey").alias("_ok"),
        line_order().alias(ROW_SEQ),
        *more,
    )
    if dirty:
        ok = F.col("_ok")
        pos = pos.select(
            *[
                _defect(c, ok) for c in RAW_COLUMNS
            ],
            ROW_SEQ,
            *more,
        )
    else:
        pos = pos.select(*RAW_COLUMNS, ROW_SEQ, *more)
    return pos


def _defect(name: str, ok: Column) -> Column:
    c = F.col(name)
    if name == "store_id":
        c = F.when(ok % DEFECT_NULL_STORE == 0, F.lit(None).cast("string")).otherwise(c)
    elif name == "net_revenue":
        c = F.when(ok % DEFECT_NULL_NET == 0, F.lit(None).cast(MONEY)).otherwise(c)
    elif name == "margin":
        c = F.when(ok % DEFECT_NEGATIVE_MARGIN == 0, -c).otherwise(c)
    elif name == "discount_rate":
        c = (
            F.when(ok % DEFECT_RATE_ABOVE_ONE == 0, F.lit("1.5").cast(RATE))
            .when(ok % DEFECT_NULL_RATE == 0, F.lit(None).cast(RATE))
            .otherwise(c)
        )
    return c.alias(name)
