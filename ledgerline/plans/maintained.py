"""A star and its marts kept up to date by deliveries, without a rebuild.

Each delivery is validated, reduced to the transactions not loaded yet, and
committed as one version (:mod:`ledgerline.sinks.files`):

    staging/load_id=<version>/     the delivery's new rows        (immutable)
    fact_sales/load_id=<version>/  their fact rows                (immutable)
    version-<version>/             the small tables: dimensions, monthly
                                   partial sums (``Parts``), loads
    _current                       the pointer, switched last

The dimensions get keys for new members only, the fact gets the delivery's
rows only, and the partial sums of the delivery are merged with the stored
ones by key.  Neither the stored fact nor the partial sums' input is read
again; stored staging is scanned for the delivery's ids only (``anti_join``).
The marts then read the partial sums.

A load is known by (stream, epoch) in the table of loads, which is part of the
version: a replay of a committed load does nothing, and a crash before the
pointer is switched leaves folders that no version names.

Sums add up only while every store and product has one row in its dimension.
A delivery that gives one a second row (another city, another category) makes
earlier facts join it too; the fact is then rebuilt from staging, the partial
sums are dropped, and the marts run over the fact, as they would after a full
rebuild.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.calendar import calendar_columns
from ledgerline.functions.labels import discount_bucket
from ledgerline.operators.anti_join import new_rows
from ledgerline.operators.broadcast import Sized
from ledgerline.operators.materialize import materialize, release, tracking
from ledgerline.operators.sequence import with_row_index_counted
from ledgerline.operators.star import Parts, Star, build_fact_sales
from ledgerline.operators.validate import add_load_time, validate
from ledgerline.schema import DIM_DATE_COLUMNS, FACT_COLUMNS, RAW_COLUMNS, RAW_SCHEMA
from ledgerline.sinks import files

DIMS = {"dim_store": ("store_key", ["store_id", "city", "province"]), "dim_product": ("product_key", ["sku", "category"])}
CATEGORY_KEYS = ["category", "ym", "discount_bucket"]
STORE_KEYS = ["store_id", "city", "ym"]
# stated, so that no old file's footer is read for it
_TYPES = {f.name: f.dataType.simpleString() for f in RAW_SCHEMA.fields} | {"date_key": "int", "load_id": "string"}
SCHEMAS = {
    name: ", ".join(f"{c} {_TYPES.get(c, 'bigint')}" for c in [*columns, "load_id"])
    for name, columns in (("staging", RAW_COLUMNS), ("fact_sales", FACT_COLUMNS))
}
SUMMED = ("quantity", "gross_revenue", "discount_amount", "net_revenue", "margin", "discount_rate")


# --- partial sums -----------------------------------------------------------------
def _sums(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(
        *[F.sum(m).alias(m) for m in SUMMED],
        *[F.count(m).alias(f"n_{m}") for m in SUMMED],
        F.count(F.lit(1)).alias("n_rows"),
        F.count("transaction_id").alias("n_txn"),
    )


def parts_of(staging: DataFrame) -> Parts:
    """Partial sums of staging rows; staging holds category, store and date,
    so no dimension is joined."""
    ym = F.expr("year(txn_date) * 100 + month(txn_date)").alias("ym")
    rows = staging.select("*", ym, discount_bucket(F.col("discount_rate")).alias("discount_bucket"))
    return Parts(_sums(rows, CATEGORY_KEYS), _sums(rows, STORE_KEYS))


def merge(stored: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Add the partial sums of a delivery to the stored ones, key by key."""
    measures = [c for c in stored.columns if c not in keys]
    both = stored.unionByName(new)
    return both.groupBy(*keys).agg(*[F.sum(c).cast(stored.schema[c].dataType).alias(c) for c in measures])


# --- reading ----------------------------------------------------------------------
def _committed(spark: SparkSession, base: str, name: str, loads: Sized, columns: list[str]) -> DataFrame:
    """Rows of the loads that the version names; others' folders are skipped
    by partition pruning."""
    table = spark.read.schema(SCHEMAS[name]).parquet(f"{base}/{name}")
    return table.join(loads.for_join(), "load_id", "left_semi").select(*columns)


def _loads(spark: SparkSession, at: dict, which: str) -> Sized:
    rows = spark.read.parquet(f"{at['path']}/loads").filter(which).select("load_id")
    return Sized(rows, at["meta"]["loads"])


def load_ledger(spark: SparkSession, base: str) -> DataFrame | None:
    """(stream, epoch, load_id, rows, date, in_fact) of the committed loads."""
    at = files.current(spark, base)
    return at and spark.read.parquet(f"{at['path']}/loads")


def load_maintained(spark: SparkSession, base: str) -> Star:
    """The published star with its partial sums."""
    base = base.rstrip("/")
    at = files.current(spark, base)
    if at is None or not at["meta"]["rows"]["dim_date"]:
        raise FileNotFoundError(f"no rows were loaded into {base}")
    meta, path = at["meta"], at["path"]
    dims = {n: Sized(spark.read.parquet(f"{path}/{n}"), meta["rows"][n]) for n in ("dim_date", *DIMS)}
    fact = _committed(spark, base, "fact_sales", _loads(spark, at, "in_fact"), FACT_COLUMNS)
    parts = None
    if meta["adds_up"]:
        parts = Parts(spark.read.parquet(f"{path}/category_parts"), spark.read.parquet(f"{path}/store_parts"))
    return Star(dims["dim_date"], dims["dim_store"], dims["dim_product"], fact, meta["adds_up"], parts, meta["rows"]["fact_sales"])


# --- one delivery -----------------------------------------------------------------
def _span(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    day = F.explode(F.sequence(F.lit(first), F.lit(last), F.expr("INTERVAL 1 DAY"))).alias("d")
    return spark.range(1).select(day).select(*calendar_columns(F.col("d"))).select(*DIM_DATE_COLUMNS)


def _grow(stored: Sized | None, rows: DataFrame, key: str, natural: list[str]) -> tuple[DataFrame, int, bool]:
    """The dimension with the members that ``rows`` adds, keyed after the
    stored ones; its size; whether a stored member got a second row."""
    members = rows.select(*natural).distinct()
    before = stored.rows if stored else 0
    if stored:
        members = materialize(members.subtract(stored.df.select(*natural)), "members")  # nulls compare equal
        if not members.take(1):
            return stored.df, stored.rows, False
    keyed, added = with_row_index_counted(members, [F.col(c).asc_nulls_first() for c in natural], key, start=before + 1)
    keyed = keyed.select(F.col(key).cast("bigint").alias(key), *natural)
    if not stored:
        return keyed, added, False
    again = bool(added) and bool(keyed.join(stored.df.select(natural[0]), natural[0], "left_semi").take(1))
    return stored.df.select(key, *natural).unionByName(keyed), before + added, again


def apply_delivery(spark: SparkSession, base: str, raw: DataFrame, stream_id: str, epoch_id: int, dealt: bool = False) -> int:
    """Commit one delivery of raw POS lines; returns the rows it added, 0 for
    a load that was committed before.  ``dealt``: the lines come from a table
    in buckets by transaction id."""
    base = base.rstrip("/")
    at = files.current(spark, base)
    if at is not None:
        known = spark.read.parquet(f"{at['path']}/loads")
        if known.filter((F.col("stream") == stream_id) & (F.col("epoch") == epoch_id)).take(1):
            return 0
    temp: list[str] = []
    with tracking(temp):
        version = files.new_version(spark, base)
        rows = _commit(spark, base, at, version, validate(raw, dealt), stream_id, epoch_id)
    release(spark, temp)
    files.prune(spark, base)
    return rows


def _commit(spark, base: str, at: dict | None, version: str, valid: DataFrame, stream_id: str, epoch_id: int) -> int:
    path = files.version_path(base, version)
    meta = at["meta"] if at else {"rows": {}, "loads": 0, "adds_up": True, "first": None, "last": None}
    stored_rows = meta["rows"].get("staging", 0)
    fresh = valid.select(*RAW_COLUMNS)
    if stored_rows:
        stored = _committed(spark, base, "staging", _loads(spark, at, "rows > 0"), ["transaction_id"])
        fresh = new_rows(fresh, stored, "transaction_id")
    seen = Observation()
    fresh = add_load_time(fresh).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.min("txn_date").alias("first"), F.max("txn_date").alias("last")
    )
    own = f"{base}/staging/load_id={version}"
    fresh.write.parquet(own)
    counted = seen.get
    added = counted["rows"]
    load = {"stream": stream_id, "epoch": epoch_id, "load_id": version, "rows": added, "date": counted["last"], "in_fact": added > 0}
    loads = spark.createDataFrame([load], "stream string, epoch long, load_id string, rows long, date date, in_fact boolean")
    earlier = spark.read.parquet(f"{at['path']}/loads") if at else loads.limit(0)
    rebuilt = False
    new = dict(meta, rows=dict(meta["rows"], staging=stored_rows + added), loads=meta["loads"] + 1)
    if added:
        fresh = spark.read.parquet(own).select(*RAW_COLUMNS)
        rebuilt = _write_tables(spark, base, at if stored_rows else None, path, version, fresh, counted, new)
    elif stored_rows:  # nothing new: the small tables as they were
        for name in ("dim_date", *DIMS, *(["category_parts", "store_parts"] if meta["adds_up"] else [])):
            spark.read.parquet(f"{at['path']}/{name}").write.parquet(f"{path}/{name}")
    else:
        new["rows"] |= {"dim_date": 0, "fact_sales": 0}
    if rebuilt:  # the new fact holds the earlier loads
        earlier = earlier.withColumn("in_fact", F.lit(False))
    earlier.unionByName(loads).coalesce(1).write.parquet(f"{path}/loads")
    files.publish(spark, base, version, new, at and at["version"])
    return added


def _write_tables(spark, base: str, at: dict | None, path: str, version: str, fresh, counted: dict, new: dict) -> bool:
    first = min(counted["first"], dt.date.fromisoformat(new["first"])) if new["first"] else counted["first"]
    last = max(counted["last"], dt.date.fromisoformat(new["last"])) if new["last"] else counted["last"]
    new |= {"first": first.isoformat(), "last": last.isoformat()}
    _span(spark, first, last).coalesce(1).write.parquet(f"{path}/dim_date")
    new["rows"]["dim_date"] = (last - first).days + 1

    dims, rebuild = {}, False
    for name, (key, natural) in DIMS.items():
        stored = Sized(spark.read.parquet(f"{at['path']}/{name}"), at["meta"]["rows"][name]) if at else None
        df, size, again = _grow(stored, fresh, key, natural)
        df.write.parquet(f"{path}/{name}")
        dims[name] = Sized(spark.read.parquet(f"{path}/{name}"), size)
        new["rows"][name] = size
        rebuild |= again
        if new["adds_up"] and (not stored or size > stored.rows):
            twice = dims[name].df.groupBy(natural[0]).count().filter("count > 1")
            new["adds_up"] = not twice.take(1)

    source = fresh
    if rebuild:
        earlier = _committed(spark, base, "staging", _loads(spark, at, "rows > 0"), RAW_COLUMNS)
        source = earlier.unionByName(fresh)
    seen = Observation()
    fact = build_fact_sales(source, dims["dim_store"], dims["dim_product"])
    fact = fact.observe(seen, F.count(F.lit(1)).alias("rows"))
    fact.write.parquet(f"{base}/fact_sales/load_id={version}")
    new["rows"]["fact_sales"] = seen.get["rows"] + (0 if rebuild else new["rows"].get("fact_sales", 0))

    if new["adds_up"]:
        parts = parts_of(fresh)
        for name, part, keys in (("category", parts.category, CATEGORY_KEYS), ("store", parts.store, STORE_KEYS)):
            if at:
                part = merge(spark.read.parquet(f"{at['path']}/{name}_parts"), part, keys)
            part.write.parquet(f"{path}/{name}_parts")
    return rebuild
