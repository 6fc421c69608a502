"""Incremental daily load as a Structured Streaming job.

New POS files dropped into a folder are picked up by a file stream; each
micro-batch is validated and appended to staging *minus* the transaction ids
staging already holds (``left_anti``).  The anti-join - not a date high-water
mark - decides, so a late file with unseen ids below the latest loaded date
still loads.  A ledger keyed by stream and epoch makes a replayed micro-batch
(after a failure between the write and the commit of the offsets) append and
count nothing twice.

``trigger(availableNow=True)`` processes what is there and stops, which is
how a daily scheduled run uses it; the stream's checkpoint remembers which
files were already read.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerline.operators.anti_join import new_rows
from ledgerline.operators.materialize import materialize, release, tracking
from ledgerline.operators.validate import add_load_time, check_columns, validate
from ledgerline.plans.maintained import apply_delivery
from ledgerline.schema import RAW_COLUMNS, ROW_SEQ
from ledgerline.sinks import files
from ledgerline.sinks.writers import write_staging_table
from ledgerline.sources.pos_csv import CSV_OPTIONS, RAW_STRING_SCHEMA, natural_path, parse_pos_strings


def ledger_path(staging_path: str) -> str:
    return staging_path.rstrip("/") + "_ledger"


LEDGER_SCHEMA = "stream string, epoch long, state string, date date, rows long, at timestamp"


def _entry(staging_path: str, stream_id: str, epoch_id: int, state: str) -> str:
    return f"{ledger_path(staging_path)}/{stream_id}-{epoch_id}-{state}.json"


def _record(spark: SparkSession, staging_path: str, entry: dict) -> None:
    stamped = entry | {"at": dt.datetime.now(dt.timezone.utc).isoformat()}
    path = _entry(staging_path, entry["stream"], entry["epoch"], entry["state"])
    files.write_text(spark, path, json.dumps(stamped))


def read_ledger(spark: SparkSession, staging_path: str) -> DataFrame | None:
    """One row per load and state: ``intent`` before its rows are appended,
    ``commit`` after.  Loads are keyed by stream and epoch."""
    if not files.has_data(spark, ledger_path(staging_path)):
        return None
    return spark.read.schema(LEDGER_SCHEMA).json(ledger_path(staging_path))


def read_high_water(spark: SparkSession, staging_path: str) -> dict | None:
    """The high-water mark over all committed loads that brought rows: latest
    txn_date, cumulative rows, number of loads and the epoch of the last."""
    ledger = read_ledger(spark, staging_path)
    if ledger is None:
        return None
    row = ledger.filter("state = 'commit' AND rows > 0").agg(
        F.max("date").alias("high_water_date"),
        F.sum("rows").alias("rows_loaded"),
        F.count(F.lit(1)).alias("loads"),
        F.max_by("epoch", "at").alias("last_epoch"),
    ).first()
    return row.asDict() if row["loads"] else None


def load_batch(
    batch: DataFrame,
    staging_path: str,
    epoch_id: int | None = None,
    staging_table: str | None = None,
    buckets: int | None = None,
    stream_id: str | None = None,
) -> int:
    """Validate one batch and append the rows staging does not hold yet.

    A load is keyed by (``stream_id``, ``epoch_id``); without an epoch it is a
    load of its own.  Its ledger says before the append what it brings (the
    intent) and after it that it is done (the commit):

    * a replay after the commit does nothing;
    * a replay after the intent appends the rows that the crashed append left
      out (the anti-join finds them) and commits the counts of the intent,
      which was made when staging held none of them;
    * a replay before the intent is the first run.

    So the high-water mark never counts a load twice, loses one, or goes
    back, also when a stream starts anew with a checkpoint of its own.  The
    mark informs; late rows below it still load, because the anti-join
    decides.  Returns the rows that the load brings (0 for a replay of a
    committed one).
    """
    spark = batch.sparkSession
    if epoch_id is None:
        stream_id, epoch_id = f"direct-{uuid.uuid4().hex}", 0
    key = (staging_path, stream_id or "direct", epoch_id)
    if files.exists(spark, _entry(*key, "commit")):
        return 0
    temp: list[str] = []
    with tracking(temp):
        entry = _append_new(spark, batch, key, staging_table, buckets)
    _record(spark, staging_path, entry | {"state": "commit"})
    release(spark, temp)  # the batch's intermediate tables
    return entry["rows"]


def _append_new(
    spark: SparkSession,
    batch: DataFrame,
    key: tuple[str, str, int],
    staging_table: str | None,
    buckets: int | None,
) -> dict:
    staging_path, stream_id, epoch_id = key
    fresh = validate(parse_pos_strings(batch))
    if staging_table:
        # bucketed by transaction_id: the anti-join never shuffles staging
        exists = spark.catalog.tableExists(staging_table)
        target = spark.table(staging_table) if exists else None
    else:
        exists = files.has_data(spark, staging_path)
        target = spark.read.parquet(staging_path) if exists else None
    if target is not None:
        fresh = new_rows(fresh, target, "transaction_id")
    # Freeze the batch's new rows first: evaluated again after the append,
    # the anti-join would find them in staging and drop them.
    seen = Observation()
    fresh = add_load_time(fresh).observe(seen, F.max("txn_date").alias("d"), F.count(F.lit(1)).alias("n"))
    fresh = materialize(fresh, "batch_new")
    planned = files.read_text(spark, _entry(*key, "intent"))
    if planned is None:
        # counted while the batch was written; no second pass, no staging scan
        date = seen.get["d"]
        entry = {"stream": stream_id, "epoch": epoch_id, "date": date and date.isoformat(), "rows": seen.get["n"]}
        _record(spark, staging_path, entry | {"state": "intent"})
    else:
        entry = {k: v for k, v in json.loads(planned).items() if k not in ("state", "at")}
    if staging_table:
        write_staging_table(fresh, staging_table, staging_path, buckets or 64, mode="append" if exists else "overwrite")
    else:
        fresh.write.mode("append").parquet(staging_path)
    return entry


def stream_id(spark: SparkSession, checkpoint_location: str) -> str:
    """The stream's own id, which its checkpoint folder keeps over restarts."""
    return json.loads(files.read_text(spark, f"{checkpoint_location.rstrip('/')}/metadata"))["id"]


def header_schema(spark: SparkSession, source_dir: str) -> T.StructType:
    """String columns in the order of the files' own header, so deliveries
    with extra or reordered columns load like in the batch reader; a missing
    required column fails.  An empty folder expects the plain columns."""
    if not files.has_data(spark, source_dir):
        return RAW_STRING_SCHEMA
    names = spark.read.options(**CSV_OPTIONS).csv(source_dir).columns
    check_columns(names)
    return T.StructType([T.StructField(c, T.StringType()) for c in names])


def _start(
    spark: SparkSession,
    source_dir: str,
    checkpoint_location: str,
    per_batch: Callable[[DataFrame, str, int], object],
    available_now: bool,
    processing_time: str | None,
) -> StreamingQuery:
    """Stream the folder's files to ``per_batch(lines, stream id, epoch)``."""
    opts = {k: v for k, v in CSV_OPTIONS.items() if k not in ("inferSchema",)}
    stream = (
        spark.readStream.schema(header_schema(spark, source_dir))
        .options(**opts)
        .csv(source_dir)
        .select(
            "*",
            F.struct(
                natural_path(F.col("_metadata.file_path")).alias("f"),
                F.col("_metadata.file_block_start").alias("b"),
                F.col("_metadata.file_size").alias("i"),
            ).alias("_file"),
        )
    )

    def ordered(batch: DataFrame, epoch_id: int) -> None:
        # File order inside the batch: (file, block) then position in the split.
        lines = batch.select(
            "*",
            F.struct(F.col("_file.f"), F.col("_file.b"), F.monotonically_increasing_id().alias("i")).alias(ROW_SEQ),
        ).select(*RAW_COLUMNS, ROW_SEQ)
        per_batch(lines, stream_id(spark, checkpoint_location), epoch_id)

    writer = stream.writeStream.foreachBatch(ordered).option("checkpointLocation", checkpoint_location)
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def start_incremental_load(
    spark: SparkSession,
    source_dir: str,
    staging_path: str,
    checkpoint_location: str,
    available_now: bool = True,
    processing_time: str | None = None,
    staging_table: str | None = None,
    buckets: int | None = None,
) -> StreamingQuery:
    """Append each new file's unseen transactions to staging."""

    def load(lines: DataFrame, stream: str, epoch: int) -> None:
        load_batch(lines, staging_path, epoch, staging_table, buckets, stream)

    return _start(spark, source_dir, checkpoint_location, load, available_now, processing_time)


def start_maintained_load(
    spark: SparkSession,
    source_dir: str,
    base: str,
    checkpoint_location: str,
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Commit each micro-batch as a delivery of the maintained star and marts
    under ``base`` (:mod:`ledgerline.plans.maintained`)."""

    def load(lines: DataFrame, stream: str, epoch: int) -> None:
        apply_delivery(spark, base, parse_pos_strings(lines), stream, epoch)

    return _start(spark, source_dir, checkpoint_location, load, available_now, processing_time)


def run_incremental_load(spark: SparkSession, source_dir: str, staging_path: str, checkpoint_location: str) -> int:
    """Process every file that is there now, then stop; returns staging rows."""
    q = start_incremental_load(spark, source_dir, staging_path, checkpoint_location, available_now=True)
    q.awaitTermination()
    if q.exception() is not None:  # pragma: no cover
        raise q.exception()
    return spark.read.parquet(staging_path).count() if files.has_data(spark, staging_path) else 0
