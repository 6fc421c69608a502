"""Registered queries: each is ``(spark, sf_dir) -> DataFrame``.

Every query runs the whole pipeline over the whole driver tables in
``sf_dir``; nothing is sampled, capped or filtered to keep it cheap.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.numeric import dbl, publish, round_dbl
from ledgerline.operators import features as feat
from ledgerline.operators import star as star_ops
from ledgerline.operators import validate as V
from ledgerline.operators.materialize import materialize_bucketed, release, tracking
from ledgerline.operators.quantile import exact_quantile
from ledgerline.plans import anomaly, chart_data, fixed_forest, maintained, marts, scoped
from ledgerline.plans.pipeline import BASE_YEAR, COMPARE_YEAR, Pipeline
from ledgerline.schema import ROW_SEQ
from ledgerline.session import dropped_shuffles, ensure_checkpoint_dir
from ledgerline.sinks.writers import save_table, write_csv, write_staging
from ledgerline.sources.pos_csv import read_pos_csv
from ledgerline.sources.tables import table_path

Query = Callable[[SparkSession, str], DataFrame]
CSV_FILE_LINES = 1_000_000


_PIPELINES: dict[tuple, Pipeline] = {}


def _fingerprint(spark: SparkSession, sf_dir: str) -> tuple:
    """Sizes and modification times of the input tables, by the file system
    that the path names."""
    jvm, conf, out = spark._jvm, spark._jsc.hadoopConfiguration(), []
    for name in ("lineitem", "part", "supplier", "nation", "region"):
        path = jvm.org.apache.hadoop.fs.Path(table_path(sf_dir, name))
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            status = fs.getFileStatus(path)
            out.append((name, fs.getContentSummary(path).getLength(), status.getModificationTime()))
    return tuple(out)


def _pipe(spark: SparkSession, sf_dir: str) -> Pipeline:
    """The pipeline over ``sf_dir`` for this application.

    Staging and dimensions are written once to the shared checkpoint folder
    (like the staging and star tables of the job chain) and reused by every
    query of the same application; the key includes the inputs' sizes and
    modification times, so changed inputs rebuild.
    """
    ensure_checkpoint_dir(spark)
    key = (spark.sparkContext.applicationId, sf_dir, _fingerprint(spark, sf_dir))
    pipe = _PIPELINES.get(key)
    if pipe is None:
        pipe = Pipeline(spark, sf_dir, base_year=BASE_YEAR, compare_year=COMPARE_YEAR)
        _PIPELINES[key] = pipe
    return pipe


def build(spark: SparkSession, sf_dir: str) -> Pipeline:
    """Materialise staging and the star for ``sf_dir`` (ingest + transform)."""
    pipe = _pipe(spark, sf_dir)
    pipe.star  # noqa: B018 - forces staging and the dimensions
    return pipe


# --- marts -------------------------------------------------------------------
def revenue_decomposition(spark, sf_dir):
    return marts.revenue_decomposition(_pipe(spark, sf_dir).star, BASE_YEAR, COMPARE_YEAR)


def store_pl(spark, sf_dir):
    return marts.store_pl(_pipe(spark, sf_dir).star, BASE_YEAR, COMPARE_YEAR)


def store_pl_yearly(spark, sf_dir):
    return marts.store_pl_yearly(_pipe(spark, sf_dir).star)


def discount_leakage(spark, sf_dir):
    return marts.discount_leakage(_pipe(spark, sf_dir).star)


def seasonality(spark, sf_dir):
    return marts.seasonality(_pipe(spark, sf_dir).star)


def stored_star_seasonality(spark, sf_dir):
    """K3 over the whole star: the four tables are written (fact partitioned
    by year), read back with ``load_star`` and the seasonality mart runs on
    the stored tables; the result equals ``seasonality``."""
    from ledgerline.plans.jobs import load_star
    from ledgerline.sinks.writers import write_star

    p = _pipe(spark, sf_dir)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledgerline-star-{uuid.uuid4().hex}"
    write_star(p.star, path, clustered=True)
    p.materialized.append(path)
    return marts.seasonality(load_star(spark, path))


def seasonality_repeated_load(spark, sf_dir):
    """A star over staging that holds the lines of every March twice (a load
    that ran again): each transaction id still counts once."""
    pipe = _pipe(spark, sf_dir)
    # each line beside its copy: the rows stay in staging's buckets by id, so
    # the second star is not dealt out again
    times = F.when(F.month("txn_date") == 3, F.lit(2)).otherwise(F.lit(1))
    staging = pipe.staging.withColumn("_n", F.explode(F.sequence(F.lit(1), times))).drop("_n")
    with tracking(pipe.materialized):
        twice = materialize_bucketed(staging, "twice", "transaction_id")
        return marts.seasonality(star_ops.build_star(twice, clustered=True))


# --- sinks, written and read back ------------------------------------------------
def _sink_path(pipe: Pipeline, name: str) -> str:
    path = f"{ensure_checkpoint_dir(pipe.spark).rstrip('/')}/ledgerline-{name}-{uuid.uuid4().hex}"
    pipe.materialized.append(path)
    return path


def stored_staging(spark, sf_dir):
    """K1: staging replaced by the ingest sink (twice: the second load
    replaces the first) and read back without its load time."""
    pipe = _pipe(spark, sf_dir)
    path = _sink_path(pipe, "stored-staging")
    for _ in range(2):
        write_staging(pipe.staging, path)
    return publish(spark.read.parquet(path).drop("loaded_at"))


def stored_leakage_csv(spark, sf_dir):
    """K4: a mart exported as CSV and read back with the mart's types."""
    pipe = _pipe(spark, sf_dir)
    mart, path = marts.discount_leakage(pipe.star), _sink_path(pipe, "leakage-csv")
    write_csv(mart, path, single_file=True)
    return spark.read.option("header", True).schema(mart.schema).csv(path)


# --- validation steps (each operator on the raw feed) -------------------------
def _raw(spark, sf_dir):
    return V.conform(_pipe(spark, sf_dir).raw)


def dedup_first(spark, sf_dir):
    return publish(_pipe(spark, sf_dir).dedup_first())


def drop_null_keys(spark, sf_dir):
    return publish(V.drop_null_keys(_raw(spark, sf_dir)).drop(ROW_SEQ))


def zero_negatives(spark, sf_dir):
    return publish(V.zero_negatives(_raw(spark, sf_dir)).drop(ROW_SEQ))


def clamp_discount(spark, sf_dir):
    return publish(V.clamp_discount(_raw(spark, sf_dir)).drop(ROW_SEQ))


def validated_staging(spark, sf_dir):
    return publish(_pipe(spark, sf_dir).staging)


def csv_roundtrip_staging(spark, sf_dir):
    """S1 over the whole feed: the raw lines are exported as header CSV in
    source order, read back through the CSV source (real header check, null
    spellings, file order) and validated.  File order then equals the
    source order, so the result equals ``validated_staging``."""
    p = _pipe(spark, sf_dir)
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/ledgerline-pos-csv-{uuid.uuid4().hex}"
    p.materialized.append(path)
    # range-partitioned sort: part files are named in partition order
    feed = V.conform(p.raw_in_order()).drop(ROW_SEQ)
    # the text takes several times the bytes of the tables; a compressed file is
    # read by one task, so its lines are bounded
    options = {"header": True, "compression": "gzip", "maxRecordsPerFile": CSV_FILE_LINES}
    with dropped_shuffles(spark):
        feed.write.options(**options).csv(path)
    return publish(V.validate(read_pos_csv(spark, path)))


def dq_report(spark, sf_dir):
    return _pipe(spark, sf_dir).dq_report()


# --- star ----------------------------------------------------------------------
def dim_date(spark, sf_dir):
    return _pipe(spark, sf_dir).star.dim_date.df


def dim_store(spark, sf_dir):
    return _pipe(spark, sf_dir).star.dim_store.df


def dim_product(spark, sf_dir):
    return _pipe(spark, sf_dir).star.dim_product.df


def fact_sales(spark, sf_dir):
    return publish(_pipe(spark, sf_dir).fact)


def fk_null_audit(spark, sf_dir):
    return star_ops.fk_null_audit(_pipe(spark, sf_dir).fact)


def stage_row_counts(spark, sf_dir):
    """Row counts per stage, one row per stage (long format).

    The tables were counted while they were written; the marts are counted
    over the stored partial sums, so neither the fact nor staging is scanned.
    """
    p = _pipe(spark, sf_dir)
    star = p.summed_star
    a, b = BASE_YEAR, COMPARE_YEAR
    p.store_days  # noqa: B018 - counted when written
    known = {
        "raw_rows": p.dq["total_rows"],
        "staging_rows": p.dq["rows_accepted"],
        "dim_date_rows": star.dim_date.rows,
        "dim_store_rows": star.dim_store.rows,
        "dim_product_rows": star.dim_product.rows,
        "fact_sales_rows": star.fact_rows,
        "store_day_rows": p.store_day_rows,
    }
    parts = [
        ("revenue_decomposition_rows", marts.revenue_decomposition(star, a, b)),
        ("store_pl_rows", marts.store_pl(star, a, b)),
        ("discount_leakage_rows", marts.discount_leakage(star)),
        ("seasonality_rows", marts.seasonality(star)),
    ]
    counted = [spark.createDataFrame(list(known.items()), "stage string, row_count bigint")] + [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("stage"), "row_count")
        for n, df in parts
    ]
    return reduce(DataFrame.unionByName, counted)


# --- anomaly features ----------------------------------------------------------
def _daily(spark, sf_dir):
    return _pipe(spark, sf_dir).store_days


def store_day_features(spark, sf_dir):
    return publish(_daily(spark, sf_dir))


def rolling_features(spark, sf_dir):
    return publish(feat.rolling_features(_daily(spark, sf_dir)))


def scaled_features(spark, sf_dir):
    return feat.scaled_features(_daily(spark, sf_dir))


CONTAMINATION = 0.03


def isolation_threshold_flags(spark, sf_dir):
    """The contamination threshold step on a stand-in score (net revenue):
    offset = exact 3rd percentile; flagged when score - offset < 0."""
    daily = _daily(spark, sf_dir)
    offset = exact_quantile(daily, "net_revenue", CONTAMINATION)
    return daily.select(
        "store_id",
        "city",
        "full_date",
        dbl("net_revenue").alias("net_revenue"),
        round_dbl(F.lit(offset).cast("double"), 4).alias("threshold"),
        ((dbl("net_revenue") - F.lit(offset).cast("double")) < 0).cast("int").alias("is_flagged"),
    )


def forest_nodes(spark, sf_dir):
    """M2: every node of the fitted forest; thresholds to 9 places."""
    nodes = anomaly.forest_nodes(_daily(spark, sf_dir))
    names = ["tree_id", "node_id", "feature", "left", "right", "size", "depth"]
    return nodes.select(*names, round_dbl("threshold", 9).alias("threshold"))


def anomaly_scores(spark, sf_dir):
    return _pipe(spark, sf_dir).anomaly_scores(CONTAMINATION)


def anomaly_watchlist(spark, sf_dir):
    return anomaly.anomaly_watchlist(anomaly_scores(spark, sf_dir))


def watchlist_top10(spark, sf_dir):
    return anomaly.watchlist_top10(anomaly_watchlist(spark, sf_dir))


def _fixed(spark, sf_dir):
    pipe = _pipe(spark, sf_dir)
    if "_fixed_scores" not in pipe.__dict__:
        scores = anomaly.anomaly_scores(pipe.star, CONTAMINATION, daily=pipe.store_days, forest=fixed_forest.forest())
        pipe.__dict__["_fixed_scores"] = scores
    return pipe.__dict__["_fixed_scores"]


def fixed_forest_scores(spark, sf_dir):
    """M3/M4/M5 over every store-day with a given forest: the production
    scaling, scorer, contamination offset, rounding and flag."""
    return _fixed(spark, sf_dir).select("store_id", "city", "full_date", "anomaly_score", "is_anomaly")


def fixed_forest_watchlist(spark, sf_dir):
    """M6 with K5 and K6: the watch-list written as a table and as CSV; the
    CSV is read back and joined to the stored table."""
    pipe = _pipe(spark, sf_dir)
    watch = anomaly.anomaly_watchlist(_fixed(spark, sf_dir))
    table, csv = _sink_path(pipe, "watchlist-table"), _sink_path(pipe, "watchlist-csv")
    save_table(watch, f"watchlist_{uuid.uuid4().hex}", table)
    stored = spark.read.parquet(table)
    write_csv(stored, csv)
    keys = ["store_id", "city", "full_date"]
    back = spark.read.option("header", True).schema(stored.schema).csv(csv)
    return back.join(stored.select(*keys), keys).select(*stored.columns)


def fixed_forest_top10(spark, sf_dir):
    return anomaly.watchlist_top10(anomaly.anomaly_watchlist(_fixed(spark, sf_dir)))


# --- chart tables ----------------------------------------------------------------
def waterfall_points(spark, sf_dir):
    return chart_data.waterfall_points(revenue_decomposition(spark, sf_dir))


def discount_scatter_points(spark, sf_dir):
    leakage = marts.discount_leakage(_pipe(spark, sf_dir).star, COMPARE_YEAR)
    return chart_data.discount_scatter_points(leakage, COMPARE_YEAR)


# --- documented-only capabilities --------------------------------------------------
SCOPED_REGION = "EUROPE"
INCREMENTAL_CUTOFF = dt.date(COMPARE_YEAR, 1, 1)
INCREMENTAL_OVERLAP_DAYS = 31


def region_scoped_sales(spark, sf_dir):
    return scoped.region_scoped_sales(_pipe(spark, sf_dir).star, SCOPED_REGION)


def margin_compression_share(spark, sf_dir):
    return scoped.margin_compression_share(_pipe(spark, sf_dir).star, BASE_YEAR, COMPARE_YEAR)


def incremental_new_rows(spark, sf_dir):
    return scoped.incremental_new_rows(_pipe(spark, sf_dir).raw, INCREMENTAL_CUTOFF, INCREMENTAL_OVERLAP_DAYS)


# Deliveries of the maintained star: the feed cut at these days, each delivery
# also bringing the last days of the one before again.
DELIVERY_CUTS = (dt.date(1997, 1, 1), dt.date(COMPARE_YEAR - 1, 1, 1), dt.date(COMPARE_YEAR, 1, 1))


def _maintained(spark, sf_dir):
    """The star and marts after four overlapping deliveries, the third of
    them replayed."""
    pipe = _pipe(spark, sf_dir)
    if "_maintained" not in pipe.__dict__:
        base = _sink_path(pipe, "maintained")
        temp: list[str] = []
        with tracking(temp):
            feed, dealt = pipe.raw_by_id()
        day, overlap = F.col("txn_date"), dt.timedelta(days=INCREMENTAL_OVERLAP_DAYS)
        starts = [None, *[c - overlap for c in DELIVERY_CUTS]]
        for epoch, (lo, hi) in enumerate(zip(starts, [*DELIVERY_CUTS, None], strict=True)):
            part = feed if lo is None else feed.filter(day >= F.lit(lo))
            part = part if hi is None else part.filter(day < F.lit(hi))
            for _ in range(2 if epoch == 2 else 1):
                maintained.apply_delivery(spark, base, part, "feed", epoch, dealt)
        release(spark, temp)
        pipe.__dict__["_maintained"] = base
    return maintained.load_maintained(spark, pipe.__dict__["_maintained"])


def maintained_revenue_decomposition(spark, sf_dir):
    return marts.revenue_decomposition(_maintained(spark, sf_dir), BASE_YEAR, COMPARE_YEAR)


def maintained_store_pl_yearly(spark, sf_dir):
    return marts.store_pl_yearly(_maintained(spark, sf_dir))


def maintained_discount_leakage(spark, sf_dir):
    return marts.discount_leakage(_maintained(spark, sf_dir))


def maintained_seasonality(spark, sf_dir):
    return marts.seasonality(_maintained(spark, sf_dir))


def maintained_sales(spark, sf_dir):
    """The fact of the maintained star, resolved through its dimensions."""
    star = _maintained(spark, sf_dir)
    out = star.fact_sales
    for dim, key in ((star.dim_store, "store_key"), (star.dim_product, "product_key"), (star.dim_date, "date_key")):
        out = out.join(dim.for_join(), key)
    names = ["transaction_id", "full_date", "store_id", "city", "province", "sku", "category", "quantity", "net_revenue", "margin"]
    return publish(out.select(*names))


QUERIES: dict[str, Query] = {
    "revenue_decomposition": revenue_decomposition,
    "store_pl": store_pl,
    "store_pl_yearly": store_pl_yearly,
    "discount_leakage": discount_leakage,
    "seasonality": seasonality,
    "stored_star_seasonality": stored_star_seasonality,
    "seasonality_repeated_load": seasonality_repeated_load,
    "stored_staging": stored_staging,
    "stored_leakage_csv": stored_leakage_csv,
    "dedup_first": dedup_first,
    "drop_null_keys": drop_null_keys,
    "zero_negatives": zero_negatives,
    "clamp_discount": clamp_discount,
    "validated_staging": validated_staging,
    "csv_roundtrip_staging": csv_roundtrip_staging,
    "dq_report": dq_report,
    "dim_date": dim_date,
    "dim_store": dim_store,
    "dim_product": dim_product,
    "fact_sales": fact_sales,
    "fk_null_audit": fk_null_audit,
    "stage_row_counts": stage_row_counts,
    "store_day_features": store_day_features,
    "rolling_features": rolling_features,
    "scaled_features": scaled_features,
    "isolation_threshold_flags": isolation_threshold_flags,
    "forest_nodes": forest_nodes,
    "anomaly_scores": anomaly_scores,
    "anomaly_watchlist": anomaly_watchlist,
    "watchlist_top10": watchlist_top10,
    "fixed_forest_scores": fixed_forest_scores,
    "fixed_forest_watchlist": fixed_forest_watchlist,
    "fixed_forest_top10": fixed_forest_top10,
    "waterfall_points": waterfall_points,
    "discount_scatter_points": discount_scatter_points,
    "incremental_new_rows": incremental_new_rows,
    "region_scoped_sales": region_scoped_sales,
    "margin_compression_share": margin_compression_share,
    "maintained_revenue_decomposition": maintained_revenue_decomposition,
    "maintained_store_pl_yearly": maintained_store_pl_yearly,
    "maintained_discount_leakage": maintained_discount_leakage,
    "maintained_seasonality": maintained_seasonality,
    "maintained_sales": maintained_sales,
}
