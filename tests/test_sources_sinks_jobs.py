"""CSV source, sinks and the four jobs end to end on the sf0.001 feed."""

import os
import tempfile

import pytest
from ledgerline.sinks import files
from tests_support import SF_SMOKE
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ledgerline.functions.numeric import publish
from ledgerline.operators.validate import validate
from ledgerline.plans import jobs
from ledgerline.plans.pipeline import Pipeline
from ledgerline.schema import RAW_COLUMNS
from ledgerline.sinks.writers import write_csv
from ledgerline.sources.pos_csv import read_pos_csv


def scratch():
    return tempfile.mkdtemp(prefix="ledgerline-test-", dir="/tmp")


def write_text(path, lines):
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


HEADER = ",".join(RAW_COLUMNS)


def test_missing_path_raises(spark):
    with pytest.raises(AnalysisException):
        read_pos_csv(spark, "/tmp/ledgerline-does-not-exist/x.csv")


def test_missing_header_column_raises(spark):
    d = scratch()
    cols = [c for c in RAW_COLUMNS if c != "net_revenue"]
    write_text(f"{d}/a.csv", [",".join(cols), ",".join(["1"] * len(cols))])
    with pytest.raises(ValueError, match="missing columns"):
        read_pos_csv(spark, f"{d}/a.csv")


def test_reordered_and_extra_columns_load_by_name(spark):
    d = scratch()
    cols = list(reversed(RAW_COLUMNS)) + ["till"]
    row = {
        "transaction_id": "T1", "txn_date": "2024-01-15", "store_id": "S01", "city": "X", "province": "P",
        "sku": "K1", "category": "C", "unit_price": "2.5", "quantity": "2", "discount_rate": "0.05",
        "gross_revenue": "5", "discount_amount": "0.25", "net_revenue": "4.75", "margin": "1.1", "till": "9",
    }
    write_text(f"{d}/a.csv", [",".join(cols), ",".join(row[c] for c in cols)])
    r = validate(read_pos_csv(spark, f"{d}/a.csv")).first().asDict()
    assert r["net_revenue"] == pytest.approx(4.75) and r["quantity"] == 2 and r["till"] == "9"


def test_null_spellings_become_null(spark):
    d = scratch()
    lines = [HEADER]
    for i, token in enumerate(["NaN", "NA", "N/A", "", "null"]):
        vals = [f"T{i}", "2024-01-15", "S01", "X", "P", "K1", "C", "2.5", "2", token, "5", "0.25", "4.75", "1.1"]
        lines.append(",".join(vals))
    write_text(f"{d}/a.csv", lines)
    out = validate(read_pos_csv(spark, f"{d}/a.csv"))
    assert out.count() == 5
    assert out.filter(F.col("discount_rate").isNull()).count() == 5


def test_keep_first_follows_file_order(spark):
    d = scratch()
    base = ["2024-01-15", "S01", "X", "P", "K1", "C", "2.5"]
    tail = ["0.05", "5", "0.25", "4.75", "1.1"]
    write_text(f"{d}/a.csv", [HEADER, ",".join(["T1", *base, "7", *tail]), ",".join(["T1", *base, "3", *tail])])
    assert validate(read_pos_csv(spark, f"{d}/a.csv")).first()["quantity"] == 7


def test_csv_round_trip_of_staging(spark):
    pipe = Pipeline(spark, SF_SMOKE)
    staging = pipe.staging
    d = scratch()
    write_csv(staging.select(*RAW_COLUMNS), f"{d}/pos")
    back = validate(read_pos_csv(spark, f"{d}/pos"))
    a = sorted(tuple(r) for r in publish(staging.select(*RAW_COLUMNS)).collect())
    b = sorted(tuple(r) for r in publish(back.select(*RAW_COLUMNS)).collect())
    assert a == b


def test_jobs_end_to_end(spark):
    d = scratch()
    raw = Pipeline(spark, SF_SMOKE).raw
    dq = jobs.run_ingest(spark, f"{d}/staging", raw=raw)
    assert dq["total_rows"] == 6000 and dq["rows_accepted"] == spark.read.parquet(f"{d}/staging").count()
    assert "loaded_at" in spark.read.parquet(f"{d}/staging").columns
    counts = jobs.run_star(spark, f"{d}/staging", f"{d}/star")
    assert counts["fact_sales"] == dq["rows_accepted"]
    assert os.path.isdir(files.current(spark, f"{d}/star")["path"] + "/fact_sales/year=1999")
    marts = jobs.run_marts(spark, f"{d}/star", f"{d}/out")
    assert marts["revenue_decomposition"] == 6 and marts["waterfall_points"] == 6
    top = jobs.run_anomaly(spark, f"{d}/star", f"{d}/out", table_name="watch_test")
    assert len(top) == 10
    assert list(top[0].keys()) == ["full_date", "store_id", "city", "net_revenue", "txn_count",
                                   "avg_discount_rate", "anomaly_score"]
    scores = [r["anomaly_score"] for r in top]
    assert scores == sorted(scores)
    wl = spark.read.option("header", True).csv(f"{d}/out/anomaly_watchlist")
    assert wl.count() == spark.read.parquet(f"{d}/out/watch_test_table").count() > 0


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("col,value", [("txn_date", "2024-13-45"), ("net_revenue", "4.7.5"), ("quantity", "two")])
def test_malformed_text_raises(spark, ansi, col, value):
    d = scratch()
    row = {
        "transaction_id": "T1", "txn_date": "2024-01-15", "store_id": "S01", "city": "X", "province": "P",
        "sku": "K1", "category": "C", "unit_price": "2.5", "quantity": "2", "discount_rate": "0.05",
        "gross_revenue": "5", "discount_amount": "0.25", "net_revenue": "4.75", "margin": "1.1",
    }
    row[col] = value
    write_text(f"{d}/a.csv", [HEADER, ",".join(row[c] for c in RAW_COLUMNS)])
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="malformed value in column"):
            validate(read_pos_csv(spark, f"{d}/a.csv")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_pipeline_release_deletes_its_tables(spark):
    p = Pipeline(spark, SF_SMOKE)
    p.star  # noqa: B018
    entries = list(p.materialized)
    tables = [x.removeprefix("table:") for x in entries if x.startswith("table:")]
    paths = [x for x in entries if not x.startswith("table:")]
    assert tables and all(spark.catalog.tableExists(t) for t in tables)
    assert paths and all(os.path.exists(x.replace("file:", "")) for x in paths)
    assert p.release() == len(paths)
    assert not any(os.path.exists(x.replace("file:", "")) for x in paths)
    assert not any(spark.catalog.tableExists(t) for t in tables)


def test_second_file_with_reordered_header_fails_loudly(spark):
    d = scratch()
    vals = {
        "transaction_id": "T1", "txn_date": "2024-01-15", "store_id": "S01", "city": "X", "province": "P",
        "sku": "K1", "category": "C", "unit_price": "2.5", "quantity": "2", "discount_rate": "0.05",
        "gross_revenue": "5", "discount_amount": "0.25", "net_revenue": "4.75", "margin": "1.1",
    }
    cols = list(RAW_COLUMNS)
    write_text(f"{d}/a.csv", [",".join(cols), ",".join(vals[c] for c in cols)])
    rev = list(reversed(cols))
    write_text(f"{d}/b.csv", [",".join(rev), ",".join(vals[c] for c in rev).replace("T1", "T2")])
    with pytest.raises(Exception, match="(?i)header|schema"):
        validate(read_pos_csv(spark, d)).collect()
