"""Guards on order, casts, distinct counts, replays and missing settings."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from tests_support import staging_rows

from ledgerline.operators import star as S
from ledgerline.plans import marts
from ledgerline.schema import RAW_COLUMNS
from ledgerline.sources.pos_csv import natural_path, read_pos_csv

HEADER = ",".join(RAW_COLUMNS)


def line(tid, city="X", qty="3", rate="0.05"):
    return f"{tid},2024-01-15,S01,{city},P,K1,C,2.5,{qty},{rate},5,0.25,4.75,1.1"


def csv_folder(tmp_path, files):
    for name, rows in files.items():
        (tmp_path / name).write_text("\n".join([HEADER, *rows]) + "\n")
    return str(tmp_path)


def test_keep_first_follows_the_natural_file_order(spark, tmp_path):
    from ledgerline.operators.validate import validate

    files = {"part-100000.csv": [line("T1", "later")], "part-99999.csv": [line("T1", "first")],
             "day10.csv": [line("T2", "later")], "day9.csv": [line("T2", "first")]}
    got = validate(read_pos_csv(spark, csv_folder(tmp_path, files))).collect()
    assert {(r.transaction_id, r.city) for r in got} == {("T1", "first"), ("T2", "first")}


def test_natural_path_orders_numbers(spark):
    names = ["a/part-9.csv", "a/part-10.csv", "a/part-99999-x2.csv", "a/part-100000-x1.csv", "b/part-1.csv"]
    df = spark.createDataFrame([(n,) for n in names], ["n"])
    assert [r.n for r in df.orderBy(natural_path(F.col("n"))).collect()] == names


@pytest.mark.parametrize("bad", [{"qty": "3.7"}, {"rate": "0.12345"}, {"qty": "x"}])
def test_lossy_values_fail(spark, tmp_path, bad):
    with pytest.raises(PySparkException, match="malformed value"):
        read_pos_csv(spark, csv_folder(tmp_path, {"a.csv": [line("T1", **bad)]})).collect()


def test_whole_floats_load(spark, tmp_path):
    row = read_pos_csv(spark, csv_folder(tmp_path, {"a.csv": [line("T1", qty="3.0", rate="0.1250")]})).first()
    assert row.quantity == 3 and str(row.discount_rate) == "0.1250"


def test_ids_written_twice_count_once(spark, tmp_path):
    from ledgerline.plans import jobs

    staging = staging_rows(spark, 20)
    staging.unionByName(staging.limit(10)).write.parquet(f"{tmp_path}/staging")
    jobs.run_star(spark, f"{tmp_path}/staging", f"{tmp_path}/star")
    star = jobs.load_star(spark, f"{tmp_path}/star")
    assert star.txn_unique is False
    assert sum(r.txn_count for r in marts.seasonality(star).collect()) == 20
    assert sum(r.txn_count for r in marts.store_pl_yearly(star).collect()) == 20


def test_surrogate_keys_are_bigint(spark):
    star = S.build_star(staging_rows(spark, 5))
    types = dict(star.fact_sales.dtypes)
    assert types["store_key"] == types["product_key"] == "bigint"


def test_run_star_reports_unresolved_keys(spark, tmp_path):
    from ledgerline.plans import jobs

    staging_rows(spark, 3).write.parquet(f"{tmp_path}/staging")
    sizes = jobs.run_star(spark, f"{tmp_path}/staging", f"{tmp_path}/star")
    assert sizes["fact_sales"] == 3 and sizes["null_store_key"] == 0


def test_the_stream_takes_extra_and_reordered_columns(spark, tmp_path):
    from ledgerline.streaming.incremental import run_incremental_load

    names = [*reversed(RAW_COLUMNS), "note"]
    rows = [dict(zip(RAW_COLUMNS, line(f"T{i}").split(","), strict=True)) | {"note": "x"} for i in range(3)]
    (tmp_path / "in").mkdir()
    text = [",".join(names), *[",".join(r[c] for c in names) for r in rows]]
    (tmp_path / "in" / "a.csv").write_text("\n".join(text) + "\n")
    assert run_incremental_load(spark, f"{tmp_path}/in", f"{tmp_path}/staging", f"{tmp_path}/ckpt") == 3
    got = spark.read.parquet(f"{tmp_path}/staging").first()
    assert (got.store_id, got.sku) == ("S01", "K1") and "note" not in got.asDict()


def test_the_seen_keys_are_distinct(spark):
    from ledgerline.operators.anti_join import new_rows

    target = spark.createDataFrame([("a",)] * 50 + [("b",)], ["k"])
    assert {r.k for r in new_rows(spark.createDataFrame([("a",), ("c",)], ["k"]), target, "k").collect()} == {"c"}


def test_a_cluster_needs_a_checkpoint_folder(monkeypatch):
    from ledgerline import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_lines_without_their_part_stay_in_the_feed(spark, tmp_path):
    from tests_support import SF_SMOKE

    from ledgerline.sources.adapter import pos_feed

    for t in ("lineitem", "supplier", "nation", "region", "part"):
        df = spark.read.parquet(f"{SF_SMOKE}/{t}.parquet")
        (df.filter("p_partkey % 2 = 0") if t == "part" else df).write.parquet(f"{tmp_path}/{t}.parquet")
    feed = pos_feed(spark, str(tmp_path), dirty=False)
    assert feed.count() == spark.read.parquet(f"{SF_SMOKE}/lineitem.parquet").count()
    assert feed.filter("sku IS NULL").count() > 0
