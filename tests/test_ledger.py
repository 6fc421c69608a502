"""Loads into staging: replays, crashes and new checkpoints."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from tests_support import staging_rows

from ledgerline.sinks import files
from ledgerline.streaming import incremental as inc


def line(tid, date="2024-05-01"):
    return (tid, date, "S01", "X", "P", "K1", "C", "2.5", "1", "0.05", "5", "0.25", "4.75", "1.1")


def batch(spark, lines):
    return spark.createDataFrame(lines, inc.RAW_STRING_SCHEMA).withColumn("_row_seq", F.struct(F.lit(1).alias("i")))


def mark(spark, staging):
    m = inc.read_high_water(spark, staging)
    return m and (m["high_water_date"], m["rows_loaded"], m["loads"], m["last_epoch"])


def test_epoch_zero_of_a_new_checkpoint_does_not_replace_the_first(spark, tmp_path):
    staging = f"{tmp_path}/staging"
    assert inc.load_batch(batch(spark, [line(f"T{i}") for i in range(3)]), staging, 0, stream_id="a") == 3
    assert inc.load_batch(batch(spark, [line("T9", "2024-04-01")]), staging, 0, stream_id="b") == 1
    assert spark.read.parquet(staging).count() == 4
    assert mark(spark, staging) == (dt.date(2024, 5, 1), 4, 2, 0)
    # calls without an epoch are loads of their own
    assert inc.load_batch(batch(spark, [line("U1", "2024-03-01")]), staging) == 1
    assert inc.load_batch(batch(spark, [line("U1", "2024-03-01")]), staging) == 0
    assert mark(spark, staging)[:2] == (dt.date(2024, 5, 1), 5)


@pytest.mark.parametrize("where", ["before intent", "before append", "in append", "before commit"])
def test_a_crash_at_any_step_is_replayed(spark, tmp_path, monkeypatch, where):
    from pyspark.sql.readwriter import DataFrameWriter

    staging = f"{tmp_path}/staging"
    inc.load_batch(batch(spark, [line("T0", "2024-01-15")]), staging, 6, stream_id="s")
    lines = batch(spark, [line(f"T{i}") for i in range(4)])  # T0 is a replay of epoch 6's row
    append, record = DataFrameWriter.parquet, inc._record

    def crash_append(self, path, *args, **kwargs):
        if path == staging:
            if where == "in append":  # some of the rows became visible
                append(spark.read.parquet(staging).withColumn("transaction_id", F.lit("T2"))
                       .withColumn("txn_date", F.lit(dt.date(2024, 5, 1))).coalesce(1).write.mode("append"), path)
            raise RuntimeError("lost")
        return append(self, path, *args, **kwargs)

    def crash_record(spark, staging, entry):
        if entry["state"] == {"before intent": "intent", "before commit": "commit"}[where]:
            raise RuntimeError("lost")
        record(spark, staging, entry)

    if where.endswith("append"):
        monkeypatch.setattr(DataFrameWriter, "parquet", crash_append)
    else:
        monkeypatch.setattr(inc, "_record", crash_record)
    with pytest.raises(RuntimeError, match="lost"):
        inc.load_batch(lines, staging, 7, stream_id="s")
    monkeypatch.undo()
    assert mark(spark, staging) == (dt.date(2024, 1, 15), 1, 1, 6)
    for brings in (3, 0):  # the replay, and one more
        assert inc.load_batch(lines, staging, 7, stream_id="s") == brings
        ids = sorted(r.transaction_id for r in spark.read.parquet(staging).collect())
        assert ids == ["T0", "T1", "T2", "T3"]
        assert mark(spark, staging) == (dt.date(2024, 5, 1), 4, 2, 7)


def test_streams_name_their_loads_by_their_checkpoint(spark, tmp_path):
    from ledgerline.schema import RAW_COLUMNS

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(",".join(RAW_COLUMNS) + "\n" + ",".join(line("T1")) + "\n")
    staging = f"{tmp_path}/staging"
    for k in range(2):
        assert inc.run_incremental_load(spark, f"{tmp_path}/in", staging, f"{tmp_path}/ckpt{k}") == 1
    ledger = inc.read_ledger(spark, staging).filter("state = 'commit'").collect()
    assert sorted(r.rows for r in ledger) == [0, 1] and len({r.stream for r in ledger}) == 2
    assert mark(spark, staging)[:2] == (dt.date(2024, 5, 1), 1)


# --- versions of the star ---------------------------------------------------------
def test_a_reader_between_two_writes_sees_one_whole_version(spark, tmp_path, monkeypatch):
    from ledgerline.plans import jobs, marts

    base = f"{tmp_path}/star"
    staging_rows(spark, 20).write.parquet(f"{tmp_path}/one")
    staging_rows(spark, 50).withColumn("city", F.lit("Y")).write.parquet(f"{tmp_path}/two")
    jobs.run_star(spark, f"{tmp_path}/one", base)
    before = jobs.load_star(spark, base)

    def whole(star):
        rows = marts.store_pl_yearly(star).collect()
        return [(r.city, r.txn_count) for r in rows], star.fact_sales.count(), star.fact_rows

    assert whole(before) == ([("X", 20)], 20, 20)
    publish = files.publish
    seen = []

    def late(*args):  # all tables are written, the pointer is not switched
        seen.append(whole(jobs.load_star(spark, base)))
        raise RuntimeError("lost")

    monkeypatch.setattr(files, "publish", late)
    with pytest.raises(RuntimeError, match="lost"):
        jobs.run_star(spark, f"{tmp_path}/two", base)
    monkeypatch.setattr(files, "publish", publish)
    assert seen == [whole(jobs.load_star(spark, base))] == [([("X", 20)], 20, 20)]
    jobs.run_star(spark, f"{tmp_path}/two", base)
    assert whole(jobs.load_star(spark, base)) == ([("Y", 50)], 50, 50)
    assert whole(before) == ([("X", 20)], 20, 20)  # a reader of the old version goes on


def test_a_second_writer_is_found(spark, tmp_path):
    base = f"{tmp_path}/t"
    one = files.new_version(spark, base)
    files.publish(spark, base, one, {}, None)
    files.publish(spark, base, "00000002-x", {"a": 1}, one)
    with pytest.raises(files.StaleVersion):
        files.publish(spark, base, "00000003-y", {}, one)
    assert files.current(spark, base)["meta"] == {"a": 1}


def test_stored_ids_are_checked_without_an_exchange(spark, tmp_path, monkeypatch):
    """Bucket by bucket while the star is written; not at all when it is read."""
    import ledgerline.sinks.writers as writers
    from ledgerline.operators import star as S
    from ledgerline.plans import jobs

    plans = []

    def checked(df, key):
        plans.append(df.groupBy(key).count()._jdf.queryExecution().executedPlan().toString())
        return S.unique_on(df, key)

    monkeypatch.setattr(writers, "unique_on", checked)
    staging = staging_rows(spark, 300)
    staging.unionByName(staging.limit(10)).write.parquet(f"{tmp_path}/staging")
    jobs.run_star(spark, f"{tmp_path}/staging", f"{tmp_path}/star")
    assert len(plans) == 1 and "Exchange" not in plans[0] and "Bucketed: true" in plans[0]
    monkeypatch.setattr(jobs, "unique_on", lambda *a: pytest.fail("the ids are known"))
    star = jobs.load_star(spark, f"{tmp_path}/star")
    assert star.txn_unique is False and star.fact_rows == 310


def test_the_pipeline_shuffles_rows_by_id_once(spark):
    from tests_support import SF_SMOKE

    from ledgerline.operators.star import build_fact_sales
    from ledgerline.plans.pipeline import Pipeline

    p = Pipeline(spark, SF_SMOKE)
    fact = build_fact_sales(p.staging, p.star.dim_store, p.star.dim_product)
    for df in (fact, p.star.fact_sales.groupBy("transaction_id").count()):
        assert "Exchange hashpartitioning(transaction_id" not in df._jdf.queryExecution().executedPlan().toString()
    assert p.star.fact_rows == p.star.fact_sales.count() == p.staging.count()
    assert p.release() > 3
