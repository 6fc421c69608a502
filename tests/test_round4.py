"""Steps whose cost must grow with the rows alone."""

import pytest
from pyspark.sql import functions as F
from test_sources_sinks_jobs import HEADER
from tests_support import SF_SMOKE

from ledgerline.operators import validate as V
from ledgerline.operators.dedup import hot_slots, keep_first
from ledgerline.operators.validate import validate
from ledgerline.plans import catalog, marts
from ledgerline.plans.pipeline import Pipeline
from ledgerline.schema import ROW_SEQ
from ledgerline.sources.adapter import narrow_feed
from ledgerline.sources.pos_csv import read_pos_csv


def csv_line(tid, qty):
    return f"{tid},2024-01-15,S01,X,P,K1,C,2.5,{qty},0.05,5,0.25,4.75,1.1"


# --- F1: the CSV source ---------------------------------------------------------
def test_file_order_carries_a_rank_and_no_path(spark, tmp_path):
    folder = tmp_path / "a b%20ü+c#d"
    folder.mkdir()
    (folder / "part-10 x.csv").write_text("\n".join([HEADER, csv_line("T1", 7)]) + "\n")
    (folder / "part-9%41 x.csv").write_text("\n".join([HEADER, csv_line("T1", 3)]) + "\n")
    raw = read_pos_csv(spark, str(folder))
    assert raw.schema[ROW_SEQ].dataType["f"].dataType.typeName() == "integer"
    assert [r.quantity for r in validate(raw).collect()] == [3]


# --- F3, F6, F7: keep-first and the marts over the feed ---------------------------
def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def pipe(spark):
    return catalog.build(spark, SF_SMOKE)


def test_keep_first_sorts_nothing_before_the_shuffle(spark, pipe):
    plan = physical(V.dedup_first(V.conform(pipe.raw)))
    below = plan.split("Exchange hashpartitioning(transaction_id")
    assert len(below) == 2 and "Sort" not in below[1]


@pytest.mark.parametrize("hot_rows", [3, 10**6])
def test_keep_first_with_hot_keys(spark, hot_rows):
    rows = [("hot", i, f"h{i}") for i in range(50)] + [(None, i, f"n{i}") for i in range(20)]
    rows += [(f"k{i % 30}", i, f"c{i}") for i in range(60)]
    df = spark.createDataFrame(rows, "k string, o int, v string").repartition(4)
    assert bool(hot_slots(df, "k", hot_rows)) == (hot_rows == 3)
    got = {tuple(r) for r in keep_first(df, "k", "o", "n", hot_rows).collect()}
    assert got == {("hot", 0, "h0", 50), (None, 0, "n0", 20)} | {(f"k{i}", i, f"c{i}", 2) for i in range(30)}


def test_dimension_texts_are_joined_to_the_kept_lines(spark, pipe):
    firsts = pipe._firsts()
    dealt = next(x for x in physical(firsts).splitlines() if "partial_min_by" in x)
    assert "l_partkey" in dealt and "city" not in dealt and "category" not in dealt
    want = V.first_copies(pipe.raw)
    assert firsts.schema.names == want.schema.names
    assert firsts.exceptAll(want).count() == 0 and want.exceptAll(firsts).count() == 0


def test_repeated_part_keys_keep_the_feed_whole(spark, tmp_path):
    for name in ("lineitem", "part", "supplier", "nation", "region"):
        df = spark.read.parquet(f"{SF_SMOKE}/{name}.parquet")
        df = df.limit(200) if name == "lineitem" else df
        (df.unionByName(df) if name == "part" else df).write.parquet(f"{tmp_path}/{name}")
    assert narrow_feed(spark, str(tmp_path)) is None
    p = Pipeline(spark, str(tmp_path))
    p.deduped
    assert p.dq["total_rows"] == p.raw.count() == 400


def test_marts_sum_by_category_where_products_are_broadcast(spark, pipe):
    plan = physical(marts.seasonality(pipe.star))
    assert "keys=[category" in plan and "keys=[product_key" not in plan


# --- F2, F5: deliveries -------------------------------------------------------------
def test_deliveries_are_dealt_out_once(spark, pipe):
    feed, dealt = pipe.raw_by_id()
    assert dealt
    assert "Exchange hashpartitioning(transaction_id" not in physical(validate(feed, dealt))
    want = V.conform(pipe.raw).drop(ROW_SEQ)
    assert feed.drop(ROW_SEQ).exceptAll(want).count() == 0 and feed.count() == want.count()


# --- F4: the repeated load ------------------------------------------------------------
def test_repeated_load_stays_in_its_buckets(spark, pipe, monkeypatch):
    seen = {}

    def build(staging, clustered=False):
        seen.update(rows=staging.count(), clustered=clustered)
        return pipe.star

    monkeypatch.setattr(catalog.star_ops, "build_star", build)
    catalog.seasonality_repeated_load(spark, SF_SMOKE)
    march = pipe.staging.filter(F.month("txn_date") == 3).count()
    assert march and seen == {"rows": pipe.staging.count() + march, "clustered": True}
