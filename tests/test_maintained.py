"""The star and marts kept by deliveries against a full rebuild."""

import datetime as dt
import glob
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from tests_support import make_raw, raw_row

from ledgerline.operators.star import build_star
from ledgerline.operators.validate import validate
from ledgerline.plans import maintained as M
from ledgerline.plans import marts
from ledgerline.schema import RAW_COLUMNS
from ledgerline.sinks import files

START = dt.date(2023, 11, 20)


def sales(lo, hi, city="city"):
    return [
        raw_row(f"R{i}", START + dt.timedelta(days=(i * i) % 211), f"N{i % 9}", f"{city}{i % 9 // 2}", f"P{i % 23}",
                f"cat{i % 23 % 4}", "2.50", i % 5, ["0", "0.04", None, "0.3"][i % 4], i, i / 4, i * 3 / 4, i / 2)
        for i in range(lo, hi)
    ]


def results(star):
    frames = (marts.revenue_decomposition(star, 2023, 2024), marts.store_pl_yearly(star),
              marts.discount_leakage(star, 2024), marts.seasonality(star))
    return [sorted(map(str, df.collect())) for df in frames]


def rebuilt(spark, rows):
    return build_star(validate(make_raw(spark, rows)))


def resolved(star):
    out = star.fact_sales.join(star.dim_store.df, "store_key").join(star.dim_product.df, "product_key")
    out = out.join(star.dim_date.df.select("date_key", "full_date"), "date_key")
    return sorted(map(str, out.drop("store_key", "product_key").collect()))


def test_deliveries_equal_a_full_rebuild_and_do_not_read_the_fact_again(spark, tmp_path):
    base = str(tmp_path / "w")
    assert M.apply_delivery(spark, base, make_raw(spark, sales(0, 100)), "s", 0) == 100
    # the first load's fact and the old staging's measures are not needed again
    for f in glob.glob(f"{base}/fact_sales/*/part-*.parquet"):
        with open(f, "wb") as out:
            out.write(b"not parquet")
    assert M.apply_delivery(spark, base, make_raw(spark, sales(80, 230)), "s", 1) == 130  # 20 again
    late = [raw_row("LATE", "2022-01-02", "N77", "new", "P99", "cat9", 1, 1, 0, 5, 0, 5, 1)]
    assert M.apply_delivery(spark, base, make_raw(spark, late + sales(230, 300)), "s", 2) == 71
    star = M.load_maintained(spark, base)
    full = rebuilt(spark, sales(0, 300) + late)
    assert results(star) == results(full)
    plan = marts.seasonality(star)._jdf.queryExecution().optimizedPlan().toString()
    assert "transaction_id" not in plan and star.txn_unique and star.fact_rows == 301
    keys = [r[0] for r in star.dim_product.df.select("product_key").collect()]
    assert sorted(keys) == list(range(1, 25)) and star.dim_date.rows == star.dim_date.df.count()


def test_a_second_city_rebuilds_the_fact_from_staging(spark, tmp_path):
    base = str(tmp_path / "w")
    M.apply_delivery(spark, base, make_raw(spark, sales(0, 50)), "s", 0)
    assert resolved(M.load_maintained(spark, base)) == resolved(rebuilt(spark, sales(0, 50)))
    M.apply_delivery(spark, base, make_raw(spark, sales(50, 80, city="other")), "s", 1)
    star = M.load_maintained(spark, base)
    full = rebuilt(spark, sales(0, 50) + sales(50, 80, city="other"))
    assert star.parts is None and not star.txn_unique and star.fact_rows == full.fact_rows > 80
    assert results(star) == results(full) and resolved(star) == resolved(full)
    # deliveries after it only add their rows
    M.apply_delivery(spark, base, make_raw(spark, sales(80, 95)), "s", 2)
    star = M.load_maintained(spark, base)
    full = rebuilt(spark, sales(0, 50) + sales(50, 80, city="other") + sales(80, 95))
    assert resolved(star) == resolved(full)


def test_replays_crashes_and_empty_deliveries(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "w")
    with pytest.raises(FileNotFoundError):
        M.load_maintained(spark, base)
    assert M.apply_delivery(spark, base, make_raw(spark, []), "s", 0) == 0
    with pytest.raises(FileNotFoundError):
        M.load_maintained(spark, base)
    assert M.apply_delivery(spark, base, make_raw(spark, sales(0, 40)), "s", 1) == 40
    before = results(M.load_maintained(spark, base))
    publish = files.publish

    def lost(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(files, "publish", lost)  # everything is written, nothing committed
    with pytest.raises(RuntimeError, match="lost"):
        M.apply_delivery(spark, base, make_raw(spark, sales(40, 70)), "s", 2)
    monkeypatch.setattr(files, "publish", publish)
    assert results(M.load_maintained(spark, base)) == before
    assert M.apply_delivery(spark, base, make_raw(spark, sales(40, 70)), "s", 2) == 30
    assert M.apply_delivery(spark, base, make_raw(spark, sales(40, 70)), "s", 2) == 0  # replay
    assert M.apply_delivery(spark, base, make_raw(spark, sales(0, 70)), "new checkpoint", 0) == 0
    star = M.load_maintained(spark, base)
    assert results(star) == results(rebuilt(spark, sales(0, 70))) and star.fact_sales.count() == 70
    ledger = {(r.stream, r.epoch): r.rows for r in M.load_ledger(spark, base).collect()}
    assert ledger == {("s", 0): 0, ("s", 1): 40, ("s", 2): 30, ("new checkpoint", 0): 0}


def test_the_stream_maintains_the_marts(spark, tmp_path):
    from ledgerline.streaming.incremental import start_maintained_load

    source, base = tmp_path / "in", str(tmp_path / "w")
    source.mkdir()
    for day, (lo, hi) in enumerate([(0, 30), (20, 60)]):
        lines = [",".join("" if v is None else str(v) for v in r) for r in sales(lo, hi)]
        (source / f"day{day}.csv").write_text("\n".join([",".join(RAW_COLUMNS), *lines]) + "\n")
        q = start_maintained_load(spark, str(source), base, str(tmp_path / "ckpt"))
        q.awaitTermination()
    star = M.load_maintained(spark, base)
    assert results(star) == results(rebuilt(spark, sales(0, 60)))
    assert [r.rows for r in M.load_ledger(spark, base).orderBy("epoch").collect()] == [30, 30]


def test_partial_sums_merge_like_the_whole(spark):
    raw = validate(make_raw(spark, sales(0, 120)))
    halves = [raw.filter(F.col("quantity") < 2), raw.filter(F.col("quantity") >= 2)]
    for name, keys in (("category", M.CATEGORY_KEYS), ("store", M.STORE_KEYS)):
        whole = getattr(M.parts_of(raw), name)
        merged = M.merge(*[getattr(M.parts_of(h), name) for h in halves], keys)
        assert sorted(map(str, merged.collect())) == sorted(map(str, whole.collect()))
        assert isinstance(whole.first()["net_revenue"], Decimal)
