"""Isolation forest: brute-force checks on small fixtures and properties."""

import datetime as dt
import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import isolation_forest as IF

KEYS = ["store_id", "full_date"]
FEATS = ["a", "b", "c"]


def fixture_df(spark, n=400, outliers=3, seed=0, null_rows=0):
    rng = np.random.default_rng(seed)
    base = dt.date(2020, 1, 1)
    rows = []
    for i in range(n):
        x = rng.normal(size=3)
        if i < outliers:
            x = x + 12.0  # planted extreme rows
        vals = [float(v) for v in x]
        if i >= n - null_rows:
            vals[2] = None
        rows.append((f"S{i % 7:02d}", base + dt.timedelta(days=i), *vals))
    return spark.createDataFrame(rows, "store_id string, full_date date, a double, b double, c double")


def test_average_path_length_values():
    c = IF.average_path_length([0, 1, 2, 3, 256])
    assert c[0] == 0 and c[1] == 0 and c[2] == 1
    assert c[3] == pytest.approx(2 * (np.log(2) + IF.EULER_GAMMA) - 2 * 2 / 3)
    assert c[4] == pytest.approx(10.244770920116851, rel=1e-12)


def brute_sample(keys, t, psi, seed):
    """The psi keys whose permuted hashes are smallest, in plain Python."""
    def digits(text):
        return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)

    p = 2**31 - 1
    a, b = 1 + digits(f"{seed}|{t}|a") % (p - 1), digits(f"{seed}|{t}|b") % p
    return sorted(keys, key=lambda k: ((a * (digits("|".join([str(seed), *map(str, k)])) % p) + b) % p, *k))[:psi]


def test_tree_samples_equal_brute_force_bottom_k(spark):
    df = fixture_df(spark, n=300)
    got, psi = IF.tree_samples(df.select(*KEYS), KEYS, n_trees=6, max_samples=32, seed=42)
    assert psi == 32
    keys = [tuple(r) for r in df.select(*KEYS).collect()]
    have = got.select("tree_id", *KEYS).collect()
    for t in range(6):
        assert sorted((r[1], r[2]) for r in have if r[0] == t) == sorted(brute_sample(keys, t, 32, 42))


def brute_tree(rows, t, seed, top):
    """Grow one tree by recursion."""
    def draw(node, name):
        return int(hashlib.md5(f"{seed}|{t}|{node}|{name}".encode()).hexdigest()[:13], 16) / 2.0**52

    def grow(node, rows, depth):
        usable = [f for f in range(len(rows[0])) if max(r[f] for r in rows) > min(r[f] for r in rows)]
        if depth == top or not usable:
            return {node: (-1, 0.0, len(rows), depth)}
        f = usable[int(draw(node, "feature") * len(usable))]
        lo, hi = min(r[f] for r in rows), max(r[f] for r in rows)
        at = lo + draw(node, "threshold") * (hi - lo)
        at = lo if at >= hi else at
        out = {node: (f, at, len(rows), depth)}
        out |= grow(2 * node + 1, [r for r in rows if r[f] <= at], depth + 1)
        return out | grow(2 * node + 2, [r for r in rows if r[f] > at], depth + 1)

    return grow(0, rows, 0)


@pytest.mark.parametrize("n", [1, 2, 50, 400])
def test_grown_nodes_equal_brute_force(spark, n):
    rng = np.random.default_rng(n)
    base = dt.date(2020, 1, 1)
    # ties: whole numbers, a constant feature and repeated rows
    rows = [(f"S{i % 7}", base + dt.timedelta(days=i), float(rng.integers(4)), float(rng.normal()), 3.0) for i in range(n)]
    df = spark.createDataFrame(rows, "store_id string, full_date date, a double, b double, c double")
    nodes, psi, top = IF.fit_nodes(df, FEATS, KEYS, n_trees=5, max_samples=64, seed=9)
    assert psi == min(n, 64)
    got = nodes.collect()
    values = {(r[0], r[1]): r[2:] for r in rows}
    for t in range(5):
        want = brute_tree([values[k] for k in brute_sample(list(values), t, psi, 9)], t, 9, top)
        have = {r["node_id"]: (r["feature"], r["threshold"], r["size"], r["depth"]) for r in got if r["tree_id"] == t}
        assert have == want


def test_the_fit_shuffles_the_candidates_once(spark):
    """All windows keep the partitioning by tree; no Python runs in the fit."""
    df = fixture_df(spark, n=300)
    base, psi, p = IF._plan_sampling(df, KEYS, 64, 1)
    nodes = IF.grown(IF._samples_at(base, KEYS, 4, psi, p, 1), FEATS, 1, 6)
    plan = nodes._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(tree_id") == 1 and "Python" not in plan and "Pandas" not in plan


def _naive_path(forest, t, x):
    node, depth = 0, 0
    while forest.feature[t, node] >= 0:
        f = forest.feature[t, node]
        node = forest.left[t, node] if x[f] <= forest.threshold[t, node] else forest.right[t, node]
        depth += 1
    return forest.path_at_leaf[t, node], depth


def test_vectorised_scoring_equals_naive_traversal(spark):
    df = fixture_df(spark, n=200)
    forest = IF.fit_forest(df, FEATS, KEYS, n_trees=10, max_samples=64, seed=1)
    X = np.asarray(df.select(*FEATS).toPandas(), dtype=float)
    fast = forest.score_samples(X)
    c = IF.average_path_length([forest.psi])[0]
    naive = []
    for x in X:
        h = np.mean([_naive_path(forest, t, x)[0] / 1e9 for t in range(forest.n_trees)])
        naive.append(-(2.0 ** (-h / c)))
    assert np.allclose(fast, naive, rtol=0, atol=1e-12)


def test_detect_flags_contamination_share_and_planted_outliers(spark):
    df = fixture_df(spark, n=400, outliers=3)
    out = IF.detect(df, FEATS, KEYS, contamination=0.03, n_trees=50, seed=42)
    flagged = out.filter("is_anomaly = 1").count()
    assert abs(flagged - 0.03 * 400) <= 1
    top3 = out.orderBy("anomaly_score", *KEYS).limit(3).collect()
    assert {r.full_date for r in top3} == {dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(3)}


def test_detect_is_deterministic_and_partition_invariant(spark):
    df = fixture_df(spark, n=300)
    a = IF.detect(df.repartition(1), FEATS, KEYS, n_trees=20, seed=5)
    b = IF.detect(df.repartition(7, "store_id"), FEATS, KEYS, n_trees=20, seed=5)
    ka = sorted(tuple(r) for r in a.select(*KEYS, "anomaly_score", "is_anomaly").collect())
    kb = sorted(tuple(r) for r in b.select(*KEYS, "anomaly_score", "is_anomaly").collect())
    assert ka == kb


def test_rows_with_missing_feature_get_null_score_and_no_flag(spark):
    df = fixture_df(spark, n=200, null_rows=5)
    out = IF.detect(df, FEATS, KEYS, n_trees=20, seed=5)
    nulls = out.filter(F.col("c").isNull()).collect()
    assert len(nulls) == 5
    assert all(r.anomaly_score is None and r.is_anomaly == 0 for r in nulls)


def test_large_n_uses_candidate_cutoff(spark):
    """n >> 4 psi: candidates are a hash-selected share, every tree still gets
    exactly psi rows."""
    df = spark.range(20000).select(
        F.concat(F.lit("S"), (F.col("id") % 13).cast("string")).alias("store_id"),
        F.date_add(F.lit(dt.date(2000, 1, 1)), F.col("id").cast("int")).alias("full_date"),
    )
    got, psi = IF.tree_samples(df, KEYS, n_trees=30, max_samples=64, seed=42)
    per_tree = pd.Series({r["tree_id"]: r["count"] for r in got.groupBy("tree_id").count().collect()})
    assert len(per_tree) == 30 and (per_tree == psi).all()


def test_short_candidate_sets_are_retried_not_capped(spark, monkeypatch):
    """With a candidate rate far too low every tree starts short; the rate
    doubles until each tree has its full psi-row sample."""
    monkeypatch.setattr(IF, "OVERSAMPLE", 0.25)
    df = fixture_df(spark, n=600)
    forest = IF.fit_forest(df, FEATS, KEYS, n_trees=8, max_samples=64, seed=3)
    assert list(forest.sample_sizes) == [64] * 8
    got, psi = IF.tree_samples(df.select(*KEYS), KEYS, n_trees=8, max_samples=64, seed=3)
    per_tree = {r["tree_id"]: r["count"] for r in got.groupBy("tree_id").count().collect()}
    assert psi == 64 and len(per_tree) == 8 and set(per_tree.values()) == {64}
    assert forest.n_trees == 8
