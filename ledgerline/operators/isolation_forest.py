"""Distributed isolation forest (Liu, Ting & Zhou, 2008).

Definitions follow the published algorithm and scikit-learn's documented
conventions:

* each tree sees a subsample of ``psi = min(max_samples, n)`` rows drawn
  without replacement; its height is limited to ``ceil(log2(psi))``;
* a node splits on a feature drawn uniformly among the features that are not
  constant in the node, at a threshold drawn uniformly in [min, max);
  ``x <= threshold`` goes left;
* path length h(x) = leaf depth + c(leaf size), with
  c(n) = 2 (ln(n - 1) + gamma) - 2 (n - 1) / n for n > 2, c(2) = 1, c(<=1) = 0;
* score_samples = -2 ** (-mean_h / c(psi)); decision = score_samples - offset,
  offset = the ``100 * contamination`` percentile of the training scores;
  a row is an anomaly when decision < 0.

Spark plan:

1. Subsamples: every row gets a 31-bit hash ``h`` of its key and every tree
   ``t`` an own permutation ``(A_t h + B_t) mod (2**31 - 1)`` of the hashes; the
   tree's sample is the ``psi`` rows that come first (bottom-k sampling =
   uniform without replacement, independent of partitioning).  Only rows
   under a cut-off are emitted as candidates (about ``4 * psi`` per tree); if
   a tree gets fewer than ``psi`` candidates (seen from its root size) the
   cut-off is doubled and the step redone, so no tree is ever short of its
   exact sample.
2. Trees: all trees grow at once, level by level, as windows over (tree,
   node): size, minimum and maximum of each feature.  The split of a node is
   drawn from a hash of (seed, tree, node), so every row of the node knows it
   and goes left or right.  The samples are dealt out by tree once; all the
   windows keep that partitioning, and a window spans at most ``psi`` rows.
   Hashes are MD5, so the fit can be stated in SQL (it is, in ``oracle``).
3. The forest (at most ``n_trees * (2 psi - 1)`` nodes) is collected and
   broadcast; an Arrow ``pandas_udf`` scores rows in vectorised batches.  Path
   lengths are counted in units of 1e-9, so their sum has no order.
4. The offset is an exact distributed quantile of the training scores.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.materialize import bucket_count, materialize
from ledgerline.operators.quantile import exact_quantile
from ledgerline.session import ship_package

EULER_GAMMA = 0.5772156649015329
OVERSAMPLE = 4.0
PRIME = (1 << 31) - 1  # the hashes are numbers modulo this
UNIT = 1_000_000_000  # path lengths are whole multiples of 1 / UNIT
NODE_COLUMNS = ["tree_id", "node_id", "feature", "threshold", "left", "right", "size", "depth"]


def average_path_length(n) -> np.ndarray:
    """c(n): average path length of an unsuccessful BST search among n points."""
    n = np.asarray(n, dtype=np.float64)
    out = np.zeros_like(n)
    two = n == 2
    big = n > 2
    out[two] = 1.0
    nb = n[big]
    out[big] = 2.0 * (np.log(nb - 1.0) + EULER_GAMMA) - 2.0 * (nb - 1.0) / nb
    return out


@dataclass
class Forest:
    """Dense (n_trees x max_nodes) node arrays; -1 feature marks a leaf."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    path_at_leaf: np.ndarray  # depth + c(size) in units, precomputed per node
    max_depth: int
    psi: int
    sample_sizes: np.ndarray | None = None  # rows each tree was grown on

    @property
    def n_trees(self) -> int:
        return self.feature.shape[0]

    def score_samples(self, X: np.ndarray) -> np.ndarray:
        """-2 ** (-mean path length / c(psi)) for the rows of X."""
        m = X.shape[0]
        rows = np.arange(m)
        total = np.zeros(m, dtype=np.int64)
        for t in range(self.n_trees):
            feat, thr, lft, rgt = self.feature[t], self.threshold[t], self.left[t], self.right[t]
            node = np.zeros(m, dtype=np.int64)
            for _ in range(self.max_depth):
                f = feat[node]
                internal = f >= 0
                if not internal.any():
                    break
                x = X[rows, np.where(internal, f, 0)]
                nxt = np.where(x <= thr[node], lft[node], rgt[node])
                node = np.where(internal, nxt, node)
            total += self.path_at_leaf[t][node]
        mean_h = total / float(self.n_trees * UNIT)
        return -np.power(2.0, -mean_h / float(average_path_length([self.psi])[0]))

    @classmethod
    def from_nodes(cls, nodes: pd.DataFrame, n_trees: int, max_depth: int, psi: int) -> "Forest":
        width = int(nodes["node_id"].max()) + 1 if len(nodes) else 1
        shape = (n_trees, width)
        feature = np.full(shape, -1, dtype=np.int32)
        threshold = np.zeros(shape, dtype=np.float64)
        left = np.zeros(shape, dtype=np.int32)
        right = np.zeros(shape, dtype=np.int32)
        path = np.zeros(shape, dtype=np.int64)
        t = nodes["tree_id"].to_numpy()
        n = nodes["node_id"].to_numpy()
        feature[t, n] = nodes["feature"].to_numpy()
        threshold[t, n] = nodes["threshold"].to_numpy()
        left[t, n] = np.maximum(nodes["left"].to_numpy(), 0)
        right[t, n] = np.maximum(nodes["right"].to_numpy(), 0)
        lengths = nodes["depth"].to_numpy() + average_path_length(nodes["size"].to_numpy())
        path[t, n] = np.round(lengths * UNIT).astype(np.int64)
        sizes = np.zeros(n_trees, dtype=np.int64)
        roots = nodes[nodes["node_id"] == 0]
        sizes[roots["tree_id"].to_numpy()] = roots["size"].to_numpy()
        return cls(feature, threshold, left, right, path, max_depth, psi, sizes)


def _digits(text: Column, count: int) -> Column:
    """The first ``count`` hexadecimal digits of the text's MD5, as a number."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, count), 16, 10).cast("bigint")


def _key_hash(seed: int, keys: list[str]) -> Column:
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return _digits(F.concat_ws("|", F.lit(str(seed)), *parts), 8) % PRIME


def permutations(seed: int, n_trees: int) -> list[tuple[int, int]]:
    """(A, B) of every tree."""

    def number(t: int, name: str) -> int:
        return int(hashlib.md5(f"{seed}|{t}|{name}".encode()).hexdigest()[:8], 16)

    return [(1 + number(t, "a") % (PRIME - 1), number(t, "b") % PRIME) for t in range(n_trees)]


def _candidates(df: DataFrame, seed: int, n_trees: int, cutoff: int) -> DataFrame:
    """(row, tree) pairs under the cut-off: made and filtered in one codegen
    stage, dealt out by tree."""
    pairs = ", ".join(f"struct({t} AS t, {a}L AS a, {b}L AS b)" for t, (a, b) in enumerate(permutations(seed, n_trees)))
    out = df.select("*", F.explode(F.expr(f"array({pairs})")).alias("_x"))
    out = out.withColumn("_h", F.expr(f"(_x.a * _h0 + _x.b) % {PRIME}L")).filter(F.col("_h") < cutoff)
    out = out.withColumn("tree_id", F.col("_x.t")).drop("_x")
    # a few rows per tree: a number of partitions that is not coalesced away
    return out.repartition(max(1, min(n_trees, bucket_count(df.sparkSession))), "tree_id")


def _samples_at(base: DataFrame, key_cols: list[str], n_trees: int, psi: int, p: float, seed: int) -> DataFrame:
    """Lazy per-tree bottom-``psi`` selection among the hash candidates at rate p.

    The window runs over one tree's candidates (about ``4 psi`` rows), never
    over all rows."""
    cand = _candidates(base, seed, n_trees, int(p * PRIME))
    w = Window.partitionBy("tree_id").orderBy("_h", *key_cols)
    return cand.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") <= psi).drop("_rk", "_h0")


def _plan_sampling(df: DataFrame, key_cols: list[str], max_samples: int, seed: int) -> tuple[DataFrame, int, float]:
    base = df.withColumn("_h0", _key_hash(seed, key_cols))
    n = base.count()
    if n == 0:
        raise ValueError("no complete rows to fit the isolation forest on")
    psi = int(min(max_samples, n))
    return base, psi, min(1.0, OVERSAMPLE * psi / n)


def tree_samples(
    df: DataFrame,
    key_cols: list[str],
    n_trees: int,
    max_samples: int,
    seed: int,
) -> tuple[DataFrame, int]:
    """Each tree's exact subsample: per tree, the ``psi`` rows with the
    smallest permuted hashes (ties broken by key).  Returns (rows
    tagged with ``tree_id``, psi).  The candidate rate doubles until every
    tree has its ``psi`` rows."""
    base, psi, p = _plan_sampling(df, key_cols, max_samples, seed)
    while True:
        picked = materialize(_samples_at(base, key_cols, n_trees, psi, p, seed), "if_samples")
        counts = {r["tree_id"]: r["count"] for r in picked.groupBy("tree_id").count().collect()}
        if p >= 1.0 or all(counts.get(t, 0) >= psi for t in range(n_trees)):
            return picked, psi
        p = min(1.0, 2.0 * p)


def _uniform(seed: int, name: str) -> str:
    """SQL of a number in [0, 1) of the node, from 52 bits of a hash."""
    text = f"concat_ws('|', '{seed}', string(tree_id), string(_node), '{name}')"
    return f"double(bigint(conv(substring(md5(binary({text})), 1, 13), 16, 10))) / {1 << 52}D"


def grown(samples: DataFrame, feature_cols: list[str], seed: int, max_depth: int) -> DataFrame:
    """The nodes (``NODE_COLUMNS``) of the trees over ``samples`` (one row per
    tree and sampled row).  Node ``i`` has the children ``2 i + 1`` and
    ``2 i + 2``; feature -1 marks a leaf.  Rows that share all features end in
    one leaf; a tree without rows has no node."""
    features = [F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(feature_cols)]
    rows = samples.select("tree_id", *features, F.lit(0).alias("_node"), F.lit(True).alias("_live"))
    xs = [f"_x{i}" for i in range(len(feature_cols))]
    node = "OVER (PARTITION BY tree_id, _node)"
    # a live node's features that vary in it
    usable = "filter(array(" + ", ".join(
        f"IF(_hi{i} > _lo{i}, named_struct('f', {i}, 'lo', _lo{i}, 'hi', _hi{i}, 'x', {x}), NULL)" for i, x in enumerate(xs)
    ) + "), u -> u IS NOT NULL)"
    at = "_u.lo + _r * (_u.hi - _u.lo)"
    levels: list[str] = []
    for depth in range(max_depth + 1):
        if depth < max_depth:
            spans = [f"{f}({x}) {node} AS _{n}{i}" for i, x in enumerate(xs) for n, f in (("lo", "min"), ("hi", "max"))]
            rows = rows.selectExpr("*", f"count(1) {node} AS _n", *spans)
            rows = rows.selectExpr("tree_id", *xs, "_node", "_live", "_n", *levels, f"IF(_live, {usable}, NULL) AS _usable")
            drawn = f"get(_usable, int(floor({_uniform(seed, 'feature')} * size(_usable)))) AS _u"
            rows = rows.selectExpr("tree_id", *xs, "_node", "_live", "_n", *levels, drawn, f"{_uniform(seed, 'threshold')} AS _r")
            threshold = f"IF({at} >= _u.hi, _u.lo, {at}) AS _t"
            rows = rows.selectExpr("tree_id", *xs, "_node", "_live", "_n", *levels, "_u.f AS _f", "_u.x AS _x", threshold)
        else:
            rows = rows.selectExpr("*", f"count(1) {node} AS _n", "INT(NULL) AS _f", "DOUBLE(NULL) AS _x", "DOUBLE(NULL) AS _t")
        entry = (
            "IF(_live, named_struct('node_id', _node, 'feature', coalesce(_f, -1), 'threshold', coalesce(_t, 0D), "
            f"'size', int(_n), 'depth', {depth}), NULL) AS _level{depth}"
        )
        child = "IF(_f IS NULL, _node, 2 * _node + IF(_x <= _t, 1, 2)) AS _node"
        rows = rows.selectExpr("tree_id", *xs, child, "_f IS NOT NULL AS _live", *levels, entry)
        levels.append(f"_level{depth}")
    nodes = rows.selectExpr("tree_id", f"explode(array({', '.join(levels)})) AS e").filter("e IS NOT NULL")
    nodes = nodes.select("tree_id", "e.*").dropDuplicates(["tree_id", "node_id"])
    left, right = "IF(feature < 0, -1, 2 * node_id + 1) AS left", "IF(feature < 0, -1, 2 * node_id + 2) AS right"
    return nodes.selectExpr("tree_id", "node_id", "feature", "threshold", left, right, "size", "depth")


def fit_nodes(
    df: DataFrame,
    feature_cols: list[str],
    key_cols: list[str],
    n_trees: int = 200,
    max_samples: int = 256,
    seed: int = 42,
) -> tuple[DataFrame, int, int]:
    """Fit on the rows of ``df`` (all features non-null): the written table of
    nodes, psi and the height limit.

    The samples are the ones :func:`tree_samples` defines; the root's size
    shows a tree short of ``psi`` rows, and the candidate rate is doubled.
    """
    base, psi, p = _plan_sampling(df.select(*key_cols, *feature_cols), key_cols, max_samples, seed)
    max_depth = int(np.ceil(np.log2(max(psi, 2))))
    while True:
        samples = _samples_at(base, list(key_cols), n_trees, psi, p, seed)
        nodes = materialize(grown(samples, feature_cols, seed, max_depth), "if_nodes")
        roots = nodes.filter("node_id = 0").agg(F.count(F.lit(1)).alias("n"), F.min("size").alias("least")).first()
        complete = roots["n"] == n_trees and roots["least"] >= psi
        if not complete and p >= 0.5 and base.count() > 2 * OVERSAMPLE * psi:
            # every row a candidate of every tree would be rows x trees
            raise ValueError(f"the keys {list(key_cols)} repeat: too few distinct rows for the trees' samples")
        if complete or p >= 1.0:
            return nodes, psi, max_depth
        p = min(1.0, 2.0 * p)


def fit_forest(
    df: DataFrame,
    feature_cols: list[str],
    key_cols: list[str],
    n_trees: int = 200,
    max_samples: int = 256,
    seed: int = 42,
) -> Forest:
    """:func:`fit_nodes`, collected: at most ``n_trees * (2 psi - 1)`` rows."""
    nodes, psi, max_depth = fit_nodes(df, feature_cols, key_cols, n_trees, max_samples, seed)
    return Forest.from_nodes(nodes.toPandas(), n_trees, max_depth, psi)


def score_column(df: DataFrame, forest: Forest, feature_cols: list[str]) -> Column:
    """Arrow-batched score_samples of the feature columns (NaN if any is NULL)."""
    ship_package(df.sparkSession)
    bc = df.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf(T.DoubleType())
    def _score(*cols: pd.Series) -> pd.Series:
        X = np.column_stack([c.to_numpy(dtype=np.float64, na_value=np.nan) for c in cols])
        out = np.full(X.shape[0], np.nan)
        ok = ~np.isnan(X).any(axis=1)
        if ok.any():
            out[ok] = bc.value.score_samples(X[ok])
        return pd.Series(out)

    return _score(*[F.col(c).cast("double") for c in feature_cols])


def detect(
    df: DataFrame,
    feature_cols: list[str],
    key_cols: list[str],
    contamination: float = 0.03,
    n_trees: int = 200,
    max_samples: int = 256,
    seed: int = 42,
    score_name: str = "anomaly_score",
    flag_name: str = "is_anomaly",
    forest: Forest | None = None,
) -> DataFrame:
    """Fit on the complete rows of ``df`` (unless a ``forest`` is given) and
    score every row.

    Adds ``anomaly_score`` = decision value rounded to 4 places (NULL for rows
    with a missing feature) and ``is_anomaly`` = 1 when the unrounded decision
    is negative, else 0.
    """
    complete = None
    for c in feature_cols:
        cond = F.col(c).isNotNull()
        complete = cond if complete is None else complete & cond
    if forest is None:
        forest = fit_forest(df.filter(complete), feature_cols, key_cols, n_trees, max_samples, seed)
    # Score once and keep it: the quantile and the output both read it.
    scored = materialize(df.withColumn("_ss", F.when(complete, score_column(df, forest, feature_cols))), "if_scored")
    offset = exact_quantile(scored.filter(F.col("_ss").isNotNull()), "_ss", contamination)
    decision = F.col("_ss") - F.lit(offset)
    return scored.select(
        *[c for c in df.columns],
        F.round(decision, 4).alias(score_name),
        F.when(decision < 0, F.lit(1)).otherwise(F.lit(0)).alias(flag_name),
    )
