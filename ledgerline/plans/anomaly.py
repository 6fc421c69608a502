"""Store-day anomaly watch-list.

store-day features -> rolling features -> z-scaled model features ->
isolation forest (fit on complete rows, every row scored) -> watch-list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.numeric import publish
from ledgerline.operators.features import (
    complete_features,
    feature_stats,
    rolling_features,
    scale_features,
    store_day_features,
)
from ledgerline.operators.isolation_forest import Forest, detect, fit_nodes
from ledgerline.operators.materialize import materialize
from ledgerline.operators.star import Star
from ledgerline.schema import FEATURE_COLUMNS

N_TREES = 200
MAX_SAMPLES = 256
SEED = 42
CONTAMINATION = 0.03
KEYS = ["store_id", "city", "full_date"]
TOP_COLUMNS = ["full_date", "store_id", "city", "net_revenue", "txn_count", "avg_discount_rate", "anomaly_score"]


def anomaly_scores(
    star: Star,
    contamination: float = CONTAMINATION,
    n_trees: int = N_TREES,
    max_samples: int = MAX_SAMPLES,
    seed: int = SEED,
    daily: DataFrame | None = None,
    forest: Forest | None = None,
) -> DataFrame:
    """Every store-day with its rolling features, score and flag.

    The model sees the four z-scaled features only (the rolling columns are
    reported, not modelled); scaling statistics come from the complete rows.
    """
    if daily is None:
        daily = materialize(store_day_features(star), "store_day")
    stats = feature_stats(complete_features(daily))
    scaled = scale_features(daily, stats, prefix="z_")
    zcols = [f"z_{c}" for c in FEATURE_COLUMNS]
    scored = detect(scaled, zcols, KEYS, contamination, n_trees, max_samples, seed, forest=forest).drop(*zcols)
    # The rolling columns are reported, not modelled: add them over the
    # (written) scored table instead of writing a rolled copy first.
    rolled = rolling_features(scored)
    roll_cols = [c for c in rolled.columns if c not in scored.columns]
    return publish(rolled.select(*daily.columns, *roll_cols, "anomaly_score", "is_anomaly"))


def forest_nodes(daily: DataFrame, n_trees: int = N_TREES, max_samples: int = MAX_SAMPLES, seed: int = SEED) -> DataFrame:
    """The nodes of the forest that :func:`anomaly_scores` fits."""
    complete = complete_features(daily)
    scaled = scale_features(complete, feature_stats(complete), prefix="z_")
    return fit_nodes(scaled, [f"z_{c}" for c in FEATURE_COLUMNS], KEYS, n_trees, max_samples, seed)[0]


def anomaly_watchlist(scores: DataFrame) -> DataFrame:
    """Flagged store-days, most anomalous (lowest score) first."""
    return scores.filter(F.col("is_anomaly") == 1).orderBy("anomaly_score", "store_id", "full_date")


def watchlist_top10(watchlist: DataFrame) -> DataFrame:
    """The ten most anomalous store-days (a top-k report: the limit is the feature)."""
    return watchlist.select(*TOP_COLUMNS).orderBy("anomaly_score", "store_id", "full_date").limit(10)
