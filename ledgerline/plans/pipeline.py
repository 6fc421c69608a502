"""The pipeline as a context of lazily built, materialised stages.

raw POS feed -> keep-first rows (written once) -> validated staging (lazy
over them) -> star (dimensions and fact written, dimensions counted) ->
marts / features / anomaly.
"""

from __future__ import annotations

from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.dedup import hot_slots, keep_first
from ledgerline.operators.materialize import materialize, materialize_bucketed, release, tracking
from ledgerline.operators.star import Parts, Star, build_star
from ledgerline.operators.validate import COPIES, conform, dq_aggregates, finish_validation, first_copies, observed_report
from ledgerline.plans.maintained import parts_of
from ledgerline.schema import ROW_SEQ
from ledgerline.sources.adapter import line_order, narrow_feed, ordered_feed, pos_feed

BASE_YEAR = 1999
COMPARE_YEAR = 2000


class Pipeline:
    """One run of the pipeline over a directory of driver tables.

    ``raw`` may be given directly (any DataFrame with the 14 POS columns, e.g.
    from :func:`ledgerline.sources.pos_csv.read_pos_csv`); otherwise it is the
    POS feed derived from the driver tables in ``sf_dir``.
    """

    def __init__(
        self,
        spark: SparkSession,
        sf_dir: str | None = None,
        raw: DataFrame | None = None,
        dirty: bool = True,
        base_year: int = BASE_YEAR,
        compare_year: int = COMPARE_YEAR,
    ):
        self.spark = spark
        self.sf_dir = sf_dir
        self._raw = raw
        self.dirty = dirty
        self.base_year = base_year
        self.compare_year = compare_year
        self.materialized: list[str] = []

    @cached_property
    def raw(self) -> DataFrame:
        if self._raw is not None:
            return self._raw
        return pos_feed(self.spark, self.sf_dir, dirty=self.dirty)

    def raw_in_order(self) -> DataFrame:
        """The raw feed in source order: by partition, and by row inside each."""
        if self._raw is not None:
            return conform(self._raw).orderBy(ROW_SEQ)
        return ordered_feed(self.spark, self.sf_dir, dirty=self.dirty)

    @cached_property
    def deduped(self) -> DataFrame:
        """Keep-first rows with copy counts, written once (the only full
        write of the build); staging and the DQ report are scans of it.  The
        keep-first shuffle has dealt the rows by id, so they are stored in
        buckets and the star needs no further shuffle by id."""
        seen = Observation()
        firsts = self._firsts().observe(seen, *dq_aggregates())
        with tracking(self.materialized):
            out = materialize_bucketed(firsts, "deduped", "transaction_id")
        self.dq = seen.get
        return out

    @cached_property
    def _narrow(self):
        return narrow_feed(self.spark, self.sf_dir, self.dirty) if self._raw is None else None

    def _firsts(self) -> DataFrame:
        """Keep-first rows with their copy counts.  The feed's texts depend on
        the line alone, so they are joined to the lines that are kept."""
        if self._narrow is None:
            return first_copies(self.raw)
        lines, rows = self._narrow
        kept = keep_first(lines, "transaction_id", line_order(), copies_col=COPIES)
        return conform(rows(kept)).drop(ROW_SEQ)

    def raw_by_id(self) -> tuple[DataFrame, bool]:
        """The raw feed over lines written once, and whether they lie in buckets
        by id (not where one id has too many rows for a bucket)."""
        if self._narrow is None or hot_slots(self._narrow[0], "transaction_id"):
            return materialize(conform(self.raw), "deliveries"), False
        lines, rows = self._narrow
        stored = materialize_bucketed(lines.repartition(F.col("transaction_id")), "deliveries", "transaction_id")
        return conform(rows(stored)), True

    @cached_property
    def staging(self) -> DataFrame:
        """Validated staging: the remaining validation steps over ``deduped``
        (filters and projections pushed into the parquet scan)."""
        return finish_validation(self.deduped)

    def dq_report(self) -> DataFrame:
        """Counted while the keep-first rows were written: no scan."""
        self.deduped  # noqa: B018
        return observed_report(self.spark, self.dq)

    @cached_property
    def parts(self) -> Parts | None:
        """Monthly partial sums of staging, written once; None where the
        marts must read the fact (ids or dimension members repeat)."""
        adds_up = self.star.txn_unique and self.star.fact_rows == self.dq["rows_accepted"]
        if not adds_up:
            return None
        with tracking(self.materialized):
            parts = parts_of(self.staging)
            return Parts(materialize(parts.category, "category_parts"), materialize(parts.store, "store_parts"))

    @property
    def summed_star(self) -> Star:
        """The star with its partial sums: marts over it do not scan the fact."""
        return replace(self.star, parts=self.parts)

    def dedup_first(self) -> DataFrame:
        return self.deduped.drop(COPIES)

    @cached_property
    def star(self) -> Star:
        with tracking(self.materialized):
            return build_star(self.staging, clustered=True)

    @property
    def fact(self) -> DataFrame:
        return self.star.fact_sales

    @cached_property
    def store_days(self) -> DataFrame:
        """Store-day features, written once (features, scaling, thresholds
        and the forest all read them)."""
        from ledgerline.operators.features import store_day_features

        seen = Observation()
        daily = store_day_features(self.star).observe(seen, F.count(F.lit(1)).alias("rows"))
        with tracking(self.materialized):
            out = materialize(daily, "store_day")
        self.store_day_rows = seen.get["rows"]
        return out

    def anomaly_scores(self, contamination: float) -> DataFrame:
        """Scored store-days, fitted once per contamination level (the
        scored table is written by the detector, so reuse is a scan)."""
        from ledgerline.plans.anomaly import anomaly_scores

        cache = self.__dict__.setdefault("_anomaly", {})
        if contamination not in cache:
            daily = self.store_days
            with tracking(self.materialized):
                cache[contamination] = anomaly_scores(self.star, contamination, daily=daily)
        return cache[contamination]

    def release(self) -> int:
        """Delete every table this pipeline wrote to the checkpoint folder.
        DataFrames obtained from it are unusable afterwards."""
        n = release(self.spark, self.materialized)
        for k in ("deduped", "staging", "star", "parts", "store_days", "_anomaly"):
            self.__dict__.pop(k, None)
        return n
