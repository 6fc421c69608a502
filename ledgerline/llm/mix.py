"""Mixing sources to target weights by Pareto order sampling.

Sources share 100 % of all sizes by weight; a source's target stops at
``max_repeat`` times its own size and the excess is shared again by weight
among the others until none is above.  A source whose target is ``r`` times
its size takes ``floor(r)`` whole copies of every document for certain.  The
rest is a sample without replacement with inclusion probability
``p = r - floor(r)``, unequal between sources: each document draws a uniform
``u`` from the hash of its id, documents are ranked by the odds ``u/(1-u)``
over the inclusion odds ``p/(1-p)``, and the lowest ranks are taken until the
source's words are as near to its target as whole documents allow.

No window or sort ever holds a source: the cut in the ranking is found with
two histograms (a partial aggregate of at most 4096 buckets per source each),
and only the documents of the crossing bucket, about one in 16 million of a
source, are ordered exactly.  Documents of equal rank share their fate.
Reruns agree, because the rank depends on the id and the seed alone.

Defined results: null text has size 0; null sources are one source, ordered
last; a null id draws one fixed number; repeated rows are ranked together;
sources without any word get target 0; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.common import Sized, col, materialize, read_docs, text_of, unboxed, word_count
from ledgerline.operators.sequence import with_row_index_counted

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
SEED = "mix-1"
_BUCKETS = 4096
_EXACT = "decimal(38,0)"


def uniform(id_col: Column, seed: str) -> Column:
    """A number in (0, 1) with 52 random bits, from the id's MD5."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(id_col.cast("string"), F.lit("null"))).cast("binary"))
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint")
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT
) -> tuple[DataFrame, int]:
    """One row per source: source, source_size, target, whole copies
    (``base``) and the sampled rest (``need``), with the number of sources.

    ``sizes`` has ``source`` and ``size``.  The shared level is re-solved with
    one scalar aggregate per pass until no further source is capped.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked, n_sources = with_row_index_counted(totals, [F.col("source").asc_nulls_last()], name="_rank")
    turn = F.pmod(F.col("_rank"), F.lit(len(weights))).cast("int")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), turn + 1)
    ranked = ranked.withColumn("weight", weight.cast(_EXACT)).withColumn(
        "cap", (F.col("source_size") * max_repeat).cast(_EXACT)
    )
    first = ranked.agg(F.sum("source_size").cast(_EXACT).alias("t"), F.sum("weight").cast(_EXACT).alias("w")).first()
    total, num, den = int(first["t"] or 0), int(first["t"] or 0), int(first["w"] or 1)

    def above() -> Column:
        return F.col("weight") * F.lit(num).cast(_EXACT) >= F.col("cap") * F.lit(den).cast(_EXACT)

    while n_sources:
        row = ranked.agg(
            F.sum(F.when(above(), F.col("cap"))).cast(_EXACT).alias("capped"),
            F.sum(F.when(~above(), F.col("weight"))).cast(_EXACT).alias("open"),
        ).first()
        new = (total - int(row["capped"] or 0), int(row["open"] or 0))
        if not new[1] or new == (num, den):
            break
        num, den = new
    share = F.col("weight") * F.lit(num).cast(_EXACT)
    target = F.when(above(), F.col("cap").cast("double")).otherwise(share.cast("double") / F.lit(float(den)))
    base = F.when(F.col("source_size") == 0, F.lit(0)).when(above(), F.lit(max_repeat))
    base = base.otherwise(F.floor(share.cast("double") / F.lit(float(den)) / F.col("source_size"))).cast("int")
    return (
        ranked.select("source", "source_size", target.alias("target"), base.alias("base")).withColumn(
            "need", F.greatest(F.lit(0.0), F.col("target") - F.col("base") * F.col("source_size"))
        ),
        n_sources,
    )


def _rank(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """``sizes`` with its source's row and the Pareto rank mapped to (0, 1)."""
    t = targets.withColumnRenamed("source", "_source")
    joined = sizes.join(t, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    p = F.col("need") / F.col("source_size")
    odds = (F.col("u") / (1 - F.col("u"))) / (p / (1 - p))
    return joined.withColumn("rank", F.when(F.col("need") > 0, odds / (1 + odds)))


def _crossing(hist: DataFrame, bucket: str) -> DataFrame:
    """The bucket of each source in which the running size reaches ``need``."""
    w = Window.partitionBy("source").orderBy(bucket)
    before = F.sum("size").over(w) - F.col("size")
    run = hist.withColumn("before", F.col("before") + before)
    hit = run.filter((F.col("before") < F.col("need")) & (F.col("before") + F.col("size") >= F.col("need")))
    return hit.select("source", bucket, "before")


def cut_points(sizes: DataFrame, targets: Sized) -> DataFrame:
    """One row per source with a sampled rest: ranks below ``low`` or up to
    ``high`` are taken."""
    ranked = _rank(sizes, targets.for_join()).filter(F.col("rank").isNotNull())
    b1 = F.floor(F.col("rank") * _BUCKETS).cast("int")
    b2 = F.floor(F.col("rank") * _BUCKETS * _BUCKETS).cast("bigint")

    def hist(df: DataFrame, bucket: Column, name: str, before: Column) -> DataFrame:
        return df.groupBy("source", bucket.alias(name)).agg(
            F.sum("size").alias("size"), F.first("need").alias("need"), F.max(before).alias("before")
        )

    def within(prev: DataFrame, bucket: Column, name: str) -> DataFrame:
        p = materialize(prev, "mixcut")
        p = Sized(p, targets.rows).for_join().withColumnsRenamed({"source": "_s", name: "_b"})
        return ranked.join(p, F.col("source").eqNullSafe(F.col("_s")) & (bucket == F.col("_b"))).drop("_s", "_b")

    first = _crossing(hist(ranked, b1, "b", F.lit(0)), "b")
    second = _crossing(hist(within(first, b1, "b"), b2, "b", F.col("before")), "b")
    last = within(second, b2, "b").withColumn("low", b2.cast("double") / float(_BUCKETS * _BUCKETS))
    last = last.groupBy("source", "rank", "low").agg(
        F.sum("size").alias("size"), F.first("need").alias("need"), F.max("before").alias("before")
    )
    w = Window.partitionBy("source").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    last = last.withColumn("miss", F.abs(F.col("before") + F.sum("size").over(w) - F.col("need")))
    best = last.groupBy("source").agg(
        F.min("low").alias("low"),
        F.min(F.struct("miss", "rank")).alias("best"),
        F.max(F.col("need") - F.col("before")).alias("without"),
    )
    high = F.when(F.col("best.miss") < F.col("without"), F.col("best.rank")).otherwise(F.lit(-1.0))
    return best.select("source", "low", high.alias("high"))


def pareto_mix(
    docs: DataFrame,
    size: Column,
    id_col: str = "doc_id",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    max_repeat: int = MAX_REPEAT,
    seed: str = SEED,
    keep_rows: bool = False,
) -> DataFrame:
    """Every document with source_size, target, ``copies`` and ``taken``
    (= copies * size).  ``size`` is an expression over ``docs``; ``keep_rows``
    adds the input row as ``_row``."""
    sized_docs = docs.select(
        col(id_col).alias("doc_id"),
        col(source_col).alias("source"),
        size.alias("size"),
        uniform(col(id_col), seed).alias("u"),
        *([F.struct(*[col(c) for c in docs.columns]).alias("_row")] if keep_rows else []),
    )
    slim = materialize(sized_docs.select("doc_id", "source", "size", "u"), "mix")
    targets, n = source_targets(slim, weights, max_repeat)
    targets = Sized(materialize(targets, "mixtargets"), n)
    cuts = Sized(materialize(cut_points(slim, targets), "mixcuts"), n)
    cut = cuts.for_join().withColumnRenamed("source", "_cut")
    ranked = _rank(sized_docs if keep_rows else slim, targets.for_join())
    full = ranked.join(cut, F.col("source").eqNullSafe(F.col("_cut")), "left")
    chosen = F.coalesce((F.col("rank") < F.col("low")) | (F.col("rank") <= F.col("high")), F.lit(False))
    copies = F.col("base") + chosen.cast("int")
    out = full.withColumn("copies", copies).withColumn("taken", (F.col("copies") * F.col("size")).cast("bigint"))
    names = ["doc_id", "source", "size", "source_size", "target", "copies", "taken"]
    return out.select(*names, *(["_row"] if keep_rows else []))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_docs(spark, sf_dir)
    out = pareto_mix(docs, word_count(text_of()))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document as often as the mix takes it."""
    mixed = pareto_mix(docs, word_count(text_of()), keep_rows=True)
    taken = mixed.filter(F.col("copies") > 0)
    repeated = taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return unboxed(repeated, docs.columns)


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         (CAST(('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13)) AS BIGINT) + 0.5::DOUBLE)
           / 4503599627370496::DOUBLE AS u
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5, 2, 1][1 + CAST((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 AS INT)] AS weight
  FROM d GROUP BY source
), o AS (  -- capped sources are a prefix in the order of cap / weight
  SELECT *, sum(source_size) OVER () AS total,
         coalesce(sum(3 * source_size) OVER w, 0) AS capped, sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS open
  FROM s WINDOW w AS (ORDER BY 3 * source_size::DOUBLE / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), lvl AS (
  SELECT total - capped AS num, open AS den FROM o
  WHERE weight * (total - capped) < 3 * source_size * open
  ORDER BY 3 * source_size::DOUBLE / weight, source LIMIT 1
), t AS (
  SELECT source, source_size,
         CASE WHEN weight * num >= 3 * source_size * den THEN CAST(3 * source_size AS DOUBLE)
              ELSE CAST(weight * num AS DOUBLE) / CAST(den AS DOUBLE) END AS target
  FROM s LEFT JOIN lvl ON true
), b AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 WHEN target = 3 * source_size THEN 3
                 ELSE CAST(floor(target / source_size) AS INT) END AS base FROM t
), p AS (
  SELECT *, greatest(0.0::DOUBLE, target - base * source_size) AS need FROM b
), q AS (
  SELECT d.doc_id, d.source, d.size, p.source_size, p.target, p.base, p.need,
         CASE WHEN need > 0 THEN (u / (1 - u)) / ((need / p.source_size) / (1 - need / p.source_size)) END AS odds
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
), r AS (
  SELECT *, odds / (1 + odds) AS rank FROM q
), c AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY rank RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM r
), best AS (
  SELECT source, min(need) AS need, arg_min(cum, (abs(cum - need), cum)) AS cut, min(abs(cum - need)) AS miss
  FROM c WHERE rank IS NOT NULL GROUP BY source
)
SELECT c.doc_id, c.size, c.source_size, c.target,
       CAST(c.size * (c.base + CASE WHEN c.rank IS NOT NULL AND best.miss < best.need AND c.cum <= best.cut THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM c LEFT JOIN best ON c.source IS NOT DISTINCT FROM best.source
"""
