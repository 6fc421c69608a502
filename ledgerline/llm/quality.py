"""Quality rules judged per host.

Each document is measured (words, symbols, repeated lines, words in repeated
8-word windows) inside its row, without a shuffle.  Soft rules on these
measures give a number of failures per document.  Per host (here: the
document's source), the share of failing documents is shrunk towards the
corpus with a beta prior fitted by the method of moments over all hosts; a
host whose shrunk rate exceeds ``HOST_LIMIT`` is bad.  The verdict is joined
back: a document is dropped when it fails a base rule, when it fails
``STRIKES_NORMAL`` soft rules, or, on a bad host, when it fails
``STRIKES_BAD``.  A document without any failure is always kept.

Host counts are partial aggregates (one row per host and task), so a host
with a third of all rows is no hot key.  The host table is broadcast only
behind a counted size and joined by shuffle beyond it.

Defined results: null text has no word and fails; a null source is a host of
its own; repeated rows are judged alike; other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import SPACES, Sized, boxed, col, materialize, read_docs, text_of, unboxed

WINDOW_WORDS = 8
MIN_WORDS = 20
MAX_REPEAT_PCT = 30
HOST_LIMIT = 0.5
STRIKES_NORMAL = 2
STRIKES_BAD = 1
SYMBOLS = "#*$%&|<>"


def _with_words(df: DataFrame, text: Column) -> DataFrame:
    bare = F.btrim(text, F.lit(SPACES))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))
    df = df.withColumn("_words", words).withColumn("n_words", F.size("_words").cast("bigint"))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    df = df.withColumn("_lines", lines)
    return df.withColumns(
        {
            "word_chars": F.length(F.translate(text, SPACES, "")).cast("bigint"),
            "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
            "_n_lines": F.size("_lines"),
        }
    )


def _with_repeats(df: DataFrame) -> DataFrame:
    """``n_repeat_words``: words inside windows that occur at least twice.

    Window hashes are sorted with their positions, so equal windows are
    neighbours; the covered words follow from the sorted flagged positions.
    Only texts with some repeated window do this (n log n) work.
    """
    k = WINDOW_WORDS
    starts = F.sequence(F.lit(0), F.size("_words") - k)
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(F.col("_words"), i + 1, k)))
    df = df.withColumn("_win", F.when(F.size("_words") >= k, hashes).otherwise(F.array().cast("array<bigint>")))
    df = df.withColumn("_has", F.size(F.array_distinct("_win")) < F.size("_win"))
    pairs = F.array_sort(F.transform("_win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("_ord", F.when(F.col("_has"), pairs))

    def equal(j: Column, other: Column) -> Column:
        return F.get(F.col("_ord"), j).getField("h") == F.get(F.col("_ord"), other).getField("h")

    def flagged(j: Column) -> Column:
        same = F.coalesce(equal(j, j - 1), F.lit(False)) | F.coalesce(equal(j, j + 1), F.lit(False))
        return F.when(same, F.get(F.col("_ord"), j).getField("i")).otherwise(F.lit(-1))

    at = F.transform(F.sequence(F.lit(0), F.size("_ord") - 1), flagged)
    df = df.withColumn("_pos", F.when(F.col("_has"), F.array_sort(F.filter(at, lambda p: p >= 0))))

    def step(total: Column, j: Column) -> Column:
        gap = F.coalesce(F.get(F.col("_pos"), j + 1) - F.get(F.col("_pos"), j), F.lit(k))
        return total + F.least(F.lit(k), gap)

    covered = F.aggregate(F.sequence(F.lit(0), F.size("_pos") - 1), F.lit(0), step)
    return df.withColumn("n_repeat_words", F.when(F.col("_has"), covered).otherwise(F.lit(0)).cast("bigint"))


def measures(df: DataFrame, text: Column, *keep: str) -> DataFrame:
    """The measures, base rule and number of failed soft rules of each row."""
    df = _with_repeats(_with_words(df, text))
    repeats = F.col("n_repeat_words") * 100
    base = (F.col("n_words") < MIN_WORDS) | (repeats > F.col("n_words") * MAX_REPEAT_PCT)
    soft = [
        F.col("n_symbols") * 10 > F.col("n_words"),
        (F.col("word_chars") < F.col("n_words") * 2) | (F.col("word_chars") > F.col("n_words") * 12),
        F.col("n_dup_lines") * 100 > F.col("_n_lines") * 30,
        repeats > F.col("n_words") * 15,
    ]
    strikes = sum((s.cast("int") for s in soft[1:]), soft[0].cast("int"))
    df = df.withColumn("base_failed", base).withColumn("strikes", strikes)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "strikes"]
    return df.select(*keep, *names)


def host_verdicts(measured: DataFrame, host: str = "host") -> tuple[DataFrame, int]:
    """One row per host: documents, failing documents, shrunk rate, ``bad``.

    The beta prior has the mean and variance of the hosts' rates, corrected
    for sampling noise; its strength is between 1 and 1000 documents.
    """
    failed = (F.col("base_failed") | (F.col("strikes") > 0)).cast("bigint")
    hosts = materialize(
        measured.groupBy(host).agg(F.count(F.lit(1)).alias("n_docs"), F.sum(failed).alias("n_failed")), "hosts"
    )
    rate = F.col("n_failed") / F.col("n_docs")
    s = hosts.agg(
        F.count(F.lit(1)).alias("hosts"),
        F.sum("n_docs").alias("docs"),
        F.sum("n_failed").alias("failed"),
        F.sum(F.floor(rate * rate * 1e6)).alias("squares"),
        F.sum(F.floor(rate * 1e6)).alias("rates"),
        F.sum(F.floor(1e6 / F.col("n_docs"))).alias("inverse"),
    ).first()
    mean = (s["failed"] + 0.5) / (s["docs"] + 1) if s["docs"] else 0.5
    strength = 1.0
    if s["hosts"]:
        average = s["rates"] / 1e6 / s["hosts"]
        noise = mean * (1 - mean) * s["inverse"] / 1e6 / s["hosts"]
        between = max(s["squares"] / 1e6 / s["hosts"] - average * average - noise, 1e-9)
        strength = min(max(mean * (1 - mean) / between - 1, 1.0), 1000.0)
    shrunk = (F.col("n_failed") + F.lit(mean * strength)) / (F.col("n_docs") + F.lit(strength))
    out = hosts.withColumn("host_rate", shrunk).withColumn("bad", F.col("host_rate") > HOST_LIMIT)
    return out, s["hosts"]


def judged(measured: DataFrame, verdicts: DataFrame, n_hosts: int, host: str = "host") -> DataFrame:
    v = Sized(verdicts.select(F.col(host).alias("_host"), "bad", "host_rate"), n_hosts).for_join()
    joined = measured.join(v, F.col(host).eqNullSafe(F.col("_host")), "left").drop("_host")
    limit = F.when(F.col("bad"), F.lit(STRIKES_BAD)).otherwise(F.lit(STRIKES_NORMAL))
    return joined.withColumn("kept", ~F.col("base_failed") & (F.col("strikes") < limit))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_docs(spark, sf_dir).select(col("doc_id"), col("source").alias("host"), text_of().alias("_text"))
    measured = materialize(measures(docs, F.col("_text"), "doc_id", "host"), "quality")
    verdicts, n = host_verdicts(measured)
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged(measured, verdicts, n).select(*names)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the rules reject go.  The measures are
    taken once and written with the rows that pass the base rules."""
    rows = boxed(docs, "source").withColumnRenamed("source", "host")
    rows = rows.withColumn("_text", F.coalesce(F.col("_row").getField("text"), F.lit("")))
    measured = measures(rows, F.col("_text"), "host", "_row").select(
        "host", "base_failed", "strikes", F.when(~F.col("base_failed"), F.col("_row")).alias("_row")
    )
    measured = materialize(measured, "quality")
    verdicts, n = host_verdicts(measured.drop("_row"))
    return unboxed(judged(measured, verdicts, n).filter("kept"), docs.columns)


_W = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, source, coalesce(text, '') AS text, {_W} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), g AS (
  SELECT k, i, list_slice(w, i, i + 7) AS win FROM (SELECT k, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)
), rep AS (
  SELECT k, i FROM g QUALIFY count(*) OVER (PARTITION BY k, win) > 1
), cov AS (
  SELECT k, sum(least(8, coalesce(nx - i, 8))) AS n FROM (SELECT k, i, lead(i) OVER (PARTITION BY k ORDER BY i) AS nx FROM rep) GROUP BY k
), m AS (
  SELECT d.k, doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, len(l) AS n_lines,
         CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN cov ON d.k = cov.k
), f AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         (n_symbols * 10 > n_words)::INT + (word_chars < n_words * 2 OR word_chars > n_words * 12)::INT
         + (n_dup_lines * 100 > n_lines * 30)::INT + (n_repeat_words * 100 > n_words * 15)::INT AS strikes
  FROM m
), h AS (
  SELECT source, count(*) AS n_docs, sum((base_failed OR strikes > 0)::INT) AS n_failed FROM f GROUP BY source
), a AS (
  SELECT count(*) AS hosts, (sum(n_failed) + 0.5::DOUBLE) / (sum(n_docs) + 1) AS mean,
         sum(floor((n_failed / n_docs) * (n_failed / n_docs) * 1e6)) / 1e6 / count(*) AS sq,
         sum(floor(n_failed / n_docs * 1e6)) / 1e6 / count(*) AS av, sum(floor(1e6 / n_docs)) / 1e6 / count(*) AS inv
  FROM (SELECT n_docs::DOUBLE AS n_docs, n_failed::DOUBLE AS n_failed FROM h)
), b AS (
  SELECT mean, least(greatest(mean * (1 - mean) / greatest(sq - av * av - mean * (1 - mean) * inv, 1e-9) - 1, 1.0), 1000.0) AS strength FROM a
), v AS (
  SELECT source, (n_failed + mean * strength) / (n_docs + strength) > 0.5 AS bad FROM h, b
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND strikes < CASE WHEN bad THEN 1 ELSE 2 END AS kept
FROM f JOIN v ON f.source IS NOT DISTINCT FROM v.source
"""
