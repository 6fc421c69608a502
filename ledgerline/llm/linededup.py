"""Line dedup: keep a repeated line only in the smallest document that has it.

Each line becomes a 128-bit hash of its key (trimmed, A-Z folded) with its
document and position; no text is moved for the search.  The hashes are
range-partitioned and sorted by (hash, document, position), and a running
minimum streams each hash's first occurrence past its later ones.  Hashes
that hold more than 1/4096 of all lines, at most 4096 of them, would make hot
partitions: a partial aggregate finds them with their first document, and
that proven-small table is broadcast to decide their lines in place.

The decisions return as one sparse bitmap per document (32 lines to a word,
only words with a dropped line) instead of text, and are applied to the
documents by one join.

Defined results: null or empty text is one empty line; keys under 10 code
points always stay; rows that share a doc_id are one document, but each text
keeps its own bitmap; a null doc_id orders after all others; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.common import SPACES, boxed, col, fold_ascii, materialize, read_docs, text_of

MIN_KEY = 10
HOT_SHARE = 4096
_WORD = 32


def line_hashes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(h1, h2, doc_id, text_key, pos) of every line whose key is long enough."""
    text = text_of(text_col)
    src = docs.select(col(id_col).alias("doc_id"), text.alias("_t"), F.xxhash64(text).alias("text_key"))
    lines = src.select("doc_id", "text_key", F.posexplode(F.split("_t", "\n")).alias("pos", "line"))
    key = F.btrim("line", F.lit(SPACES))
    lines = lines.select("doc_id", "text_key", "pos", key.alias("_k")).filter(F.length("_k") >= MIN_KEY)
    digest = F.unhex(F.md5(fold_ascii(F.col("_k")).cast("binary")))
    return lines.select(digest.alias("h"), "doc_id", "text_key", "pos")


def _after(doc: Column, first: Column) -> Column:
    """The line lies in another document than the hash's first one."""
    return ~doc.eqNullSafe(first) & first.isNotNull()


def dropped_lines(lines: DataFrame) -> DataFrame:
    """(doc_id, text_key, pos) of the lines to drop."""
    counts = lines.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"))
    counts = materialize(counts.filter("n > 1"), "linecounts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = counts.filter(F.col("n") > max(total // HOT_SHARE, 1)).select(F.col("h").alias("_h"), "first")
    # At most HOT_SHARE rows: their counts add up to no more than the total.
    marked = lines.join(F.broadcast(hot), F.col("h") == F.col("_h"), "left")
    in_hot = marked.filter(F.col("_h").isNotNull()).filter(_after(F.col("doc_id"), F.col("first")))
    rest = marked.filter(F.col("_h").isNull()).select("h", "doc_id", "text_key", "pos")
    ranged = rest.repartitionByRange("h")
    order = [F.col("doc_id").asc_nulls_last(), F.col("pos")]
    stream = Window.partitionBy("h").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    later = ranged.withColumn("first", F.first("doc_id").over(stream)).filter(_after(F.col("doc_id"), F.col("first")))
    names = ["doc_id", "text_key", "pos"]
    return in_hot.select(*names).unionByName(later.select(*names))


def drop_bitmaps(dropped: DataFrame) -> DataFrame:
    """One sparse bitmap per document: map of word number to 32 drop bits."""
    bit = F.expr(f"shiftleft(1L, pos % {_WORD})")
    words = dropped.groupBy("doc_id", "text_key", F.floor(F.col("pos") / _WORD).cast("int").alias("word"))
    words = words.agg(F.bit_or(bit).alias("bits"))
    entries = F.map_from_entries(F.collect_list(F.struct("word", "bits")))
    return words.groupBy("doc_id", "text_key").agg(entries.alias("drops"))


def _is_dropped(pos: Column) -> Column:
    bits = F.coalesce(F.element_at(F.col("drops"), F.floor(pos / _WORD).cast("int")), F.lit(0).cast("bigint"))
    return F.getbit(bits, (pos % _WORD).cast("int")) == 1


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every input row as ``_row`` with ``lines`` and the ``kept_lines``."""
    lines = line_hashes(docs, id_col, text_col)
    maps = drop_bitmaps(dropped_lines(lines)).withColumnsRenamed({"doc_id": "_id", "text_key": "_key"})
    rows = boxed(docs).withColumn("doc_id", F.col("_row").getField(id_col))
    rows = rows.withColumn("_text", F.coalesce(F.col("_row").getField(text_col), F.lit("")))
    rows = rows.withColumn("text_key", F.xxhash64("_text"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    out = rows.join(maps, same, "left").withColumn("lines", F.split("_text", "\n"))
    kept = F.when(F.col("drops").isNull(), F.col("lines")).otherwise(
        F.filter("lines", lambda _, i: ~_is_dropped(i))
    )
    return out.withColumn("kept_lines", kept).select("_row", "doc_id", "lines", "kept_lines")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(read_docs(spark, sf_dir).select("doc_id", "text"))
    return out.select(
        "doc_id",
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size("kept_lines")).cast("bigint").alias("n_dropped"),
        F.sha2(F.array_join("kept_lines", "\n").cast("binary"), 256).alias("kept_sha256"),
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents without their repeated lines; n_chars follows
    the text, and a document of which no line is left goes."""
    out = line_dedup(docs)
    text = F.array_join("kept_lines", "\n")
    kept = out.filter((F.size("kept_lines") > 0) | (F.size("lines") == 0)).withColumn("_text", text)
    new = {"text": F.col("_text"), "n_chars": F.length("_text").cast("bigint")}
    return kept.select(*[new.get(c, F.col("_row").getField(c)).alias(c) for c in docs.columns])


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents
), x AS (
  SELECT k, doc_id, i, l[i] AS line,
         translate(trim(l[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT k, doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM d)
), y AS (
  SELECT *, length(key) >= 10 AND doc_id > min(doc_id) OVER (PARTITION BY key) AS gone FROM x
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(gone::INT) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM y GROUP BY k, doc_id
"""
