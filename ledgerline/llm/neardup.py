"""MinHash near-dedup with bottom-k sketches of one hash function.

1. Every text becomes its set of 5-word shingles (64-bit hashes).  Texts with
   equal sets are one class, found by a digest of the set; only one row per
   class goes on.  Its sketch is the ``SKETCH`` smallest hashes.
2. Inverted lists: a class is listed under every run of ``RUN`` neighbouring
   values among its first ``LISTED`` retained ones.  Two sets with a
   resemblance of 0.85 share a list unless no ``RUN`` of the union's first
   values are all common, a chance below 1e-8; unrelated sets with a common
   passage hardly ever do.
3. Each list is compared with its hub only, the member that shares most
   lists, so a list costs as many pairs as it has members.  The union-sketch
   estimate drops unlike pairs, and the exact resemblance of the full sets
   decides the rest, in a stream over the members of a hub.
4. Members that are not linked to their hub are compared exactly with all
   other members of that hub, in tiles of bounded size; inside a tile,
   intersections are counted from posting lists, and only links between
   parts not yet connected are returned.
5. Components of the verified links (``components``), then back to documents.

A group of copies of any size is one class, and near copies cost one
comparison each with their hub; hubs with many members are salted.

Defined results: a text without words (or null) links with nothing; rows
with equal text are one class whatever their ids, repeated rows get the same
result; a null id takes its class's smallest id as component, or null, and is
kept only where no member has an id; other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import Sized, boxed, col, materialize, read_docs, runs, ship_package, text_of, unboxed
from ledgerline.llm.components import components

SHINGLE = 5
PERCENT = 85
SKETCH = 64
LISTED = 40
RUN = 3
#: Smallest set that can resemble a different one: (n - 1) / n >= 0.85.
SMALLEST = 6
#: Sketches of sets with resemblance 0.85 estimate less with chance < 1e-9.
ESTIMATE = 0.5
SALT = 2000
TILE_SETS, TILE_SHINGLES = 1000, 2_000_000


def _ordered(hashes: np.ndarray) -> np.ndarray:
    """uint64 as int64 in the same order, so that SQL sorts them alike."""
    return (hashes ^ np.uint64(1 << 63)).view(np.int64)


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def resembles(shared: int, a: int, b: int, percent: int = PERCENT) -> bool:
    return 100 * shared >= percent * (a + b - shared)


def profiles(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, n_shingles, digest, sketch) of every row."""
    ship_package(docs.sparkSession)
    text = text_of(text_col)
    rows = docs.select(col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    schema = T.StructType(
        [
            *rows.schema.fields[:2],
            T.StructField("n_shingles", T.LongType()),
            T.StructField("digest", T.BinaryType()),
            T.StructField("sketch", T.ArrayType(T.LongType())),
        ]
    )

    def profile(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from ledgerline.llm.words import shingle_set

        for batch in batches:
            sizes, digests, sketches = [], [], []
            for t in batch.column("text").to_pylist():
                s = shingle_set(t, SHINGLE)
                sizes.append(len(s))
                digests.append(_digest(s))
                sketches.append(_ordered(s[:SKETCH]))
            values = pa.array(np.concatenate(sketches) if sketches else np.empty(0, np.int64))
            offsets = pa.array(np.concatenate(([0], np.cumsum([len(s) for s in sketches]))), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_key"),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.ListArray.from_arrays(offsets, values),
                ],
                names=schema.names,
            )

    return rows.mapInArrow(profile, schema)


def classes(profiled: DataFrame) -> DataFrame:
    """One row per distinct set that can link with another."""
    out = profiled.filter(F.col("n_shingles") >= SMALLEST).groupBy("digest")
    return out.agg(
        F.min(F.struct("doc_id", "text_key")).alias("at"),
        F.first("n_shingles").alias("n"),
        F.first("sketch").alias("sketch"),
    )


def hub_members(sets: DataFrame) -> DataFrame:
    """Distinct (hub, digest) over all inverted lists."""
    starts = F.sequence(F.lit(1), F.least(F.lit(LISTED - RUN + 1), F.size("sketch") - RUN + 1))
    keys = F.transform(starts, lambda i: F.xxhash64(F.slice(F.col("sketch"), i, RUN)))
    postings = sets.select("digest", F.explode(F.array_distinct(keys)).alias("key"))
    shared = postings.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    postings = materialize(postings.join(shared, "key"), "postings")
    score = postings.groupBy("digest").agg(F.sum(F.floor(F.log2("c") * 16)).alias("score"))
    scored = postings.join(score, "digest")
    hubs = scored.groupBy("key").agg(F.max(F.struct("score", "digest")).alias("top"))
    hubs = hubs.select("key", F.col("top.digest").alias("hub"))
    members = postings.join(hubs, "key").filter(F.col("digest") != F.col("hub"))
    return members.select("hub", "digest").distinct()


def estimate(a: Column, b: Column) -> Column:
    """Share of the union's bottom-k values that both sketches retain."""
    union = F.slice(F.array_sort(F.array_union(a, b)), 1, SKETCH)
    return F.size(F.array_intersect(F.array_intersect(union, a), b)) / F.size(union)


def estimated(members: DataFrame, sets: DataFrame) -> DataFrame:
    """``members`` with ``near``: sizes and sketches allow the resemblance."""
    mine = sets.select("digest", F.col("n").alias("n"), "sketch")
    hubs = sets.select(F.col("digest").alias("hub"), F.col("n").alias("hub_n"), F.col("sketch").alias("hub_sketch"))
    both = members.join(mine, "digest").join(hubs, "hub")
    sizes = F.least("n", "hub_n") * 100 >= F.greatest("n", "hub_n") * PERCENT
    near = sizes & (estimate(F.col("sketch"), F.col("hub_sketch")) >= ESTIMATE)
    return both.select("hub", "digest", "n", near.alias("near"))


def with_texts(rows: DataFrame, sets: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``rows`` (with ``digest``) plus the text of each digest's first row.

    Texts are fetched for the wanted digests only: their places are broadcast
    behind a counted size, else both sides are shuffled by place.
    """
    wanted = materialize(rows.select("digest").distinct().join(sets.select("digest", "at"), "digest"), "wanted")
    places = wanted.select("digest", F.col("at.doc_id").alias("_id"), F.col("at.text_key").alias("_key"))
    places = Sized(places, wanted.count()).for_join(max_rows=500_000)
    text = text_of(text_col)
    src = docs.select(col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    same = F.col("text_key").eqNullSafe(F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    texts = src.join(places, same).select("digest", "text").dropDuplicates(["digest"])
    return rows.join(texts, "digest")


_EDGE = "a binary, b binary"


def hub_links(pairs: DataFrame, sets: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Verified links (a = hub, b = member) of (hub, digest) pairs."""
    sizes = pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / SALT).cast("int").alias("salts"))
    salt = F.pmod(F.xxhash64("digest"), F.col("salts")).cast("int")
    members = pairs.join(sizes, "hub").select("hub", salt.alias("salt"), F.lit(1).alias("side"), "digest")
    hubs = sizes.select("hub", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    hubs = hubs.select("hub", "salt", F.lit(0).alias("side"), F.col("hub").alias("digest"))
    rows = with_texts(members.unionByName(hubs), sets, docs, id_col, text_col)
    rows = rows.repartition("hub", "salt").sortWithinPartitions("hub", "salt", "side", "digest")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from ledgerline.llm.words import shingle_set

        hub = None
        for batch in batches:
            out = []
            for side, digest, text in zip(batch["side"], batch["digest"], batch["text"], strict=True):
                s = shingle_set(text, SHINGLE)
                if side == 0:
                    hub = (digest, s)
                elif resembles(len(np.intersect1d(hub[1], s, assume_unique=True)), len(hub[1]), len(s)):
                    out.append((hub[0], digest))
            yield pd.DataFrame(out, columns=["a", "b"])

    return rows.mapInPandas(verify, _EDGE)


def tile_links(frame: pd.DataFrame) -> list[tuple[bytes, bytes]]:
    """Links of a tile between parts not yet connected: rows with ``left`` are
    compared with all rows; rows that are not ``left`` are one part."""
    from ledgerline.llm.words import shingle_set

    digests, left = frame["digest"].tolist(), frame["left"].to_numpy(dtype=bool)
    sets = [shingle_set(t, SHINGLE) for t in frame["text"]]
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, code, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(code, kind="stable")
    lists = owner[order]
    ends = np.cumsum(count)
    first = np.concatenate(([0], np.cumsum(sizes)))
    part = np.where(left, np.arange(len(sets)), len(sets))

    def shared_with(codes: np.ndarray) -> np.ndarray:
        codes = codes[count[codes] > 1]
        lens = count[codes]
        at = np.arange(lens.sum()) - np.repeat(np.cumsum(lens) - lens, lens) + np.repeat(ends[codes] - lens, lens)
        return np.bincount(lists[at], minlength=len(sets))

    out = []
    for x in np.flatnonzero(left):
        codes = code[first[x] : first[x + 1]]
        sketch = np.minimum(sizes, SKETCH)
        # Values retained by both sketches are at least those of the union's.
        close = shared_with(codes[:SKETCH]) >= ESTIMATE * np.minimum(sketch, sketch[x])
        close &= (part != part[x]) & (100 * np.minimum(sizes, sizes[x]) >= PERCENT * np.maximum(sizes, sizes[x]))
        if not close.any():
            continue
        shared = shared_with(codes)
        linked = close & (100 * shared >= PERCENT * (sizes + sizes[x] - shared))
        for y in np.flatnonzero(linked):
            if part[x] != part[y]:
                out.append((digests[x], digests[y]))
                part[part == part[x]] = part[y]
    return out


def remainder_links(
    members: DataFrame, links: DataFrame, sets: DataFrame, docs: DataFrame, id_col: str, text_col: str
) -> DataFrame:
    """Links among the members of a hub of which one at least is not linked
    to the hub."""
    known = links.select(F.col("a").alias("hub"), F.col("b").alias("digest"), F.lit(False).alias("_known"))
    rows = members.join(known, ["hub", "digest"], "left").withColumn("left", F.coalesce("_known", F.lit(True)))
    one = F.lit(1.0)

    def blocks(of: Column) -> Column:
        sets_ = F.sum(F.when(of, one)) / TILE_SETS
        return F.greatest(F.lit(1), F.ceil(F.greatest(sets_, F.sum(F.when(of, F.col("n"))) / TILE_SHINGLES)).cast("int"))

    sizes = rows.groupBy("hub").agg(
        F.count(F.lit(1)).alias("size"),
        F.max("left").alias("any_left"),
        blocks(F.col("left")).alias("lefts"),
        blocks(F.lit(True)).alias("rights"),
    )
    rows = rows.join(sizes.filter("any_left AND size > 1"), "hub")
    h = F.xxhash64("digest")
    i, j = F.pmod(h, F.col("lefts")).cast("int"), F.pmod(h, F.col("rights")).cast("int")
    as_right = F.transform(F.sequence(F.lit(0), F.col("lefts") - 1), lambda k: F.struct(k.alias("i"), j.alias("j")))
    as_left = F.transform(F.sequence(F.lit(0), F.col("rights") - 1), lambda k: F.struct(i.alias("i"), k.alias("j")))
    tiles = F.when(F.col("left"), F.array_union(as_left, as_right)).otherwise(as_right)
    placed = rows.select("hub", "digest", "left", i.alias("own"), F.explode(tiles).alias("tile"))
    # A left member met in another row of tiles is there as a right one, but
    # still a part of its own.
    placed = placed.select("hub", F.col("tile.i").alias("i"), F.col("tile.j").alias("j"), "digest", "left")
    texts = with_texts(placed, sets, docs, id_col, text_col)
    texts = texts.repartition("hub", "i", "j").sortWithinPartitions("hub", "i", "j", "digest")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, frame in runs(batches, ["hub", "i", "j"]):
            yield pd.DataFrame(tile_links(frame), columns=["a", "b"])

    return texts.mapInPandas(verify, _EDGE)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id, kept) of every row."""
    profiled = materialize(profiles(docs, id_col, text_col), "profiles")
    sets = materialize(classes(profiled), "sets")
    members = materialize(estimated(hub_members(sets), sets), "members")
    links = materialize(hub_links(members.filter("near"), sets, docs, id_col, text_col), "links")
    more = materialize(remainder_links(members, links, sets, docs, id_col, text_col), "links")
    labels = components(links.unionByName(more)).withColumnRenamed("node", "digest")
    linked = profiled.groupBy("digest").agg(F.min("doc_id").alias("least")).join(labels, "digest", "left")
    smallest = linked.filter(F.col("label").isNotNull()).groupBy("label").agg(F.min("least").alias("lowest"))
    per_class = linked.join(smallest, "label", "left").select("digest", F.coalesce("lowest", "least").alias("lowest"))
    rows = profiled.select("doc_id", "text_key", "n_shingles", "digest").join(per_class, "digest")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("lowest"))
    rows = rows.withColumn("component_id", component)
    return rows.select(
        "doc_id", "text_key", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(read_docs(spark, sf_dir))
    return out.select("doc_id", "n_shingles", "component_id", "kept")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each group stays.  Rows that repeat a
    kept id and text stay together, as they are one document."""
    verdict = near_duplicates(docs).filter(~F.col("kept")).select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")
    )
    rows = boxed(docs, "doc_id").withColumn("_text_key", F.xxhash64(F.coalesce(F.col("_row").getField("text"), F.lit(""))))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_key") == F.col("_key"))
    return unboxed(rows.join(verdict, same, "left_anti"), docs.columns)


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS k, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT k, list_slice(w, i, i + 4) AS sh
  FROM (SELECT k, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)
), n AS (
  SELECT k, count(*) AS n FROM s GROUP BY k
), c AS (
  SELECT a.k AS x, b.k AS y, count(*) AS shared FROM s a JOIN s b ON a.sh = b.sh AND a.k <> b.k GROUP BY a.k, b.k
), e AS (
  SELECT x, y FROM c JOIN n p ON p.k = x JOIN n q ON q.k = y WHERE 100 * shared >= 85 * (p.n + q.n - shared)
), r(k, m) AS (
  SELECT k, doc_id FROM d
  UNION
  SELECT e.y, r.m FROM r JOIN e ON e.x = r.k
), m AS (
  SELECT k, min(m) AS component_id FROM r GROUP BY k
)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM d JOIN m USING (k) LEFT JOIN n USING (k)
"""
