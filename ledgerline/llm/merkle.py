"""Merkle dataset manifest: a content-addressed DAG over the documents.

Every document is a leaf, the hash of its fields.  Per language the leaves
are ordered by id and folded, ``FANOUT`` consecutive nodes to one; the
languages' subroots are folded likewise into the root.  Inner nodes are
stored as records *digest -> children digests*, one per distinct digest, so
equal sub-DAGs are stored once.

Proofs come from the records by descent.  All requests start at the root; one
step joins the requests' current digests with the records, each request
follows the child that the next digit of its rank names, and the unselected
children to its left and right are put on its path.  Requests that share the
upper digits of their ranks travel as one row until they part, so a step moves
one row per distinct node and the last one moves one row per run of leaves.
The documents join the run that holds them, and the path segments, collected
from the root downwards, are reversed into proof order.

Each fold and each step is one hash aggregation or one join whose size falls
or grows by ``FANOUT`` per level; their number is the depth of the DAG, the
logarithm of the rows.  Nothing is collected but one depth and one digest.

Defined results: a null field counts as ``-``, an empty text as ``0:``; very
long texts are hashed whole, by row.  Leaves that share an id (repeated rows,
null ids, which come first) are ordered by their digest, so equal rows have
equal leaves and swap without effect.  A null or empty language is a group of
its own.  An empty table has no root and no proofs.  Extra columns do not
matter.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import Sized, col, fold_ascii, materialize, read_docs
from ledgerline.operators.sequence import with_row_index

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_NO_PATH = "array<struct<before:string,after:string>>"


def _hash(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def field(c: Column) -> Column:
    """A field inside a leaf: byte count, colon, value; ``-`` where null."""
    value = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(fields: list[Column]) -> Column:
    return _hash(F.concat(*[field(c) for c in fields]))


@dataclass
class Manifest:
    """``leaves``: (id, lang, rank, leaf and the columns asked for);
    ``groups``: (lang, place, n, subroot, depth); ``records``: (digest,
    children), unique by digest; ``root`` and ``depth`` of the DAG above the
    subroots (None and 0 for an empty table)."""

    leaves: DataFrame
    groups: Sized
    records: DataFrame
    root: str | None
    depth: int
    fanout: int = FANOUT


def fold(nodes: DataFrame, keys: list[str], fanout: int = FANOUT) -> tuple[DataFrame, list[DataFrame]]:
    """Fold each tree's nodes (keys, rank, n, digest) to one: returns
    (keys, n, digest, depth) and the records of the inner nodes, by level."""
    tops, levels, depth = [], [], 0
    while True:
        tops.append(nodes.filter("n = 1").select(*keys, "digest", F.lit(depth).alias("depth")))
        grow = nodes.filter("n > 1")
        run = F.floor(F.col("rank") / fanout).cast("bigint")
        kids = F.transform(F.array_sort(F.collect_list(F.struct("rank", "digest"))), lambda k: k["digest"])
        grow = grow.groupBy(*keys, run.alias("_run")).agg(F.first("n").alias("_n"), kids.alias("children"))
        grow = grow.select(
            *keys,
            F.col("_run").alias("rank"),
            F.ceil(F.col("_n") / fanout).cast("bigint").alias("n"),
            _hash(F.array_join("children", "")).alias("digest"),
            "children",
        )
        grow = materialize(grow, "merkle-level")
        if not grow.take(1):
            break
        levels.append(grow.select("digest", "children"))
        nodes, depth = grow.drop("children"), depth + 1
    out = tops[0]
    for t in tops[1:]:
        out = out.unionByName(t)
    return out, levels


def build(
    docs: DataFrame,
    id_col: str = "doc_id",
    lang_col: str = "lang",
    fields: tuple[str, ...] = FIELDS,
    extra: dict[str, Callable[[DataFrame], Column]] | None = None,
    fanout: int = FANOUT,
) -> Manifest:
    """Hash, order and fold the documents.  ``extra`` names further columns of
    the leaves table, made from the documents in the same pass."""
    added = {n: make(docs) for n, make in (extra or {}).items()}
    leaves = docs.select(
        col(id_col).alias("id"),
        col(lang_col).alias("lang"),
        leaf_digest([col(f) for f in fields]).alias("leaf"),
        *[c.alias(n) for n, c in added.items()],
    )
    # hashed once: the range partitioning below samples its input
    leaves = materialize(leaves, "merkle-leaves")
    order = [F.col("lang").asc_nulls_first(), F.col("id").asc_nulls_first(), F.col("leaf")]
    leaves = with_row_index(leaves, order, "_at")
    sizes = leaves.groupBy("lang").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("n"))
    sizes = materialize(with_row_index(sizes, [F.col("lang").asc_nulls_first()], "place"), "merkle-langs")
    sizes = Sized(sizes, sizes.count())
    of = sizes.for_join().withColumnRenamed("lang", "_lang")
    leaves = leaves.join(of, F.col("lang").eqNullSafe(F.col("_lang")))
    leaves = leaves.withColumn("rank", F.col("_at") - F.col("_first")).drop("_at", "_first", "_lang")

    nodes = leaves.select("place", "rank", "n", F.col("leaf").alias("digest"))
    tops, low = fold(nodes, ["place"], fanout)
    tops = tops.withColumnRenamed("digest", "subroot")
    groups = materialize(sizes.df.drop("_first").join(tops, "place"), "merkle-groups")
    groups = Sized(groups, sizes.rows)
    upper = groups.df.select(
        F.lit(0).alias("tree"), F.col("place").alias("rank"), F.lit(sizes.rows).cast("bigint").alias("n"),
        F.col("subroot").alias("digest"),
    )
    top, high = fold(upper, ["tree"], fanout)
    row = top.first()
    records = None
    for level in low + high:
        records = level if records is None else records.unionByName(level)
    if records is None:
        records = docs.sparkSession.createDataFrame([], "digest string, children array<string>")
    # content addressed: equal digests have equal children
    records = materialize(records.dropDuplicates(["digest"]), "merkle-records")
    return Manifest(leaves, groups, records, row and row["digest"], row["depth"] if row else 0, fanout)


def _siblings(children: Column, digit: Column) -> Column:
    return F.struct(
        F.array_join(F.slice(children, F.lit(1), digit), "").alias("before"),
        F.array_join(F.slice(children, digit + 2, F.size(children)), "").alias("after"),
    )


def descend(at: DataFrame, records: DataFrame, keys: list[str], fanout: int = FANOUT) -> DataFrame:
    """One step: requests (keys, prefix, digest, path, left) to every child of
    their node, the unselected children appended to the path."""
    at = at.withColumnRenamed("digest", "_digest").join(records, F.col("_digest") == F.col("digest"))
    kids = at.select(*keys, "prefix", "path", "left", "children", F.posexplode("children").alias("_digit", "_child"))
    return kids.select(
        *keys,
        (F.col("prefix") * fanout + F.col("_digit")).alias("prefix"),
        F.col("_child").alias("digest"),
        F.concat("path", F.array(_siblings(F.col("children"), F.col("_digit")))).alias("path"),
        (F.col("left") - 1).alias("left"),
    )


def leaf_runs(manifest: Manifest) -> DataFrame:
    """(lang, place, run, subroot, children, path): every run of leaves with
    the path from the root down to it, by descent from the root."""
    no_path = F.array().cast(_NO_PATH)
    groups = manifest.groups.df
    start = groups.sparkSession.range(1).select(
        F.lit(0).cast("bigint").alias("prefix"), F.lit(manifest.root).alias("digest"), no_path.alias("path"),
        F.lit(manifest.depth).alias("left"),
    )
    for _ in range(manifest.depth):
        start = descend(start, manifest.records, [], manifest.fanout)
    langs = groups.select("lang", "place", "subroot", "depth")
    at = start.select(F.col("prefix").alias("place"), "digest", "path").join(langs, "place")
    at = at.filter(F.col("digest") == F.col("subroot"))
    keys = ["place", "subroot"]
    at = at.select(*keys, F.lit(0).cast("bigint").alias("prefix"), "digest", "path", F.col("depth").alias("left"))
    at = materialize(at, "merkle-at")
    # a group of one leaf: its subroot is the leaf
    done = [at.filter("left = 0").select(*keys, F.col("prefix").alias("run"), "path", F.array("digest").alias("children"))]
    for _ in range(groups.agg(F.max("depth")).first()[0] or 0):
        last = at.filter("left = 1").join(manifest.records, "digest")
        done.append(last.select(*keys, F.col("prefix").alias("run"), "path", "children"))
        at = materialize(descend(at.filter("left > 1"), manifest.records, keys, manifest.fanout), "merkle-at")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def refold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path, from the leaf upwards, give."""
    return F.aggregate(path, leaf, lambda h, s: _hash(F.concat(s["before"], h, s["after"])))


def prove(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """The requested leaves (rows of ``manifest.leaves``) with their
    ``subroot`` and their ``path`` from the leaf up to the root: the siblings
    before and after the node, level by level.  A leaf that is not at its
    rank in the DAG has no row."""
    if manifest.root is None:
        return requests.limit(0).withColumn("subroot", F.lit("")).withColumn("path", F.array().cast(_NO_PATH))
    runs = leaf_runs(manifest).withColumnRenamed("run", "_run")
    digit = (F.col("rank") % manifest.fanout).cast("int")
    out = requests.withColumn("_run", F.floor(F.col("rank") / manifest.fanout).cast("bigint")).join(runs, ["place", "_run"])
    out = out.filter(F.get("children", digit) == F.col("leaf"))
    alone = F.size("children") == 1
    own = F.when(alone & (F.col("n") == 1), F.array().cast(_NO_PATH)).otherwise(F.array(_siblings(F.col("children"), digit)))
    return out.withColumn("path", F.reverse(F.concat("path", own))).drop("_run", "children")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    def tampered(docs: DataFrame) -> Column:
        lowered = [fold_ascii(col(f)) if f == "text" else col(f) for f in FIELDS]
        chosen = F.crc32(col("doc_id").cast("string").cast("binary")) % 3 == 0
        return F.when(chosen, leaf_digest(lowered))

    manifest = build(read_docs(spark, sf_dir), extra={"tampered": tampered})
    out = prove(manifest, manifest.leaves)
    siblings = F.transform("path", lambda s: F.concat(s["before"], s["after"]))
    folded = refold(F.coalesce("tampered", "leaf"), F.col("path"))
    out = out.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", F.lit(manifest.root).cast("string").alias("root"),
        _hash(F.array_join(siblings, "")).alias("proof_sha256"), folded.alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


# The levels are folded by recursion, the proofs joined from the stored levels.
# CRC-32 is stated bit by bit: its polynomial reversed is 3988292384.
ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS k, *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
         xor(list_reduce([4294967295]::BIGINT[] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
           lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
             lambda v, i: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END))),
           4294967295::BIGINT) % 3 = 0 AS chosen
  FROM documents
), f AS (
  SELECT k, doc_id, lang, chosen,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
         coalesce(strlen(text) || ':' || text, '-') AS body, coalesce(strlen(low) || ':' || low, '-') AS low_body
  FROM d
), l AS (
  SELECT k, doc_id, sha256(head || body) AS leaf,
         CASE WHEN chosen THEN sha256(head || low_body) ELSE sha256(head || body) END AS start,
         dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, lang
  FROM f
), r AS (
  SELECT *, row_number() OVER (PARTITION BY place ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank,
         count(*) OVER (PARTITION BY place) AS n
  FROM l
), low AS (
  SELECT place, 0 AS lv, rank, n, leaf AS digest FROM r
  UNION ALL
  SELECT place, lv + 1, rank // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY rank))
  FROM low WHERE n > 1 GROUP BY place, lv, rank // 8, n
), sub AS (
  SELECT place, digest AS subroot, lv AS depth FROM low WHERE n = 1
), top AS (
  SELECT 0 AS lv, place AS rank, (SELECT count(*) FROM sub) AS n, subroot AS digest FROM sub
  UNION ALL
  SELECT lv + 1, rank // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY rank))
  FROM top WHERE n > 1 GROUP BY lv, rank // 8, n
), asked AS (
  SELECT r.k, r.place, 0 AS seg, s.depth, lv, (rank // CAST(pow(8, lv) AS BIGINT)) AS pos
  FROM r JOIN sub s USING (place), range(0, 12) t(lv) WHERE lv < s.depth
  UNION ALL
  SELECT k, r.place, 1, s.depth, lv, (r.place // CAST(pow(8, lv) AS BIGINT))
  FROM r JOIN sub s USING (place), range(0, 12) t(lv) WHERE lv < (SELECT max(lv) FROM top)
), node AS (
  SELECT 0 AS seg, place, lv, rank, digest FROM low UNION ALL SELECT 1, NULL, lv, rank, digest FROM top
), step AS (
  SELECT k, a.seg * a.depth + a.lv AS at_level,
         coalesce(string_agg(digest, '' ORDER BY rank) FILTER (WHERE x.rank < a.pos), '') AS before,
         coalesce(string_agg(digest, '' ORDER BY rank) FILTER (WHERE x.rank > a.pos), '') AS after
  FROM asked a JOIN node x ON x.seg = a.seg AND x.lv = a.lv AND x.rank // 8 = a.pos // 8
       AND (a.seg = 1 OR x.place = a.place)
  GROUP BY k, a.seg, a.depth, a.lv
), folded AS (
  SELECT k, 0 AS at_level, start AS h FROM r
  UNION ALL
  SELECT k, at_level + 1, sha256(s.before || h || s.after) FROM folded JOIN step s USING (k, at_level)
), last AS (
  SELECT k, arg_max(h, at_level) AS folded_root FROM folded GROUP BY k
), proof AS (
  SELECT k, sha256(string_agg(before || after, '' ORDER BY at_level)) AS proof_sha256 FROM step GROUP BY k
)
SELECT doc_id, leaf, subroot, (SELECT digest FROM top WHERE n = 1) AS root,
       coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root,
       folded_root = (SELECT digest FROM top WHERE n = 1) AS verified
FROM r JOIN sub USING (place) JOIN last USING (k) LEFT JOIN proof USING (k)
"""
