"""Document fingerprints: a homomorphic multiset hash of paragraphs.

A paragraph (a line of the text) hashes to a wide vector: ``EXACT_LANES``
lanes of 32 bits from its MD5, and ``SIGN_LANES`` lanes that count, over its
sentences, the set bits of the sentence hash.  A fingerprint is the sum of
its paragraphs' vectors, lane by lane, modulo 2**32.  A text has fewer than
2**31 sentences, so no count of a sign lane wraps.  The fingerprint does not
depend on the order of paragraphs, equal multisets have equal fingerprints,
and a paragraph is inserted or deleted by adding or subtracting its vector
(``combine``) without the rest of the text.

``likeness`` reads two fingerprints only.  A sign lane is ``2 * count - n``,
a random +-1 projection of the multiset of sentences, so dot products of the
lanes estimate the sentences in common; 2ab / (aa + bb) is 1 for equal
fingerprints and about 0 for unrelated texts, with a standard error of 0.09.

Scale: paragraphs stream through one partial aggregate whose state is one
row per document.  Whole texts are shuffled once, by document key; a
document's next one sends only the head that is needed (half the document's
length), found through a numbered table of ids and lengths.

Defined results: null text is empty and has one empty paragraph; equal ids
order by the text's hash, and repeated rows (same id and text) count as one
document whose result every copy gets; a null id orders after all others;
the only document of a table is its own next one; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import col, materialize, read_docs, text_of
from ledgerline.operators.sequence import with_row_index_counted

EXACT_LANES = 4
SIGN_LANES = 128
_M32 = 0xFFFFFFFF


def _long(x: int) -> Column:
    return F.lit(x).cast("bigint")


def _signed(lane: Column) -> Column:
    """A lane from 0 to 2**32 - 1 as the int of the same 32 bits."""
    return F.when(lane > _M32 >> 1, lane - _long(1 << 32)).otherwise(lane).cast("int")


def vectors(texts: DataFrame, key: str = "key", text: str = "text") -> DataFrame:
    """(key, exact array<bigint>, n bigint, sign array<int>) per key.

    Two sign lanes are summed at once in the halves of a 64-bit integer; a
    text has fewer than 2**31 sentences, so the halves never meet.  Repeated
    rows of a key sum to a multiple, which the row count divides out exactly.
    """
    paragraphs = texts.select(F.col(key).alias("key"), F.posexplode(F.split(text, "\n")).alias("lpos", "line"))
    units = paragraphs.select("key", "lpos", "line", F.posexplode(F.split("line", r"(?<=[.!?]) ")).alias("pos", "s"))
    digest = F.when(F.col("pos") == 0, F.md5(F.col("line").cast("binary")))
    seeds = range(SIGN_LANES // 64)
    units = units.select(
        "key",
        ((F.col("lpos") == 0) & (F.col("pos") == 0)).cast("int").alias("first"),
        digest.alias("digest"),
        *[F.xxhash64("s", F.lit(k)).alias(f"h{k}") for k in seeds],
    )
    pair = _long(0x0000000100000001)
    exact = [F.conv(F.substring("digest", 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(EXACT_LANES)]
    sums = [F.sum("first").alias("copies"), F.count(F.lit(1)).alias("n")]
    sums += [F.sum(e).alias(f"e{i}") for i, e in enumerate(exact)]
    sums += [F.sum(F.shiftright(f"h{k}", b).bitwiseAND(pair)).alias(f"s{k}_{b}") for k in seeds for b in range(32)]
    out = units.groupBy("key").agg(*sums)

    def lane(name: str, high: bool) -> Column:
        half = F.shiftright(name, 32) if high else F.col(name).bitwiseAND(_long(_M32))
        return _signed(F.try_divide(half, F.col("copies")).cast("bigint").bitwiseAND(_long(_M32)))

    names = [f"s{k}_{b}" for k in seeds for b in range(32)]
    return out.select(
        "key",
        F.array(*[F.expr(f"(e{i} div copies) & {_M32}L") for i in range(EXACT_LANES)]).alias("exact"),
        F.expr("n div copies").alias("n"),
        F.array(*[lane(x, False) for x in names], *[lane(x, True) for x in names]).alias("sign"),
    )


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """Lane sums of two fingerprint structs (exact, n, sign); ``sign=-1``
    removes ``b``'s paragraphs from ``a``."""

    def wrap32(x: Column) -> Column:
        return F.pmod(x, _long(1 << 32))

    exact = F.zip_with(a["exact"], b["exact"], lambda x, y: wrap32(x + y * sign))
    lanes = F.zip_with(a["sign"], b["sign"], lambda x, y: _signed(wrap32(x.cast("bigint") + y.cast("bigint") * sign)))
    return F.struct(exact.alias("exact"), (a["n"] + b["n"] * sign).alias("n"), lanes.alias("sign"))


def encoded(exact: Column, n: Column, sign: Column) -> Column:
    """The fingerprint as hex: exact lanes, number of sentences, sign lanes."""
    wide = F.transform(exact, lambda x: F.lpad(F.hex(x), 8, "0"))
    lanes = F.transform(sign, lambda x: F.lpad(F.hex(F.pmod(x.cast("bigint"), _long(1 << 32))), 8, "0"))
    return F.concat(F.array_join(wide, ""), F.lpad(F.hex(n), 8, "0"), F.array_join(lanes, ""))


def likeness(n_a: Column, sign_a: Column, n_b: Column, sign_b: Column) -> Column:
    def plus_minus(lanes: Column, n: Column) -> Column:
        return F.transform(lanes, lambda x: 2 * F.pmod(x.cast("double"), F.lit(float(1 << 32))) - n)

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)

    a, b = plus_minus(sign_a, n_a), plus_minus(sign_b, n_b)
    both = dot(a, a) + dot(b, b)
    raw = F.when(both == 0, F.lit(1.0)).otherwise(2 * dot(a, b) / both)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key, text): the key holds the id and the text's hash and is never null."""
    text = text_of(text_col)
    ident = F.coalesce(col(id_col).cast("string"), F.lit("null"))
    return docs.select(F.concat(ident, F.lit(":"), F.hex(F.xxhash64(text))).alias("key"), text.alias("text"))


def following(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key, prev, need): the document that comes before in descending id and
    how many code points of this one's head it needs."""
    slim = keyed(docs, id_col, text_col).select("key", F.length("text").alias("n"))
    slim = slim.withColumn("id", F.nullif(F.split_part("key", F.lit(":"), F.lit(1)), F.lit("null")))
    slim = slim.withColumn("id", F.col("id").cast(docs.schema[id_col].dataType)).distinct()
    slim, count = with_row_index_counted(slim, [F.col("id").desc_nulls_last(), F.col("key")], name="at")
    slim = slim.select("key", "n", "at")
    if not count:
        return slim.select("key", F.col("key").alias("prev"), F.col("n").alias("need"))
    before = slim.select(
        F.col("key").alias("prev"),
        F.floor(F.col("n") / 2).cast("int").alias("need"),
        ((F.col("at") + 1) % count).alias("at"),
    )
    return materialize(slim.join(before, "at").select("key", "prev", "need"), "following")


def edited(docs: DataFrame, order: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, text, edited): the last half of each text replaced by as much of
    the next document's head."""
    placed = keyed(docs, id_col, text_col).join(order.hint("shuffle_merge"), "key")
    heads = placed.select(F.col("prev").alias("key"), F.expr("substring(text, 1, need)").alias("head"))
    heads = heads.groupBy("key").agg(F.first("head").alias("head"))
    rows = placed.select("key", "text").join(heads.hint("shuffle_merge"), "key")
    stay = F.expr("substring(text, 1, length(text) - CAST(floor(length(text) / 2) AS INT))")
    return rows.select("key", F.length("text").cast("bigint").alias("n_chars"), F.concat(stay, "head").alias("edited"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_docs(spark, sf_dir)
    order = following(docs, "doc_id", "text")
    own = vectors(keyed(docs, "doc_id", "text"))
    changed = edited(docs, order)
    other = vectors(changed, text="edited").withColumnsRenamed({"exact": "exact2", "n": "n2", "sign": "sign2"})
    nxt = own.join(order, "key").select(
        F.col("prev").alias("key"), F.col("n").alias("n3"), F.col("sign").alias("sign3")
    )
    rows = changed.select("key", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"))
    out = rows.join(own, "key").join(other, "key").join(nxt, "key")
    ident = F.nullif(F.split_part("key", F.lit(":"), F.lit(1)), F.lit("null"))
    return out.select(
        ident.cast(docs.schema["doc_id"].dataType).alias("doc_id"),
        "n_chars",
        "edited_sha256",
        encoded(F.col("exact"), F.col("n"), F.col("sign")).alias("fingerprint"),
        encoded(F.col("exact2"), F.col("n2"), F.col("sign2")).alias("edited_fingerprint"),
        likeness(F.col("n"), F.col("sign"), F.col("n2"), F.col("sign2")).alias("near_edited"),
        likeness(F.col("n"), F.col("sign"), F.col("n3"), F.col("sign3")).alias("near_next"),
    )
