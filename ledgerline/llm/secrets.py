"""Secret scans with multipart credential linking.

Base findings stand on their own: assigned secrets, access identifiers and
long hex runs, leftmost and non-overlapping per kind.  Weak parts (named
identifiers, endpoints, short or unlabelled secret values) mean little alone;
they are reported only when complementary parts lie within ``SCOPE`` code
points of each other in the same text:

* a weak secret next to an identifier or an endpoint;
* an identifier next to a secret;
* an endpoint next to both an identifier and a secret.

Texts are scanned in place with JVM regular expressions, behind cheap exact
tests for a character that each pattern needs.  Only found parts leave the
scan.  Their positions follow from the lengths of the gaps between matches (a
running sum per text), and the interval join works on bins as wide as the
scope: each bin keeps the first and last start per role, so a part meets one
row per neighbouring bin however many parts there are, and no pairs are made.

Defined results: null text is empty; repeated rows (same id and text) get the
same result; rows that share an id but not the text are scanned apart; a null
id stays null; other columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.common import col, materialize, read_docs, text_of

SCOPE = 400
MIN_ASSIGN = 12

# The three base patterns.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"

_SET = r"""["']?\x20*[:=]\x20*["']?"""
IDENTIFIER = r"(?i)(?<![a-z0-9_])(?:access_?key_?id|client_?id|account_?id|user_?name|login)" + _SET + r"[a-z0-9+/_.@-]{3,}"
ENDPOINT = r"""[A-Za-z][A-Za-z0-9+.-]{1,15}://[^\s"'<>]+"""
WEAK = (
    r"(?i)(?<![a-z0-9_])(?:pwd|pass|passphrase|private_?key|access_?key|auth|credentials?)"
    + _SET
    + r"""[^\s"',;:=]{6,}|(?<![A-Za-z0-9+/_.=-])(?=[A-Za-z0-9+/]{0,39}[0-9])(?=[A-Za-z0-9+/]{0,39}[G-Zg-z])"""
    r"[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/_.=-])"
)

KINDS = ["assign", "access", "hex", "identifier", "endpoint", "weak"]
BASE = KINDS[:3]


def _scans(text: Column) -> list[tuple[str, str, Column]]:
    """(kind, pattern, exact test for texts that can match at all)."""
    sets = text.contains("=") | text.contains(":")
    return [
        ("assign", ASSIGN, sets),
        ("access", ACCESS, text.contains("AKIA")),
        ("hex", HEX, text.rlike("[0-9a-f]{16}")),
        ("identifier", IDENTIFIER, sets),
        ("endpoint", ENDPOINT, text.contains("://")),
        ("weak", WEAK, sets | text.rlike("[A-Za-z0-9+/]{40}")),
    ]


def text_key(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_of(text_col)
    return docs.select(col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("_text"))


def parts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, kind, hit, start, end) of everything found."""
    src = text_key(docs, id_col, text_col)
    text = F.col("_text")
    nothing = F.expr("CAST(array() AS array<struct<kind:string,i:int,gap:int,hit:string>>)")

    def scan(kind: str, pattern: str, test: Column) -> Column:
        gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
        hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        pairs = F.zip_with(gaps, hits, lambda g, h: F.struct(g.alias("gap"), h.alias("hit")))
        rows = F.transform(
            pairs, lambda e, i: F.struct(F.lit(kind).alias("kind"), i.alias("i"), e["gap"].alias("gap"), e["hit"].alias("hit"))
        )
        return F.when(test, F.filter(rows, lambda e: e["hit"].isNotNull())).otherwise(nothing)

    found = [scan(*s) for s in _scans(text)]
    rows = src.select("doc_id", "text_key", F.explode(F.concat(*found)).alias("p")).select("doc_id", "text_key", "p.*")
    rows = rows.dropDuplicates(["doc_id", "text_key", "kind", "i"])
    run = Window.partitionBy("doc_id", "text_key", "kind").orderBy("i")
    end = F.sum(F.col("gap") + F.length("hit")).over(run)
    rows = rows.withColumn("end", end.cast("bigint"))
    return rows.select("doc_id", "text_key", "kind", "hit", (F.col("end") - F.length("hit")).alias("start"), "end")


def classified(found: DataFrame) -> DataFrame:
    """Assigned values that are too short become weak secrets; the role is
    what a part contributes to a credential."""
    value = F.length(F.regexp_extract("hit", ASSIGN, 1))
    short = (F.col("kind") == "assign") & (value < MIN_ASSIGN)
    kind = F.when(short, F.when(value >= 4, F.lit("weak"))).otherwise(F.col("kind"))
    role = (
        F.when(kind.isin("access", "identifier"), "id")
        .when(kind.isin("assign", "weak"), "secret")
        .when(kind == "endpoint", "endpoint")
    )
    return found.withColumn("kind", kind).withColumn("role", role).filter(F.col("kind").isNotNull())


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Base parts, and weak parts that complementary parts support."""
    at = ["doc_id", "text_key"]
    bin_ = F.floor(F.col("start") / scope)
    binned = found.withColumn("bin", bin_)
    spans = binned.filter(F.col("role").isNotNull()).groupBy(*at, "bin", "role")
    spans = spans.agg(F.min("start").alias("lo"), F.max("start").alias("hi"))
    # Each bin's row is sent to itself and its two neighbours, as "same",
    # "below" (only its last start matters) or "above" (its first).
    sent = spans.withColumn("d", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))))
    sent = sent.withColumn("bin", F.col("bin") + F.col("d"))
    aggs = []
    for role in ("id", "secret", "endpoint"):
        mine = F.col("role") == role
        aggs += [
            F.max(F.when(mine & (F.col("d") == 0), True)).alias(f"{role}_same"),
            F.max(F.when(mine & (F.col("d") == 1), F.col("hi"))).alias(f"{role}_below"),
            F.min(F.when(mine & (F.col("d") == -1), F.col("lo"))).alias(f"{role}_above"),
        ]
    near = sent.groupBy(*at, "bin").agg(*aggs).withColumnsRenamed({"doc_id": "_id", "text_key": "_key", "bin": "_bin"})
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")) & (F.col("bin") == F.col("_bin"))
    joined = binned.join(near, same, "left")

    def any_of(role: str) -> Column:
        below = F.col(f"{role}_below") >= F.col("start") - scope
        above = F.col(f"{role}_above") <= F.col("start") + scope
        return F.coalesce(f"{role}_same", F.lit(False)) | F.coalesce(below, F.lit(False)) | F.coalesce(above, F.lit(False))

    supported = (
        F.when(F.col("kind").isin(*BASE), True)
        .when(F.col("kind") == "weak", any_of("id") | any_of("endpoint"))
        .when(F.col("kind") == "identifier", any_of("secret"))
        .when(F.col("kind") == "endpoint", any_of("id") & any_of("secret"))
    )
    return joined.filter(supported).select(*at, "kind", "hit", "start", "end")


def span_lists(spans: DataFrame) -> DataFrame:
    """Per text: counts of the base kinds and both span strings."""
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    entry = F.struct(F.col("start"), order.alias("o"), F.concat_ws(":", "kind", "start", "end").alias("s"))
    base = F.col("kind").isin(*BASE)

    def listed(c: Column) -> Column:
        return F.array_join(F.transform(F.array_sort(F.collect_list(c)), lambda e: e["s"]), ",")

    counts = [F.sum((F.col("kind") == k).cast("bigint")).alias(f"n_{k}") for k in BASE]
    out = spans.groupBy("doc_id", "text_key").agg(
        *counts, listed(F.when(base, entry)).alias("base"), listed(entry).alias("spans")
    )
    return out


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_docs(spark, sf_dir)
    found = materialize(classified(parts(docs)), "secrets")
    lists = span_lists(linked(found)).withColumnsRenamed({"doc_id": "_id", "text_key": "_key"})
    rows = text_key(docs, "doc_id", "text").select("doc_id", "text_key")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    out = rows.join(lists, same, "left")
    return out.select(
        "doc_id",
        *[F.coalesce(F.col(f"n_{k}"), F.lit(0)).cast("bigint").alias(f"n_{k}") for k in BASE],
        F.sha2(F.coalesce("base", F.lit("")).cast("binary"), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )
