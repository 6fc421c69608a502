"""Harmonic packing of token ids into sequences of a fixed capacity.

A document is cut where it helps: full sequences first, then the rest at the
reciprocal lengths capacity/2, /4, ... down to ``SMALLEST``, and what remains
(shorter than that) as one piece.  Every length is a class of its own with
``capacity // length`` places per sequence, so a class's sequences all hold
the same number of pieces and waste less than one piece (nothing for the
reciprocal lengths).

Workers fill sequences independently: a piece's place follows from its number
within its class, which is its number within the class on its own input
partition plus the pieces that the class has on earlier partitions.  Only the
last, incomplete sequence of each class is left over: fewer than
``capacity // length`` pieces per class, together under 10,000 whatever the
input's size.  Those are packed by first fit, longest first, in one task.

Defined results: a document without text is its end token alone; a null id
stays null; repeated rows are packed as often as they occur; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgerline.llm.common import col, materialize, read_docs, ship_package

CAPACITY = 2048
SMALLEST = 64
END_ID = 1


def cut_lengths(n: int, capacity: int = CAPACITY, smallest: int = SMALLEST) -> list[int]:
    """Piece lengths of a document of ``n`` ids, in order."""
    out = [capacity] * (n // capacity)
    rest, part = n % capacity, capacity // 2
    while part >= smallest:
        if rest >= part:
            out.append(part)
            rest -= part
        part //= 2
    return [*out, rest] if rest else out


def pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens and, if
    asked for, the ids themselves."""
    ship_package(docs.sparkSession)
    rows = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"))
    fields = [rows.schema["doc_id"], *[T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens")]]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.LongType())))

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from ledgerline.llm.tokens import coder

        words = coder(tokenizer)
        end = np.asarray([END_ID], dtype="<u4").tobytes()
        for batch in batches:
            source, values = [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                raw = words.encode(text) + end
                n, at = len(raw) // 4, 0
                for length in cut_lengths(n, capacity):
                    source.append(i)
                    part = raw[4 * at : 4 * (at + length)]
                    values.append((at, length, zlib.crc32(part), n, part))
                    at += length
            ids = batch.column("doc_id").take(pa.array(source, pa.int64()))
            columns = [ids, *[pa.array([v[k] for v in values], pa.int64()) for k in range(4)]]
            if with_ids:
                lists = [np.frombuffer(v[4], "<u4").astype(np.int64) for v in values]
                columns.append(pa.array(lists, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return rows.mapInArrow(cut, T.StructType(fields))


def harmonic_pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut`` (any table of pieces with ``length``) with sequence_id and
    offset."""
    frozen = materialize(cut.withColumn("_part", F.spark_partition_id()), "pieces")
    order = [F.col(c) for c in cut.columns if c != "ids"]
    number = F.row_number().over(Window.partitionBy("_part", "length").orderBy(*order))
    per_part = frozen.groupBy("_part", "length").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = per_part.select("_part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shift"))
    # One row per length, at most capacity / 2 + SMALLEST of them.
    classes = sorted(tuple(r) for r in per_part.groupBy("length").agg(F.sum("n")).collect())
    first_id, at = {}, 0
    for length, n in classes:
        full = n // (capacity // length)
        first_id[length] = (at, full * (capacity // length))
        at += full
    placed = frozen.withColumn("_no", number).join(shift, ["_part", "length"])
    placed = placed.withColumn("_no", F.col("_no") - 1 + F.col("shift"))
    rows = [(length, a, b) for length, (a, b) in first_id.items()] or [(0, 0, 0)]
    starts = F.create_map(*[F.lit(x).cast("bigint") for length, a, _ in rows for x in (length, a)])
    limits = F.create_map(*[F.lit(x).cast("bigint") for length, _, b in rows for x in (length, b)])
    per = F.floor(F.lit(capacity) / F.col("length"))
    in_full = F.col("_no") < F.element_at(limits, F.col("length"))
    full = placed.filter(in_full)
    full = full.withColumn("sequence_id", F.element_at(starts, F.col("length")) + F.floor(F.col("_no") / per))
    full = full.withColumn("offset", (F.col("_no") % per) * F.col("length"))
    rest = placed.filter(~in_full)
    names = [*cut.columns, "sequence_id", "offset"]
    schema = T.StructType(
        [*cut.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )
    first = at

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "_part", "_no"], ascending=[False, True, True], kind="stable")
        used: list[int] = []
        seq, offset = [], []
        for length in frame["length"].tolist():
            b = next((i for i, u in enumerate(used) if u + length <= capacity), len(used))
            if b == len(used):
                used.append(0)
            seq.append(first + b)
            offset.append(used[b])
            used[b] += length
        return frame.assign(sequence_id=seq, offset=offset)[names]

    packed = rest.drop("shift").withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(fit, schema)
    return full.select(*names).unionByName(packed)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = harmonic_pack(pieces(read_docs(spark, sf_dir)))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return out.select(*[F.col(c).cast("bigint") if c not in ("doc_id",) else F.col(c) for c in names])


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the pieces with their token ids and places."""
    return harmonic_pack(pieces(docs, with_ids=True))
