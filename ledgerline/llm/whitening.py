"""Whitening of embeddings by their leading principal components.

The entries are put on an integer grid, ``x = floor(64 c) + 1000000``, so that
counts, sums and products are exact integers and no result depends on how the
rows are partitioned:

1. one pass sums the grid vectors (one partial per task and dimension);
2. a second pass centres them by the rounded mean and adds up their products
   (one partial per task and pair of dimensions); the covariance is the exact
   rational of these sums, rounded once per entry;
3. the driver, which holds that one matrix of dimension x dimension, makes it
   tridiagonal by reflections, bisects the leading eigenvalues on Sturm counts
   and finds their vectors by inverse iteration (``eigen``);
4. the components are broadcast and every row is projected; a further pass
   over the projected rows measures their own covariance against the identity.

Rows never shuffle; what does is the square of the dimension per task.

Defined results: null vectors, empty vectors, and vectors with a null or
non-finite entry are dropped.  Vectors have the most frequent length (the
greater of equally frequent ones); an entry missing there counts as null, and
longer vectors are dropped likewise.  Entries whose grid value exceeds 2**45
in size count as that bound.  Components of no variance (eigenvalue within
rounding of zero) have no whitened value and are left out; a table without
variance or rows gives no rows.  Repeated rows and ids stay, each on its own.
``deviation`` is exact as DECIMAL(38,0); ``op11`` returns null where it
exceeds a long (from about 10**8 rows on).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm import eigen
from ledgerline.llm.common import col, materialize, read_table, ship_package

GRID, BASE, BOUND = 64.0, 1_000_000, float(1 << 45)
COMPONENTS = 32
_EXACT = 53  # bits of a double's integers
_WHOLE = T.DecimalType(38, 0)


def vector_column(df: DataFrame, name: str):
    """The vectors as arrays of float or double."""
    element = df.select(col(name)).schema[0].dataType.elementType
    return col(name) if isinstance(element, (T.FloatType, T.DoubleType)) else col(name).cast("array<double>")


def grid_rows(vectors: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows kept, their grid values as int64) of the vectors of ``dim``
    entries that are all finite."""
    lengths = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(lengths == dim)
    if not dim or not len(rows):
        return rows[:0], np.empty((0, dim), dtype=np.int64)
    flat = vectors.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
    values = flat.astype(np.float64).reshape(-1, dim)  # null entries are NaN
    finite = np.isfinite(values).all(axis=1)
    with np.errstate(over="ignore"):
        cells = np.clip(np.floor(GRID * values[finite]), -BOUND, BOUND)
    return rows[finite], cells.astype(np.int64) + BASE


def _limbs(y: np.ndarray, bits: int) -> list[np.ndarray]:
    """``y`` as a sum of 2**(bits i) times limbs of at most ``bits`` bits."""
    out = []
    while True:
        low = y & ((1 << bits) - 1)
        rest = y >> bits
        if ((rest == 0) | (rest == -1)).all():
            return [*out, y.astype(np.float64)]
        out.append(low.astype(np.float64))
        y = rest


def products(y: np.ndarray) -> np.ndarray:
    """Exact ``y' y`` as Python integers, by float products of limbs that are
    short enough for every partial sum to be an integer of a double."""
    dim = y.shape[1]
    out = np.zeros((dim, dim), dtype=object)
    step = 4096
    for a in range(0, len(y), step):
        part = y[a : a + step]
        largest = max(int(abs(part.max())), int(abs(part.min())), 1)
        if 2 * largest.bit_length() + len(part).bit_length() <= _EXACT:
            z = part.astype(np.float64)
            out += (z.T @ z).astype(np.int64).astype(object)
            continue
        bits = (_EXACT - len(part).bit_length()) // 2 - 1
        limbs = _limbs(part, bits)
        for i, p in enumerate(limbs):
            for j, q in enumerate(limbs):
                out += (p.T @ q).astype(np.int64).astype(object) << (bits * (i + j))
    return out


def _column_sums(x: np.ndarray) -> list[int]:
    high, low = x >> 26, x & ((1 << 26) - 1)
    return [(int(h) << 26) + int(v) for h, v in zip(high.sum(axis=0), low.sum(axis=0), strict=True)]


def _decimals(values) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


def _ints(values) -> pa.Array:
    return pa.array(np.asarray(values, dtype=np.int32))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, list] = {}
    for batch in batches:
        lengths = pc.unique(pc.list_value_length(batch.column(0))).to_pylist()
        for dim in lengths:
            rows, x = grid_rows(batch.column(0), dim or 0)
            if not len(rows):
                continue
            n, s = held.get(dim, (0, [0] * dim))
            held[dim] = n + len(rows), [a + b for a, b in zip(s, _column_sums(x), strict=True)]
    for dim, (n, s) in held.items():
        names = ["dim", "i", "n", "s"]
        count = pa.array(np.full(dim, n, dtype=np.int64))
        yield pa.RecordBatch.from_arrays([_ints([dim] * dim), _ints(range(dim)), count, _decimals(s)], names)


@dataclass
class Whitening:
    """``n`` rows fitted, exact column ``sums``; eigen``values``, falling, with
    unit ``vectors`` as columns; ``total`` variance over all dimensions."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    total: float

    @property
    def dim(self) -> int:
        return len(self.sums)

    @property
    def centre(self) -> list[int]:
        return [(2 * s + self.n) // (2 * self.n) for s in self.sums]

    @property
    def rest(self) -> list[int]:
        """``sum - n centre`` per dimension: what rounding the mean left."""
        return [s - self.n * c for s, c in zip(self.sums, self.centre, strict=True)]

    @property
    def explained(self) -> list[float]:
        return [float(v) / self.total for v in self.values]

    def deviations(self, y: np.ndarray) -> list[int]:
        """Exact ``sum (n x - S)**2`` per row, of centred rows."""
        rest = self.rest
        most = max(int(abs(y.max())), int(abs(y.min())), 1) if len(y) else 1
        far = self.n * most + max(map(abs, rest))
        if far * far * self.dim < 1 << 62:
            d = y * self.n - np.array(rest, dtype=np.int64)
            return np.einsum("ij,ij->i", d, d)
        d = y.astype(object) * self.n - np.array(rest, dtype=object)
        return (d * d).sum(axis=1)

    def project(self, y: np.ndarray) -> np.ndarray:
        """Whitened values of centred rows."""
        exact = y.astype(np.float64) - np.array([r / self.n for r in self.rest])
        return exact @ (self.vectors / np.sqrt(self.values))


def fit(df: DataFrame, vec_col: str, components: int = COMPONENTS) -> Whitening | None:
    """Fit over all vectors; None where no row or no variance is left."""
    ship_package(df.sparkSession)
    vectors = df.select(vector_column(df, vec_col).alias("v"))
    sums = materialize(vectors.mapInArrow(_sums, "dim int, i int, n bigint, s decimal(38,0)"), "whiten-sums")
    best = sums.filter("i = 0").groupBy("dim").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    if best is None:
        return None
    dim, n = best["dim"], best["n"]
    per = sums.filter(F.col("dim") == dim).groupBy("i").agg(F.sum("s").cast(_WHOLE).alias("s"))
    totals = [int(r["s"]) for r in per.orderBy("i").collect()]  # one row per dimension
    model = Whitening(n, totals, np.empty(0), np.empty((dim, 0)), 0.0)
    centre = np.array(model.centre, dtype=np.int64)

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim), dtype=object)
        for batch in batches:
            _, x = grid_rows(batch.column(0), dim)
            if len(x):
                total = total + products(x - centre)
        a, b = np.triu_indices(dim)
        if total.any():
            yield pa.RecordBatch.from_arrays([_ints(a), _ints(b), _decimals(total[a, b])], ["i", "j", "g"])

    parts = vectors.mapInArrow(gram, "i int, j int, g decimal(38,0)")
    entries = parts.groupBy("i", "j").agg(F.sum("g").cast(_WHOLE).alias("g")).collect()  # dim**2 / 2 rows
    cov = np.zeros((dim, dim))
    rest = model.rest
    for r in entries:
        i, j = r["i"], r["j"]
        cov[i, j] = cov[j, i] = (n * int(r["g"]) - rest[i] * rest[j]) / (n * n)
    values, basis = eigen.leading_pairs(cov, components)
    total = float(np.trace(cov))
    kept = values > 4 * eigen.EPS * dim * max(float(values[0]) if len(values) else 0.0, 0.0)
    if not kept.any():
        return None
    return Whitening(n, totals, values[kept], basis[:, kept], total)


def transform(df: DataFrame, vec_col: str, model: Whitening, keep: list[str]) -> DataFrame:
    """The ``keep`` columns of every remaining row, as struct ``_row``, with
    ``deviation`` and the array ``whitened``."""
    ship_package(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        centre = np.array(m.centre, dtype=np.int64)
        k = len(m.values)
        for batch in batches:
            at, x = grid_rows(batch.column(1), m.dim)
            if not len(at):
                continue
            y = x - centre
            flat = pa.array(m.project(y).reshape(-1))
            ends = pa.array(np.arange(0, len(at) * k + 1, k, dtype=np.int32))
            dev = m.deviations(y)
            dev = pa.array(dev).cast(pa.decimal128(38, 0)) if dev.dtype == np.int64 else _decimals(dev)
            arrays = [batch.column(0).take(pa.array(at)), dev, pa.ListArray.from_arrays(ends, flat)]
            yield pa.RecordBatch.from_arrays(arrays, ["_row", "deviation", "whitened"])

    src = df.select(F.struct(*[col(c) for c in keep]).alias("_row"), vector_column(df, vec_col).alias("v"))
    schema = T.StructType([src.schema["_row"], T.StructField("deviation", _WHOLE),
                           T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    return src.mapInArrow(rows, schema)


def identity_error(df: DataFrame, vec_col: str, model: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the
    identity, measured over all rows.  Partials are added as decimals, so the
    order of tasks does not matter."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    k = len(model.values)

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        centre = np.array(m.centre, dtype=np.int64)
        square, plain = np.zeros((k, k)), np.zeros(k)
        for batch in batches:
            _, x = grid_rows(batch.column(0), m.dim)
            if len(x):
                w = m.project(x - centre)
                square += w.T @ w
                plain += w.sum(axis=0)
        a, b = np.triu_indices(k)
        i, j = np.concatenate([a, np.arange(k)]), np.concatenate([b, np.full(k, -1)])
        g = np.concatenate([square[a, b], plain])
        yield pa.RecordBatch.from_arrays([_ints(i), _ints(j), pa.array(g)], ["i", "j", "g"])

    parts = df.select(vector_column(df, vec_col).alias("v")).mapInArrow(gram, "i int, j int, g double")
    sums = parts.groupBy("i", "j").agg(F.sum(F.col("g").cast("decimal(38,15)")).alias("g")).collect()
    got = {(r["i"], r["j"]): float(r["g"]) / model.n for r in sums}
    return max(
        abs(got[i, j] - got[i, -1] * got[j, -1] - (1.0 if i == j else 0.0)) for i in range(k) for j in range(i, k)
    )


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read_table(spark, sf_dir, "embeddings")
    model = fit(df, "embedding")
    schema = (
        "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    )
    if model is None:
        return spark.createDataFrame([], schema)
    error = identity_error(df, "embedding", model)
    shares = F.array(*[F.lit(v) for v in model.explained])
    out = transform(df, "embedding", model, ["vec_id"]).select(
        F.col("_row.vec_id").alias("vec_id"),
        F.expr("try_cast(deviation AS bigint)").alias("deviation"),
        F.posexplode("whitened").alias("at", "whitened"),
    )
    return out.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
