"""Language identification by a string kernel.

The kernel of two texts is the blended-spectrum presence kernel: the number of
distinct character n-grams of 1 to 3 code points (A-Z and other cased letters
folded) that both hold, over the root of the product of their numbers of
distinct n-grams.  An n-gram is packed into one 63-bit integer, so presence is
exact and no feature is hashed.

Landmark texts give a Nyström approximation of the kernel: a text is described
by its kernel values with the landmarks, whitened by the landmarks' own kernel
matrix.  One-versus-rest kernel ridge regression on these features needs only
two sums over the fitted texts, which every task adds up for its rows.  The
solution is a weight per landmark and language; multiplied once with the
landmarks' presence matrix it becomes a weight per n-gram and language, so
that a batch is scored by one product of its sparse presence matrix (rows of
n-gram positions) with that table.  The model is broadcast.

The model is fitted on a bounded sample of labelled texts: at most
``fit_rows`` distinct texts, equally many per language, those of smallest
hash; the first of them are the ``landmarks``, where texts of more than
``LANDMARK_CHARS`` code points come last.  Every text is taken as a whole, in
the sample and when it is scored.  The driver holds one matrix of landmarks x
landmarks and the landmarks' n-grams.

Defined results: a null text and a text without a letter is ``und`` with score
0, as is every text where nothing labelled is left to learn from; a row
without id is not held out.  Rows of equal text get equal results.  Equal
scores go to the language that sorts first.  Very long texts are taken in
pieces whose n-gram sets are united, so memory follows the distinct n-grams.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgerline.llm.common import Sized, col, materialize, read_docs, ship_package

LENGTHS = (1, 2, 3)
LANDMARKS = 256
LANDMARK_CHARS = 20_000
FIT_ROWS = 4096
RIDGE = 1e-4
UNKNOWN = "und"
_BITS = np.uint64(21)  # code points + 1 fit, so lengths never collide
_PIECE = 1 << 20


def _piece_grams(points: np.ndarray) -> np.ndarray:
    out, codes = [], points
    for k in LENGTHS:
        if k > 1:
            codes = (codes[:-1] << _BITS) | points[k - 1 :]
        if len(codes):
            out.append(np.unique(codes))
    return np.concatenate(out) if out else points


def gram_codes(text: str) -> np.ndarray:
    """Distinct n-grams of the whole text, as integers."""
    raw = text.lower().encode("utf-32-le", "surrogatepass")
    points = np.frombuffer(raw, dtype="<u4").astype(np.uint64) + np.uint64(1)
    if len(points) <= _PIECE:
        return _piece_grams(points)
    found = np.empty(0, dtype=np.uint64)
    for a in range(0, len(points), _PIECE):
        part = points[a : a + _PIECE + max(LENGTHS) - 1]
        found = np.union1d(found, _piece_grams(part))
    return found


def positions(codes: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    at = np.searchsorted(vocabulary, codes)
    at[at == len(vocabulary)] = 0
    return at[vocabulary[at] == codes] if len(vocabulary) else at[:0]


def presence(texts: list[str], vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The batch's sparse presence matrix: n-gram positions of all rows, the
    row ends, and the rows' numbers of distinct n-grams."""
    hits, ends, sizes = [], [], []
    total = 0
    for t in texts:
        codes = gram_codes(t)
        at = positions(codes, vocabulary)
        total += len(at)
        hits.append(at)
        ends.append(total)
        sizes.append(len(codes))
    flat = np.concatenate(hits) if hits else np.empty(0, dtype=np.int64)
    return flat, np.array(ends, dtype=np.int64), np.array(sizes, dtype=np.float64)


def product(flat: np.ndarray, ends: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Sparse presence rows times a dense table, for the whole batch."""
    out = np.zeros((len(ends), table.shape[1]))
    starts = np.concatenate(([0], ends[:-1]))
    full = np.flatnonzero(ends > starts)
    if len(full):
        out[full] = np.add.reduceat(table[flat], starts[full], axis=0)
    return out


def _normal(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return values / np.sqrt(np.maximum(sizes, 1.0))[:, None]


@dataclass
class Landmarks:
    """``vocabulary``: sorted n-grams of all landmarks; per landmark its
    positions there (``flat`` up to ``ends``) and its number of n-grams."""

    vocabulary: np.ndarray
    flat: np.ndarray
    ends: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, texts: list[str]) -> Landmarks:
        sets = [gram_codes(t) for t in texts]
        vocabulary = np.unique(np.concatenate(sets))
        return cls(vocabulary, *presence(texts, vocabulary))

    def by_gram(self) -> tuple[np.ndarray, np.ndarray]:
        """The transpose: landmarks of every n-gram, and where they start."""
        owner = np.repeat(np.arange(len(self.ends)), np.diff(self.ends, prepend=0))
        order = np.argsort(self.flat, kind="stable")
        starts = np.searchsorted(self.flat[order], np.arange(len(self.vocabulary) + 1))
        return owner[order].astype(np.int32), starts

    def kernel(self, texts: list[str], transpose: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Kernel values of the texts (rows) with the landmarks."""
        owners, starts = transpose
        m = len(self.ends)
        out = np.zeros((len(texts), m))
        for i, t in enumerate(texts):
            codes = gram_codes(t)
            at = positions(codes, self.vocabulary)
            width = starts[at + 1] - starts[at]
            first = np.repeat(starts[at] - np.concatenate(([0], np.cumsum(width)[:-1])), width)
            shared = np.bincount(owners[first + np.arange(width.sum())], minlength=m)
            out[i] = shared / np.sqrt(max(len(codes), 1) * self.sizes)
        return out

    def table(self, weights: np.ndarray) -> np.ndarray:
        """Weights per landmark as weights per n-gram."""
        out = np.zeros((len(self.vocabulary), weights.shape[1]))
        owner = np.repeat(np.arange(len(self.ends)), np.diff(self.ends, prepend=0))
        np.add.at(out, self.flat, _normal(weights, self.sizes)[owner])
        return out


@dataclass
class LanguageModel:
    languages: list[str]
    vocabulary: np.ndarray
    table: np.ndarray  # n-grams x languages
    bias: np.ndarray

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        if not texts:
            return [], np.empty(0)
        flat, ends, sizes = presence(texts, self.vocabulary)
        values = _normal(product(flat, ends, self.table), sizes) + self.bias
        best = values.argmax(axis=1)
        return [self.languages[b] for b in best], np.clip(values[np.arange(len(best)), best], 0.0, 1.0)


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def sample(labelled: DataFrame, fit_rows: int) -> DataFrame:
    """(lang, h, text): per language the distinct texts of smallest hash, at
    most ``fit_rows`` in all."""
    rows = labelled.withColumn("h", F.xxhash64("text"))
    counts = rows.groupBy("lang").agg(F.approx_count_distinct("h", 0.02).alias("n"))
    counts = materialize(counts, "lang-counts")
    languages = counts.count()
    if not languages:
        return rows.limit(0)
    each = max(1, fit_rows // languages)
    # texts below the cut are half again as many as needed, however often copied
    cut = F.least(F.lit(1.0), F.lit(1.5 * each + 32) / F.col("n")).alias("cut")
    share = (F.col("h").cast("double") / float(1 << 63) + 1.0) / 2.0
    rows = rows.join(Sized(counts.select("lang", cut), languages).for_join(), "lang").filter(share <= F.col("cut"))
    rows = rows.groupBy("lang", "h").agg(F.min("text").alias("text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    return rows.withColumn("place", place).filter(F.col("place") <= each).select("lang", "h", "text")


def fit(
    labelled: DataFrame, landmarks: int = LANDMARKS, fit_rows: int = FIT_ROWS, ridge: float = RIDGE
) -> LanguageModel | None:
    """Model of the texts and their languages (columns ``text`` and ``lang``,
    neither null); None where there are none."""
    ship_package(labelled.sparkSession)
    rows = materialize(sample(labelled, fit_rows), "lang-sample")
    languages = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    if not languages:
        return None
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.length("text") > LANDMARK_CHARS, "h"))
    chosen = rows.withColumn("place", place).filter(F.col("place") <= max(1, landmarks // len(languages)))
    texts = [r["text"] for r in chosen.orderBy("lang", "place").select("text").collect()]
    marks = Landmarks.of(texts)
    shared = labelled.sparkSession.sparkContext.broadcast((marks, {v: i for i, v in enumerate(languages)}))
    m, c = len(texts), len(languages)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lm, number = shared.value
        transpose = lm.by_gram()
        total, answers = np.zeros((m + 1, m + 1)), np.zeros((m + 1, c))
        n = 0
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                k = lm.kernel(part.column(0).to_pylist(), transpose)
                k = np.hstack([k, np.ones((len(k), 1))])
                label = np.array([number[v] for v in part.column(1).to_pylist()])
                total += k.T @ k
                np.add.at(answers.T, label, k)
                n += len(k)
        if n:
            flat = pa.array([np.hstack([total, answers]).reshape(-1).tolist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), flat], ["n", "sums"])

    parts = rows.select("text", "lang").mapInArrow(sums, "n bigint, sums array<double>")
    # one short row per task of the bounded sample
    got = sorted((r["n"], r["sums"]) for r in parts.collect())
    n = sum(g[0] for g in got)
    whole = np.sum([np.array(g[1]) for g in got], axis=0).reshape(m + 1, m + 1 + c)
    gram, answers = whole[:, : m + 1], whole[:, m + 1 :]

    kernel = marks.kernel(texts, marks.by_gram())
    values, vectors = np.linalg.eigh((kernel + kernel.T) / 2)
    good = values > 1e-9 * values[-1]
    whiten = vectors[:, good] / np.sqrt(values[good])
    lift = np.zeros((m + 1, whiten.shape[1] + 1))  # landmarks and the constant
    lift[:m, :-1], lift[m, -1] = whiten, 1.0
    normal = lift.T @ gram @ lift
    solved = lift @ np.linalg.solve(normal + ridge * n * np.eye(len(normal)), lift.T @ answers)
    return LanguageModel(languages, marks.vocabulary, marks.table(solved[:m]), solved[m])


def predict(df: DataFrame, text_col: str, model: LanguageModel | None, keep: list[str]) -> DataFrame:
    """The ``keep`` columns of every row, as struct ``_row``, with
    ``lang_pred`` and ``score``."""
    row = F.struct(*[col(c) for c in keep]).alias("_row")
    if model is None:
        return df.select(row, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    ship_package(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                known = part.column(1).to_numpy(zero_copy_only=False)
                names = np.full(len(known), UNKNOWN, dtype=object)
                scores = np.zeros(len(known))
                at = np.flatnonzero(known)
                names[at], scores[at] = m.predict(part.column(2).take(pa.array(at)).to_pylist())
                arrays = [part.column(0), pa.array(names, pa.string()), pa.array(scores)]
                yield pa.RecordBatch.from_arrays(arrays, ["_row", "lang_pred", "score"])

    src = df.select(row, has_letter(col(text_col)).alias("known"), col(text_col).alias("text"))
    schema = T.StructType([src.schema["_row"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return src.mapInArrow(rows, schema)


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_docs(spark, sf_dir).select("doc_id", "lang", "text")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    held_out = F.coalesce(fold == 0, F.lit(False))
    model = fit(docs.filter(~held_out & F.col("lang").isNotNull() & has_letter(F.col("text"))).select("text", "lang"))
    out = predict(docs, "text", model, ["doc_id"]).withColumn("doc_id", F.col("_row.doc_id"))
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
