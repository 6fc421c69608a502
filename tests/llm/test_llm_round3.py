"""Whitening, language identification and the Merkle manifest."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from llm_support import make_documents, write_documents

import __spark_entry__ as E
from ledgerline.llm import eigen, language_id, merkle, whitening

Q = E.queries()


def run(spark, name, folder):
    return [r.asDict() for r in Q[name](spark, str(folder)).collect()]


# --- op11 -------------------------------------------------------------------------
@pytest.mark.parametrize("kind", ["plain", "clusters", "equal", "low rank", "blocks", "graded"])
def test_leading_pairs(kind):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((300, 40))
    a = {
        "plain": np.cov(x.T),
        "clusters": np.diag(np.repeat([5.0, 5.0 + 1e-13, 3.0, 1.0], 10)),
        "equal": np.eye(40),
        "low rank": np.cov(x[:7].T),
        "blocks": np.kron(np.eye(5), np.cov(x[:, :8].T)),
        "graded": np.cov((x * np.logspace(0, 7, 40)).T),
    }[kind]
    q, _ = np.linalg.qr(rng.standard_normal((40, 40)))
    for m in (a, (q @ a @ q.T + (q @ a @ q.T).T) / 2):
        values, vectors = eigen.leading_pairs(m, 12)
        scale = np.abs(m).max()
        assert np.abs(values - np.linalg.eigvalsh(m)[::-1][:12]).max() < 1e-13 * 40 * scale
        assert np.abs(m @ vectors - vectors * values).max() < 1e-13 * 40 * scale
        assert np.abs(vectors.T @ vectors - np.eye(12)).max() < 1e-12


def test_sturm_counts_are_numbers_of_smaller_eigenvalues():
    rng = np.random.default_rng(5)
    diag, off = rng.standard_normal(30), rng.standard_normal(29)
    values = np.linalg.eigvalsh(np.diag(diag) + np.diag(off, 1) + np.diag(off, -1))
    at = np.linspace(-5, 5, 101)
    assert (eigen.sturm_counts(diag, off, at) == [(values < v).sum() for v in at]).all()


def test_products_are_exact_integers():
    rng = np.random.default_rng(6)
    for size in (40, 1 << 30, 1 << 46):
        y = rng.integers(-size, size, (5000, 5))
        assert (whitening.products(y) == y.astype(object).T @ y.astype(object)).all()


def write_vectors(folder, vectors, extra=()):
    folder.mkdir(parents=True, exist_ok=True)
    table = {"vec_id": pa.array([7 * i for i in range(len(vectors))], pa.int64()),
             "embedding": pa.array(vectors, pa.list_(pa.float32())), "label": pa.array([1] * len(vectors), pa.int32())}
    table |= {c: pa.array(["x"] * len(vectors)) for c in extra}
    pq.write_table(pa.table(table), folder / "embeddings.parquet")
    return folder


def expected_whitening(vectors, ids, k=32):
    x = np.floor(64 * np.array(vectors, dtype=np.float32).astype(np.float64)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    y = x - s / n
    values, basis = np.linalg.eigh(y.T @ y / n)
    values, basis = values[::-1], basis[:, ::-1]
    keep = min(k, int((values > 1e-12 * values[0]).sum()))
    white = y @ basis[:, :keep] / np.sqrt(values[:keep])
    dev = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s, strict=True)) for row in x]
    return {i: (n, d, w) for i, d, w in zip(ids, dev, white, strict=True)}, values[:keep] / values.sum()


@pytest.mark.parametrize("dim", [3, 50])
def test_op11(spark, tmp_path, dim):
    rng = np.random.default_rng(dim)
    good = (rng.standard_normal((400, dim)) * np.linspace(1, 3, dim)).astype(np.float32)
    good[100:180] = good[0]  # one very common vector
    rows = [None, [], [None] * dim, [float("nan")] + [0.0] * (dim - 1), [math.inf] * dim, [1.0] * (dim - 1), [1.0] * (dim + 1)]
    vectors = rows + good.tolist() + [[1.0, None] + [0.0] * (dim - 2)]
    ids = [7 * i for i in range(len(rows), len(rows) + len(good))]
    got = run(spark, "op11_whitening", write_vectors(tmp_path, vectors, ["at", "_row", "whitened", "a.b"]))
    want, shares = expected_whitening(good, ids)
    assert len(got) == len(good) * len(shares) and {r["vec_id"] for r in got} == set(ids)
    table = defaultdict(dict)
    for r in got:
        table[r["vec_id"]][r["component"]] = r
    signs = None
    for i, (n, dev, white) in want.items():
        row = [table[i][k + 1] for k in range(len(shares))]
        assert {(r["n"], r["deviation"]) for r in row} == {(n, dev)}
        mine = np.array([r["whitened"] for r in row])
        signs = np.sign(mine * white) if signs is None else signs
        assert np.abs(mine * signs - white).max() < 1e-8
        assert np.abs([r["explained"] for r in row] - shares).max() < 1e-12
        assert {r["identity_error"] for r in row} == {got[0]["identity_error"]} and got[0]["identity_error"] < 1e-9


def test_op11_degenerate(spark, tmp_path):
    same = write_vectors(tmp_path / "same", [[0.5, -0.25]] * 20)
    assert run(spark, "op11_whitening", same) == []
    flat = write_vectors(tmp_path / "flat", [[float(i), 2.0 * i, 1.0] for i in range(10)])  # one dimension of variance
    assert {r["component"] for r in run(spark, "op11_whitening", flat)} == {1}
    one = write_vectors(tmp_path / "none", [None, [], [math.nan]])
    assert run(spark, "op11_whitening", one) == []
    far = write_vectors(tmp_path / "far", [[1e30, 0.0], [-1e30, 1.0], [0.0, 2.0]])
    got = run(spark, "op11_whitening", far)
    assert {r["vec_id"] for r in got} == {0, 7, 14} and all(r["deviation"] is None for r in got if r["vec_id"] != 14)


def test_whitening_of_integer_vectors(spark):
    rows = [(i, [i % 5, i % 7, i % 3]) for i in range(60)]
    df = spark.createDataFrame(rows, "k int, v array<int>")
    model = whitening.fit(df, "v", components=2)
    out = whitening.transform(df, "v", model, ["k"]).collect()
    assert len(out) == 60 and all(len(r["whitened"]) == 2 for r in out)
    assert whitening.identity_error(df, "v", model) < 1e-9


# --- op12 -------------------------------------------------------------------------
def test_gram_codes_are_the_distinct_ngrams(monkeypatch):
    def brute(t):
        t = t.lower()
        return {t[i : i + k] for k in (1, 2, 3) for i in range(len(t) - k + 1)}

    rnd = random.Random(4)
    for t in ["", "a", "Ab", "aBc aBc", "é😀\U0010ffff", "".join(rnd.choices("abß Ö\n", k=400))]:
        codes = language_id.gram_codes(t)
        assert len(set(codes.tolist())) == len(codes) == len(brute(t))
        plain = {"".join(chr(int(c >> (21 * k) & 0x1FFFFF) - 1) for k in (2, 1, 0) if c >> (21 * k) & 0x1FFFFF)
                 for c in map(int, codes)}
        assert plain == brute(t)
        with monkeypatch.context() as m:
            m.setattr(language_id, "_PIECE", 7)
            assert set(language_id.gram_codes(t).tolist()) == set(codes.tolist())


def language_rows(n=400, seed=11):
    rnd = random.Random(seed)
    stems = {"aa": ["tok", "pel", "rim", "sa"], "bb": ["ünd", "geß", "lor", "mi"], "cc": ["señ", "toc", "mir", "as"]}
    rows = []
    for i in range(n):
        lang = rnd.choice(list(stems))
        text = " ".join("".join(rnd.choices(stems[lang], k=rnd.randint(1, 3))) for _ in range(rnd.randint(3, 60)))
        rows.append({"doc_id": i, "text": text, "lang": lang, "source": None, "n_chars": len(text)})
    return rows


def brute_scores(fit_rows, landmarks, texts, ridge):
    """Kernel ridge regression on Nyström features, by Python sets."""
    def grams(t):
        t = t.lower()
        return {t[i : i + k] for k in (1, 2, 3) for i in range(len(t) - k + 1)}

    def kernel(a, b):
        sets = [grams(t) for t in b]
        return np.array([[len(x & y) / math.sqrt(len(x) * len(y)) for y in sets] for x in map(grams, a)])

    names = sorted({lang for _, lang in fit_rows})
    values, vectors = np.linalg.eigh(kernel(landmarks, landmarks))
    good = values > 1e-9 * values[-1]
    white = vectors[:, good] / np.sqrt(values[good])

    def features(t):
        return np.hstack([kernel(t, landmarks) @ white, np.ones((len(t), 1))])

    f = features([t for t, _ in fit_rows])
    y = np.array([[float(lang == v) for v in names] for _, lang in fit_rows])
    w = np.linalg.solve(f.T @ f + ridge * len(f) * np.eye(f.shape[1]), f.T @ y)
    return names, features(texts) @ w


def test_language_model_is_kernel_ridge_regression(spark):
    rows = language_rows(90)
    df = spark.createDataFrame([(r["text"], r["lang"]) for r in rows], "text string, lang string").repartition(5)
    model = language_id.fit(df, landmarks=24, fit_rows=60)
    picked = language_id.sample(df, 60).orderBy("lang", "h").collect()
    counts = Counter(r["lang"] for r in picked)
    assert max(counts.values()) == 20
    marks, at = [], Counter()
    for r in picked:
        at[r["lang"]] += 1
        marks += [r["text"]] if at[r["lang"]] <= 8 else []
    texts = [r["text"] for r in rows[:40]]
    names, want = brute_scores([(r["text"], r["lang"]) for r in picked], marks, texts, language_id.RIDGE)
    got, score = model.predict(texts)
    assert model.languages == names and got == [names[i] for i in want.argmax(axis=1)]
    assert np.abs(score - np.clip(want.max(axis=1), 0, 1)).max() < 1e-6


def test_op12_accuracy_and_defined_results(spark, tmp_path):
    rows = language_rows()
    rows += [dict(rows[0], doc_id=1000 + i) for i in range(200)]  # a third are copies of one text
    odd = [None, "", " \n", "123 456 !!", "tokpel " * 40_000]
    rows += [{"doc_id": 2000 + i, "text": t, "lang": None, "source": "s", "n_chars": 0} for i, t in enumerate(odd)]
    rows.append(dict(rows[0], doc_id=None))
    got = run(spark, "op12_language_id", write_documents(tmp_path, rows))
    assert len(got) == len(rows) and Counter(r["doc_id"] for r in got) == Counter(r["doc_id"] for r in rows)
    by = {r["doc_id"]: r for r in got}
    for r in rows:
        held = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
        assert by[r["doc_id"]]["held_out"] is held and 0 <= by[r["doc_id"]]["score"] <= 1
    held = [r for r in rows[:400] if by[r["doc_id"]]["held_out"]]
    assert len(held) > 50 and all(by[r["doc_id"]]["lang_pred"] == r["lang"] for r in held)
    assert [by[2000 + i]["lang_pred"] for i in range(5)] == ["und"] * 4 + ["aa"]
    assert len({by[1000 + i]["score"] for i in range(200)}) == 1


def test_op12_without_labels(spark, tmp_path):
    rows = [dict(r, lang=None) for r in language_rows(20)]
    assert {(r["lang_pred"], r["score"]) for r in run(spark, "op12_language_id", write_documents(tmp_path, rows))} == {("und", 0.0)}


# --- op13 -------------------------------------------------------------------------
def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def brute_leaf(r, low=False):
    text = r["text"]
    if low and text is not None:
        text = text.translate({c: c + 32 for c in range(65, 91)})
    values = [r["doc_id"], r["source"], r["lang"], r["n_chars"], text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def brute_tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i : i + 8])) for i in range(0, len(last), 8)])
    return levels


def brute_path(levels, i):
    out = []
    for nodes in levels[:-1]:
        a = i // 8 * 8
        out.append(("".join(nodes[a:i]), "".join(nodes[i + 1 : a + 8])))
        i //= 8
    return out


def brute_manifest(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append(r)
    names = sorted(groups, key=lambda v: (v is not None, (v or "").encode()))
    for v in names:
        groups[v].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, brute_leaf(r)))
    trees = {v: brute_tree([brute_leaf(r) for r in groups[v]]) for v in names}
    top = brute_tree([trees[v][-1][0] for v in names])
    for place, v in enumerate(names):
        for i, r in enumerate(groups[v]):
            path = brute_path(trees[v], i) + brute_path(top, place)
            chosen = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
            h = brute_leaf(r, chosen)
            for before, after in path:
                h = sha(before + h + after)
            yield {"doc_id": r["doc_id"], "leaf": brute_leaf(r), "subroot": trees[v][-1][0], "root": top[-1][0],
                   "proof_sha256": sha("".join(b + a for b, a in path)), "folded_root": h, "verified": h == top[-1][0]}


def plain(rows):
    return Counter(tuple(sorted((k, str(v)) for k, v in r.items())) for r in rows)


def manifest_rows(kind):
    rows = make_documents()
    if kind == "languages":  # a null, an empty, lone and many languages
        return [dict(r, lang=[None, "", "é", "Z", "a"][i % 5] if i < 60 else f"l{i % 37}") for i, r in enumerate(rows)]
    if kind == "one":
        return rows[:1]
    if kind == "copies":  # repeated rows make equal subtrees
        return rows + [rows[0]] * 700
    return rows


@pytest.mark.parametrize("kind", ["plain", "languages", "one", "copies"])
def test_op13(spark, tmp_path, kind):
    rows = manifest_rows(kind)
    got = run(spark, "op13_merkle_manifest", write_documents(tmp_path, rows))
    assert plain(got) == plain(brute_manifest(rows))
    if kind == "plain":
        assert {r["verified"] for r in got} == {True, False}


def test_manifest_stores_equal_subtrees_once_and_rejects_foreign_leaves(spark, tmp_path):
    from pyspark.sql import functions as F

    rows = manifest_rows("copies")
    docs = spark.read.parquet(write_documents(tmp_path, rows) + "/documents.parquet")
    m = merkle.build(docs)
    records = m.records.collect()
    assert len({r["digest"] for r in records}) == len(records) < len(rows) // 8
    for r in records:
        assert r["digest"] == sha("".join(r["children"])) and 1 <= len(r["children"]) <= 8
    some = m.leaves.filter("rank % 50 = 3")
    assert merkle.prove(m, some).count() == some.count() > 0
    assert merkle.prove(m, some.withColumn("leaf", F.lit(sha("other")))).count() == 0
    binary = merkle.build(docs, fanout=2)
    proved = merkle.prove(binary, binary.leaves)
    assert proved.filter(merkle.refold(F.col("leaf"), F.col("path")) != binary.root).count() == 0
