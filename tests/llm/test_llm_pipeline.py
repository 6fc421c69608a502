"""The pipeline's stages, each against a plain Python version of it."""

from collections import Counter

import brute
import pytest
from test_llm_ops import check_packing

import corpus_pipeline
from ledgerline.llm.common import read_docs


@pytest.fixture(scope="module", params=["docs_dir", "clash_dir"])
def steps(request, spark):
    """(columns, rows before, rows after) of every stage."""
    folder = request.getfixturevalue(request.param)
    docs, out = read_docs(spark, folder), {}
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.materialize(stage(spark, docs, folder), "test")
        out[name] = (docs.columns, [r.asDict() for r in docs.collect()], after.columns, [r.asDict() for r in after.collect()])
        docs = after
    return out


def rows_of(rows):
    return Counter(tuple(sorted((k, str(v)) for k, v in r.items())) for r in rows)


def test_columns(steps):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "near_dedup", "source_mix", "packing"]
    for name in names[:-1]:
        assert steps[name][0] == steps[name][2]


def test_quality(steps):
    _, before, _, after = steps["quality_rules"]
    gone = rows_of(before) - rows_of(after)
    assert not rows_of(after) - rows_of(before)
    failed = [r for r in before if brute.quality(r["text"])[5]]
    assert not rows_of(failed) - gone
    clean = [r for r in before if not brute.quality(r["text"])[5] and not brute.quality(r["text"])[6]]
    assert not rows_of(clean) & gone


def test_lines(steps):
    _, before, _, after = steps["line_dedup"]
    expected = []
    for r, (_, kept) in zip(before, brute.line_dedup(before), strict=True):
        if kept:
            text = "\n".join(kept)
            expected.append(r | {"text": text, "n_chars": len(text)})
    assert rows_of(after) == rows_of(expected)


def test_near_duplicates(steps):
    _, before, _, after = steps["near_dedup"]
    kept = [r for r, (_, c) in zip(before, brute.near_duplicates(before), strict=True) if r["doc_id"] == c]
    assert rows_of(after) == rows_of(kept)


def test_mix(steps):
    _, before, _, after = steps["source_mix"]
    _, target = brute.targets(before)
    taken, largest = Counter(), Counter()
    for r in after:
        taken[r["source"]] += len(brute.words(r["text"]))
    for r in before:
        largest[r["source"]] = max(largest[r["source"]], len(brute.words(r["text"])))
    repeats = Counter({k: n for k, n in rows_of(before).items()})
    assert all(n <= 3 * repeats[k] for k, n in rows_of(after).items())
    ties = max(repeats.values())
    for s, t in target.items():
        assert abs(taken[s] - t) <= ties * largest[s] / 2 + 1e-6


def test_packing(steps):
    _, before, columns, after = steps["packing"]
    assert {"doc_id", "start", "length", "ids", "sequence_id", "offset"} <= set(columns)
    check_packing(after, before)


def test_run(spark, docs_dir, empty_dir):
    assert corpus_pipeline.run(spark, empty_dir).collect() == []
    assert corpus_pipeline.run(spark, docs_dir).count() > 50
