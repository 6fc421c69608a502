"""Substring dedup with FM-indexes of routed shards.

A window is 13 consecutive words.  A word goes when a window covers it whose
words also start in a document with a smaller id.

Streaming every document through the index of every shard would make the
work grow with the square of the input, so passages are routed first, and
each index decides what was routed to it:

1. A window's anchor is its 8-word run with the smallest hash, so equal
   windows have equal anchors.  Each text is cut into segments, the runs of
   consecutive windows with one anchor.  Only (anchor, content hash,
   document, place) of a segment is shuffled, by anchor.  Of the rows of one
   batch with equal content only the first document's needs to meet its
   anchor; the others are known to have a partner and are dealt out evenly,
   so copies of a passage do not meet in one task.
2. A stream over the sorted rows drops the anchors that lie in one document.
3. The distinct contents of the other anchors are fetched from the first
   document that has them.  Anchors with more than ``HOT_CONTENTS`` contents
   (a frequent phrase in ever new surroundings) are routed once more, by
   whole windows, so that no group grows beyond that number.
4. Consecutive anchors fill shards of ``SHARD_WORDS`` words.  Each shard is an
   FM-index (wavelet matrix) with the smallest document per suffix interval,
   and the contents are streamed through it: matching statistics by backward
   search give, for every place, whether a match of the threshold length ends
   there, and the first document that has it.  Copies of one content share
   its answer; every removal comes from such a match.
5. The answers join the segments' rows; the covered windows return per
   document as short codes and are applied to its text.

Defined results: null text has no words; a null id orders after all others;
rows that share an id are one document, each text with its own places (its
number among the texts of shared ids is part of the key); repeated rows get
the same result; very long texts are cut, hashed and applied whole, one text
in memory at a time; other columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import Sized, col, materialize, read_docs, ship_package, text_of
from ledgerline.operators.sequence import with_row_index_counted

WINDOW = 13
ANCHOR = 8
SHARD_WORDS = 400_000
HOT_CONTENTS = 20_000
_LAST = (1 << 63) - 1
_SPAN = WINDOW - ANCHOR + 1  # most windows of a segment


def segments(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """anchor, content hash, first window and number of windows of each
    segment of a text's word hashes."""
    from ledgerline.llm.words import _ROLL, _powers, gram_hashes, mix

    grams = gram_hashes(words, ANCHOR)
    n = len(words) - WINDOW + 1
    if n <= 0:
        none = np.empty(0, dtype=np.int64)
        return none.view(np.uint64), none.view(np.uint64), none, none
    place = np.arange(n) + np.lib.stride_tricks.sliding_window_view(grams, _SPAN).argmin(axis=1)
    start = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    count = np.diff(np.concatenate((start, [n])))
    power = _powers(_ROLL, len(words) + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * power[:-1])))
    inverse = _powers(np.uint64(pow(int(_ROLL), -1, 1 << 64)), len(words) + 1)
    content = mix((total[start + count + WINDOW - 1] - total[start]) * inverse[start] + count.astype(np.uint64))
    return grams[place[start]], content, start, count


_TAGS = 1 << 29


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, tag, text): doc is the id with null last; tag is 0, or the number
    of the text among all texts of ids that have several."""
    text = text_of(text_col)
    rows = docs.select(
        F.coalesce(col(id_col).cast("bigint"), F.lit(_LAST)).alias("doc"), F.xxhash64(text).alias("h"), text.alias("text")
    )
    per_id = rows.groupBy("doc").agg(F.min("h").alias("a"), F.max("h").alias("b"))
    shared = materialize(per_id.filter("a <> b").select("doc"), "shared-ids")
    n = shared.count()
    if not n:
        return rows.select("doc", F.lit(0).cast("bigint").alias("tag"), "text")
    pairs = rows.select("doc", "h").join(Sized(shared, n).for_join(), "doc").distinct()
    tags, count = with_row_index_counted(pairs, [F.col("doc"), F.col("h")], "tag")
    if count > _TAGS:
        raise ValueError(f"{count} texts share their ids with other texts; at most {_TAGS} can be told apart")
    tags = Sized(tags, count).for_join()
    return rows.join(tags, ["doc", "h"], "left").select("doc", F.coalesce("tag", F.lit(0).cast("bigint")).alias("tag"), "text")


_ROW = T.StructType([T.StructField(c, T.LongType()) for c in ("anchor", "content", "doc", "place")])
_ROUTED = T.StructType([T.StructField("route", T.LongType()), *_ROW.fields])
_SHARED = 8  # flag beside a segment's number of windows: its batch holds a partner


def _place(tag, start, count):
    return (tag << 34) | (start << 4) | count


def _routed(t: np.ndarray) -> np.ndarray:
    """Rows (anchor, content, doc, place) of one batch with the key they are
    dealt out by: the anchor, or a scattered one where the first document of
    that content in the batch stands for the row."""
    from ledgerline.llm.words import mix

    order = np.lexsort((t[2], t[1], t[0]))
    s = t[:, order]
    new = np.ones(s.shape[1], dtype=bool)
    new[1:] = (s[0][1:] != s[0][:-1]) | (s[1][1:] != s[1][:-1])
    group = np.maximum.accumulate(np.where(new, np.arange(s.shape[1]), 0))
    later = s[2] > s[2][group]
    route = s[0].copy()
    route[later] = mix((s[2] * 31 + s[3])[later].view(np.uint64)).view(np.int64)
    first = np.flatnonzero(new)
    shared = np.add.reduceat(later, first) > 0
    s[3] |= np.where(shared[np.cumsum(new) - 1], _SHARED, 0)
    return np.concatenate([route[None], s])


def segment_rows(texts: DataFrame) -> DataFrame:
    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from ledgerline.llm.words import word_hashes

        for batch in batches:
            parts: list[list[np.ndarray]] = [[], [], [], []]
            docs, tags = batch.column("doc").to_numpy(), batch.column("tag").to_numpy()
            for doc, tag, text in zip(docs, tags, batch.column("text").to_pylist(), strict=True):
                anchor, content, start, count = segments(word_hashes(text))
                parts[0].append(anchor.view(np.int64))
                parts[1].append(content.view(np.int64))
                parts[2].append(np.full(len(start), doc, dtype=np.int64))
                parts[3].append(_place(int(tag), start.astype(np.int64), count.astype(np.int64)))
            if sum(map(len, parts[0])):
                table = _routed(np.stack([np.concatenate(p) for p in parts]))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in table], names=_ROUTED.names)

    return texts.mapInArrow(cut, _ROUTED)


def shared_segments(rows: DataFrame) -> DataFrame:
    """The rows whose anchor lies in at least two documents."""
    rows = rows.repartition("route").sortWithinPartitions("route", "doc")

    def keep(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def out(t: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*map(pa.array, t[1:4]), pa.array(t[4] & ~_SHARED)], names=_ROW.names)

        # rows of the anchor that is not over yet: all of one document, so no
        # more than one text has
        held = np.empty((5, 0), dtype=np.int64)
        known = None  # the anchor that is not over yet, if it is shared
        for batch in batches:
            if not batch.num_rows:
                continue
            t = np.concatenate([held, np.stack([batch.column(i).to_numpy() for i in range(5)])], axis=1)
            new = np.concatenate(([True], t[0][1:] != t[0][:-1]))
            at = np.flatnonzero(new)
            marked = ((t[4] & _SHARED) > 0) | (t[0] != t[1])
            several = np.minimum.reduceat(t[3], at) < np.maximum.reduceat(t[3], at)
            several |= np.logical_or.reduceat(marked, at)
            if known is not None and t[0][0] == known:
                several[0] = True
            known = t[0][-1] if several[-1] else None
            last = at[-1] if known is None else t.shape[1]
            chosen = several[np.cumsum(new) - 1]
            chosen[last:] = False
            held = t[:, last:]
            if chosen.any():
                yield out(t[:, chosen])

    return rows.mapInArrow(keep, _ROW)


def contents(wanted: DataFrame, texts: DataFrame) -> DataFrame:
    """``wanted`` rows (anchor, content, doc, place, last) with the ``words``
    of the segment, as hashes, from the text that holds it (from every one of
    repeated rows)."""
    places = wanted.withColumn("tag", F.shiftrightunsigned("place", 34))
    entry = F.struct("anchor", "content", "place", "last")
    per_text = places.groupBy("doc", "tag").agg(F.collect_list(entry).alias("at"))  # bounded by the text
    joined = texts.join(per_text, ["doc", "tag"])

    def fetch(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from ledgerline.llm.words import word_hashes

        for batch in batches:
            at = batch.column(2)
            flat = at.flatten()
            anchor, content, place, last = (flat.field(i).to_numpy() for i in range(4))
            ends = np.cumsum(at.value_lengths().to_numpy())
            start, size = (place >> 4) & ((1 << 30) - 1), (place & 7) + WINDOW - 1
            words, a = [], 0
            for text, b in zip(batch.column(1).to_pylist(), ends, strict=True):
                hashes = word_hashes(text)
                words += [hashes[i : i + k].tobytes() for i, k in zip(start[a:b], size[a:b], strict=True)]
                a = b
            doc = np.repeat(batch.column(0).to_numpy(), np.diff(ends, prepend=0))
            arrays = [pa.array(anchor), pa.array(content), pa.array(doc), pa.array(last), pa.array(words, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=_CONTENT_COLUMNS)

    return joined.select("doc", "text", "at").mapInArrow(fetch, _CONTENT)


_CONTENT_COLUMNS = ["anchor", "content", "doc", "last", "words"]
_CONTENT = "anchor bigint, content bigint, doc bigint, last bigint, words binary"
_LEAST = [f"least{i}" for i in range(_SPAN)]


def search_shard(t: np.ndarray, sizes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Index a shard's contents and stream them through it.

    ``t``: anchor, content, first and last document per content; ``words``:
    their word hashes, one content after the other.  Returns anchor, content
    and, for every window, the first document that has it; contents of which
    no document after that has a copy are left out."""
    from ledgerline.llm.fmindex import FMIndex

    n = len(sizes)
    docs, rank = np.unique(t[2], return_inverse=True)
    _, symbols = np.unique(words, return_inverse=True)
    first = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    text = np.zeros(int(sizes.sum()) + n, dtype=np.int64)
    label = np.repeat(rank, sizes + 1)
    inside = np.arange(len(symbols)) + np.repeat(np.arange(n), sizes)
    text[inside] = symbols + 1
    index = FMIndex(text, label)
    windows = sizes - WINDOW + 1
    owner = np.repeat(np.arange(n), windows)
    nth = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    ends = first[owner] + nth + WINDOW
    length, lo, hi = index.matching(text, ends, WINDOW)
    hit = length >= WINDOW
    least = np.full((_SPAN, n), _LAST, dtype=np.int64)
    least[nth[hit], owner[hit]] = docs[index.least(lo[hit], hi[hit])]
    out = np.concatenate([t[:2], least])
    return out[:, least.min(axis=0) < t[3]]


def searched(found: DataFrame) -> DataFrame:
    """(anchor, content, least0, ...): the first document of each window of
    the contents.  Whole anchors go to one shard, and a partition is cut into
    as many shards as its words fill."""
    rows = found.select(*_CONTENT_COLUMNS).repartition("anchor").sortWithinPartitions("anchor", "content")

    def search(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def out(part: tuple) -> Iterator:
            t, sizes, words = part
            if t.shape[1] and (got := search_shard(t, sizes, words)).shape[1]:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in got], names=["anchor", "content", *_LEAST])

        held: list[tuple] = []  # (columns, sizes in words, words) of the shard so far
        filled = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            t = np.stack([batch.column(i).to_numpy() for i in range(4)])
            raw = batch.column(4).cast(pa.large_binary())
            ends = np.frombuffer(raw.buffers()[1], dtype=np.int64)[raw.offset : raw.offset + len(raw) + 1] // 8
            words = np.frombuffer(raw.buffers()[2], dtype=np.uint64, count=int(ends[-1]))[int(ends[0]) :]
            held.append((t, np.diff(ends), words))
            filled += len(words)
            if filled < SHARD_WORDS:
                continue
            t, sizes, words = (np.concatenate(x, axis=-1) for x in zip(*held, strict=True))
            over = t[0] != t[0][-1]  # the last anchor may go on in the next batch
            cut = int(over.sum())
            at = int(sizes[:cut].sum())
            yield from out(_distinct(t[:, :cut], sizes[:cut], words[:at]))
            held, filled = [_distinct(t[:, cut:], sizes[cut:], words[at:])], 0
            filled = len(held[0][2])
        if held:
            yield from out(_distinct(*(np.concatenate(x, axis=-1) for x in zip(*held, strict=True))))

    fields = ", ".join(f"{c} bigint" for c in ["anchor", "content", *_LEAST])
    return rows.mapInArrow(search, fields)


def _distinct(t: np.ndarray, sizes: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each content once (repeated rows of a text bring it again)."""
    new = np.ones(t.shape[1], dtype=bool)
    new[1:] = (t[0][1:] != t[0][:-1]) | (t[1][1:] != t[1][:-1])
    return (t, sizes, words) if new.all() else (t[:, new], sizes[new], words[np.repeat(new, sizes)])


def single_windows(rows: DataFrame) -> DataFrame:
    """Segments with their words as rows of one window each, whose anchor is
    the window itself."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from ledgerline.llm.words import gram_hashes, mix

        for batch in batches:
            frames = []
            for doc, place, raw in zip(batch["doc"], batch["place"], batch["words"], strict=True):
                words = np.frombuffer(raw, dtype=np.uint64)
                h = gram_hashes(words, WINDOW)
                second = gram_hashes(mix(words + np.uint64(1)), WINDOW)
                windows = np.lib.stride_tricks.sliding_window_view(words, WINDOW)
                frames.append(
                    pd.DataFrame(
                        {"anchor": h.view(np.int64), "content": second.view(np.int64), "doc": doc,
                         "place": (int(place) & ~15) + (np.arange(len(h)) << 4) + 1,
                         "words": [w.tobytes() for w in windows]}
                    )
                )
            if frames:
                yield pd.concat(frames)

    return rows.select("doc", "place", "words").mapInPandas(cut, "anchor bigint, content bigint, doc bigint, place bigint, words binary")


def _firsts(rows: DataFrame) -> DataFrame:
    """Each distinct content with the first document that has it, a place
    there, and the last document."""
    out = rows.groupBy("anchor", "content").agg(F.min(F.struct("doc", "place")).alias("f"), F.max("doc").alias("last"))
    return out.select("anchor", "content", "f.doc", "f.place", "last")


def _answered(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(doc, place, mask) of the segments with a window (bit) that a smaller
    document has as well, by the answers of the index."""
    hits = rows.join(searched(found), ["anchor", "content"])
    mask = F.lit(0).cast("bigint")
    for i, c in enumerate(_LEAST):
        mask = mask + F.when(F.col(c) < F.col("doc"), F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
    return hits.select("doc", "place", mask.alias("mask")).filter("mask > 0")


def covered_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", texts: DataFrame | None = None) -> DataFrame:
    """(doc, tag, code): windows start + i for the bits i of code & 511, with
    start = code >> 9."""
    ship_package(docs.sparkSession)
    texts = keyed(docs, id_col, text_col) if texts is None else texts
    rows = materialize(shared_segments(segment_rows(texts)), "segments")
    found = materialize(contents(_firsts(rows), texts), "contents")
    sizes = found.groupBy("anchor").agg(F.countDistinct("content").alias("contents"))
    hot = materialize(sizes.filter(F.col("contents") > HOT_CONTENTS).select("anchor"), "hot")
    n_hot = hot.count()
    if not n_hot:
        hits = _answered(rows, found)
    else:
        hot = Sized(hot, n_hot).for_join()
        hits = _answered(rows.join(hot, "anchor", "left_anti"), found.join(hot, "anchor", "left_anti"))
        words = found.join(hot, "anchor", "left_semi").groupBy("anchor", "content").agg(F.first("words").alias("words"))
        long = rows.join(words, ["anchor", "content"])
        single = materialize(single_windows(long), "windows")
        one = single.groupBy("anchor", "content").agg(
            F.min("doc").alias("doc"), F.max("doc").alias("last"), F.first("words").alias("words"))
        hits = hits.unionByName(_answered(single.drop("words"), one))
    start = F.shiftright("place", 4).bitwiseAND(F.lit((1 << 30) - 1).cast("bigint"))
    code = F.shiftleft(start, 9).bitwiseOR(F.col("mask"))
    return hits.select("doc", F.shiftrightunsigned("place", 34).alias("tag"), code.alias("code"))


def kept_words(text: str, codes: np.ndarray) -> tuple[int, int, bytes]:
    """Number of words, number removed, and the kept words joined by a space."""
    from ledgerline.llm.words import _SPACE, word_spans

    raw = (text or "").encode("utf-8", "surrogatepass")
    data = np.frombuffer(raw, dtype=np.uint8)
    starts, ends = word_spans(data)
    edge = np.zeros(len(starts) + WINDOW + 1, dtype=np.int64)
    for i in range(_SPAN):
        at = (codes[(codes >> i) & 1 == 1] >> 9) + i
        np.add.at(edge, at, 1)
        np.add.at(edge, at + WINDOW, -1)
    keep = np.cumsum(edge)[: len(starts)] == 0
    letters = np.zeros(len(data) + 1, dtype=np.int8)
    letters[starts[keep]] = 1
    letters[ends[keep]] = -1
    mask = np.cumsum(letters[:-1]) > 0
    mask[ends[keep & (ends < len(data))]] = True  # the white space after a kept word
    spaced = np.where(_SPACE[data], np.uint8(32), data)
    return len(starts), int((~keep).sum()), spaced[mask].tobytes().rstrip(b" ")


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and the kept text) per row."""
    texts = keyed(docs, id_col, text_col)
    codes = covered_windows(docs, id_col, text_col, texts).groupBy("doc", "tag").agg(F.collect_list("code").alias("codes"))
    rows = texts.join(codes, ["doc", "tag"], "left")
    schema = "doc bigint, n_words bigint, n_removed bigint, kept_sha256 string" + (", kept string" if with_text else "")

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, text, found in zip(batch["doc"], batch["text"], batch["codes"], strict=True):
                at = np.empty(0, np.int64) if found is None else np.asarray(found, dtype=np.int64)
                n, removed, kept = kept_words(text, at)
                row = (doc, n, removed, hashlib.sha256(kept).hexdigest())
                out.append((*row, kept.decode("utf-8", "surrogatepass")) if with_text else row)
            names = ["doc", "n_words", "n_removed", "kept_sha256"]
            yield pd.DataFrame(out, columns=[*names, "kept"] if with_text else names)

    done = rows.select("doc", "text", "codes").mapInPandas(apply, schema)
    ident = F.when(F.col("doc") != _LAST, F.col("doc")).cast(docs.schema[id_col].dataType)
    return done.withColumn("doc_id", ident).select("doc_id", *[c for c in done.columns if c != "doc"])


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(read_docs(spark, sf_dir))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), g AS (
  SELECT k, doc_id, i, list_slice(w, i, i + 12) AS win
  FROM (SELECT k, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)
), c AS (
  SELECT k, i FROM g QUALIFY doc_id > min(doc_id) OVER (PARTITION BY win)
), x AS (
  SELECT DISTINCT k, unnest(range(i, i + 13)) AS p FROM c
), r AS (
  SELECT k, list(p) AS gone FROM x GROUP BY k
), o AS (
  SELECT d.k, d.doc_id, w[p] AS word, p, x.p IS NOT NULL AS gone
  FROM (SELECT k, doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d) d LEFT JOIN x USING (k, p)
), a AS (
  SELECT k, CAST(sum(gone::INT) AS BIGINT) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (NOT gone) AS kept FROM o GROUP BY k
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN a USING (k)
"""
