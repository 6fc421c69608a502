"""License scans: MinHash bands retrieve templates, exact containment decides.

A text is read as words (A-Z folded, ASCII punctuation as white space) and
5-word shingles; a template of fewer words is one shingle of all its words.
For every template length, windows of that many words overlap in steps of a
sixteenth of it.  Each window's MinHash signature has ``BANDS`` bands of
``ROWS`` values; a window that shares a band with a template of its length
retrieves it, and the template's best place within a step of it is taken.  At a
resemblance of 0.8 a band agrees with probability 0.64,
so all 20 miss with a chance of 0.36**20, below 1e-8.  A retrieved template
matches when the window holds at least ``CONTAINED`` of its shingles, counted
exactly.

Windows without any shingle of a template of their length have resemblance 0
with all of these; only the others are hashed.  Templates travel with the code (their
number is fixed, not data).  Every text is scanned whole in its own row, so
nothing is shuffled.

Defined results: a null or empty text has no match; matches of one license
that overlap count once, at the best window (the first of equal ones);
repeated rows and equal ids get a row each; other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import col, read_docs, ship_package, text_of
from ledgerline.llm.license_texts import BODIES, NOTICES

SHINGLE = 5
BANDS, ROWS = 20, 2
CONTAINED = 0.8
STEPS = 16

# Public license notices, as they appear in texts.
TEMPLATES: list[tuple[str, str]] = [
    ("all-rights-reserved", "All rights reserved."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    *NOTICES,
    *BODIES,
]


def _seeds() -> np.ndarray:
    from ledgerline.llm.words import mix

    return mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))


def band_keys(grams: np.ndarray) -> np.ndarray:
    """(sets, BANDS) keys of sets given as rows of shingle hashes."""
    from ledgerline.llm.words import mix

    mins = np.stack([mix(grams ^ s).min(axis=1) for s in _seeds()], axis=1)
    rows = mins.reshape(len(grams), BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)[None, :]
    for r in range(ROWS):
        key = mix(key ^ rows[:, :, r])
    return key


class Templates:
    """Templates by length: shingles and the band index."""

    def __init__(self, templates: list[tuple[str, str]]):
        from ledgerline.llm.words import gram_hashes, word_hashes

        self.names = [name for name, _ in templates]
        self.sets: list[np.ndarray] = []
        self.by_length: dict[int, dict[int, list[int]]] = {}
        known: dict[int, list[np.ndarray]] = {}
        for i, (_, text) in enumerate(templates):
            words = word_hashes(text, plain=True)
            grams = gram_hashes(words, min(SHINGLE, len(words)))
            self.sets.append(np.unique(grams))
            index = self.by_length.setdefault(len(words), {})
            for key in band_keys(grams[None, :])[0].tolist():
                index.setdefault(key, []).append(i)
            known.setdefault(len(words), []).append(grams)
        self.known = {n: np.unique(np.concatenate(s)) for n, s in known.items()}
        sizes = {min(SHINGLE, n) for n in self.known}
        self.any = {g: np.unique(np.concatenate([s for n, s in self.known.items() if min(SHINGLE, n) == g])) for g in sizes}
        self.keys = {n: np.array(sorted(index), dtype=np.uint64) for n, index in self.by_length.items()}

    def matches(self, text: str | None) -> list[tuple[str, int, int, float]]:
        """(license, first word, end word, containment), by place."""
        from ledgerline.llm.words import gram_hashes, word_hashes

        words = word_hashes(text, plain=True)
        found: list[tuple[str, int, int, float]] = []
        sizes = {min(SHINGLE, n) for n in self.by_length}
        grams = {g: gram_hashes(words, g) for g in sizes}
        places = {g: self._places(g, grams[g]) for g in sizes}
        for n, index in self.by_length.items():
            g = min(SHINGLE, n)
            k = n - g + 1
            # the last window ends with the text; a shorter text is one window
            if not len(places[g]):
                continue
            known = self.known[n]
            at = np.minimum(np.searchsorted(known, grams[g][places[g]]), len(known) - 1)
            hit = places[g][known[at] == grams[g][places[g]]]
            if not len(hit):
                continue
            hits = np.searchsorted(hit, np.arange(len(grams[g]) + 1))
            k, step = min(k, len(grams[g])), max(1, n // STEPS)
            starts = np.arange(0, len(grams[g]) - k + 1, step)
            if starts[-1] != len(grams[g]) - k:
                starts = np.append(starts, len(grams[g]) - k)
            starts = starts[hits[starts + k] > hits[starts]]
            for a in range(0, len(starts), 2000):
                part = starts[a : a + 2000]
                windows = grams[g][part[:, None] + np.arange(k)[None, :]]
                keys = band_keys(windows)
                known_keys = self.keys[n]
                at = np.minimum(np.searchsorted(known_keys, keys), len(known_keys) - 1)
                for w in np.flatnonzero((known_keys[at] == keys).any(axis=1)):
                    got = {t for key in keys[w].tolist() for t in index.get(key, ())}
                    for t in got:
                        share, first = self._placed(t, grams[g], int(part[w]), k, step)
                        if share >= CONTAINED:
                            found.append((self.names[t], first, first + k + g - 1, share))
        return self._best(found)

    def _places(self, g: int, grams: np.ndarray) -> np.ndarray:
        """Where shingles of ``g`` words of any template are."""
        known = self.any[g]
        at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
        return np.flatnonzero(known[at] == grams)

    def _placed(self, t: int, grams: np.ndarray, start: int, k: int, step: int) -> tuple[float, int]:
        """Greatest containment within a step of a window, and its first place."""
        firsts = range(max(0, start - step + 1), min(len(grams) - k, start + step - 1) + 1)
        shares = [(float(np.isin(self.sets[t], grams[a : a + k]).mean()), -a) for a in firsts]
        share, a = max(shares)
        return share, -a

    @staticmethod
    def _best(found: list[tuple[str, int, int, float]]) -> list[tuple[str, int, int, float]]:
        out: list[tuple[str, int, int, float]] = []
        open_: dict[str, list] = {}
        for m in sorted(found, key=lambda m: (m[1], m[2], m[0])):
            held = open_.get(m[0])
            if held and m[1] < held[1]:
                held[1] = max(held[1], m[2])
                if m[3] > held[0][3]:
                    held[0] = m
            else:
                if held:
                    out.append(held[0])
                open_[m[0]] = [m, m[2]]
        out += [held[0] for held in open_.values()]
        return sorted(out, key=lambda m: (m[1], m[2], m[0]))


@lru_cache(maxsize=4)
def _templates(templates: tuple[tuple[str, str], ...]) -> Templates:
    return Templates(list(templates))


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: list[tuple[str, str]] | None = None,
) -> DataFrame:
    """doc_id and ``matches``: license, start and end word, containment."""
    ship_package(docs.sparkSession)
    fixed = tuple(templates or TEMPLATES)
    kind = "array<struct<license:string,start:bigint,end:bigint,containment:double>>"

    @F.pandas_udf(kind)
    def scan(texts: pd.Series) -> pd.Series:
        index = _templates(fixed)
        names = ("license", "start", "end", "containment")
        return texts.map(lambda t: [dict(zip(names, m, strict=True)) for m in index.matches(t)])

    return docs.select(col(id_col).alias("doc_id"), scan(text_of(text_col)).alias("matches"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan_licenses(read_docs(spark, sf_dir))
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"])))
    spans = F.transform("matches", lambda m: F.concat_ws(":", m["license"], m["start"], m["end"]))
    return out.select(
        "doc_id",
        F.size("matches").cast("bigint").alias("n_matches"),
        F.array_join(names, ",").alias("licenses"),
        F.array_join(spans, ",").alias("spans"),
        F.coalesce(F.array_min(F.transform("matches", lambda m: m["containment"])), F.lit(0.0)).alias("least_containment"),
    )


__all__ = ["TEMPLATES", "Templates", "band_keys", "op4", "scan_licenses"]
