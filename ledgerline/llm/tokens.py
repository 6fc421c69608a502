"""Token ids of whole texts inside Python tasks, by a public word-level BPE.

The tokenizer lower-cases a text, cuts it into words and codes each word on
its own, so a word's ids do not depend on its neighbours and can be kept.
:class:`WordIds` keeps the ids of white-space chunks in two generations of
bounded size.  Texts for which Python's and the tokenizer's idea of letters,
white space or lower case could differ go to the tokenizer whole.
"""

from __future__ import annotations

import os
import re
import unicodedata

import numpy as np

#: Python's and the tokenizer's tables agree below this code point.
_PLAIN_BELOW = 0x250
_UNSURE = re.compile("[\x1c-\x1f\x85\xa0%s-\U0010ffff]|<\\|" % chr(_PLAIN_BELOW))


def _class(initial: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(_PLAIN_BELOW) if unicodedata.category(chr(c))[0] == initial)


def _word_pattern() -> re.Pattern:
    letters, digits = _class("L"), _class("N")
    # The English endings that the tokenizer's own pattern names.
    return re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{digits}]|[^\s{letters}{digits}]+")


class WordIds:
    """``path``: the tokenizer file (default: the public word-level BPE)."""

    def __init__(self, path: str | None = None, keep: int = 400_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("word_bpe_49k.json")
        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        self.pattern = _word_pattern()
        self.keep = keep
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _learn(self, chunks: list[str]) -> None:
        pieces = [self.pattern.findall(c) for c in chunks]
        if len(self.words) > self.keep:
            self.words = {}
        unknown = list({w for p in pieces for w in p if w not in self.words})
        for a in range(0, len(unknown), 4000):
            part = unknown[a : a + 4000]
            ids = np.asarray(self.tokenizer.encode(" ".join(part), add_special_tokens=False).ids, dtype="<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(part):
                for w in part:
                    self.words[w] = np.asarray(
                        self.tokenizer.encode(w, add_special_tokens=False).ids, dtype="<u4"
                    ).tobytes()
                continue
            raw, at = ids.tobytes(), 0
            for w, cut in zip(part, cuts.tolist(), strict=True):
                self.words[w] = raw[4 * at : 4 * cut]
                at = cut
        if len(self.new) > self.keep:
            self.old, self.new = self.new, {}
        for c, p in zip(chunks, pieces, strict=True):
            self.new[c] = b"".join([self.words[w] for w in p])

    def encode(self, text: str | None) -> bytes:
        """The text's ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if _UNSURE.search(text):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return np.asarray(ids, dtype="<u4").tobytes()
        chunks = text.lower().split()
        new, old = self.new, self.old
        out = [new.get(c) for c in chunks]
        if None in out:
            missing = {c for c, ids in zip(chunks, out, strict=True) if ids is None}
            for c in [c for c in missing if c in old]:
                new[c] = old[c]
                missing.discard(c)
            if missing:
                self._learn(list(missing))
            new, old = self.new, self.old
            out = [new[c] if c in new else old[c] for c in chunks]
        return b"".join(out)


_CODERS: dict[str | None, WordIds] = {}


def coder(path: str | None) -> WordIds:
    """One coder per worker process and file."""
    if path not in _CODERS:
        _CODERS[path] = WordIds(path)
    return _CODERS[path]
