"""Plain Python versions of the operators, over lists of row dicts."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACES = " \t\n\x0b\f\r"
FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def order(doc_id):
    return (doc_id is None, doc_id or 0)


def targets(rows, weights=(5, 2, 1), most=3):
    size = Counter()
    for r in rows:
        size[r["source"]] += len(words(r["text"]))
    names = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(size.values()), set()
    while True:
        rest = total - sum(most * size[s] for s in capped)
        free = sum(weight[s] for s in names if s not in capped)
        more = {s for s in names if s not in capped and weight[s] * rest >= most * size[s] * free}
        if not more or not free:
            break
        capped |= more
    return size, {s: float(most * size[s]) if s in capped else weight[s] * rest / free for s in names}


def shingles(text, n=5):
    w = words((text or "").translate(FOLD))
    if not w:
        return frozenset()
    n = min(n, len(w))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1))


def near_duplicates(rows):
    """component_id per row index."""
    sets = [shingles(r["text"]) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        k = find(i)
        ids = [x for x in (least.get(k), r["doc_id"]) if x is not None]
        least[k] = min(ids) if ids else None
    return [(len(sets[i]), least[find(i)] if sets[i] else r["doc_id"]) for i, r in enumerate(rows)]


def line_dedup(rows):
    """(lines, kept lines) per row."""
    keys = defaultdict(list)
    split = [(r["text"] or "").split("\n") for r in rows]
    for r, lines in zip(rows, split, strict=True):
        for x in lines:
            k = x.strip(SPACES).translate(FOLD)
            if len(k) >= 10:
                keys[k].append(r["doc_id"])
    first = {k: min(v, key=order) for k, v in keys.items()}
    out = []
    for r, lines in zip(rows, split, strict=True):
        kept = [x for x in lines if first.get(x.strip(SPACES).translate(FOLD), r["doc_id"]) == r["doc_id"]]
        out.append((lines, kept))
    return out


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_secrets(text):
    text = text or ""
    spans = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    spans += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    kinds = ["assign", "access", "hex"]
    return sorted(spans, key=lambda s: (s[1], kinds.index(s[0])))


def substring_dedup(rows, n=13):
    """(n_words, n_removed, kept text) per row."""
    first = {}
    split = [words(r["text"]) for r in rows]
    for r, w in zip(rows, split, strict=True):
        for i in range(len(w) - n + 1):
            g = tuple(w[i : i + n])
            first[g] = min(first.get(g, r["doc_id"]), r["doc_id"], key=order)
    out = []
    for r, w in zip(rows, split, strict=True):
        gone = set()
        for i in range(len(w) - n + 1):
            if first[tuple(w[i : i + n])] != r["doc_id"]:
                gone.update(range(i, i + n))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, strikes."""
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    grams = defaultdict(list)
    for i in range(len(w) - 7):
        grams[tuple(w[i : i + 8])].append(i)
    covered = {p for at in grams.values() if len(at) > 1 for i in at for p in range(i, i + 8)}
    n, chars = len(w), sum(map(len, w))
    symbols, dup = sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines))
    failed = n < 20 or 100 * len(covered) > 30 * n
    strikes = sum(
        [symbols * 10 > n, chars < 2 * n or chars > 12 * n, dup * 100 > len(lines) * 30, len(covered) * 100 > n * 15]
    )
    return n, chars, symbols, dup, len(covered), failed, strikes


def sentences(text):
    return Counter(x for line in text.split("\n") for x in re.split(r"(?<=[.!?]) ", line))
