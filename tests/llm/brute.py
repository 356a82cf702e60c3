"""Plain versions of the operators, for small tables."""

import hashlib
import re
import string
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def repeats(docs, window=100):
    """doc_id -> (n_bytes, n_removed, n_spans, kept_sha256)."""
    seen, out = set(), {}
    for doc_id, text in sorted(docs.items()):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for start in range(len(raw) - window + 1):
            part = raw[start : start + window]
            if part in seen:
                gone[start : start + window] = b"\1" * window
            seen.add(part)
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[doc_id] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def shingles(text):
    words = WORD.findall((text or "").translate(_LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def components(docs):
    """doc_id -> (n_shingles, component_id)."""
    sets = {d: shingles(t) for d, t in docs.items()}
    index = defaultdict(list)
    for doc_id, members in sets.items():
        for shingle in members:
            index[shingle].append(doc_id)
    parent = {d: d for d in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for doc_id, members in sets.items():
        shared = Counter(other for s in members for other in index[s] if other < doc_id)
        for other, n in shared.items():
            if 100 * n >= 80 * (len(members) + len(sets[other]) - n):
                a, b = root(doc_id), root(other)
                parent[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), root(d)) for d in docs}


def text_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {
        i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)
    }
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)


def base_spans(text):
    """(start, kind, end) of the base rules."""
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [
        (m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20
    ]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def weighted_jaccard(a, b):
    a, b = Counter(WORD.findall(a)), Counter(WORD.findall(b))
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 1.0
