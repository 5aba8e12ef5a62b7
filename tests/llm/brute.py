"""Plain single-process versions of the operators, for small tables."""

import hashlib

import numpy as np
import xxhash

UPPER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def substring_dedup(rows, window):
    """{row number: (n_words, n_removed, kept)}; rows are (key, text), a smaller key comes first."""
    words = [(text or "").encode().split() for _, text in rows]
    first = {}
    for (key, _), w in zip(rows, words):
        for i in range(len(w) - window + 1):
            s = tuple(w[i:i + window])
            first[s] = min(first.get(s, key), key)
    out = []
    for (key, _), w in zip(rows, words):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < key:
                gone[i:i + window] = [True] * window
        out.append((len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return out


def suffix_dedup(rows, length):
    """[(n_bytes, n_removed, n_spans, kept)] for rows (key, text) with different keys."""
    seen, out = set(), {}
    for key, text in sorted(rows, key=lambda r: r[0]):
        b = (text or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            s = b[i:i + length]
            if s in seen:
                gone[i:i + length] = b"\1" * length
            seen.add(s)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out[key] = (len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g))
    return [out[key] for key, _ in rows]


def simhash(text, shingle=3):
    words = (text or "").encode().translate(UPPER).split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + shingle]), 42) for i in range(max(1, len(words) - shingle + 1))]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def grouped(n, linked):
    """Smallest index reachable from each of n indexes over the pairs in ``linked``."""
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def near(fingerprints, distance):
    x = np.array(fingerprints, dtype=np.uint64)
    return [(i, int(j)) for i in range(len(x)) for j in np.flatnonzero(np.bitwise_count(x ^ x[i]) <= distance) if i < j]


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()
