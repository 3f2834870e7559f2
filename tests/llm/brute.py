"""Plain forms of what the operators compute, over lists of (id, text)."""

import hashlib
import math
import re
import zlib
from collections import Counter

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return WORD.findall((text or "").encode())


def repeated_passages(rows, size):
    first, out = {}, {}
    for i, text in sorted(rows):
        w = words(text)
        for p in range(len(w) - size + 1):
            first.setdefault(tuple(w[p : p + size]), (i, p))
    for i, text in rows:
        w = words(text)
        gone = [False] * len(w)
        for p in range(len(w) - size + 1):
            if first[tuple(w[p : p + size])] != (i, p):
                gone[p : p + size] = [True] * size
        out[i] = (len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode())
    return out


def repeated_lines(rows, size):
    first, out = {}, {}
    full = {i: [k for k, x in enumerate(t.split("\n")) if x.strip(" ")] for i, t in rows if t is not None}
    lines = {i: t.split("\n") for i, t in rows if t is not None}
    for i in sorted(full):
        for p in range(len(full[i]) - size + 1):
            first.setdefault(tuple(lines[i][k] for k in full[i][p : p + size]), (i, p))
    for i, text in rows:
        if text is None:
            out[i] = (None, 0, 0)
            continue
        gone = set()
        for p in range(len(full[i]) - size + 1):
            if first[tuple(lines[i][k] for k in full[i][p : p + size])] != (i, p):
                gone.update(full[i][p : p + size])
        out[i] = ("\n".join(x for k, x in enumerate(lines[i]) if k not in gone), len(full[i]), len(gone))
    return out


def fingerprint(text, size):
    import xxhash

    w = [x.decode() for x in words(lower(text))]
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + size]), 42) for i in range(max(1, len(w) - size + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(rows, size, radius):
    prints = {i: fingerprint(t, size) for i, t in rows}
    root = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= radius and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    return {i: (f"{prints[i]:016x}", root[i]) for i in prints}


def add_one(rows, folds=7, held=2):
    tokens = {i: words(lower(t)) + [None] for i, t in rows}
    out = {i: zlib.crc32(str(i).encode()) % folds == held for i in tokens}
    counts = Counter(w for i, t in tokens.items() if not out[i] for w in t)
    n, v = sum(counts.values()), len(counts)
    return {
        i: (out[i], len(t), sum(counts[w] > 0 for w in t), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t))
        for i, t in tokens.items()
    }


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leak_distance(item, text):
    """Fewest edits that turn the item into a stretch of the text (both as bytes)."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i] + [0] * len(text)
        for j, b in enumerate(text, 1):
            new[j] = min(row[j - 1] + (a != b), row[j] + 1, new[j - 1] + 1)
        row = new
    return min(row)
