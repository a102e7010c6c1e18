"""Plain versions of the operators, straight from what their results are to be."""

import hashlib
import re
from collections import Counter

import numpy as np
import xxhash

SPACED = re.compile(rb"[^\x20\x09-\x0D]+")
LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def op1(rows, window=13):
    """doc_id, n_words, n_removed, kept_sha256; a null id is smaller than all."""
    order = lambda i: -(2**63) if i is None else i
    docs = [(i, SPACED.findall((t or "").encode())) for i, t in rows]
    first = {}
    for i, w in docs:
        for k in range(len(w) - window + 1):
            s = tuple(w[k : k + window])
            first[s] = min(first.get(s, 2**63), order(i))
    out = []
    for i, w in docs:
        covered = np.zeros(len(w), bool)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < order(i):
                covered[k : k + window] = True
        out.append((i, len(w), int(covered.sum()), sha(b" ".join(x for x, c in zip(w, covered, strict=True) if not c))))
    return out


def op5(rows, items, window=13):
    known = {}
    for i, t in items:
        w = LETTERS.findall((t or "").translate(LOWER))
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            known.setdefault(tuple(w[k : k + n]), set()).add(str(i))
    out = []
    for i, t in rows:
        w = LETTERS.findall((t or "").translate(LOWER))
        hit, found = np.zeros(len(w), bool), set()
        for n in {len(k) for k in known}:
            for k in range(len(w) - n + 1):
                if s := known.get(tuple(w[k : k + n])):
                    found |= s
                    hit[k : k + n] = True
        n = int(hit.sum())
        out.append((i, len(w), n, len(found), sha(",".join(sorted(found))), n > 0 and 20 * n >= len(w)))
    return out


def simhash(text):
    words = [w.decode() for w in SPACED.findall((text or "").translate(LOWER).encode())]
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def components_of(fingerprints):
    """Index of the component of each fingerprint, by all pairs."""
    f = np.array(fingerprints, np.uint64)
    root = list(range(len(f)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(f)):
        bits = np.unpackbits((f ^ f[a]).view(np.uint8).reshape(-1, 8), axis=1).sum(1)
        for b in np.flatnonzero(bits <= 2):
            p, q = find(a), find(int(b))
            root[max(p, q)] = min(p, q)
    return [find(i) for i in range(len(f))]


def op6(rows):
    prints = [simhash(t) for _, t in rows]
    groups = components_of(prints)
    least = {}
    for (i, _), g in zip(rows, groups, strict=True):
        if i is not None:
            least[g] = min(least.get(g, i), i)
    return [(i, format(f, "016x"), least.get(g)) for (i, _), f, g in zip(rows, prints, groups, strict=True)]


def op7(rows, length=200):
    texts = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(b[k : k + length] for _, b in texts for k in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        covered = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if count[b[k : k + length]] > 1:
                covered[k : k + length] = True
        runs = int((covered & ~np.concatenate([[False], covered[:-1]])[: len(b)]).sum())
        out.append((i, len(b), int(covered.sum()), runs, sha(np.frombuffer(b, np.uint8)[~covered].tobytes())))
    return out


FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else 2 * d - 9 if d > 4 else 2 * d
    return total % 10 == 0


def base_spans(text):
    out = []
    for kind, form in FORMS.items():
        for m in re.finditer(form, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda: True, "ip": lambda m=m: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda d=digits: 16 <= len(d) <= 19 and luhn(d), "phone": lambda d=digits: 8 <= len(d) <= 15,
            }[kind]()
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def op10(rows):
    out = []
    for i, t in rows:
        found = base_spans(t)
        counts = Counter(k for k, _, _ in found)
        out.append((i, *[counts[k] for k in FORMS], sha(",".join(f"{k}:{s}:{e}" for k, s, e in found))))
    return out
