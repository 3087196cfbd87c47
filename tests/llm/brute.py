"""Plain versions of the corpus operators, for small inputs."""

import hashlib
import math
import zlib
from fractions import Fraction

import numpy as np
import xxhash

SPACE = b" \t\n\x0b\x0c\r"


def lower(b):
    return b.lower()


def dedup_lines(docs, min_chars=20, min_docs=3):
    """{row: (n_lines, n_dropped, kept bytes)} for [(id, text)]."""
    split = [[(x, lower(x.strip(SPACE))) for x in (t or "").encode().split(b"\n")] for _, t in docs]
    held = {}
    for (i, _), lines in zip(docs, split):
        for _, k in lines:
            if len(k.decode()) >= min_chars:
                held.setdefault(k, set()).add(-(2**63) if i is None else i)
    out = []
    for (i, _), lines in zip(docs, split):
        me = -(2**63) if i is None else i
        kept = [x for x, k in lines if not (len(held.get(k, ())) >= min_docs and me != max(held[k]))]
        out.append((len(lines), len(lines) - len(kept), b"\n".join(kept)))
    return out


def fingerprint(text, width=3):
    w = lower((text or "").encode()).split()
    shingles = [b" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def simhash_groups(docs, most=3):
    """[(fingerprint, smallest id of the group)]"""
    fps = [fingerprint(t) for _, t in docs]
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= most:
                parent[find(i)] = find(j)
    groups = {}
    for i, (d, _) in enumerate(docs):
        groups.setdefault(find(i), []).append(d)
    ids = [[d for d in groups[find(i)] if d is not None] for i in range(len(docs))]
    return [(f, min(g) if g else None) for f, g in zip(fps, ids)]


def near_groups(docs, width=5, share=0.8):
    """{id: smallest id of the group} of links of exact Jaccard similarity, for [(id, text)]."""
    sets = []
    for _, t in docs:
        w = lower((t or "").encode()).split()
        sets.append(frozenset(b" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset())
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] == sets[j] or both >= share * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        least[find(i)] = min(d, least.get(find(i), d))
    return {d: least[find(i)] for i, (d, _) in enumerate(docs)}


def dedup_substrings(docs, length=100, whole_chars=False):
    """{id: (n_bytes, n_removed, n_spans, kept bytes)}; ids must differ."""
    seen, out = set(), {}
    for i, t in sorted(docs, key=lambda x: -(2**63) if x[0] is None else x[0]):
        b = (t or "").encode()
        bad = np.zeros(len(b), bool)
        for a in range(len(b) - length + 1):
            w = b[a : a + length]
            if w in seen:
                bad[a : a + length] = True
            seen.add(w)
        if whole_chars:
            at = 0
            for c in (t or ""):
                n = len(c.encode())
                bad[at : at + n] = bad[at : at + n].all()
                at += n
        edges = np.diff(np.concatenate([[0], bad.astype(int), [0]]))
        out[i] = (len(b), int(bad.sum()), int((edges == 1).sum()), np.frombuffer(b, np.uint8)[~bad].tobytes())
    return out


def base_metrics(text):
    t = text or ""
    for c in "\t\n\x0b\x0c\r":
        flat = t.replace(c, " ") if c == "\t" else flat.replace(c, " ")
    w = [x for x in flat.split(" ") if x]
    lines = [x for x in t.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    windows = {}
    for i in range(len(w) - 7):
        windows.setdefault(tuple(w[i : i + 8]), []).append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)


def without_boilerplate(docs, min_docs=5, share=0.02):
    """{id: (share of its characters that is boilerplate, text without it)} for [(id, text, host)]; ids must differ."""
    norm = lambda x: x.strip(" \t\n\x0b\x0c\r").lower()
    held, size = {}, {}
    for i, t, h in docs:
        size.setdefault(h, set()).add(t)
        for x in (t or "").split("\n"):
            if norm(x):
                held.setdefault((h, norm(x)), []).append((i, t))
    bad = {}
    for (h, x), at in held.items():
        n = len({t for _, t in at})
        if n > min_docs and n > share * len(size[h]):
            bad[h, x] = min(i for i, _ in at)
    out = {}
    for i, t, h in docs:
        own = {norm(x) for x in (t or "").split("\n")} - {""}
        gone = {x for x in own if bad.get((h, x), i) != i}
        kept = [x for x in (t or "").split("\n") if norm(x) not in gone]
        out[i] = (sum(map(len, gone)) / max(1, sum(map(len, own))), "\n".join(kept))
    return out


def top_k(vectors, queries, k=10):
    ok = {i: [math.floor(1024 * Fraction(float(x))) for x in v] for i, v in vectors if v is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = {}
    for q in queries:
        if q in ok:
            scored = sorted((-sum(a * b for a, b in zip(ok[q], v)), i) for i, v in ok.items() if i != q)[:k]
            out[q] = [(i, -s) for s, i in scored]
    return out


def sha(b):
    return hashlib.sha256(b).hexdigest()


def planted(i, text):
    """Words of the text, periodic from some place on for one id in ten."""
    w = (text or "").encode().split()
    h, n = zlib.crc32(str(i).encode()), len(w)
    g = h // 10
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[k if k < a else a + (k - a) % p] for k in range(n)]


def runs(w, least=24, times=3):
    """(start, length, period) of the maximal runs, every period tried."""
    n, out = len(w), []
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            size = i - s + q
            if i > s and size >= max(least, times * q) and not any(w[s : s + size - p] == w[s + p : s + size] for p in range(1, q)):
                out.append((s, size, q))
            i = max(i, s + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, found):
    """The words, joined, without those behind the first period of a run."""
    return b" ".join(x for i, x in enumerate(w) if not any(s + q <= i < s + n for s, n, q in found))


def collocations(docs, min_n=2, max_n=3, least=10, top=2000):
    """[(lang, rank, phrase, a, l, r, n, score)] for [(lang, text)]."""
    f, total = {}, {}
    for lang, t in docs:
        lang = "und" if lang is None else lang
        b = (t or "").encode().lower()
        for c in b".,;:!?\n\x0b\x0c\r":
            b = b.replace(bytes([c]), b"\n")
        for piece in b.split(b"\n"):
            w = [x for x in piece.replace(b"\t", b" ").split(b" ") if x]
            total[lang] = total.get(lang, 0) + len(w)
            for i in range(len(w)):
                for k in range(1, min(max_n, len(w) - i) + 1):
                    f[lang, *w[i : i + k]] = f.get((lang, *w[i : i + k]), 0) + 1
    out = []
    for (lang, *w), a in f.items():
        if len(w) < min_n or a < least:
            continue
        score, k = min((1000000 * a * a // (f[lang, *w[:k]] * f[lang, *w[k:]]), k) for k in range(1, len(w)))
        longer = [x for (o, *v), x in f.items() if o == lang and len(v) > len(w) and x >= least and any(v[i : i + len(w)] == w for i in range(len(v) - len(w) + 1))]
        if not any(2 * x >= a for x in longer):
            out.append((lang, -score, -a, b" ".join(w), f[lang, *w[:k]], f[lang, *w[k:]], total[lang]))
    ranked, rank = [], {}
    for lang, s, a, phrase, l, r, n in sorted(out):
        rank[lang] = rank.get(lang, 0) + 1
        if rank[lang] <= top:
            ranked.append((lang, rank[lang], phrase.decode(), -a, l, r, n, -s))
    return ranked


def jaccard_groups(docs, width=3, part=9, whole=10):
    """[(number of shingles, smallest id of the component)] for [(id, text)]; sets without shingles are linked with nothing."""
    sets = []
    for _, t in docs:
        w = lower((t or "").encode()).split()
        sets.append(frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset())
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and whole * both >= part * (len(a) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        least.setdefault(find(i), []).append(d)
    ids = {g: [d for d in of if d is not None] for g, of in least.items()}
    return [(len(sets[i]), min(ids[find(i)], default=None)) for i in range(len(docs))]
