"""Plain, quadratic or dictionary versions of the operators, for small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def substring_dedup(docs, window=50):
    words = [(i, WORD.findall(t or "")) for i, t in docs]
    owner = {}
    for i, ws in words:
        if i is not None:
            for s in range(len(ws) - window + 1):
                key = tuple(ws[s : s + window])
                owner[key] = min(owner.get(key, i), i)
    out = []
    for i, ws in words:
        gone = set()
        for s in range(len(ws) - window + 1):
            if i is not None and owner[tuple(ws[s : s + window])] < i:
                gone |= set(range(s, s + window))
        out.append((i, len(ws), len(gone), sha(" ".join(w for k, w in enumerate(ws) if k not in gone))))
    return out


def shingle_set(text, size=5):
    ws = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not ws:
        return frozenset()
    return frozenset(tuple(ws[i : i + size]) for i in range(max(1, len(ws) - size + 1)))


def ngram_components(docs):
    """(doc_id, n_shingles, component_id); docs are (doc_id, text) with distinct ids."""
    sets = [(i, shingle_set(t)) for i, t in docs]
    parent = {i: i for i, _ in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and min(len(a), len(b)) * 100 >= 80 * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= 80 * (len(a) + len(b) - both):
                    x, y = sorted((root(i), root(j)))
                    parent[y] = x
    return [(i, len(s), root(i)) for i, s in sets]


def periodic_runs(words, min_length=6, min_exponent=4):
    """Every maximal stretch of every period, kept if no smaller period fits it."""
    n, runs = len(words), []
    for q in range(1, n // min_exponent + 1):
        start = 0
        while start + q < n:
            end = start + q
            while end < n and words[end] == words[end - q]:
                end += 1
            stretch = words[start:end]
            smallest = next(p for p in range(1, len(stretch) + 1) if all(x == y for x, y in zip(stretch, stretch[p:])))
            if len(stretch) >= max(min_length, min_exponent * q) and smallest == q:
                runs.append((start, end - start, q))
            start = end - q + 1
    return sorted(runs)


def without_repeats(words, runs):
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def resampled(docs, target, min_words=20, percent=10):
    """(doc_id, n_features, weight, score, rank); docs are (doc_id, text)."""
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    place = lambda w: zlib.crc32(w.encode()) % 10000
    s, t = Counter(), Counter()
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            counts.update(map(place, split(text)))
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (n_s + 10000) / ((s[b] + 1) * (n_t + 10000))))
    out = []
    for i, text in docs:
        words = split(text)
        weight = sum(gain(place(w)) for w in words) // len(words) if words else 0
        h = int(sha(f"2024:{'' if i is None else i}")[:8], 16)
        out.append([i, len(words), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    long = [r for r in out if r[1] >= min_words]
    order = sorted(long, key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    rank = {id(r): k + 1 for k, r in enumerate(order[: percent * len(long) // 100])}
    return [(*r, rank.get(id(r))) for r in out]


def near_vectors(rows, threshold=0.9):
    """(vec_id, n_links, component_id, kept) by comparing all; ids are distinct, vectors one length."""
    usable = {i: v for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    length = {i: math.hypot(*v) for i, v in usable.items()}
    near = {i: [j for j, w in usable.items() if j != i and math.sumprod(v, w) / length[i] / length[j] >= threshold] for i, v in usable.items()}
    out = []
    for i, _ in rows:
        met, open_ids = {i}, [i]
        while open_ids:
            new = set(near.get(open_ids.pop(), [])) - met
            met |= new
            open_ids += new
        out.append((i, len(near.get(i, [])), min(met), min(met) == i))
    return out
