"""Plain Python scoring, for small fixtures only."""

import math
from collections import Counter


def grams(norm, analyzer):
    words = norm.split()
    if analyzer == "word":
        return words
    if analyzer == "word12":
        return words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    out = []
    for w in words:
        w = f" {w} "
        out += [w[i:i + n] for n in (3, 4, 5) for i in range(len(w) - n + 1)]
    return out


def scores(docs, queries, analyzer, weighting):
    tfs = {d: Counter(grams(t, analyzer)) for d, t in docs.items()}
    df = Counter(t for c in tfs.values() for t in c)
    n = len(docs)
    out = {}
    if weighting == "tfidf":
        idf = {t: math.log((1 + n) / (1 + f)) + 1 for t, f in df.items()}

        def vec(c):
            v = {t: k * idf[t] for t, k in c.items() if t in idf}
            size = math.sqrt(sum(x * x for x in v.values())) or 1.0
            return {t: x / size for t, x in v.items()}
        dv = {d: vec(c) for d, c in tfs.items()}
        for q, text in queries.items():
            qv = vec(Counter(grams(text, analyzer)))
            out[q] = {d: sum(x * v.get(t, 0.0) for t, x in qv.items()) for d, v in dv.items()}
        return out
    raw = {t: math.log(n - f + 0.5) - math.log(f + 0.5) for t, f in df.items()}
    floor = 0.25 * sum(raw.values()) / len(raw)
    idf = {t: floor if r < 0 else r for t, r in raw.items()}
    mean = sum(sum(c.values()) for c in tfs.values()) / n
    for q, text in queries.items():
        out[q] = {d: sum(idf.get(t, 0) * c[t] * 2.5 / (c[t] + 1.5 * (0.25 + 0.75 * sum(c.values()) / mean))
                         for t in grams(text, analyzer)) for d, c in tfs.items()}
    return out


def top(scored, k, pad=True):
    out = {}
    for q, s in scored.items():
        rows = sorted(((-round(v, 9), d) for d, v in s.items()))
        out[q] = [(d, -v) for v, d in rows][:k]
    return out
