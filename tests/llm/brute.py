"""Plain-Python versions of the training-data operators, for small inputs."""

import hashlib
import re
from collections import Counter

LOWER = {c: c + 32 for c in range(65, 91)}


def groups(nodes, linked):
    """Smallest node of each node's component."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_duplicates(rows, span, percent=80):
    sets = {}
    for i, text in rows:
        words = (text or "").translate(LOWER).encode().split()
        runs = {tuple(words[j:j + span]) for j in range(max(1, len(words) - span + 1))} if words else set()
        sets[i] = runs
    ids = sorted(sets)
    linked = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1:] if sets[a] and sets[b]
              and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    root = groups(ids, linked)
    return {i: (len(sets[i]), root[i], root[i] == i) for i in ids}


def repeated_strings(rows, span=50):
    out, seen = {}, set()
    for i, text in sorted(rows):
        raw = (text or "").encode()
        own = {raw[s:s + span] for s in range(len(raw) - span + 1)}
        gone = bytearray(len(raw))
        for s in range(len(raw) - span + 1):
            if raw[s:s + span] in seen:
                gone[s:s + span] = b"\x01" * span
        seen |= own
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out[i] = (len(raw), sum(gone), sum(1 for x in bytes(gone).split(b"\x00") if x), hashlib.sha256(kept).hexdigest())
    return out


def quality(text):
    raw = (text or "").encode()
    words = [w for w in re.split(rb"[\x20\x09-\x0D]+", raw) if w]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    repeated = {p for i, w in enumerate(windows) if count[w] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in raw.split(b"\n") if x.strip()]
    chars = len(b"".join(words).decode())
    symbols = sum(chr(b) in "#*$%&|<>" for b in raw)
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return len(words), chars, symbols, len(lines) - len(set(lines)), len(repeated), failed


def contamination(docs, items):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    windows = {}
    for item, text in items:
        w = split(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(item)
    out = {}
    for doc, text in docs:
        w, hit, found = split(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])]
        names = ",".join(sorted(map(str, found)))
        out[doc] = (len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w))
    return out


def kept_lines(rows, span=5, percent=80):
    first = {}
    for i, text in sorted(rows):
        for at, line in enumerate((text or "").split("\n")):
            if line.strip(" \t\r\x0b\x0c"):
                first.setdefault(line, (i, at))
    sets = {place: {line[j:j + span] for j in range(max(1, len(line) - span + 1))} for line, place in first.items()}
    places = sorted(sets)
    linked = [(a, b) for n, a in enumerate(places) for b in places[n + 1:]
              if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    root = groups(places, linked)
    return {i: "\n".join(line for at, line in enumerate((text or "").split("\n"))
                         if not line.strip(" \t\r\x0b\x0c") or root[first[line]] == (i, at)) for i, text in rows}


def targets(sizes, weights=(5, 2, 1), cap=3):
    """Share the total by weight; sources above their cap are fixed at it and the rest is shared again."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    fixed = {}
    while True:
        left = sum(sizes.values()) - sum(fixed.values())
        free = [s for s in names if s not in fixed]
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if share[s] > cap * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: cap * sizes[s] for s in over}


def node(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(fields):
    return node(*["-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields])


def climbed(level, at, own):
    """(joined siblings, last node with ``own`` at ``at``, last node) of one tree of threes."""
    siblings, level = [], list(level)
    while len(level) > 1:
        start = at - at % 3
        left, right = level[start:at], level[at + 1:start + 3]
        siblings += left + right
        own = node(*left, own, *right)
        level, at = [node(*level[i:i + 3]) for i in range(0, len(level), 3)], at // 3
    return siblings, own, level[0]


def manifest(rows):
    """``rows``: (key, group, leaf, changed leaf). Returns sorted (key, leaf, subroot, root, proof, folded, verified)."""
    groups = {}
    for key, group, own, changed in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[2])):
        groups.setdefault(group, []).append((key, own, changed))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subroots = [climbed([m[1] for m in groups[g]], 0, groups[g][0][1])[2] for g in names]
    out = []
    for g, name in enumerate(names):
        leaves = [m[1] for m in groups[name]]
        for at, (key, own, changed) in enumerate(groups[name]):
            low, top, _ = climbed(leaves, at, changed)
            high, folded, root = climbed(subroots, g, top)
            out.append((key, own, subroots[g], root, node(*low, *high), folded, folded == root))
    return sorted(out, key=str)


STEPS = {("0", "s"): "S", ("0", "u"): "U", ("S", "u"): "U", ("U", "a"): "A", ("A", "u"): "U"}


def cheapest_edits(rows):
    """Least (cost, audit) for (initial, fault) rows, by relaxing one row after the other."""
    def relax(layer):
        while True:
            better = [(STEPS[p, i], (c + 5, a + "I")) for p, (c, a) in layer.items() for i in "ua" if (p, i) in STEPS]
            better = [(q, v) for q, v in better if q not in layer or v < layer[q]]
            if not better:
                return layer
            for q, v in better:
                layer[q] = min(v, layer.get(q, v))

    layer = relax({"0": (0, "")})
    for initial, fault in rows:
        steps = []
        for p, (c, a) in layer.items():
            steps.append((p, (c + 2, a + "D")))
            if fault not in ("blank", "duplicate"):
                extra = 5 * (fault == "truncated")
                steps += [(STEPS[p, initial], (c + extra, a + "K"))] if (p, initial) in STEPS else []
                steps += [(STEPS[p, i], (c + 1 + extra, a + "R")) for i in "ua" if (p, i) in STEPS]
        layer = relax({q: min(v for s, v in steps if s == q) for q in {s for s, _ in steps}})
    return min(layer[q] for q in "0A" if q in layer)


def repaired(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, sha256) of one conversation's rows (turn, role, text) in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        shown = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not shown else "duplicate" if (role, text) in seen else "" if shown[-1] in ".!?" else "truncated")
        seen.add((role, text))
    cost, audit = cheapest_edits([(role[:1], f) for (_, role, _), f in zip(rows, faults)])
    left, out = list(rows), []
    for edit in audit:
        role, text = left.pop(0)[1:] if edit != "I" else ("", "")
        wanted = "assistant" if out and out[-1][0][:1] == "u" else "user"
        if edit != "D":
            out.append((role if edit == "K" else wanted, text))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, digest
