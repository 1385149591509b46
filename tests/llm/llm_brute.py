"""Plain Python versions of the training-data operators, for small inputs."""

import collections
import hashlib
import math
import re
import zlib

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    low = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    return WORD.findall(low)


def shingles(text, size=5):
    w = words(text)
    return [tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))] if w else []


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def secrets(text, m):
    """(n_assign, n_access, n_hex, base_sha256, spans, n_entropy); ``m`` is the module with the patterns."""
    t = text or ""
    base = [(x.start(), 0, "assign", x.end()) for x in re.finditer(m.ASSIGN, t) if len(x[2]) >= 6]
    base += [(x.start(), 1, "access", x.end()) for x in re.finditer("AKIA[A-Z0-9]+", t) if len(x[0]) >= 20]
    base += [(x.start(), 2, "hex", x.end()) for x in re.finditer("[0-9a-f]+", t) if len(x[0]) >= 24]
    more, rest = [], t
    for word in m.SAMPLES:
        rest = re.sub(word, " " * len(word), rest, flags=re.IGNORECASE | re.ASCII)
    for rank, (kind, chars, least) in enumerate(m.ENTROPY):
        for x in re.finditer(f"[{chars}]{{{m.WINDOW},}}", rest):
            if any(re.search(a, x[0]) for a in m.ALLOWED):
                continue
            spans = []
            for i in range(len(x[0]) - m.WINDOW + 1):
                n = collections.Counter(x[0][i:i + m.WINDOW]).values()
                if -sum(v / m.WINDOW * math.log2(v / m.WINDOW) for v in n) >= least - 1e-9:
                    if spans and spans[-1][1] >= i:
                        spans[-1][1] = i + m.WINDOW
                    else:
                        spans.append([i, i + m.WINDOW])
            more += [(x.start() + a, 3 + rank, kind, x.start() + b) for a, b in spans]

    def said(spans):
        return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(spans))

    return (*(sum(s[1] == k for s in base) for k in range(3)), sha(said(base)), said(base + more), len(more))


def components(docs, size=5, percent=80):
    """id -> (set size, smallest reachable id)."""
    sets = {i: frozenset(shingles(t, size)) for i, t in docs}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where, both = collections.defaultdict(list), collections.Counter()
    for i, s in sets.items():
        for k in s:
            where[k].append(i)
    for v in where.values():
        for a in range(len(v)):
            for b in range(a + 1, len(v)):
                both[v[a], v[b]] += 1
    for (a, b), o in both.items():
        if 100 * o >= percent * (len(sets[a]) + len(sets[b]) - o):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def contamination(docs, items, size=5, percent=80):
    """(doc_id, item_id) -> (similarity, first word) of the best window."""
    grams = [(i, shingles(t, size)) for i, t in items if len(words(t)) >= size]
    short = [(i, words(t)) for i, t in items if 0 < len(words(t)) < size]
    out = {}
    for d, t in docs:
        own, said = shingles(t, size), words(t)
        for i, w in short:                      # fewer words than a shingle: found as they stand
            at = [k for k in range(len(said) - len(w) + 1) if said[k:k + len(w)] == w]
            if at:
                out[d, i] = 1.0, at[0]
        have = set(own)
        for i, g in grams:
            if not have & set(g):
                continue
            n, want, best = min(len(g), len(own)), collections.Counter(g), None
            for at in range(len(own) - n + 1):
                shared = sum((collections.Counter(own[at:at + n]) & want).values())
                total = n + len(g) - shared
                if 100 * shared >= percent * total and (best is None or shared / total > best[0]):
                    best = shared / total, at
            if best:
                out[d, i] = best
    return out


def repeats(docs, length=200):
    """id -> (bytes, removed, runs, sha256 of the rest)."""
    seen = collections.Counter(b[k:k + length] for _, t in docs for b in [(t or "").encode()]
                               for k in range(len(b) - length + 1))
    out = {}
    for i, t in docs:
        b, runs = (t or "").encode(), []
        for k in range(len(b) - length + 1):
            if seen[b[k:k + length]] > 1:
                if runs and k <= runs[-1][1]:
                    runs[-1][1] = k + length
                else:
                    runs.append([k, k + length])
        kept, at = b"", 0
        for lo, hi in runs:
            kept, at = kept + b[at:lo], hi
        kept += b[at:]
        out[i] = len(b), len(b) - len(kept), len(runs), sha(kept)
    return out


def line_runs(docs, window):
    """id -> (lines, removed, runs, kept text); earlier means smaller (id, line)."""
    first = {}
    cut = {i: (t or "").split("\n") for i, t in docs}
    for i in sorted(cut):
        for k in range(len(cut[i]) - window + 1):
            first.setdefault(tuple(cut[i][k:k + window]), (i, k))
    out = {}
    for i, lines in cut.items():
        gone = [False] * len(lines)
        for k in range(len(lines) - window + 1):
            if first[tuple(lines[k:k + window])] != (i, k):
                gone[k:k + window] = [True] * window
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out[i] = len(lines), sum(gone), runs, "\n".join(x for x, g in zip(lines, gone, strict=True) if not g)
    return out


def line_passages(docs, window, words):
    """As line_runs; a run of fewer lines than ``window`` counts when it holds ``words`` words."""
    cut, seen = {i: (t or "").split("\n") for i, t in docs}, set()
    gone = {i: set() for i in cut}
    for i in sorted(cut):
        for k in range(len(cut[i])):
            for n in range(1, min(window, len(cut[i]) - k) + 1):
                run = tuple(cut[i][k:k + n])
                if n == window or len(re.findall(r"[^ \t\n\v\f\r]+", "\n".join(run))) >= words:
                    if run in seen:
                        gone[i].update(range(k, k + n))
                    seen.add(run)
    return {i: (len(x), len(gone[i]), sum(k - 1 not in gone[i] for k in gone[i]),
                "\n".join(y for k, y in enumerate(x) if k not in gone[i])) for i, x in cut.items()}


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n
