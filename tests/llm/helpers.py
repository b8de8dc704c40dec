"""Plain-Python versions of what the operators compute."""

import hashlib
import re
from collections import Counter

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def spaced(t):
    return re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))


def alnum(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))


def components(edges, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_groups(docs, k=4):
    sets = {}
    for i, t in docs.items():
        w = spaced(t)
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    return sets, components(links, sets)


def hits(docs, items, window=10):
    found = {}
    windows = {}
    for i, t in items:
        w = alnum(t)
        k = min(window, len(w))
        for j in range(len(w) - k + 1 if k else 0):
            windows.setdefault(tuple(w[j : j + k]), set()).add(i)
    for d, t in docs.items():
        w, words, ids = alnum(t), set(), set()
        for k in {len(x) for x in windows}:
            for j in range(len(w) - k + 1):
                if m := windows.get(tuple(w[j : j + k])):
                    words.update(range(j, j + k))
                    ids |= m
        found[d] = (len(w), len(words), len(ids - {None}), sha(",".join(sorted(str(x) for x in ids if x is not None))))
    return found


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def digits(s):
    return re.sub("[^0-9]", "", s)


PII = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m[0])) <= 15),
]
SECRETS = [
    ("assign", r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[1]) >= 8),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16),
    ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 32),
]


def spans(text, kinds):
    return [(n, s, e) for s, _, e, n in sorted((m.start(), k, m.end(), n) for k, (n, p, ok) in enumerate(kinds) for m in re.finditer(p, text or "") if ok(m))]


def written(found):
    return ",".join(f"{n}:{s}:{e}" for n, s, e in found)


def counts(found):
    return Counter(n for n, _, _ in found)
