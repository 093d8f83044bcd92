"""The same definitions, spelt out in plain Python."""

import re
from collections import Counter, defaultdict

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

SECRETS = [
    (r"(?a:(?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 1, 12),
    (r"AKIA[A-Z0-9]+", 0, 18),
    (r"[0-9a-f]+", 0, 16),
    (r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    (r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
    (r"AIza[0-9A-Za-z_-]{35}", 0, 1),
    (r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", 0, 1),
    (r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----", 0, 1),
]


def secret_spans(text):
    found = []
    for order, (pattern, group, least) in enumerate(SECRETS):
        found += [(m.start(), order, m.end()) for m in re.finditer(pattern, text) if len(m.group(group)) >= least]
    return [(a, b) for a, _, b in sorted(found)]


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_LOWER))
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def components(texts, size, num, den):
    """The smallest id of each text's group, from all pairs that share a shingle."""
    sets = {i: shingles(t, size) for i, t in texts.items()}
    holders = defaultdict(list)
    for i in sorted(sets):
        for s in sets[i]:
            holders[s].append(i)
    common = Counter((a, b) for ids in holders.values() for k, b in enumerate(ids) for a in ids[:k])
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (a, b), n in common.items():
        if den * n >= num * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}
