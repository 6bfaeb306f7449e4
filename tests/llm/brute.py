"""Plain Python versions of what the operators must return."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def quality_base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    covered = {j for i, w in enumerate(windows) if w in often for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n, rep = len(words), len(covered)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return n, sum(map(len, words)), symbols, dup, rep, n < 20 or 100 * rep > 30 * n


SECRET_RULES = [
    ("assign", re.compile(r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A), 1, 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 16),
]


def secret_base(text):
    spans = []
    for place, (kind, pattern, group, least) in enumerate(SECRET_RULES):
        for m in pattern.finditer(text or ""):
            if len(m.group(group)) >= least:
                spans.append((m.start(), place, f"{kind}:{m.start()}:{m.end()}"))
    joined = ",".join(s for _, _, s in sorted(spans))
    count = Counter(place for _, place, _ in spans)
    return count[0], count[1], count[2], hashlib.sha256(joined.encode()).hexdigest(), joined


def simhash(text):
    words = WORD.findall((text or "").translate(ASCII_LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(items, bits=4):
    """{position: smallest id reachable} for (id, fingerprint) items, over all pairs."""
    root = list(range(len(items)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(items)):
        for j in range(i):
            if (items[i][1] ^ items[j][1]).bit_count() <= bits:
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(items):
        if key is not None:
            r = find(i)
            least[r] = min(least.get(r, key), key)
    return [least.get(find(i)) for i in range(len(items))]


LICENSE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def license_base(text):
    words = LICENSE_WORD.findall((text or "").translate(ASCII_LOWER))
    starts, labels = [], set()
    for phrase, label in PHRASES.items():
        want = phrase.split()
        for i in range(len(words) - len(want) + 1):
            if words[i:i + len(want)] == want:
                starts.append(i)
                labels.add(label)
    return (
        len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))
    )
