"""Plain single-process versions that the operators are held against."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np

sha = lambda s: hashlib.sha256(s.encode()).hexdigest()

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d: str) -> bool:
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def base_spans(text: str | None) -> dict[str, list[tuple[int, int]]]:
    ok = {
        "email": lambda m: True,
        "ip": lambda m: all(int(p) <= 255 for p in m.split(".")),
        "card": lambda m: 13 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and luhn(d),
        "phone": lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15,
    }
    return {k: [m.span() for m in re.finditer(p, text or "") if ok[k](m[0])] for k, p in PATTERNS.items()}


def joined(spans: dict) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, found in spans.items() for a, b in found)


def components(nodes, links) -> dict:
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in parent}


def cosine_links(rows, cosine=0.98):
    """Row positions linked, for (id, vector or None, label or None) rows."""
    by = defaultdict(list)
    for i, (_, v, lab) in enumerate(rows):
        if v is None or lab is None or any(x is None for x in v):
            continue
        x = np.array(v, float)
        if np.isfinite(x).all() and x.any():
            by[lab, len(x)].append((i, x / np.linalg.norm(x)))
    for group in by.values():
        m = np.stack([x for _, x in group])
        for a, b in zip(*np.nonzero(np.triu(m @ m.T >= cosine, 1))):
            yield group[a][0], group[b][0]


def shingles(text: str) -> list[tuple]:
    """Occurrence-labelled five-word shingles in order."""
    w = text.split()
    if not w:
        return []
    k, seen, out = min(5, len(w)), defaultdict(int), []
    for i in range(len(w) - k + 1):
        s = tuple(w[i:i + k])
        out.append((s, seen[s]))
        seen[s] += 1
    return out


def alignment(a: list, b: list) -> float:
    """m / (n1 + n2 - m) for the longest common subsequence of m."""
    last = [0] * (len(b) + 1)
    for x in a:
        now = [0]
        for j, y in enumerate(b):
            now.append(last[j] + 1 if x == y else max(last[j + 1], now[j]))
        last = now
    return last[-1] / (len(a) + len(b) - last[-1]) if a and b else 0.0


def host_path(url: str | None) -> tuple[str, str]:
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3:]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def best_rule(host: str, path: str, rules):
    fits = []
    for action, rule in rules:
        h, p = rule[:rule.index("/")], rule[rule.index("/"):]
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            fits.append((-len(rule), rule, action))
    return min(fits)[1:] if fits else (None, None)


def quality_counts(text: str | None):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = defaultdict(list)
    for i in range(len(words) - 7):
        grams[tuple(words[i:i + 8])].append(i)
    covered = {j for at in grams.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def held_out(doc_id) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 3 == 1
