"""Plain Python versions of the operators' results, for small inputs only."""

from __future__ import annotations

import hashlib
import re

import xxhash

SPACE = re.compile(r"[\x20\x09-\x0D]")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def ascii_lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def exact(docs: list[tuple]) -> dict:
    """doc_id -> (keep_id, group_size, kept, sha) for unique ids."""
    groups: dict[str, list] = {}
    for i, t in docs:
        groups.setdefault(sha(SPACE.sub("", t or "")), []).append((-len(t or ""), i))
    return {i: (min(g)[1], len(g), min(g)[1] == i, s) for s, g in groups.items() for _, i in g}


def secret_spans(text: str) -> str:
    out = []
    assign = r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    out += [(m.start(), 0, "assign", m.end()) for m in re.finditer(assign, text, re.I | re.A) if len(m[2]) >= 6]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(out))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def pii_spans(text: str) -> str:
    def digits(m):
        return re.sub("[^0-9]", "", m[0])

    out = [(0, m.start(), m.end(), "email")
           for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, m.start(), m.end(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(2, m.start(), m.end(), "card") for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
            if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [(3, m.start(), m.end(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 9 <= len(digits(m)) <= 15]
    return ",".join(f"{k}:{s}:{e}" for _, s, e, k in sorted(out))


def bench_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text or ""))


def contamination(docs: list[tuple], bench: list[tuple]) -> dict:
    """doc_id -> (n_words, n_hit, sorted item ids as strings)."""
    windows: dict[tuple, set] = {}
    for item, text in bench:
        w = bench_words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(item)
    out = {}
    for doc, text in docs:
        w, hit, items = bench_words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if found := windows.get(tuple(w[i:i + n])):
                    hit.update(range(i, i + n))
                    items |= found
        out[doc] = (len(w), len(hit), sorted(str(i) for i in items if i is not None))
    return out


def simhash(text: str | None) -> int:
    words = [w for w in SPACE.split(ascii_lower(text or "")) if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_components(prints: dict[int, int], distance: int = 2) -> dict[int, int]:
    """doc_id -> smallest doc_id reachable, by comparing all pairs."""
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if (prints[a] ^ prints[b]).bit_count() <= distance:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}
