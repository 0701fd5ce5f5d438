"""Plain versions of what the operators compute, one row or pair at a time."""

import hashlib
import re
from collections import defaultdict

import xxhash

BLANKS = " \t\n\x0b\x0c\r"


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def kept_lines(rows, least=10):
    """(id, text) rows -> the texts that stay, in the same order."""
    docs_of = defaultdict(set)
    for i, t in rows:
        if i is not None:
            for line in (t or "").split("\n"):
                docs_of[lower(line.strip(BLANKS))].add(i)

    def stays(i, line):
        key = lower(line.strip(BLANKS))
        owners = docs_of.get(key, ())
        return i is None or len(key) < least or len(owners) < 2 or min(owners) == i

    return [None if t is None else "\n".join(x for x in t.split("\n") if stays(i, x)) for i, t in rows]


def fingerprint(text, n=4):
    words = [w for w in re.split("[\x20\x09-\x0d]+", lower(text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, limit=4):
    """id -> fingerprint  to  id -> smallest id reachable."""
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= limit:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


KINDS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in KINDS:
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m.group().split(".") if kind == "ip"),
                "card": 13 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def masked(text, spans):
    """Spans that overlap count as one, of the first one's kind."""
    merged = []
    for kind, start, end in sorted(spans, key=lambda s: (s[1], [k for k, _ in KINDS].index(s[0]))):
        if merged and start < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], end)
        else:
            merged.append([kind, start, end])
    out, at = "", 0
    for kind, start, end in merged:
        out, at = out + text[at:start] + f"[{kind}]", end
    return out + text[at:]
