"""Plain Python versions of what the operators return."""

import hashlib
import re

WORD = re.compile("[^\x20\x09-\x0D]+")
FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text, width):
    words = WORD.findall((text or "").translate(FOLD))
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1))


def components(docs, width, percent):
    """doc_id -> smallest reachable doc_id, comparing all pairs."""
    sets = {d: shingles(t, width) for d, t in docs}
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return {d: (len(sets[d]), root(d), root(d) == d) for d in sets}


def passages(rows, width):
    first = {}
    for doc_id, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        words = WORD.findall(text or "")
        for i in range(len(words) - width + 1):
            first.setdefault(tuple(words[i:i + width]), doc_id)
    out = []
    for doc_id, text in rows:
        words = WORD.findall(text or "")
        gone = set()
        if doc_id is not None:
            for i in range(len(words) - width + 1):
                if first[tuple(words[i:i + width])] < doc_id:
                    gone.update(range(i, i + width))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc_id, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def base_spans(text):
    def ok(kind, value):
        digits = re.sub("[^0-9]", "", value)
        if kind == "ip":
            return all(int(p) <= 255 for p in value.split("."))
        if kind == "card":
            return 16 <= len(digits) <= 19 and luhn(digits)
        return kind == "email" or 8 <= len(digits) <= 15

    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if ok(k, m[0]))


def rule_counts(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dups, places = set(), 0, {}
    for line in text.split("\n"):
        if WORD.search(line):
            dups += line in seen
            seen.add(line)
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {j for v in places.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(covered), failed
