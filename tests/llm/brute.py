"""Plain versions of the operators for small fixtures."""

import hashlib
import re

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def shingles(text):
    w = words((text or "").translate(LOW))
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def components(docs, percent):
    """docs: id -> text; id -> smallest id reachable."""
    sets = {i: shingles(t) for i, t in docs.items()}
    root = {i: i for i in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in docs:
        for b in docs:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * len(sets[a] | sets[b]):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: find(i) for i in docs}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(x):
    return re.sub("[^0-9]", "", x)


PERSONAL = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(x) <= 255 for x in v.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda v: 16 <= len(_digits(v)) <= 19 and luhn(_digits(v))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 8 <= len(_digits(v)) <= 15),
]


def personal(text):
    found, counts = [], []
    for kind, pattern, good in PERSONAL:
        hits = [m for m in re.finditer(pattern, text or "") if good(m.group())]
        counts.append(len(hits))
        found += [f"{kind}:{m.start()}:{m.end()}" for m in hits]
    return (*counts, hashlib.sha256(",".join(found).encode()).hexdigest())


def secret(text):
    text, found = text or "", []
    plain = [
        r"(?ai)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        r"AKIA[A-Z0-9]+",
        r"[0-9a-f]+",
    ]
    for k, (pattern, least) in enumerate(zip(plain, (6, 20, 24), strict=True)):
        for m in re.finditer(pattern, text):
            if len(m.group(2) if k == 0 else m.group()) >= least:
                found.append((m.start(), k, m.end()))
    found.sort()
    line = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in found)
    return (*(sum(k == j for _, k, _ in found) for j in range(3)), hashlib.sha256(line.encode()).hexdigest())


def quality(text):
    text = text or ""
    w = words(text)
    seen, repeated = {}, set()
    for i in range(len(w) - 2):
        seen.setdefault(tuple(w[i : i + 3]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            repeated |= {p + k for p in places for k in range(3)}
    lines = [x for x in text.split("\n") if words(x)]
    return (
        len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)), len(repeated),
    )


def drop_lines(docs, near=8):
    """docs: list of (id, text), ids distinct; id -> kept text."""

    def within(a, b):
        if a == b:
            return True
        if max(len(a), len(b)) < near or min(len(a), len(b)) < near or abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
        short, long = sorted((a, b), key=len)
        return any(long[:k] + long[k + 1 :] == short for k in range(len(long)))

    lines = [
        (i is None, i or 0, k, words(line.translate(LOW)))
        for i, text in docs for k, line in enumerate((text or "").split("\n"))
    ]
    lines.sort(key=lambda x: x[:3])
    gone = set()
    for at, (none, i, k, w) in enumerate(lines):
        if w and any(v and within(v, w) for _, _, _, v in lines[:at]):
            gone.add((none, i, k))
    out = {}
    for i, text in docs:
        keep = [x for k, x in enumerate((text or "").split("\n")) if (i is None, i or 0, k) not in gone]
        out[i] = None if text is None else "\n".join(keep)
    return out
