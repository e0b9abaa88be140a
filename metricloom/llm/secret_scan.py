"""Secret scans: fixed patterns, and a guess-cost model on values in credential context."""

from __future__ import annotations

import bisect
import hashlib
import itertools
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from metricloom.llm.common import small_batches

ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
#: A run below the least length fails as a whole, so the length can stand in the pattern.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Wider credential context whose values only count when they are costly to guess. The short
#: words also end others (spin, compass), so they begin a word or a capitalised part of one.
CONTEXT = re.compile(
    r"(?:passphrase|password|passwd|pwd|secret|token|credentials?|bearer"
    r"|(?:api|private|client|access)_?key"
    r"|(?-i:(?<![A-Za-z])|(?<=[a-z])(?=[AOP][a-z]))(?:pass|pin|o?auth))"
    r"[\"']?(?:\x20*[:=]\x20*|\x20+is\x20+)[\"']?(?=[^\s\"'<>]{6})",
    re.IGNORECASE | re.ASCII,
)
VALUE = re.compile(r"[^\s\"'<>]*", re.ASCII)
KINDS = ("assign", "access", "hex", "guess")

#: Guesses (as a power of ten) from which a value is held to be a secret.
MIN_GUESS_POWER = 8.0

#: Fixed words of common passwords and of credential texts, most frequent first.
WORDS = (
    "password", "123456", "qwerty", "admin", "welcome", "letmein", "monkey", "dragon", "login",
    "master", "secret", "token", "hello", "test", "user", "root", "pass", "guest", "default",
    "changeme", "example", "sample", "demo", "none", "null", "true", "false", "your", "here",
    "key", "api", "access", "private", "public", "server", "local", "host", "home", "summer",
    "winter", "spring", "autumn", "love", "baby", "star", "sun", "moon", "blue", "red", "green",
    "black", "white", "king", "queen", "super", "the", "and", "for", "with", "one", "two",
)
_RANK = {word: rank for rank, word in enumerate(WORDS, 1)}
_LONGEST = max(map(len, WORDS))
_ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
_NEXT = {(a, b) for row in _ROWS for a, b in zip(row, row[1:], strict=False)}
_NEXT |= {(b, a) for a, b in _NEXT}
_LEET = str.maketrans("013457@$!", "oieastasi")
_DATE = re.compile(
    r"(?:19|20)\d\d[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:0[1-9]|[12]\d|3[01])"
    r"|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)\d\d|(?:19|20)\d\d"
)
_SEGMENT = 0.3  # power of ten that each further segment adds: the guesser must find the cuts


def _char_cost(c: str) -> float:
    if c.isdigit():
        return 1.0
    if c.isascii() and c.isalpha():
        return math.log10(26)
    return math.log10(33) if c.isascii() else 2.0


def guess_power(value: str) -> float:
    """Power of ten of the guesses that the cheapest segmentation of ``value`` needs.

    Dynamic programming over positions: a segment is a common word (with swapped case or
    look-alike digits), a date, a repeated character, a keyboard walk, an alphabet
    sequence, or one character tried by brute force. Work is linear in the length.
    """
    n, low = len(value), value.lower()
    plain = low.translate(_LEET)
    if len(low) != n:  # letters whose lower case is longer
        low = plain = value
    best = [0.0] + [math.inf] * n

    def offer(i: int, j: int, cost: float) -> None:
        best[j] = min(best[j], best[i] + cost)

    repeat = walk = climb = 0
    starts = [[], [], []]  # of each kind of run: where its segments may yet begin
    for i in range(n):  # runs ending at i
        joined = low[i - 1 : i + 1]
        repeat = repeat + 1 if i and low[i] == low[i - 1] else 1
        walk = walk + 1 if i and (joined[0], joined[1]) in _NEXT else 1
        step = ord(low[i]) - ord(low[i - 1]) if i else 0
        climb = climb + 1 if abs(step) == 1 and joined.isalnum() else 1
        offer(i, i + 1, _char_cost(value[i]))
        for kind, run in enumerate((repeat, walk, climb)):
            if run == 1:
                starts[kind] = []
            if run >= 3:
                # A start that an earlier one matches stays behind it: log10 grows ever slower.
                start, kept, least = i - 2, [], math.inf
                own = best[start] + _char_cost(value[start]) + 0.3 + _SEGMENT * (start > 0)
                for at, cost in (*starts[kind], (start, own)):
                    if cost + math.log10(i + 1 - at) < least:
                        least = cost + math.log10(i + 1 - at)
                        kept.append((at, cost))
                starts[kind] = kept
                best[i + 1] = min(best[i + 1], least)
        for length in range(3, min(i + 1, _LONGEST) + 1):
            start = i + 1 - length
            for form, more in ((low, 0.0), (plain, 0.6)):
                rank = _RANK.get(form[start : i + 1])
                if rank:
                    case = 0.0 if value[start : i + 1] == low[start : i + 1] else 0.5
                    offer(start, i + 1, math.log10(rank + 1) + more + case + _SEGMENT * (start > 0))
        for length in (4, 8, 10):
            start = i + 1 - length
            if start >= 0 and _DATE.fullmatch(value, start, i + 1):
                offer(start, i + 1, (2.1 if length == 4 else 4.5) + _SEGMENT * (start > 0))
    return best[n]


def find_secrets(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]], int]:
    """Base spans and added spans as (start, kind, end), and how many base values are weak."""
    base, added, weak = [], [], 0
    for m in ASSIGN.finditer(text):
        if m.end(2) - m.start(2) >= 6:
            base.append((m.start(), 0, m.end()))
            weak += guess_power(m.group(2)) < MIN_GUESS_POWER
    if "AKIA" in text:
        base += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    base += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    base.sort()
    if ":" in text or "=" in text or " is " in text.lower():
        ends = list(itertools.accumulate((e for _, _, e in base), max))
        m = CONTEXT.search(text)
        while m:
            start = at = m.end()
            i = bisect.bisect_right(ends, start)  # the first base span that ends later
            if i < len(base) and base[i][0] <= start:
                at = ends[i]
            else:
                end = VALUE.match(text, start, base[i][0] if i < len(base) else len(text)).end()
                size = len(text[start:end].rstrip(".,;:)]}"))
                if size >= 6 and guess_power(text[start : start + size]) >= MIN_GUESS_POWER:
                    added.append((start, 3, start + size))
                    at = end
            m = CONTEXT.search(text, at)
    return base, added, weak


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


OUTPUT = [
    T.StructField("n_assign", T.LongType()), T.StructField("n_access", T.LongType()),
    T.StructField("n_hex", T.LongType()), T.StructField("base_sha256", T.StringType()),
    T.StructField("spans", T.StringType()), T.StructField("n_weak", T.LongType()),
]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.name for f in OUTPUT]
    for batch in batches:
        rows = []
        for text in batch.column(batch.num_columns - 1).to_pylist():
            base, added, weak = find_secrets(text or "")
            count = [sum(k == kind for _, k, _ in base) for kind in range(3)]
            digest = hashlib.sha256(joined(base).encode()).hexdigest()
            rows.append((*count, digest, joined(base + added), weak))
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        own = batch.columns[:-1]
        yield pa.RecordBatch.from_arrays([*own, *arrays], [*batch.schema.names[:-1], *names])


def scan_secrets(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` of each row with the spans found in its whole text.

    Missing and empty texts have no spans. Rows are independent: repeated rows give
    repeated results, an empty table an empty one. A map over rows, without a shuffle.
    """
    small_batches(docs)
    chosen = docs.select(*keys, docs[text].alias("__body"))
    schema = T.StructType([*chosen.drop("__body").schema.fields, *OUTPUT])
    return chosen.mapInArrow(_scan, schema)
