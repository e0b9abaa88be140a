"""Spelling variants, alignments and license scans against plain versions, with odd rows."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from metricloom.llm import alignment, license_rules, licenses, queries, spelling
from tests.llm.brute import LOW

LEFT, RIGHT = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def frame(spark, data, kinds="doc_id long, text string, kept string"):
    return spark.createDataFrame([(i, t, "x") for i, t in data], kinds).repartition(3)


# --- spelling variants -------------------------------------------------------------------


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants(counts):
    out = {}
    for w, n in counts.items():
        near = [v for v in counts if one_apart(w, v)]
        best = min(near, key=lambda v: (-counts[v], v.encode()), default=None)
        form = best if best is not None and counts[best] >= 2 * n else None
        out[w] = (form, n, len(near), counts[form] if form else None)
    for w, (form, *rest) in list(out.items()):
        root = w
        while out[root][0]:
            root = out[root][0]
        out[w] = (form, root, *rest)
    return out


def plain_words(docs, planted=True):
    seen = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", (text or "").translate(LOW)):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if planted and h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                seen[run] += 1
    return {w: n for w, n in seen.items() if n >= 3}


def words_of(seed, letters, n=700):
    rng = random.Random(seed)
    bases = ["".join(rng.choices(letters, k=rng.randint(4, 11))) for _ in range(40)]
    out = {}
    for _ in range(n):
        w = list(rng.choice(bases))
        for _ in range(rng.choice((0, 1, 1, 2))):
            at = rng.randrange(len(w) + 1)
            w[at : at + rng.randint(0, 1)] = rng.choices(letters, k=rng.randint(0, 2))
        if len(w) >= 5:
            out["".join(w)] = rng.randint(3, 60)
    return out


@pytest.mark.parametrize("letters", ["ab", "abcde", "abcdefghijklmnopqrstuvwxyzéß"])
def test_variants(spark, letters):
    counts = words_of(len(letters), letters)
    counts |= {letters[0] * k: 5 * k for k in (5, 6, 7, 8, 40, 41)}  # one gram, many times
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    got = {r.word: tuple(r)[1:] for r in spelling.group_variants(words).collect()}
    assert got == variants(counts)
    assert sum(1 for x in got.values() if x[3]) > 100


@pytest.mark.parametrize("letters", ["ab", "abc"])
def test_pivots_meet(letters):
    """Each pair one edit apart shares a filed text between the pivots of one and the grams of the other."""
    words = ["".join(x) for k in (4, 5, 6, 7) for x in itertools.product(letters, repeat=k)]
    words = random.Random(1).sample(words, 180 if len(letters) > 2 else len(words) // 2)
    grams = Counter(g for w in words for g in {w[i : i + 2] for i in range(len(w) - 1)})
    order = {g: (rank, n) for rank, (n, g) in enumerate(sorted((n, g) for g, n in grams.items()))}
    filed = {}
    for w in words:
        last, pivots, searched = spelling.prefix_of(w, order)
        n = len(w)
        assert len(pivots) == 2 and abs(pivots[0] - pivots[1]) >= 2 and set(pivots) <= set(searched)
        filed[w] = (
            last, set(spelling._sides(w, pivots, (n,), 0)),
            set(spelling._sides(w, searched, (n - 1, n, n + 1), 1)),
        )
    for a, b in itertools.combinations(words, 2):
        if one_apart(a, b):
            (x, mine, all_a), (y, theirs, all_b) = filed[a], filed[b]
            assert (x <= y and mine & all_b) or (y <= x and theirs & all_a)


def test_pivot_choice():
    assert spelling.choose_pivots([(0, 5), (1, 1), (3, 2)]) == [1, 3]
    assert spelling.choose_pivots([(0, 5), (1, 1), (2, 2)]) == [0, 2]
    assert spelling.choose_pivots([(0, 1), (4, 1), (9, 1)]) == [0, 4]


def test_planted_deletions(spark):
    rng = random.Random(2)
    pool = ["".join(rng.choices("abcdeÀÉäöß", k=rng.randint(3, 9))) for _ in range(60)]
    docs = [(i, " ".join(rng.choices(pool, k=80)).upper() if i % 2 else "1".join(rng.choices(pool, k=80))) for i in range(60)]
    docs += [(None, "Wörter ohne Kennung " * 4), (900, None), (901, ""), (902, "\n\t 12 "), (903, "a" * 50_000 + " " + "langes " * 9_000)]
    docs += [(904, "gleich gleich gleich")] * 2
    got = spelling.word_counts(frame(spark, docs, "doc_id long, text string, word string"), queries.planted_deletions)
    assert {r.word: r.n for r in got.collect()} == plain_words(docs)
    plain = spelling.word_counts(frame(spark, docs))
    assert {r.word: r.n for r in plain.collect()} == plain_words(docs, planted=False)


def test_no_words(spark):
    for rows in ([], [(1, "abcde " * 3)]):
        words = spelling.word_counts(frame(spark, rows))
        got = spelling.group_variants(words).collect()
        assert [tuple(r) for r in got] == ([("abcde", None, "abcde", 3, 0, None)] if rows else [])
    with pytest.raises(ValueError, match="more frequent"):
        spelling.group_variants(words, ratio=1)


def test_variants_in_texts(spark):
    docs = frame(spark, [(1, "The colour color of colour"), (2, None), (3, "nothing")], "doc_id long, text string, words string")
    groups = spark.createDataFrame([("color", "colour"), ("colour", "colour")], "word string, root string")
    got = {r.doc_id: r.words_ for r in spelling.with_forms(docs, groups).collect()}
    assert [tuple(x) for x in got[1]] == [(2, "color", "colour")]
    assert got[2] is None and got[3] is None


# --- alignment ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def sides():
    import sentencepiece
    from tokenizers import Tokenizer

    left = Tokenizer.from_file(LEFT)
    left.encode_special_tokens = True
    return left, sentencepiece.SentencePieceProcessor(model_file=RIGHT), alignment._byte_characters()


def aligned_plainly(text, sides):
    """(ids, ends) of both sides, or nothing."""
    left, right, alphabet = sides
    if not text:
        return ([], []), ([], [])
    made = left.encode(" " + text, add_special_tokens=False)
    a = [bytes(alphabet[c] for c in left.id_to_token(i)) for i in made.ids]
    pieces = right.encode(text)
    b = [
        bytes([int(right.id_to_piece(i)[3:5], 16)]) if right.is_byte(i) else right.id_to_piece(i).replace("▁", " ").encode()
        for i in pieces
    ]
    body = (" " + text).encode()
    if b"".join(a) != body or b"".join(b) != body:
        return ([], []), ([], [])
    return tuple((ids, list(itertools.accumulate(map(len, parts)))) for ids, parts in ((made.ids, a), (pieces, b)))


TEXTS = [
    "plain words here", "Ünïcödé wörds — 東京 🙂🙂 naïve", "tabs\tand\nnew\n\nlines  and   spaces ", " leading", "<|endoftext|> <s> </s> <unk>",
    "▁mark", "x" * 3_000, "123456789 3.14159 don't we'll", "\u0000\u0001", "á ﬁ ½ ²", "", None, "word " * 2_000, "é", " ", "\r\n",
]


def test_alignment(spark, sides):
    rng = random.Random(4)
    docs = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (50, "twice"), (50, "twice")]
    docs += [(100 + i, " ".join(rng.choices(TEXTS[0].split() + TEXTS[1].split() + ["thtion", "ß", "..."], k=60))) for i in range(40)]
    links, per = Counter(), []
    for i, text in docs:
        (a, ends_a), (b, ends_b) = aligned_plainly(text, sides)
        ends = sorted(set(ends_a) & set(ends_b))
        mine = [(x, y) for x, p in zip(a, ends_a, strict=True) for y, q in zip(b, ends_b, strict=True) if p == q] if len(a) < 500 else [
            (a[ends_a.index(e)], b[ends_b.index(e)]) for e in ends]
        groups, last = [], 0
        for e in ends:
            side = [",".join(str(x) for x, p in zip(ids, at, strict=True) if last < p <= e) for ids, at in ((a, ends_a), (b, ends_b))]
            groups.append("|".join(side))
            last = e
        links.update(mine)
        per.append((i, len(a), len(b), len(ends), mine, ";".join(groups)))
    highest = {}
    for (x, y), n in links.items():
        highest[y] = max(highest.get(y, 0), n)
    want = sorted(
        (repr(i), a, b, g, len(m), sum(links[x] == highest[x[1]] for x in m), sum(links[x] for x in m),
         hashlib.sha256(t.encode()).hexdigest() if t else "")
        for i, a, b, g, m, t in per
    )
    rows = frame(spark, docs, "doc_id long, text string, groups string")
    made = alignment.align(rows, LEFT, RIGHT)
    made = made.withColumn("groups", F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)))
    got = alignment.score_links(made).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
    assert sorted((repr(r.doc_id), *tuple(r)[1:]) for r in got.collect()) == want
    assert sum(x[4] for x in want) > 2_000


def test_overlapping_tokens(spark, sides):
    docs = [(i, t) for i, t in enumerate(TEXTS) if t is None or len(t) < 200]
    got = {}
    for r in alignment.overlaps(frame(spark, docs), LEFT, RIGHT).collect():
        got.setdefault(r.doc_id, set()).add((r.a_at, r.a_id, r.a_start, r.a_end, r.b_at, r.b_id, r.b_start, r.b_end))
    for i, text in docs:
        (a, ends_a), (b, ends_b) = aligned_plainly(text, sides)
        want = {
            (k, x, s, e, m, y, t, f)
            for k, (x, s, e) in enumerate(zip(a, [0, *ends_a], ends_a, strict=False))
            for m, (y, t, f) in enumerate(zip(b, [0, *ends_b], ends_b, strict=False))
            if s < f and t < e
        }
        assert got.get(i, set()) == want


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(max_codepoint=0x24F), max_size=60))
def test_quick_ids_are_the_librarys(text):
    import functools

    from tokenizers import Tokenizer

    global _QUICK
    if "_QUICK" not in globals():
        library = Tokenizer.from_file(LEFT)
        library.encode_special_tokens = True
        _QUICK = (functools.partial(library.encode, add_special_tokens=False), alignment.Side(LEFT).encode)
    assert _QUICK[1]([text])[0] == _QUICK[0](" " + text).ids


def test_alignment_of_nothing(spark):
    rows = frame(spark, [])
    assert alignment.score_links(alignment.align(rows, LEFT, RIGHT)).collect() == []
    assert alignment.overlaps(rows, LEFT, RIGHT).collect() == []
    with pytest.raises(ValueError, match="rename"):
        alignment.align(rows.withColumn("links", F.lit(1)), LEFT, RIGHT, ["links"])
    with pytest.raises(ValueError, match="byte-level"):
        alignment.Side(public_tokenizers.path("word_bpe_49k.json"))


# --- licenses ----------------------------------------------------------------------------

PHRASES = {tuple(p.split()): label for p, label in license_rules.BASE.items()}


def scanned(text):
    """Everything but the detections' parts: n_words, n_base, first, last, base labels; then labels, score."""
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOW))
    places = sorted(
        (i, label) for i in range(len(words)) for p, label in PHRASES.items() if tuple(words[i : i + len(p)]) == p
    )
    line = " " + "  ".join(words) + " "
    found = [
        (m.start(), m.end(), k, rule)
        for k, rule in enumerate(license_rules.RULES) for m in re.finditer(rule.pattern, line)
    ]
    outer = [
        x for x in found
        if not any(y is not x and y[0] <= x[0] and x[1] <= y[1] and ((y[0], y[1]) != (x[0], x[1]) or y[2] < x[2]) for y in found)
    ]
    outer.sort(key=lambda x: x[0])
    kept = []
    for k, x in enumerate(outer):
        left, right = outer[k - 1] if k else None, outer[k + 1] if k + 1 < len(outer) else None
        beaten = (left and left[1] > x[0] and left[2] < x[2]) or (right and right[0] < x[1] and right[2] < x[2])
        if not beaten:
            kept.append(x)
    rules = [x[3] for x in kept] + [x[3] for x in found if x[3].base]
    at = [i for i, _ in places]
    return (
        len(words), len(places), min(at, default=None), max(at, default=None),
        ",".join(sorted({label for _, label in places})), ",".join(sorted({r.label for r in rules})),
        max((r.weight for r in rules), default=0.0),
    )


SAMPLES = [
    "Licensed under CC BY-NC 4.0.", "Released under the MIT License.", "Licensed under the Apache License, Version 2.0.",
    "This work is licensed under the GNU General Public License, version 3.", "mit license mit license MIT-License",
    "SPDX-License-Identifier: GPL-2.0-or-later", "cc by cc by cc-by", "GNU  general\npublic/license of apache license",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files, to deal in the software without restriction", "see https://www.apache.org/licenses/LICENSE-2.0.txt",
    "GNU Lesser General Public License version 2.1 or Mozilla Public License 2.0", "unlicensed cc bye committed license",
    "The code is dual licensed under the MIT license and the Apache license", "license: BSD-3-Clause", "é cc by é", None, "", " \n..",
    "Copyright 2020 Some Body. All rights reserved.", "ACC BY mit licenses", "word " * 30_000 + "MIT License " * 500,
    "licensed under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the "
    "License, or (at your option) any later version",
]


def test_licenses(spark):
    rng = random.Random(6)
    docs = list(enumerate(SAMPLES)) + [(None, SAMPLES[0]), (60, SAMPLES[1]), (60, SAMPLES[1])]
    for i in range(60):
        parts = [rng.choice(SAMPLES[:15]) if rng.random() < 0.5 else "filler words here" for _ in range(rng.randint(1, 8))]
        docs.append((100 + i, rng.choice(["\n", " ", ", "]).join(parts)))
    got = licenses.scan_licenses(frame(spark, docs, "doc_id long, text string, labels string")).drop("spans")
    want = sorted((repr(i), *scanned(t)) for i, t in docs)
    assert sorted((repr(r.doc_id), *tuple(r)[1:]) for r in got.collect()) == want


def test_license_labels(spark):
    docs = list(enumerate(SAMPLES))
    got = {r.doc_id: r for r in licenses.scan_licenses(frame(spark, docs)).collect()}
    assert got[0].labels == "cc-by,cc-by-nc-4.0" and got[2].labels == "apache,apache-2.0"
    assert got[5].labels == "gpl-2.0-or-later" and got[5].score == 1.0 and got[5].n_base == 0
    assert got[9].labels == "apache-2.0" and got[13].labels == "bsd-3-clause"
    assert got[11].labels == "" and got[11].score == 0.0
    assert [tuple(x) for x in got[1].spans] == [("mit", 0, 5), ("mit", 3, 5)]
    assert got[15].n_words == 0 and got[16].labels == "" and got[20].n_base == 500


def test_no_licenses(spark):
    assert licenses.scan_licenses(frame(spark, [])).collect() == []
    with pytest.raises(ValueError, match="rename"):
        licenses.scan_licenses(frame(spark, []).withColumn("Score", F.lit(1)), ["Score"])


def test_rules_hold_their_keyword_and_a_stem():
    for rule in license_rules.RULES:
        assert rule.keyword in rule.pattern
        must = re.sub(r"\(\?: \(\?:[^)]*\) \)\?|\(\?: \[\^ \]\+ \)\{0,[0-9]+\}", "", rule.pattern)
        assert any(stem in must for stem in license_rules.GATE), rule
        re.compile(rule.pattern)
    assert len({r.pattern for r in license_rules.RULES}) > 500


def test_license_plan_has_no_python(spark):
    plan = licenses.scan_licenses(frame(spark, [(1, SAMPLES[0])]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
