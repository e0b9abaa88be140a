"""Line dedup, near-dedup, spans and quality rules against plain versions, with odd rows."""

import math
import random

import numpy as np
import pytest

from metricloom.llm import line_dedup, near_dedup, personal_data, quality, secret_scan
from tests.llm import brute

ODD = [
    (None, "no id here but quite some words in a line of text\nshared"),
    (None, None),
    (900, None),
    (901, ""),
    (902, "\n\n \t\n"),
    (903, "é🙂 ü " * 40),
    (904, "one two three"),
    (905, "x" * 5_000 + " " + "word " * 3_000),
]


def rows(seed=3, n=60):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(300)]
    lines = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 14))) for _ in range(60)]
    out = []
    for i in range(n):
        text = rng.sample(lines, rng.randint(1, 8))
        for k, line in enumerate(text):
            w = line.split()
            step = rng.random()
            if step < 0.2:
                w[rng.randrange(len(w))] = "changed"
            elif step < 0.3:
                del w[rng.randrange(len(w))]
            elif step < 0.4:
                w.insert(rng.randrange(len(w) + 1), "added")
            text[k] = " ".join(w).upper() if step > 0.9 else " ".join(w)
        out.append((i, "\n".join(text)))
    return out


def frame(spark, data, extra="kept string"):
    return spark.createDataFrame(
        [(i, t, "x") for i, t in data], f"doc_id long, text string, {extra}"
    ).repartition(3)


def test_lines(spark):
    data = rows() + [x for x in ODD if x != (None, None)]
    got = line_dedup.dedup_lines(frame(spark, data, "n_lines string")).collect()
    assert {r.doc_id: r.text for r in got} == brute.drop_lines(data)
    assert sum(r.n_dropped for r in got) > 50


def test_texts_are_taken_in_groups(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "_GROUP", 60)
    texts = [b"a" * 30, b"", b"b" * 30, b"c" * 200, b"d"]
    assert list(line_dedup._groups(texts)) == [(0, 3), (3, 4), (4, 5)] and not list(line_dedup._groups([]))
    data = rows(seed=8) + [x for x in ODD if x != (None, None)]
    got = line_dedup.dedup_lines(frame(spark, data)).collect()
    assert {r.doc_id: r.text for r in got} == brute.drop_lines(data)
    assert {r.doc_id: r.n_lines for r in got} == {i: t.count("\n") + 1 if t is not None else 0 for i, t in data}


@pytest.mark.parametrize("n", range(8, 13))
def test_lines_within_one_word_share_a_part(n):
    rng = np.random.default_rng(n)
    ranges = line_dedup.Ranges(7)

    def parts(w):
        return {int(h[0]) for h in line_dedup._halves(w, np.array([0]), np.array([w.size]), ranges)}

    line = rng.integers(1, 1 << 60, n).astype(np.uint64)
    for k in range(n + 1):
        other = np.insert(line, k, 5)
        assert parts(line) & parts(other)
        if k < n:
            changed = line.copy()
            changed[k] = 9
            assert parts(line) & parts(changed)


def test_lines_of_repeated_rows(spark):
    data = [(1, "a b\nc d"), (1, "a b\nc d"), (2, "c d\nc d\ne")]
    got = line_dedup.dedup_lines(frame(spark, data)).select("doc_id", "text").collect()
    assert sorted(map(tuple, got)) == [(1, "a b\nc d"), (1, "a b\nc d"), (2, "e")]
    emptied = line_dedup.dedup_lines(frame(spark, [(1, "a"), (2, "a"), (3, "")]), drop_emptied=True)
    assert sorted(r.doc_id for r in emptied.collect()) == [1, 3]


def near_rows(n=90, seed=5):
    rng = random.Random(seed)
    out, bases = {}, [[f"v{rng.randrange(5000)}" for _ in range(rng.randint(6, 120))] for _ in range(6)]
    for i in range(n):
        w = list(rng.choice(bases))
        for _ in range(rng.choice((0, 0, 1, 1, 2, 3, 6))):
            w[rng.randrange(len(w))] = f"z{rng.randrange(9)}"
        out[i] = " ".join(w)
    return out


@pytest.mark.parametrize("percent", [80, 85])
def test_near_groups(spark, percent):
    data = near_rows() | {i: t for i, t in ODD if i is not None}
    want = brute.components(data, percent)
    got = near_dedup.near_components(frame(spark, list(data.items())), percent).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    for r in got:
        assert r.n_shingles == len(brute.shingles(data[r.doc_id]))
        assert r.kept == (r.doc_id == r.component_id)
    kept = near_dedup.keep_one_of_each(frame(spark, list(data.items()), "near_tag string"), percent)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))
    assert kept.columns == ["doc_id", "text", "near_tag"]


def test_near_groups_of_odd_rows(spark):
    data = [(None, "a b c"), (None, "a b c"), (None, None), (4, "a b c"), (4, "a b c"), (3, "d"), (3, "e")]
    got = near_dedup.near_components(frame(spark, data)).collect()
    found = sorted((str(r.doc_id), r.n_shingles, r.component_id, r.kept) for r in got)
    assert found == sorted(
        [("None", 1, 4, False)] * 2 + [("None", 0, None, True)] + [("4", 1, 4, True)] * 2
        + [("3", 1, 3, True)] * 2
    )
    kept = near_dedup.keep_one_of_each(frame(spark, data)).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in kept) == [
        ("3", "d"), ("3", "e"), ("4", "a b c"), ("None", "None")
    ]


def test_estimate_is_corrected_for_chance():
    k = near_dedup.LONG
    rng = np.random.default_rng(1)
    mult, add = near_dedup._permutations(k)
    for share in (0.2, 0.5, 0.85):
        pool = rng.integers(0, 1 << 63, 4000).astype(np.uint64)
        both = int(2000 * share / (1 + share) * 2)
        a, b = pool[:2000], pool[2000 - both : 4000 - both]
        signs = [near_dedup._packed(near_dedup.minima(x, mult, add)) for x in (a, b)]
        planes = near_dedup._planes(signs)
        got = near_dedup.estimate(near_dedup._agreement(planes[0], planes[1], k), k)
        assert abs(got - both / (4000 - both)) < 0.06


PERSONAL = [
    "a@b.c_x@d.e a@b.c@d.e", "1.2.3.4.5.6.7.8 300.1.1.1 001.2.3.4 1.2.3", "4111 1111-1111 1111 12",
    "+1 (555) 555-1234, tel 555-123-4567 and bob [at] mail [dot] com", "ü🙂 x@y.zz 🙂 +49 123 456789",
    "1 " * 9_000, "9" * 900, "a@b." + "c." * 4_000 + "d", "." * 3_000 + "@a.b", "4111111111111111",
]


def test_personal_data(spark):
    data = [(i, t) for i, t in enumerate(PERSONAL)] + ODD + [(3, PERSONAL[3])]
    got = personal_data.find_personal_data(frame(spark, data, "n_ip string")).collect()
    assert len(got) == len(data)
    want = sorted((str(i), *brute.personal(t)) for i, t in data)
    assert sorted((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == want
    added = {r.doc_id: r.spans for r in got if r.n_added}
    assert "phone_local:23:35" in added[3]


def test_addresses_with_zero_parts(spark):
    texts = [
        "10.0.0.1 0.0.0.0", "000.1.2.3 and 127.0.0.1", "192.168.0.1 256.0.0.1", "0.0.0.0256 000.00.0.00255",
        "0" * 3_000 + ".1.2.3 1.2.3." + "0" * 3_000 + "256",
    ]
    got = personal_data.find_personal_data(frame(spark, list(enumerate(texts)))).collect()
    want = {i: brute.personal(t) for i, t in enumerate(texts)}
    assert {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got} == want
    assert [want[i][1] for i in range(5)] == [2, 2, 1, 1, 1]


def test_personal_data_of_single_digits(spark):
    texts = [
        "8.8.8.8", "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1", "4-1-1-1-1-1-1-1-1-1-1-1-1-1-1-1", "+1 2 3 4 5 6 7 8 9",
        "+1(2)3.4-5 6 7.8", "call + 1 2 3", "1 . 2", "7",
    ]
    got = personal_data.find_personal_data(frame(spark, list(enumerate(texts)))).collect()
    want = {i: brute.personal(t) for i, t in enumerate(texts)}
    assert {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got} == want
    assert [sum(want[i][:4]) for i in range(5)] == [1] * 5


def test_reliability_prefers_labelers_that_agree():
    counts = [((1, 1, -1), 40.0), ((-1, -1, 1), 40.0), ((1, 1, 1), 20.0), ((-1, -1, -1), 20.0)]
    good = dict(zip([v for v, _ in counts], personal_data.estimate_reliability(counts), strict=True))
    assert good[1, 1, -1] > 0.9 > 0.1 > good[-1, -1, 1]


def test_secrets(spark):
    texts = [
        'password = "abc123XYZ" token:short secret: abc token: abcdefg', "AKIA" + "A1" * 8 + " AKIAX",
        "ſecret=abcdefgh toKen=abcdefgh", "deadbeef" * 4 + "g" + "0" * 24, "🙂 api_key: x9 passwd=aaaaaa",
        "my pwd: Xk29vQz7LmP0 and pass is 123456",
    ]
    data = list(enumerate(texts)) + ODD
    got = secret_scan.scan_secrets(frame(spark, data, "n_hex string"), ["doc_id"]).collect()
    want = sorted((str(i), *brute.secret(t)) for i, t in data)
    assert sorted((str(r.doc_id), r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got) == want
    assert next(r.spans for r in got if r.doc_id == 5) == "guess:8:20"


def test_secrets_after_common_words():
    def added(text):
        base, more, _ = secret_scan.find_secrets(text)
        assert all(e <= s or t <= b for b, _, e in base for s, _, t in more)
        return [text[s:e] for s, _, e in more]

    assert added("password: p@ssW0rd!9xQz") == ["p@ssW0rd!9xQz"]
    assert added('secret="$9f!kQ2z#Lm"') == ["$9f!kQ2z#Lm"]
    assert added("my PASSWORD IS Xk29vQz7LmP0, ok") == ["Xk29vQz7LmP0"]
    assert added("api_key: !Xk29vQz7 apikey = %Zz81!kQp passwd:#kQ2z9f!L token is t9$Kw2!zQ") == [
        "!Xk29vQz7", "%Zz81!kQp", "#kQ2z9f!L", "t9$Kw2!zQ"
    ]
    # A base span keeps its place, and what stands before or after it is still read.
    assert added("token=abcdef;pwd=Xk29!vQz7LmP0") == ["Xk29!vQz7LmP0"]
    assert added("pwd: #kQ2z9f!L;token=abcdef") == ["#kQ2z9f!L"]
    assert added("password: abcdefgh token: 123") == []
    assert added("password is 123456 secret is hello1") == []
    assert len(added("token=abcdef;pwd=Xk29!vQz7LmP0;" * 3_000)) == 3_000


def test_guess_power():
    power = secret_scan.guess_power
    assert power("") == 0
    assert power("password") < power("passw0rd") < power("vq7Kz0Lm")
    assert power("aaaaaaaaaaaa") < 4 and power("qwertyuiop") < 4 and power("20240131") < 5
    assert power("7f3a9c1be2d84c55") > 12
    assert power("z" * 20_000) < power("zq" * 10_000)


def test_quality_base(spark):
    data = rows(n=20) + ODD + [(1, "a b c a b c")]
    got = quality.score_quality(frame(spark, data, "n_words string"), None).collect()
    want = sorted((str(i), *brute.quality(t)) for i, t in data)
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted((str(r.doc_id), *(r[c] for c in columns)) for r in got) == want
    for r in got:
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed and r.kept == (not failed)
    names = quality.score_quality(frame(spark, data, "x string"), None).columns
    assert names == ["doc_id", "text", "x", *columns, "base_failed", "kept", "probability"]


def test_quality_model_on_held_out_rows(spark):
    from tests.conftest import SMALL

    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    fit = labels.where("doc_id % 2 = 0")
    model = quality.train_quality_model(docs, fit)
    scored = quality.score_quality(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id")
    kept = [(r.kept, r.quality) for r in scored.where("not base_failed").collect()]
    assert sum(k == bool(q) for k, q in kept) / len(kept) > 0.9
    assert quality.train_quality_model(docs, labels.where("quality = 1")) is None


def test_fit_holds_a_bounded_part_of_its_texts(monkeypatch):
    import tracemalloc

    rng = random.Random(3)
    texts = [(" ".join(f"w{rng.randrange(50_000)}" for _ in range(400)), i % 3 % 2) for i in range(240)]
    whole = quality.fit(texts)
    monkeypatch.setattr(quality, "_CHUNK", 20_000)
    monkeypatch.setattr(quality, "_STEPS", 150)
    tracemalloc.start()
    parts = quality.fit(iter(texts))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 24e6  # all grams at once: 40 MB and more
    assert np.allclose(parts.weights, whole.weights) and np.isclose(parts.slope, whole.slope)
    assert np.isclose(parts.bias, whole.bias) and np.isclose(parts.offset, whole.offset)
    assert quality.fit(x for x in texts if x[1]) is None and quality.fit([]) is None


def test_quality_keeps_clashing_columns(spark):
    docs = frame(spark, rows(n=5), "q_kept string")
    assert quality.keep_good(docs, spark.createDataFrame([], "doc_id long, quality int")).columns == docs.columns


def test_empty_tables(spark):
    none = frame(spark, [])
    assert line_dedup.dedup_lines(none).count() == 0
    assert near_dedup.near_components(none).count() == 0
    assert near_dedup.keep_one_of_each(none).count() == 0
    assert personal_data.find_personal_data(none).count() == 0
    assert secret_scan.scan_secrets(none, ["doc_id"]).count() == 0
    assert quality.score_quality(none, None).count() == 0


def _plain_guess_power(value: str) -> float:
    """All segmentations, by trying every segment between every two positions."""
    low, best = value.lower(), [0.0] + [float("inf")] * len(value)
    plain = low.translate(secret_scan._LEET)

    def alike(part: str) -> bool:
        steps = list(zip(part, part[1:]))
        return any(
            all(test(a, b) for a, b in steps)
            for test in (
                lambda a, b: a == b,
                lambda a, b: (a, b) in secret_scan._NEXT,
                lambda a, b: abs(ord(a) - ord(b)) == 1 and (a + b).isalnum(),
            )
        )

    for end in range(1, len(value) + 1):
        for start in range(end):
            part, size = value[start:end], end - start
            costs = [secret_scan._char_cost(part)] if size == 1 else []
            if size >= 3 and alike(low[start:end]):
                costs.append(secret_scan._char_cost(part[0]) + math.log10(size) + 0.3)
            for form, more in ((low, 0.0), (plain, 0.6)):
                if form[start:end] in secret_scan.WORDS:
                    rank = secret_scan.WORDS.index(form[start:end]) + 1
                    costs.append(math.log10(rank + 1) + more + 0.5 * (part != part.lower()))
            if size in (4, 8, 10) and secret_scan._DATE.fullmatch(part):
                costs.append(2.1 if size == 4 else 4.5)
            further = secret_scan._SEGMENT * (start > 0 and (size > 1 or costs[0] != secret_scan._char_cost(part)))
            for cost in costs:
                best[end] = min(best[end], best[start] + cost + further)
    return best[-1]


def test_guess_power_is_the_cheapest_segmentation():
    rng = random.Random(5)
    pieces = ["a" * 150, "password", "P4ssw0rd", "qwerty", "poiuytrewq", "abcdef", "9876543210", "2019-03-04",
              "1999", "x", "!", "aA", "ab" * 40, "dfdfdf" * 20, "1212" * 30, "zzz", "é", "kKk"]
    values = ["", "a", "a" * 500, "ab" * 300, *("".join(rng.choices(pieces, k=rng.randint(1, 4))) for _ in range(60))]
    values += ["".join(rng.choices("ab1", k=rng.randint(1, 90))) for _ in range(60)]
    for value in values:
        assert secret_scan.guess_power(value) == pytest.approx(_plain_guess_power(value), abs=1e-9), value


def test_short_context_words_begin_a_word():
    def added(text):
        return secret_scan.find_secrets(text)[1]

    for text in ("spin: Xk29vQz7LmP0", "bypass is Xk29vQz7LmP0", "compass=Xk29vQz7LmP0"):
        assert not added(text)
    for text in ("pin: Xk29vQz7LmP0", "user_pin: Xk29vQz7LmP0", "userPin: Xk29vQz7LmP0", "oauth: Xk29vQz7LmP0", "PASS=Xk29vQz7LmP0"):
        assert len(added(text)) == 1
