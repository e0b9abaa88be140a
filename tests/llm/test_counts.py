"""Token counts, pieces, mixing, chats and neighbours: plain versions, round trips, recall."""

import itertools
import random

import numpy as np
import pytest
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from metricloom.llm import byte_level, chat, mixing, neighbours, pieces, token_counts
from metricloom.session import scratch_path
from tests.llm.test_texts import ODD, frame, rows

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def test_token_counts_and_cache(spark):
    data = rows(n=10) + ODD + [(1, "a <|endoftext|> b"), (1, "a <|endoftext|> b")]
    library = Tokenizer.from_file(BYTES)
    want = sorted(
        (str(i), len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids))
        for i, t in data
    )
    cache = scratch_path(spark, "cache")
    for _ in range(2):
        got = token_counts.count_tokens(frame(spark, data, "n_tokens string"), BYTES, cache)
        assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got.collect()) == want
        assert spark.read.parquet(cache).count() == len({t or "" for _, t in data})
    more = token_counts.count_tokens(frame(spark, [*data, (5, "new text")]), BYTES, cache)
    assert more.where("doc_id = 5 and n_bytes = 8").first().n_tokens == 2
    assert spark.read.parquet(cache).count() == len({t or "" for _, t in data}) + 1
    assert token_counts.count_tokens(frame(spark, []), BYTES).count() == 0


def test_only_odd_texts_are_counted_by_the_files_library(monkeypatch):
    import json

    library = Tokenizer.from_file(BYTES)
    seen = []

    def slow(texts):
        seen.extend(texts)
        return [library.encode(x, add_special_tokens=False).ids for x in texts]

    odd = ["a <|endoftext|> b", "слово", "日本 a", "a" + " " * 200_000 + "b", "\n \t" * 60_000]
    plain = ["", " ", "a  b\n\n c", "Größe, it's 12 %", "a" * 30_000, " x" * 30_000, "<|endoftext|", "Ɏ\x00\x85 \xa0 "]
    with open(BYTES, encoding="utf-8") as file:
        spec = json.load(file)
    assert byte_level.is_plain(spec)
    encode = byte_level.quick(spec, byte_level.token_bytes(library), slow, ["<|endoftext|>"])
    got = encode([*odd, *plain])
    assert seen == odd
    assert got == slow([*odd, *plain])
    used = []
    monkeypatch.setattr(token_counts, "quick", lambda *a: used.append(a) or byte_level.quick(*a))
    assert token_counts._encoder(BYTES)([*odd, *plain]) == [len(x) for x in got]
    assert used
    spec["model"]["merges"] = spec["model"]["merges"][::-1]
    assert not byte_level.is_plain(spec)


def test_pieces_equal_the_library(spark):
    rng = random.Random(1)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    long = [
        "thethenandinthere" * 90, " " * 300 + "x", "無" * 200 + "the" * 300, "ab " * 500,
        "".join(rng.choice("etaoin") for _ in range(2500)), "a▁b" * 400,
    ]
    data = rows(n=10) + ODD + list(enumerate(long, 100)) + [(100, long[0])]
    got = pieces.encode(frame(spark, data, "ids string"), ["doc_id"], PIECES, chunk=64)
    found = sorted((str(r.doc_id), r.ids) for r in got.collect())
    assert found == sorted((str(i), library.encode(t or "")) for i, t in data)
    assert got.where("not same").count() == 0
    back = {r.doc_id: r.text for r in pieces.decode(got.drop("same"), PIECES).collect()}
    assert all(back[i] == t.replace("▁", " ") for i, t in data if i is not None and t)
    assert pieces.encode(frame(spark, []), ["doc_id"], PIECES).count() == 0


def test_max_plus_product_is_associative():
    model = pieces.Vocabulary(PIECES)
    text, longest = pieces.normalised("thentheaterinthe" * 30), model.longest
    parts = [
        model.transfer(text[max(0, b - longest) : e + longest], min(b, longest), min(b, longest) + e - b, e == len(text))
        for b, e in pieces.cuts(len(text), 60, longest)
    ]
    a, b, c = parts[:3]
    assert pieces.combine(pieces.combine(a, b), c) == pieces.combine(a, pieces.combine(b, c))


def test_flight_keeps_totals():
    rng = np.random.default_rng(2)
    size, p = rng.integers(0, 900, 3000).astype(float), np.full(3000, 0.37)
    out = mixing.flight(size, p, rng)
    assert ((out > 0) & (out < 1)).sum() <= 2
    assert abs(out.sum() - p.sum()) < 1e-6 and abs(out @ size - p @ size) < 1e-3
    total = np.mean([mixing.flight(size[:9], p[:9], np.random.default_rng(k)) for k in range(4000)], axis=0)
    assert np.abs(total - 0.37).max() < 0.05


def plain_targets(sizes, weights=(3, 1, 2)):
    left, open_, target = 1.5 * sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    w = [weights[i % 3] for i in range(len(sizes))]
    while True:
        unit = left / max(1e-300, sum(w[i] for i in open_))
        over = {i for i in open_ if w[i] * unit > 2 * sizes[i]}
        if not over:
            break
        for i in over:
            target[i], left = 2.0 * sizes[i], left - 2.0 * sizes[i]
        open_ -= over
    for i in open_:
        target[i] = w[i] * unit
    return target


def test_mixing(spark):
    rng = random.Random(4)
    data = []
    for i in range(900):
        source = rng.choice(["a", "a", "a", "a", "b", "Z", "é", None])
        data.append((i, "w " * rng.choice((1, 5, 40, 200, 900)), source))
    data += [(None, "no id", "b"), (7, None, "b"), (8, "", "empty"), (7, "same row", "b"), (7, "same row", "b")]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string").repartition(5)
    got = mixing.mix_documents(docs).collect()
    again = mixing.mix_documents(docs.repartition(2)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again)) and len(got) == len(data)
    names = sorted({s for _, _, s in data if s}) + [None]
    sizes = [sum(len((t or "").split()) for _, t, s in data if s == n) for n in names]
    targets = dict(zip(sizes, plain_targets(sizes), strict=True))
    for size, target in targets.items():
        mine = [r for r in got if r.source_size == size]
        assert all(abs(r.target - target) < 1e-6 * max(1, target) for r in mine)
        assert abs(sum(r.taken for r in mine) - target) <= max(3, 0.01 * target)
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    taken = mixing.mixed_rows(docs)
    assert taken.columns == docs.columns
    assert taken.selectExpr("sum(size(regexp_extract_all(text, '[^ ]+', 0)))").first()[0] == sum(r.taken for r in got)
    assert mixing.mix_documents(docs.limit(0)).count() == 0


def test_repeats_fly_as_one(spark, monkeypatch):
    flown = []
    fly = mixing.included
    monkeypatch.setattr(mixing, "included", lambda units: flown.append(units.count()) or fly(units))
    data = [(1, "same text here", "a")] * 3000 + [(None, "no id", None)] * 1000
    data += [(i, "w " * (i % 50), ("a", "b")[i % 2]) for i in range(2, 1500)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string").repartition(7)
    got = mixing.mix_documents(docs).toPandas()
    assert flown[0] <= 1500 and len(got) == len(data)
    for _, mine in got.groupby("source_size"):
        assert abs(mine["taken"].sum() - mine["target"].iloc[0]) <= max(3, 0.01 * mine["target"].iloc[0])
    hot = got[got["doc_id"] == 1]
    rate = (hot["target"] / hot["source_size"]).iloc[0]
    assert abs(hot["taken"].sum() - 3 * 3000 * rate) <= 3
    assert set(hot["taken"]) <= {3 * int(rate), 3 * int(rate) + 3}
    rows = mixing.mixed_rows(docs)
    assert rows.where("doc_id = 1").count() == hot["taken"].sum() / 3


def plain_cost(roles):
    """Least cost over all legal role sequences, by trying every choice."""
    best = {chat.START: 0.0}
    for role in roles:
        new = {}
        for (a, b), (cost, _, _) in itertools.chain(*[chat.MOVES[role].items()]):
            if a in best:
                new[b] = min(new.get(b, 1e9), best[a] + cost)
        best = new
    return min(best.values())


def legal(roles):
    body = roles[1:] if roles[:1] == ["system"] else roles
    return all(r == ("user", "assistant")[k % 2] for k, r in enumerate(body))


def test_repair_is_legal_and_cheapest():
    for n in range(1, 6):
        for roles in itertools.product(range(-1, 3), repeat=n):
            ways = chat.repair(list(roles))
            out, cost, before = [], 0.0, chat.START
            for role, (new, inserted, action) in zip(roles, ways, strict=True):
                cost += chat._label(role, new) + (chat.INSERT if inserted >= 0 else 0) + chat.MERGE * action
                out += [chat.ROLES[inserted]] if inserted >= 0 else []
                out += [chat.ROLES[new]] if action == 0 else []
                assert action == 0 or new == before
                before = new
            assert legal(out) and cost == plain_cost(roles)


def test_chats_over_part_borders(spark):
    rng = random.Random(8)
    data = [(1, k, rng.choice(["user", "user", "assistant", "system", "tool", None]), f"t{k}") for k in range(400)]
    data += [(2, 0, "assistant", "<|im_end|> x"), (3, None, "user", None), (None, 1, " User ", "a"), (4, 0, "user", "q")]
    data += [(4, 0, "user", "q")]
    schema = "conv_id long, turn long, role string, text string, rendered string"
    turns = spark.createDataFrame([(*x, "old") for x in data], schema).repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = chat.format_chats(turns).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(got) == len(data)
    mine = sorted((r for r in got if r.conv_id == 1), key=lambda r: r.turn)
    roles = [chat.role_of(x[2]) for x in data[:400]]
    cost = sum(
        chat._label(a, chat.ROLES.index(r.new_role)) + chat.INSERT * (r.inserted is not None)
        + chat.MERGE * r.action.endswith("merge") for a, r in zip(roles, mine, strict=True)
    )
    assert cost == plain_cost(roles)
    whole = "".join(r.rendered for r in mine)
    heads = [x.split("\n")[0] for x in whole.split("<|im_start|>")[1:]]
    assert legal(heads) and whole.count("<|im_end|>") == len(heads) and whole.startswith("<|im_start|>")
    assert next(r.rendered for r in got if r.conv_id == 2).count("<|im_end|>") == 2
    assert chat.format_chats(turns.limit(0)).count() == 0


def test_neighbours(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((8, 16))
    x = centres[rng.integers(0, 8, 700)] + 0.7 * rng.standard_normal((700, 16))
    x[50:90] = x[50]
    data = [(i, [float(v) for v in row], "s") for i, row in enumerate(x)]
    bad = [None, [], [0.0] * 16, [float("nan")] * 16, [1.0] * 15 + [None], [float("inf")] * 16, [1.0] * 4]
    odd = [(2000 + 20 * i, v, "s") for i, v in enumerate(bad)] + [(None, [1.0] * 16, "s"), data[0]]
    table = spark.createDataFrame([*data, *odd], "vec_id long, embedding array<double>, rank string")
    got = neighbours.nearest(table.repartition(3)).toPandas()
    hit = 0
    for q in range(0, 700, 20):
        mine = got[got.query_id == q].sort_values("rank")
        score = x @ x[q]
        score[q] = -np.inf
        want = np.lexsort((np.arange(700), -np.round(score, 9)))[:20]
        assert list(mine["rank"]) == list(range(1, 21)) and q not in set(mine.vec_id)
        assert np.allclose(mine.score, score[mine.vec_id.to_numpy()], atol=1e-9)
        order = list(zip(-mine.score, mine.vec_id, strict=True))
        assert order == sorted(order)
        hit += len(set(mine.vec_id) & set(want.tolist()))
    assert hit / (35 * 20) >= 0.9 and set(got.query_id) == set(range(0, 700, 20))
    few = neighbours.nearest(table.where("vec_id in (0, 1, 2)")).collect()
    assert sorted(r.vec_id for r in few) == [1, 2]
    assert neighbours.nearest(table.limit(0)).count() == 0


def test_neighbours_of_opposite_vectors(spark):
    table = spark.createDataFrame([(0, [1.0, -2.0, 3.0]), (20, [-1.0, 2.0, -3.0])], "vec_id long, embedding array<double>")
    got = sorted((r.query_id, r.vec_id, r.score) for r in neighbours.nearest(table).collect())
    assert got == [(0, 20, -14.0), (20, 0, -14.0)]


def test_neighbours_of_rare_directions(spark):
    rng = np.random.default_rng(5)
    centre = 3 * rng.standard_normal(16)
    x = centre + 0.3 * rng.standard_normal((6000, 16))
    rare = np.arange(0, 6000, 100)
    x[rare] = -centre + 4 * rng.standard_normal((60, 16))
    apart = np.arange(10, 6000, 1200)  # a separated group, smaller than a result
    x[apart] = 5 * np.roll(centre, 3) + 0.1 * rng.standard_normal((5, 16))
    x[20] = x[apart[0]] + 0.01
    table = spark.createDataFrame(
        [(i, [float(v) for v in row]) for i, row in enumerate(x)], "vec_id long, embedding array<double>"
    ).repartition(3)
    got = neighbours.nearest(table).toPandas()
    assert (got.groupby("query_id").size() == 20).all() and got.query_id.nunique() == 300
    hit = 0
    for q in [20, *rare]:
        score = x @ x[q]
        score[q] = -np.inf
        hit += len(set(got[got.query_id == q].vec_id) & set(np.argsort(-score)[:20].tolist()))
    assert hit / (61 * 20) >= 0.9


@pytest.mark.parametrize("scale", [1e-120, 1e-45, 1.0, 1e100])
def test_neighbours_of_extreme_sizes(spark, scale):
    rng = np.random.default_rng(11)
    x = np.abs(rng.standard_normal((400, 8))) * scale
    x[37] *= 1e39
    x[60] *= 1e-20
    table = spark.createDataFrame(
        [(i, [float(v) for v in row]) for i, row in enumerate(x)], "vec_id long, embedding array<double>"
    )
    got = neighbours.nearest(table).toPandas()
    assert set(got[got["rank"] == 1].vec_id) == {37} and got.query_id.nunique() == 20
    hit = 0
    for q in range(0, 400, 20):
        score = (x / scale) @ (x[q] / scale)
        score[q] = -np.inf
        hit += len(set(got[got.query_id == q].vec_id) & set(np.argsort(-score)[:20].tolist()))
    assert hit / 400 >= 0.9


def test_all_nodes_are_compared_block_by_block(spark):
    rng = np.random.default_rng(6)
    x = rng.standard_normal((700, 8))
    nodes = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "node long, vec array<double>")
    asked = nodes.where("node < 70").selectExpr("node as query", "vec as qvec")
    got = neighbours.compare_all(asked, nodes, 5).toPandas()
    for q in range(70):
        assert set(np.argsort(-(x @ x[q]))[:5]) <= set(got[got["query"] == q].node)
