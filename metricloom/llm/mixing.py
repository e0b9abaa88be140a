"""Mixing sources to target weights by balanced sampling with the cube method.

Every document of a source gets the same expected number of copies; its whole part is
certain, the fraction is an inclusion probability. A flight moves the probabilities of
three undecided documents at a time along the null space of the balancing constraints
(documents and tokens), until one of them is 0 or 1, so that both totals stay as they
are. Sources are cut into blocks of bounded size that fly on their own; each leaves at most
two undecided documents, which meet in the next round, until one small landing problem per
source is left.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from metricloom.llm.common import WORD, fresh, numbered, stored, text_of

WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
MAX_REPEATS = 2
#: Documents that fly in one task.
BLOCK = 20_000
#: Documents of a source that are left to the landing; their 2**12 choices are all tried.
LANDING = 12
_EDGE = 1e-9


def n_words(column: str = "text") -> Column:
    return F.regexp_count(text_of(column), F.lit(WORD)).cast("long")


def ranked(sources: DataFrame) -> DataFrame:
    """Add ``rank`` from 0 by code point, missing last: a range sort and one offset per part."""
    order = F.col("source").asc_nulls_last()
    placed = sources.repartitionByRange(order).sortWithinPartitions(order)
    placed = stored(placed.withColumn("at", F.monotonically_increasing_id()), "sources")
    part = F.shiftright("at", 33).alias("part")
    parts = placed.groupBy(part).agg(F.count(F.lit(1)).alias("c"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition of the sort, however many sources there are.
    offsets = parts.select("part", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("offset"))
    joined = placed.withColumn("part", part).join(offsets, "part")
    inside = F.col("at") - F.shiftleft(F.col("part"), 33)
    return joined.withColumn("rank", F.col("offset") + inside).drop("part", "at", "offset")


def source_targets(
    sizes: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share_percent: int = SHARE_PERCENT,
    max_repeats: int = MAX_REPEATS,
) -> DataFrame:
    """(source, source_size, n, target) from rows of (source, size).

    Targets are weights times one common factor, but at most ``max_repeats`` times the
    source's size; the factor grows until the excess is shared out. Each round is one
    aggregate over one row per source; only the factor comes to the driver.
    """
    sources = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")
    )
    weight = F.element_at(
        F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")
    ).cast("double")
    sources = stored(ranked(sources).withColumn("weight", weight).drop("rank"), "weights")
    cap = F.lit(max_repeats) * F.col("source_size")
    first = sources.agg(F.sum("source_size").alias("s"), F.sum("weight").alias("w")).first()
    goal = (first["s"] or 0) * share_percent / 100
    factor, capped = (goal / first["w"] if first["w"] else 0.0), -1
    while True:
        above = F.col("weight") * F.lit(factor) > cap
        now = sources.agg(
            F.count(F.when(above, 1)).alias("c"),
            F.sum(F.when(above, cap)).alias("s"),
            F.sum(F.when(~above, F.col("weight"))).alias("w"),
        ).first()
        if now["c"] == capped or not now["w"]:
            break
        capped, factor = now["c"], (goal - (now["s"] or 0)) / now["w"]
    target = F.least(F.col("weight") * F.lit(factor), cap.cast("double"))
    return sources.select("source", "source_size", "n", target.alias("target"))


def flight(
    size: np.ndarray, p: np.ndarray, rng: np.random.Generator, leave: int = 0
) -> np.ndarray:
    """Probabilities after the flight: 0 or 1 but for two at most, or for ``leave``.

    Totals of ``p`` and of ``p * size`` stay; the expectation of each ``p`` does too.
    """
    out = p.copy()
    wait = np.flatnonzero((p > _EDGE) & (p < 1 - _EDGE)).tolist()[::-1]
    chance = rng.random(2 * len(wait) + 4).tolist()
    active: list[int] = []
    while len(active) + len(wait) > leave:
        while len(active) < 3 and wait:
            active.append(wait.pop())
        x = [float(size[i]) for i in active]
        if len(active) == 3:
            step = [x[1] - x[2], x[2] - x[0], x[0] - x[1]]
            if not any(step):
                step = [1.0, -1.0, 0.0]
        elif len(active) == 2 and x[0] == x[1]:
            step = [1.0, -1.0]
        else:
            break
        up = down = np.inf
        for i, s in zip(active, step, strict=True):
            if s > 0:
                up, down = min(up, (1 - out[i]) / s), min(down, out[i] / s)
            elif s < 0:
                up, down = min(up, -out[i] / s), min(down, (out[i] - 1) / s)
        move = up if chance.pop() * (up + down) < down else -down
        for i, s in zip(active, step, strict=True):
            out[i] += move * s
            if out[i] < _EDGE:
                out[i] = 0.0
            elif out[i] > 1 - _EDGE:
                out[i] = 1.0
        active = [i for i in active if 0 < out[i] < 1]
    return out


def landing(size: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Decide the last few documents so that the token total misses least, then the count."""
    left = np.flatnonzero((p > 0) & (p < 1))
    choices = np.array(list(product((0.0, 1.0), repeat=left.size))).reshape(-1, left.size)
    tokens = np.round(np.abs(choices @ size[left] - (p[left] * size[left]).sum()), 6)
    count = np.abs(choices.sum(1) - p[left].sum())
    out = p.copy()
    out[left] = choices[np.lexsort((count, tokens))[0]]
    return out


def _fly(level: int, land: bool):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["h", "key", "size"])
        rng = np.random.default_rng([level, len(rows), abs(int(rows["h"].iloc[0]))])
        size = rows["size"].to_numpy()
        p = flight(size, rows["p"].to_numpy(), rng, LANDING if land else 0)
        return rows.assign(p=landing(size, p) if land else p)

    return run


_UNIT = "key bigint, h bigint, source string, size bigint, p double, block bigint"


def included(units: DataFrame, block: int = BLOCK) -> DataFrame:
    """(key, h, p) with p decided to 0 or 1, from units (key, h, source, size, p)."""
    done: list[DataFrame] = []
    open_, level = units, 0
    while True:
        counts = stored(open_.groupBy("source").agg(F.count(F.lit(1)).alias("n")), "open")
        land = counts.where(F.col("n") > block).isEmpty()
        same = F.col("u.source").eqNullSafe(F.col("c.source"))
        blocks = F.ceil(F.col("c.n") / block)
        cut = open_.alias("u").join(counts.alias("c"), same).select(
            "u.*", F.pmod(F.xxhash64("u.h", F.lit(level)), blocks).alias("block")
        )
        flown = cut.groupBy("source", "block").applyInPandas(_fly(level, land), _UNIT)
        flown = stored(flown.drop("block"), "flown")
        done.append(flown.where("p in (0, 1)"))
        if land:
            break
        open_, level = flown.where("p > 0 and p < 1"), level + 1
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out


_ALIKE = ("key", "h", "source", "size")


def _same(a: str, b: str, *more: str) -> Column:
    found = F.lit(True)
    for c in (*_ALIKE, *more):
        found &= F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return found


def _undecided(p: str) -> Column:
    return (F.col(p) > _EDGE) & (F.col(p) < 1 - _EDGE)


def mixed_units(units: DataFrame, **settings) -> DataFrame:
    """Add source_size, target and copies to units (key, h, source, size, others).

    ``key`` orders units; ``h`` is a hash of what identifies a document, which deals
    documents to blocks, so that reruns agree. Units alike in all four are interchangeable
    and fly as one: of m units with probability p, the whole part of m p is taken for
    certain and the rest is the probability of one more. So repeats, however many, take
    one place in a block, and both totals stay as they are.
    """
    targets = source_targets(units.select("source", "size"), **settings)
    same = F.col("u.source").eqNullSafe(F.col("t.source"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    joined = units.alias("u").join(targets.alias("t"), same).select(
        "u.*", "t.source_size", "t.target", F.floor(rate).alias("whole"), (rate - F.floor(rate)).alias("p")
    )
    joined = numbered(joined, "at", "units").withColumn("part", F.shiftright("at", 33))
    certain = joined.where(~_undecided("p")).withColumn("copies", F.col("whole") + F.round("p").cast("long"))

    parts = joined.where(_undecided("p")).groupBy(*_ALIKE, "p", "part").agg(F.count(F.lit(1)).alias("c"))
    parts = stored(parts, "alike-parts")
    expected = F.sum("c") * F.col("p")
    groups = parts.groupBy(*_ALIKE, "p").agg(
        F.floor(expected).alias("sure"), (expected - F.floor(expected)).alias("rest")
    )
    groups = stored(groups.drop("p"), "alike")
    decided = included(groups.where(_undecided("rest")).select(*_ALIKE, F.col("rest").alias("p")))
    more = F.coalesce("d.p", F.round("g.rest")).cast("long")
    taken = groups.alias("g").join(decided.alias("d"), _same("g", "d"), "left").select(
        *[f"g.{c}" for c in _ALIKE], (F.col("g.sure") + more).alias("taken")
    )
    # The first of the alike take what the group takes: part by part, so that none is one task's.
    before = Window.partitionBy(*_ALIKE).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("c").over(before), F.lit(0)))
    quota = F.least("p.c", F.col("t.taken") - F.col("p.before"))
    shares = parts.alias("p").join(taken.alias("t"), _same("p", "t")).select(
        *[f"p.{c}" for c in _ALIKE], "p.part", quota.alias("quota")
    )
    rank = Window.partitionBy(*_ALIKE, "part").orderBy("at")
    open_ = joined.where(_undecided("p")).withColumn("k", F.row_number().over(rank))
    chosen = open_.alias("j").join(shares.alias("s"), _same("j", "s", "part")).select(
        "j.*", (F.col("j.whole") + (F.col("j.k") <= F.col("s.quota")).cast("long")).alias("copies")
    )
    return chosen.drop("k").union(certain).drop("whole", "p", "h", "at", "part")


def mix_documents(docs: DataFrame, **settings) -> DataFrame:
    """doc_id, size, source_size, target, taken of each document.

    Missing text has size 0, missing source is a source of its own, the last one. Repeated
    rows are documents of their own. An empty table gives an empty table.
    """
    units = docs.select(
        F.col("doc_id").cast("long").alias("key"), F.xxhash64("doc_id", text_of()).alias("h"),
        "source", n_words().alias("size"),
    )
    out = mixed_units(units, **settings)
    return out.select(
        F.col("key").alias("doc_id"), "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def mixed_rows(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    name = fresh(docs.columns, "mix_row")
    rows = numbered(docs, name, "mix-rows")
    units = rows.select(
        F.col("doc_id").cast("long").alias("key"), F.xxhash64("doc_id", text_of()).alias("h"),
        "source", n_words().alias("size"), F.col(name).alias("row"),
    )
    copies = mixed_units(units, **settings).where("copies > 0")
    copies = copies.select(F.col("row").alias(name), "copies")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    joined = rows.join(copies, name)
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return joined.select(*columns, again.alias(fresh(docs.columns, "copy"))).select(*columns)
