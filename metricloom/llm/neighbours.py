"""Approximate nearest neighbours: a neighbour graph by NN-descent, searched greedily.

The graph starts from small exact searches inside buckets of random projections. Nodes of
small buckets also meet those of other small buckets under a shorter code, and every node
meets some random ones, so that rare directions have neighbours too. Then rounds of joins follow: the neighbours of each node, in both directions, are brought together and
compared with one another, because a neighbour of a neighbour is likely to be one. A pair
is only passed on if it beats the worst neighbour its node has so far. A search begins at the
query's own node and at random ones; queries left with too few results are compared with all
nodes. Equal vectors are one node; their rows come back in the result. Rounds work on vectors rounded to bytes, results
on the original ones.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from metricloom.llm.common import stored

#: Neighbours of a node in the graph; as many again from the other direction are compared.
DEGREE = 32
TREES = 5
#: Vectors of a bucket that are compared with each other at the start.
BUCKET = 192
#: Random nodes that meet at the start, and those where a search begins (means of hashed groups).
RANDOM, ENTRIES = 64, 16
#: Queries and nodes of a block in the exact pass.
ASKED_BLOCK, NODE_BLOCK = 64, 256
ROUNDS = 7
#: A round that replaces no more than this share of the edges is the last one.
LEAST_NEW = 0.05
#: Nodes kept for a query, and how many of them are expanded in a step.
BEAM, EXPAND = 160, 80
STEPS = 6


def usable(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec): rows with an id and a vector of finite numbers, not all zero.

    Vectors of another length than the most frequent one (of several: the longest) take no
    part; rows that agree in id and vector are one.
    """
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = (
        rows.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"))
        .where("id is not null and vec is not null")
        .where(~bad & F.exists("vec", lambda x: x != 0))
    )
    sizes = good.groupBy(F.size("vec").alias("d")).count()
    usual = sizes.agg(F.max_by("d", F.struct("count", "d")).alias("d")).first()["d"] or 0
    return good.where(F.size("vec") == usual).dropDuplicates(["id", "vec"])


def _matrix(column: pa.ListArray) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _prepared(trees: int, bits: int, dims: int, largest: float):
    """(node, vec) to (node, vec, bytes, bucket codes).

    The bytes are the length of the vector as a share of ``largest``, the largest
    component of all, in double precision, and its direction in steps of 1/127 of its own
    largest component, so that no finite vector is out of range.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = np.random.default_rng(7).standard_normal((dims, trees * bits))
        weight = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1)).astype(np.float64)
            most = np.abs(x).max(1, keepdims=True)
            x = x / most
            small = np.rint(x * 127).astype(np.int8)
            length = (most / largest) * np.sqrt((x * x).sum(1, keepdims=True))
            packed = np.concatenate([length.view(np.int8), small], axis=1)
            above = (x @ planes > 0).reshape(len(x), trees, bits)
            codes = (above @ weight).tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1),
                    pa.array([r.tobytes() for r in packed], pa.binary()),
                    pa.array(codes, pa.list_(pa.int64())),
                ],
                ["node", "vec", "q", "codes"],
            )

    return run


def _unpacked(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Directions of length 1, and the lengths.

    What is near to a vector depends on its direction alone; so similarities are products
    of a direction with whole vectors, and a vector's own length can't take them out of range.
    """
    rows = np.frombuffer(b"".join(raw), np.int8).reshape(len(raw), -1)
    length = np.ascontiguousarray(rows[:, :8]).view(np.float64)[:, 0]
    direction = rows[:, 8:].astype(np.float32)
    return direction / np.sqrt((direction * direction).sum(1, keepdims=True)), length


def _compared(keep: int):
    """(ids, bytes, worst) of a group to (node, nbr, sim): each node's best of the group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, nbr, sim = [], [], []
            for i in range(batch.num_rows):
                ids = batch.column(0)[i].values.to_numpy()
                if ids.size < 2:
                    continue
                x, length = _unpacked(batch.column(1)[i].as_py())
                worst = batch.column(2)[i].values.to_numpy()
                s = (x @ x.T) * length
                np.fill_diagonal(s, -np.inf)
                s[s <= worst[:, None]] = -np.inf
                if ids.size - 1 > keep:
                    best = np.argpartition(-s, keep - 1, axis=1)[:, :keep]
                else:
                    best = np.tile(np.arange(ids.size), (ids.size, 1))
                value = np.take_along_axis(s, best, 1)
                a, b = np.nonzero(np.isfinite(value))
                node.append(ids[a])
                nbr.append(ids[best[a, b]])
                sim.append(value[a, b])
            none = np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([none.astype(np.int64), *node])),
                    pa.array(np.concatenate([none.astype(np.int64), *nbr])),
                    pa.array(np.concatenate([none, *sim])),
                ],
                ["node", "nbr", "sim"],
            )

    return run


_EDGES = "node bigint, nbr bigint, sim double"


def _best(edges: DataFrame, degree: int) -> DataFrame:
    order = Window.partitionBy("node").orderBy(F.col("sim").desc(), "nbr")
    unique = edges.groupBy("node", "nbr").agg(F.max("sim").alias("sim"), F.min("born").alias("born"))
    return unique.withColumn("r", F.row_number().over(order)).where(F.col("r") <= degree).drop("r")


def _both_ways(graph: DataFrame, degree: int) -> DataFrame:
    """(node, nbr): the neighbours of a node and the nearest of those it is a neighbour of."""
    turned = graph.select(F.col("nbr").alias("node"), F.col("node").alias("nbr"), "sim")
    order = Window.partitionBy("node").orderBy(F.col("sim").desc(), "nbr")
    turned = turned.withColumn("r", F.row_number().over(order)).where(F.col("r") <= degree)
    return graph.select("node", "nbr").union(turned.select("node", "nbr")).distinct()


def _meeting(counts: DataFrame, bits: int, degree: int) -> DataFrame:
    """(tree, code, level, key, total): the groups that the nodes of each (tree, code, c) join.

    All join their own bucket. Buckets too small to fill the neighbours of a node also join
    the other small ones with the same first half of the code; where these are still too
    few, all such buckets of the tree join.
    """
    wide = F.shiftright("code", bits - bits // 2)
    small = counts.where(F.col("c") <= degree).select("tree", "code", wide.alias("wide"), "c")
    sums = small.groupBy("tree", "wide").agg(F.sum("c").alias("n"))
    few = small.join(sums, ["tree", "wide"]).where(F.col("n") <= degree)
    rows = counts.select("tree", "code", F.lit(0).alias("level"), F.col("code").alias("key"), "c")
    rows = rows.union(small.select("tree", "code", F.lit(1), "wide", "c"))
    rows = rows.union(few.select("tree", "code", F.lit(2), F.lit(0).cast("long"), "c"))
    totals = rows.groupBy("tree", "level", "key").agg(F.sum("c").alias("total"))
    return rows.drop("c").join(totals, ["tree", "level", "key"])


def build_graph(nodes: DataFrame, bits: int, degree: int = DEGREE, rounds: int = ROUNDS) -> DataFrame:
    """(node, nbr, sim, born: its round) of the graph over the stored (node, q, codes of ``bits`` bits)."""
    chance = F.pmod(F.xxhash64("node", F.lit("start")), F.lit(math.ceil(max(1, nodes.count()) / RANDOM)))
    codes = F.concat("codes", F.array(chance))
    spread = nodes.select("node", "q", F.posexplode(codes).alias("tree", "code"))
    placed = spread.join(_meeting(spread.groupBy("tree", "code").agg(F.count(F.lit(1)).alias("c")), bits, degree), ["tree", "code"])
    part = F.pmod(F.xxhash64("node", "tree", "level"), F.ceil(F.col("total") / BUCKET)).alias("part")
    placed = placed.select("tree", "level", "key", part, "node", "q")
    groups = placed.groupBy("tree", "level", "key", "part").agg(F.collect_list(F.struct("node", "q")).alias("m"))
    lowest = F.transform("m.node", lambda x: F.lit(-math.inf))
    start = groups.select("m.node", "m.q", lowest.alias("w")).mapInArrow(_compared(degree), _EDGES)
    graph = stored(_best(start.withColumn("born", F.lit(0)), degree), "graph")
    for at in range(1, rounds + 1):
        worst = graph.groupBy("node").agg(
            F.when(F.count(F.lit(1)) >= degree, F.min("sim"))
            .otherwise(F.lit(-math.inf)).alias("w")
        )
        known = nodes.select("node", "q").join(worst, "node", "left").select(
            F.col("node").alias("nbr"), "q", F.coalesce("w", F.lit(-math.inf)).alias("w")
        )
        met = _both_ways(graph, degree).join(known, "nbr")
        groups = met.groupBy("node").agg(F.collect_list(F.struct("nbr", "q", "w")).alias("m"))
        found = groups.select("m.nbr", "m.q", "m.w").mapInArrow(_compared(degree // 2), _EDGES)
        graph = stored(_best(graph.union(found.withColumn("born", F.lit(at))), degree), "graph")
        new, edges = graph.agg(F.count(F.when(F.col("born") == at, 1)), F.count(F.lit(1))).first()
        if new <= LEAST_NEW * edges:
            break
    return graph


def _scored(keep: int):
    """(query, its bytes, ids, bytes) to the query's best nodes, on the rounded vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            queries, nodes, scores = [], [], []
            for i in range(batch.num_rows):
                ids = batch.column(2)[i].values.to_numpy()
                x, length = _unpacked(batch.column(3)[i].as_py())
                score = (x @ _unpacked([batch.column(1)[i].as_py()])[0][0]) * length
                best = np.lexsort((ids, -score))[:keep]
                queries.append(np.full(best.size, batch.column(0)[i].as_py()))
                nodes.append(ids[best])
                scores.append(score[best])
            none = np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([none.astype(np.int64), *queries])),
                    pa.array(np.concatenate([none.astype(np.int64), *nodes])),
                    pa.array(np.concatenate([none, *scores])),
                ],
                ["query", "node", "score"],
            )

    return run


def _exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(query, node, vector, vector) to the inner product in double precision."""
    for batch in batches:
        if batch.num_rows:
            a, b = (_matrix(batch.column(i)).astype(np.float64) for i in (2, 3))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array((a * b).sum(1))], ["query", "node", "score"]
            )


def _all_scored(keep: int):
    """(queries, vectors, nodes, vectors) of two blocks to the best nodes of each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            queries, nodes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for i in range(batch.num_rows):
                asked, q, ids, x = (batch.column(j)[i].values for j in range(4))
                asked, ids = asked.to_numpy(), ids.to_numpy()
                scores = _matrix(q).astype(np.float64) @ _matrix(x).astype(np.float64).T
                for query, row in zip(asked, scores, strict=True):
                    best = ids[np.lexsort((ids, -row))[:keep]]
                    queries.append(np.full(best.size, query))
                    nodes.append(best)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(queries)), pa.array(np.concatenate(nodes))], ["query", "node"]
            )

    return run


def compare_all(queries: DataFrame, nodes: DataFrame, keep: int) -> DataFrame:
    """(query, node): at least the ``keep`` best nodes of each (query, qvec) among all (node, vec).

    Block by block. Work is queries times nodes, so only for the few that a search leaves short.
    """

    def blocks(df: DataFrame, name: str, vec: str, size: int) -> DataFrame:
        at = F.pmod(F.xxhash64(name), F.lit(math.ceil(max(1, df.count()) / size)))
        grouped = df.groupBy(at.alias("at")).agg(F.collect_list(F.struct(name, vec)).alias("m"))
        return grouped.select(F.col(f"m.{name}").alias(name), F.col(f"m.{vec}").alias(vec))

    asked = blocks(queries.select("query", "qvec"), "query", "qvec", ASKED_BLOCK)
    pairs = asked.crossJoin(blocks(nodes.select("node", "vec"), "node", "vec", NODE_BLOCK))
    return pairs.mapInArrow(_all_scored(keep), "query bigint, node bigint")


def search(
    nodes: DataFrame, graph: DataFrame, queries: DataFrame, entries: DataFrame,
    beam: int = BEAM, expand: int = EXPAND, steps: int = STEPS,
) -> DataFrame:
    """(query, node): up to ``beam`` nodes per query, from a greedy search.

    ``queries`` has (query, qvec, qq: the vector and its bytes), ``entries`` (query, node) where to begin. In each step the
    ``expand`` nearest nodes not yet expanded are replaced by their neighbours; a query
    ends when its nearest nodes are all expanded.
    """
    links = stored(_both_ways(graph, DEGREE).groupBy("node").agg(F.collect_list("nbr").alias("nbrs")), "adjacency")
    vectors = nodes.select("node", "q")

    def scores(pairs: DataFrame) -> DataFrame:
        rows = pairs.join(vectors, "node").groupBy("query").agg(
            F.collect_list(F.struct("node", "q")).alias("m")
        )
        rows = rows.join(queries.select("query", "qq"), "query").select("query", "qq", "m.node", "m.q")
        return rows.mapInArrow(_scored(beam), "query bigint, node bigint, score double")

    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "node")
    pool = stored(scores(entries.distinct()).withColumn("done", F.lit(False)), "pool")
    for _ in range(steps):
        ranked = pool.withColumn("r", F.row_number().over(order)).where(F.col("r") <= beam)
        front = ranked.where((F.col("r") <= expand) & ~F.col("done"))
        if front.isEmpty():
            break
        reached = front.join(links, "node").select("query", F.explode("nbrs").alias("node")).distinct()
        new = reached.join(pool.select("query", "node"), ["query", "node"], "left_anti")
        seen = ranked.select("query", "node", "score", (F.col("done") | (F.col("r") <= expand)).alias("done"))
        both = seen.union(scores(new).withColumn("done", F.lit(False)))
        cut = both.withColumn("r", F.row_number().over(order)).where(F.col("r") <= beam).drop("r")
        pool = stored(cut, "pool")
    return pool.select("query", "node")


def _with_scores(pool: DataFrame, queries: DataFrame, nodes: DataFrame) -> DataFrame:
    """(query, node, score) of the pairs, on the original vectors."""
    both = pool.select("query", "node").join(queries.select("query", "qvec"), "query")
    both = both.join(nodes.select("node", "vec"), "node").select("query", "node", "qvec", "vec")
    return both.mapInArrow(_exact, "query bigint, node bigint, score double")


def nearest(
    rows: DataFrame, k: int = 20, every: int = 20, *, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of each row whose id is divisible.

    Nearness is the inner product in double precision; ties go to the smaller id. The
    query's own row is no candidate, other rows of an equal vector are. See ``usable``
    for rows that take no part. With few rows, all candidates come back; an empty table
    gives an empty result.
    """
    items = stored(usable(rows, id_col, vec_col), "vectors")
    classes = items.groupBy("vec").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("c"))
    classes = stored(classes, "distinct")
    size = F.array_max(F.transform("vec", lambda x: F.abs(x.cast("double"))))
    n, total, largest = classes.agg(F.count(F.lit(1)), F.sum("c"), F.max(size)).first()
    first = classes.select(F.size("vec").alias("d")).first()
    dims = first["d"] if first else 1
    bits = max(1, math.ceil(math.log2(max(2, n) / 64)))
    kind = classes.schema["vec"].dataType.simpleString()
    nodes = classes.select("node", "vec").mapInArrow(
        _prepared(TREES, bits, dims, largest), f"node bigint, vec {kind}, q binary, codes array<bigint>"
    )
    nodes = stored(nodes, "nodes")
    # The rows of a node; no more than k + 1 of them can be among the k nearest.
    copies = items.join(classes.withColumnRenamed("vec", "v"), F.col("vec") == F.col("v"))
    place = Window.partitionBy("node").orderBy("id")
    copies = copies.select("node", "id").withColumn("at", F.row_number().over(place))
    asked = items.join(classes.withColumnRenamed("vec", "v"), F.col("vec") == F.col("v")).where(
        F.col("id") % every == 0
    )
    asked = stored(asked.select(F.col("id").alias("query"), "vec", "node"), "queries")
    graph = build_graph(nodes, bits)
    own = nodes.select("node", F.col("vec").alias("qvec"), F.col("q").alias("qq"))
    queries = stored(asked.join(own, "node").select("query", "qvec", "qq"), "asked")
    groups = F.lit(math.ceil(max(1, n) / ENTRIES))
    doors = nodes.select("node", F.pmod(F.xxhash64("node", F.lit("entry")), groups).alias("g"))
    drawn = asked.select("query", F.pmod(F.xxhash64("query", F.lit("drawn")), groups).alias("g"))
    entries = asked.select("query", "node").union(drawn.join(doors, "g").select("query", "node"))
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "id")

    def best(pool: DataFrame) -> DataFrame:
        found = _with_scores(pool, queries, nodes).join(copies.where(F.col("at") <= k + 1), "node")
        found = found.where("id != query").withColumn("rank", F.row_number().over(order))
        return found.where(F.col("rank") <= k).select("query", "rank", "id", "score")

    top = stored(best(search(nodes, graph, queries, entries)), "top")
    full = top.groupBy("query").count().where(F.col("count") >= min(k, (total or 0) - 1))
    short = stored(queries.join(full, "query", "left_anti"), "short")
    if not short.isEmpty():
        # Scores may differ in the last place between the two passes, hence more than k + 1.
        exact = best(compare_all(short, nodes, 2 * (k + 1)))
        top = top.join(short.select("query").distinct(), "query", "left_anti").union(exact)
    return top.select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")
