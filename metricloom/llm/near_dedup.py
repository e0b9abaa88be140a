"""MinHash near-dedup: b-bit signatures, band candidates, links confirmed on full sets.

Steps, each over all rows:

1. One pass over the texts gives, per row, a digest of its word sequence, the size of its
   shingle set, a signature of the low bits of its minima, and band keys of full minima.
   Rows of equal digest are one class; from here on only classes are compared.
2. The classes of a band bucket are paired with the first class of the bucket: a star, so
   that work is linear in the bucket. The signatures' bit counts, corrected for chance
   agreement, drop pairs that are far apart; the rest is confirmed on the full sets.
3. Classes that are linked already need no further comparison. In buckets that still hold
   more than one component, all classes outside the largest component are compared with
   all of the bucket, in blocks of a bounded number of signatures and on longer
   signatures, again with confirmation. So no link is lost to the star. A pair that
   shares several buckets is compared in the first of them only.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from metricloom.llm.common import Ranges, fresh, mixed, small_batches, stored, text_of, word_bounds
from metricloom.llm.components import components

SHINGLE = 5
BANDS, ROWS = 30, 5
#: Low bits kept of each minimum.
BITS = 4
#: Minima of the longer signatures, made for classes in unresolved buckets only.
LONG = 1024
#: Standard deviations of the estimate by which a pair may miss the threshold and still
#: be confirmed on the full sets.
MARGIN = 5.0
#: Classes in a block of signatures.
BLOCK = 512
_K = BANDS * ROWS
_PART = 1 << 16


def _permutations(k: int) -> tuple[np.ndarray, np.ndarray]:
    steps = mixed(np.arange(1, 2 * k + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    steps = (steps >> np.uint64(32)).astype(np.uint32)
    return steps[:k] | np.uint32(1), steps[k:]


def shingle_hashes(raw: bytes, ranges: Ranges) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a text, all of it.

    Long texts are read in parts that overlap by a shingle, so that memory stays bounded.
    """
    words = raw.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    size = min(SHINGLE, len(words))
    found = []
    for at in range(0, len(words) - size + 1, _PART):
        part = b" ".join(words[at : at + _PART + size - 1])
        units = np.frombuffer(part, np.uint8)
        start, end = word_bounds(units)
        n = start.size - size + 1
        found.append(np.unique(ranges.hashes(units, start[:n], end[size - 1 :])))
    return found[0] if len(found) == 1 else np.unique(np.concatenate(found))


def minima(hashes: np.ndarray, mult: np.ndarray, add: np.ndarray) -> np.ndarray:
    """The least value of each permutation over a set of shingles."""
    least = np.full(mult.size, np.iinfo(np.uint32).max, np.uint32)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    part = max(1, 65_536 // mult.size)
    for at in range(0, short.size, part):  # a part that stays in the processor's cache
        values = short[at : at + part, None] * mult
        values += add
        np.minimum(least, values.min(axis=0), out=least)
    return least.astype(np.uint64)


def _packed(least: np.ndarray) -> bytes:
    """The low bits of the (mixed) minima, one plane of bits after another."""
    low = mixed(least) & np.uint64((1 << BITS) - 1)
    planes = [np.packbits((low >> np.uint64(k)) & np.uint64(1) == 1) for k in range(BITS)]
    return np.concatenate(planes).tobytes()


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ranges, (mult, add) = Ranges(), _permutations(_K)
    band_salt = mixed(np.arange(1, BANDS + 1, dtype=np.uint64))
    for batch in batches:
        classes, sizes, signs, bands, known = [], [], [], [], {}
        for raw in batch.column(2).to_pylist():
            key = hashlib.blake2b(b" ".join(raw.lower().split()), digest_size=16).digest()
            if key not in known:
                hashes = shingle_hashes(raw, ranges)
                if hashes.size:
                    least = minima(hashes, mult, add)
                    keys = np.zeros(BANDS, np.uint64)
                    for row in least.reshape(BANDS, ROWS).T:
                        keys = mixed(keys * np.uint64(31) + row)
                    known[key] = (hashes.size, _packed(least), (keys + band_salt).view(np.int64))
                else:
                    known[key] = (0, None, None)
            size, sign, band = known[key]
            classes.append(key)
            sizes.append(size)
            signs.append(sign)
            bands.append(band)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), batch.column(1), pa.array(classes, pa.binary()),
                pa.array(sizes, pa.int64()), pa.array(signs, pa.binary()),
                pa.array(bands, pa.list_(pa.int64())),
            ],
            ["doc_id", "tag", "class", "n_shingles", "sign", "bands"],
        )


_SIGNATURES = (
    "doc_id bigint, tag bigint, class binary, n_shingles bigint, sign binary, bands array<bigint>"
)


def _agreement(a: np.ndarray, b: np.ndarray, k: int) -> np.ndarray:
    """How many of ``k`` minima agree in all their kept bits."""
    plane = a.shape[-1] // BITS
    differ = np.zeros(np.broadcast_shapes(a.shape, b.shape)[:-1] + (plane,), np.uint8)
    for at in range(0, BITS * plane, plane):
        differ |= a[..., at : at + plane] ^ b[..., at : at + plane]
    return k - np.bitwise_count(differ).sum(-1, dtype=np.int64)


def estimate(agree: np.ndarray, k: int) -> np.ndarray:
    """Similarity from agreements: unequal minima agree in their low bits by chance."""
    chance = 0.5**BITS
    return (agree / k - chance) / (1 - chance)


def least_estimate(percent: int, k: int) -> float:
    """Estimates below this are more than ``MARGIN`` deviations under the threshold."""
    chance = 0.5**BITS
    p = percent / 100 * (1 - chance) + chance
    return percent / 100 - MARGIN * math.sqrt(p * (1 - p) / k) / (1 - chance)


def _planes(signs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(signs), np.uint8).reshape(len(signs), -1)


def _estimated(least: float):
    """(a, b, sign_a, sign_b) to the pairs (a, b) that may reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (_planes(batch.column(i).to_pylist()) for i in (2, 3))
                near = pa.array(estimate(_agreement(a, b, _K), _K) >= least)
                yield batch.select([0, 1]).filter(near)

    return run


def _block_pairs(least: float):
    """A band key and two blocks of its bucket to the pairs between them that may be links.

    Each block has nodes, roots, long signatures and all band keys of its members.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                band = batch.column(0)[i].as_py()
                a, a_root, b, b_root = (batch.column(k)[i].values.to_numpy() for k in (1, 2, 5, 6))
                a_sign, b_sign = (_planes(batch.column(k)[i].as_py()) for k in (3, 7))
                a_keys, b_keys = (
                    batch.column(k)[i].values.flatten().to_numpy().reshape(-1, BANDS) for k in (4, 8)
                )
                for node, root, sign, keys in zip(a, a_root, a_sign, a_keys, strict=True):
                    shared = b_keys == keys
                    here = (keys[shared.argmax(1)] == band) & shared.any(1) & (b_root != root)
                    other, others = b[here], b_sign[here]
                    other = other[estimate(_agreement(others, sign, LONG), LONG) >= least]
                    if other.size:
                        ends = np.minimum(other, node), np.maximum(other, node)
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in ends], ["a", "b"])

    return run


def _sets(long: bool):
    """(node, text) to its shingle set, with the long signature if asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges, (mult, add) = Ranges(), _permutations(LONG)
        for batch in batches:
            found = [shingle_hashes(x, ranges) for x in batch.column(1).to_pylist()]
            signs = [_packed(minima(x, mult, add)) if long else None for x in found]
            arrays = [pa.array([x.tobytes() for x in found], pa.binary()), pa.array(signs, pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *arrays], ["node", "shingles", "long"]
            )

    return run


def _confirmed(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if 100 * min(a.size, b.size) < percent * max(a.size, b.size):
                    linked.append(False)
                    continue
                if a.size > b.size:
                    a, b = b, a
                at = np.minimum(np.searchsorted(b, a), b.size - 1)
                common = int((b[at] == a).sum())
                linked.append(100 * common >= percent * (a.size + b.size - common))
            yield batch.select([0, 1]).filter(pa.array(linked, pa.bool_()))

    return run


def _fetched(docs: DataFrame, classes: DataFrame, nodes: DataFrame, long: bool) -> DataFrame:
    """(node, shingles, long): the full sets of some classes, from the texts of their first rows."""
    wanted = classes.join(nodes, "node", "left_semi").select("node", "at").alias("w")
    at = F.col("w.at")
    same = F.col("d.doc_id").eqNullSafe(at["doc_id"]) & (F.col("d.tag") == at["tag"])
    texts = docs.alias("d").join(wanted, same).select("w.node", "d.body")
    sets = texts.mapInArrow(_sets(long), "node bigint, shingles binary, long binary")
    # Repeated rows of one id and text give equal sets: one of them is enough.
    return stored(sets, "sets").dropDuplicates(["node"])


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that are links on their full sets."""
    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(a, "a").join(b, "b").select("a", "b", "sa", "sb")
    return stored(both.mapInArrow(_confirmed(percent), "a bigint, b bigint"), "confirmed")


def near_groups(docs: DataFrame, percent: int = 85) -> DataFrame:
    """(row, doc_id, tag, n_shingles, node, root) of each row of ``docs`` (doc_id, tag, body).

    ``root`` is the smallest class that the row's class reaches over links of similarity
    ``percent`` or more; it is missing for rows without a word.
    """
    rows = docs.mapInArrow(_signatures, _SIGNATURES)
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "signatures")
    classes = (
        rows.where("n_shingles > 0").groupBy("class")
        .agg(
            F.min("row").alias("node"),
            F.min_by(F.struct("doc_id", "tag"), "row").alias("at"),
            F.first("sign").alias("sign"), F.first("bands").alias("bands"),
        )
    )
    classes = stored(classes, "classes")
    members = classes.select("node", F.explode("bands").alias("band"))
    buckets = members.groupBy("band").agg(
        F.min("node").alias("first"), F.count(F.lit(1)).alias("c")
    ).where("c > 1")
    met = stored(members.join(buckets, "band"), "buckets")
    star = met.where("node != first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    signs = classes.select("node", "sign")
    sa = signs.select(F.col("node").alias("a"), F.col("sign").alias("sa"))
    sb = signs.select(F.col("node").alias("b"), F.col("sign").alias("sb"))
    paired = star.distinct().join(sa, "a").join(sb, "b").select("a", "b", "sa", "sb")
    pairs = stored(paired.mapInArrow(_estimated(least_estimate(percent, _K)), "a bigint, b bigint"), "pairs")
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    links = _links(pairs, _fetched(docs, classes, ends, False), percent)
    label = components(links)

    rooted = met.join(label, "node", "left").select(
        "band", "node", "c", F.coalesce("root", "node").alias("root")
    )
    parts = rooted.groupBy("band", "root").agg(F.count(F.lit(1)).alias("size"))
    open_ = parts.groupBy("band").agg(
        F.max_by("root", F.struct("size", "root")).alias("main"), F.count(F.lit(1)).alias("parts")
    ).where("parts > 1").drop("parts")
    rest = stored(rooted.join(open_, "band"), "open")
    sets = _fetched(docs, classes, rest.select("node").distinct(), True)
    known = sets.select("node", "long").join(classes.select("node", "bands"), "node")
    rest = rest.join(known, "node")
    block = F.pmod(F.xxhash64("node"), F.ceil(F.col("c") / BLOCK)).alias("block")
    gathered = F.sort_array(F.collect_list(F.struct("node", "root", "long", "bands"))).alias("m")
    columns = ["m.node", "m.root", "m.long", "m.bands"]
    whole = rest.groupBy("band", block).agg(gathered)
    whole = whole.select("band", *[F.col(c).alias(f"b{i}") for i, c in enumerate(columns)])
    outside = rest.where("root != main").groupBy("band", block).agg(gathered)
    outside = outside.select("band", *[F.col(c).alias(f"a{i}") for i, c in enumerate(columns)])
    tested = outside.join(whole, "band").select(
        "band", *[f"{side}{i}" for side in "ab" for i in range(4)]
    )
    more = tested.mapInArrow(_block_pairs(least_estimate(percent, LONG)), "a bigint, b bigint")
    more = stored(more.distinct().join(pairs, ["a", "b"], "left_anti"), "more")
    if not more.isEmpty():
        links = links.union(_links(more, sets, percent))
        label = components(links)
    named = classes.join(label, "node", "left").select(
        "class", "node", F.coalesce("root", "node").alias("root")
    )
    plain = rows.select("row", "doc_id", "tag", "n_shingles", "class")
    return plain.join(named, "class", "left").drop("class")


def _prepared(docs: DataFrame) -> DataFrame:
    small_batches(docs)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("tag"),
        text_of().cast("binary").alias("body"),
    )


def near_components(docs: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row.

    A row without a word has an empty set, is linked with nothing and is its own
    component. ``component_id`` is the smallest ``doc_id`` reachable; missing ids are
    passed over, unless the component has no other. Rows may repeat an id: each is judged
    by its own text. An empty table gives an empty table.
    """
    found = stored(near_groups(_prepared(docs), percent), "groups")
    least = found.where("root is not null").groupBy("root").agg(
        F.min("doc_id").alias("component_id")
    )
    joined = found.join(least, "root", "left")
    component = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def keep_one_of_each(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row of the
    smallest ``doc_id`` stays (missing ids last, then by a hash of the text). Rows that
    agree in id and text are one document, of which one row stays."""
    found = near_groups(_prepared(docs), percent).where("root is not null")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("tag"))
    best = found.groupBy("root").agg(
        F.min_by(F.struct("doc_id", "tag"), order).alias("k")
    ).select("k.*").alias("k")
    name = fresh(docs.columns, "near_tag")
    tagged = docs.withColumn(name, F.xxhash64(text_of())).alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col(f"d.{name}") == F.col("k.tag"))
    columns = [F.col(f"d.`{c}`") for c in docs.columns]
    worded = text_of().rlike(r"[^\x20\x09-\x0D]")
    kept = tagged.where(worded).join(best, same, "left_semi")
    kept = kept.dropDuplicates(["doc_id", name]).select(*columns)
    return kept.unionByName(docs.where(~worded))
