"""Alignment of two tokenizers' tokens over the same bytes.

Both sides cut the same bytes, so every token start lies inside exactly one token of the
other side. In each batch, an as-of merge keyed by document finds that covering token, once
in either direction; the union of both directions holds all overlapping pairs. Where the
two tokens of a pair end together, both sides agree on a border: those pairs are the links,
and their ends cut a document into groups.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from metricloom.llm.byte_level import Encode, byte_characters as _byte_characters, is_plain, quick, token_bytes
from metricloom.llm.common import fresh, light, small_batches, stored

#: Bytes of text whose tokens are merged at once; a longer document is merged on its own.
SLICE = 1 << 20

class Side:
    """One tokenizer: how it encodes texts, and the bytes of each of its ids.

    Begin, end and special tokens are never added, and their strings inside texts are plain
    text. Sentence pieces put a space before the text themselves; for byte-level files the
    space is part of the text here, so that both sides cut the same bytes.
    """

    def __init__(self, path: str) -> None:
        self.encode, self.bytes = _json_side(path) if path.endswith(".json") else _model_side(path)
        self.sizes = np.array([len(x) for x in self.bytes], np.int64)
        #: The ids as texts, with the mark that follows them: inside and at the end of the
        #: left or the right side of a group.
        self.marked = {m: np.array([f"{i}{m}" for i in range(len(self.bytes))], object) for m in ",|;"}


def _model_side(path: str) -> tuple[Encode, list[bytes]]:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    table = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        table.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
    return lambda texts: model.encode(texts, num_threads=1), table


def _json_side(path: str) -> tuple[Encode, list[bytes]]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    if (spec.get("decoder") or {}).get("type") != "ByteLevel":
        raise ValueError(f"{path} is not a byte-level vocabulary")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    tokenizer.no_truncation()
    tokenizer.no_padding()
    table = token_bytes(tokenizer)

    def library(texts: list[str]) -> list[list[int]]:
        return [x.ids for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    encode = quick(spec, table, library) if is_plain(spec) else library
    return lambda texts: encode([" " + x for x in texts]), table


class Tokens:
    """The tokens of one side over a slice of documents, one after the other."""

    def __init__(self, side: Side, ids: list[list[int]], base: np.ndarray) -> None:
        self.counts = np.array([len(x) for x in ids], np.int64)
        self.ids = np.fromiter((i for x in ids for i in x), np.int64, int(self.counts.sum()))
        self.first = np.concatenate(([0], np.cumsum(self.counts)))
        self.doc = np.repeat(np.arange(len(ids)), self.counts)
        sizes = side.sizes[self.ids]
        # Documents follow each other without a gap, so a running sum of sizes is the place.
        self.end = np.cumsum(sizes)
        self.start = self.end - sizes
        self.base = base

    def frame(self, name: str) -> pd.DataFrame:
        return pd.DataFrame({"at": self.start, "doc": self.doc, name: np.arange(self.ids.size)})


def overlapping(a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Indexes (into a, into b) of all pairs of tokens that share a byte, by document and place."""
    left, right = a.frame("a"), b.frame("b")
    covered = pd.merge_asof(left, right, on="at", by="doc")
    covering = pd.merge_asof(right, left, on="at", by="doc")
    # A pair that starts together is found in both directions; it is taken from the first.
    later = b.start != a.start[covering["a"].to_numpy()] if len(right) else np.zeros(0, bool)
    i = np.concatenate((covered["a"].to_numpy(np.int64), covering["a"].to_numpy(np.int64)[later]))
    j = np.concatenate((covered["b"].to_numpy(np.int64), covering["b"].to_numpy(np.int64)[later]))
    order = np.lexsort((j, i))
    return i[order], j[order]


def _slices(texts: list[str | None]) -> Iterator[range]:
    start, size = 0, 0
    for i, x in enumerate(texts):
        here = len(x or "")
        if size and size + here > SLICE:
            yield range(start, i)
            start, size = i, 0
        size += here
    yield range(start, len(texts))


def _tokens(texts: list[str | None], a: Side, b: Side) -> tuple[Tokens, Tokens]:
    """Tokens of both sides; texts that a side does not give back byte by byte have none."""
    some = [i for i, x in enumerate(texts) if x]
    full = [texts[i] for i in some]
    ids_a: list[list[int]] = [[] for _ in texts]
    ids_b: list[list[int]] = [[] for _ in texts]
    size = np.zeros(len(texts), np.int64)
    for i, x, y in zip(some, a.encode(full), b.encode(full), strict=True):
        body = b" " + texts[i].encode()
        if b"".join([a.bytes[t] for t in x]) == body and b"".join([b.bytes[t] for t in y]) == body:
            ids_a[i], ids_b[i], size[i] = x, y, len(body)
    base = np.cumsum(size) - size
    return Tokens(a, ids_a, base), Tokens(b, ids_b, base)


def _group_texts(a: Tokens, b: Tokens, ends_a: np.ndarray, ends_b: np.ndarray, left: Side, right: Side) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` per document, from the flags of tokens that end a group."""
    before_a = np.cumsum(ends_a) - ends_a  # groups closed before each token
    before_b = np.cumsum(ends_b) - ends_b
    # A group's tokens of a stand before its tokens of b, behind all of earlier groups.
    closed_a = np.concatenate(([0], np.flatnonzero(ends_a) + 1))  # tokens of a in the first k groups
    closed_b = np.concatenate(([0], np.flatnonzero(ends_b) + 1))
    out = np.empty(a.ids.size + b.ids.size, object)
    out[np.arange(a.ids.size) + closed_b[before_a]] = np.where(ends_a, left.marked["|"][a.ids], left.marked[","][a.ids])
    out[np.arange(b.ids.size) + closed_a[before_b + 1]] = np.where(ends_b, right.marked[";"][b.ids], right.marked[","][b.ids])
    cuts = a.first + b.first
    return ["".join(out[x:y])[:-1] for x, y in zip(cuts, cuts[1:])]


_LINK = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int32())]))
_MADE = T.StructType(
    [
        T.StructField("n_a", T.LongType()),
        T.StructField("n_b", T.LongType()),
        T.StructField("n_groups", T.LongType()),
        T.StructField("n_links", T.LongType()),
        T.StructField("groups", T.StringType()),
        T.StructField("links", T.ArrayType(T.StructType([T.StructField(c, T.IntegerType()) for c in "abn"]))),
    ]
)


def _align(left: str, right: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = Side(left), Side(right)
        width = len(sides[1].bytes)
        for batch in batches:
            body = batch.column(batch.num_columns - 1).to_pylist()
            for rows in _slices(body):
                a, b = _tokens([body[i] for i in rows], *sides)
                i, j = overlapping(a, b)
                together = a.end[i] == b.end[j]
                i, j = i[together], j[together]
                ends_a, ends_b = np.zeros(a.ids.size, bool), np.zeros(b.ids.size, bool)
                ends_a[i], ends_b[j] = True, True
                doc, code = a.doc[i], a.ids[i] * width + b.ids[j]
                n_links = np.bincount(doc, minlength=len(rows))
                # Equal pairs of a document, counted.
                order = np.lexsort((code, doc))
                doc, code = doc[order], code[order]
                new = np.ones(code.size, bool)
                new[1:] = (doc[1:] != doc[:-1]) | (code[1:] != code[:-1])
                at = np.flatnonzero(new)
                times = np.diff(np.append(at, code.size))
                offsets = np.concatenate(([0], np.cumsum(np.bincount(doc[at], minlength=len(rows)))))
                links = pa.StructArray.from_arrays(
                    [pa.array(x.astype(np.int32)) for x in (code[at] // width, code[at] % width, times)],
                    fields=list(_LINK.value_type),
                )
                made = [
                    pa.array(a.counts), pa.array(b.counts),
                    pa.array(np.bincount(a.doc[ends_a], minlength=len(rows))), pa.array(n_links),
                    pa.array(_group_texts(a, b, ends_a, ends_b, *sides), pa.string()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), links),
                ]
                kept = batch.slice(rows.start, len(rows)).columns[:-1]
                yield pa.RecordBatch.from_arrays([*kept, *made], [*batch.schema.names[:-1], *_MADE.names])

    return run


def align(docs: DataFrame, left: str, right: str, keep: Sequence[str] = ("doc_id",), *, text: str = "text") -> DataFrame:
    """The columns ``keep`` and the alignment of each whole text by two tokenizer files.

    ``n_a``, ``n_b``: tokens of either side. ``n_groups``; ``groups``: the ids of each group,
    as ``a1,a2|b1;a3|b2,b3``. ``n_links``; ``links``: the distinct id pairs (a, b) that end
    together, with how often. The left file is a byte-level ``.json``, a ``.model`` may stand
    on either side.

    Missing and empty texts, and texts that a side does not give back byte by byte, have no
    tokens. Repeated rows each get their row, an empty table gives an empty table. A ``keep``
    named like an output is refused. A task holds the tokens of ``SLICE`` bytes, or of one
    longer document.
    """
    clash = {c.lower() for c in keep} & set(_MADE.names)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are made here; rename them first")
    small_batches(docs)
    kept = docs.select(*keep)
    schema = T.StructType([*kept.schema.fields, *_MADE.fields])
    return docs.select(*keep, F.col(text).alias(fresh(keep, "body"))).mapInArrow(_align(left, right), schema)


def _overlaps(left: str, right: str, kept: T.StructType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = Side(left), Side(right)
        for batch in batches:
            body = batch.column(batch.num_columns - 1).to_pylist()
            for rows in _slices(body):
                a, b = _tokens([body[i] for i in rows], *sides)
                i, j = overlapping(a, b)
                doc = a.doc[i]
                own = batch.slice(rows.start, len(rows)).take(pa.array(doc)).columns[:-1]
                made = [
                    i - a.first[doc], a.ids[i], a.start[i] - a.base[doc], a.end[i] - a.base[doc],
                    j - b.first[doc], b.ids[j], b.start[j] - b.base[doc], b.end[j] - b.base[doc],
                ]
                yield pa.RecordBatch.from_arrays(
                    [*own, *[pa.array(x.astype(np.int64)) for x in made]],
                    [*batch.schema.names[:-1], *PAIR],
                )

    return run


PAIR = ["a_at", "a_id", "a_start", "a_end", "b_at", "b_id", "b_start", "b_end"]


def overlaps(docs: DataFrame, left: str, right: str, keep: Sequence[str] = ("doc_id",), *, text: str = "text") -> DataFrame:
    """One row per pair of tokens that share a byte: ``keep``, and place, id and byte range of both.

    Bytes count from the space before the text. Odd rows and names are treated as in ``align``.
    """
    clash = {c.lower() for c in keep} & set(PAIR)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are made here; rename them first")
    small_batches(docs)
    kept = docs.select(*keep).schema
    schema = T.StructType([*kept.fields, *[T.StructField(c, T.LongType()) for c in PAIR]])
    return docs.select(*keep, F.col(text).alias(fresh(keep, "body"))).mapInArrow(_overlaps(left, right, kept), schema)


def score_links(aligned: DataFrame) -> DataFrame:
    """``aligned`` without its links, with ``n_best`` and ``count_sum``.

    A pair's count is how many links of all documents hold it. ``n_best``: links whose
    count is the highest of their right id, ties included; ``count_sum``: the counts of a
    document's links added up. Every row of ``aligned`` keeps its own sums.
    """
    row = fresh(aligned.columns, "row")
    rows = stored(aligned.withColumn(row, F.monotonically_increasing_id()), "aligned")
    links = rows.select(F.col(row).alias("row"), F.inline("links"))
    totals = stored(links.groupBy("a", "b").agg(F.sum(F.col("n").cast("long")).alias("total")), "pair-totals")
    # One row per id of the right vocabulary: some ten thousand at most.
    highest = F.broadcast(totals.groupBy("b").agg(F.max("total").alias("highest")))
    judged = light(totals.join(highest, "b").select("a", "b", "total", (F.col("total") == F.col("highest")).alias("best")), "pair-totals")
    sums = links.join(judged, ["a", "b"]).groupBy(F.col("row").alias(row)).agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).cast("long").alias("n_best"),
        F.sum(F.col("n") * F.col("total")).cast("long").alias("count_sum"),
    )
    return rows.drop("links").join(sums, row, "left").drop(row).fillna(0, ["n_best", "count_sum"])
