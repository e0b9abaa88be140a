"""SentencePiece encoding and decoding of texts of any length, equal to the library's.

A text of more than ``CHUNK`` characters is cut into chunks that are solved apart. The model
files at hand are of the merging kind (BPE). There, a row of pieces is the encoding of its
text exactly if each two neighbours are the encoding of theirs, and there is one such row.
So an encoding is the best path of an automaton whose states are pieces and whose forbidden
steps score minus infinity, and what a chunk must know of its neighbours is the one piece
over its border: how far it reaches back and ahead. Each chunk has a (sparse) transfer
matrix from the piece over its first border to the piece over its last. Matrices combine by
the max-plus product, which is associative: chunks are combined into blocks, the blocks of
a text are scanned, each block is scanned again, and then every chunk knows its two
borders and is traced back on its own.

No piece has a space mark behind another character, so an encoding always has a border
before the first mark of a run. Between such borders, words are encoded one by one, through
a bounded memo.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from metricloom.llm.common import small_batches, stored, text_of

#: Characters of a chunk; longer texts are spread over tasks.
CHUNK = 16_384
#: Chunks whose matrices are combined in one step.
BLOCK = 64
#: Entries of a memo, and characters of a text that goes into it.
_MEMO, _MEMO_TEXT = 150_000, 64
_MARK = "▁"
_WORDS = re.compile(f"{_MARK}*[^{_MARK}]+|{_MARK}+")
_BORDER = re.compile(f"(?<=[^{_MARK}]){_MARK}")

#: The piece over a border: characters before it and behind it. The first border of a
#: text has none.
State = tuple[int, int]
START: State = (0, 0)
#: Best scores (pieces begun in the chunk) from a state to a state; absent is impossible.
Matrix = dict[State, dict[State, float]]


class Vocabulary:
    """Pieces, scores and ids of a model file."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = {}
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.text: list[bytes] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            special = model.is_control(i) or model.is_unknown(i) or model.is_unused(i)
            if model.is_byte(i):
                self.bytes[int(piece[1:-1], 16)] = i
                self.text.append(bytes([int(piece[1:-1], 16)]))
            else:
                self.text.append(b"" if special else piece.replace(_MARK, " ").encode())
                if not special:
                    self.ids[piece], self.scores[piece] = i, float(model.get_score(i))
        self.unknown_id = model.unk_id()
        self.longest = max(map(len, self.ids))
        inner = [p for p in self.ids if _MARK in p.lstrip(_MARK)]
        if inner:
            raise ValueError(f"pieces span words: {inner[:3]}")
        self._memo: dict[str, list[int]] = {}
        self._fits: dict[tuple[str, str], bool] = {}

    def of(self, piece: str) -> tuple[int, ...]:
        """Ids of a piece, or of the bytes of an uncovered character."""
        known = self.ids.get(piece)
        if known is not None:
            return (known,)
        if not self.bytes:
            return (self.unknown_id,)
        return tuple(self.bytes[b] for b in piece.encode())

    def word(self, text: str) -> list[int]:
        known = self._memo.get(text)
        if known is None:
            # The library puts the first mark in front itself.
            known = self.model.encode(text[1:].replace(_MARK, " ")) or list(self.of(text))
            if len(text) <= _MEMO_TEXT:
                if len(self._memo) >= _MEMO:
                    self._memo.clear()
                self._memo[text] = known
        return known

    def encode(self, text: str) -> list[int]:
        """Ids of a whole normalised text."""
        ids: list[int] = []
        for word in _WORDS.findall(text):
            ids += self.word(word)
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.text[i] for i in ids])

    # -- chunks -------------------------------------------------------------------------

    def merged(self, text: str) -> list[str]:
        """Pieces of a short text: the best-scored neighbours merge first, leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            pairs = [(self.scores.get(a + b), -i) for i, (a, b) in enumerate(pairwise(parts))]
            found = [p for p in pairs if p[0] is not None]
            if not found:
                break
            at = -max(found)[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, a: str, b: str) -> bool:
        """Whether two neighbouring pieces are the encoding of their text (``a`` may be empty)."""
        known = self._fits.get((a, b))
        if known is None:
            if len(self._fits) >= _MEMO:
                self._fits.clear()
            known = self._fits[a, b] = self.merged(a + b) == [x for x in (a, b) if x]
        return known

    def _steps(self, text: str, at: int, last: int) -> Iterator[int]:
        """Ends of the pieces that may follow the piece from ``last`` to ``at``."""
        before = text[last:at]
        for end in range(at + 1, min(at + self.longest, len(text)) + 1):
            piece = text[at:end]
            if (end == at + 1 or piece in self.scores) and self.fits(before, piece):
                yield end

    def _walk(self, text: str, starts: list[tuple[int, int]], stop: int) -> dict:
        """Nodes (begin, end of a piece) reached from pieces that end before ``stop``.

        Each node maps to the node before it; nodes with an end at or behind ``stop`` are
        where a walk ends. A node has one way back: encodings are unique.
        """
        back = {node: None for node in starts}
        todo = sorted(starts, key=lambda node: node[1])
        by_end: dict[int, list[tuple[int, int]]] = {}
        for node in todo:
            by_end.setdefault(node[1], []).append(node)
        for at in range(min(by_end, default=stop), stop):
            for node in by_end.pop(at, ()):
                for end in self._steps(text, at, node[0]):
                    after = (at, end)
                    if after not in back:
                        back[after] = node
                        by_end.setdefault(end, []).append(after)
        return back

    def _way(self, back: dict, node: tuple[int, int]) -> list[tuple[int, int]]:
        way = []
        while node is not None:
            way.append(node)
            node = back[node]
        return way[::-1]

    def _cut(self, text: str, begin: int, stop: int) -> tuple[int, int] | None:
        """First and last certain border behind every possible start of a chunk."""
        found = [m.start() for m in _BORDER.finditer(text, begin + self.longest, stop)]
        return (found[0], found[-1]) if found else None

    def starts(self, text: str, begin: int) -> list[State]:
        """Pieces that may lie over the first border of a chunk."""
        if begin == 0:
            return [START]
        return [
            (i, j)
            for i in range(1, min(self.longest, begin) + 1)
            for j in range(0, self.longest - i + 1)
            if begin + j <= len(text)
            and (i + j == 1 or text[begin - i : begin + j] in self.scores)
            and self.fits("", text[begin - i : begin + j])
        ]

    def transfer(self, text: str, begin: int, stop: int, final: bool) -> Matrix:
        """Matrix of the chunk ``text[begin:stop]``; ``text`` has its surroundings as well."""
        return self.solve(text, begin, stop, final)[0]

    def solve(self, text: str, begin: int, stop: int, final: bool) -> tuple[Matrix, tuple[int, int] | None, list[int]]:
        """The chunk's matrix, its first and last certain border, and the ids between these."""
        cut = self._cut(text, begin, stop)
        inner = self.encode(text[cut[0] : cut[1]]) if cut else []
        middle = len(inner)

        def ends(back: dict) -> dict[State, int]:
            return {
                (stop - a, b - stop): len(self._way(back, (a, b))) - 1
                for a, b in back
                if b >= stop > a and (b == stop or not final)
            }

        out: Matrix = {}
        tail = ends(self._walk(text, [(cut[1], cut[1])], stop)) if cut else {}
        for i, j in self.starts(text, begin):
            first = (begin - i, begin + j)
            if cut is None:
                row = ends(self._walk(text, [first], stop))
            else:
                back = self._walk(text, [first], cut[0])
                heads = [len(self._way(back, x)) - 1 for x in back if x[1] == cut[0]]
                row = {e: n + middle + heads[0] for e, n in tail.items()} if heads else {}
            if row:
                out[i, j] = {e: float(n) for e, n in row.items()}
        return out, cut, inner

    def trace(self, head: str, low: int, high: int, tail: str | None, start: State, end: State) -> tuple[list[int], list[int]]:
        """Ids of the pieces that begin in a chunk between its two known borders: before and behind its middle.

        ``head`` is the text up to the first certain border, with the chunk's start at ``low``;
        ``tail`` the text from the last one on, with the chunk's end at ``high``. Without a
        certain border ``tail`` is missing, and ``head`` is the whole text.
        """
        first, last = (low - start[0], low + start[1]), (high - end[0], high + end[1])

        def ids(way: list[tuple[int, int]], text: str) -> list[int]:
            return [i for a, b in way[1:] for i in self.of(text[a:b])]

        if tail is None:
            return ids(self._way(self._walk(head, [first], high), last), head), []
        back = self._walk(head, [first], len(head))
        border = next(x for x in back if x[1] == len(head))
        behind = self._walk(tail, [(0, 0)], high)
        return ids(self._way(back, border), head), ids(self._way(behind, last), tail)


def normalised(text: str) -> str:
    """As the model's identity rule does: a leading space, and marks for spaces."""
    return _MARK + text.replace(" ", _MARK) if text else ""


def combine(a: Matrix, b: Matrix) -> Matrix:
    """Max-plus product of two transfer matrices."""
    out: Matrix = {}
    for start, row in a.items():
        best: dict[State, float] = {}
        for middle, first in row.items():
            for end, second in b.get(middle, {}).items():
                best[end] = max(best.get(end, -math.inf), first + second)
        if best:
            out[start] = best
    return out


def scan(matrices: list[Matrix], start: State, end: State | None) -> list[tuple[State, State]]:
    """First and last border of each of a row of chunks, on the best path between two borders.

    Without ``end``, the path ends where its score is best.
    """
    forward: list[dict[State, float]] = [{start: 0.0}]
    for m in matrices:
        forward.append(combine({START: forward[-1]}, m).get(START, {}))
    last = end if end is not None else max(forward[-1], key=forward[-1].get)
    states = [last]
    for before, m in zip(forward[-2::-1], matrices[::-1], strict=True):
        able = {s: v + m[s][states[-1]] for s, v in before.items() if states[-1] in m.get(s, {})}
        states.append(max(able, key=able.get))
    states.reverse()
    return list(zip(states[:-1], states[1:], strict=True))


def _packed(m: Matrix) -> bytes:
    rows = [(*s, *e, v) for s, row in m.items() for e, v in row.items()]
    return np.array(rows, np.float64).tobytes()


def _unpacked(raw: bytes) -> Matrix:
    out: Matrix = {}
    for a, b, c, d, v in np.frombuffer(raw).reshape(-1, 5).tolist():
        out.setdefault((int(a), int(b)), {})[int(c), int(d)] = v
    return out


def cuts(length: int, chunk: int, longest: int) -> list[tuple[int, int]]:
    """Borders of the chunks of a text; the last takes what is too short for one of its own."""
    at = [x for x in range(0, length, chunk) if x == 0 or length - x >= longest]
    return list(zip(at, [*at[1:], length], strict=True))


def _encode_short(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Vocabulary(path)
        for batch in batches:
            ids, same = [], []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                plain = normalised(text)
                got = model.encode(plain)
                ids.append(got)
                same.append(model.decode(got).decode() == plain.replace(_MARK, " "))
            yield _with_ids(batch, ids, same)

    return run


def _with_ids(batch: pa.RecordBatch, ids: list[list[int]], same: list[bool]) -> pa.RecordBatch:
    arrays = [pa.array(ids, pa.list_(pa.int32())), pa.array(same, pa.bool_())]
    names = [*batch.schema.names[:-1], "ids", "same"]
    return pa.RecordBatch.from_arrays([*batch.columns[:-1], *arrays], names)


def _cut(chunk: int, path: str):
    """Long texts to chunks: the matrix, the ids of the middle, and the texts around it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Vocabulary(path)
        for batch in batches:
            for row, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                plain = normalised(text)
                places = cuts(len(plain), chunk, model.longest)
                for k, (begin, stop) in enumerate(places):
                    low = max(0, begin - model.longest)
                    part = plain[low : stop + model.longest]
                    matrix, cut, ids = model.solve(part, begin - low, stop - low, stop == len(plain))
                    if cut is None:
                        head, tail, high, same = part, None, stop - low, True
                    else:
                        head, tail, high = part[: cut[0]], part[cut[1] :], stop - low - cut[1]
                        same = model.decode(ids).decode("utf-8", "replace") == part[cut[0] : cut[1]].replace(_MARK, " ")
                    values = [row, k, len(places), begin - low, high, head, tail, ids, same, _packed(matrix)]
                    arrays = [pa.array([v], t) for v, t in zip(values, _CHUNK_KINDS, strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, _CHUNK_NAMES)

    return run


_CHUNK_NAMES = ["row", "chunk", "n_chunks", "low", "high", "head", "tail", "middle", "same", "matrix"]
_CHUNK_KINDS = [*[pa.int64()] * 5, pa.string(), pa.string(), pa.list_(pa.int32()), pa.bool_(), pa.binary()]
_CHUNKS = (
    "row bigint, chunk bigint, n_chunks bigint, low bigint, high bigint, head string, tail string, "
    "middle array<int>, same boolean, matrix binary"
)
_STATES = "s0 bigint, s1 bigint, e0 bigint, e1 bigint"


def _combined(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("chunk")
    product = _unpacked(rows["matrix"].iloc[0])
    for raw in rows["matrix"].iloc[1:]:
        product = combine(product, _unpacked(raw))
    return pd.DataFrame(
        {"row": rows["row"].iloc[:1], "block": rows["block"].iloc[:1], "matrix": [_packed(product)]}
    )


def _between(order: str):
    """Scan the matrices of a group in order, between the group's two borders."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(order)
        matrices = [_unpacked(x) for x in rows["matrix"]]
        known = rows.iloc[0]
        start, end = START, None
        if "s0" in rows:
            start = int(known["s0"]), int(known["s1"])
            end = int(known["e0"]), int(known["e1"])
        found = [(*s, *e) for s, e in scan(matrices, start, end)]
        out = rows[["row", order]].reset_index(drop=True)
        return pd.concat([out, pd.DataFrame(found, columns=["s0", "s1", "e0", "e1"])], axis=1)

    return run


def _trace_chunks(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Vocabulary(path)
        for batch in batches:
            ids, right = [], []
            columns = (c.to_pylist() for c in batch.columns[2:])
            for low, high, head, tail, middle, same, s0, s1, e0, e1 in zip(*columns, strict=True):
                before, behind = model.trace(head, low, high, tail, (s0, s1), (e0, e1))
                ids.append([*before, *middle, *behind])
                ends = [(before, head[low + s1 :] if tail is not None else head[low + s1 : high + e1])]
                if tail is not None:
                    ends.append((behind, tail[: high + e1]))
                fits = (model.decode(x).decode("utf-8", "replace") == t.replace(_MARK, " ") for x, t in ends)
                right.append(same and all(fits))
            arrays = [pa.array(ids, pa.list_(pa.int32())), pa.array(right, pa.bool_())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *arrays], ["row", "chunk", "ids", "same"]
            )

    return run


def encode_long(texts: DataFrame, path: str, chunk: int = CHUNK) -> DataFrame:
    """(row, ids, same) of long texts (row, body) by chunks.

    The chunks of a text are scanned in blocks; a text of one block needs one scan only.
    Matrices are small but take long, so they are dealt by number, not by their bytes.
    """
    chunks = stored(texts.mapInArrow(_cut(chunk, path), _CHUNKS), "chunks")
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    one = chunks.where(F.col("n_chunks") <= BLOCK).select("row", "chunk", "matrix").repartition(parts, "row")
    alone = one.groupBy("row").applyInPandas(_between("chunk"), f"row bigint, chunk bigint, {_STATES}")
    placed = chunks.where(F.col("n_chunks") > BLOCK).select(
        "row", "chunk", "matrix", F.floor(F.col("chunk") / BLOCK).alias("block")
    ).repartition(parts, "row", "block")
    blocks = placed.groupBy("row", "block").applyInPandas(
        _combined, "row bigint, block bigint, matrix binary"
    )
    borders = blocks.groupBy("row").applyInPandas(
        _between("block"), f"row bigint, block bigint, {_STATES}"
    )
    states = placed.join(borders, ["row", "block"]).groupBy("row", "block").applyInPandas(
        _between("chunk"), f"row bigint, chunk bigint, {_STATES}"
    )
    known = chunks.drop("matrix", "n_chunks").join(alone.unionByName(states), ["row", "chunk"])
    traced = known.select(
        "row", "chunk", "low", "high", "head", "tail", "middle", "same", "s0", "s1", "e0", "e1"
    ).mapInArrow(_trace_chunks(path), "row bigint, chunk bigint, ids array<int>, same boolean")
    whole = traced.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("chunk", "ids"))).alias("parts"),
        F.bool_and("same").alias("same"),
    )
    return whole.select("row", F.flatten("parts.ids").alias("ids"), "same")


def encode(docs: DataFrame, keys: list[str], path: str, chunk: int = CHUNK) -> DataFrame:
    """``keys`` with ``ids`` (the pieces of the whole text) and ``same``: whether decoding
    them gives the text again, a leading space and spaces for space marks apart.

    Missing and empty texts have no pieces. Repeated rows are encoded each. ``ids`` of a
    text do not depend on ``chunk``.
    """
    small_batches(docs)
    chosen = docs.select(*[F.col(k) for k in keys], text_of().alias("__body"))
    long_ = F.char_length("__body") >= chunk
    fields = chosen.drop("__body").schema.fields
    found = [
        T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("same", T.BooleanType())
    ]
    short = chosen.where(~long_).mapInArrow(_encode_short(path), T.StructType([*fields, *found]))
    giants = stored(
        chosen.where(long_).withColumn("__row", F.monotonically_increasing_id()), "giants"
    )
    solved = encode_long(giants.select(F.col("__row").alias("row"), F.col("__body").alias("body")), path, chunk)
    solved = solved.withColumnRenamed("row", "__row")
    rest = giants.drop("__body").join(solved, "__row").drop("__row")
    return short.unionByName(rest)


def decode(ids: DataFrame, path: str, column: str = "ids", to: str = "text") -> DataFrame:
    """Add the text of each row's ids; the space that encoding puts in front is taken off."""

    names = [*ids.columns, to]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Vocabulary(path)
        for batch in batches:
            rows = batch.column(names.index(column)).to_pylist()
            texts = [None if r is None else model.decode(r).decode("utf-8", "replace") for r in rows]
            texts = [t[1:] if t and t[0] == " " else t for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names)

    small_batches(ids)
    return ids.mapInArrow(run, T.StructType([*ids.schema.fields, T.StructField(to, T.StringType())]))
