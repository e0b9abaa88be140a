"""Line dedup: drop lines that repeat an earlier line, up to one changed, lost or added word.

Lines are compared by their words, ASCII letters in lower case. Equal lines meet in one
grouping. For lines that differ by a word, each line emits the hash of every sequence
that is left when one of its words is taken out (its deletion neighbourhood), with the
place of that word:

* two lines of equal length differ in one word exactly if they share a sequence *at the
  same place*; all lines of such a group are within one edit of each other, so that
  comparing each with the earliest decides the whole group;
* a line with one word more than another has the other as one of its sequences.

Every match is verified on the words. The neighbourhood is only emitted for lines that can
have a partner: a single edit leaves one half of a line as it is, so that a line whose
halves occur in no other line has none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from metricloom.llm.common import Ranges, fresh, light, mixed, numbered, small_batches, stored, text_of, word_bounds

#: Shorter lines must be equal: with few words, one word is most of what a line says.
MIN_WORDS_NEAR = 8
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_U = np.uint64
_BYTES = mixed(np.arange(256, dtype=np.uint64) + _U(1))

#: Bytes of text that one call of the array functions takes, unless one text is longer.
_GROUP = 1 << 18


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x, pa.int64())


def _word_hashes(raw: bytes, ranges: Ranges) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    units = np.frombuffer(raw.lower(), np.uint8)
    start, end = word_bounds(units)
    return ranges.hashes(units, start, end, _BYTES[units]), start, units


def _groups(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``_GROUP`` bytes together, a longer text alone."""
    begin = size = 0
    for i, text in enumerate(texts):
        if i > begin and size + len(text) > _GROUP:
            yield begin, i
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def _halves(words: np.ndarray, begin: np.ndarray, stop: np.ndarray, ranges: Ranges) -> list[np.ndarray]:
    """Three hashes of each line, of which it shares one with any line within one word.

    A line of n words meets lines of n words in its halves, and lines of n - 1 or n + 1
    words in those cut for the longer of the two. Either both heads or both tails of the
    two cuts are the same, so three hashes stand for the four parts.
    """
    n = stop - begin
    half, odd = n // 2, n % 2 == 1
    parts = (
        (begin, begin + half, np.zeros(n.size, _U)),
        (begin + half, stop, np.ones(n.size, _U)),
        (np.where(odd, begin, stop - half - 1), np.where(odd, begin + half + 1, stop), (~odd).astype(_U)),
    )
    return [mixed(ranges.hashes(words, a, b) + kind * _U(_BASES[1])) for a, b, kind in parts]


def _lines(min_words: int):
    """Hashes of the lines of each text, and of the parts of the longer ones.

    Texts are taken together, parted by a line end, so that short texts share the calls.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, first, second = Ranges(), Ranges(_BASES[0]), Ranges(_BASES[1])
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for low, high in _groups(texts):
                words, at, units = _word_hashes(b"\n".join(texts[low:high]), letters)
                if not words.size:
                    continue
                ends = np.flatnonzero(units == 10)
                line = np.searchsorted(ends, at)
                begin = np.flatnonzero(np.r_[True, line[1:] != line[:-1]])
                stop, number = np.r_[begin[1:], words.size], line[begin]
                starts = np.cumsum([0, *(len(t) + 1 for t in texts[low : high - 1])])
                opening = np.searchsorted(ends, starts)  # number of each text's first line
                owner = np.searchsorted(opening, number, side="right") - 1
                take = pa.array(owner + low)
                longer = stop - begin >= min_words
                keys = [np.zeros(begin.size, _U) for _ in range(3)]
                for key, found in zip(keys, _halves(words, begin[longer], stop[longer], first), strict=True):
                    key[longer] = found
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(take), batch.column(1).take(take),
                        pa.array(number - opening[owner], pa.int64()),
                        _signed(first.hashes(words, begin, stop)),
                        _signed(second.hashes(words, begin, stop)),
                        *[pa.array(k.view(np.int64), pa.int64(), mask=~longer) for k in keys],
                    ],
                    _LINE_NAMES,
                )

    return run


_KEYS = ["k0", "k1", "k2"]
_LINE_NAMES = ["doc", "tag", "line", "h1", "h2", *_KEYS]
_LINE_SCHEMA = ", ".join(f"{x} bigint" for x in _LINE_NAMES)


def _picked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The chosen lines of each text: (text, line numbers) to (line number, line)."""
    for batch in batches:
        rows = []
        for doc, tag, raw, numbers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            lines = raw.split(b"\n")
            rows += [(doc, tag, k, b" ".join(lines[k].lower().split())) for k in numbers]
        columns = list(zip(*rows, strict=True)) or [()] * 4
        kinds = [pa.int64()] * 3 + [pa.binary()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, ["doc", "tag", "line", "words"])


def _neighbourhood(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(number, words) to one row per left-out word, and one (place -1) for the line itself."""
    letters, first, second = Ranges(), Ranges(_BASES[0]), Ranges(_BASES[1])
    for batch in batches:
        v1, v2, place, owner = [], [], [], []
        for i, raw in enumerate(batch.column(1).to_pylist()):
            words, _, _ = _word_hashes(raw, letters)
            ends = np.array([0]), np.array([words.size])
            v1 += [first.hashes(words, *ends), first.without_one(words)]
            v2 += [second.hashes(words, *ends), second.without_one(words)]
            place.append(np.arange(-1, words.size))
            owner.append(np.full(words.size + 1, i))
        take = pa.array(np.concatenate(owner) if owner else np.zeros(0, np.int64))
        none = np.zeros(0, _U)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(take),
                _signed(np.concatenate([none, *v1])), _signed(np.concatenate([none, *v2])),
                _signed(np.concatenate([none.astype(np.int64), *place])),
            ],
            ["number", "v1", "v2", "place"],
        )


def within_one_word(a: list[bytes], b: list[bytes]) -> bool:
    """Whether at most one word is changed, lost or added."""
    if abs(len(a) - len(b)) > 1:
        return False
    least, most = min(len(a), len(b)), max(len(a), len(b))
    head = 0
    while head < least and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < least - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    return head + tail >= most - 1


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
        near = pa.array([within_one_word(a.split(), b.split()) for a, b in pairs], pa.bool_())
        yield batch.select([0, 1]).filter(near)


def near_lines(docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """(h1, h2) of the lines that have an earlier line within one word."""
    keys = distinct.where("k0 is not null").select("h1", "h2", F.explode(F.array(*_KEYS)).alias("key"))
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key")
    able = keys.join(light(shared, "line-shared"), "key").select("h1", "h2").distinct()
    able = light(able, "line-partners")
    able = distinct.join(able, ["h1", "h2"], "left_semi").select("h1", "h2", "first")
    # Numbers rise from one sorted part to the next: the smaller number is the earlier line.
    able = numbered(able.orderBy("first", "h1", "h2"), "number", "line-able")
    wanted = able.groupBy(F.col("first.doc").alias("doc"), F.col("first.tag").alias("tag")).agg(
        F.collect_list("first.line").alias("lines")  # lines of one text
    )
    wanted = light(wanted, "line-wanted", weight=F.size("lines"))
    same = F.col("a.doc").eqNullSafe(F.col("b.doc")) & (F.col("a.tag") == F.col("b.tag"))
    picked = (
        docs.alias("a").join(wanted.alias("b"), same)
        .select("a.doc", "a.tag", "a.body", "b.lines")
        .dropDuplicates(["doc", "tag"])
        .mapInArrow(_picked, "doc bigint, tag bigint, line bigint, words binary")
        .alias("p")
    )
    at = F.col("a.first")
    here = (
        F.col("p.doc").eqNullSafe(at["doc"])
        & (F.col("p.tag") == at["tag"]) & (F.col("p.line") == at["line"])
    )
    texts = stored(
        able.alias("a").join(picked, here).select("number", "h1", "h2", "words"), "line-texts"
    )

    rows = texts.select("number", "words").mapInArrow(
        _neighbourhood, "number bigint, v1 bigint, v2 bigint, place bigint"
    )
    rows = stored(rows, "line-variants")
    # Most sequences occur once. Half of the hash tells the others, and few more.
    again = rows.groupBy("v1").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("v1")
    rows = stored(rows.join(light(again, "line-again"), "v1"), "line-met")
    cliques = rows.groupBy("v1", "v2", "place").agg(F.min("number").alias("least"))
    cliques = stored(cliques, "line-cliques")
    sequences = cliques.groupBy("v1", "v2").agg(
        F.min(F.when(F.col("place") < 0, F.col("least"))).alias("whole"),
        F.min(F.when(F.col("place") >= 0, F.col("least"))).alias("part"),
    )
    met = rows.join(sequences, ["v1", "v2"]).join(cliques, ["v1", "v2", "place"])
    other = F.when(F.col("place") < 0, F.col("part")).otherwise(F.col("whole"))
    pairs = met.select("number", F.explode(F.array("least", other)).alias("earlier"))
    pairs = pairs.where("earlier is not null and earlier < number").distinct()
    own = texts.select("number", "h1", "h2", F.col("words").alias("mine"))
    theirs = texts.select(F.col("number").alias("earlier"), F.col("words").alias("theirs"))
    checked = pairs.join(own, "number").join(theirs, "earlier")
    checked = checked.select("h1", "h2", "mine", "theirs")
    return checked.mapInArrow(_verified, "h1 bigint, h2 bigint").distinct()


def dropped_lines(docs: DataFrame, min_words_near: int = MIN_WORDS_NEAR) -> DataFrame:
    """(doc, tag, lines): numbers of the lines to drop, per text that has any.

    ``docs`` has ``doc`` (id), ``tag`` (hash of the text) and ``body`` (text as bytes).
    """
    lines = stored(docs.mapInArrow(_lines(min_words_near), _LINE_SCHEMA), "lines")
    place = F.struct(
        F.col("doc").isNull().alias("none"), F.col("doc"), F.col("line"), F.col("tag")
    )
    distinct = lines.groupBy("h1", "h2").agg(
        F.min(place).alias("first"), F.count(F.lit(1)).alias("c"), *[F.max(k).alias(k) for k in _KEYS]
    )
    distinct = stored(distinct, "line-distinct")
    near = near_lines(docs, distinct).withColumn("near", F.lit(True))
    rules = distinct.join(near, ["h1", "h2"], "left").where("c > 1 or near")
    rules = rules.select("h1", "h2", "first", F.coalesce("near", F.lit(False)).alias("near"))
    hit = lines.select("doc", "tag", "line", "h1", "h2").join(light(rules, "line-rules"), ["h1", "h2"])
    hit = hit.where(F.col("near") | (F.col("first") < place))
    return hit.groupBy("doc", "tag").agg(F.collect_set("line").alias("lines"))


def dedup_lines(
    docs: DataFrame,
    min_words_near: int = MIN_WORDS_NEAR,
    *,
    drop_emptied: bool = False,
    counts: tuple[str, str] = ("n_lines", "n_dropped"),
) -> DataFrame:
    """The rows of ``docs`` with the repeated lines taken out of ``text``.

    A line goes if an earlier line equals it, or is within one word of it and it has at
    least ``min_words_near`` words. Earlier is by ``doc_id`` (missing ids last), then by
    line, then by a hash of the text. Lines without a word stay. Missing and empty texts
    stay as they are. Rows that agree in id and text count as one document and are
    treated alike. ``drop_emptied`` leaves out documents that lost their last word.
    Adds the numbers of lines and of dropped lines, named by ``counts``; input columns of
    these names are replaced.
    """
    small_batches(docs)
    docs = docs.select(*[c for c in docs.columns if c not in counts])
    name = fresh(docs.columns, "line_tag")
    tag = F.xxhash64(text_of())
    body = text_of().cast("binary")
    found = dropped_lines(
        docs.select(F.col("doc_id").cast("long").alias("doc"), tag.alias("tag"), body.alias("body")),
        min_words_near,
    )
    found = light(found, "line-found", weight=F.size("lines")).alias("f")
    same = F.col("d.doc_id").eqNullSafe(F.col("f.doc")) & (F.col(f"d.{name}") == F.col("f.tag"))
    joined = docs.withColumn(name, tag).alias("d").join(found, same, "left")
    line_ends = F.octet_length("d.text") - F.octet_length(F.replace(F.col("d.text"), F.lit("\n"), F.lit("")))
    parts = F.split(F.col("d.text"), "\n", -1)  # of texts with dropped lines only
    every = F.sequence(F.lit(0).cast("long"), (F.size(parts) - 1).cast("long"))
    left = F.array_except(every, F.col("f.lines"))
    stay = F.transform(left, lambda i: F.get(parts, i.cast("int")))
    text = F.when(F.col("f.lines").isNull(), F.col("d.text")).otherwise(
        F.array_join(stay, "\n")
    )
    out = joined.select(
        *[text.alias("text") if c == "text" else F.col(f"d.`{c}`") for c in docs.columns],
        F.when(F.col("d.text").isNull(), F.lit(0)).otherwise(line_ends + 1).cast("long").alias(counts[0]),
        F.coalesce(F.size("f.lines"), F.lit(0)).cast("long").alias(counts[1]),
    )
    if drop_emptied:
        words = F.col("text").rlike(r"[^\x20\x09-\x0D]")
        out = out.where((F.col(counts[1]) == 0) | words)
    return out
