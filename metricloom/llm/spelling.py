"""Spelling variants: words one edit apart, found through pivotal grams.

A word's grams are its bigrams with their places, ordered by how many words hold them,
rarest first. One edit destroys at most two grams, and of two *disjoint* grams at most one.
So a word's prefix is its three rarest grams, and its pivots are the two disjoint grams of
the prefix that are cheapest together, chosen by dynamic programming. Of two words one edit
apart, take the one whose prefix ends with the rarer gram: one of its pivots survives in the
other word, and there it is among the grams of the prefix. Pivots are therefore looked up
among the prefix grams of the other words only.

Position limits: the edit lies wholly before or wholly behind a pivot that survives, hence
the text on its other side is unchanged as well, and so are either the ``TAIL`` letters at
the far end of the word or all but those. A pivot is looked up together with what is
unchanged, which fixes its place from the start or from the end of the word. Pairs found
are verified by their edit distance.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from metricloom.llm.common import fresh, stored, text_of

GRAM, EDITS = 2, 1
#: Grams of a prefix, and disjoint ones among them.
PREFIX, PIVOTS = GRAM * EDITS + 1, EDITS + 1
#: An edit creates at most this many grams, so a gram's k-th occurrence in one word is at
#: most the (k + 2)-th in the other.
_LATER = GRAM * EDITS

#: Words are maximal runs of these letters. There are 90 in lower case, so at most 8,100 bigrams.
LETTERS = r"A-Za-zÀ-ÿ"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LENGTH, MIN_COUNT = 5, 3

#: Letters at the far end of a word that are filed along with a gram.
TAIL = 3

_INDEX = "word string, n bigint, last int, pivot boolean, side string"


def word_counts(
    docs: DataFrame,
    alter: Callable[[Column, Column], Column] | None = None,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
) -> DataFrame:
    """(word, n) of the words of whole texts that are long and frequent enough.

    Words are runs of letters with A-Z in lower case. ``alter`` maps a document's id (as a
    string, empty if missing) and a run to the word to count in its place; it may shorten
    runs but not lengthen them. Missing and empty texts hold no words; repeated rows count
    each.
    """
    # By splitting: linear, however long the text. A shorter run can't become a word.
    runs = F.filter(
        F.split(F.translate(text_of(text), _UPPER, _LOWER), f"[^{LETTERS}]+"),
        lambda run: F.char_length(run) >= min_length,
    )
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    words = docs.select(key.alias("id"), F.explode(runs).alias("word"))
    if alter is not None:
        words = words.select(alter(F.col("id"), F.col("word")).alias("word"))
        words = words.where(F.char_length("word") >= min_length)
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= min_count)


def gram_order(words: DataFrame) -> dict[str, tuple[int, int]]:
    """gram -> (rank, number of words holding it), rarest first.

    The table is collected: it holds pairs of letters, 8,100 at most, whatever the input.
    """
    places = F.sequence(F.lit(1), F.char_length("word") - (GRAM - 1))
    grams = F.array_distinct(
        F.transform(places, lambda i: F.substr(F.col("word"), i, F.lit(GRAM)))
    )
    counts = words.select(F.explode(grams).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    rows = sorted((r["n"], r["gram"]) for r in counts.collect())
    return {gram: (rank, n) for rank, (n, gram) in enumerate(rows)}


def choose_pivots(grams: list[tuple[int, int]]) -> list[int]:
    """The places of ``PIVOTS`` disjoint grams of least total cost, from (place, cost) by place.

    best[k] is the cheapest choice of k disjoint grams among those seen; a gram extends a
    choice that ends before it. Ties fall to the earlier places.
    """
    ends: list[list[tuple[int, list[int]]]] = []
    for i, (place, cost) in enumerate(grams):
        row: list[tuple[int, list[int]]] = [(cost, [place])]
        for k in range(1, PIVOTS):
            before = [
                ends[j][k - 1] for j in range(i)
                if grams[j][0] + GRAM <= place and len(ends[j]) >= k
            ]
            if not before:
                break
            total, places = min(before)
            row.append((total + cost, [*places, place]))
        ends.append(row)
    return min(row[PIVOTS - 1] for row in ends if len(row) == PIVOTS)[1]


def prefix_of(word: str, order: dict[str, tuple[int, int]]) -> tuple[int, list[int], list[int]]:
    """(rank of the prefix's last gram, places of the pivots, places where others' pivots may sit).

    A gram as common as the last one may occur again behind the prefix, where the other word
    has it inside: its next occurrences are searched too, as many as an edit can create.
    """
    ranks = [order[word[i : i + GRAM]] for i in range(len(word) - GRAM + 1)]
    first = sorted((rank, i) for i, (rank, _) in enumerate(ranks))[:PREFIX]
    last = first[-1][0]
    pivots = choose_pivots(sorted((i, ranks[i][1]) for _, i in first))
    searched = [i for rank, i in first if rank < last]
    same = (i for i, r in enumerate(ranks) if r[0] == last)
    searched += [i for i, _ in zip(same, range(PREFIX + _LATER), strict=False)]
    return last, pivots, searched


def _sides(word: str, places: list[int], lengths: tuple[int, ...], slack: int) -> list[str]:
    """The texts under which a word is filed for grams at ``places``: what one edit leaves alone.

    With the edit behind a gram, all before it stays. Of what follows, either the last
    ``TAIL`` letters stay, or all letters but those. A gram with fewer letters behind it is
    filed under what is before it alone. Likewise with the edit before the gram. ``lengths``
    are the possible lengths of the word that holds the pivot, and ``slack`` is how far its
    place may be off from the end.
    """
    size, out = len(word), []
    for i in places:
        end = i + GRAM
        if size - end - slack < TAIL:
            out.append("<" + word[:end])
        if size - end + slack >= TAIL:
            out.append(f"[{word[:end]} {word[-TAIL:]}")
        if i - slack < TAIL:
            out.append(">" + word[i:])
        if i + slack >= TAIL:
            out.append(f"]{word[:TAIL]} {word[i:]}")
    head, back = min(places) + GRAM, max(places)
    for n in lengths:
        keep = n - TAIL  # letters that stay if the edit falls among the other word's last or first ones
        if head <= keep <= size:
            out.append(f"({n} {word[:keep]}")
        if keep >= 0 and back >= size - keep >= 0:
            out.append(f"){n} {word[size - keep:]}")
    return out


def _index(order: dict[str, tuple[int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, last, pivot, side = [], [], [], []
            for row, word in enumerate(batch.column(0).to_pylist()):
                rank, pivots, searched = prefix_of(word, order)
                n = len(word)
                mine = _sides(word, pivots, (n,), 0)
                theirs = _sides(word, searched, (n - 1, n, n + 1), EDITS)
                side += mine
                side += theirs
                pivot += [True] * len(mine) + [False] * len(theirs)
                at += [row] * (len(mine) + len(theirs))
                last += [rank] * (len(mine) + len(theirs))
            filed = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*filed.columns, pa.array(last, pa.int32()), pa.array(pivot, pa.bool_()), pa.array(side, pa.string())],
                ["word", "n", "last", "pivot", "side"],
            )

    return run


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n): all pairs of ``words`` (word, n) one edit apart, in both orders.

    Words must be distinct, of four letters or more.
    """
    index = words.select("word", "n").mapInArrow(_index(gram_order(words)), _INDEX)
    index = stored(index.withColumn("key", F.xxhash64("side")).drop("side"), "spelling-index")
    pivots = index.where("pivot").drop("pivot").alias("p")
    grams = index.where("not pivot").drop("pivot").alias("g")
    fits = (
        (F.col("p.key") == F.col("g.key"))
        & (F.col("p.last") <= F.col("g.last"))
        & (F.abs(F.char_length("p.word") - F.char_length("g.word")) <= EDITS)
        & (F.col("p.word") != F.col("g.word"))
        & (F.levenshtein("p.word", "g.word", EDITS) == EDITS)
    )
    found = pivots.join(grams, fits).select(
        F.col("p.word").alias("a"), F.col("p.n").alias("an"),
        F.col("g.word").alias("b"), F.col("g.n").alias("bn"),
    )
    both = found.select(
        F.explode(
            F.array(
                F.struct(F.col("a").alias("word"), F.col("an").alias("n"), F.col("b").alias("other"), F.col("bn").alias("other_n")),
                F.struct(F.col("b").alias("word"), F.col("bn").alias("n"), F.col("a").alias("other"), F.col("an").alias("other_n")),
            )
        ).alias("x")
    ).select("x.*")
    # Dealt by word: a pair found through several grams, and later a word's pairs, meet there.
    return both.repartition("word").groupBy("word", "other").agg(
        F.first("n").alias("n"), F.first("other_n").alias("other_n")
    )


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): forms followed to the last.

    A form occurs at least twice as often as its word, so there are no circles and a chain
    has at most log2(largest count) steps; each round doubles the steps taken.
    """
    step = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    moved = not step.isEmpty()
    while moved:
        up = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stored(
            step.join(up, "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            ),
            "spelling-roots",
        )
        moved = not step.where("moved").isEmpty()
        step = step.drop("moved")
    return step


def group_variants(words: DataFrame, ratio: int = 2) -> DataFrame:
    """word, form, root, n, n_near, form_n for each row of ``words`` (word, n), words distinct.

    ``form`` is the most frequent word one edit away (ties: the smallest in code-point
    order) if it occurs at least ``ratio`` times as often, else null; ``root`` follows forms
    to the last. An empty table gives an empty table. ``ratio`` must exceed 1, or forms
    could run in circles.
    """
    if ratio <= 1:
        raise ValueError("a form has to be more frequent than its variants")
    words = stored(words.select("word", "n"), "spelling-words")
    best = F.min(F.struct((-F.col("other_n")).alias("m"), F.col("other").alias("o"))).alias("best")
    near = near_pairs(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    rows = words.join(near, "word", "left")
    form_n = -F.col("best.m")
    frequent = form_n >= ratio * F.col("n")
    rows = stored(
        rows.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(frequent, F.col("best.o")).alias("form"), F.when(frequent, form_n).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = _roots(rows.where("form is not null"))
    return rows.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def with_forms(docs: DataFrame, groups: DataFrame, *, text: str = "text", out: str = "words") -> DataFrame:
    """``docs`` with the array ``out`` of (at, word, root) of the variants in each text.

    Only words whose root is another word are listed, by their place among the text's words
    (from 0). All columns stay; an ``out`` that is taken gets an underscore. The texts are
    not shuffled, only their words are.
    """
    out = fresh(docs.columns, out)
    row = fresh([*docs.columns, out], "row")
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "spelling-docs")
    low = F.translate(text_of(text), _UPPER, _LOWER)
    runs = F.filter(F.split(low, f"[^{LETTERS}]+"), lambda run: run != "")
    words = rows.select(F.col(row).alias("row"), F.posexplode(runs).alias("at", "word"))
    variants = groups.where("root != word").select("word", "root")
    found = words.join(variants, "word").groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("at", "word", "root"))).alias(out)
    )
    return rows.join(found.withColumnRenamed("row", row), row, "left").drop(row)
