"""License scan by ordered signature rules, in DataFrame expressions only.

Hundreds of signatures (``license_rules``) are regular expressions over words. A text is
looked at if it holds one of a few stems that every rule demands; a rule is tried on it if
the text holds the rule's keyword, the longest run of plain words that each of its matches
has. Detections are intervals of the text. One that lies inside another is suppressed; of
equal intervals the rule of higher priority stays, and of neighbours that overlap in part
the one of higher priority. The places of the base phrases always count.

The texts are not shuffled: one pass over them writes a narrow row per document, with the
words of the few texts that pass the gate. Only detections are dealt by document.
"""

from __future__ import annotations

import functools
import json
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from metricloom.llm.common import fresh, stored, text_of
from metricloom.llm.license_rules import GATE, RULES, Rule

#: What separates words in a text, before and after A-Z are put in lower case.
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Set around matches; no word holds it.
_MARK = "\x01"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: Column) -> Column:
    """The words of a text, one space between two (by replacing: linear, however long the text)."""
    return F.trim(F.regexp_replace(text, F.lit(_BETWEEN), F.lit(" ")))


def _spaced(words: Column) -> Column:
    """Words in lower case, each between two spaces of its own, so that matches share none."""
    low = F.translate(words, _UPPER, _LOWER)
    return F.concat(F.lit(" "), F.replace(low, F.lit(" "), F.lit("  ")), F.lit(" "))


def _count(words: Column) -> Column:
    """How many words, given one space between two."""
    return F.when(words == "", 0).otherwise(
        F.char_length(words) - F.char_length(F.replace(words, F.lit(" "), F.lit(""))) + 1
    ).cast("long")


def _gate(low: Column) -> Column:
    """Whether a lower-case text holds a stem that the rules demand; "cc" only as a word."""
    stems = [F.contains(low, F.lit(x)) for x in GATE if x != "cc"]
    return functools.reduce(operator.or_, stems) | (
        F.contains(low, F.lit("cc")) & F.rlike(low, F.lit("(?<![0-9a-z])cc(?![0-9a-z])"))
    )


def _rule_table(rules: Sequence[Rule]) -> Column:
    """The rules as one constant array, in the order of priority."""
    rows = [{"priority": i, **rule._asdict()} for i, rule in enumerate(rules)]
    kind = "array<struct<priority:int,label:string,weight:double,pattern:string,keyword:string,base:boolean>>"
    return F.from_json(F.lit(json.dumps(rows)), kind)


def detections(texts: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(row, priority, label, weight, base, word, words, start, end) of all matches in (row, words).

    ``words`` of the input is a text as ``_spaced`` gives it. ``word`` is the number of
    words before the match, ``start`` and ``end`` its interval in characters.
    """
    tried = texts.select(
        "row", "words",
        F.explode(F.filter(_rule_table(rules), lambda r: F.contains(F.col("words"), r["keyword"]))).alias("r"),
    )
    marked = F.regexp_replace("words", F.col("r.pattern"), F.lit(f"{_MARK}$0{_MARK}"))
    parts = tried.select("row", "r.*", F.posexplode(F.split(marked, _MARK, -1)).alias("at", "part"))
    size = F.char_length("part")
    spaces = size - F.char_length(F.replace("part", F.lit(" "), F.lit("")))  # two for each word
    sizes = parts.select(
        "row", "priority", "label", "weight", "base", "at", size.alias("size"),
        (spaces / 2).cast("long").alias("words"),
    )
    through = Window.partitionBy("row", "priority").orderBy("at")
    placed = sizes.repartition("row").select(
        "*", F.sum("size").over(through).alias("end"), F.sum("words").over(through).alias("past")
    )
    return placed.where("at % 2 = 1").select(  # the parts between two marks are the matches
        "row", "priority", "label", "weight", "base", (F.col("past") - F.col("words")).alias("word"),
        "words", (F.col("end") - F.col("size")).alias("start"), "end",
    )


def suppressed(found: DataFrame) -> DataFrame:
    """``found`` with ``kept``: whether no other detection of the same text suppresses this one."""
    outward = Window.partitionBy("row").orderBy("start", F.desc("end"), "priority")
    before = outward.rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.max("end").over(before) >= F.col("end"), F.lit(False))
    # What is left has rising starts and ends; the others wait at the end of the order.
    along = Window.partitionBy("row", "inside").orderBy("start")
    rows = found.withColumn("inside", inside)
    beaten = (
        (F.lag("end").over(along) > F.col("start")) & (F.lag("priority").over(along) < F.col("priority"))
    ) | ((F.lead("start").over(along) < F.col("end")) & (F.lead("priority").over(along) < F.col("priority")))
    rows = rows.withColumn("beaten", F.coalesce(beaten, F.lit(False)))
    return rows.withColumn("kept", ~F.col("inside") & ~F.col("beaten")).drop("inside", "beaten")


def scan_licenses(
    docs: DataFrame, keep: Sequence[str] = ("doc_id",), rules: Sequence[Rule] = RULES, *, text: str = "text"
) -> DataFrame:
    """The columns ``keep`` and the licenses of each whole text.

    ``n_words``; ``n_base``, ``first_word`` and ``last_word``: places of base phrases, and
    the words before the first and the last (null without any); ``base_labels`` and
    ``labels`` (the kept detections' too), distinct, in code-point order, comma-joined;
    ``score``: the weight of the surest detection behind ``labels``, 0 without any;
    ``spans``: (label, start, end) in words, of the kept detections and the base places.

    Missing and empty texts have no words and no labels. Repeated rows each get their row;
    an empty table gives an empty table. A ``keep`` named like an output is refused.
    """
    outputs = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
    clash = {c.lower() for c in keep} & set(outputs)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are made here; rename them first")
    row, words = fresh([*keep, *outputs], "row"), fresh([*keep, *outputs], "words")
    plain, low = fresh([*keep, *outputs], "plain"), fresh([*keep, *outputs], "low")
    texts = docs.select(*keep, _words(text_of(text)).alias(plain)).withColumn(low, F.lower(plain))
    seen = stored(
        texts.select(
            *keep, F.monotonically_increasing_id().alias(row),
            _count(F.col(plain)).alias("n_words"),
            F.when(_gate(F.col(low)), _spaced(F.col(plain))).alias(words),
        ),
        "license-words",
    )
    gated = seen.where(F.col(words).isNotNull()).select(F.col(row).alias("row"), F.col(words).alias("words"))
    found = suppressed(detections(gated, rules)).where(F.col("base") | F.col("kept"))
    base = F.col("base")
    span = F.struct("label", F.col("word").alias("start"), (F.col("word") + F.col("words")).alias("end"))
    per_row = found.groupBy(F.col("row").alias(row)).agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("word"))).alias("first_word"),
        F.max(F.when(base, F.col("word"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("weight").alias("score"),
        F.array_sort(F.collect_set(span)).alias("spans"),
    )
    none = {"n_base": F.lit(0), "base_labels": F.lit(""), "labels": F.lit(""), "score": F.lit(0.0)}
    return seen.drop(words).join(per_row, row, "left").select(
        *keep,
        *[F.coalesce(c, none[c]).alias(c) if c in none else F.col(c) for c in outputs],
    )
