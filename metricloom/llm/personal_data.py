"""Personal data by weak supervision: labelers vote on candidate spans, a classifier decides.

Everything that grows with the data is a DataFrame expression. Candidates are found by
patterns; pattern, gazetteer and context labelers vote yes, no or nothing on each.
Expectation-maximisation estimates how reliable each labeler is, from the counts of the
distinct vote patterns alone, and the posteriors train a logistic span classifier. Both
tables of counts have a size fixed by the number of kinds and labelers, not by the data.
Base spans always stay; the classifier decides about the others.
"""

from __future__ import annotations

import functools
import math
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from metricloom.llm.common import stored, text_of

#: Fixed patterns, in the order of the result. Possessive repeats and look-behinds give the
#: leftmost longest matches of the plain patterns without searching back. A card with too
#: few digits fails as a whole, so the least number stands in its pattern.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
ADDED = {
    "email_spelled": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]{1,63}"
    r"(?:\x20?(?:\.|[\[(]dot[\])])\x20?[A-Za-z0-9-]{1,63}){1,5}",
    "phone_local": r"(?<![0-9+(.-])(?<!\+[0-9]\x20)\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
}
KINDS = [*BASE, *ADDED]

#: Fixed gazetteers: endings of mail domains, issuer digits of cards.
ENDINGS = (
    "com org net edu gov int info biz io co uk de fr es it nl be ch at se no fi dk pl pt br mx "
    "ca us au nz jp cn in ru example test"
).split()
FOR = (
    "mail email e-mail contact write call phone tel telephone mobile cell fax card visa "
    "mastercard account iban ssn social security address ip host from reach"
).split()
AGAINST = "version release chapter page section isbn order invoice ref item part serial figure".split()

#: A span that is not a base one needs this probability.
MIN_PROBABILITY = 0.9
_ROUNDS, _STEPS = 60, 300
LABELERS = ("shape", "gazetteer", "context", "border", "variety")


def _match(kind: int):
    def of(x: Column, at: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), at.alias("at"),
            F.char_length(x["gap"]).alias("gap"), x["hit"].alias("value"),
            F.right(x["gap"], F.lit(40)).alias("before"),
            F.left(x["next"], F.lit(20)).alias("after"),
        )

    return of


def _is(kind: int):
    return lambda x: x["kind"] == kind


def _candidates(docs: DataFrame) -> DataFrame:
    """(doc, tag, kind, start, end, value, before, after) of every match of every pattern."""
    body = F.col("body")
    digits = body.rlike("[0-9][0-9]")
    guards = {
        "email": body.contains("@"), "ip": body.rlike(r"[0-9]\.[0-9]"),
        "card": body.rlike(r"[0-9][\x20-]?[0-9]"), "phone": body.rlike(r"\+[0-9]"),
        "email_spelled": body.rlike(r"[\[(]at[\])]"),
    }
    found = []
    for i, (kind, pattern) in enumerate((BASE | ADDED).items()):
        gaps = F.split(body, pattern, -1)
        hits = F.regexp_extract_all(body, F.lit(pattern), F.lit(0))
        zipped = F.arrays_zip(
            gaps.alias("gap"), hits.alias("hit"), F.slice(gaps, 2, 2_147_483_646).alias("next")
        )
        matches = F.transform(zipped, _match(i))
        found.append(F.when(guards.get(kind, digits), matches))
    some = functools.reduce(operator.or_, guards.values(), digits)
    rows = docs.where(some).withColumn("row", F.monotonically_increasing_id())
    none = F.array().cast(
        "array<struct<kind:int,at:int,gap:int,value:string,before:string,after:string>>"
    )
    every = F.concat(*[F.coalesce(f, none) for f in found])
    spans = rows.select("doc", "tag", "row", F.explode(every).alias("m")).select(
        "doc", "tag", "row", "m.*"
    )
    spans = spans.where("value is not null")
    through = Window.partitionBy("row", "kind").orderBy("at")
    size = F.char_length("value")
    spans = spans.withColumn("end", F.sum(F.col("gap") + size).over(through))
    return spans.select(
        "doc", "tag", "kind", (F.col("end") - size).alias("start"), "end", "value", "before", "after"
    )


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check; doubled digits count by their digit sum."""
    size = F.char_length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, size - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(0), size - 1), F.lit(0), add)
    return total % 10 == 0


def _valid(kind: Column, value: Column) -> Column:
    """The checks behind the patterns of the base kinds; other kinds have none."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    n = F.char_length(digits)
    small = F.lit(r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])")
    ip = F.regexp_like(value, F.concat(F.lit("^"), small, F.lit(r"(?:\."), small, F.lit("){3}$")))
    at = {name: i for i, name in enumerate(KINDS)}
    return (
        F.when(kind == at["ip"], ip)
        .when(kind == at["card"], (n <= 19) & F.when(n.between(16, 19), _luhn(digits)))
        .when(kind == at["phone"], n.between(8, 15))
        .otherwise(True)
    )


def _vote(yes: Column, no: Column) -> Column:
    return F.when(no, -1).when(yes, 1).otherwise(0)


def _votes(spans: DataFrame) -> DataFrame:
    at = {name: i for i, name in enumerate(KINDS)}
    kind, value = F.col("kind"), F.col("value")
    digits = F.regexp_replace(value, "[^0-9]", "")
    n = F.char_length(digits)
    ending = F.lower(F.regexp_extract(value, r"([A-Za-z]+)$", 1))
    mail = kind.isin(at["email"], at["email_spelled"])
    known = F.when(mail, ending.isin(ENDINGS)).when(kind == at["card"], value.rlike("^[3-6]"))
    known = known.when(kind == at["iban"], value.rlike("^[A-Z]{2}[0-9]{2}"))
    unknown = F.when(kind == at["card"], ~value.rlike("^[3-6]")).when(
        kind == at["ssn"], value.rlike("^(?:000|666|9)|-00-|-0000$")
    ).when(kind == at["phone_local"], value.rlike("^[(]?[01]"))
    shape = (
        F.when(mail, value.rlike(r"[A-Za-z]{2,24}$"))
        .when(kind == at["card"], n == 16)
        .when(kind.isin(at["phone"], at["phone_local"]), n.between(10, 13))
        .otherwise(True)
    )
    before = F.lower("before")
    words = r"(?:^|[^a-z])(?:{})[^a-z]{{0,3}}(?:[a-z]+[^a-z]{{1,3}}){{0,2}}$"
    votes = {
        "shape": _vote(shape, ~shape),
        "gazetteer": _vote(F.coalesce(known, F.lit(False)), F.coalesce(unknown, F.lit(False))),
        "context": _vote(
            before.rlike(words.format("|".join(FOR))), before.rlike(words.format("|".join(AGAINST)))
        ),
        "border": _vote(
            F.regexp_like(F.concat("before", F.lit("|"), "after"), F.lit(r"^(?:.*[\s(<\[\"':,;])?\|(?:[\s)>\]\"',.;:!?].*)?$")),
            before.rlike("[a-z0-9]$") | F.col("after").rlike("^[A-Za-z0-9]"),
        ),
        "variety": _vote(
            mail | (F.size(F.array_distinct(F.split(digits, ""))) > 4), (n > 3) & digits.rlike(r"^(.)\1+$")
        ),
    }
    length = F.least(F.floor(F.char_length(value) / 8), F.lit(4)).cast("int")
    return spans.withColumns(votes | {"length": length})


def estimate_reliability(counts: Sequence[tuple[tuple[int, ...], float]]) -> list[float]:
    """Posterior of each vote pattern, by expectation-maximisation.

    Two classes; each labeler votes -1, 0 or 1 with a probability per class. Starts from
    the balance of the votes.
    """
    posterior = [1 / (1 + math.exp(-sum(votes))) for votes, _ in counts]
    total = sum(n for _, n in counts)
    for _ in range(_ROUNDS):
        good = sum(p * n for p, (_, n) in zip(posterior, counts, strict=True))
        prior = (good + 1) / (total + 2)
        tables = []
        for side in (1, 0):
            weight = [(p if side else 1 - p) * n for p, (_, n) in zip(posterior, counts, strict=True)]
            all_ = sum(weight)
            rows = []
            for k in range(len(counts[0][0]) if counts else 0):
                seen = {-1: 1.0, 0: 1.0, 1: 1.0}  # one vote of each kind beforehand
                for w, (votes, _) in zip(weight, counts, strict=True):
                    seen[votes[k]] += w
                rows.append({v: math.log(s / (all_ + 3)) for v, s in seen.items()})
            tables.append(rows)
        new = []
        for votes, _ in counts:
            a = math.log(prior) + sum(t[v] for t, v in zip(tables[0], votes, strict=True))
            b = math.log(1 - prior) + sum(t[v] for t, v in zip(tables[1], votes, strict=True))
            new.append(1 / (1 + math.exp(min(max(b - a, -50), 50))))
        posterior = new
    return posterior


def _features(kind: int, length: int, votes: Sequence[int]) -> list[str]:
    named = [f"{name}{v:+d}" for name, v in zip(LABELERS, votes, strict=True) if v]
    return ["bias", f"kind{kind}", f"length{length}", *named]


def fit_classifier(rows: Sequence[tuple[list[str], float, float]]) -> dict[str, float]:
    """Weights of named features, from (features, wanted probability, count) rows."""
    weights = {f: 0.0 for features, _, _ in rows for f in features}
    past = dict.fromkeys(weights, 1e-9)
    total = sum(n for _, _, n in rows) or 1.0
    for _ in range(_STEPS):
        slope = {f: 0.001 * w for f, w in weights.items()}
        for features, wanted, n in rows:
            score = sum(weights[f] for f in features)
            error = (1 / (1 + math.exp(-min(max(score, -30), 30))) - wanted) * n / total
            for f in features:
                slope[f] += error
        for f, s in slope.items():
            past[f] += s * s
            weights[f] -= 0.5 * s / math.sqrt(past[f])
    return weights


def _probability(weights: dict[str, float]) -> Column:
    score = F.lit(weights.get("bias", 0.0))
    for f, w in weights.items():
        if f == "bias":
            continue
        column = f.rstrip("+-0123456789")
        score = score + F.when(F.col(column) == int(f[len(column):]), F.lit(w)).otherwise(0.0)
    return 1 / (1 + F.exp(-score))


def judged_spans(docs: DataFrame) -> DataFrame:
    """(doc, tag, kind, start, end, base, probability) of the spans found in (doc, tag, body)."""
    spans = _candidates(docs)
    base = F.col("kind") < len(BASE)
    valid = F.coalesce(_valid(F.col("kind"), F.col("value")), F.lit(False))
    spans = stored(_votes(spans.where(valid)).withColumn("base", base).drop("value", "before", "after"), "spans")
    table = spans.groupBy("kind", "length", *LABELERS).agg(F.count(F.lit(1)).alias("n")).collect()
    # At most kinds x lengths x 3 ** labelers rows, whatever the size of the data.
    counts: dict[tuple[int, ...], float] = {}
    for r in table:
        votes = tuple(r[x] for x in LABELERS)
        counts[votes] = counts.get(votes, 0.0) + r["n"]
    patterns = sorted(counts.items())
    posterior = dict(zip([v for v, _ in patterns], estimate_reliability(patterns), strict=True))
    rows = []
    for r in sorted(table, key=tuple):
        votes = tuple(r[x] for x in LABELERS)
        rows.append((_features(r["kind"], r["length"], votes), posterior[votes], float(r["n"])))
    return spans.withColumn("probability", _probability(fit_classifier(rows)))


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    parts = F.transform(
        F.array_sort(spans),
        lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.array_join(parts, ",")


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, counts and digest of the base spans, and all spans, of each row.

    Missing and empty texts have no spans. Rows that agree in id and text share their
    spans. Added spans overlap no base span. An empty table gives an empty table.
    """
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc"), F.xxhash64(text_of()).alias("tag"),
        text_of().alias("body"),
    )
    judged = judged_spans(keyed).where(F.col("base") | (F.col("probability") >= MIN_PROBABILITY))
    spans = F.collect_set(F.struct("kind", "start", "end")).alias("s")  # of one text
    found = judged.groupBy("doc", "tag").agg(spans)
    own = F.filter("s", lambda x: x["kind"] < len(BASE))
    more = F.filter("s", lambda x: x["kind"] >= len(BASE))
    clear = F.filter(
        more, lambda x: ~F.exists(own, lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"]))
    )
    found = found.select("doc", "tag", own.alias("own"), clear.alias("more")).alias("f")
    same = F.col("k.doc").eqNullSafe(F.col("f.doc")) & (F.col("k.tag") == F.col("f.tag"))
    joined = keyed.select("doc", "tag").alias("k").join(found, same, "left")
    none = F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")
    own, more = F.coalesce(F.col("f.own"), none), F.coalesce(F.col("f.more"), none)
    counts = [
        F.size(F.filter(own, _is(i))).cast("long").alias(f"n_{kind}")
        for i, kind in enumerate(BASE)
    ]
    return joined.select(
        F.col("k.doc").alias("doc_id"), *counts,
        F.sha2(_joined(own), 256).alias("base_sha256"),
        _joined(F.concat(own, more)).alias("spans"),
        F.size(more).cast("long").alias("n_added"),
    )
