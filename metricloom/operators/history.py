"""The fourteen change features: diffusion, size, purpose, history and experience.

Input is a change log with one row per change and touched file (author, date and message
are those of the change): ``repo, hash,
commit_seq, author, committer_date, msg, path, added, deleted, nloc, merge``.
``commit_seq`` is a whole number that orders the changes of a repository.

History features only see strictly earlier changes of the same repository.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from metricloom.functions.scalars import (
    days_between,
    directory,
    half_even,
    is_corrective,
    message_head,
    safe_ratio,
    subsystem,
)
from metricloom.operators.cleaning import commit_filter
from metricloom.operators.ordered import ROWS_PER_TASK, Blocks, _bucket, find_blocks, heavy_buckets, running_before
from metricloom.session import written_once

COMMIT = ["repo", "hash"]
# What a change has one of. Grouping by all of it, instead of taking a minimum of each,
# keeps the aggregation hash-based: text minima would force sorting.
IDENTITY = [*COMMIT, "commit_seq", "author", "committer_date", "msg"]
DAYS_PER_YEAR = 365.25

# The feature names, by dimension.
CHANGE_FEATURES = [
    "NS", "ND", "NF", "Entropy",
    "LA", "LD", "LT",
    "FIX",
    "NDEV", "AGE", "NUC",
    "EXP", "REXP", "SEXP",
]


def _weighted(lines: Column) -> Column:
    return F.when(lines > 0, lines * F.log2(lines))


def _entropy_of(total: Column, weighted: Column, files: Column) -> Column:
    """Normalised Shannon entropy of the lines over the files of a change.

    With T the total and S the sum of c*log2(c), the entropy is log2(T) - S/T: plain
    sums, so it needs no second pass over the files. Files without lines add nothing to
    S but count in the normaliser log2(files).
    """
    shannon = F.log2(F.nullif(total, F.lit(0.0))) - safe_ratio(weighted, total)
    bits = F.log2(F.nullif(files, F.lit(1)).cast("double"))
    return F.coalesce(F.greatest(safe_ratio(shannon, bits), F.lit(0.0)), F.lit(0.0))


def _size_aggregates() -> dict[str, Column]:
    return {
        "LA": F.sum("added"),
        "LD": F.sum("deleted"),
        "LT": F.coalesce(
            F.avg(F.when(F.col("nloc") >= 0, F.col("nloc").cast("double"))), F.lit(0.0)
        ),
    }


def _per_commit(changes: DataFrame, aggregates: dict[str, Column]) -> DataFrame:
    grouped = commit_filter(changes).groupBy(*COMMIT)
    return grouped.agg(*[value.alias(name) for name, value in aggregates.items()])


def diffusion(changes: DataFrame) -> DataFrame:
    """Subsystems, directories, files and entropy per change.

    Rolled up from files to directories, subsystems and changes, so that two distinct
    counts do not multiply the rows of the log. Each directory lies in one subsystem,
    but for the root: its files are subsystems of their own and share the empty directory.
    """
    lines = (F.col("added") + F.col("deleted")).cast("double")
    path, folder = F.col("path"), F.col("folder")
    sums = [F.sum(c).alias(c) for c in ("NF", "total", "weighted")]
    folders = commit_filter(changes).groupBy(
        *COMMIT, subsystem(path).alias("area"), directory(path).alias("folder")
    ).agg(
        F.count(F.lit(1)).alias("NF"), F.sum(lines).alias("total"), F.sum(_weighted(lines)).alias("weighted")
    )
    areas = folders.groupBy(*COMMIT, "area").agg(
        F.count_if(folder != "").alias("inner"), F.max((folder == "").cast("int")).alias("root"), *sums
    )
    files = F.sum("NF")
    entropy = _entropy_of(F.sum("total"), F.sum("weighted"), files)
    return areas.groupBy(*COMMIT).agg(
        F.count("area").alias("NS"),
        (F.sum("inner") + F.coalesce(F.max("root"), F.lit(0))).alias("ND"),
        files.alias("NF"), half_even(entropy, 6).alias("Entropy"),
    )


def size(changes: DataFrame) -> DataFrame:
    """Lines added, lines deleted and mean file size per change."""
    return _per_commit(changes, _size_aggregates()).withColumn("LT", half_even(F.col("LT"), 2))


def purpose(changes: DataFrame) -> DataFrame:
    """Is the change a correction?"""
    messages = commit_filter(changes).select(*COMMIT, "msg").distinct()
    return messages.select(*COMMIT, is_corrective(F.col("msg")).cast("int").alias("FIX"))


def _touches(changes: DataFrame) -> DataFrame:
    """One row per change and touched file; a path may repeat within a change."""
    return commit_filter(changes).select(
        "repo", "path", "commit_seq", "hash", "author", "committer_date"
    )


def _author_areas(changes: DataFrame) -> DataFrame:
    """One row per change and subsystem."""
    return (
        commit_filter(changes)
        .select(*COMMIT, "commit_seq", "author", subsystem(F.col("path")).alias("area"))
        .distinct()
    )


def _blocks(changes: DataFrame, rows_per_task: int) -> Blocks:
    """Blocks along the order of changes, shared by the totals of files, authors and areas."""
    return find_blocks(commit_filter(changes), "commit_seq", True, rows_per_task, at_most=changes.count())


def _file_history(touches: DataFrame, blocks: Blocks, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Earlier touches, earlier distinct authors and previous date per touched file.

    An author counts from the first touch on, so no set of authors is ever collected. Only
    files that may have more than ``rows_per_task`` touches are cut into blocks.
    """
    if not blocks.bounds:
        return _small_file_history(touches)
    keys = ["repo", "path"]
    heavy = heavy_buckets(touches, keys, rows_per_task)
    if not heavy:
        return _small_file_history(touches)
    light = _small_file_history(touches.where(~_bucket(keys).isin(heavy))).drop("author", "new_author", "n")
    large = _large_file_history(touches.where(_bucket(keys).isin(heavy)), blocks, rows_per_task)
    return light.unionByName(large.drop("new_author", "n"))


def _file_totals() -> tuple[dict[str, Column], dict[str, Column]]:
    sums = {"authors_before": F.col("new_author"), "touches_before": F.col("n")}
    return sums, {"last_date": F.col("committer_date")}


def _small_file_history(touches: DataFrame) -> DataFrame:
    """Both windows run on one shuffle: the files of a task include all their authors."""
    by_author = Window.partitionBy("repo", "path", "author").orderBy("commit_seq")
    marked = touches.repartition("repo", "path").withColumns(
        {"n": F.lit(1).cast("long"), "new_author": (F.row_number().over(by_author) == 1).cast("long")}
    )
    return running_before(marked, ["repo", "path"], "commit_seq", *_file_totals(), blocks=Blocks())


def _large_file_history(touches: DataFrame, blocks: Blocks, rows_per_task: int) -> DataFrame:
    one = F.lit(1).cast("long")
    # First touches as marker rows from a plain minimum, which combines before the shuffle
    # and lets the rows of a file be cut into blocks.
    first = touches.groupBy("repo", "path", "author").agg(F.min("commit_seq").alias("commit_seq"))
    zero = F.lit(0).cast("long")
    marks = first.select(
        "repo", "path", "commit_seq", one.alias("new_author"), zero.alias("n")
    )
    rows = touches.withColumns({"n": one, "new_author": zero}).drop("author")
    both = rows.unionByName(marks, allowMissingColumns=True)
    return running_before(
        both, ["repo", "path"], "commit_seq", *_file_totals(), blocks=blocks, rows_per_task=rows_per_task
    ).where("n > 0")


def _history_from(file_history: DataFrame) -> DataFrame:
    age = days_between(F.col("last_date"), F.col("committer_date"))
    return file_history.groupBy(*COMMIT).agg(
        F.avg("authors_before").alias("NDEV"),
        F.coalesce(F.avg(F.when(F.col("last_date").isNotNull(), age)), F.lit(0.0)).alias("AGE"),
        F.avg("touches_before").alias("NUC"),
    )


def history(changes: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Mean earlier authors, mean days since the previous change, mean earlier changes."""
    blocks = _blocks(changes, rows_per_task)
    raw = _history_from(_file_history(_touches(changes), blocks, rows_per_task))
    return raw.select(*COMMIT, *[half_even(F.col(c), 2).alias(c) for c in ("NDEV", "AGE", "NUC")])


def _experience_sums(as_of: datetime) -> dict[str, Column]:
    years = days_between(F.col("committer_date"), F.lit(as_of).cast("timestamp")) / DAYS_PER_YEAR
    return {"EXP": F.lit(1).cast("long"), "REXP": F.lit(1.0) / (years + 1.0)}


def _by_area(areas: DataFrame, **shared) -> DataFrame:
    """Earlier changes of the author in the areas of a change, and the number of its areas."""
    before = running_before(
        areas, ["repo", "author", "area"], "commit_seq", sums={"before": F.lit(1).cast("long")}, **shared
    )
    return before.groupBy(*COMMIT).agg(F.sum("before").alias("SEXP"), F.count(F.lit(1)).alias("NS"))


def _shared(changes: DataFrame, blocks: Blocks, rows_per_task: int) -> dict:
    """What the totals of authors and of their areas have in common."""
    area = subsystem(F.col("path")).alias("area")
    touched = commit_filter(changes).select("repo", "author", area)  # as many rows of a group, or more
    return {"blocks": blocks, "rows_per_task": rows_per_task, "counted": touched}


def _add_experience(
    commits: DataFrame, changes: DataFrame, as_of: datetime, blocks: Blocks, rows_per_task: int
) -> DataFrame:
    """Join the author's past onto one row per change."""
    shared = _shared(changes, blocks, rows_per_task)
    by_author = running_before(commits, ["repo", "author"], "commit_seq", sums=_experience_sums(as_of), **shared)
    return by_author.join(_by_area(_author_areas(changes), **shared), COMMIT)


def experience(changes: DataFrame, as_of: datetime, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Earlier changes of the author: count, recency-weighted sum, count in the same areas.

    Recency is measured back from ``as_of``, an argument, so that a rerun gives the same.
    """
    commits = commit_filter(changes).select(*IDENTITY).distinct()
    raw = _add_experience(commits, changes, as_of, _blocks(changes, rows_per_task), rows_per_task)
    return raw.select(*COMMIT, "EXP", half_even(F.col("REXP"), 4).alias("REXP"), "SEXP")


def _commits_with_areas(changes: DataFrame) -> DataFrame:
    """One row per change: its own features, and its areas as an array.

    The file rows move once, dealt by change; folders, areas and changes are then counted in place.
    """
    path, folder = F.col("path"), F.col("folder")
    lines = (F.col("added") + F.col("deleted")).cast("double")
    known = F.when(F.col("nloc") >= 0, F.col("nloc").cast("double"))
    dealt = commit_filter(changes).select(
        *IDENTITY, subsystem(path).alias("area"), directory(path).alias("folder"), "added", "deleted", "nloc"
    ).repartition(*COMMIT)
    folders = dealt.groupBy(*IDENTITY, "area", "folder").agg(
        F.count(F.lit(1)).alias("NF"), F.sum(lines).alias("total"), F.sum(_weighted(lines)).alias("weighted"),
        F.sum("added").alias("LA"), F.sum("deleted").alias("LD"),
        F.sum(known).alias("nloc"), F.count(known).alias("sized"),
    )
    files = F.sum("NF")
    # Each directory lies in one subsystem, but for the root.
    folded = F.count_if(folder != "") + F.coalesce(F.max((folder == "").cast("long")), F.lit(0))
    return folders.groupBy(*IDENTITY).agg(
        folded.alias("ND"), files.alias("NF"), _entropy_of(F.sum("total"), F.sum("weighted"), files).alias("Entropy"),
        F.sum("LA").alias("LA"), F.sum("LD").alias("LD"),
        F.coalesce(F.sum("nloc") / F.nullif(F.sum("sized"), F.lit(0)), F.lit(0.0)).alias("LT"),
        F.collect_set("area").alias("areas"),
    )


def change_features(
    changes: DataFrame, as_of: datetime, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """All fourteen features per change with its identifying columns.

    Each of the three pasts is written before the next begins, so that the disk holds the
    shuffles of one of them at a time. The changes carry their areas along: those are spread
    where the author's rows meet, and the many file rows move once for both.
    """
    blocks = _blocks(changes, rows_per_task)
    shared = _shared(changes, blocks, rows_per_task)
    past = written_once(_history_from(_file_history(_touches(changes), blocks, rows_per_task)), "past")
    commits = written_once(_commits_with_areas(changes), "commits")
    known = commits.select(*COMMIT, "commit_seq", "author", "areas")
    if not blocks.bounds or not heavy_buckets(shared["counted"], ["repo", "author"], rows_per_task):
        known = known.repartition("repo", "author")  # also deals the areas: they need no shuffle of their own
    areas = known.select(*COMMIT, "commit_seq", "author", F.explode("areas").alias("area")).distinct()
    by_area = written_once(_by_area(areas, **shared), "areas")
    by_author = running_before(
        commits.drop("areas"), ["repo", "author"], "commit_seq", sums=_experience_sums(as_of), **shared
    )
    by_author = written_once(by_author, "experience", instead_of=[commits])
    joined = by_author.join(by_area, COMMIT).join(past, COMMIT)
    joined = joined.withColumn("FIX", is_corrective(F.col("msg")).cast("int"))
    digits = {"Entropy": 6, "LT": 2, "NDEV": 2, "AGE": 2, "NUC": 2, "REXP": 4}
    return joined.select(
        *COMMIT, "author", "committer_date", "commit_seq",
        message_head(F.col("msg")).alias("msg_head"),
        *[
            half_even(F.col(c), digits[c]).alias(c) if c in digits else F.col(c)
            for c in CHANGE_FEATURES
        ],
    )
