"""Labelling of changes that introduced lines which a later correction deleted."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from metricloom.functions.scalars import (
    half_even,
    is_corrective,
    is_meaningful_line,
    is_python,
    safe_ratio,
)
from metricloom.operators.cleaning import commit_filter
from metricloom.operators.ordered import ROWS_PER_TASK, running_before
from metricloom.session import written_once

LINE = ["repo", "path", "line_id"]


def fix_candidates(changes: DataFrame, lines: DataFrame, max_files: int | None = None) -> DataFrame:
    """Files of corrections whose deletions are traced back.

    Source files with deletions and at least one deleted line that is neither blank nor a
    comment. ``max_files`` keeps only the first files of a change in file order; by default
    all of them are traced.
    """
    files = commit_filter(changes).where(
        is_corrective(F.col("msg")) & is_python(F.col("path")) & (F.col("deleted") > 0)
    )
    if max_files is not None:
        position = F.row_number().over(Window.partitionBy("repo", "hash").orderBy("file_order"))
        files = files.withColumn("__pos", position).where(F.col("__pos") <= max_files)
    real = lines.where((F.col("op") == "delete") & is_meaningful_line(F.col("content")))
    return (
        files.join(real.select("repo", "hash", "path").distinct(), ["repo", "hash", "path"], "left_semi")
        .select("repo", "hash", "commit_seq", "path")
        .distinct()
    )


def line_origins(
    candidates: DataFrame, lines: DataFrame, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """For every deleted line of a candidate file, the change that last wrote it before.

    An as-of join without a range condition: writes and deletes share one ordered
    history per line and each delete takes the latest write in front of it.
    """
    deletes = lines.where(F.col("op") == "delete").join(
        candidates.select("repo", "hash", "path"), ["repo", "hash", "path"], "left_semi"
    )
    writes = lines.where(F.col("op") == "write")
    columns = [*LINE, "hash", "commit_seq", "op"]
    both = writes.select(*columns).unionByName(deletes.select(*columns))
    written = F.when(F.col("op") == "write", F.col("hash"))
    return (
        running_before(
            both, LINE, "commit_seq", latest={"origin": written},
            at_most=lines.count(), rows_per_task=rows_per_task, counted=lines.select(*LINE),
        )
        .where((F.col("op") == "delete") & F.col("origin").isNotNull())
        .select("repo", F.col("hash").alias("fix_hash"), "path", "line_id", "origin")
    )


def inducing_label(commits: DataFrame, origins: DataFrame, label: str = "is_buggy") -> DataFrame:
    """1 for changes named as an origin within their own repository, else 0."""
    named = origins.select("repo", F.col("origin").alias("hash")).distinct()
    marked = named.withColumn(label, F.lit(1))
    return commits.join(marked, ["repo", "hash"], "left").withColumn(
        label, F.coalesce(F.col(label), F.lit(0))
    )


def labelling_report(labelled: DataFrame, fix: str = "FIX", label: str = "is_buggy") -> DataFrame:
    """Changes, corrections, labelled changes and their rate per repository."""
    return labelled.groupBy("repo").agg(
        F.count(F.lit(1)).alias("commits"),
        F.sum(F.col(fix).cast("long")).alias("fixes"),
        F.sum(F.col(label).cast("long")).alias("labelled"),
        half_even(safe_ratio(F.sum(label) * 100, F.count(F.lit(1))), 1).alias("rate_pct"),
    )


def label_changes(
    changes: DataFrame, lines: DataFrame, commits: DataFrame, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """The whole labelling: candidates, origins, labels. The origins, few against the lines, are written first."""
    origins = line_origins(fix_candidates(changes, lines), lines, rows_per_task)
    return inducing_label(commits, written_once(origins.select("repo", "origin").distinct(), "origins"))
