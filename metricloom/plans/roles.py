"""The driver tables read in the roles the operators expect."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, functions as F

from metricloom.operators.cleaning import drop_incomplete
from metricloom.session import use_utc

METRICS = [
    "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "p_size",
    "p_retailprice",
]
LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
DAY_SPAN = 100_000_000_000_000
#: File rows of a change log that one task groups by change.
FILES_PER_TASK = 250_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def metric_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide numeric table with missing values, a constant column and an empty column."""
    lines = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    return lines.join(parts, lines["l_partkey"] == parts["p_partkey"]).select(
        F.col("l_orderkey").alias("id"),
        *["l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate"],
        *[F.col(c).cast("double").alias(c) for c in METRICS if c != "l_linenumber"],
        F.nullif(F.col("l_linenumber"), F.lit(7)).cast("double").alias("l_linenumber"),
        F.lit(3.0).alias("constant"),
        F.lit(None).cast("double").alias("empty"),
    )


def change_log(spark: SparkSession, sf_dir: str, by_change: bool = False) -> DataFrame:
    """One row per change and touched file.

    ``commit_seq`` orders the changes of a repository by (date, key). It is composed
    arithmetically, so no global numbering of the changes is needed. ``by_change`` is for
    results grouped by change: their state is many times a file row, so tasks are dealt by the
    number of those rows instead of their bytes.
    """
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    regions = table(spark, sf_dir, "region")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    # Changes and files are completed apart: the many file rows move once for their part and
    # once for their change, and those of a change end up beside each other.
    owned = (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    files = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    n = lines.count() if by_change else 0
    if n > FILES_PER_TASK:
        parts = max(math.ceil(n / FILES_PER_TASK), spark.sparkContext.defaultParallelism)
        files = files.repartition(parts, "l_orderkey")
    joined = files.join(owned, F.col("l_orderkey") == F.col("o_orderkey"))
    stamp = F.col("o_orderdate").cast("timestamp")
    folder = F.when(F.col("p_partkey") % 10 == 0, F.lit("")).otherwise(
        F.concat("p_brand", F.lit("/"), "p_type", F.lit("/"))
    )
    suffix = F.when(F.col("p_size") % 4 == 0, F.lit(".txt")).otherwise(F.lit(".py"))
    message = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("Fix crash #"), "o_orderkey"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.concat(F.lit("closes #"), "o_orderkey"))
        .otherwise(F.concat(F.lit("update "), "o_orderpriority"))
    )
    deleted = F.when(F.col("l_linestatus") == "F", F.col("l_linenumber")).otherwise(F.lit(0))
    return joined.select(
        F.col("r_name").alias("repo"),
        F.col("o_orderkey").alias("hash"),
        (F.unix_date(stamp.cast("date")).cast("long") * F.lit(DAY_SPAN) + F.col("o_orderkey")).alias(
            "commit_seq"
        ),
        ((F.col("o_orderstatus") == "P") & (F.col("o_orderkey") % 10 == 0)).alias("merge"),
        F.col("c_name").alias("author"),
        stamp.alias("committer_date"),
        message.alias("msg"),
        F.concat(folder, F.lit("f"), F.col("l_partkey"), suffix).alias("path"),
        F.struct(*LINE_COLUMNS).alias("file_order"),
        F.col("l_quantity").cast("long").alias("added"),
        deleted.cast("long").alias("deleted"),
        F.nullif(F.col("p_size"), F.lit(50)).cast("long").alias("nloc"),
        F.col("l_linenumber").alias("line_id"),
    )


def line_log(changes: DataFrame) -> DataFrame:
    """Line writes and deletes that go with the file changes."""
    content = (
        F.when(F.col("line_id") % 3 == 0, F.lit("# note"))
        .when(F.col("line_id") % 3 == 1, F.lit(""))
        .otherwise(F.lit("x = 1"))
    )
    return changes.where(~F.col("merge")).select(
        "repo", "hash", "commit_seq", "path", "line_id",
        F.when(F.col("deleted") == 0, F.lit("write")).otherwise(F.lit("delete")).alias("op"),
        content.alias("content"),
    )


def commit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per change without files, from the event stream table."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("hash"),
        F.col("user_id").alias("author"),
        F.col("ts").cast("timestamp").alias("committer_date"),
        F.col("event_type").alias("msg"),
        (F.get_json_object("props", "$.k").cast("long") % 5).alias("repo"),
        F.col("value").alias("churn"),
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores in [0, 1] with binary labels."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.col("ts").cast("timestamp").alias("date"),
        (F.col("value") / 500.0).alias("score"),
        (F.col("event_type") == "error").cast("int").alias("label"),
    )


TEXT_FEATURES = ["n_chars_log", "words_log", "lines_log", "mean_word_log", "other_share"]


def labelled(spark: SparkSession, sf_dir: str, target: str = "toxic") -> DataFrame:
    """Numeric text features with a binary target and a date, for the learners."""
    text = F.col("text")
    words = F.size(F.split(F.trim(text), r"\s+")).cast("double")
    plain = F.length(F.regexp_replace(text, r"[^\x00-\x7F]", ""))
    features = (
        table(spark, sf_dir, "documents")
        .select(
            F.col("doc_id").alias("id"),
            F.timestamp_add("HOUR", F.col("doc_id"), F.lit("2024-01-01").cast("timestamp")).alias(
                "date"
            ),
            F.log1p(F.length(text).cast("double")).alias("n_chars_log"),
            F.log1p(words).alias("words_log"),
            F.log1p(F.size(F.split(text, "\n")).cast("double")).alias("lines_log"),
            F.log1p(F.length(text) / words).alias("mean_word_log"),
            (1.0 - plain / F.greatest(F.length(text), F.lit(1))).alias("other_share"),
        )
    )
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"), F.col(target).cast("int").alias("label")
    )
    return drop_incomplete(features.join(labels, "id"), [*TEXT_FEATURES, "label"])
