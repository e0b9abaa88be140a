"""The registered queries of this subpackage: thin forms of its operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from metricloom.llm import alignment, chat, licenses, line_dedup, mixing, near_dedup, neighbours, personal_data, pieces, quality, secret_scan, spelling, token_counts
from metricloom.llm.common import documents, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MAX_TOKENS = 512


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    counted = token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > MAX_TOKENS)


@query
def op7_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.scan_secrets(documents(spark, folder), ["doc_id"])


@query
def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    model = quality.train_quality_model(docs, table(spark, folder, "labels"))
    return quality.score_quality(docs, model).drop("text")


@query
def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.dedup_lines(documents(spark, folder).select("doc_id", "text"))


@query
def op4_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_components(documents(spark, folder).select("doc_id", "text"))


@query
def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text", "source")
    return mixing.mix_documents(docs)


@query
def op9_pieces(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    coded = pieces.encode(docs, ["doc_id"], public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        F.xxhash64("ids").alias("ids_hash"),
        "same",
    )


@query
def op6_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data.find_personal_data(documents(spark, folder).select("doc_id", "text"))


@query
def op8_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"))


@query
def op5_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    return chat.format_chats(table(spark, folder, "conversations"))


def planted_deletions(doc_id: Column, run: Column) -> Column:
    """The run, or if 97 divides the crc32 of id and run, the run less one letter."""
    h = F.crc32(F.concat(doc_id, F.lit(":"), run).cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    short = F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))
    return F.when(h % 97 == 0, short).otherwise(run)


@query
def op11_spelling(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    return spelling.group_variants(spelling.word_counts(docs, planted_deletions))


@query
def op13_licenses(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan_licenses(documents(spark, folder).select("doc_id", "text"))
    return found.drop("spans")


@query
def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    left, right = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    aligned = alignment.align(docs, left, right).withColumn("groups_sha256", digest).drop("groups")
    return alignment.score_links(aligned).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
