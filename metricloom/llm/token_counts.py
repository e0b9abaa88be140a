"""Token counts with a cache keyed by digests of content and tokenizer version."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from metricloom.llm.byte_level import is_plain, quick, token_bytes
from metricloom.llm.common import small_batches, stored, text_of
from metricloom.session import path_exists, scratch_path

CACHE = T.StructType(
    [
        T.StructField("digest", T.BinaryType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("version", T.StringType()),
    ]
)

#: Missing digests up to this number (32 bytes each) are sent to the scan of a warm cache.
BROADCAST_DIGESTS = 200_000


def tokenizer_version(path: str) -> str:
    """Digest of the vocabulary file and of the way it is called: what a count depends on."""
    with open(path, "rb") as file:
        content = hashlib.sha256(file.read()).hexdigest()
    return hashlib.sha256(f"{content}:no-added-tokens:whole-text".encode()).hexdigest()[:32]


def _encoder(path: str):
    """Counts the tokens of a list of texts as the library of the file does."""
    if path.endswith(".json"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()

        def library(texts: list[str]) -> list[list[int]]:
            return [x.ids for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        encode = library
        if is_plain(spec):
            # Strings of added tokens inside texts are theirs: only the file's library knows the rules.
            special = [x["content"] for x in spec.get("added_tokens") or []]
            encode = quick(spec, token_bytes(tokenizer), library, special)

        def count(texts: list[str]) -> list[int]:
            return [len(ids) for ids in encode(texts)]

    else:
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=path)

        def count(texts: list[str]) -> list[int]:
            return [len(x) for x in pieces.encode(texts, num_threads=1)]

    return count


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _encoder(path)
        for batch in batches:
            digests, texts = batch.column(0), batch.column(1).to_pylist()
            counts = pa.array(count([x.decode("utf-8", "replace") for x in texts]), pa.int64())
            yield pa.RecordBatch.from_arrays([digests, counts], ["digest", "n_tokens"])

    return run


def read_cache(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """Stored counts of one tokenizer version; concurrent writers may have stored one twice."""
    if not path_exists(spark, cache):
        return spark.createDataFrame([], CACHE).drop("version")
    rows = spark.read.schema(CACHE).parquet(cache).where(F.col("version") == version)
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(
    docs: DataFrame, tokenizer: str, cache: str | None = None, *, text: str = "text"
) -> DataFrame:
    """All columns of ``docs`` but the text, with ``n_bytes`` and ``n_tokens``.

    Content is normalised as the tokenizer does it: missing text is empty text, nothing
    else is changed, because this vocabulary reads bytes as they are. A digest of it is
    joined to the cache of this tokenizer version; each *distinct* missing content is
    encoded once and its count appended. The counts then come from the cache alone.
    Repeated and tied rows each get their count; an empty table gives an empty table.
    Columns of ``docs`` named like an output are replaced by it.
    """
    small_batches(docs)
    spark = docs.sparkSession
    cache = cache or scratch_path(spark, "token-cache")
    version = tokenizer_version(tokenizer)
    warm = path_exists(spark, f"{cache}/version={version}")
    content = docs.select(
        F.unhex(F.sha2(text_of(text), 256)).alias("digest"), text_of(text).alias("body")
    )
    missing = None
    if warm:
        known = read_cache(spark, cache, version)
        missing = stored(
            content.select("digest").distinct().join(known, "digest", "left_anti"), "missing"
        )
        few = missing.count() <= BROADCAST_DIGESTS
        content = content.join(F.broadcast(missing) if few else missing, "digest", "left_semi")
    distinct = content.groupBy("digest").agg(F.first("body").cast("binary").alias("body"))
    encoded = distinct.mapInArrow(_encode(tokenizer), "digest binary, n_tokens bigint")
    encoded.withColumn("version", F.lit(version)).write.partitionBy("version").mode(
        "append"
    ).parquet(cache)

    outputs = {"n_bytes", "n_tokens", "__digest"}
    kept = [c for c in docs.columns if c != text and c.lower() not in outputs]
    keyed = docs.select(
        *kept,
        F.octet_length(text_of(text)).cast("long").alias("n_bytes"),
        F.unhex(F.sha2(text_of(text), 256)).alias("__digest"),
    )
    counts = read_cache(spark, cache, version).withColumnRenamed("digest", "__digest")
    return keyed.join(counts, "__digest", "left").select(*kept, "n_bytes", "n_tokens")
