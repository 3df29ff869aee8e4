"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (
    bpe,
    centroids,
    exact,
    hilbert,
    importance,
    langid,
    linededup,
    mixing,
    mphindex,
    rules,
    superminhash,
    tagpaths,
    wordtable,
)
from .common import table
from .twins import TWINS

BYTE_BPE = "byte_bpe_multi_50k.tiktoken"
WORD_BPE = "word_bpe_49k.json"
END_ID = 2
SHARDS = 24


def _texts(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text", *more)


def bpe_digests(docs: DataFrame) -> DataFrame:
    """Ids and round trip of ``text``, as counts and digests."""
    path, pattern = public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN
    return bpe.encode(docs.select("doc_id", "text"), path, pattern, decoded="decoded").select(
        "doc_id",
        (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(_texts(spark, sf_dir))


def op2_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    # A row without a key is not held out.
    held_out = F.coalesce(hashed % 4 == 2, F.lit(False))
    docs = _texts(spark, sf_dir, "lang").withColumn("held_out", held_out)
    found = langid.identify(docs.drop("lang"), docs.filter("not held_out"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.drop_repeated_lines(_texts(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_removed", "text"
    )


def op4_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _texts(spark, sf_dir, "source", "lang")
    return hilbert.assign_shards(docs, SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.replicate(table(spark, sf_dir, "documents")).select(
        "doc_id", "source", "lang", "text", "copy", "mix_key"
    )


def op6_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    return rules.judge(_texts(spark, sf_dir), labels).select(
        "doc_id", *rules.COUNTS, "base_failed", "kept"
    )


def op7_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superminhash.near_groups(_texts(spark, sf_dir))


def op8_tag_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagpaths.extract(table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", "n_chars"
    )


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.group_copies(_texts(spark, sf_dir)).select(
        "doc_id", "keep_id", "group_size", "kept", exact.digest("text").alias("text_sha256")
    )


def op10_token_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-index")
    mphindex.write_index(
        _texts(spark, sf_dir), path, public_tokenizers.path(WORD_BPE), END_ID
    )
    rows = mphindex.read_index(spark, path).select(
        "part",
        "seq",
        F.col("key").alias("doc_id"),
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
    return mphindex.with_starts(rows, path).select("doc_id", "start", "n_tokens", "ids_crc32")


def op11_rotated_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def op12_importance_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(_texts(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op13_word_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(WORD_BPE)
    return wordtable.encode(_texts(spark, sf_dir), path, decoded="decoded").select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_byte_bpe,
        op2_string_kernel,
        op3_line_dedup,
        op4_hilbert_shards,
        op5_poisson_mix,
        op6_decision_list,
        op7_superminhash,
        op8_tag_paths,
        op9_exact_dedup,
        op10_token_index,
        op11_rotated_centroids,
        op12_importance_draw,
        op13_word_table,
    )
}

__all__ = ["QUERIES", "TWINS"]
