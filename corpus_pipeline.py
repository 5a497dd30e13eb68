"""From raw documents to token ids: five stages, each over all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from scanlake.llm import byte_bpe, exact_dedup, mixing, quality, simhash
from scanlake.llm.common import written

BPE_RANKS = "byte_bpe_multi_50k.tiktoken"


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_equals(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact(docs)


def one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats of a document are repeated rows."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids and the digests of ids and of the bytes they decode to."""
    import public_tokenizers

    rows = byte_bpe.encoded(docs, public_tokenizers.path(BPE_RANKS), public_tokenizers.PATTERN)
    return byte_bpe.digests(rows).select("doc_id", "ids", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_good),
    ("exact_dedup", one_of_equals),
    ("near_dedup", one_of_near),
    ("mixing", mix),
    ("encoding", encode),
]

#: Drawing, components and subset sums are not SQL; tests/llm checks run() by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
