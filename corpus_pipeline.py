"""From documents to tokens: reject, deduplicate, mask, mix and encode.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before kept; it is written as
Parquet and read again. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacantia.llm import bpe, minhash, mixing, pii, quality
from vacantia.llm.registry import stored, table, with_package
from vacantia.session import work_dir

#: Percent of common shingles that makes near-duplicates here.
NEAR = 80
#: Pieces and pairs that a worker remembers, which it does beside what the other stages hold.
MEMO = 50_000
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@with_package
def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling towards those labelled good keeps."""
    model = quality.fit(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality.resample(docs, model).where("kept").select(docs.columns)


@with_package
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates one row, with the smallest id."""
    return minhash.one_of_each(docs, NEAR)


@with_package
def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with the names of kinds in place of personal data; ``n_chars`` is that of the new text."""
    masked = pii.mask(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked.select(docs.columns)


@with_package
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    mixed = mixing.mix(docs, weights=[5, 2, 1]).where("times > 0")
    times = F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))
    return mixed.select(*docs.columns, times.alias("__time")).drop("__time")


@with_package
def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, packed, and whether they decode to exactly its bytes."""
    own = ["doc_id", "lang", "source"]  # texts and decoded bytes, thrice the ids, stay in the worker
    found = bpe.encode(docs, RANKS, public_tokenizers.PATTERN, keep=own, memo=MEMO, exact="exact")
    return found.select(*own, bpe.token_count().alias("n_tokens"), "ids", "exact")


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", mask_personal_data),
    ("mixing", mix_sources),
    ("tokens", encode_tokens),
]
#: Hashes decide what is sampled; the stages are tested against plain versions of themselves.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
