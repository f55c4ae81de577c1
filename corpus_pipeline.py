"""Corpus pipeline: from raw documents to the token ids of a training mix.

Stages, in order: documents without a known language go; one document of each
group of equal texts stays; one of each group of near copies stays; sources are
mixed to their target weights (a document taken twice stands twice); every
document is encoded and the ids decoded again.

A stage takes (spark, docs, sf_dir) and returns a frame, which is written as
Parquet and read again as the next stage's ``docs``; all but the last return
the columns of ``documents``, further columns of the input included.  Every
stage works on all rows it is given and on whole texts.  An empty table goes
through all stages; null texts have no language and go in the first.

``run`` keeps each stage's table in the shared folder the session names in
``spark.checkpoint.dir`` only until the next one is written.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.llm import bpe, common, exact_dedup, lang_id, mixing, simhash

#: Documents with a smaller share of n-grams in their best language are rejected.
MIN_LANGUAGE_SCORE = 0.1
SHINGLE_WORDS, MAX_BITS = 3, 3
MIX_SEED = 0

#: None: SQL has no learned language model, fingerprint or token ids; the tests
#: hold the stages against brute force.
ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learned from the labelled documents."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    model = lang_id.learn(docs.filter(~F.coalesce(crc % 4 == 2, F.lit(False))))
    return lang_id.keep_known(docs, model, MIN_LANGUAGE_SCORE)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one of the largest doc_id."""
    return exact_dedup.keep_latest(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies, the one of the smallest doc_id."""
    return simhash.keep_first(docs, SHINGLE_WORDS, MAX_BITS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, as often as it takes them."""
    return mixing.repeat_rows(docs, seed=MIX_SEED)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document with their digest and that of the bytes
    they decode to (last stage)."""
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                      public_tokenizers.PATTERN, ("ids", "n_tokens", "ids_sha256", "decoded_sha256"))


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("source_mix", mix_sources),
    ("byte_bpe", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``."""
    common.ship(spark)
    common.ensure_checkpoints(spark)
    base = f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    before = None
    for name, stage in STAGES:
        out, path = stage(spark, docs, sf_dir), f"{base}/{name}"
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if before:
            common.remove_path(spark, before)
        before = path
    return docs
