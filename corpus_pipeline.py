"""A training corpus from raw documents: five stages, each an operator of `departure_risk.llm`.

A stage takes (spark, docs, folder) and gives the documents that go on, with the columns of `documents`; the last one gives
the index of the token files. `run` writes each stage's result as Parquet below `spark.checkpoint.dir` and reads it back, so
a stage never repeats the work of the ones before it.

1. quality: a byte-level network learned from `labels` rejects low scores.
2. near_duplicates: one document of each group of near duplicates stays, the one with the smallest id.
3. decontamination: documents that overlap an item of `benchmark` go.
4. mixing: documents are repeated or left out so that sources come near their target weights.
5. tokens: the ids of all documents in Simple-8b files.
"""

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from departure_risk.llm import decontaminate, mixing, neardup, quality, tokens
from departure_risk.session import shared_dir


def keep_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return quality.accepted(docs, quality.train(docs, labels))


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return neardup.deduplicated(docs)


def drop_benchmark_overlaps(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def write_token_files(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    # fewer pieces than by default: these workers have served four other stages
    written = tokens.write_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), kept=150_000)
    return tokens.read_tokens(written).drop("file")


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("decontamination", drop_benchmark_overlaps),
    ("mixing", mix_sources),
    ("tokens", write_token_files),
]

#: Learned scores, hashed draws and tokenizers are beyond SQL; tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{shared_dir(spark).rstrip('/')}/corpus-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES = {"pipeline": run}
SQL = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
