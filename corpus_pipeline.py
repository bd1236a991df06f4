"""From raw documents to token files: five stages, each written to Parquet and read again.

1. Language: documents without a letter, so in no language, go.
2. Near duplicates: one document of each group stays.
3. Benchmark items: documents that hold one go.
4. Mixing: documents are laid out in the order that gives each source its weight.
5. Tokens: the ids are written in that order, and read back.

A stage is ``(spark, docs, sf_dir) -> DataFrame``. All but the last return the columns of the
documents. The order of stage 4 is the order of rows in its files, which stage 5 reads.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourtally import session
from hourtally.llm import decontaminate, language, minhash, mixing, registered, stored, tokens


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = language.identify(docs, language.fitted(docs))
    return found.where("lettered").select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.deduplicated(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    laid_out = mixing.mixed(docs).repartitionByRange("position").sortWithinPartitions("position")
    return laid_out.select(docs.columns)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = session.scratch(spark, "tokens")
    rows = docs if docs.inputFiles() else stored.written(docs, "ordered")
    file = F.col("_metadata.file_name")
    order = [F.regexp_extract(file, "part-([0-9]+)", 1).cast("long"), file, F.col("_metadata.row_index")]
    tokens.write_tokens(rows, path, registered.tokenizer_path(), order)
    return tokens.digests(spark, path)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("minhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("source_mixing", mix_sources),
    ("token_output", write_token_files),
]

# Languages, near duplicates and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another, from ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored.written(stage(spark, docs, sf_dir), name)
    return docs
