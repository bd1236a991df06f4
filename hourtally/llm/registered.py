"""The queries of the training-data operators, and their SQL where SQL can say it.

Every query is ``(spark, sf_dir) -> DataFrame`` over whole tables with the parameters meant
for production.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourtally import session
from hourtally.llm import (
    decontaminate, language, licences, merkle, minhash, mixing, oracles, quality, suffixes, tokens, toxicity, urls, vectors, zones,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_cross_parsing_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language.fitted(docs)
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op2_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mixed(docs)


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.without_repeats(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def tokenizer_path() -> str:
    """The vocabulary file of the queries; the operator takes any."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op4_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = session.scratch(spark, "tokens")
    tokens.write_tokens(_table(spark, sf_dir, "documents"), path, tokenizer_path())
    return tokens.digests(spark, path)


def list_changes(pages: DataFrame) -> DataFrame:
    """Stand-in for dated lists, from the hosts of the pages themselves: when a host, a domain or
    a folder of a host was listed, taken off and listed again follows from its name's md5."""
    url = F.col("url")
    host = urls.host_of(url)
    labels = F.split(host, "[.]")
    domain = F.when(F.size(labels) > 3, F.array_join(F.slice(labels, F.lit(2), F.size(labels)), "."))
    folder = F.concat_ws("/", host, F.get(F.split(F.regexp_extract(url, urls.PATH, 1), "/"), F.lit(1)))
    named = F.array(
        F.struct(F.lit("hosts").alias("list_id"), host.alias("pattern")),
        F.struct(F.lit("domains").alias("list_id"), domain.alias("pattern")),
        F.struct(F.lit("folders").alias("list_id"), folder.alias("pattern")),
    )
    entries = pages.where(host != "").select(F.explode(named).alias("e")).select("e.*").dropna().distinct()
    byte = [F.conv(F.substring(F.md5(F.col("pattern").cast("binary")), 2 * i + 1, 2), 16, 10).cast("int") for i in range(3)]
    changes = F.array(
        F.struct(F.lit(True).alias("listed"), (byte[0]).alias("day")),
        F.struct(F.lit(False).alias("listed"), (byte[0] + 1 + byte[1]).alias("day")),
        F.struct(F.lit(True).alias("listed"), (byte[0] + 2 + byte[1] + byte[2]).alias("day")),
    )
    dated = entries.select("list_id", "pattern", F.explode(changes).alias("c"))
    start = F.lit("2024-01-01").cast("date")
    return dated.select("list_id", "pattern", "c.listed", F.date_add(start, F.col("c.day")).cast("timestamp").alias("changed_at"))


def op5_temporal_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages carry no fetch time: page n stands for a capture n hours after the start of 2024,
    going round after a year."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    hours = F.make_interval(hours=(F.col("page_id") % 8784).cast("int"))
    captures = pages.withColumn("fetched_at", F.lit("2024-01-01 00:00:00").cast("timestamp") + hours)
    found = urls.checked(captures, list_changes(pages))
    shown = [F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("fetched_at", "since")]
    return found.select("page_id", "url", "blocked", "list_id", "pattern", *shown)


def op6_pigeonhole_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_random_indexing_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    table, network = quality.fit(docs, _table(spark, sf_dir, "labels"))
    found = quality.scored(docs, table, network)
    return found.select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(_table(spark, sf_dir, "documents"))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return found.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def op9_product_quantised_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vectors.near_duplicates(_table(spark, sf_dir, "embeddings"))
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op10_licence_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.recognised(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    numbers = F.array_join(F.col("sentences").cast("array<string>"), ",")
    return found.select("doc_id", F.array_join("licences", ",").alias("licences"), numbers.alias("sentences"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(_table(spark, sf_dir, "documents"))


def op12_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = toxicity.scored(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))
    return found.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op13_hilbert_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zones.with_inertia(*zones.clustered(_table(spark, sf_dir, "embeddings")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_cross_parsing_language": op1_cross_parsing_language,
    "op2_pfair_mixing": op2_pfair_mixing,
    "op3_suffix_array_dedup": op3_suffix_array_dedup,
    "op4_token_output": op4_token_output,
    "op5_temporal_url_filter": op5_temporal_url_filter,
    "op6_pigeonhole_decontamination": op6_pigeonhole_decontamination,
    "op7_random_indexing_quality": op7_random_indexing_quality,
    "op8_minhash_near_dedup": op8_minhash_near_dedup,
    "op9_product_quantised_dedup": op9_product_quantised_dedup,
    "op10_licence_sentences": op10_licence_sentences,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_kneser_ney_toxicity": op12_kneser_ney_toxicity,
    "op13_hilbert_clustering": op13_hilbert_clustering,
}

ORACLES: dict[str, str] = dict(oracles.ORACLES)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)
