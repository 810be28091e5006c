"""The registered queries of this subpackage, one per operator, over their whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import cotraining, exact_dedup, line_dedup, merkle, mixing, packing, periodic_runs, quality_rules, secret_scan, sharding, simhash, token_counts, url_filter
from .common import table
from .registry import query
from .sql import MIXING, URLS


@query("op1_secret_scan")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


@query("op2_quality_classifier")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotraining.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op3_url_filter", URLS)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    listed = url_filter.listing(pages, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return url_filter.judge(pages, listed)


@query("op4_simhash")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query("op5_sharding")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


@query("op6_mixing", MIXING)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query("op7_quality_rules")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op8_exact_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups(table(spark, sf_dir, "documents"))


@query("op9_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), packing.vocabulary_path())


@query("op10_line_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op11_token_counts")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), token_counts.vocabulary_path())


@query("op12_merkle_manifest")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    altered = merkle.tampered_text(F.col("doc_id"), F.col("text"))
    return merkle.digest(merkle.manifest(merkle.leaves(table(spark, sf_dir, "documents"), claimed_text=altered))[1])


@query("op13_periodic_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digest(periodic_runs.periodic_runs(periodic_runs.planted(table(spark, sf_dir, "documents"))))


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)
