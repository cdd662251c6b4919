"""Queries of the problems on texts, over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm import content, mixing, packing, vocabulary
from caseloom.llm.sql import SQL  # noqa: F401
from caseloom.session import stored
from caseloom.sources.tables import table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    mapped = vocabulary.dirty_terms(table(spark, d, "extraction_results"), table(spark, d, "symptom_vocabulary"))
    return mapped.select("extraction_id", "term_no", "symptom")


def p2_listed(spark: SparkSession, d: str) -> DataFrame:
    mapped = vocabulary.map_terms(table(spark, d, "extraction_results"), table(spark, d, "symptom_vocabulary"))
    return mapped.where("listed").select("extraction_id", "term_no", "symptom")


def p2_mapped(spark: SparkSession, d: str) -> DataFrame:
    mapped = vocabulary.map_terms(table(spark, d, "extraction_results"), table(spark, d, "symptom_vocabulary"))
    return vocabulary.as_lists(mapped)


def p2_unmatched(spark: SparkSession, d: str) -> DataFrame:
    mapped = vocabulary.map_terms(table(spark, d, "extraction_results"), table(spark, d, "symptom_vocabulary"))
    return vocabulary.unmatched_report(mapped)


def p7_pack(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(table(spark, d, "documents"), table(spark, d, "pack_capacities"))


def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    capacities = table(spark, d, "pack_capacities")
    return packing.fill_report(packing.pack_documents(table(spark, d, "documents"), capacities), capacities)


def p7_cover(spark: SparkSession, d: str) -> DataFrame:
    """What has to hold of any packing: all documents in containers of each capacity, none overfull, none cut without need."""
    capacities = table(spark, d, "pack_capacities")
    packed = stored(packing.pack_documents(table(spark, d, "documents"), capacities), "packed")
    caps = capacities.select("capacity_id", F.col("capacity_tokens").alias("capacity"))
    boxes = packed.groupBy("capacity_id", "container_id").agg(F.sum("tokens").alias("load")).join(caps, "capacity_id")
    texts = packed.groupBy("capacity_id", "doc_id").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("pieces"), F.max("piece_no").alias("last")).join(caps, "capacity_id")
    overfull = boxes.groupBy("capacity_id").agg(F.count_if(F.col("load") > F.col("capacity")).alias("overfull"))
    cut = (F.col("pieces") > 1) & (F.col("tokens") <= F.col("capacity")) | (F.col("pieces") != F.col("last"))
    return texts.groupBy("capacity_id", "capacity").agg(F.count("*").alias("documents"), F.count_if(cut).alias("needless_cuts")).join(overfull, "capacity_id")


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_documents(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    targets = table(spark, d, "mix_targets")
    return mixing.share_report(mixing.mix_documents(table(spark, d, "documents"), targets), targets)


def p8_cover(spark: SparkSession, d: str) -> DataFrame:
    """What has to hold of any mixture: per target source the texts used too often, and those used that are not the first of their copies there."""
    documents, targets = table(spark, d, "documents"), table(spark, d, "mix_targets")
    used = mixing.mix_documents(documents, targets).select("doc_id", "source", "repeats")
    source = content.plain_source(F.col("source"))
    named = documents.select("doc_id", source.alias("source"), F.sha2("text", 256).alias("hash"))
    known = named.join(targets.select(source.alias("source")).distinct(), "source", "left_semi")
    first = known.groupBy("hash").agg(F.min("doc_id").alias("doc_id")).select("doc_id", F.lit(True).alias("first"))
    wanted = targets.select(source.alias("source"), "max_repeats")
    return wanted.join(used.join(first, "doc_id", "left"), "source", "left").groupBy("source", "max_repeats").agg(
        F.count_if(F.col("repeats") > F.col("max_repeats")).alias("over_repeated"), F.count_if(F.col("doc_id").isNotNull() & F.col("first").isNull()).alias("later_copies")
    )


def _scored(spark: SparkSession, d: str, below: bool = False) -> DataFrame:
    documents = table(spark, d, "documents")
    return content.score_documents(documents, content.fit_reviews(documents, table(spark, d, "content_reviews")), below)


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return content.flagged(_scored(spark, d))


def p9_scores(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d, below=True).select("doc_id", *[F.round(k, 4).alias(f"{k}_score") for k in content.CATEGORIES])


def p9_rates(spark: SparkSession, d: str) -> DataFrame:
    return content.source_rates(_scored(spark, d))


QUERIES = {f.__name__: f for f in (p2_found, p2_listed, p2_mapped, p2_unmatched, p7_pack, p7_fill, p7_cover, p8_mix, p8_shares, p8_cover, p9_found, p9_scores, p9_rates)}
