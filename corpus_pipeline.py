"""From documents to packed sequences: language, quality, near duplicates, mixture, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindrift.llm import langid, mixing, packing, quality, simhash
from spindrift.llm.queries import held_out, tokenizer
from spindrift.llm.shared import stored

#: Documents that SimHash's deletion variants, or for those farther apart bands, bring together link from a Jaccard
#: similarity of 0.8 of their five-word shingles, which is verified.
NEAR = simhash.Resemblance(shingle=5, similarity=0.8)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose language is told with a margin, by dictionaries of documents of a known language that aren't
    held out; one without letters goes. lang is what was told from here on, so that no missing or wrong label picks a later threshold."""
    found = langid.identify(docs, langid.learn(docs.filter(~held_out())), prefix="_")
    return found.filter("NOT _rejected").withColumn("lang", F.col("_lang_pred")).select(*docs.columns)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose perplexity isn't above their language's threshold; the model is of those labelled good and not toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic")
    return quality.judged(docs, labels).filter("keep").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: that of the smallest doc_id."""
    return simhash.without_copies(docs, settings=NEAR)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents as often as it takes them."""
    return mixing.repeated(mixing.mix(docs)).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their sequences, with their ids."""
    return packing.pack(docs, tokenizer())


STAGES = [("language ID", language_id), ("quality classifier", quality_classifier), ("SimHash near-dedup", near_duplicates), ("mixing", mixture), ("packing", packed)]

#: SQL has no compression, XXH64 or tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
