"""Corpus cleaning from end to end: each stage takes the documents its predecessor kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame. ``run`` writes each stage's result as Parquet in the
shared folder and reads it back as the next stage's documents. All stages but
the last return the columns of their documents; the last packs what is left.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from towerlens.llm.common import read, written
from towerlens.llm.exact_dedup import drop_exact_copies
from towerlens.llm.packing import pack
from towerlens.llm.simhash import drop_near_copies
from towerlens.llm.toxicity import drop_toxic
from towerlens.llm.winnowing import drop_contaminated


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated toxicity reaches 0.5 go; the model is fitted on the labelled rows among ``docs``."""
    return drop_toxic(docs, read(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lowered) the row with the largest doc_id stays."""
    return drop_exact_copies(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of SimHash fingerprints (3 words, 2 bits) the smallest doc_id stays."""
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of ten benchmark words (or a whole shorter item) go."""
    return drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 ids; of the ids their checksum is kept here, the operator returns them whole."""
    packed = pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("toxicity", toxicity), ("exact dedup", exact_dedup), ("simhash near dedup", simhash_dedup),
          ("benchmark decontamination", decontamination), ("packing", packing)]

#: SQL cannot express the learned and the packing stages; the tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
