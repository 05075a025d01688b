"""A corpus pipeline over ``documents``: toxicity, line dedup, SimHash near-dedup, mixing to target
weights, best-fit packing. Every stage reads what its predecessor wrote and works on all of it;
all but the last return the columns of ``documents`` (the last returns the packed pieces)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duelspark.llm import linededup, mixing, packing, simhash, toxicity
from duelspark.llm.common import materialize, read

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5. The classifier learns from ``labels``."""
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where("predicted = 0").select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that at least ten of the documents share are removed; n_chars follows the text."""
    kept = linededup.drop_common_lines(docs)
    return kept.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.char_length("text").cast("long"))
                           .otherwise(F.col("n_chars"))).select(*COLUMNS)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates (three-word shingles, three bits)."""
    return simhash.first_of_each(docs, width=3, errors=3).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.take(docs).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces of every document of the mix."""
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("line dedup", dedup_lines), ("simhash near-dedup", dedup_near),
          ("mixing", mix), ("packing", pack)]

#: Classifier, SimHash and tokenizer have no SQL form; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
