"""The training-data pipeline: each stage works on what the one before kept.

Stages take ``(spark, docs, sf_dir)`` and return the columns of ``documents``; the last one adds
each document's token count, domain probabilities and sampling rate. ``run`` writes every
stage's result to the shared folder and reads it back, so a lost executor never costs more than
the stage at hand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoreline.llm import decontaminate, linededup, mixing, simhash, toxicity
from shoreline.llm.common import table, unused_name
from shoreline.session import remove_folder, scratch_cleared, scratch_path

#: Shares of all tokens for documents of good and of poor quality; toxic ones have left before.
SHARES = {"good": 0.9, "poor": 0.1}
DOMAIN = "CASE WHEN quality = 0 THEN 'poor' WHEN quality = 1 THEN 'good' END"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below one half stay."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    score = unused_name(docs, "score")
    return toxicity.scored(docs, model, score).where(F.col(score) < 0.5).select(docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a document with a smaller id holds go; ``n_chars`` follows the text."""
    kept, _, dropped = linededup.without_repeats(docs)
    n_chars = F.when(F.col(dropped) > 0, F.char_length("text")).otherwise(F.col("n_chars")).cast("bigint")
    return kept.withColumn("n_chars", n_chars).select(docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by fingerprints of 4-word shingles that differ in 4 bits or fewer the one with the smallest id stays."""
    return simhash.one_of_each(docs, radius=4, shingle=4)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a whole window with a benchmark item go, or consist of items by half or more."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents get the rate at which to take them; those with rate 0 go."""
    mixed, names = mixing.mixed(docs, table(spark, sf_dir, "labels"), SHARES, F.expr(DOMAIN))
    return mixed.where(F.col(names["rate"]) > 0)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("SimHash near-dedup", keep_one_of_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("mixing to target weights", mix),
]

#: The first and the last stage fit models by iteration, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage staged, and its input, go once its result is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        with scratch_cleared(spark):
            kept = stage(spark, docs, sf_dir)
            kept.write.parquet(path)
        if before is not None:
            remove_folder(spark, before)
        docs, before = spark.read.schema(kept.schema).parquet(path), path
    return docs


RUNNERS = {"pipeline": run}
TWINS = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
