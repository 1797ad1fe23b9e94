"""Five stages from documents to packed sequences, each written as Parquet and read again by the next.

Toxic documents go, later repeats of lines go, one document of each near-duplicate class stays, sources are
mixed to target weights, and what is left is packed into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedweave.llm import jaccard, lines, mixing, packing, toxicity
from feedweave.session import fresh_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5, as what nothing is known of is; learnt from the labelled ones among ``docs``.

    Null and empty texts stay.
    """
    model = toxicity.train_on(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    toxic = (F.col("score") >= 0.5) & (F.coalesce(F.char_length("text"), F.lit(0)) > 0)
    return toxicity.score_rows(docs, model).filter(~toxic).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats of lines are cut; a document of which only white space is left then goes."""
    cut = lines.dedup_lines(docs)
    kept = cut.filter((F.col("lines_removed") == 0) | F.col("text").rlike(r"[^ \t-\r]"))
    return kept.withColumn("n_chars", F.when(F.col("lines_removed") == 0, F.col("n_chars"))
                           .otherwise(F.char_length("text")).cast("long")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each class of Jaccard 0.8 or more on five-word shingles."""
    return jaccard.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources weigh as the roots of their sizes; a document can come several times or not at all."""
    return mixing.mix_sources(docs, exponent=0.5, seed=7).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens with their place in a sequence."""
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("line_dedup", dedup_lines), ("near_duplicates", drop_near_duplicates),
          ("mixing", mix_sources), ("packing", pack)]

#: Toxicity is a trained model, near duplicates an iteration: no SQL equivalent.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
