"""Training-corpus pipeline: five stages of the training-data operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet under ``spark.checkpoint.dir`` and read again as the next one's ``docs``.
All but the last return the columns of ``documents``, with ``n_chars`` following the
text.  Null or empty texts pass every filter, rows that repeat are duplicates of each
other, extra columns are carried along, and an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm import bpe, decontaminate, minhash, queries, suffix, toxicity
from shoplens.llm.common import ensure_checkpoint_dir, read, stage

TOXIC = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below ``TOXIC``, by a model of the labelled documents given."""
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).filter(F.col("toxicity") < TOXIC).select(*docs.columns)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest id; one row
    of rows that repeat an id with the same text.  Rows without an id stay."""
    groups = minhash.near_duplicates(docs).filter("kept").select("doc_id").distinct()
    kept = docs.join(groups, "doc_id", "left_semi").select(*docs.columns)
    twice = stage(docs.groupBy("doc_id").count().filter("count > 1 and doc_id is not null").select("doc_id"), "pipeline-repeated-ids")
    if not twice.isEmpty():          # whole rows are only compared where an id occurs more than once
        kept = kept.join(twice, "doc_id", "left_anti").select(*docs.columns).unionByName(
            kept.join(twice, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id", "text"]))
    return kept.unionByName(docs.filter("doc_id is null"))


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of 200-byte strings that also start elsewhere; a null text stays null."""
    done = suffix.remove_repeats(docs.withColumn("__null", F.col("text").isNull()))
    text = F.when(F.col("__null"), F.lit(None)).otherwise(F.col("text"))
    done = done.withColumn("text", text).withColumn(
        "n_chars", F.when(F.col("repeat_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return done.select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of each text's token ids and of the text decoded from them."""
    done = bpe.tokenize(docs.select("doc_id", "text"), queries.tokenizer_path(), digest_only=True)
    return done.select("doc_id", F.col("bpe_n").alias("n_tokens"), F.col("bpe_ids_sha256").alias("ids_sha256"),
                       F.col("bpe_text_sha256").alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", keep_one_of_near_duplicates),
    ("suffix_dedup", remove_repeated_passages),
    ("decontaminate", drop_contaminated),
    ("bpe", encode),
]

ORACLE_SQL = None      # neither a learnt score nor the tokenizer can be said in SQL; tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
