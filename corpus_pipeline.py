"""The corpus pipeline: quality, near-duplicates, repeated passages, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before it kept. All
but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftworks.llm import packing, pii, quality, simhash, substring
from siftworks.llm.staging import stage
from siftworks.session import table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _with_text(docs: DataFrame) -> DataFrame:
    """The columns of ``documents``, n_chars counted anew."""
    return docs.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the quality classifier, learned from the labels outside its held-out fold, predicts as bad."""
    model = quality.fit(quality.features(docs.where(~quality.held_out())), table(spark, sf_dir, "labels"))
    return quality.with_score(docs, model).where("score >= 0.3").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group of near-duplicates; rows without a doc_id stay."""
    groups = simhash.similar_groups(docs)
    gone = groups.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 50 words or more that a document with a smaller doc_id has too; documents left empty by that go."""
    out = substring.remove_repeats(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return _with_text(out.where("n_removed = 0 or n_removed < n_words").withColumn("text", text))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by the name of its kind."""
    return _with_text(pii.mask_text(pii.find_spans(docs)))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, their token ids, and their places in sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=True)


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", drop_near_copies),
    ("substring", cut_repeats),
    ("pii", mask_personal_data),
    ("packing", pack_sequences),
]

#: SQL states neither the classifier nor the tokenizer; tests compare the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each staged as Parquet in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
