"""A training corpus from ``documents``: language, line and near-duplicate filters, mixing, packing.

Each stage takes what the one before it wrote and returns all it keeps; all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from uuid import uuid4

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm import language, lines, mixing, packing, simhash
from claimloom.llm.common import doc_bucket, settle, table, word_count
from claimloom.session import cut_lineage, shared_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language is found, with that language; texts without a letter go."""
    settle(spark)
    model = language.learn(docs.where(doc_bucket("doc_id", 4) != 2))
    found = language.identify(docs.select(*COLUMNS), model, keep=COLUMNS)
    return found.where(F.col("lang_pred") != language.UNKNOWN).withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the first line of every class of similar lines only."""
    settle(spark)
    return lines.dedup_lines(docs.select(*COLUMNS))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of every group of near-duplicates; documents without an id stay.

    Texts that share an id are documents of their own, each judged by its own group.
    """
    settle(spark)
    hashed = docs.select(*COLUMNS, F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    first = cut_lineage(simhash.firsts(hashed, "text_hash", shingle=4, radius=4))
    named = hashed.join(first, ["doc_id", "text_hash"], "left_semi").dropDuplicates(["doc_id", "text_hash"])
    return named.unionByName(hashed.where("doc_id is null")).select(*COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources by words takes them, the last of a source in part."""
    settle(spark)
    return mixing.mixed_texts(mixing.mix(docs.select(*COLUMNS), word_count("text")), COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 ids."""
    settle(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), 2)


STAGES = [
    ("language ID", language_stage),
    ("line dedup", line_stage),
    ("SimHash near-dedup", simhash_stage),
    ("mixing sources", mixing_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/corpus-{uuid4().hex[:12]}"
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return docs


# The stages learn, hash and pack in ways that SQL cannot say.
ORACLE_SQL = None
