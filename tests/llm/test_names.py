"""Operators over tables whose other columns have the names that operators use inside."""

from __future__ import annotations

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from claimloom.llm import fingerprints, language, lines, mixing, packing, quality, sharding, simhash, simple8b, topk
from claimloom.llm.common import settle, word_count

NAMES = [
    "_key", "_group", "_range", "_before", "_budget", "_source", "_copy", "_offset", "_inside", "_all", "_id", "_hash", "_drop", "_own", "_text",
    "h", "id", "key", "range", "place", "fp", "root", "size", "k", "t", "p", "v", "q", "c0", "copy", "drop", "body", "label", "shard", "score",
]


@pytest.fixture(scope="module")
def clashing(spark):
    rows = [(i, f"text {i % 7} of some words\nand a line", "en" if i % 2 else "de", "ab"[i % 2], 1) for i in range(30)]
    df = settle(spark).createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return df.select("*", *[F.lit("x").alias(name) for name in NAMES])


@pytest.mark.parametrize("name", ["op1", "op3", "op4", "op5", "op6", "op7", "op8", "op9", "op10", "texts"])
def test_names_do_not_clash(spark, clashing, name, tmp_path):
    bare = clashing.select("doc_id", "text", "lang", "source", "n_chars")
    marks = spark.createDataFrame([(i, i % 2, 0) for i in range(30)], "doc_id bigint, quality int, toxic int")

    def files(df):
        folder = str(tmp_path / f"files{len(df.columns)}")
        simple8b.write_token_files(df, folder, public_tokenizers.path("byte_bpe_50k.json"), 0)
        return simple8b.read_token_files(spark, folder)

    runs = {
        "op1": lambda df: packing.pack(df, public_tokenizers.path("word_bpe_49k.json"), 2).select("doc_id", "length"),
        "op3": fingerprints.fingerprint_documents,
        "op4": lambda df: mixing.mix(df, word_count("text")).select("doc_id", "taken"),
        "op5": lines.classify_lines,
        "op6": lambda df: sharding.shard_documents(df, 4).select("doc_id", "slot"),
        "op7": lambda df: quality.score(df, quality.learn(df, marks)).select("doc_id", "predicted"),
        "op8": lambda df: files(df).select("doc_id", "start"),
        "op9": lambda df: language.identify(df, language.learn(df)),
        "op10": simhash.near_duplicates,
        "texts": lambda df: mixing.mixed_texts(mixing.mix(df, word_count("text")), ["doc_id", "text", "n_chars"]),
    }
    run = runs[name]
    assert sorted(run(clashing).collect(), key=str) == sorted(run(bare).collect(), key=str)


def test_kept_columns_come_back(clashing):
    mixed = mixing.mix(clashing, word_count("text"))
    kept = [c for c in clashing.columns if c != "size"]
    assert set(kept) <= set(mixed.columns) and mixed.where("_key <> 'x' or c0 <> 'x' or _before <> 'x'").count() == 0
    assert set(lines.dedup_lines(clashing).columns) == set(clashing.columns)


def test_vectors_with_other_columns(spark):
    df = settle(spark).createDataFrame([(i, [float(i % 5), 1.0]) for i in range(20)], "vec_id bigint, embedding array<float>")
    wide = df.select("*", *[F.lit("x").alias(n) for n in ("id", "v", "q", "c", "b", "score", "rank", "query_id")])
    assert sorted(topk.top_k(wide, F.col("vec_id") % 5 == 0).collect()) == sorted(topk.top_k(df, F.col("vec_id") % 5 == 0).collect())
