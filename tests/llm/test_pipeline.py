"""Stages of the pipeline on rows that share ids."""

from __future__ import annotations

import corpus_pipeline


def test_texts_that_share_an_id_are_judged_apart(spark):
    copied = "a line of many words that a later document has again word by word"
    alone, other = "nothing here is like the text before it at all", "a third text that has its own things to say"
    texts = [(1, copied), (2, copied), (2, alone), (3, other), (3, other), (3, copied), (None, copied), (4, alone), (5, None)]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in texts], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    rows = corpus_pipeline.simhash_stage(spark, docs, "").collect()
    got = sorted(((r.doc_id, r.text) for r in rows), key=str)
    assert got == sorted([(1, copied), (2, alone), (3, other), (None, copied), (5, None)], key=str)
