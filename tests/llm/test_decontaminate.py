"""Decontamination against a plain search for windows."""

from __future__ import annotations

import random
import re

import pytest

from claimloom.llm import decontaminate
from claimloom.llm.common import settle

SCHEMA = "doc_id bigint, text string, found string, had string, text_bytes string, n_words int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain(text, items, window=10):
    said, hit, named, longest = words(text), set(), set(), 0
    for name, body in items:
        item = words(body)
        k = min(window, len(item))
        grams = {tuple(item[i : i + k]) for i in range(len(item) - k + 1)} if item else set()
        for i in range(len(said) - k + 1):
            if tuple(said[i : i + k]) in grams:
                hit.update(range(i, i + k))
                named.add("" if name is None else str(name))
    return len(said), sorted(hit), sorted(named)


def compare(spark, docs, items, window=10):
    settle(spark)
    table = spark.createDataFrame([(i, t, "a", "b", "c", 1) for i, t in docs], SCHEMA).repartition(3)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    rows = decontaminate.find(table, bench, ["doc_id", "text", "n_words"], window=window, found="share").collect()
    got = sorted(((r.doc_id, r.text, r.share.n_words, [i for s in r.share.spans for i in range(s.begin, s.end)], r.share["items"]) for r in rows), key=str)
    want = sorted(((i, t, *plain(t, items, window)) for i, t in docs), key=str)
    assert got == want
    return rows


def tables(seed, few):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(few)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 9, 10, 11, 40])))) for i in range(12 if few > 2 else 3)]
    items = [(i, t) for i, t in items if few > 8 or len(t.split()) > 2]
    docs = []
    for i in range(60):
        parts = [rng.choice([*vocabulary, "other", "Ünï"]) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            body = rng.choice(items)[1].upper().split() if items else []
            at, begin = rng.randint(0, len(parts)), rng.randint(0, 3)
            parts[at:at] = body[begin : len(body) - rng.randint(0, 3)]
        docs.append((i, rng.choice([" ", ", ", "\n", "_"]).join(parts)))
    return docs, items


@pytest.mark.parametrize(("seed", "few"), [(1, 40), (2, 3), (3, 2), (4, 12)])
def test_equals_plain_search(spark, seed, few):
    compare(spark, *tables(seed, few))


def test_items_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 25)  # items of 40 words are cut
    compare(spark, *tables(5, 20))


def test_odd_rows(spark):
    passage = "One two three four, five six seven eight nine ten eleven"
    docs = [(1, None), (2, ""), (3, " .,; "), (None, passage), (4, passage), (4, passage), (5, f"x {passage.upper()}! y"), (6, passage[:-8]),
            (7, "long words " * 200_000 + passage), (8, "one two three four five six seven eight nine"), (9, "tiny bit")]
    items = [(1, passage), (2, passage), (2, "tiny  BIT"), (None, "eight nine"), (3, None), (4, ""), (5, "...")]
    compare(spark, docs, items)
    compare(spark, docs, [])
    compare(spark, [], items)


def test_chunks_of_texts_keep_words_whole(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BYTES_AT_ONCE", 7)
    compare(spark, *tables(6, 15))


def test_clean(spark):
    settle(spark)
    passage = " ".join(f"p{i}" for i in range(12))
    docs = [(1, f"Before, ({passage}) after it many more words than the passage has, one two three four five six."), (2, f"{passage} end"), (3, None), (4, "p1 p2 Ü!"), (5, "")]
    table = spark.createDataFrame([(i, t, "a", "b", "c", 1) for i, t in docs], SCHEMA).drop("found")
    found = decontaminate.find(table, spark.createDataFrame([(1, passage.upper()), (2, "p1 p2")], "item_id bigint, text string"), ["doc_id", "text", "had"])
    rows = sorted((r.doc_id, r.text, r.had) for r in decontaminate.clean(found).collect())
    assert rows == [(1, "Before, () after it many more words than the passage has, one two three four five six.", "b"), (3, None, "b"), (4, "p1 p2 Ü!", "b"), (5, "", "b")]
    assert {r.doc_id: r.found.longest for r in found.collect()} == {1: 12, 2: 12, 3: 0, 4: 2, 5: 0}
