"""Operators over small tables with odd rows, against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from claimloom.llm import components, fingerprints, language, lines, mixing, packing, quality, sharding, simhash, simple8b, topk
from claimloom.llm.common import settle, word_count

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, h string, key string, shard string"
LONG = "long text of many words. " * 4000


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows and columns with clashing names."""
    settle(spark)
    texts = [None, "", " ", "One.", "One.", "two words\nof two lines", "two words\nof two lines", LONG, "ünï çode ß", "x\n\n\nx"]
    rows = [(i, t, "en" if i % 2 else None, "a" if i % 3 else None, 1, "h", "k", "s") for i, t in enumerate(texts)]
    rows += [rows[3], (None, "no id", "de", "b", None, None, None, None), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return settle(spark).createDataFrame([], SCHEMA)


def test_packing(odd, none):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = packing.pack(odd, path, 2).collect()
    assert sum(r.length for r in rows) == sum(r.doc_tokens for r in rows if r.start == 0)
    assert sum(1 for r in rows if r.start == 0) == 13 and all(r.padding == 0 or r.sequence_tokens < 4096 for r in rows)
    assert packing.pack(none, path, 2).count() == 0


def test_prompts_bear_no_loss(spark):
    df = settle(spark).createDataFrame([(1, "a b c", "q r"), (2, "d", None)], "doc_id bigint, text string, prompt string")
    rows = packing.pack(df, public_tokenizers.path("word_bpe_49k.json"), 2, packing.Limits(8, 2, 4), prompt="prompt").collect()
    assert sum(r.loss_tokens for r in rows) == 4 + 2 and sum(r.length for r in rows) == 6 + 2


def test_token_files(spark, odd, none, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    simple8b.write_token_files(odd, str(tmp_path / "a"), path, 0)
    rows = sorted(simple8b.read_token_files(spark, str(tmp_path / "a")).collect(), key=lambda r: r.start)
    ids = [r.doc_id for r in rows]
    assert ids == [None, None, 0, 1, 2, 3, 3, 4, 5, 6, 7, 8, 9]
    at = 0
    texts = {r.doc_id: r.text or "" for r in odd.collect() if r.doc_id is not None}
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(path)
    for r in rows:
        assert r.start == at
        at += r.n_tokens
        if r.doc_id is not None:
            assert np.frombuffer(r.ids, "<u4").tolist() == [*library.encode(texts[r.doc_id], add_special_tokens=False).ids, 0]
    some = {(r.doc_id, r.start): r.ids for r in simple8b.read_token_files(spark, str(tmp_path / "a"), [3, 7, 99]).collect()}
    assert some == {(r.doc_id, r.start): r.ids for r in rows if r.doc_id in (3, 7)} and len(some) == 3
    simple8b.write_token_files(none, str(tmp_path / "b"), path, 0)
    assert simple8b.read_token_files(spark, str(tmp_path / "b")).count() == 0


def test_mixing(odd, none):
    mixed = mixing.mix(odd, word_count("text"))
    rows = mixed.collect()
    per = {r.source: [0, r.target, r.source_size] for r in rows}
    for r in rows:
        per[r.source][0] += r.taken
        assert 0 <= r.taken <= 3 * r["size"]
    for taken, target, size in per.values():
        assert taken == int(target + 0.5) and target <= 3 * size
    texts = mixing.mixed_texts(mixed, ["doc_id", "text", "n_chars"]).select(word_count("text").alias("n")).collect()
    assert sum(r.n for r in texts) == sum(r.taken for r in rows)
    assert mixing.mix(none, word_count("text")).count() == 0


def test_top_k(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice([0.5, rng.uniform(-1, 1)]) for _ in range(6)]) for i in range(230)]
    rows += [(5, rows[5][1]), (None, [1.0] * 6), (300, None), (301, [None] + [1.0] * 5), (302, [float("nan")] * 6), (400, rows[0][1]), (500, [])]
    df = settle(spark).createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.top_k(df, F.pmod("vec_id", F.lit(100)) == 0).collect()}
    good = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and x == x for x in v)]
    for q, v in good:
        if q % 100 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in good if i != q)[:10]
            assert [got[q, n + 1] for n in range(10)] == [(i, -s) for s, i in best]
    assert topk.top_k(df.limit(0), F.lit(True)).count() == 0


def test_components(spark):
    rng = random.Random(2)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(7, 7), (None, 3)] + [(1000, i) for i in range(1001, 1100)]
    found = {r.node: r.root for r in components.components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        if a is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    assert found == {x: find(x) for x in list(root)}


def test_simhash_links_equal_brute_force(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(20)]
    prints = {0} | {b ^ sum(1 << k for k in rng.sample(range(64), rng.randrange(7))) for b in base for _ in range(12)}
    df = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in sorted(prints)], "fp bigint")
    found = {r.node % (1 << 64): r.root % (1 << 64) for r in components.components(simhash.links(df)).collect()}
    seen = {p: p for p in prints}

    def find(x):
        while seen[x] != x:
            x = seen[x]
        return x

    for a in prints:
        for b in prints:
            if a < b and (a ^ b).bit_count() <= 4:
                seen[find(a)] = find(b)
    groups = lambda label: {frozenset(p for p in prints if label(p) == r) for r in set(map(label, prints))}
    assert groups(find) == groups(lambda p: found.get(p, p))


def test_near_duplicates(odd, none):
    rows = simhash.near_duplicates(odd).collect()
    of = {r.doc_id: r.component_id for r in rows if r.doc_id is not None}
    assert len(rows) == 13 and of[3] == of[4] == 3 and of[5] == of[6] == 5 and of[0] == of[1] == of[2] == 0
    assert simhash.near_duplicates(none).count() == 0


def test_language(odd, none):
    model = language.learn(odd)
    rows = language.identify(odd, model).collect()
    assert len(rows) == 13 and {r.lang_pred for r in rows if r.doc_id in (0, 1, 2)} == {"und"}
    assert all(0 <= r.score <= 1 for r in rows)
    assert language.identify(odd, {}).where("lang_pred != 'und'").count() == 0
    assert language.identify(none, model).count() == 0 and language.learn(none) == {}


def test_quality(odd, none, spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(3, 9)] + [(None, 1, 0), (5, None, 0)], "doc_id bigint, quality int, toxic int")
    rows = quality.score(odd, quality.learn(odd, labels)).collect()
    assert len(rows) == 13 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert quality.learn(none, labels) is None and quality.score(none, None).count() == 0


def test_sharding(spark, odd, none):
    rows = [(i, f"text {i} " * (i % 7 + 1) if i >= 60 else "copy of one text") for i in range(400)]
    for df, n, shards in ((spark.createDataFrame(rows, "doc_id bigint, text string"), 400, 5), (odd, 13, 3)):
        out = sharding.shard_documents(df, shards).collect()
        assert len(out) == n
        for s in range(shards):
            slots = sorted(r.slot for r in out if r.shard == s)
            assert slots == list(range(len(slots)))
        if n == 400:
            loads = [sum(r["size"] for r in out if r.shard == s) for s in range(shards)]
            assert max(loads) - min(loads) < 0.02 * sum(loads) / shards
            assert len({r.shard for r in out if r.doc_id < 60}) == 1
    assert sharding.shard_documents(none, 4).count() == 0


def test_fingerprints(odd, none, spark):
    rows = fingerprints.fingerprint_documents(odd).collect()
    ids = [r.doc_id for r in rows]
    assert len(rows) == 13 and ids.count(3) == 2
    of = {r.doc_id: r for r in rows}
    assert of[3].fingerprint == of[4].fingerprint and of[5].near_edited <= 1 and of[0].n_chars == 0
    edited = LONG[: len(LONG) - len(LONG) // 2] + "two words\nof two lines"[: len(LONG) // 2]
    assert of[7].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    assert fingerprints.fingerprint_documents(none).count() == 0


def test_collision_rate_is_generalised_jaccard(spark):
    rng = random.Random(5)
    bags = [Counter({f"w{rng.randrange(40)}": rng.randrange(1, 9) for _ in range(30)}) for _ in range(2)]
    words = [(w, bags[0][w], bags[1][w]) for w in bags[0] | bags[1]]
    df = spark.createDataFrame([(1, w, a, b) for w, a, b in words], "g int, w string, a bigint, b bigint").withColumn("word", F.xxhash64("w"))
    prints = fingerprints.signatures(df, ["g"], {"x": "a", "y": "b"}, samples=400)
    rate = prints.select(fingerprints.likeness(F.col("x"), F.col("y"), 400).alias("r")).first().r
    want = sum((bags[0] & bags[1]).values()) / sum((bags[0] | bags[1]).values())
    assert abs(rate - want) < 0.09


def test_lines(odd, none, spark):
    base = "this line of a document has a good many words so that one other letter hardly matters to it at all"
    rows = [(1, f"{base}\nalone"), (2, f"{base[:-1]}k\nanother quite different line"), (3, f"alone\n{base}"), (4, None), (5, "\n\n")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = {r.doc_id: r.text for r in lines.dedup_lines(docs).collect()}
    assert out == {1: f"{base}\nalone", 2: "another quite different line", 3: "", 4: None, 5: "\n\n"}
    classes = lines.classify_lines(odd).collect()
    assert all(r.kept for r in classes if r.first_doc_id is None and r.doc_id in (0, 1, 2))
    assert not any(r.kept for r in classes if r.doc_id in (4, 6))
    assert lines.classify_lines(none).count() == 0 and lines.dedup_lines(none).columns == none.columns
