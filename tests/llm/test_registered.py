"""Registered queries and the pipeline over a whole small table, against plain Python."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from claimloom.llm import queries
from claimloom.llm.common import settle
from tests.llm.test_lines import all_pairs

FOLDER = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").collect()


def rows(spark, name):
    return queries.QUERIES[name](spark, FOLDER).collect()


def reached(n, linked):
    """The least index that each one reaches over the linked pairs."""
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return [find(i) for i in range(n)]


def encoded(path, end):
    library = Tokenizer.from_file(public_tokenizers.path(path))
    return lambda text: [*library.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def covered(pieces):
    """Sequences are gapless, within their size, and padded as little as can be."""
    of = defaultdict(list)
    for r in pieces:
        of[r.sequence_id].append(r)
    padding = 0
    for parts in of.values():
        parts.sort(key=lambda r: r.offset)
        assert [r.offset for r in parts] == list(np.cumsum([0, *[r.length for r in parts]])[:-1])
        total = sum(r.length for r in parts)
        assert 0 < total <= 4096
        padding += 0 if total & (total - 1) == 0 else 4096 - total
    return padding


def test_op1(spark, docs):
    ids = {d.doc_id: encoded("word_bpe_49k.json", 2)(d.text) for d in docs}
    got = rows(spark, "op1_packing")
    pieces = defaultdict(list)
    for r in got:
        assert r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == crc(ids[r.doc_id][r.start : r.start + r.length])
        pieces[r.doc_id].append((r.start, r.length))
    for doc, parts in pieces.items():
        parts.sort()
        assert [s for s, _ in parts] == list(np.cumsum([0, *[n for _, n in parts]])[:-1]) and sum(n for _, n in parts) == len(ids[doc])
    assert set(pieces) == set(ids) and covered(got) <= 0.02 * sum(map(len, ids.values()))


def test_op3(spark, docs):
    got = {r.doc_id: r for r in rows(spark, "op3_fingerprints")}
    order = sorted(docs, key=lambda d: -d.doc_id)
    counts = [Counter(w for w in re.split(r"[\x20\x09-\x0D]+", (d.text or "").lower()) if w) for d in order]
    errors, prints = [], {}
    for i, d in enumerate(order):
        text, following = d.text or "", order[(i + 1) % len(order)].text or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        r = got[d.doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
        other = Counter(w for w in re.split(r"[\x20\x09-\x0D]+", edited.lower()) if w)
        after = counts[(i + 1) % len(order)]
        for bag, said in ((other, r.near_edited), (after, r.near_next)):
            union = sum((counts[i] | bag).values())
            errors.append(said - (sum((counts[i] & bag).values()) / union if union else 1.0))
    # 32 samples: a standard error of at most 0.088 for one, and of far less for the mean
    assert len(got) == len(docs) and math.sqrt(np.mean(np.square(errors))) < 0.088 and abs(np.mean(errors)) < 0.03


def test_op5(spark, docs):
    places = [(d.doc_id, n, body) for d in sorted(docs, key=lambda d: d.doc_id) for n, body in enumerate((d.text or "").split("\n"))]
    bodies = list(dict.fromkeys(body for _, _, body in places if WORDS.search(body)))
    root = dict(zip(bodies, all_pairs(bodies), strict=True))
    first, want = {}, []
    for doc, n, body in places:
        if body not in root:
            want.append((doc, n, None, None, True))
            continue
        place = first.setdefault(root[body], (doc, n))
        want.append((doc, n, *place, place == (doc, n)))
    got = [(r.doc_id, r.line_no, r.first_doc_id, r.first_line_no, r.kept) for r in rows(spark, "op5_line_dedup")]
    assert sorted(got, key=lambda r: r[:2]) == want


def test_op6(spark, docs):
    got = {r.doc_id: r for r in rows(spark, "op6_sharding")}
    sizes, slots, shards = Counter(), defaultdict(list), defaultdict(set)
    for d in docs:
        r, data = got[d.doc_id], (d.text or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(data) + 16, zlib.crc32(data), "bytes", None)
        sizes[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        shards[data].add(r.shard)
    assert len(got) == len(docs) and set(sizes) == set(range(40))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(len((d.text or "").encode()) for d in docs) + 16
    assert max(sizes.values()) - min(sizes.values()) <= largest


def held(doc_id, modulus, remainder):
    return zlib.crc32(str(doc_id).encode()) % modulus == remainder


def test_op7(spark, docs):
    got = {r.doc_id: r for r in rows(spark, "op7_quality")}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect() if r.quality is not None}
    assert set(got) == {d.doc_id for d in docs}
    for r in got.values():
        assert r.held_out == held(r.doc_id, 5, 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    judged = [(got[i].predicted, q) for i, q in labels.items() if got[i].held_out]
    assert judged and sum(p == q for p, q in judged) >= 0.9 * len(judged)


def test_op8(spark, docs):
    got = {r.doc_id: r for r in rows(spark, "op8_token_files")}
    at = 0
    for d in sorted(docs, key=lambda d: d.doc_id):
        ids = encoded("byte_bpe_50k.json", 0)(d.text)
        r = got.pop(d.doc_id)
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), crc(ids))
        at += len(ids)
    assert not got


def test_op9(spark, docs):
    got = {r.doc_id: r for r in rows(spark, "op9_language_id")}
    known = {d.lang for d in docs if d.lang is not None}
    right = []
    for d in docs:
        r = got[d.doc_id]
        assert r.held_out == held(d.doc_id, 4, 2) and 0 <= r.score <= 1
        letters = any(c.isalpha() for c in d.text or "")
        assert (r.lang_pred in known) if letters else r.lang_pred == "und"
        if r.held_out and d.lang is not None and letters:
            right.append(r.lang_pred == d.lang)
    assert len(got) == len(docs) and sum(right) >= 0.95 * len(right)


def simhash(text):
    words = WORDS.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near(prints, radius=4):
    values = np.array(prints, dtype=np.uint64)
    return [(i, int(j)) for i in range(len(values)) for j in np.flatnonzero(np.bitwise_count(values[:i] ^ values[i]) <= radius)]


def test_op10(spark, docs):
    order = sorted(docs, key=lambda d: d.doc_id)
    prints = [simhash(d.text) for d in order]
    root = reached(len(order), near(prints))
    want = [(d.doc_id, f"{p:016x}", order[r].doc_id) for d, p, r in zip(order, prints, root, strict=True)]
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in rows(spark, "op10_simhash")) == want


def plain_corpus(docs):
    """Texts and sources that the stages before packing leave, by document, and how often each comes."""
    kept = [[d.doc_id, d.text, d.source] for d in sorted(docs, key=lambda d: d.doc_id) if any(c.isalpha() for c in d.text or "")]
    # lines: the first of every class of alike ones
    bodies = list(dict.fromkeys(b for _, text, _ in kept for b in text.split("\n") if WORDS.search(b)))
    root, seen = dict(zip(bodies, all_pairs(bodies), strict=True)), set()
    for row in kept:
        left = []
        for body in row[1].split("\n"):
            if body in root:
                if root[body] in seen:
                    continue
                seen.add(root[body])
            left.append(body)
        row[1] = "\n".join(left)
    # near duplicates: the least id of every component
    group = reached(len(kept), near([simhash(text) for _, text, _ in kept]))
    kept = [row for i, row in enumerate(kept) if group[i] == i]
    # the mix: weights 5, 2, 1 by source in code point order, at most three times a source
    sizes = [len(WORDS.findall(text)) for _, text, _ in kept]
    total = Counter()
    for (_, _, source), n in zip(kept, sizes, strict=True):
        total[source] += n
    names = sorted(total)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, open_ = {}, set(names)
    while open_:
        rest = sum(total.values()) - sum(target.values())
        share = {s: rest * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = {s for s in open_ if share[s] >= 3 * total[s]}
        if not over:
            target.update(share)
            break
        target.update({s: 3.0 * total[s] for s in over})
        open_ -= over
    out = defaultdict(list)
    for s in names:
        budget = math.floor(target[s] + 0.5)
        epochs, left = divmod(budget, total[s]) if total[s] else (0, 0)
        own = [(row, n) for row, n in zip(kept, sizes, strict=True) if row[2] == s]
        for (doc, text, _), n in sorted(own, key=lambda p: (hashlib.md5(f"{p[0][0]}:42".encode()).hexdigest(), p[0][0])):
            part = min(n, left)
            left -= part
            whole = epochs + (part == n and n > 0)
            out[doc] += [text] * whole
            if 0 < part < n:
                out[doc].append("".join(re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+", text)[:part]))
    return out


def test_pipeline_equals_plain_stages(spark, docs):
    want = {doc: Counter(tuple(encoded("word_bpe_49k.json", 2)(t)) for t in texts) for doc, texts in plain_corpus(docs).items() if texts}
    pieces = corpus_pipeline.run(spark, FOLDER).collect()
    covered(pieces)
    got = defaultdict(Counter)
    for r in pieces:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        fitting = [t for t in want[r.doc_id] if len(t) == r.doc_tokens and list(t[r.start : r.start + r.length]) == ids]
        assert fitting, r.doc_id
        for place in range(r.start, r.start + r.length):
            got[r.doc_id][r.doc_tokens, place] += 1
    for doc, texts in want.items():
        lengths = Counter()
        for ids, copies in texts.items():
            lengths[len(ids)] += copies
        assert got[doc] == Counter({(n, place): copies for n, copies in lengths.items() for place in range(n)})
    assert set(got) == set(want)


EMPTY = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def test_stages_on_empty_and_odd_tables(spark):
    """Empty tables stay empty; nulls, ties, repeats and clashing names go through every stage."""
    settle(spark)
    clash = ["_key", "h", "fp", "root", "drop", "size", "taken", "lang_pred", "text_hash", "line_no"]
    odd = [(i, t, "en" if i % 2 else None, "s" if i % 3 else None, None) for i, t in enumerate([None, "", "...", "One line.", "One line.", "two\nlines of text", "a " * 9000])]
    odd += [odd[3], (None, "no id at all", None, None, None)]
    for data in ([], odd):
        frame = spark.createDataFrame([(*r, *["x"] * len(clash)) for r in data], EMPTY + "".join(f", {c} string" for c in clash))
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, FOLDER)
            frame = spark.createDataFrame(out.collect(), out.schema)
        assert (frame.count() > 0) == bool(data)
