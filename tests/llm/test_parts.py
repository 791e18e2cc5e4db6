"""The parts that need no session: encoding, coding, packing, parsing, fingerprints, the field."""

from __future__ import annotations

import random
import re

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from claimloom.llm import language, packing, quality, simhash, simple8b, tokens
from claimloom.llm.tokens import encoder

DOCS = "/root/testdata/sf0.001/documents.parquet"
ODD = st.text(alphabet=" \n\tabÉéİßñ'st.,!3́\xa0\x1c Σσ<|>", max_size=30)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_cached_ids_equal_the_library(name):
    e = encoder(public_tokenizers.path(name))
    texts = [r[0] for r in duckdb.sql(f"SELECT text FROM '{DOCS}'").fetchall()]
    for text in [*texts, "", " ", "\n a", "<|endoftext|> a<|endoftext|>b", "don't I'S\n\n y"]:
        assert np.frombuffer(e.encode(text), "<u4").tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids

    @settings(max_examples=300, deadline=None)
    @given(st.one_of(st.text(max_size=30), ODD))
    def same(text):
        assert np.frombuffer(e.encode(text), "<u4").tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids

    same()


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_words_that_come_once_leave_the_frequent_ones_in_memory(name, monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_BYTES", 1 << 15)
    e = tokens.Encoder(public_tokenizers.path(name))
    merged, merge = [], e.merge
    e.merge = lambda word: merged.append(word) or merge(word)
    letters = [chr(97 + i) for i in range(26)]
    rare = [a + b + c + "q" for a in letters for b in letters for c in letters][:4000]
    for i in range(0, len(rare), 4):
        text = " ".join(["frequent", *rare[i : i + 4], "word", "frequent", "word"])
        assert np.frombuffer(e.encode(text), "<u4").tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids
    assert sum("requent" in m or "word" in m for m in merged) <= 8


def test_memory_holds_the_words_of_many_texts():
    """A quarter of a million words that come again are all kept, so that none is merged a third time."""
    e = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"), simple8b.KEPT_BYTES)
    letters = [chr(97 + i) for i in range(26)]
    words = [a + b + c + d for a in letters for b in letters for c in letters for d in letters[:15]]
    texts = [" ".join(["", *words[i : i + 500]]) for i in range(0, len(words), 500)]
    first, _, _, _ = ([e.encode(text) for text in texts] for _ in range(4))
    merged, merge = [], e.merge
    e.merge = lambda word: merged.append(word) or merge(word)
    assert [e.encode(text) for text in texts] == first
    assert not merged


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_many_texts_at_once_equal_the_library(name):
    e = encoder(public_tokenizers.path(name))
    odd = ["", " ", "a", " a", "a ", "\n", "\na", "a\n", "a\n\nb", "a\n b", "a  b", "a\u00a0\u00a0b", "a \u3000b", "x\x85\x85y", "x\x1c\x1dy", "x\x0b\x0by", "a\tb", "a\t b"]
    odd += ["it's, ok!! ...\nok?!", "Ünï, ünï\nİi, ɐ. Ωσς.", "<|endoftext|> x", "a <|endoftext|>.", "日本 語,", "\u200b \u200b", "a\r\nb", "\x00 \x00a", "e\u0301 é! ª, µ. ×,"]
    for texts in (odd, odd[::-1], odd[10:11], []):
        want = [e.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert [np.frombuffer(ids, "<u4").tolist() for ids in e.encode_all(pa.array(texts, pa.string()))] == want


def test_a_word_of_many_texts_is_merged_once(spark, tmp_path, monkeypatch):
    """The writer merges a word once, whatever punctuation follows it in which of its texts."""
    rng, merged = random.Random(4), []
    words = ["".join(rng.choice("aeioubcdfg") for _ in range(9)) for _ in range(300)]
    texts = ["x " + " ".join(word + rng.choice(["", ",", ".", "!?", "###"]) for word in words) for _ in range(5)]
    e = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    merge = e.merge
    e.merge = lambda word: merged.append(word) or merge(word)
    monkeypatch.setattr(simple8b, "encoder", lambda *_: e)
    monkeypatch.setattr(simple8b.TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda self: 0})())

    class Rows:
        """Hands the writer's function one batch instead of Spark's, to count what it merges."""
        sparkSession = spark
        select = repartitionByRange = sortWithinPartitions = lambda self, *_: self

        def _map(self, run, batch):
            self.found = list(run(iter([batch])))
            self.write = type("Write", (), {"parquet": lambda *_: None})
            return self

        def mapInArrow(self, run, _schema):
            return self._map(run, pa.RecordBatch.from_pydict({"k": list(range(5)), "t": texts}))

        def mapInPandas(self, run, _schema):
            return self._map(run, pa.RecordBatch.from_pydict({"k": list(range(5)), "t": texts}).to_pandas())

    rows = Rows()
    simple8b.write_token_files(rows, str(tmp_path), "", 0)
    assert len(merged) <= len(words) + 10 and len(rows.found) == 1


def test_memory_starts_anew_when_the_text_has_changed(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_BYTES", 1 << 12)
    monkeypatch.setattr(tokens, "PATIENCE", 50)
    e = tokens.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    old, new = ([f"{c}{a}{b}" for a in "bcdfg" for b in "aeiou"] for c in "xz")
    for words in (old, new):
        for _ in range(20):
            e.encode(" ".join(words))
    assert set(new) & set(e.words) and not set(old) & set(e.words)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_capitals_beside_other_scripts_equal_the_library(name):
    e = encoder(public_tokenizers.path(name))
    for text in ["Été ÇA Où, Ñandú!", "İstanbul IĞDIR", "Ɏ ɐ Ɑ ẞ Straße", "Ünder <|endoftext|> Über", "Ab ΣΑΣ ΟΔΟΣ", "é Ét Àb̀"]:
        for _ in range(3):
            assert np.frombuffer(e.encode(text), "<u4").tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids


def test_packer_knows_what_all_waiting_examples_ask_for():
    rng = random.Random(5)
    packer = packing.Packer(packing.Limits(64, 3, 40), waiting=6)
    for n in range(200):
        total = rng.randint(1, 90)
        for _ in packer.add(packing._Example(n, bytes(4 * total), total, rng.randint(0, total))):
            assert packer.asked.tolist() == packer.demand.sum(axis=0).tolist()
        assert packer.asked.tolist() == packer.demand.sum(axis=0).tolist()
    list(packer.finish())
    assert packer.asked.tolist() == [0, 0, 0]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 70_000), st.integers(0, (1 << 64) - 1)), max_size=3000))
def test_simple8b_round_trip(ids):
    words, blocks, escapes = simple8b.encode_ids(np.array(ids, dtype=np.uint64))
    assert simple8b.decode_ids(words, escapes).tolist() == ids
    first = np.frombuffer(blocks, "<u4")
    assert len(first) == -(-len(ids) // simple8b.BLOCK)
    if len(first) > 1:  # a block is decoded on its own
        part = simple8b.decode_ids(words[8 * first[1] : (8 * first[2] if len(first) > 2 else None)], escapes)
        assert part.tolist() == ids[simple8b.BLOCK : 2 * simple8b.BLOCK]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 60), st.integers(0, 60)), max_size=40), st.integers(1, 16), st.integers(1, 5), st.integers(1, 16))
def test_packing_keeps_limits_and_every_id(sizes, tokens, segments, loss):
    limits = packing.Limits(tokens, segments, loss)
    packer = packing.Packer(limits, waiting=4)
    rows = []
    for doc, (total, prompt) in enumerate(sizes):
        ids = np.arange(total, dtype="<u4").tobytes()
        rows += packer.add(packing._Example(doc, ids, total, min(prompt, total)))
    rows += packer.finish()
    covered = {}
    used = {}
    for doc, start, length, ids, _, sequence, offset, _, loss_tokens, _, _ in rows:
        assert ids == np.arange(start, start + length, dtype="<u4").tobytes() and length > 0
        covered.setdefault(doc, []).append((start, length))
        u = used.setdefault(sequence, [0, 0, 0])
        assert offset == u[0]
        used[sequence] = [u[0] + length, u[1] + 1, u[2] + loss_tokens]
    assert all(t <= tokens and n <= segments and w <= loss for t, n, w in used.values())
    for doc, (total, _) in enumerate(sizes):
        at = 0
        for start, length in sorted(covered[doc]):
            assert start == at
            at += length
        assert at == total


def test_automaton_walks_exactly_the_substrings():
    words = ["\nabcab\n", "\nbca\n", "\nxabx\n", "\nabcab\n"]
    automaton = language.suffix_automaton(words)
    inside = {w[i:j] for w in words for i in range(len(w)) for j in range(i + 1, len(w) + 1)}

    def walks(text):
        state = 0
        for c in text:
            state = automaton.get(state * language._CHARS + ord(c))
            if state is None:
                return False
        return True

    for n in range(1, 4):
        for text in map("".join, __import__("itertools").product("abcx\n", repeat=n)):
            assert walks(text) == (text in inside)
    assert language.phrases(automaton, "\nabx") == 2
    assert language.phrases(automaton, "qq") == 2
    assert language.phrases(automaton, "") == 0


def _brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \t", "One", "a b c d", "A  b\tc\nd E", "é Ü x y z é Ü x", "a b c d " * 40])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == _brute_print(text)


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    doc = np.array([0, 0, 0, 1, 2, 2])
    unary, transitions = rng.normal(size=6), rng.normal(size=(2, 2))
    good, pairs, total = quality.marginals(unary, doc, transitions)
    want, want_pairs, want_total = np.zeros(6), np.zeros((2, 2)), 0.0
    for d in range(3):
        at = np.flatnonzero(doc == d)
        weights = {}
        for labels in __import__("itertools").product((0, 1), repeat=len(at)):
            score = sum(unary[i] * y for i, y in zip(at, labels, strict=True))
            score += sum(transitions[a, b] for a, b in zip(labels, labels[1:], strict=False))
            weights[labels] = np.exp(score)
        z = sum(weights.values())
        want_total += np.log(z)
        for labels, w in weights.items():
            for i, y in zip(at, labels, strict=True):
                want[i] += y * w / z
            for a, b in zip(labels, labels[1:], strict=False):
                want_pairs[a, b] += w / z
    assert np.allclose(good, want) and np.allclose(pairs, want_pairs) and np.isclose(total, want_total)


def test_quality_of_odd_texts():
    model = quality.train(["good words here.\nand more of them."] * 5 + ["BAD!! BAD!! BAD!!\nBAD!! BAD!!"] * 5, [1] * 5 + [0] * 5)
    scores = quality.score_texts(model, ["", "\n\n", "good words here.", "BAD!! BAD!!", "x" * 100_000])
    assert ((scores >= 0) & (scores <= 1)).all() and scores[2] > 0.5 > scores[3]
    assert quality.train([], []) is None


def test_parsing_side_by_side_equals_one_walk():
    rng = random.Random(6)
    for _ in range(60):
        many = rng.choice([2, 5, 70, 200])
        automaton = language.suffix_automaton(["".join(chr(rng.randrange(many)) for _ in range(rng.randint(1, 400)))])
        parser = language.Parser(automaton, many, 1.0)
        texts = [np.array([rng.randrange(many + 1) for _ in range(rng.randint(0, 700))], dtype=np.uint8) for _ in range(12)]
        stretches, active, of_text = language._stretches(texts)
        got = np.bincount(of_text, parser.phrases(stretches, active), len(texts)).tolist()
        step = language.STRETCH
        assert got == [sum(language.phrases(automaton, "".join(map(chr, t[i : i + step]))) for i in range(0, len(t), step)) for t in texts]


def test_symbols_of_a_text():
    symbols = {" ": 0, "a": 1, "b": 2, "é": 3}
    turned = language._Symbols(symbols, 4)
    codes, letters = turned.of("12 A, b!\n\nÉ_x")
    assert language.normalised("12 A, b!\n\nÉ_x") == "a b é x"
    assert codes.tolist() == [0, 1, 0, 2, 0, 3, 0, 4] and letters == 4
    assert turned.of("")[0].tolist() == [] and turned.of("...")[1] == 0


def test_samples_take_equal_shares():
    class Row:
        def __init__(self, text):
            self.text = text

    assert language._sampled(iter([Row("aaaa bbbb"), Row("c"), Row("dddddddd")]), 9, 3) == "aaacddda "
    assert language._sampled(iter([]), 9, 3) == ""


def test_ranges_are_decoded_by_block_offsets():
    rng = random.Random(9)
    ids = np.array([rng.choice([rng.randrange(4), rng.randrange(50_000), rng.getrandbits(64)]) for _ in range(5000)], dtype=np.uint64)
    words, offsets, escapes = simple8b.encode_ids(ids)
    for begin, end in [(0, 5000), (0, 0), (0, 1), (1023, 1025), (1024, 2048), (4999, 5000), (700, 4100)]:
        assert (simple8b.decode_range(words, offsets, escapes, begin, end) == ids[begin:end]).all()
    # blocks outside the range are not looked at
    spoiled = bytearray(words)
    spoiled[: 8 * int(np.frombuffer(offsets, "<u4")[2])] = bytes(8 * int(np.frombuffer(offsets, "<u4")[2]))
    assert (simple8b.decode_range(bytes(spoiled), offsets, escapes, 2048, 5000) == ids[2048:]).all()
