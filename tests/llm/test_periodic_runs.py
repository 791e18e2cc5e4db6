"""Periodic runs against a comparison of every period."""

from __future__ import annotations

import random
import re

import pytest

from claimloom.llm import periodic_runs
from claimloom.llm.common import WORD, settle

SCHEMA = "doc_id bigint, text string, text_bytes string, runs_of string, start int"


def plain(words, least):
    """(start, length, period) of all runs: smallest period first, so that a multiple of it adds nothing."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i >= q:
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((b, e - b, q) for (b, e), q in found.items() if e - b >= least), key=lambda r: (r[0], r[2]))


def kept(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def drawn(rng, kind):
    """Letters that stand for words: random ones over few letters, powers, and shapes with regions inside a period."""
    some = "".join(rng.choice("abcde"[: rng.choice([1, 2, 2, 3, 5])]) for _ in range(rng.randint(0, 260)))
    if kind == "power":
        unit = some[: rng.randint(1, 60)] or "a"
        return some[: rng.randint(0, 40)] + unit * rng.randint(2, 8) + unit[: rng.randint(0, len(unit))] + some[:20]
    if kind == "fibonacci":
        a, b = "a", "ab"
        while len(b) < len(some):
            a, b = b, b + a
        return b[: len(some)]
    if kind == "parity":
        return "".join("ab"[i.bit_count() & 1] for i in range(len(some)))
    if kind == "long region":  # almost all of a period has a far smaller one
        q = rng.randint(2, 60)
        return ("a" * (q - 1) + "b") * rng.randint(2, 4) + "a" * rng.randint(0, q)
    if kind == "two regions":  # squares of many periods around one place
        return "ba" * rng.randint(1, 40) + "ab" * rng.randint(1, 40) + "b" * rng.randint(0, 3)
    if kind == "region twice":
        root = "".join(rng.choice("ab") for _ in range(rng.randint(1, 5)))
        unit = (root * 40)[: rng.randint(1, 100)]
        return rng.choice(["", root, root[::-1] * 10]) + unit + unit + rng.choice(["", "c", root, (root * 20)[:30]])
    if kind == "nested":
        unit = "a"
        for _ in range(rng.randint(1, 6)):
            unit = unit * rng.randint(1, 3) + rng.choice("abc") + unit * rng.randint(0, 2)
        return (unit * 3)[:400]
    if kind == "edited":
        letters = list(some)
        for _ in range(rng.randint(1, 3)):
            if letters:
                at, n = rng.randrange(len(letters)), rng.randint(1, 50)
                letters[at:at] = letters[at : at + n] * rng.randint(1, 4)
        return "".join(letters)
    return some


KINDS = ["random", "power", "fibonacci", "parity", "long region", "two regions", "region twice", "nested", "edited"]


@pytest.mark.parametrize("kind", KINDS)
def test_runs_equal_plain_search(kind):
    rng = random.Random(kind)
    for _ in range(25):
        texts = [[c.encode() for c in drawn(rng, rng.choice([kind, kind, "random"]))] for _ in range(8)]
        for least in (0, 12):
            assert periodic_runs.runs_of(texts, least) == [plain(t, least) for t in texts]


def test_long_periods():
    rng = random.Random(9)
    texts = []
    for q in (97, 384, 700, 1500):
        unit = [f"{rng.randrange(400)}".encode() for _ in range(q)]
        texts.append([b"x", *unit, *unit, *unit[: q // 3], b"y", *unit[5:], *unit])
    assert periodic_runs.runs_of(texts, 12) == [plain(t, 12) for t in texts]


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(periodic_runs, "WORDS_AT_ONCE", 100)
    settle(spark)
    texts = [None, "", " \n\t", "one", "a b " * 6, "a b " * 5 + "a", "a\x0bb\x0cc\r" * 4, "Ünï ünï " * 9 + "end", "w " * 30_000 + "z", " ".join(map(str, range(500)))]
    rows = [(i, t, "p", "q", 7) for i, t in enumerate(texts)] + [(None, "k l m " * 9, "p", "q", 7), (4, texts[4], "p", "q", 7)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(2)
    got = periodic_runs.detect(df, ["doc_id", "start", "text_bytes"], collapsed="left").collect()
    want = []
    for doc_id, text, clash, _, start in rows:
        words = re.findall(WORD, text or "")
        runs = [(0, 30_000, 1)] if len(words) > 30_000 else plain(words, 12)
        want.append((doc_id, start, clash, runs, kept(words, runs)))
    assert sorted(((r.doc_id, r.start, r.text_bytes, [tuple(x) for x in r.runs], r.left) for r in got), key=str) == sorted(want, key=str)
    assert periodic_runs.detect(spark.createDataFrame([], SCHEMA), ["doc_id"]).count() == 0
