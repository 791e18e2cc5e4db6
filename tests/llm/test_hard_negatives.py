"""Hard negatives and their residue arithmetic against plain whole numbers."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from claimloom.llm import hard_negatives
from claimloom.llm.common import settle

SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, score string, v string, chosen string"


def plain(rows, is_anchor, scale=256):
    good = []
    for key, vector, label in rows:
        if key is None or label is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        good.append((key, label, [int(np.floor(scale * float(np.float32(x)))) for x in vector]))
    out = []
    for key, label, vector in good:
        if not is_anchor(key):
            continue
        scored = [(sum(x * y for x, y in zip(vector, v, strict=False)), k, lab) for k, lab, v in good if k != key]
        scored.sort(key=lambda t: (-t[0], t[1]))
        for high, positive, _ in [t for t in scored if t[2] == label][:5]:
            near = [t for t in scored if t[2] != label and 80 * high <= 100 * t[0] <= 100 * high][:5]
            out += [(key, positive, rank, k, high, s) for rank, (s, k, _) in enumerate(near, 1)]
    return sorted(out)


def mined(spark, rows):
    df = settle(spark).createDataFrame([(*r, "x", "y", "z", "w") for r in rows], SCHEMA)
    return sorted(tuple(r) for r in hard_negatives.mine(df.repartition(3), F.col("vec_id") % 10 == 0).collect())


def test_scores_are_exact_at_every_size():
    rng = random.Random(5)
    for size, width in ((3, 5), (160, 64), (30_000, 3000), (2**30, 7), (2**31 - 1, 1)):
        a = np.array([[rng.randint(-size, size) for _ in range(width)] for _ in range(6)], dtype=np.int64)
        b = np.array([[rng.randint(-size, size) for _ in range(width)] for _ in range(9)], dtype=np.int64)
        a[0], b[0], b[1] = size, size, -size  # the largest and the least score there can be
        primes = hard_negatives.primes_for(width * size * size)
        got = hard_negatives.Scorer(a, primes).scores([hard_negatives.residues(b, p) for p in primes], slice(0, 6))
        want = a.astype(object) @ b.astype(object).T
        fits = np.abs(want) < 2**63
        assert fits.any() and (got[fits] == want[fits]).all()


def test_equals_plain_search(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ANCHOR_BLOCK", 7)  # several blocks
    monkeypatch.setattr(hard_negatives, "ROWS_AT_ONCE", 16)
    monkeypatch.setattr(hard_negatives, "ANCHORS_AT_ONCE", 3)
    rng = random.Random(3)
    rows = [(i, [rng.gauss(1, 1) for _ in range(6)], rng.randint(0, 2)) for i in range(200)]
    rows += [(300 + i, [1.0] * 6, i % 2) for i in range(24)]  # ties
    rows += [(400, [0.0] * 6, 0), (401, [0.0] * 6, 1), (410, [5.0], 1), (411, [5.0, 0.0, 0.0], 0)]
    rows += [(None, [1.0] * 6, 1), (500, None, 1), (510, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1), (520, [1.0] * 5 + [float("nan")], 1), (530, [1.0] * 6, None)]
    assert mined(spark, rows) == plain(rows, lambda key: key % 10 == 0)


def test_repeated_rows_are_each_mined(spark):
    rows = [(10, [1.0, 0.5], 0), (10, [1.0, 0.5], 0), (11, [1.0, 0.25], 0), (12, [0.9, 0.5], 1), (12, [0.9, 0.5], 1)]
    assert mined(spark, rows) == plain(rows, lambda key: key % 10 == 0)


def test_empty_and_unlabelled(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(10, [1.0], None), (20, None, 1), (30, [], 1), (31, [], 0)]) == []
