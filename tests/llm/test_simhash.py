"""Ball hashing where many fingerprints share their leading bits."""

from __future__ import annotations

import random

from claimloom.llm import components, simhash

AT_ONCE = 20_000


def test_hot_key_is_split_and_exact(spark, monkeypatch):
    rng = random.Random(7)
    centres = [rng.getrandbits(64), (1 << 64) - 1, 0]
    prints = {c ^ sum(1 << k for k in rng.sample(range(64), rng.randrange(9))) for c in centres for _ in range(150)}
    meet = simhash._meet

    def bounded(keys, values, left, masks, *rest):
        written = sum(len(masks[n]) for n in left)
        assert written <= 2 * AT_ONCE, written
        return meet(keys, values, left, masks, *rest)

    monkeypatch.setattr(simhash, "VALUES_AT_ONCE", AT_ONCE)
    monkeypatch.setattr(simhash, "_meet", bounded)
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
