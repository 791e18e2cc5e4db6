"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad. A line's features are shares of character and word kinds in it, and the
same of the lines before and after; a transition weight ties neighbouring labels. Trained on lines
that inherit their document's label. A document's score is the mean marginal probability of good
over its lines, by forward-backward, weighted by their lengths.

All documents of a batch are handled together: features by running sums over bytes, the chain by
steps over line numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.session import cut_lineage

# Bounds of the labelled sample: documents, and characters of one.
SAMPLE_DOCS = 3000
SAMPLE_CHARS = 20_000

STEPS = 200
RATE = 0.1
DECAY = 1e-3

# Bytes of text whose features are computed at once.
BYTES_AT_ONCE = 1 << 22

_SPACE, _UPPER, _LOWER, _DIGIT, _MARK, _SHOUT, _BAR, _SIGN, _HIGH = range(9)


def _kinds() -> np.ndarray:
    kinds = np.zeros((9, 256), dtype=bool)
    for code in range(256):
        char = chr(code)
        kinds[_SPACE, code] = code == 32 or 9 <= code <= 13
        kinds[_UPPER, code] = "A" <= char <= "Z"
        kinds[_LOWER, code] = "a" <= char <= "z"
        kinds[_DIGIT, code] = "0" <= char <= "9"
        kinds[_MARK, code] = 33 <= code < 127 and not char.isalnum()
        kinds[_SHOUT, code] = char in "!?"
        kinds[_BAR, code] = char in "|<>{}[]=_/\\"
        kinds[_SIGN, code] = char in "#$%&*@^~+"
        kinds[_HIGH, code] = code >= 128
    return kinds


_KINDS = _kinds()
_POWERS = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, dtype=np.uint64), dtype=np.uint64)


def _own_features(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features, bytes) of every line of ``data``, which ends with a line break."""
    breaks = np.flatnonzero(data == 10)
    starts = np.concatenate(([0], breaks[:-1] + 1))
    length = breaks - starts
    whole = np.maximum(length, 1)
    share = []
    for kind in (_SPACE, _UPPER, _LOWER, _DIGIT, _MARK, _SHOUT, _BAR, _SIGN, _HIGH):
        so_far = np.concatenate(([0], np.cumsum(_KINDS[kind][data], dtype=np.int64)))
        share.append((so_far[breaks] - so_far[starts]) / whole)
    gap = _KINDS[_SPACE][data]
    begin = np.flatnonzero(~gap & np.concatenate(([True], gap[:-1])))
    lines = len(breaks)
    if len(begin):
        line = np.searchsorted(breaks, begin)
        owner = np.repeat(begin, np.diff(np.append(begin, len(data))))
        at = np.concatenate((np.zeros(begin[0], dtype=np.int64), np.arange(begin[0], len(data)) - owner))
        mixed = np.where(gap, np.uint64(0), (data.astype(np.uint64) + np.uint64(1)) * _POWERS[at & 63])
        mark = np.add.reduceat(mixed, begin)
        size = np.add.reduceat(~gap, begin).astype(np.float64)
        repeat = np.zeros(len(begin))
        repeat[1:] = (mark[1:] == mark[:-1]) & (line[1:] == line[:-1])
        words = np.bincount(line, minlength=lines)
        many = np.maximum(words, 1)
        repeated = np.bincount(line, weights=repeat, minlength=lines) / many
        mean_size = np.bincount(line, weights=size, minlength=lines) / many
        long = np.bincount(line, weights=size > 15, minlength=lines) / many
        tail = data[np.minimum(begin + size.astype(np.int64) - 1, len(data) - 1)]
        signed = np.bincount(line, weights=_KINDS[_MARK][tail], minlength=lines) / many
        capital = np.bincount(line, weights=_KINDS[_UPPER][data[begin]], minlength=lines) / many
        distinct = np.unique(np.stack([line.astype(np.uint64), mark]), axis=1)[0].astype(np.int64)
        variety = np.bincount(distinct, minlength=lines) / many
    else:
        words = repeated = mean_size = long = signed = capital = variety = np.zeros(lines)
    last = np.where(length > 0, data[np.maximum(breaks - 1, 0)], 32)
    plain = [
        *share, repeated, mean_size / 10, long, signed, capital, variety, np.log1p(length) / 5, np.log1p(words) / 5,
        np.isin(last, [46, 33, 63]), length == 0,
    ]
    shares = [share[k] for k in (_UPPER, _DIGIT, _MARK, _SHOUT, _BAR, _SIGN)] + [repeated, signed, 1 - variety]
    steps = [x > cut for x in shares for cut in (0.02, 0.1, 0.4)]
    return np.stack([np.asarray(f, dtype=np.float64) for f in [*plain, *steps]], axis=1), length


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features with neighbours, bytes, document number) of all lines of the texts."""
    parts, sizes, docs, pending, size, first = [], [], [], [], 0, 0

    def flush() -> None:
        data = np.frombuffer(b"".join(pending), dtype=np.uint8)
        own, length = _own_features(data)
        counts = [p.count(b"\n") for p in pending]
        parts.append(own)
        sizes.append(length)
        docs.append(np.repeat(np.arange(first, first + len(pending)), counts))

    for i, text in enumerate(texts):
        pending.append(text.encode("utf-8", "replace") + b"\n")
        size += len(pending[-1])
        if size >= BYTES_AT_ONCE or i == len(texts) - 1:
            flush()
            pending, size, first = [], 0, i + 1
    own, length, doc = np.concatenate(parts), np.concatenate(sizes), np.concatenate(docs)
    before, after = np.zeros_like(own), np.zeros_like(own)
    same = (doc[1:] == doc[:-1])[:, None]
    before[1:] = np.where(same, own[:-1], 0)
    after[:-1] = np.where(same, own[1:], 0)
    linked = np.stack([np.concatenate(([0.0], same[:, 0])), np.concatenate((same[:, 0], [0.0]))], axis=1)
    return np.concatenate([own, before, after, linked], axis=1), length, doc


@dataclass(frozen=True)
class Model:
    """Weights of a line's features for good, and of label pairs [before, after]."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    bias: float
    transitions: np.ndarray


def _chains(doc: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """For each line number the lines that have it, documents with most lines first, and how many go on."""
    starts = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
    counts = np.diff(np.append(starts, len(doc)))
    order = np.argsort(-counts, kind="stable")
    starts, counts = starts[order], counts[order]
    lengths = np.arange(counts[0] if len(counts) else 0)
    live = np.searchsorted(-counts, -lengths, side="left")
    return [(starts[: live[t]] + t, int(live[t + 1]) if t + 1 < len(live) else 0) for t in lengths]


def marginals(unary: np.ndarray, doc: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(probability of good per line, expected label pairs, log partition) by forward-backward."""
    scores = np.stack([np.zeros_like(unary), unary], axis=1)
    forward, backward = np.empty_like(scores), np.zeros_like(scores)
    chains = _chains(doc)
    for t, (lines, _) in enumerate(chains):
        if t == 0:
            forward[lines] = scores[lines]
        else:
            last = forward[lines - 1]
            for y in (0, 1):
                forward[lines, y] = scores[lines, y] + np.logaddexp(last[:, 0] + transitions[0, y], last[:, 1] + transitions[1, y])
    pairs = np.zeros((2, 2))
    for t in range(len(chains) - 1, -1, -1):
        lines, going = chains[t]
        if going:
            on = lines[:going]
            after = scores[on + 1] + backward[on + 1]
            for y in (0, 1):
                backward[on, y] = np.logaddexp(transitions[y, 0] + after[:, 0], transitions[y, 1] + after[:, 1])
    whole = np.logaddexp(forward[:, 0] + backward[:, 0], forward[:, 1] + backward[:, 1])
    good = np.exp(forward[:, 1] + backward[:, 1] - whole)
    inner = np.flatnonzero(doc[1:] == doc[:-1])
    for y in (0, 1):
        for z in (0, 1):
            pairs[y, z] = np.exp(forward[inner, y] + transitions[y, z] + scores[inner + 1, z] + backward[inner + 1, z] - whole[inner]).sum()
    firsts = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
    total = float(whole[firsts].sum())
    return good, pairs, total


def train(texts: list[str], labels: list[int], steps: int = STEPS, rate: float = RATE, decay: float = DECAY) -> Model | None:
    """A model of the labelled texts by gradient steps with momentum scaling; None without texts."""
    if not texts:
        return None
    x, _, doc = line_features(texts)
    mean, spread = x.mean(axis=0), x.std(axis=0)
    spread[spread < 1e-6] = 1.0
    x = (x - mean) / spread
    y = np.asarray(labels)[doc].astype(float)
    inner = doc[1:] == doc[:-1]
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[:-1][inner].astype(int), y[1:][inner].astype(int)), 1)
    theta = np.zeros(x.shape[1] + 5)
    theta[-5] = np.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    n = len(texts)
    for step in range(1, steps + 1):
        unary = x @ theta[:-5] + theta[-5]
        good, pairs, _ = marginals(unary, doc, theta[-4:].reshape(2, 2))
        slope = np.concatenate([x.T @ (y - good), [(y - good).sum()], (seen - pairs).ravel()]) / n
        slope -= decay * np.concatenate([theta[:-5], [0.0], 10 * theta[-4:]])
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        theta += rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Model(mean, spread, theta[:-5], float(theta[-5]), theta[-4:].reshape(2, 2))


def score_texts(model: Model, texts: list[str]) -> np.ndarray:
    """Length-weighted mean marginal of good for every text."""
    if not texts:
        return np.zeros(0)
    x, length, doc = line_features(texts)
    unary = ((x - model.mean) / model.spread) @ model.weights + model.bias
    good, _, _ = marginals(unary, doc, model.transitions)
    weight = length + 1.0
    share = np.bincount(doc, weights=weight * good, minlength=len(texts)) / np.bincount(doc, weights=weight, minlength=len(texts))
    return np.clip(share, 0.0, 1.0)


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE_DOCS, chars: int = SAMPLE_CHARS) -> Model | None:
    """The model of a bounded sample of labelled documents.

    Of those with a label 0 or 1 and at most ``chars`` characters, the ``sample`` ones of least id
    hash are read and trained on. Null texts and labels are left out. None without a labelled document.

    Ids alone are joined to count them; the texts that travel are those below the hash at which about
    twice the sample is expected, and that is raised until the sample is full.
    """
    marked = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")).where("y in (0, 1)")
    bodies = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).where(F.length("t") <= chars)
    known = bodies.select("k").join(marked, "k").count()
    share = min(1.0, 2 * sample / max(known, 1))
    while True:
        most = F.xxhash64("k") <= min(int(share * 2.0**64) - (1 << 63), (1 << 63) - 1)
        near = bodies.where(most).join(marked.where(most), "k").orderBy(F.xxhash64("k"), "k", "y", F.xxhash64("t"))
        # written first: a sorted limit that is collected sends every task's best rows to the driver
        rows = cut_lineage(near.limit(sample).select("t", "y", F.xxhash64("k").alias("h"), "k")).collect()
        if len(rows) == sample or share == 1.0:
            break
        share = min(1.0, 4 * share)
    rows = sorted(rows, key=lambda r: (r.h, r.k, r.y, r.t))
    return train([r.t for r in rows], [r.y for r in rows])


def score(docs: DataFrame, model: Model | None, threshold: float = 0.3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score, predicted`` of every whole text; null text as empty, one empty line.

    Without a model every score is 0.5. Null and repeated keys are scored like others. An empty
    table gives no rows.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = [t if isinstance(t, str) else "" for t in frame["t"]]
            found = np.full(len(texts), 0.5) if model is None else score_texts(model, texts)
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "score": found, "predicted": (found >= threshold).astype(np.int32)})

    chosen = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("t"))
    return chosen.mapInPandas(run, "doc_id bigint, score double, predicted int")
