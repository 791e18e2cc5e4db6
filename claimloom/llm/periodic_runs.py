"""Periodic runs of words by string synchronising sets.

A run is a stretch of words with smallest period q, at least 2 q long, that keeps the period in
neither direction. For every dyadic scale t the runs with periods from 3 t to 6 t are found by a
synchronising set: position i is in it if the least hash of the t-word stretches beginning at
i, ..., i + t is that of the first or the last, so that equal contexts of 2 t words decide alike wherever
they stand. Stretches with a period of at most t / 3 bear no hash. A run's first period either holds a
position of the set, which its second period repeats, or begins highly periodic. So

* positions of the set with equal contexts propose their distance as a period;
* highly periodic regions, which are runs found before, propose the distance of their ends, and
  where two of one period meet, every distance that brings them into phase.

Every proposal is extended word by word to both sides, and stands if it is two periods long. The
periods below the smallest scale are compared directly. Contexts are hashed by doubling, hashes only
propose; words are compared as numbers given to them exactly.

Texts of a task are laid end to end, longest first, with a word of its own after each, so that all of
them are worked on at once; a scale reads only the texts long enough for it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Periods up to this one are compared directly; the first scale, t = 2, begins above.
SMALL = 5

# Words worked on at once; a longer text is worked on alone, in some 100 bytes a word.
WORDS_AT_ONCE = 200_000

_MOST = np.uint64((1 << 64) - 1)
_ODD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Numbers whose every bit depends on all bits of the given ones."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` numbers in a row."""
    wanted, have = len(x) - width + 1, 1
    while 2 * have <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[:wanted], x[width - have : width - have + wanted])


def _covered(length: int, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which places lie in one of the stretches."""
    steps = np.zeros(length + 1, dtype=np.int32)
    np.add.at(steps, np.minimum(begins, length), 1)
    np.add.at(steps, np.minimum(ends, length), -1)
    return np.cumsum(steps[:-1]) > 0


class Runs:
    """The runs of a sequence of numbers whose first and last occur once in it."""

    def __init__(self, numbers: np.ndarray):
        self.numbers = numbers
        self.found: dict[tuple[int, int], int] = {}  # smallest period by (begin, end)

    def _agree(self, a: int, b: int, step: int) -> int:
        """How many numbers in a row agree from the places ``a`` and ``b`` on, to the right (1) or the left (-1)."""
        numbers, done, width = self.numbers, 0, 16
        while True:
            if step > 0:
                x, y = numbers[a + done : a + done + width], numbers[b + done : b + done + width]
                x = x[: len(y)]
            else:
                y, x = numbers[max(0, b - done - width + 1) : b - done + 1][::-1], numbers[max(0, a - done - width + 1) : a - done + 1][::-1]
                y = y[: len(x)]
            differ = np.flatnonzero(x != y)
            if len(differ):
                return done + int(differ[0])
            if not len(x):
                return done
            done += len(x)
            width *= 2

    def _small(self) -> None:
        for q in range(1, min(SMALL, len(self.numbers) - 1) + 1):
            same = np.concatenate(([False], self.numbers[:-q] == self.numbers[q:], [False]))
            edges = np.flatnonzero(same[1:] != same[:-1])
            begins, ends = edges[::2], edges[1::2]
            long = np.flatnonzero(ends - begins >= q)
            for begin, end in zip(begins[long].tolist(), (ends[long] + q).tolist(), strict=True):
                self.found.setdefault((begin, end), q)

    def _equal_contexts(self, scale: int, hashes: np.ndarray, contexts: np.ndarray, regions: np.ndarray) -> Iterator[tuple[int, int]]:
        """(period, place) proposals of the synchronising set of a scale."""
        ids = hashes
        periodic = regions[(3 * regions[:, 2] <= scale) & (regions[:, 1] - regions[:, 0] >= scale)]
        if len(periodic):
            ids = np.where(_covered(len(ids), periodic[:, 0], periodic[:, 1] - scale + 1), _MOST, ids)
        least = _least(ids, scale + 1)
        many = len(least)
        place = np.flatnonzero(((least == ids[:many]) | (least == ids[scale : scale + many])) & (least != _MOST))
        context = contexts[place]
        order = np.argsort(context, kind="stable")
        place, context = place[order], context[order]
        step = 1
        while step < len(place):
            apart = place[step:] - place[:-step]
            near = np.flatnonzero((context[step:] == context[:-step]) & (apart < 6 * scale))
            if not len(near):
                break
            near = near[apart[near] >= 3 * scale]
            yield from zip(apart[near].tolist(), place[near].tolist(), strict=True)
            step += 1

    def _regions(self, scale: int, regions: np.ndarray) -> Iterator[tuple[int, int]]:
        """(period, place) proposals of the highly periodic regions of a scale."""
        long = regions[(3 * regions[:, 2] <= scale) & (regions[:, 1] - regions[:, 0] >= 3 * scale - 1)]
        long = long[np.lexsort((long[:, 1], long[:, 2]))].tolist()
        for at, (begin, end, p) in enumerate(long):
            for other_begin, other_end, other_p in long[at + 1 :]:
                if other_p != p or other_end - end >= 6 * scale and other_begin > end:
                    break
                if 3 * scale <= other_end - end < 6 * scale:
                    yield other_end - end, end - 1
                if end - p < other_begin <= end:
                    root = self.numbers[end - p : end]
                    for turn in range(p):
                        if np.array_equal(self.numbers[other_begin + turn : other_begin + turn + p], root):
                            first = 3 * scale + (other_begin + turn - end - 3 * scale) % p
                            last = min(6 * scale, end - begin + 1, other_end - other_begin + 1)
                            yield from ((q, end - 2 * p) for q in range(first, last, p))
                            break

    def _take(self, proposals: Iterator[tuple[int, int]]) -> None:
        """Extend every proposal; those inside the stretch that one before has given are known."""
        period, until = 0, 0
        for q, place in sorted(set(proposals)):
            if q == period and place + q < until:
                continue
            begin = place + 1 - self._agree(place, place + q, -1)
            end = place + q + self._agree(place, place + q, 1)
            period, until = q, end
            if end - begin >= 2 * q:
                self.found.setdefault((begin, end), q)

    def all(self, lengths: list[int]) -> dict[tuple[int, int], int]:
        """Smallest period by (begin, end); ``lengths``, descending, of texts of which each has one number after it."""
        self._small()
        reach = np.cumsum(np.array([1, *lengths]) + np.array([0] + [1] * len(lengths)))
        lengths = np.array(lengths)
        hashes, scale = _mixed(self.numbers.astype(np.uint64) * _ODD[0] + _ODD[1]), 1
        while True:
            hashes = _mixed(hashes[:-scale] * _ODD[0] + hashes[scale:] * _ODD[1] + np.uint64(scale))
            scale *= 2
            texts = int((lengths >= 6 * scale).sum())
            if not texts:
                return self.found
            hashes = hashes[: int(reach[texts]) - scale + 1]
            contexts = _mixed(hashes[:-scale] * _ODD[0] + hashes[scale:] * _ODD[1] + np.uint64(scale))
            regions = np.array([(b, e, p) for (b, e), p in self.found.items() if 3 * p <= scale], dtype=np.int64).reshape(-1, 3)
            self._take([*self._equal_contexts(scale, hashes, contexts, regions), *self._regions(scale, regions)])


class _Numbers(dict):
    """A number for every word, by first appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = len(self)
        return self[word]


def runs_of(texts: list[list[bytes]], least: int) -> list[list[tuple[int, int, int]]]:
    """Per text the (start, length, period) of its runs of ``least`` words or more, ascending by start, then period."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    lengths = [len(texts[i]) for i in order]
    numbers = np.empty(sum(lengths) + len(texts) + 1, dtype=np.int64)
    known, at = _Numbers(), 1
    numbers[0], begins = -1, []
    for place, i in enumerate(order):
        begins.append(at)
        numbers[at : at + len(texts[i])] = list(map(known.__getitem__, texts[i]))
        at += len(texts[i])
        numbers[at] = -2 - place
        at += 1
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    kept = [(b, e, p) for (b, e), p in Runs(numbers).all(lengths).items() if e - b >= least]
    for (begin, end, period), place in zip(kept, (np.searchsorted(begins, [b for b, _, _ in kept], side="right") - 1).tolist(), strict=True):
        out[order[place]].append((begin - begins[place], end - begin, period))
    for rows in out:
        rows.sort(key=lambda r: (r[0], r[2]))
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by single spaces."""
    if runs:
        table = np.array(runs, dtype=np.int64)
        gone = _covered(len(words), table[:, 0] + table[:, 2], table[:, 0] + table[:, 1])
        words = [words[i] for i in np.flatnonzero(~gone).tolist()]
    return b" ".join(words)


_ARROW_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def detect(docs: DataFrame, keep: list[str], text: str = "text", least: int = 12, runs: str = "runs", collapsed: str = "collapsed") -> DataFrame:
    """The columns ``keep`` with the runs of a text's words and the text without their repetitions.

    ``runs``: array of (start, length, period) in words, numbered from 0, ascending by start, then
    period, of the runs of at least ``least`` words. ``collapsed``: the words that no run holds after
    its first period, joined by single spaces. Words are what lies between spaces and the controls from
    tab to carriage return, compared as they are written.

    A null text and one without words have no runs and collapse to the empty text. Overlapping runs
    are all listed. Ids play no part, so repeated rows appear each. An empty table gives no rows. The
    names ``runs`` and ``collapsed`` must not be among ``keep``; other columns don't matter.
    """
    body = "text_bytes"
    while body in keep:
        body += "_"
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*keep).schema)
    at = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def settled(batch: pa.RecordBatch, begin: int, texts: list[list[bytes]]) -> pa.RecordBatch:
            found = runs_of(texts, least)
            left = pa.array([collapse(w, r) for w, r in zip(texts, found, strict=True)], pa.binary()).cast(pa.string())
            rows = [[{"start": s, "length": n, "period": p} for s, n, p in r] for r in found]
            kept = [c.slice(begin, len(texts)) for c in batch.columns[:at]]
            return pa.RecordBatch.from_arrays([*kept, pa.array(rows, _ARROW_RUNS), left], names=[*keep, runs, collapsed])

        for batch in batches:
            begin, texts, size = 0, [], 0
            for place, data in enumerate(batch.column(at)):
                words = (data.as_py() or b"").split()
                if texts and size + len(words) > WORDS_AT_ONCE:
                    yield settled(batch, begin, texts)
                    begin, texts, size = place, [], 0
                texts.append(words)
                size += len(words)
            if texts:
                yield settled(batch, begin, texts)

    schema = f"{kinds}`{runs}` array<struct<start: bigint, length: bigint, period: bigint>>, `{collapsed}` string"
    return docs.select(*keep, F.col(text).cast("string").cast("binary").alias(body)).mapInArrow(run, schema)
