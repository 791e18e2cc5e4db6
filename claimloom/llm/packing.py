"""Vector bin packing of training examples into sequences of a fixed token length.

Each example is a point in three dimensions: tokens, segments (one per piece) and loss-bearing
tokens. A sequence is a bin with a limit in each. The dot-product heuristic fills one bin at a time:
of the pieces that fit, the one whose demand has the largest dot product with the room left, both
scaled by the limits and weighted by the average demand, goes in next. When none fits whole, the
best one is cut and the rest goes back to the waiting pieces.

Every task packs its own partition as a stream with a bounded number of waiting examples: no
shuffle, nothing gathered, and a lost task is packed again from the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.tokens import encoder

# Examples waiting in one task; the heuristic chooses among them.
WAITING = 512

# Sequences of one task are numbered within this range.
PER_TASK = 1 << 33

SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint, "
    "segment int, loss_tokens bigint, sequence_tokens bigint, padding bigint"
)


@dataclass(frozen=True)
class Limits:
    """What one sequence holds at most."""

    tokens: int = 4096
    segments: int = 512
    loss_tokens: int = 4096


@dataclass
class _Example:
    doc_id: int | None
    ids: bytes
    total: int
    prompt: int
    at: int = 0

    def loss(self, start: int, end: int) -> int:
        return max(0, end - max(start, self.prompt))


class Packer:
    """Fills sequences one after the other; ``add`` and ``finish`` yield the pieces of full ones."""

    def __init__(self, limits: Limits, first_sequence: int = 0, waiting: int = WAITING):
        if min(limits.tokens, limits.segments, limits.loss_tokens) < 1:
            raise ValueError("every limit must be at least 1")
        self.limits = limits
        self.caps = np.array([limits.tokens, limits.segments, limits.loss_tokens], dtype=float)
        self.sequence = first_sequence
        self.room = waiting
        self.waiting: list[_Example | None] = [None] * waiting
        # what a waiting example still asks for: tokens, one segment, loss tokens
        self.demand = np.zeros((waiting, 3))
        self.asked = np.zeros(3)
        self.free = list(range(waiting))[::-1]
        self.bin: list[tuple[_Example, int, int]] = []
        self.left = self.caps.copy()

    def add(self, example: _Example) -> Iterator[tuple]:
        while not self.free:
            yield from self._step()
        slot = self.free.pop()
        self.waiting[slot] = example
        self._ask(slot)

    def finish(self) -> Iterator[tuple]:
        while len(self.free) < self.room:
            yield from self._step()
        if self.bin:
            yield from self._close_by_powers()

    def _ask(self, slot: int) -> None:
        example = self.waiting[slot]
        self._demand(slot, (example.total - example.at, 1, example.loss(example.at, example.total)))

    def _demand(self, slot: int, asked: tuple[int, int, int]) -> None:
        self.asked += asked - self.demand[slot]
        self.demand[slot] = asked

    def _step(self) -> Iterator[tuple]:
        """Place one piece, or close the sequence if nothing more goes in."""
        within = self.demand <= self.left
        fits = within[:, 0] & within[:, 1] & within[:, 2]
        full = not self.free
        present = None if full else self.demand[:, 1] > 0
        if not full:
            fits &= present
        # whole numbers, so the sum is the same in any order
        weight = self.asked / (self.room - len(self.free)) / self.caps
        score = (np.minimum(self.demand, self.left) / self.caps) @ (weight * self.left / self.caps)
        whole = bool(fits.any())
        among = fits if whole else present
        slot = int(score.argmax() if among is None else np.where(among, score, -1.0).argmax())
        example = self.waiting[slot]
        end = example.total if whole else self._cut(example)
        if end <= example.at:  # the best asks for loss tokens only; one whose prompt goes in may wait
            cuts = [(self._cut(e) - e.at, -i) for i, e in enumerate(self.waiting) if e is not None]
            length, slot = max(cuts)
            slot = -slot
            example = self.waiting[slot]
            end = example.at + length
            if length <= 0:
                yield from self._close()
                return
        piece = (example, example.at, end)
        self.bin.append(piece)
        self.left -= (end - example.at, 1, example.loss(example.at, end))
        example.at = end
        if end == example.total:
            self.waiting[slot] = None
            self._demand(slot, (0, 0, 0))
            self.free.append(slot)
        else:
            self._ask(slot)
        if self.left[0] < 1 or self.left[1] < 1:
            yield from self._close()

    def _cut(self, example: _Example) -> int:
        """Where the longest prefix ends that goes into the open sequence."""
        if self.left[1] < 1:
            return example.at
        by_loss = max(example.at, example.prompt) + int(self.left[2])
        return min(example.total, example.at + int(self.left[0]), by_loss)

    def _close(self) -> Iterator[tuple]:
        total = sum(end - start for _, start, end in self.bin)
        yield from self._rows(self.bin, total)
        self.bin, self.left = [], self.caps.copy()

    def _close_by_powers(self) -> Iterator[tuple]:
        """The last, partly filled sequence as sequences of a power of two, which need no padding."""
        pieces, self.bin = self.bin[::-1], []
        total = sum(end - start for _, start, end in pieces)
        while total:
            size = 1 << (total.bit_length() - 1)
            part, left = [], size
            while left:
                example, start, end = pieces.pop()
                cut = min(end, start + left)
                part.append((example, start, cut))
                left -= cut - start
                if cut < end:
                    pieces.append((example, cut, end))
            yield from self._rows(part, size)
            total -= size
        self.left = self.caps.copy()

    def _rows(self, pieces: list[tuple[_Example, int, int]], total: int) -> Iterator[tuple]:
        offset = 0
        padded = total if total & (total - 1) == 0 else self.limits.tokens
        for segment, (example, start, end) in enumerate(pieces):
            ids = example.ids[4 * start : 4 * end]
            yield (
                example.doc_id, start, end - start, ids, example.total, self.sequence, offset, segment,
                example.loss(start, end), total, padded - total,
            )
            offset += end - start
        self.sequence += 1


def _frames(rows: Iterator[tuple], names: list[str], size: int = 2000) -> Iterator[pd.DataFrame]:
    kept = []
    for row in rows:
        kept.append(row)
        if len(kept) >= size:
            yield pd.DataFrame(kept, columns=names)
            kept = []
    if kept:
        yield pd.DataFrame(kept, columns=names)


def pack(
    examples: DataFrame, tokenizer_path: str, end_id: int, limits: Limits = Limits(),
    key: str = "doc_id", text: str = "text", prompt: str | None = None,
) -> DataFrame:
    """Pieces of every example and where they lie: columns of ``SCHEMA``.

    An example is the ids of its prompt, if a prompt column is named, then those of its text, then
    ``end_id``. Prompt ids bear no loss, all others do. Each id lies in exactly one piece. Full
    sequences hold ``limits.tokens`` ids; a sequence that the segment or loss limit closes earlier
    is padded; the last one of each task is split at powers of two, which need no padding.

    Null text or prompt: as empty, so the example is ``end_id`` alone. Null and repeated keys are
    packed like any others. An empty table gives no rows. Other columns are not read. Which task
    packs a row follows the scan, so the same files and settings give the same sequences.
    """
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    empty = F.lit("")
    chosen = examples.select(
        F.col(key).cast("bigint").alias("k"), F.coalesce(F.col(text), empty).alias("t"),
        (F.coalesce(F.col(prompt), empty) if prompt else empty).alias("p"),
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer_path).encode
        end = int(end_id).to_bytes(4, "little")
        packer = Packer(limits, TaskContext.get().partitionId() * PER_TASK)

        def rows() -> Iterator[tuple]:
            for frame in frames:
                for doc, body, lead in zip(frame["k"], frame["t"], frame["p"], strict=True):
                    before = encode(lead) if lead else b""
                    ids = before + encode(body) + end
                    yield from packer.add(_Example(None if pd.isna(doc) else int(doc), ids, len(ids) // 4, len(before) // 4))
            yield from packer.finish()

        for out in _frames(rows(), names):
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return chosen.mapInPandas(run, SCHEMA)
