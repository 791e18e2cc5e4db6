"""Benchmark decontamination with a generalised suffix automaton of the benchmark's words.

The words of all items go into one suffix automaton, whose states stand for the word sequences that
end at the same places of the items. Documents are streamed through it word by word, following suffix
links where a word does not fit, so that at every word the longest sequence ending there that occurs
in an item is known. Where it is at least a window long, the state of its last ``window`` words names
the items, and those words are hit. Items shorter than a window count as a whole.

A match can only be as long as a window where every pair of adjacent words is adjacent in some item
too; words are numbered and pairs looked up for a whole document at once, and only stretches of such
pairs that are long enough are streamed.

Items come in blocks of at most ``BLOCK_WORDS`` words, each with an automaton of its own that is sent
to the executors; with several blocks, documents pass them one after the other. Longer items are cut
into pieces that overlap by a window less one word, so that no window is lost.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import free_names
from claimloom.session import cut_lineage

WINDOW = 10

# Words of items in one automaton, which the driver builds and each worker holds: some tens of megabytes.
BLOCK_WORDS = 200_000

# Bytes of a text that are split into words at once.
BYTES_AT_ONCE = 1 << 22

# Bytes as they count: A-Z as a-z, all other ASCII but digits and a-z as a space. Bytes of other characters belong to words.
_COUNTS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def split_words(data: bytes) -> Iterator[list[bytes]]:
    """The normalised words of a UTF-8 text, a bounded part at a time."""
    data = data.translate(_COUNTS)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + BYTES_AT_ONCE)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


class Automaton:
    """The generalised suffix automaton of sequences of numbered words, with what ends in its states."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.number: dict[bytes, int] = {}  # of a word
        self.step: list[dict[int, int]] = [{}]
        self.link, self.longest = [-1], [0]
        self.pairs: set[tuple[int, int]] = set()
        self.shortest = window  # length of the shortest sequence that is looked for
        self.names: dict[int, set[str]] = {}  # items by the state of one of their windows
        self.whole: dict[int, dict[int, set[str]]] = {}  # items shorter than a window, by state and length

    def _copy(self, parent: int, child: int, word: int) -> int:
        """A state of its own for the shorter ones of ``child``'s sequences, those that come by ``parent``."""
        copy = len(self.step)
        self.step.append(dict(self.step[child]))
        self.link.append(self.link[child])
        self.longest.append(self.longest[parent] + 1)
        self.link[child] = copy
        while parent >= 0 and self.step[parent].get(word) == child:
            self.step[parent][word] = copy
            parent = self.link[parent]
        return copy

    def _extend(self, last: int, word: int) -> int:
        """The state of the sequence of ``last`` and one more word."""
        known = self.step[last].get(word)
        if known is not None:
            return known if self.longest[known] == self.longest[last] + 1 else self._copy(last, known, word)
        state = len(self.step)
        self.step.append({})
        self.longest.append(self.longest[last] + 1)
        self.link.append(0)
        while last >= 0 and word not in self.step[last]:
            self.step[last][word] = state
            last = self.link[last]
        if last >= 0:
            child = self.step[last][word]
            self.link[state] = child if self.longest[child] == self.longest[last] + 1 else self._copy(last, child, word)
        return state

    def add(self, words: list[bytes]) -> list[int]:
        """Take in a sequence; its words' numbers."""
        numbers = [self.number.setdefault(w, len(self.number)) for w in words]
        last = 0
        for n in numbers:
            last = self._extend(last, n)
        self.pairs.update(zip(numbers, numbers[1:], strict=False))
        return numbers

    def walk(self, numbers: list[int]) -> Iterator[tuple[int, int]]:
        """After every word the state and length of the longest known sequence that ends there."""
        step, link, longest = self.step, self.link, self.longest
        state, length = 0, 0
        for n in numbers:
            to = step[state].get(n)
            while to is None and state:
                state = link[state]
                length = longest[state]
                to = step[state].get(n)
            if to is not None:
                state, length = to, length + 1
            yield state, length

    def top(self, state: int, length: int) -> int:
        """The state of the last ``length`` words of what a state stands for."""
        while self.longest[self.link[state]] >= length:
            state = self.link[state]
        return state

    def name(self, numbers: list[int], item: str) -> None:
        """Note the item at the states of its windows, once all sequences are in."""
        walked = list(self.walk(numbers))
        if len(numbers) < self.window:
            state = self.top(walked[-1][0], len(numbers))
            self.whole.setdefault(state, {}).setdefault(len(numbers), set()).add(item)
            self.shortest = min(self.shortest, len(numbers))
        for state, length in walked:
            if length >= self.window:
                self.names.setdefault(self.top(state, self.window), set()).add(item)

    def close(self, named: list[tuple[str, list[int]]]) -> Automaton:
        """Name the items that are in, and lay out the pairs for look-ups of whole documents."""
        for item, numbers in named:
            self.name(numbers, item)
        base = max(1, len(self.number))
        self.pairs = np.array(sorted(a * base + b for a, b in self.pairs), dtype=np.int64)
        return self

    def stretches(self, numbers: np.ndarray) -> Iterator[tuple[int, int]]:
        """(begin, end) of the longest stretches of known words and pairs that may hold a match."""
        known = numbers >= 0
        linked = np.zeros(max(0, len(numbers) - 1), dtype=bool)
        both = np.flatnonzero(known[1:] & known[:-1])
        if len(both) and len(self.pairs):
            pair = numbers[both].astype(np.int64) * len(self.number) + numbers[both + 1]
            place = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            linked[both[self.pairs[place] == pair]] = True
        begins = np.flatnonzero(known & ~np.concatenate(([False], linked)))
        ends = np.flatnonzero(known & ~np.concatenate((linked, [False]))) + 1
        long = np.flatnonzero(ends - begins >= self.shortest)
        return zip(begins[long].tolist(), ends[long].tolist(), strict=True)

    def find(self, data: bytes) -> tuple[int, list[tuple[int, int]], set[str], int]:
        """Number of words, spans of words that are hit, items, and the longest match among the hits of a text."""
        get, parts = self.number.get, []
        for words in split_words(data):
            parts.append(np.fromiter(map(get, words, repeat(-1)), dtype=np.int32, count=len(words)))
        numbers = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int32)
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        most = 0
        for begin, end in self.stretches(numbers):
            for at, (state, length) in enumerate(self.walk(numbers[begin:end].tolist()), begin + 1):
                if length < self.shortest:
                    continue
                hit = 0
                if length >= self.window:
                    items |= self.names.get(self.top(state, self.window), set())
                    hit = self.window
                if self.whole:
                    up = state
                    while up > 0:
                        for size, named in self.whole.get(up, {}).items():
                            if size <= length:
                                items |= named
                                hit = max(hit, size)
                        up = self.link[up]
                if hit:
                    most = max(most, length)
                    hit_from = at - hit
                    while spans and hit_from <= spans[-1][1]:
                        hit_from = min(hit_from, spans.pop()[0])
                    spans.append((hit_from, at))
        return len(numbers), spans, items, most


def _pieces(items: DataFrame, key: str, text: str, window: int) -> Iterator[tuple[str, list[bytes]]]:
    """Item ids with their words, in pieces of at most ``BLOCK_WORDS``."""
    named = items.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"), F.col(text).cast("string").cast("binary").alias("data"))
    for row in named.where(F.col("data").isNotNull()).toLocalIterator():
        words = [w for part in split_words(bytes(row.data)) for w in part]
        for at in range(0, max(1, len(words) - window + 1), max(1, BLOCK_WORDS - window + 1)):
            yield row.id, words[at : at + BLOCK_WORDS]


def automata(items: DataFrame, key: str = "item_id", text: str = "text", window: int = WINDOW) -> Iterator[Automaton]:
    """An automaton for every block of items; none for items without words."""
    made, named, size = Automaton(window), [], 0
    for name, words in _pieces(items, key, text, window):
        if size + len(words) > BLOCK_WORDS and size:
            yield made.close(named)
            made, named, size = Automaton(window), [], 0
        if words:
            named.append((name, made.add(words)))
            size += len(words)
    if size:
        yield made.close(named)


def _joined(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of spans, ascending and apart."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted([*a, *b]):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((begin, end))
    return out


FOUND = "struct<n_words: bigint, longest: bigint, spans: array<struct<begin: bigint, end: bigint>>, items: array<string>>"


def find(docs: DataFrame, items: DataFrame, keep: list[str], text: str = "text", item_key: str = "item_id", item_text: str = "text", window: int = WINDOW, found: str = "found") -> DataFrame:
    """The columns ``keep`` with ``found``, what a document shares with the items.

    ``found.n_words``: words of the text; ``spans``: disjoint stretches of words (from 0, the end
    exclusive) that lie in an occurrence of an item's window; ``items``: ids, as text and ascending, of
    the items with an occurring window; ``longest``: most words in a row among the hits that one item
    has too (0 without hits). Words are runs of letters, digits and non-ASCII characters, A-Z as a-z.
    An item of fewer words than a window is one window; one without words, and a null item, has none.

    A null or empty text has no words. Equal item ids are one item, a null id is the empty text.
    Repeated documents appear each. Without items nothing is hit; no documents give no rows.
    """
    spark = docs.sparkSession
    text_name, had = free_names(docs, "text_bytes", "had")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    at = len(keep)
    passing = docs.select(*keep, F.col(text).cast("string").cast("binary").alias(text_name))

    def pass_by(frame: DataFrame, shared, carry: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton = shared.value if shared is not None else Automaton(window).close([])
            for batch in batches:
                rows = []
                before = batch.column(at + 1).to_pylist() if batch.num_columns > at + 1 else repeat(None, batch.num_rows)
                for data, old in zip(batch.column(at), before, strict=True):
                    n, spans, named, longest = automaton.find(data.as_py() or b"")
                    if old:
                        spans = _joined(spans, [(s["begin"], s["end"]) for s in old["spans"]])
                        named, longest = named.union(old["items"]), max(longest, old["longest"])
                    rows.append({"n_words": n, "longest": longest, "spans": [{"begin": b, "end": e} for b, e in spans], "items": sorted(named)})
                kept = batch.columns[:at] + ([batch.column(at)] if carry else [])
                names = batch.schema.names[:at] + ([text_name] if carry else [])
                yield pa.RecordBatch.from_arrays([*kept, pa.array(rows, type=_ARROW_FOUND)], names=[*names, had])

        carried = f"`{text_name}` binary, " if carry else ""
        return frame.mapInArrow(run, f"{kinds}{', ' if kinds else ''}{carried}`{had}` {FOUND}")

    blocks = automata(items, item_key, item_text, window)
    block = next(blocks, None)
    while True:
        following = next(blocks, None)
        shared = None if block is None else spark.sparkContext.broadcast(block)
        passing = pass_by(passing, shared, carry=following is not None)
        if following is None:
            return passing.withColumnRenamed(had, found)
        passing, block = cut_lineage(passing), following


_ARROW_FOUND = pa.struct([
    ("n_words", pa.int64()), ("longest", pa.int64()),
    ("spans", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))), ("items", pa.list_(pa.string())),
])

_RUN = re.compile(rb"[^ ]+")


def without_spans(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    """A text without the given stretches of words; what stands between words stays outside of them."""
    if not spans:
        return data
    places = [m.span() for m in _RUN.finditer(data.translate(_COUNTS))]
    out, at = [], 0
    for begin, end in spans:
        out.append(data[at : places[begin][0]])
        at = places[end - 1][1]
    return b"".join([*out, data[at:]])


def clean(found: DataFrame, text: str = "text", least_words: int = WINDOW, most_share: float = 0.5, column: str = "found") -> DataFrame:
    """The documents of ``find`` (with the text kept) without what they share with the items.

    Documents of whose words more than ``most_share`` lie in spans of at least ``least_words`` words go;
    from the others those spans are removed. Shorter spans stay. The column ``found`` is left out.
    """
    long = F.filter(F.col(f"{column}.spans"), lambda s: s["end"] - s["begin"] >= least_words)
    hit = F.aggregate(long, F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["begin"])
    kept = found.where(hit <= most_share * F.col(f"{column}.n_words")).withColumn(column, long)
    names = [n for n in found.columns if n != column]
    kinds = ", ".join(f"`{n}` {found.schema[n].dataType.simpleString()}" for n in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(batch.schema.get_field_index(column)).to_pylist()
            texts = [
                body if not s else without_spans(body.encode(), [(x["begin"], x["end"]) for x in s]).decode()
                for body, s in zip(batch.column(batch.schema.get_field_index(text)).to_pylist(), spans, strict=True)
            ]
            columns = [pa.array(texts, pa.string()) if n == text else batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return kept.select(*names, column).mapInArrow(run, kinds)
