"""Language identification by cross-parsing entropy.

For each language a suffix automaton holds labelled running text. A text is parsed against it into
phrases, each the longest match in the labelled text from where the last one ended. The language that
needs fewest phrases, times the bits to point into its text, wins: the cross entropy of Ziv and Merhav.

Automata go to the executors as arrays: per state a bit set of the symbols that lead on, and the next
states in the order of these symbols. Texts are cut into stretches of ``STRETCH`` symbols, and all
stretches of a batch are parsed side by side, one symbol of each at a time. A stretch begins a new
phrase, which adds the same to every language.
"""

from __future__ import annotations

import math
import sys
from collections import Counter
from collections.abc import Iterator
from itertools import groupby
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimloom.llm.common import free_names
from claimloom.session import cut_lineage

# Bounds of the labelled sample of one language: documents, and normalised characters.
SAMPLE_DOCS = 400
SAMPLE_CHARS = 150_000

UNKNOWN = "und"

# Symbols of the automata: the most frequent characters of the labelled texts; the rarer ones share the last.
SYMBOLS = 255

# Languages of one model: its arrays, of at most some 10 MB a language, are broadcast.
MOST_LANGUAGES = 256

# Symbols of a text that are parsed in a row, and characters of a text that are turned into symbols at once.
STRETCH = 256
CHARS_AT_ONCE = 1 << 20

_CHARS = 1 << 21  # more than there are code points


def suffix_automaton(words: list[str]) -> dict[int, int]:
    """Transitions of the suffix automaton of all words: state * 2^21 + character -> state; state 0 is the start.

    A state stands for the substrings that end at the same places. Words are added one after the
    other from the start state, so a substring of any word can be walked.
    """
    step: list[dict[str, int]] = [{}]
    link, longest = [-1], [0]

    def split(parent: int, child: int, char: str) -> int:
        """A state of its own for the shorter substrings of ``child`` that come by ``parent``."""
        clone = len(step)
        step.append(dict(step[child]))
        link.append(link[child])
        longest.append(longest[parent] + 1)
        link[child] = clone
        while parent >= 0 and step[parent].get(char) == child:
            step[parent][char] = clone
            parent = link[parent]
        return clone

    for word in words:
        last = 0
        for char in word:
            known = step[last].get(char)
            if known is not None:
                last = known if longest[known] == longest[last] + 1 else split(last, known, char)
                continue
            state = len(step)
            step.append({})
            longest.append(longest[last] + 1)
            link.append(0)
            at = last
            while at >= 0 and char not in step[at]:
                step[at][char] = state
                at = link[at]
            if at >= 0:
                target = step[at][char]
                link[state] = target if longest[target] == longest[at] + 1 else split(at, target, char)
            last = state
    return {state * _CHARS + ord(c): to for state, edges in enumerate(step) for c, to in edges.items()}


def phrases(automaton: dict[int, int], word: str) -> int:
    """Longest-match phrases that a word needs; an unseen character is a phrase of its own."""
    state, count = 0, 0
    for char in word:
        code = ord(char)
        to = automaton.get(state * _CHARS + code)
        if to is None and state:
            count += 1
            to = automaton.get(code)
        if to is None:
            count += 1
            to = 0
        state = to
    return count + (state > 0)


def normalised(text: str) -> str:
    """A lower-case text in which whatever is not a letter is a space, and spaces stand alone."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


def _sampled(rows: Iterator, chars: int, docs: int) -> str:
    """Up to ``chars`` characters of normalised texts, an equal share of each before more of any."""
    texts, share = [normalised(row.text) for row in rows], max(1, chars // docs)
    parts, size = [], 0
    for at in range(0, max(map(len, texts), default=0), share):
        for text in texts:
            part = text[at : at + share][: max(0, chars - size)]
            parts.append(part)
            size += len(part)
        if size >= chars:
            break
    return "".join(parts)


class Parser:
    """An automaton over symbols 0, 1, ..., laid out for many walks at once."""

    def __init__(self, automaton: dict[int, int], symbols: int, bits: float):
        self.bits = bits
        self.words = symbols // 64 + 1  # 64-bit words of a bit set; symbol number ``symbols`` leads nowhere
        keys = np.fromiter(automaton.keys(), dtype=np.int64, count=len(automaton))
        order = np.argsort(keys)
        self.targets = np.fromiter(automaton.values(), dtype=np.int32, count=len(automaton))[order]
        state, symbol = np.divmod(keys[order], _CHARS)
        place = state * self.words + (symbol >> 6)
        sets = (int(max(state.max(initial=0), self.targets.max(initial=0))) + 1) * self.words
        self.follow = np.zeros(sets, dtype=np.uint64)
        np.bitwise_or.at(self.follow, place, np.uint64(1) << (symbol & 63).astype(np.uint64))
        counts = np.bincount(place, minlength=sets)
        self.first = (np.cumsum(counts) - counts).astype(np.int32)
        self.root = np.zeros(symbols + 1, dtype=np.int32)
        top = state == 0
        self.root[symbol[top]] = self.targets[top]

    def phrases(self, stretches: np.ndarray, active: list[int]) -> np.ndarray:
        """Phrases of every stretch: columns of ``stretches``, longest first, of which ``active[t]`` are longer than t."""
        state = np.zeros(stretches.shape[1], dtype=np.int64)
        count = np.zeros(stretches.shape[1], dtype=np.int64)
        one, last = np.uint64(1), max(0, len(self.targets) - 1)
        for t, many in enumerate(active):
            symbol = stretches[t, :many]
            now = state[:many]
            place = now * self.words + (symbol >> 6)
            bit = (symbol & 63).astype(np.uint64)
            follow = self.follow[place]
            hit = ((follow >> bit) & one).astype(bool)
            below = np.bitwise_count(follow & ((one << bit) - one))
            missed = ~hit
            fresh = self.root[symbol]
            count[:many] += (missed & (now > 0)) + (missed & (fresh == 0)).astype(np.int64)
            state[:many] = np.where(hit, self.targets[np.minimum(self.first[place] + below, last)], fresh) if len(self.targets) else fresh
        return count + (state > 0)


def learn(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", docs: int = SAMPLE_DOCS, chars: int = SAMPLE_CHARS) -> dict:
    """``{"symbols": {character: symbol}, "parsers": {language: parser}}`` from a bounded sample of labelled documents; empty without any.

    Per language: up to ``chars`` normalised characters of the ``docs`` documents of least id hash, equal
    shares of each first. Rows with null text or language are left out; more than ``MOST_LANGUAGES``
    languages raise.

    The texts that travel are those below the hash at which about twice the sample of their language is
    expected, and that is raised for a language whose sample is not full.
    """
    named = labelled.select(F.col(key).cast("string").alias("k"), F.left(F.col(text), F.lit(chars)).alias("text"), F.col(lang).cast("string").alias("lang"))
    known = {r.lang: r["count"] for r in named.where("text is not null and lang is not null").groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()}
    if len(known) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    share = {name: min(1.0, 2 * docs / count) for name, count in known.items()}
    order = Window.partitionBy("lang").orderBy(F.xxhash64("k"), F.col("k"), F.col("text"))
    while known:
        most = {name: min(int(part * 2.0**64) - (1 << 63), (1 << 63) - 1) for name, part in share.items()}
        limits = F.create_map(*[F.lit(part) for pair in most.items() for part in pair])
        near = named.where(F.col("text").isNotNull() & (F.xxhash64("k") <= limits[F.col("lang")]))
        chosen = cut_lineage(near.withColumn("n", F.row_number().over(order)).where(F.col("n") <= docs).select("lang", "n", "text"))
        full = {r.lang: r["count"] for r in chosen.groupBy("lang").count().collect()}
        short = [name for name, count in known.items() if share[name] < 1.0 and full.get(name, 0) < min(docs, count)]
        if not short:
            break
        share.update({name: min(1.0, 4 * share[name]) for name in short})
    if not known:
        return {}
    running = {}
    for name, rows in groupby(chosen.orderBy("lang", "n").toLocalIterator(), key=lambda row: row.lang):
        running[name] = _sampled(rows, chars, docs)
    running = {name: body for name, body in running.items() if body}
    ranked = sorted(sum((Counter(body) for body in running.values()), Counter()).items(), key=lambda pair: (-pair[1], pair[0]))
    symbols = {c: min(number, SYMBOLS - 1) for number, (c, _) in enumerate(ranked)}
    many = min(len(ranked), SYMBOLS)
    parsers = {}
    for name, body in sorted(running.items()):
        coded = "".join(chr(symbols[c]) for c in body)
        parsers[name] = Parser(suffix_automaton([coded]), many, math.log2(max(2, len(body))))
    return {"symbols": symbols, "parsers": parsers} if parsers else {}


class _Symbols:
    """Turns texts into symbols; what no labelled text has is the symbol ``unseen``."""

    def __init__(self, symbols: dict[str, int], unseen: int):
        self.space = symbols.get(" ", unseen)
        self.table = np.full(sys.maxunicode + 1, self.space, dtype=np.uint8)
        self.letter = np.zeros(sys.maxunicode + 1, dtype=bool)
        for code in range(sys.maxunicode + 1):
            if chr(code).isalpha():
                self.letter[code] = True
        self.table[self.letter] = unseen
        for char, symbol in symbols.items():
            self.table[ord(char)] = symbol

    def of(self, text: str) -> tuple[np.ndarray, int]:
        """The symbols of a text, white space and the like drawn together, and the number of its letters."""
        parts, letters = [], 0
        for at in range(0, len(text), CHARS_AT_ONCE):
            codes = np.frombuffer(text[at : at + CHARS_AT_ONCE].lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
            letter = self.letter[codes]
            letters += int(letter.sum())
            parts.append(self.table[codes][letter | np.concatenate(([True], letter[:-1]))])
        return (np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint8)), letters


def _stretches(texts: list[np.ndarray]) -> tuple[np.ndarray, list[int], np.ndarray]:
    """Stretches of all texts as columns, longest first, how many are longer than t, and the text of each."""
    many = np.array([-(-len(t) // STRETCH) for t in texts])
    rows = np.zeros((int(many.sum()), STRETCH), dtype=np.uint8)
    flat, at = rows.reshape(-1), 0
    lengths = np.full(len(rows), STRETCH, dtype=np.int64)
    for text, n in zip(texts, many.tolist(), strict=True):
        flat[at * STRETCH : at * STRETCH + len(text)] = text
        at += n
        if n:
            lengths[at - 1] = len(text) - (n - 1) * STRETCH
    order = np.argsort(-lengths, kind="stable")
    longer = len(lengths) - np.searchsorted(np.sort(lengths), np.arange(STRETCH), side="right")
    return np.ascontiguousarray(rows[order].T).astype(np.int64), [n for n in longer.tolist() if n], np.repeat(np.arange(len(texts)), many)[order]


_READY: dict[str, _Symbols] = {}


def identify(docs: DataFrame, model: dict, key: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns (default: the key) with ``lang_pred`` and ``score``.

    ``score``: the second-best language's cost over that cost plus the best one's, from 0.5 (no
    evidence) to 1. A null text, one without a letter, or an empty model gives ``und`` and 0. Ties go to
    the language first by name. The kept columns must not be named ``lang_pred`` or ``score``. An empty
    table gives no rows.
    """
    spark = docs.sparkSession
    names = sorted(model.get("parsers", {}))
    shared = spark.sparkContext.broadcast((model.get("symbols", {}), [model["parsers"][n] for n in names]))
    columns = [key] if keep is None else keep
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*columns).schema)
    token = uuid4().hex
    chosen = docs.select(*columns, F.col(text).cast("string").alias(free_names(docs, "body")[0]))
    at = len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, parsers = shared.value
        if token not in _READY:
            _READY.clear()
            _READY[token] = _Symbols(symbols, max(symbols.values(), default=-1) + 1)
        turned = _READY[token]
        for batch in batches:
            coded = [turned.of(body or "") for body in batch.column(at).to_pylist()]
            letters = np.array([n for _, n in coded])
            stretches, active, of_text = _stretches([codes for codes, _ in coded])
            predicted, scores = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            if names:
                cost = np.stack([p.bits * np.bincount(of_text, p.phrases(stretches, active), batch.num_rows) for p in parsers], axis=1)
                best = cost.argmin(axis=1)
                ranked = np.sort(cost, axis=1)
                second = ranked[:, 1] if len(names) > 1 else 2 * ranked[:, 0]
                predicted = [names[b] if n else UNKNOWN for b, n in zip(best, letters, strict=True)]
                scores = np.where(letters > 0, second / np.maximum(second + ranked[:, 0], 1e-9), 0.0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:at], pa.array(predicted, pa.string()), pa.array(scores)], names=[*batch.schema.names[:at], "lang_pred", "score"]
            )

    return chosen.mapInArrow(run, f"{fields}, lang_pred string, score double")
