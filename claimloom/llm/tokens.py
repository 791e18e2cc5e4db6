"""Token ids of whole texts by a public tokenizer, frequent words encoded few times.

A text is cut only where the tokenizer's own pre-tokenization has a boundary, so joining the ids of
the pieces gives the ids of the whole text. Words repeat; one that comes again is
kept with its ids. A plain Latin word goes straight to the library's merge model, without normalizer and pattern.
"""

from __future__ import annotations

import codecs
import json
import re
import sys
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

# Bytes of pieces and their ids kept for one tokenizer in one worker. Once they are full, nothing more is kept
# until ``PATIENCE`` pieces were missing; then the memory starts anew, as the text has changed.
# Longer pieces, which seldom come again, are not kept.
KEPT_BYTES = 48 << 20
KEPT_PIECE = 100
PATIENCE = 1 << 20

# How often a piece was encoded before it is kept: words that come once would take most of the memory. A word with
# punctuation is soon joined from its parts, so it must come oftener to be worth a place.
_COME_AGAIN = 1
_JOINED_AGAIN = 3

# Places that count how often pieces were missing, by hash; some share one.
_PLACES = 1 << 20

# What an entry takes besides its characters and ids: two objects and a place in the table.
_ENTRY = 200

# ASCII punctuation without the apostrophe, which contractions begin with.
_PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
# Letters below this one have a single lower-case form and need no composition.
_LATIN_END = "ɐ"
_DOTTED_I = "İ"
_FOREIGN = re.compile(f"[{_LATIN_END}-\U0010FFFF{_DOTTED_I}]")
_TWO_SPACES = re.compile(r"\s\s")
# The same for Arrow, whose \s knows ASCII alone.
_TWO_SPACES_ARROW = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]{2}"
# Words that are plain: Latin letters below ``_LATIN_END`` but ``_DOTTED_I``.
_PLAIN_ARROW = r"^[A-Za-zÀ-ÖØ-öø-įı-ɏ]+$"
_INNER_SPACE = re.compile(r"(?<=\S) (?=\S)")


def _byte_letters() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in printable}
    for extra, b in enumerate(b for b in range(256) if b not in letters):
        letters[b] = chr(256 + extra)
    return [letters[b] for b in range(256)]


def _bytes(ids: list[int]) -> bytes:
    found = array("I", ids)
    if sys.byteorder == "big":
        found.byteswap()
    return found.tobytes()


def _sizes(found: list[bytes]) -> np.ndarray:
    return np.fromiter(map(len, found), np.int64, len(found)) // 4


def _lined_up(ids: np.ndarray, ends: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the coded pieces one after the other, and where each piece's end, given where those of every code end."""
    sizes = np.diff(ends, prepend=0)
    taken = sizes[codes]
    after = np.cumsum(taken)
    at = np.repeat(ends[codes] - after, taken)
    at += np.arange(len(at))
    return ids[at], after


def _plain(word: str) -> bool:
    """Whether a word is of Latin letters alone, which no normalizer composes."""
    return word.isalpha() and (word.isascii() or not _FOREIGN.search(word))


class _Known(dict):
    """Ids of pieces as little-endian unsigned 32-bit bytes; a missing piece is encoded on demand."""

    def __init__(self, encode, kept: int):
        super().__init__()
        self.encode, self.kept = encode, kept
        self._begin()

    def _begin(self) -> None:
        self.clear()
        self.bytes = self.refused = 0
        self.missed = bytearray(_PLACES)

    def __missing__(self, piece: str) -> bytes:
        found = self.encode(piece)
        if self.bytes >= self.kept:
            self.refused += 1
            if self.refused >= PATIENCE:
                self._begin()
            return found
        if len(piece) > KEPT_PIECE:
            return found
        place = hash(piece) % _PLACES
        times = self.missed[place]
        if times < (_JOINED_AGAIN if piece[-1:] in _PUNCTUATION else _COME_AGAIN):
            self.missed[place] = times + 1
        else:
            self[piece] = found
            self.bytes += _ENTRY + len(piece) + len(found)
        return found


class Encoder:
    """``encode(text)``: the ids of a whole text, as the library gives them without special tokens."""

    def __init__(self, path: str, kept: int | None = None):
        kept = kept or KEPT_BYTES
        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.letters = _byte_letters()
        self.table = "".join(self.letters)
        with open(path, encoding="utf-8") as file:
            layout = json.load(file)
        normalizer, splitter = layout.get("normalizer"), layout.get("pre_tokenizer") or {}
        steps = [s["type"] for s in (normalizer or {}).get("normalizers", [])]
        parts = [s["type"] for s in splitter.get("pretokenizers", [])]
        if layout["model"]["type"] != "BPE":
            self.encode = self._whole
        elif normalizer is None and splitter.get("type") == "ByteLevel" and splitter.get("use_regex") and not splitter.get("add_prefix_space"):
            self.plain, self.spaced = _Known(self._plain_word, kept), _Known(self._spaced_word, kept)
            self.encode = self._by_spaced_words
        elif steps == ["NFC", "Replace", "Lowercase"] and parts == ["Split", "ByteLevel"]:
            self.words = _Known(self._lower_word, kept)
            self.encode = self._by_words
        else:
            self.encode = self._whole

    def _whole(self, text: str) -> bytes:
        return _bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _merged(self, word: str, lead: str = "") -> bytes:
        mapped = word if word.isascii() else codecs.charmap_decode(word.encode(), "strict", self.table)[0]
        return _bytes([t.id for t in self.merge(lead + mapped)])

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """``encode`` of every text, none null; byte-level words of all texts are looked up once each."""
        if self.encode != self._by_spaced_words:
            return [self.encode(text) for text in texts.to_pylist()]
        loose = pc.match_substring_regex(texts, _TWO_SPACES_ARROW)
        apart = iter(self.encode(text) for text in texts.filter(loose).to_pylist())
        close = iter(self._by_distinct_words(texts.filter(pc.invert(loose))))
        return [next(apart if each else close) for each in loose.to_pylist()]

    # white space dropped, lower case

    def _lower_word(self, piece: str) -> bytes:
        word = piece.rstrip(_PUNCTUATION)
        if not _plain(word) or _DOTTED_I in word:
            return self._whole(piece)
        lower = word.lower()
        if lower == piece:
            return self._merged(piece)
        return self.words[lower] + (self.words[piece[len(word):]] if len(word) < len(piece) else b"")

    def _by_words(self, text: str) -> bytes:
        if "<|" not in text and (text.isascii() or not _FOREIGN.search(text)):
            text = text.lower()
        return b"".join(map(self.words.__getitem__, text.replace("\n", " ").split(" ")))

    # byte level, a word taking the space before it

    def _plain_word(self, piece: str) -> bytes:
        word = piece.rstrip(_PUNCTUATION)
        if not _plain(word):
            return self._whole(piece)
        return self._merged(word) if word == piece else self.plain[word] + self.plain[piece[len(word):]]

    def _spaced_word(self, piece: str) -> bytes:
        if piece[:1] == "\n":
            return self.plain["\n"] + self.plain[piece[1:]]
        word = piece.rstrip(_PUNCTUATION)
        if not _plain(word):
            return self._whole(" " + piece)
        return self._merged(word, self.letters[32]) if word == piece else self.spaced[word] + self.plain[piece[len(word):]]

    def _by_spaced_words(self, text: str) -> bytes:
        spaced = self.spaced.__getitem__
        if _TWO_SPACES.search(text):
            first, *rest = _INNER_SPACE.split(text)
            return self.plain[first] + b"".join(map(spaced, rest))
        # a word after a line break carries the break instead of a space
        first, *rest = text.replace("\n", " \n").split(" ")
        return self._start(first) + b"".join(map(spaced, rest))

    def _by_distinct_words(self, texts: pa.Array) -> list[bytes]:
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        words, bounds = split.flatten(), np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy())])
        coded, starts = words.dictionary_encode(), bounds[:-1]
        ids, ends = self._distinct_ids(coded.dictionary)
        # a text's first word has no space before it
        firsts = list(map(self._start, words.take(pa.array(starts)).to_numpy(zero_copy_only=False)))
        ends = np.concatenate([ends, (ends[-1:].sum() + np.cumsum(_sizes(firsts)))])
        codes = coded.indices.to_numpy().copy()
        codes[starts] = len(coded.dictionary) + np.arange(len(starts))
        found, ends = _lined_up(np.concatenate([ids, np.frombuffer(b"".join(firsts), "<u4")]), ends, codes)
        found, cuts = found.tobytes(), [0, *(4 * ends[bounds[1:] - 1]).tolist()]
        return [found[a:b] for a, b in zip(cuts, cuts[1:])]

    def _distinct_ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that take a space, and where each word's end; plain words and punctuation after them are looked up apart."""
        stems = pc.utf8_rtrim(words, _PUNCTUATION)
        cut = pc.and_(pc.less(pc.binary_length(stems), pc.binary_length(words)), pc.match_substring_regex(stems, _PLAIN_ARROW))
        heads = pc.if_else(cut, stems, words).dictionary_encode()
        known = list(map(self.spaced.__getitem__, heads.dictionary.to_numpy(zero_copy_only=False)))
        tails: dict[str, int] = {}
        with_tail = zip(words.filter(cut).to_numpy(zero_copy_only=False), pc.utf8_length(stems.filter(cut)).to_pylist(), strict=True)
        tail_codes = [tails.setdefault(word[n:], len(known) + len(tails)) for word, n in with_tail]
        known += [self.plain[tail] for tail in tails]
        pairs = np.full((len(words), 2), len(known), dtype=np.int32)  # the last one is empty
        pairs[:, 0] = heads.indices.to_numpy()
        pairs[cut.to_numpy(zero_copy_only=False), 1] = tail_codes
        ids, ends = _lined_up(np.frombuffer(b"".join(known), "<u4"), np.cumsum(_sizes([*known, b""])), pairs.reshape(-1))
        return ids, ends[1::2]

    def _start(self, piece: str) -> bytes:
        return self.spaced[piece] if piece[:1] == "\n" else self.plain[piece]


_ENCODERS: dict[tuple[str, int | None], Encoder] = {}


def encoder(path: str, kept: int | None = None) -> Encoder:
    """The encoder of a vocabulary file, with so many kept bytes, made once per worker."""
    if (path, kept) not in _ENCODERS:
        _ENCODERS[path, kept] = Encoder(path, kept)
    return _ENCODERS[path, kept]
