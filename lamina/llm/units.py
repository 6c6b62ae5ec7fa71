"""Whole texts to token ids through caches of what their words encode to.

A text is cut where no pre-token of the tokenizer can span the cut; the pieces between
("units", nearly always a word with the space before it) encode alone to what they encode
to in the text, so each is encoded once per worker and then looked up. Batches of texts are
cut by Arrow, and a unit is looked up once a batch.
"""

from __future__ import annotations

import ctypes
import gc
import json
import os
import re
from array import array
from codecs import charmap_decode
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: White space that a pre-token may join over a cut: a text that has it is encoded whole.
JOINED = re.compile(r"\s\s\s|\s\s\Z")
#: The same for Arrow's expressions, whose own white space is ASCII alone.
SPACE = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in map(chr, range(0x110000)) if c.isspace()) + "]"
JOINED_IN_ARROW = rf"{SPACE}{{3}}|{SPACE}{{2}}\z"
UNITS, PIECES = 1_200_000, 500_000
#: Bytes of text that are cut at once.
AT_ONCE = 8 << 20
#: ASCII marks, of which any number in a row are one pre-token: no space, letter or digit.
MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())
#: Fixed value: the pattern byte-level BPE cuts texts by.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
IDS = np.dtype("<u4")


def byte_alphabet() -> list[str]:
    """The character byte-level BPE writes for each byte.

    Fixed values: printable Latin-1 bytes are themselves, the other bytes, in order, are
    the characters from U+0100 on.
    """
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Remembered(dict):
    """A cache of two generations: beyond ``limit`` the older half is forgotten."""

    def __init__(self, make: Callable, limit: int):
        super().__init__()
        self.make, self.limit, self.older = make, limit, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= 64:  # long keys hardly come again and would fill the cache
            self.keep(key, value)
        return value

    def keep(self, key, value) -> None:
        if len(self) >= self.limit // 2:
            self.older = dict(self)
            self.clear()
        self[key] = value


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


class Units:
    """Cuts texts into units for one tokenizer.

    ``dropped``: the tokenizer drops white space, so units need no space before them.
    Otherwise it keeps a space with the word after it (byte-level pre-tokens), and units
    start at single spaces and line ends.
    """

    def __init__(self, path: str, dropped: bool = False):
        self.tokenizer, self.dropped = load_tokenizer(path), dropped
        added = self.tokenizer.get_added_tokens_decoder().items()
        self.special = {token.content: i for i, token in added}
        self.found = re.compile("|".join(map(re.escape, self.special)) or r"(?!)")
        self.alphabet = "".join(byte_alphabet())
        self.lead = "" if dropped else self.alphabet[32]
        with open(path, encoding="utf-8") as f:
            steps = json.load(f)
        before = steps["pre_tokenizer"]
        self.lower, self.pattern = steps["normalizer"] is not None, None
        if before["type"] == "ByteLevel" and before["use_regex"] and not self.lower:
            self.pattern = regex.compile(BYTE_LEVEL)
        elif dropped:
            self.pattern = regex.compile(before["pretokenizers"][0]["pattern"]["Regex"])

    def uncut(self, text: str) -> bool:
        """Whether the text has to be encoded whole."""
        return bool(self.found.search(text) or not self.dropped and JOINED.search(text))

    def uncut_of(self, column: pa.Array) -> np.ndarray:
        """:meth:`uncut` of each text of ``column``."""
        out = np.zeros(len(column), bool)
        for special in self.special:
            out |= pc.match_substring(column, special).to_numpy(zero_copy_only=False)
        if not self.dropped:
            out |= pc.match_substring_regex(column, JOINED_IN_ARROW).to_numpy(zero_copy_only=False)
        return out

    def cut(self, text: str) -> tuple[str, list[str]] | None:
        """The literal first part and the keys of the units after it; None: not to be cut."""
        if self.uncut(text):
            return None
        if self.dropped:
            return "", text.replace("\n", " ").split(" ")
        first, *rest = text.replace("\n", " \n").split(" ")
        return first, rest

    def literal(self, key: str) -> str:
        """The text a unit's key stands for."""
        return key if self.dropped or key[:1] == "\n" else " " + key

    def pieces(self, literal: str) -> list[str]:
        """Its pre-tokens, in the alphabet of the model's vocabulary.

        Within Latin-1 the file's own pattern is applied here, which is several times
        faster; beyond it the library's character classes decide.
        """
        if self.pattern is not None and (literal.isascii() or max(literal) < "\u0100"):
            if self.lower:
                literal = literal.lower()
            word = literal.rstrip(MARKS)
            line = not self.dropped and word[:1] == "\n"
            spaced = not self.dropped and word[:1] == " "
            if (word[1:] if spaced or line else word).isalpha():
                found = [word[0], word[1:]] if line else [word]
                if len(word) < len(literal):
                    found.append(literal[len(word) :])
            else:
                found = self.pattern.findall(literal)
            return [self.written(p) for p in found]
        normalizer = self.tokenizer.normalizer
        if normalizer is not None:
            literal = normalizer.normalize_str(literal)
        return [piece for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(literal)]

    def pieces_of_unit(self, key: str) -> list[str]:
        """``pieces(literal(key))``; at once for most units, ASCII letters and marks after them."""
        word = key.rstrip(MARKS)
        if self.pattern is None or not (word.isascii() and word.isalpha()):
            return self.pieces(self.literal(key))
        marks = key[len(word) :]
        word = self.lead + (word.lower() if self.lower else word)
        return [word, marks] if marks else [word]

    def written(self, piece: str) -> str:
        """A Latin-1 pre-token in the alphabet of the model's vocabulary."""
        return charmap_decode(piece.encode(), "strict", self.alphabet)[0]

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids


class IdEncoder:
    """Texts to little-endian ids as bytes, as the library's encode gives them."""

    def __init__(self, path: str, dropped: bool = False):
        self.units = Units(path, dropped)
        self.tokenize = self.units.tokenizer.model.tokenize
        self.of_piece = Remembered(self.piece, PIECES // 5)
        self.of_unit = Remembered(self.unit, UNITS + PIECES // 5 * 4)

    def unit(self, key: str) -> bytes:
        """What a unit encodes to. A word without marks is one piece and is kept as a unit alone."""
        units = self.units
        word = key.rstrip(MARKS)
        if units.pattern is None or not word.isalpha() or not (word.isascii() or max(word) < "\u0100"):
            return b"".join(map(self.of_piece.__getitem__, units.pieces_of_unit(key)))
        lower = word.lower() if units.lower else word
        if len(word) < len(key):
            return self.of_unit[lower] + self.of_piece[key[len(word) :]]
        if lower != word:
            return self.of_unit[lower]
        return self.piece(units.lead + (word if word.isascii() else units.written(word)))

    def piece(self, piece: str) -> bytes:
        return array("I", [t.id for t in self.tokenize(piece)]).tobytes()

    def literal(self, text: str) -> bytes:
        return b"".join(map(self.of_piece.__getitem__, self.units.pieces(text)))

    def encode(self, text: str) -> bytes:
        cut = self.units.cut(text)
        if cut is None:
            return array("I", self.units.whole(text)).tobytes()
        return self.literal(cut[0]) + b"".join(map(self.of_unit.__getitem__, cut[1]))

    def encode_all(self, column: pa.Array) -> list[np.ndarray]:
        """The ids of each text of ``column`` (no nulls), as :meth:`encode` gives them."""
        if not len(column):
            return []
        dropped, texts, column = self.units.dropped, column, column.cast(pa.string())
        uncut = self.units.uncut_of(column)
        column = pc.if_else(pa.array(uncut), "", column)
        # Every text is at least one part, if an empty one.
        parts = pc.split_pattern(pc.replace_substring(column, "\n", " " if dropped else " \n"), " ")
        units, offsets = parts.flatten(), parts.offsets.to_numpy()
        coded = units.dictionary_encode()
        each = pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary)
        keys = pc.binary_join(each, " ")[0].as_py().split(" ")  # no unit has a space
        values, place = list(map(self.of_unit.__getitem__, keys)), coded.indices.to_numpy().copy()
        own = np.flatnonzero(uncut) if dropped else np.arange(len(texts))
        first = units.take(pa.array(offsets[own])).to_pylist()
        place[offsets[own]] = len(values) + np.arange(len(own))
        for row, part in zip(own.tolist(), first):
            if uncut[row]:
                values.append(array("I", self.units.whole(texts[row].as_py())).tobytes())
            else:
                values.append(self.literal(part))
        found = pa.array(values, pa.large_binary()).take(pa.array(place))
        _, ends, data = found.buffers()
        ends = np.frombuffer(ends, np.int64, len(found) + 1)[offsets] // IDS.itemsize
        ids = np.frombuffer(data or b"", IDS, int(ends[-1]))
        return [ids[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


_KEPT: dict = {}


def of_worker(kind: Callable, *args):
    """One object per Python worker; workers are reused, so caches stay warm. What another
    operator kept goes first, so a job of several stages holds the caches of one."""
    key = (kind, *args)
    if key not in _KEPT:
        give_back()
        _KEPT[key] = kind(*args)
    return _KEPT[key]


def give_back() -> None:
    """Let go of what this worker keeps, and of memory that is free but held."""
    if _KEPT:
        _KEPT.clear()
        gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # of the C library on Linux only
        trim(0)
