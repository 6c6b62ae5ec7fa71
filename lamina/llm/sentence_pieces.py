"""Encoding and decoding with merge-type sentencepiece models.

A text's characters are symbols; an agenda holds every pair of neighbours whose join is in the
vocabulary, best score first, of equal scores the leftmost. The head is joined until the agenda
is empty; a symbol the vocabulary lacks becomes its bytes. The agenda of a word is a list of its
pairs' scores in text order, that of a longer unit a heap. No piece reaches over a run of spaces
from the left, nor over a line end, so texts are cut there and each distinct unit goes through the
agenda once per worker. In each Arrow batch what the agenda made for new units is checked against the library,
ids and decoded text; where they differ the library's ids are used, and ``n_corrected`` counts such
units, so a difference is seen and changes no result.

Null texts are empty; an empty text has no ids and decodes to an empty text. A text of any length is
encoded whole. Rows are independent: repeated rows give repeated results, extra columns are not read
whatever their names, an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from heapq import heapify, heappop, heappush
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lamina.llm.common import slices, texts_of
from lamina.llm.units import IDS, Remembered, of_worker

#: How the library writes a space inside pieces, and an id it cannot spell.
SPACE = "▁"
UNKNOWN = " ⁇ "
UNIT = re.compile(r" +[^ \n]*|\n[^ \n]*")
MOST_UNITS = 800_000
#: Units of up to this many symbols have their agenda scanned, longer ones kept as a heap.
SCANNED = 48
NOT_JOINED = float("-inf")


class PieceBpe:
    """Vocabulary, agenda and decoding of one model file.

    The model must put a space before the text, leave characters and white space as they are,
    spell unknown characters as bytes, and have no piece with a space or line end after another
    character; others raise ValueError.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.library = library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.score: dict[str, float] = {}
        self.id_of: dict[str, int] = {}
        self.byte_id: dict[int, int] = {}
        self.bytes_of: list[bytes] = []
        for i in range(len(library)):
            piece = library.id_to_piece(i)
            spelled = piece.replace(SPACE, " ").encode()
            if library.is_byte(i):
                value = int(piece[3:-1], 16)
                self.byte_id[value], spelled = i, bytes([value])
            elif library.is_control(i):
                spelled = b""
            elif library.is_unknown(i):
                spelled = UNKNOWN.encode()
            else:
                self.score[piece], self.id_of[piece] = library.get_score(i), i
            self.bytes_of.append(spelled)
        self.byte_ids = frozenset(self.byte_id.values())
        if len(self.byte_id) != 256:
            raise ValueError(f"{path} does not spell unknown characters as bytes.")
        if library.normalize("ﬁ  A\t  ") != f"{SPACE}ﬁ{SPACE * 2}A\t {SPACE}":
            raise ValueError(f"{path} changes texts before it cuts them.")
        if any("\n" in p or SPACE in p.lstrip(SPACE) for p in self.score):
            raise ValueError(f"{path} has pieces that reach over a space or line end.")

    def encode(self, text: str) -> list[int]:
        """Ids of ``text``, its spaces written as in pieces, by the agenda."""
        symbols = self._scan(text) if len(text) <= SCANNED else self._heap(text)
        known = self.id_of
        try:
            return [known[s] for s in symbols]
        except KeyError:
            ids: list[int] = []
            for s in symbols:
                ids.extend([known[s]] if s in known else [self.byte_id[b] for b in s.encode()])
            return ids

    def _scan(self, text: str) -> list[str]:
        """The symbols left when the agenda, one score for each pair in text order, is empty."""
        of = self.score.get
        symbols = list(text)
        agenda = [of(a + b, NOT_JOINED) for a, b in pairwise(symbols)]
        while agenda and (best := max(agenda)) != NOT_JOINED:
            at = agenda.index(best)  # the leftmost of equal scores
            joined = symbols[at] = symbols[at] + symbols.pop(at + 1)
            del agenda[at]
            if at:
                agenda[at - 1] = of(symbols[at - 1] + joined, NOT_JOINED)
            if at < len(agenda):
                agenda[at] = of(joined + symbols[at + 1], NOT_JOINED)
        return symbols

    def _heap(self, text: str) -> list[str]:
        """The same for units of any length: the agenda is a heap of (score, left, right, size)."""
        score, symbols = self.score, list(text)
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = []
        for i in range(n - 1):
            found = score.get(symbols[i] + symbols[i + 1])
            if found is not None:
                agenda.append((-found, i, i + 1, 2))
        heapify(agenda)
        while agenda:
            _, left, right, size = heappop(agenda)
            joined = symbols[left] + symbols[right]
            # an end of the pair has been joined to something else since
            if not symbols[left] or not symbols[right] or len(joined) != size:
                continue
            symbols[left], symbols[right] = joined, ""
            follower = after[left] = after[right]
            if follower < n:
                before[follower] = left
                found = score.get(joined + symbols[follower])
                if found is not None:
                    heappush(agenda, (-found, left, follower, size + len(symbols[follower])))
            leader = before[left]
            if leader >= 0:
                found = score.get(symbols[leader] + joined)
                if found is not None:
                    heappush(agenda, (-found, leader, left, size + len(symbols[leader])))
        return [s for s in symbols if s]

    def spelled(self, ids: list[int]) -> str:
        """The text ``ids`` spell, the space before it included; a byte that is part of no
        character is U+FFFD."""
        data = b"".join(map(self.bytes_of.__getitem__, ids))
        try:
            return data.decode()
        except UnicodeDecodeError:
            return self._mended(ids)

    def _mended(self, ids: list[int]) -> str:
        out, at = [], 0
        while at < len(ids):
            end = at
            while end < len(ids) and ids[end] in self.byte_ids:
                end += 1
            run = b"".join(self.bytes_of[i] for i in ids[at:end])
            while run:
                for size in range(1, min(4, len(run)) + 1):
                    try:
                        out.append(run[:size].decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    size = 1
                run = run[size:]
            if end < len(ids):
                out.append(self.bytes_of[ids[end]].decode())
                end += 1
            at = end
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """The text ``ids`` spell, without the space the encoding put before it."""
        first = next((i for i in ids if self.bytes_of[i]), None)
        text = self.spelled(ids)
        return text[1:] if first in self._spaced() and text[:1] == " " else text

    def _spaced(self) -> set[int]:
        if not hasattr(self, "_with_space"):
            self._with_space = {i for p, i in self.id_of.items() if p.startswith(SPACE)}
        return self._with_space


class PieceEncoder:
    """Encodes batches of texts; the units new to a batch go through the agenda and the check."""

    def __init__(self, path: str):
        self.model = PieceBpe(path)
        self.known = Remembered(None, MOST_UNITS)  # asked by ``get`` and ``older`` only
        self.corrected: set[str] = set()

    @staticmethod
    def cut(text: str) -> list[str]:
        """Keys of a text's units, the space put before the text included.

        A key is its unit, but for the one space before a word, which is left out.
        """
        if not text:
            return []
        if SPACE in text:
            text = text.replace(SPACE, " ")
        if text[0] not in " \n" and text[-1] != " " and "  " not in text and " \n" not in text:
            return text.replace("\n", " \n").split(" ")
        units = UNIT.findall(" " + text)
        return [u[1:] if u[0] == " " and u[1:2] not in ("", " ") else u for u in units]

    @staticmethod
    def literal(key: str) -> str:
        return key if key[0] in " \n" else " " + key

    def by_library(self, literals: list[str]) -> list[list[int]]:
        """The library's ids of units, in one call.

        It puts a space before what it is given, unless that is nothing: a word brings its own,
        a line end none, and a space alone is read off behind a line end.
        """
        cut = [0 if u[0] == " " and len(u) > 1 else 2 if u == " " else 1 for u in literals]
        given = [(u[1:], u, "\n ")[n] for u, n in zip(literals, cut)]
        found = self.model.library.encode(given, num_threads=1)
        return [ids[n:] for ids, n in zip(found, cut)]

    def learn(self, keys: set[str]) -> dict[str, bytes]:
        """Ids of units not yet known, checked against the library."""
        model = self.model
        literals = [self.literal(k) for k in keys]
        own = [model.encode(u.replace(" ", SPACE)) for u in literals]
        theirs = self.by_library(literals)
        spelled = [model.spelled(ids) for ids in own]
        found = {}
        for key, unit, ids, right, text in zip(keys, literals, own, theirs, spelled):
            if ids != right or text != unit:
                self.corrected.add(key)
                ids = right
            found[key] = array("I", ids).tobytes()
        return found

    def encode_batch(self, texts: list[str]) -> tuple[list[bytes], list[int]]:
        """Little-endian ids of each text, and how many of its units the check corrected."""
        cuts = [self.cut(t) for t in texts]
        known, own = self.known, {}
        missing = set()
        for key in {k for keys in cuts for k in keys}:
            ids = known.get(key)
            if ids is None:
                ids = known.older.get(key)
                if ids is None:
                    missing.add(key)
                    continue
                known.keep(key, ids)
            own[key] = ids
        made = self.learn(missing) if missing else {}
        for key, ids in made.items():
            if len(key) <= 64:
                known.keep(key, ids)
        own |= made
        out = [b"".join(map(own.__getitem__, keys)) for keys in cuts]
        if not self.corrected:
            return out, [0] * len(out)
        return out, [sum(k in self.corrected for k in keys) for keys in cuts]


def encode_texts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (little-endian 32-bit), decoded text for every row."""

    def run(batches):
        encoder = of_worker(PieceEncoder, path)
        for batch in slices(batches, 500):
            encoded, _ = encoder.encode_batch(batch.column("text").to_pylist())
            decoded = [encoder.model.decode(np.frombuffer(e, IDS).tolist()) for e in encoded]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(encoded, pa.binary()), pa.array(decoded, pa.string())],
                names=["doc_id", "ids", "decoded"],
            )

    return texts_of(docs).mapInArrow(run, "doc_id long, ids binary, decoded string")


def round_trip_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, digests of the ids and of the decoded text, made where the ids are,
    and ``n_corrected``, the units of the text whose own ids differed from the library's."""

    def sha(data: bytes) -> str:
        return hashlib.sha256(data).hexdigest()

    def run(batches):
        encoder = of_worker(PieceEncoder, path)
        digits = [str(i) for i in range(len(encoder.model.bytes_of))]
        for batch in slices(batches, 500):
            encoded, corrected = encoder.encode_batch(batch.column("text").to_pylist())
            n, of_ids, of_text = [], [], []
            for packed in encoded:
                ids = np.frombuffer(packed, IDS).tolist()
                n.append(len(ids))
                of_ids.append(sha(",".join(map(digits.__getitem__, ids)).encode()))
                of_text.append(sha(encoder.model.decode(ids).encode()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n, pa.int64()),
                    pa.array(of_ids, pa.string()),
                    pa.array(of_text, pa.string()),
                    pa.array(corrected, pa.int64()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_corrected"],
            )

    return texts_of(docs).mapInArrow(
        run,
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_corrected long",
    )
