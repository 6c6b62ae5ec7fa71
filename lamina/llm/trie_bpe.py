"""BPE encoding over a trie of the distinct words, and decoding.

The encoding of a word is the encoding of one of its prefixes plus one token, so a prefix
needs one state only: the last token of its encoding. Distinct words in sorted order are a
trie in depth-first order: the path to a word shares with the one before it the states
of their common prefix, which are computed once. A token may follow another when no merge
would reach over the border between them.

Null texts are empty; an empty text has no ids and decodes to an empty text. Rows are
independent, repeated rows give repeated results, extra columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lamina.llm.common import slices, texts_of
from lamina.llm.units import (
    IDS,
    PIECES,
    UNITS,
    Remembered,
    Units,
    byte_alphabet,
    of_worker,
)

NEVER = 1 << 60
MOST_BORDERS = 1_000_000


class TrieBpe:
    """The merges and vocabulary of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.id_of: dict[str, int] = model["vocab"]
        ids = self.id_of
        self.made: dict[int, tuple[int, int, int]] = {}  # token: left, right, rank
        self.merges: dict[int, dict[int, int]] = {}  # left: right: rank
        for r, (a, b) in enumerate(pairs):
            left, right = ids[a], ids[b]
            self.made.setdefault(ids[a + b], (left, right, r))
            self.merges.setdefault(left, {})[right] = r
        self.longest = max(map(len, ids), default=1)
        self.borders: dict[int, bool] = {}
        self.ends: list[dict[int, tuple]] = [{}, {}]

    def at_end(self, token: int, side: int) -> tuple:
        """What stands at one end (0 left, 1 right) while ``token`` is built: for the right
        end what each may merge with, for the left end the token, and the rank of the merge
        that uses it up."""
        known = self.ends[side].get(token)
        if known is None:
            found, end, at = [], NEVER, token
            while True:
                part = self.merges.get(at) if side else at
                if part is not None:
                    found.append((part, end))
                if at not in self.made:
                    break
                end = self.made[at][2]
                at = self.made[at][side]
            known = self.ends[side][token] = tuple(found)
        return known

    def may_follow(self, left: int, right: int) -> bool:
        """Whether the encoding of both strings joined is these two tokens.

        It is unless some token at the end of ``left`` and one at the start of ``right``
        merge before either is used up; of equal merges the leftmost goes first.
        """
        starts = self.at_end(right, 0)
        for row, end_a in self.at_end(left, 1):
            for b, end_b in starts:
                rank = row.get(b)
                if rank is not None and rank < end_a and rank <= end_b:
                    return False
        return True

    def encode_words(self, words: set[str]) -> dict[str, list[int]]:
        """Ids of each word: a depth-first walk over the trie of ``words``."""
        out: dict[str, list[int]] = {}
        last: list[int] = [-1]  # last[i]: last token of the encoding of the first i symbols
        width: list[int] = [0]  # and how many symbols it covers
        before, id_of, known, may_follow = "", self.id_of, self.borders, self.may_follow
        if len(known) > MOST_BORDERS:
            known.clear()
        for word in sorted(words):
            shared = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                shared += 1
            del last[shared + 1 :], width[shared + 1 :]
            for i in range(shared + 1, len(word) + 1):
                for n in range(min(i, self.longest), 0, -1):
                    token = id_of.get(word[i - n : i])
                    if token is None:
                        continue
                    if n < i:
                        border = last[i - n] << 32 | token
                        fits = known.get(border)
                        if fits is None:
                            fits = known[border] = may_follow(last[i - n], token)
                        if not fits:
                            continue
                    last.append(token)
                    width.append(n)
                    break
                else:
                    raise ValueError(f"no token ends the prefix {word[:i]!r}")
            ids, i = [], len(word)
            while i:
                ids.append(last[i])
                i -= width[i]
            out[word] = ids[::-1]
            before = word
        return out


class Encoder:
    """Encodes batches of texts: unknown words of a batch go through one trie."""

    def __init__(self, path: str):
        self.units, self.trie = Units(path), TrieBpe(path)
        self.of_piece = Remembered(lambda p: self.packed({p})[p], PIECES)
        self.of_unit = Remembered(lambda key: self.make(self.units.literal(key)), UNITS)
        vocabulary = self.units.tokenizer.get_vocab(with_added_tokens=True)
        byte_of = {c: b for b, c in enumerate(byte_alphabet())}
        self.bytes_of = [b""] * (max(vocabulary.values()) + 1)
        self.digits = [str(i) for i in range(len(self.bytes_of))]
        for token, i in vocabulary.items():
            known = all(c in byte_of for c in token)
            self.bytes_of[i] = bytes(byte_of[c] for c in token) if known else token.encode()

    def packed(self, words: set[str]) -> dict[str, bytes]:
        found = self.trie.encode_words(words)
        return {word: array("I", ids).tobytes() for word, ids in found.items()}

    def make(self, literal: str) -> bytes:
        return b"".join(map(self.of_piece.__getitem__, self.units.pieces(literal)))

    def parts(self, text: str):
        """The text as (special id or None, ordinary text) parts."""
        at = 0
        for m in self.units.found.finditer(text):
            yield None, text[at : m.start()]
            yield self.units.special[m.group()], ""
            at = m.end()
        yield None, text[at:]

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        cuts = [self.units.cut(t) for t in texts]
        keys = {k for c in cuts if c for k in c[1]}
        seen = self.of_unit
        new = [k for k in keys if k not in seen and k not in seen.older]
        pieces = {k: self.units.pieces(self.units.literal(k)) for k in new}
        known = self.of_piece
        words = {p for ps in pieces.values() for p in ps if p not in known}
        found = self.packed(words)
        own = {k: b"".join([found.get(p) or known[p] for p in ps]) for k, ps in pieces.items()}
        for store, more in ((known, found), (seen, own)):
            for k, v in more.items():
                if len(k) <= 64:
                    store.keep(k, v)
        own |= {k: seen[k] for k in keys.difference(own)}
        out = []
        for text, cut in zip(texts, cuts):
            if cut is None:
                out.append(
                    b"".join(
                        self.make(part) if special is None else IDS.type(special).tobytes()
                        for special, part in self.parts(text)
                    )
                )
            else:
                out.append(self.make(cut[0]) + b"".join(map(own.__getitem__, cut[1])))
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", errors="replace")


def encode_texts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (little-endian 32-bit), decoded text for every row."""

    def run(batches):
        encoder = of_worker(Encoder, path)
        for batch in slices(batches, 500):
            ids = encoder.encode_batch(batch.column("text").to_pylist())
            decoded = [encoder.decode(np.frombuffer(i, IDS).tolist()) for i in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.binary()), pa.array(decoded)],
                names=["doc_id", "ids", "decoded"],
            )

    return texts_of(docs).mapInArrow(run, "doc_id long, ids binary, decoded string")


def round_trip_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, digests of the ids and of the decoded text, made where the ids are."""

    def sha(data: bytes) -> str:
        return hashlib.sha256(data).hexdigest()

    def run(batches):
        encoder = of_worker(Encoder, path)
        for batch in slices(batches, 500):
            n, of_ids, of_text = [], [], []
            for encoded in encoder.encode_batch(batch.column("text").to_pylist()):
                ids = np.frombuffer(encoded, IDS).tolist()
                n.append(len(ids))
                of_ids.append(sha(",".join(map(encoder.digits.__getitem__, ids)).encode()))
                of_text.append(sha(encoder.decode(ids).encode()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(of_ids), pa.array(of_text)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return texts_of(docs).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
