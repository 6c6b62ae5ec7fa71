"""Token counts, trie encoding and unit caches against the library itself."""

import random

import numpy as np
import pyarrow as pa
import pytest
from lamina.llm import token_counts, trie_bpe, units
from lamina.llm.common import tokenizer_path
from lamina.llm.units import IDS, IdEncoder, load_tokenizer

BYTE, WORD = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("word_bpe_49k.json")
PARTS = [
    "the", "New", "'s", "'ll", " ", "  ", "\n", "\n\n", "\t", " ", "é", "é", "Σ", "12",
    "$$", "<|endoftext|>", "<|startoftext|>", "日本", "😀", "\x85", "\x1c", "don't", "ªº", "aaaa",
]


def odd_texts(n=1500):
    draw = random.Random(7)
    made = ["".join(draw.choices(PARTS, k=draw.randint(0, 12))) for _ in range(n)]
    return ["", " ", "\n", "x" * 5000, " ".join(["word"] * 3000), *made]


@pytest.mark.parametrize("path, dropped", [(BYTE, False), (WORD, True)])
def test_units_equal_library(path, dropped):
    encoder, library = IdEncoder(path, dropped), load_tokenizer(path)
    for text in odd_texts():
        ids = np.frombuffer(encoder.encode(text), IDS).tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("path, dropped", [(BYTE, False), (WORD, True)])
def test_batches_equal_library_and_look_units_up_once(path, dropped):
    encoder, library = IdEncoder(path, dropped), load_tokenizer(path)
    texts = [*odd_texts(), "Upper, CASE... Ünï,", "a  ", " b", "c\n"]
    for column in (pa.array(texts), pa.array(["gone", *texts, "gone"]).slice(1, len(texts))):
        for text, ids in zip(texts, encoder.encode_all(column), strict=True):
            assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
    for some in ([], [""], ["", ""], ["x"], ["<|endoftext|>"]):
        found = [i.tolist() for i in encoder.encode_all(pa.array(some, pa.string()))]
        assert found == [library.encode(t, add_special_tokens=False).ids for t in some]
    asked, known = [], encoder.of_unit
    encoder.of_unit = type("Asked", (), {"__getitem__": lambda _, key: asked.append(key) or known[key]})()
    encoder.encode_all(pa.array(["one two two", "a two\ntwo two"] * 50))
    assert len(asked) == len(set(asked))


def test_words_with_marks_need_no_pattern():
    """A word with marks or a line end is cut as the file's pattern cuts it, without asking it."""
    for path, dropped in ((BYTE, False), (WORD, True)):
        cutter, library = IdEncoder(path, dropped).units, load_tokenizer(path)
        literals = ["Tajaí,", "word.", "it$$$", "a's", "x_", "'", "a'", "é\"...", "ab12,", "12,", "a-b", "Z\xa0,"]
        literals += literals if dropped else [lead + t for lead in (" ", "\n", "  ") for t in literals]
        for literal in literals:
            ids = [t.id for p in cutter.pieces(literal) for t in cutter.tokenizer.model.tokenize(p)]
            assert ids == library.encode(literal, add_special_tokens=False).ids, repr(literal)
        cutter.pattern = None.__class__  # has no findall
        assert len(cutter.pieces("Tajaí,..")) == 2 and len(cutter.pieces("word")) == 1


def test_trie_equals_library():
    encoder, library = trie_bpe.Encoder(BYTE), load_tokenizer(BYTE)
    draw = random.Random(8)
    words = ["".join(draw.choices("abeotnsr", k=draw.randint(1, 25))) for _ in range(1500)]
    texts = odd_texts() + words
    for text, packed in zip(texts, encoder.encode_batch(texts)):
        ids = np.frombuffer(packed, IDS).tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids, repr(text)
        assert encoder.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_counts(spark):
    library = load_tokenizer(BYTE)
    rows = [(i, t, 5) for i, t in enumerate(odd_texts(200))] + [(None, None, 1), (3, "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    found = sorted(tuple(r) for r in token_counts.token_counts(docs, BYTE).na.fill(-1).collect())
    want = []
    for i, text, _ in rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        want.append((-1 if i is None else i, len((text or "").encode()), n, n > 512))
    assert found == sorted(want)
    assert token_counts.token_counts(docs.limit(0), BYTE).count() == 0


def test_a_worker_keeps_the_caches_of_one_operator(monkeypatch):
    monkeypatch.setattr(units, "_KEPT", {})
    first = units.of_worker(list, "a")
    assert units.of_worker(list, "a") is first
    units.of_worker(set, "b")
    assert list(units._KEPT) == [(set, "b")]
    units.give_back()
    assert not units._KEPT


def test_words_are_kept_once_and_odd_spaces_found():
    """A word is no piece beside its unit, and Arrow finds the texts that are not to be cut."""
    encoder = IdEncoder("/opt/tokenizers/byte_bpe_50k.json")
    texts = ["a qwrty qwrty, (qwrty) qwrtyé qwrtyé;", "a　  b", "a  ", "a  b", "a \x1c", "x<|endoftext|>", ""]
    found = encoder.encode_all(pa.array(texts))
    for text, ids in zip(texts, found, strict=True):
        assert ids.tolist() == encoder.units.whole(text)
    assert "Ġqwrty" not in encoder.of_piece and "qwrty" in encoder.of_unit
    assert encoder.units.uncut_of(pa.array(texts)).tolist() == [encoder.units.uncut(t) for t in texts]
