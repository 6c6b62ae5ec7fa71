"""Alignment and sentencepiece encoding against brute force and the library."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from lamina.llm import alignment, sentence_pieces
from lamina.llm.common import tokenizer_path
from lamina.llm.units import IDS, load_tokenizer
from lamina.session import Staging

BYTE, PIECE = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
PARTS = [
    "the", "New", "'s", " ", "  ", "   ", "\n", "\n\n", " \n", "\t", "\r\n", " ", "é", "é", "Σ", "12",
    "$$", "<s>", "<unk>", "<0x0A>", "<|endoftext|>", "日本", "😀", "\x85", "\x00", "▁", "▁▁", "aaaa", "===",
    "\xa0", "　", "1234567", "antidisestablish",
]


def odd_texts(n=1500):
    draw = random.Random(11)
    made = ["".join(draw.choices(PARTS, k=draw.randint(0, 12))) for _ in range(n)]
    words = ["".join(draw.choices("abeotnsr", k=draw.randint(1, 60))) for _ in range(n // 3)]
    return ["", " ", "\n", "x" * 5000, "=" * 3000, "ab1" * 2000, "a b " * 500, *made, *words]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECE)


@pytest.fixture(scope="module")
def docs(spark):
    """Odd texts with repeated ids and rows, null ids and texts, and extra columns."""
    rows = [(i % 100, t, None, 1) for i, t in enumerate(odd_texts(200))]
    rows += [(None, None, None, 1), (7, "same words here", None, 2), (7, "same words here", None, 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, tag int")


# ---- sentencepiece --------------------------------------------------------


def test_agenda_equals_library(library):
    encoder = sentence_pieces.PieceEncoder(PIECE)
    texts = odd_texts()
    encoded, corrected = encoder.encode_batch(texts)
    for text, packed in zip(texts, encoded):
        ids = np.frombuffer(packed, IDS).tolist()
        assert ids == library.encode(text), repr(text)
        assert encoder.model.decode(ids) == library.decode(ids), repr(text)
    assert not any(corrected)


def test_both_agendas_agree(library):
    model = sentence_pieces.PieceBpe(PIECE)
    for text in odd_texts(400):
        written = text.replace(" ", sentence_pieces.SPACE)
        assert model._scan(written) == model._heap(written)


def test_decoding_any_ids(library):
    model, draw = sentence_pieces.PieceBpe(PIECE), random.Random(3)
    for _ in range(1500):
        ids = [draw.choice([draw.randint(0, 300), draw.randint(0, 31999)]) for _ in range(draw.randint(0, 8))]
        assert model.decode(ids) == library.decode(ids), ids


def test_check_corrects_and_reports(library):
    encoder = sentence_pieces.PieceEncoder(PIECE)
    encoder.model.score.pop("▁the")  # the agenda now misses a merge the library knows
    (packed, plain), corrected = encoder.encode_batch(["in the end", "hello"])
    assert np.frombuffer(packed, IDS).tolist() == library.encode("in the end")
    assert corrected[0] >= 1 and corrected[1] == 0


def test_piece_digests(spark, docs, library):
    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    want = []
    for doc_id, text, *_ in docs.collect():
        ids = library.encode(text or "")
        want.append((doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)), 0))
    found = [tuple(r) for r in sentence_pieces.round_trip_digests(docs, PIECE).collect()]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    assert sentence_pieces.round_trip_digests(docs.limit(0), PIECE).count() == 0
    texts = {r.decoded for r in sentence_pieces.encode_texts(docs, PIECE).collect()}
    assert texts == {(t or "").replace("▁", " ") for _, t, *_ in docs.collect()}


# ---- alignment ------------------------------------------------------------


def groups_of(text, tokenizer, library):
    """Groups of (A ids, B ids) by the rule: cut wherever both have an end."""
    spelled_a = {i: t for t, i in tokenizer.get_vocab().items()}
    byte_of = {c: b for b, c in enumerate(alignment.byte_alphabet())}
    a = tokenizer.encode(" " + text, add_special_tokens=False).ids
    b = library.encode(text)
    bytes_a = [bytes(byte_of[c] for c in spelled_a[i]) for i in a]
    bytes_b = [
        bytes([int(library.id_to_piece(i)[3:5], 16)]) if library.is_byte(i)
        else library.id_to_piece(i).replace("▁", " ").encode()
        for i in b
    ]
    want = (" " + text).encode()
    if not text or b"".join(bytes_a) != want or b"".join(bytes_b) != want:
        return []
    ends = [np.cumsum([len(p) for p in parts]).tolist() for parts in (bytes_a, bytes_b)]
    cuts = sorted(set(ends[0]) & set(ends[1]))
    found = [([], []) for _ in cuts]
    for side, ids in ((0, a), (1, b)):
        for i, end in zip(ids, ends[side]):
            found[np.searchsorted(cuts, end)][side].append(i)
    return found


def brute_links(rows):
    tokenizer = load_tokenizer(BYTE)
    tokenizer.encode_special_tokens = True
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    aligned = [(i, groups_of(t or "", tokenizer, library)) for i, t in rows]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for _, g in aligned]
    counts = Counter(pair for found in links for pair in found)
    top = defaultdict(int)
    for (a, _), n in counts.items():
        top[a] = max(top[a], n)
    out = []
    for (i, groups), found in zip(aligned, links):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((
            i, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups),
            sum(found.values()), sum(n for p, n in found.items() if counts[p] == top[p[0]]),
            sum(n * counts[p] for p, n in found.items()),
            hashlib.sha256(text.encode()).hexdigest() if groups else "",
        ))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot_pairs", [alignment.HOT_PAIRS, 40, 0])
def test_links_equal_brute_force(spark, docs, hot_pairs):
    """The bound on the broadcast table decides where counts come from, not what they are."""
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = alignment.link_counts(docs, BYTE, PIECE, Staging(spark), hot_pairs)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute_links(rows)


def test_links_of_an_empty_table(spark, docs):
    assert alignment.link_counts(docs.limit(0), BYTE, PIECE, Staging(spark)).count() == 0


def test_large_groups_are_counted_by_id():
    aligner = alignment.Aligner(BYTE, PIECE)
    texts = odd_texts(60)
    before = aligner.align(texts)
    limit, alignment.WRITTEN_LINKS = alignment.WRITTEN_LINKS, 1
    try:
        after = aligner.align(texts)
    finally:
        alignment.WRITTEN_LINKS = limit
    assert before["pairs"].equals(after["pairs"]) and before["times"].equals(after["times"])


@pytest.mark.parametrize("near", [1, 2, 32])
def test_cuts_by_halves(monkeypatch, near):
    """Shared ends of random texts, few or many, near the middle or far from it."""
    monkeypatch.setattr(alignment, "NEAR", near)
    draw = np.random.default_rng(5)
    for density in (0.02, 0.3, 0.9):
        a, b, a_stops, b_stops, base = [], [], [], [], 0
        for _ in range(30):
            length = int(draw.integers(1, 200))
            for ends, stops in ((a, a_stops), (b, b_stops)):
                own = np.flatnonzero(draw.random(length) < density) + 1
                ends.extend(base + np.union1d(own, [length]))
                stops.append(len(ends))
            base += length
        cut_a, cut_b = alignment.shared_cuts(*(np.array(x) for x in (a, b, a_stops, b_stops)))
        shared = sorted(set(a) & set(b))
        assert np.array(a)[cut_a].tolist() == shared == np.array(b)[cut_b].tolist()
