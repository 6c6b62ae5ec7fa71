"""Exact round trips of id files and packed sequences."""

import zlib
from collections import defaultdict

import numpy as np
from lamina.llm import id_files, packing
from lamina.llm.common import tokenizer_path
from lamina.llm.units import IDS, load_tokenizer

BYTE, WORD = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("word_bpe_49k.json")
ROWS = [(5, "some words here " * 900, "x"), (2, None, "y"), (9, "", None), (7, "Tie", ""), (7, "Tie", ""), (1, "one", "")]
SCHEMA = "doc_id long, text string, ids string"


def test_blocks():
    draw = np.random.default_rng(1)
    for n in (1, 127, 128, 129, 3000):
        for top in (1, 2, 300, 50257, 2**32 - 1):
            ids = draw.integers(0, top, n, dtype=np.uint32)
            ids[::97] = 2**32 - 1
            blocks = id_files.pack_blocks(ids)
            starts = np.cumsum([0, *map(len, blocks)])[:-1]
            assert (id_files.unpack_blocks(b"".join(blocks), starts) == ids).all()


def test_files(spark):
    docs, library = spark.createDataFrame(ROWS, SCHEMA), load_tokenizer(BYTE)
    files = id_files.write_ids(docs, BYTE, id_files.output_folder(spark, "test"))
    start, want = 0, []
    for doc_id, text, _ in sorted(ROWS, key=lambda r: r[0]):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, IDS).tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in id_files.id_digests(files).collect()) == sorted(want)
    none = id_files.write_ids(docs.limit(0), BYTE, id_files.output_folder(spark, "test"))
    assert id_files.read_ids(none).count() == 0


def test_packing(spark):
    docs, library = spark.createDataFrame(ROWS, SCHEMA), load_tokenizer(WORD)
    pieces = [r.asDict() for r in packing.pack_documents(docs, WORD, payload=True).collect()]
    sequences, texts = defaultdict(list), defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
        texts[p["doc_id"]].append((p["start"], p["ids"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= 2048 and (at == 2048 or at & (at - 1) == 0)
    for doc_id in {r[0] for r in ROWS}:
        own = [t or "" for i, t, _ in ROWS if i == doc_id]
        ids = [*library.encode(own[0], add_special_tokens=False).ids, 1]
        got = b"".join(x for _, x in sorted(texts[doc_id]))
        assert sorted(got) == sorted(np.array(ids, IDS).tobytes() * len(own))
    assert packing.pack_documents(docs.limit(0), WORD).count() == 0


def test_hilbert_visits_neighbours():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    keys = packing.hilbert(cells, 3)
    assert sorted(keys) == list(range(512))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()
