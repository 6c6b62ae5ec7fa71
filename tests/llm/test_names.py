"""Extra columns whose names the operators use themselves."""

import hashlib

import numpy as np
from lamina.llm import exact_dedup, near_dedup, toxicity, trie_bpe
from lamina.llm.common import tokenizer_path
from lamina.llm.units import load_tokenizer
from lamina.session import Staging

BYTE = tokenizer_path("byte_bpe_50k.json")
ROWS = [
    (1, "one two three four five six seven", 1), (2, "One two three four five six seven", 2),
    (3, None, 3), (4, "", 4), (5, "something else altogether, nothing like it", 5), (None, "x", 6),
]


def test_near_dedup_beside_gone_id(spark):
    docs = spark.createDataFrame(ROWS[:2] + ROWS[4:5], "doc_id long, text string, gone_id int")
    kept = near_dedup.keep_one(docs, Staging(spark))
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 5]


def test_exact_dedup_beside_metadata(spark, tmp_path):
    docs = spark.createDataFrame(ROWS[:5], "doc_id long, text string, _metadata int")
    docs.write.parquet(f"{tmp_path}/docs")
    found = {r["doc_id"]: r["keep_id"] for r in exact_dedup.exact_groups(spark, f"{tmp_path}/docs").collect()}
    assert found == {1: 2, 2: 2, 3: 4, 4: 4, 5: 5}
    kept = exact_dedup.keep_one(docs, Staging(spark))
    assert kept.columns == docs.columns and {r["_metadata"] for r in kept.collect()} == {2, 4, 5}


def test_trie_digests(spark):
    """The query's own form, with null, empty and repeated texts and a clashing name."""
    docs = spark.createDataFrame([*ROWS, ROWS[0]], "doc_id long, text string, n_tokens int")
    library, want = load_tokenizer(BYTE), []
    for doc_id, text, _ in [*ROWS, ROWS[0]]:
        ids = library.encode(text or "", add_special_tokens=False).ids
        parts = (",".join(map(str, ids)), library.decode(ids, skip_special_tokens=False))
        want.append((doc_id, len(ids), *[hashlib.sha256(p.encode()).hexdigest() for p in parts]))
    found = [tuple(r) for r in trie_bpe.round_trip_digests(docs, BYTE).collect()]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    assert trie_bpe.round_trip_digests(docs.limit(0), BYTE).count() == 0


def test_feature_counts_let_through_all_that_training_uses(spark):
    """Training on the features Spark lets through gives the weights training on all gives."""
    draw = np.random.default_rng(1)
    words = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(300):
        own = draw.choice(words, 12).tolist() + (["vile", "nasty"] if i < 60 else [])
        rows.append((i, " ".join(own), i < 60))
    docs = spark.createDataFrame(rows, "doc_id long, text string, positive boolean")
    used = toxicity.clear_features(docs, 60, 240, toxicity.LEAST, toxicity.CLEAR)
    every = [np.array([f for w in toxicity.words_of(t) for f in toxicity.word_features(w)], np.int32) for _, t, _ in rows]
    positive = np.array([p for *_, p in rows])
    whole = toxicity.train(every, positive, 0.2)
    less = toxicity.train([r[np.isin(r, used)] for r in every], positive, 0.2)
    assert np.allclose(whole.weights, less.weights) and abs(whole.bias - less.bias) < 1e-9
    assert 0 < len(used) < 60
