"""Trained operators: base figures by plain versions, verdicts by labels."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from lamina.llm import class_lm, line_quality, toxicity

FOLDER = "/root/testdata/sf0.01"
EDGE = [(None, None, 1), (-1, "", 1), (-2, " \n\t ", 1), (-3, "same " * 2000, 1), (-3, "same " * 2000, 1)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").limit(400)
    edge = spark.createDataFrame(EDGE, "doc_id long, text string, score int").select("doc_id", "text")
    return rows.union(edge).cache()


def held_out(doc_id, folds):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % folds == 2


def test_class_lm(spark, docs):
    rows = [(r.doc_id, [*(r.text or "").encode().lower().split(), b""]) for r in docs.collect()]
    counts = Counter(t for i, ts in rows if not held_out(i, 7) for t in ts)
    total = sum(counts.values())
    found = class_lm.score_texts(docs).collect()
    assert len(found) == len(rows)
    want = sorted(
        (repr(i), held_out(i, 7), len(ts), sum(counts[t] > 0 for t in ts), total,
         round(sum(math.log10((counts[t] + 1) / (total + len(counts) + 1)) for t in ts), 3))
        for i, ts in rows
    )
    got = sorted(
        (repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 3))
        for r in found
    )
    for a, b in zip(got, want):
        assert a[:5] == b[:5] and abs(a[5] - b[5]) < 0.01
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert class_lm.score_texts(docs.limit(0)).count() == 0


def test_exchange_gains():
    """A word joins the class whose neighbours it shares."""
    counts = np.zeros((class_lm.ALL_CLASSES,) * 2)
    counts[0, 1] = counts[1, 0] = 500
    counts[2, 3] = counts[3, 2] = 500
    left, right = np.zeros(class_lm.ALL_CLASSES), np.zeros(class_lm.ALL_CLASSES)
    left[2], right[2] = 10, 10
    counts[2, 1] += 10
    counts[1, 2] += 10
    assert class_lm.best_class(1, left, right, counts) == 3


def plain_repeats(words):
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    return len({i + k for i, w in enumerate(windows) if w in often for k in range(3)})


def test_line_quality(spark, docs):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    field = line_quality.fit(docs, labels)
    for r in line_quality.judge_texts(docs, field).collect():
        assert r.kept is False or not r.base_failed
    for text in (t for _, t, _ in EDGE + [(0, "a b c a b c a b", 0), (0, "x\nx\n\nx y", 0)]):
        text = text or ""
        n, chars, symbols, dup, repeated, failed, _, kept = line_quality.judge(text, field)
        words = text.encode().split()
        lines = [x for x in text.split("\n") if x.split()]
        assert (n, repeated, dup) == (len(words), plain_repeats(words), len(lines) - len(set(lines)))
        assert chars == sum(len(w.decode()) for w in words) and symbols == sum(map(text.count, "#*$%&|<>"))
        assert failed == (n < 50 or 100 * repeated > 50 * n) and not (failed and kept)
    scored = line_quality.judge_texts(docs, field).join(labels, "doc_id").where("not base_failed")
    assert scored.where("quality = 1 and not kept").count() == 0
    assert line_quality.judge_texts(docs.limit(0), field).count() == 0


def test_viterbi_is_best():
    draw = np.random.default_rng(3)
    field = line_quality.Field(draw.normal(size=(2, line_quality.N_FEATURES)), draw.normal(size=(2, 2)), draw.normal(size=2))
    x = draw.normal(size=(7, line_quality.N_FEATURES))

    def score(path):
        own = sum(field.own[label] @ row for label, row in zip(path, x))
        return field.start[path[0]] + own + sum(field.pair[a, b] for a, b in zip(path, path[1:]))

    paths = [[k >> i & 1 for i in range(7)] for k in range(128)]
    assert score(field.decode(x)) == pytest.approx(max(map(score, paths)))


def test_toxicity(spark):
    documents = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = toxicity.fit(documents, labels)
    scored = toxicity.score_texts(documents, model).join(labels, "doc_id").where("held_out")
    hits = {(r.toxic, r.predicted): r["count"] for r in scored.groupBy("toxic", "predicted").count().collect()}
    assert hits[1, 1] / (hits[1, 1] + hits.get((1, 0), 0)) > 0.85
    assert hits.get((0, 1), 0) / (hits[0, 0] + hits.get((0, 1), 0)) < 0.05
    edge = spark.createDataFrame(EDGE, "doc_id long, text string, score int")
    assert all(0 <= r.score <= 1 for r in toxicity.score_texts(edge, model).collect())
    none = toxicity.fit(edge, labels.limit(0))
    assert {r.predicted for r in toxicity.score_texts(edge, none).collect()} == {0}


def test_negative_risk_does_not_fit_noise():
    rows = [np.array([k]) for k in range(40)]
    positive = np.arange(40) < 20
    assert abs(toxicity.train(rows, positive, 0.1).weights).max() == 0


def test_many_words_exchange_as_one():
    draw = np.random.default_rng(5)
    counts = draw.integers(1000, 2000, (class_lm.ALL_CLASSES,) * 2).astype(float)
    own = draw.integers(0, class_lm.CLASSES, 30)
    sides = draw.integers(0, 9, (30, 2 * class_lm.ALL_CLASSES)) * (draw.random((30, 2 * class_lm.ALL_CLASSES)) < 0.1)
    sides[np.arange(30), own] = 5
    sides[:, -1] = 1
    at, place = np.nonzero(sides)
    found = class_lm.best_classes(own, at, place, sides[at, place].astype(float), counts)
    halves = class_lm.ALL_CLASSES
    want = [class_lm.best_class(k, s[:halves].astype(float), s[halves:].astype(float), counts) for k, s in zip(own, sides)]
    assert found.tolist() == want and (found != own).any()


def test_every_repeated_word_is_clustered(spark, monkeypatch):
    """Words beyond the broadcast tier have a class of the exchange too, and score by it."""
    draw = np.random.default_rng(6)
    kinds = [[f"{c}{i:03}" for i in range(300)] for c in ("a" * class_lm.LONGEST, "b")]
    texts = [" ".join(kinds[k % 2][draw.integers(300)] for k in range(60)) for _ in range(100)]
    rows = [(i, t + (" once" if i == 0 else "")) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    states = []
    found_by = class_lm.exchange
    monkeypatch.setattr(class_lm, "exchange", lambda *a: states.append(found_by(*a)) or states[-1])
    found = class_lm.score_texts(docs).collect()
    state, fits = states[0]
    training = [t.split() for i, t in rows if not held_out(i, 7)]
    counts = Counter(w.encode() for t in training for w in t)
    often = [w for w in counts if counts[w] >= class_lm.LEAST]
    top = sorted((w for w in often if len(w) <= class_lm.LONGEST), key=lambda w: (-counts[w], w))
    own = dict(zip(top, state.classes.tolist()))
    joined = {r["item"]: r["own"] for r in state.tail.collect()}
    own |= {w: joined[class_lm.tail_item(w)] for w in often if w not in top}
    assert len(own) == len(often) > 70 and max(own.values()) < class_lm.CLASSES
    assert state.fit == max(fits) > fits[0]
    of = [[class_lm.END_CLASS] + [own.get(w.encode(), class_lm.CLASSES + class_lm.shape_of(w.encode())) for w in t]
          + [class_lm.END_CLASS] for t in training]
    pairs = Counter(p for t in of for p in zip(t, t[1:]))
    assert {k: n for k, n in np.ndenumerate(state.counts) if n} == pairs
    each, rare = state.counts.sum(axis=0), class_lm.shape_totals(spark.createDataFrame(
        [(bytearray(w), n) for w, n in counts.items()], "word binary, n long"))
    share = (each + 1) / (each.sum() + class_lm.ALL_CLASSES)
    step = np.log10((state.counts + class_lm.ALL_CLASSES * share) / (state.counts.sum(axis=1, keepdims=True) + class_lm.ALL_CLASSES))
    by_id = dict(rows)
    for r in found:
        words = [w.encode() for w in by_id[r.doc_id].split()]
        classes = [own.get(w, class_lm.CLASSES + class_lm.shape_of(w)) for w in words]
        path = [class_lm.END_CLASS, *classes, class_lm.END_CLASS]
        want = step[path[:-1], path[1:]].sum()
        for w, c in zip(words, classes):
            if w in own:
                want += math.log10(counts[w] / each[c])
            else:
                held, n = rare[class_lm.shape_of(w)]
                want += math.log10((counts[w] + 0.5) / (held + 0.5 * (n + 1)))
        assert r.score == pytest.approx(want)
