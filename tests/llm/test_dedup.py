"""The three deduplications against plain versions."""

import hashlib
import os
import random
import tracemalloc

import numpy as np
import pytest
from lamina.llm import exact_dedup, near_dedup, substring_dedup, suffix_array
from lamina.session import Staging
from pyspark.sql import functions as F

PASSAGE = " ".join(f"shared{i}" for i in range(60))
BASE = " ".join(f"w{i}" for i in range(120))
ROWS = [
    (1, PASSAGE + " start one", "a"), (2, "before " + PASSAGE, "b"), (3, None, None), (4, "", "c"),
    (5, BASE, "d"), (6, BASE + " more", "d"), (7, BASE.upper(), "d"), (8, "x " * 4000, "e"),
    (9, "few words", "f"), (10, "Few words", "f"), (11, "é" * 60 + "a", "g"), (12, "b" + "é" * 60, "g"),
    (12, "b" + "é" * 60, "g"), (None, BASE, "h"),
]
SCHEMA = "doc_id long, text string, keep_id string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def lower(text):
    return (text or "").encode().lower()


@pytest.mark.parametrize("weak", [False, True])
def test_exact(spark, docs, tmp_path, weak):
    """Also with a digest that collides, and arriving in several batches."""
    path = f"{tmp_path}/docs"
    docs.repartition(4).write.parquet(path)
    options = {"files_per_batch": 1}
    if weak:
        options["digest"] = lambda text: (F.crc32(text.cast("binary")) % 3).cast("string").cast("binary")
    found = exact_dedup.exact_groups(spark, path, **options).collect()
    want = {}
    for doc_id, text, _ in ROWS:
        want.setdefault(lower(text), []).append(doc_id)
    largest = {t: max((i for i in ids if i is not None), default=None) for t, ids in want.items()}
    by_id = {(i, lower(t)) for i, t, _ in ROWS}
    assert len(found) == len(ROWS) and len(by_id) == len(ROWS) - 1
    expected = sorted((repr(i), repr(largest[lower(t)]), len(want[lower(t)])) for i, t, _ in ROWS)
    assert sorted((repr(r.doc_id), repr(r.keep_id), r.group_size) for r in found) == expected
    assert sum(r.kept for r in found) == len(want)


def test_keep_one(spark, docs):
    left = exact_dedup.keep_one(docs, Staging(spark))
    assert left.columns == docs.columns
    assert sorted(lower(r.text) for r in left.collect()) == sorted({lower(t) for _, t, _ in ROWS})


def test_stages_keep_one_copy(spark, docs):
    """Of what a stage stages, its result needs one copy of the texts at most."""
    for keep_one, texts in ((exact_dedup.keep_one, 1), (near_dedup.keep_one, 0)):
        staging = Staging(spark)
        left = keep_one(docs, staging)
        held = [spark.read.parquet(p) for p in staging.paths]
        assert sum(str(d.schema).count("StringType") >= 3 for d in held) == 0
        assert sum("text" in d.columns for d in held) == texts and len(held) == 1 + texts
        assert left.columns == docs.columns and left.count() > 0


def test_near(spark, docs):
    found = {r.doc_id: r for r in near_dedup.near_groups(docs).collect()}
    assert {i for i, r in found.items() if i and r.component_id == 5} == {5, 6, 7}
    assert found[10].component_id == 9 and found[2].component_id == 1  # 56 shingles of 59
    assert found[3].n_shingles == 0 and found[3].kept and found[4].kept and found[None].component_id is None
    assert found[9].n_shingles == 1 and found[5].n_shingles == 116
    assert near_dedup.near_groups(docs.limit(0)).count() == 0


def test_signature_estimates_similarity():
    import numpy as np

    draw = np.random.default_rng(2)
    pool = draw.integers(0, 2**63, 4000, dtype=np.uint64)
    a, b = np.unique(pool[:3000]), np.unique(pool[1000:])
    same = near_dedup.super_minhash(a) == near_dedup.super_minhash(b)
    assert abs(same.mean() - 0.5) < 0.15
    halves = [near_dedup.super_minhash(p) for p in (a[:900], a[900:])]
    whole = np.minimum(*halves)
    assert (whole == near_dedup.super_minhash(a)).all()


def plain_removal(rows):
    texts = [(i, (t or "").encode()) for i, t, _ in rows]
    first: dict[bytes, int] = {}
    for i, data in texts:
        for p in range(len(data) - 49 if i is not None else 0):
            w = data[p : p + 50]
            first[w] = min(i, first.get(w, i))
    out = []
    for i, data in texts:
        gone = bytearray(len(data))
        for p in range(len(data) - 49 if i is not None else 0):
            if first[data[p : p + 50]] < i:
                gone[p : p + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(data, gone) if not g)
        spans = (b"\0" + bytes(gone)).count(b"\0\1")
        out.append((repr(i), len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_substrings(spark, docs, monkeypatch):
    found = sorted((repr(r[0]), *r[1:]) for r in substring_dedup.removal_digests(docs).collect())
    assert found == plain_removal(ROWS)
    assert substring_dedup.removal_digests(docs.limit(0)).count() == 0


def test_a_run_another_chunk_has_first_is_settled():
    """Also where other runs share its anchor; only different runs go on to be compared."""
    import numpy as np
    import pyarrow as pa

    chunks = [[(7, 1, 5), (8, 1, 5)], [(7, 1, 6), (8, 0, 6)], [(7, 2, 3), (8, 1, 4)], [(7, 1, 5)], [(9, 4, 1)]]
    parts = [substring_dedup.packed_report(np.array(c, substring_dedup.REPORT)) for c in chunks]
    table = pa.table({"chunk": range(5), "bucket": [0] * 5, "payload": pa.array(parts, pa.binary())})
    found = [list(p) for p in substring_dedup.answer(table)["payload"].to_pylist()]
    first, partial, unique = substring_dedup.EARLIER, substring_dedup.PARTIAL, substring_dedup.UNIQUE
    # An id that comes twice does not count for itself; several runs in one (0) are compared.
    assert found == [[partial, first], [first, partial], [partial, partial], [partial], [unique]]


def test_substrings_on_documents(spark):
    folder = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang").collect()]
    found = sorted((repr(r[0]), *r[1:]) for r in substring_dedup.removal_digests(spark.createDataFrame(rows, SCHEMA)).collect())
    assert found == plain_removal(rows)


def test_suffix_ranks():
    import random

    import numpy as np

    draw = random.Random(4)
    for _ in range(600):
        text = [draw.randint(1, draw.choice([1, 2, 250])) for _ in range(draw.randint(0, 40))]
        order = sorted(range(len(text)), key=lambda i: text[i:])
        ranks = suffix_array.suffix_ranks(np.array(text, np.int64)).tolist()
        assert [ranks[i] for i in order] == list(range(1, len(text) + 1))


def plain_components(rows, percent):
    """Every pair of documents by its five-word shingles, as sets of words and not of hashes."""
    sets = {}
    for i, t, *_ in rows:
        words = lower(t).split()
        k = min(5, len(words))
        sets[i] = {tuple(words[a : a + k]) for a in range(len(words) - k + 1)} if words else set()
    root = {i: i for i in sets}
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]) and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = {i: low if r == high else r for i, r in root.items()}
    return root


@pytest.mark.parametrize("percent", [50, 75])
def test_near_by_all_pairs(spark, percent):
    """Chains of texts of which a part of the words changes, at similarities around the limit."""
    import random

    draw, rows = random.Random(8), []
    for chain in range(60):
        words = [f"c{chain}w{k}" for k in range(80)]
        for _ in range(3):
            rows.append((len(rows) + 1, " ".join(words)))
            start, size = draw.randrange(40), draw.choice([3, 6, 15, 21, 22, 40])
            words[start : start + size] = [f"x{draw.random()}" for _ in range(size)]
    found = near_dedup.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), percent).collect()
    want = plain_components(rows, percent)
    assert {r.doc_id: r.component_id for r in found} == want
    assert 60 < len(set(want.values())) < 180


def test_bands_and_bits_follow_the_similarity():
    assert (near_dedup.band_rows(75), near_dedup.most_bits(75)) == (4, 38)
    assert near_dedup.band_rows(50) == 2 and near_dedup.most_bits(50) > 38
    with pytest.raises(ValueError):
        near_dedup.band_rows(5)


def test_runs_of_a_chunk_take_little_memory():
    draw = random.Random(5)
    data = bytes(draw.choices(b"abcdefgh ", k=1 << 18))
    tracemalloc.start()
    runs = substring_dedup.Runs([1], [len(data)], data)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(runs.anchor) and peak < 60 * len(data)


def test_sets_are_made_of_the_rows_asked_for(spark):
    rows = [(i, f"{i} " + BASE) for i in range(200)] + [(7, "another seven"), (None, BASE), (300, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ids = spark.createDataFrame([(7,), (150,), (900,)], "doc_id long")
    made = near_dedup.shingle_sets(docs, ids, Staging(spark)).collect()
    shingler = near_dedup.Shingler()
    want = sorted((i, shingler.shingles(t).tobytes()) for i, t in rows if i in (7, 150))
    assert sorted((r.doc_id, bytes(r["set"])) for r in made) == want


def test_near_copies_that_are_not_linked_are_not_tried_in_pairs(spark, monkeypatch):
    """A large group around one text, of which most pairs are alike but not linked."""
    draw, rows = random.Random(11), []
    base = [f"w{k}" for k in range(150)]
    for i in range(150):
        words = list(base)
        for at in draw.sample(range(0, 150, 6), draw.choice([1, 2, 3, 4, 5, 6])):
            words[at] = f"x{draw.random()}"
        rows.append((i + 1, " ".join(words)))
    # Linked with each other by what they share and the others do not have.
    own = draw.sample(range(3, 150, 6), 9)
    for tail in ("", " p", " q"):
        words = list(base)
        for at in own:
            words[at] = f"own{at}"
        rows.append((len(rows) + 1, " ".join(words) + tail))
    tried, confirm = [], near_dedup.confirm

    def counted(pairs, *args):
        tried.append(pairs.count())
        return confirm(pairs, *args)

    monkeypatch.setattr(near_dedup, "confirm", counted)
    found = near_dedup.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = plain_components(rows, 75)
    assert {r.doc_id: r.component_id for r in found} == want
    assert want[153] == want[151] != want[1] and len(set(want.values())) > 10
    assert tried[1] < 5 * len(rows)


def test_bounds_of_pairs_are_never_below_what_differences_share(spark):
    import numpy as np

    rng, rows = np.random.default_rng(5), []
    for n in (0, 1, 40, 300):
        lost = [rng.permutation(400)[:n] for _ in "ab"]
        own = [rng.integers(0, 200, n, np.uint64) for _ in "ab"]
        own = [np.unique(o) for o in own]
        both = len(np.intersect1d(*lost)) + len(np.intersect1d(*own))
        values = [v for a, b in zip(lost, own) for v in near_dedup.bounds(a, b)]
        rows.append([both, min(len(a) + len(b) for a, b in zip(lost, own)), *values])
    names = [f"{d}_{c}" for d in "ab" for c in near_dedup.BOUNDS]
    found = spark.createDataFrame(
        [[int(v) for v in r] for r in rows], ", ".join(f"{c} long" for c in ["both", "least", *names])
    ).selectExpr("both", "least", f"{near_dedup.at_most()} AS most").collect()
    assert all(r.both <= r.most <= r.least for r in found)
    assert found[2].most < found[2].least


def test_a_pair_is_left_to_its_first_shared_shingle(spark):
    from pyspark.sql import Window

    kind = "centre long, hash long, n long, member long"
    rows = spark.createDataFrame([[1, h, 10 - h, m] for h in range(5) for m in (7, 8)], kind)
    placed = near_dedup.placed_hashes(rows)
    order = Window.partitionBy("member").orderBy("n", "hash")
    found = placed.select("hash", "member", "place", *near_dedup.front(order)).collect()
    assert {(r.hash, r.place) for r in found} == {(h, h) for h in range(5)}  # common ones first
    assert {r.hash for r in found if r.f0 == 0} == {4}  # the rarest has none before it


def test_what_finding_copies_needs_is_released_and_texts_are_compact(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq
    from lamina.llm import substring_dedup
    from lamina.session import Staging, shared_folder

    docs = spark.createDataFrame([(1, "one two"), (2, "one two"), (3, "x" * 80)], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/docs")
    folder, staging = f"{shared_folder(spark).removeprefix('file:')}/lamina", Staging(spark)
    before = set(glob.glob(f"{folder}/dedup-*"))
    assert exact_dedup.exact_groups(spark, f"{tmp_path}/docs", staging).count() == 3
    staging.release()
    assert set(glob.glob(f"{folder}/dedup-*")) == before
    assert substring_dedup.with_kept_texts(docs, staging).count() == 3
    files = [f for p in staging.paths if "substring-input" in p for f in glob.glob(f"{p.removeprefix('file:')}/*.parquet")]
    groups = [m.row_group(i) for f in files for m in [pq.read_metadata(f)] for i in range(m.num_row_groups)]
    assert {g.column(1).compression for g in groups} == {"ZSTD"}
    staging.release()


def border_rows(n):
    """One passage that ends otherwise in every document, in some pairs of them alike."""
    draw = random.Random(8)
    rows = []
    for i in range(n):
        tail = "".join(draw.choices("abcdefghij ", k=draw.choice([5, 20, 40, 60])))
        rows += [(2 * i, f"{i} {PASSAGE}{tail} {i}", "a"), (2 * i + 1, f"{-i} {PASSAGE}{tail}{-i}", "a")]
    return [*rows, (9999, "-" * 300 + PASSAGE, "b"), (9998, "+" + "-" * 200, "b"), (9998, "ab" * 90, "b")]


def test_a_hot_anchor_is_dealt_by_what_its_windows_hold(spark, monkeypatch):
    rows = border_rows(40)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    monkeypatch.setattr(substring_dedup, "HOT_CHUNKS", 2)
    found = sorted((repr(r[0]), *r[1:]) for r in substring_dedup.removal_digests(docs).collect())
    assert found == plain_removal(rows)


def staged_runs(spark, monkeypatch, docs):
    """The rows that go on to be compared, as they are staged."""
    held, write = [], Staging.write

    def seen(self, df, label):
        out = write(self, df, label)
        if label == "substring-runs":
            held.extend(out.where("bucket >= 0").collect())
        return out

    monkeypatch.setattr(Staging, "write", seen)
    found = sorted((repr(r[0]), *r[1:]) for r in substring_dedup.removal_digests(docs).collect())
    return found, held


def test_windows_of_a_hot_anchor_go_together(spark, monkeypatch):
    """Some of a run at a time: one by one their texts would come dozens of times."""
    rows = border_rows(40)
    monkeypatch.setattr(substring_dedup, "HOT_CHUNKS", 2)
    found, held = staged_runs(spark, monkeypatch, spark.createDataFrame(rows, SCHEMA).repartition(1))
    assert found == plain_removal(rows)
    texts = [substring_dedup.unsqueeze(bytes(r.payload)[8:]) for r in held]
    windows = sum(
        int((np.frombuffer(t, substring_dedup.ENTRY, int.from_bytes(bytes(r.payload)[:8], "little"))["size"] - 49).sum())
        for r, t in zip(held, texts)
    )
    assert windows and sum(map(len, texts)) < 25 * windows


def test_texts_that_share_twenty_bytes_are_not_compared(spark, monkeypatch):
    """Whatever the rest of a window is unlike in, its text would cross the network for nothing."""
    draw = random.Random(9)
    mine = lambda: "".join(draw.choices("klmnopqrstuv ", k=200))
    rows = [(i, f"{mine()}the same few words of all{mine()}", "a") for i in range(30)]
    found, held = staged_runs(spark, monkeypatch, spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert found == plain_removal(rows) and not held


def test_sides_of_anchors():
    """Equal to those by the plain definition, and unknown where an anchor comes twice in a run."""
    draw = random.Random(3)
    for trial in range(30):
        sizes = [draw.randint(0, 400) for _ in range(6)]
        data = bytes(draw.choices(draw.choice([b"ab", b"abcdefghijk", b"a"]), k=sum(sizes)))
        runs = substring_dedup.Runs(list(range(6)), sizes, data, sides=True, grams=True)
        for k, (a, b) in enumerate(zip(runs.start.tolist(), runs.stop.tolist())):
            places = [p for p in range(a, b - 19) if runs.gram[p] == runs.anchor[k]]
            want = [substring_dedup.ANY_SIDE] * 2
            if len(places) == 1:
                far = ((places[0] - 15, places[0] - 15 >= a), (places[0] + 15, places[0] + 35 <= b))
                want = [2 + (int(runs.gram[p]) >> 8) % ((1 << 24) - 2) if there else 1 for p, there in far]
            assert [runs.left[k], runs.right[k]] == want


def test_reports_come_back_as_they_were():
    draw = np.random.default_rng(2)
    for ids in ([5, 5], [0, 255], [-(1 << 63) + 1, (1 << 63) - 1], [7, 70_000], [-3, 1 << 40]):
        rows = np.zeros(50, substring_dedup.SIDES)
        for name, size in substring_dedup.PACKED.items():
            rows[name] = draw.integers(0, 1 << (8 * size), 50)
        rows["doc"] = draw.choice(ids, 50)
        begin = np.array([0, 1, 20])
        parts = [*substring_dedup.packed_reports(rows, begin), substring_dedup.packed_report(rows[:3])]
        back, counts = substring_dedup.unpacked_reports(parts)
        assert counts.tolist() == [1, 19, 30, 3] and (back == np.concatenate([rows, rows[:3]])).all()


def test_columns_travel_with_their_texts(spark):
    """Null texts, names and types of whatever else there is, and texts staged once."""
    kind = "text string, doc_id long, `a b` struct<x:array<int>,`y.z`:map<string,timestamp>>, whole decimal(30,3)"
    rows = [(t, i, ([i, None], {"k": None}) if i else None, None) for i, t, _ in ROWS]
    docs, staging = spark.createDataFrame(rows, kind), Staging(spark)
    left = substring_dedup.with_kept_texts(docs, staging)
    assert [(f.name, f.dataType) for f in left.schema] == [(f.name, f.dataType) for f in docs.schema]
    kept = sorted((repr(r[1]), repr(r[2]), r[3], r[0] is None) for r in left.collect())
    assert kept == sorted((repr(r[1]), repr(r[2]), r[3], r[0] is None) for r in docs.collect())
    plain = {i: (n, gone) for i, n, gone, *_ in plain_removal(ROWS)}
    for r in left.collect():
        if plain[repr(r.doc_id)][1] == 0:
            assert (r.text, r.doc_id) in {(t, i) for i, t, _ in ROWS}
    assert len(staging.paths) == 2  # the chunks and the spans
    staging.release()
