import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lamina import InvalidParameterError
from lamina.operators import batches
from lamina.operators.edits import tag_input
from lamina.session import stage


def one_by_one(sizes, used, budget):
    """The rule, item by item."""
    numbers, number = [], 0
    for size in sizes:
        if used and used + size > budget:
            number, used = number + 1, 0
        numbers.append(number)
        used += size
    return numbers, used


@given(
    st.lists(st.integers(1, 60), max_size=80), st.integers(0, 70), st.integers(-10, 90)
)
@settings(max_examples=400, deadline=None)
def test_filling_equals_the_rule(sizes, used, budget):
    numbers, last = batches.fill_batches(np.array(sizes, dtype=np.int64), used, budget)
    wanted, left = one_by_one(sizes, used, budget)
    assert numbers.tolist() == wanted
    assert last == left


def edits(spark, rows, partitions):
    """(kind_rank, oid, size) rows as a written edit table, in the given order."""
    df = spark.createDataFrame(rows, "kind_rank int, oid bigint, size bigint")
    df = df.coalesce(1) if partitions == 1 else df.repartitionByRange(partitions, "kind_rank", "oid")
    tagged = tag_input(df.sortWithinPartitions("kind_rank", "oid"))
    return stage(
        tagged.select(
            "kind_rank", F.col("_seq").alias("seq"), "oid",
            F.lit(None).cast("string").alias("problem"), "size",
        ),
        "test-edits",
    )


def packed(spark, rows, partitions, budget):
    pack = batches.pack_edits(edits(spark, rows, partitions), budget + batches.OVERHEAD_BYTES)
    counts, total = pack.counts, pack.n_bytes
    found = sorted(pack.edits.collect(), key=lambda r: (r["kind_rank"], r["seq"]))
    assert sum(counts.values()) == len(rows) and total == sum(r[2] for r in rows)
    return found


@pytest.mark.parametrize("partitions", [1, 5])
def test_one_run_equals_the_rule(spark, partitions):
    rng = random.Random(3)
    rows = [(k, i, rng.randint(1, 40)) for k in range(3) for i in range(k * 1000, k * 1000 + 70)]
    found = packed(spark, rows, partitions, 200)
    wanted, _ = one_by_one([r[2] for r in rows], 0, 200)
    assert [r["batch_id"] for r in found] == wanted
    assert [(r["kind_rank"], r["oid"]) for r in found] == [r[:2] for r in rows]
    assert [r["position"] for r in found] == list(range(70)) * 3


@pytest.mark.parametrize("partitions", [1, 6, 23])
def test_batches_do_not_depend_on_tasks(spark, partitions, monkeypatch):
    monkeypatch.setattr(batches, "PIECE_BITS", 4)  # pieces of 16 edits: three levels
    rng = random.Random(partitions)
    rows = [(k, i, rng.randint(1, 60)) for k in range(3) for i in range(k * 1000, k * 1000 + 200)]
    found = packed(spark, rows, partitions, 100)
    assert [r["batch_id"] for r in found] == one_by_one([r[2] for r in rows], 0, 100)[0]
    assert [r["position"] for r in found] == list(range(200)) * 3


@given(
    st.lists(st.lists(st.integers(1, 60), min_size=1, max_size=12), min_size=1, max_size=9),
    st.integers(-5, 90),
    st.randoms(use_true_random=False),
)
@settings(max_examples=600, deadline=None)
def test_joined_passages_equal_the_rule(parts, budget, rng):
    passages = [batches.passage_of(np.array(p, np.int64), budget) for p in parts]
    while len(passages) > 1:  # in any grouping
        at = rng.randrange(len(passages) - 1)
        passages[at : at + 2] = [passages[at].then(passages[at + 1], budget)]
    sizes = [s for p in parts for s in p]
    for used in range(0, 100):
        numbers, left = one_by_one(sizes, used, budget)
        assert passages[0].enter(used, budget) == (numbers[-1], left)


def test_oversized_items_stand_alone(spark):
    found = packed(spark, [(0, 1, 5), (0, 2, 500), (0, 3, 5), (0, 4, 5)], 1, 10)
    assert [r["batch_id"] for r in found] == [0, 1, 2, 2]
    tiny = packed(spark, [(0, i, 9) for i in range(3)], 1, 1)
    assert [r["batch_id"] for r in tiny] == [0, 1, 2]


@pytest.mark.parametrize("given_bytes", [0, -1, 6_000_001])
def test_limits(given_bytes):
    with pytest.raises(InvalidParameterError):
        batches.check_batch_bytes(given_bytes)


def test_bodies(spark):
    rows = [(0, "adds", 1, '{"b":1}', None), (0, "adds", 0, '{"a":1}', None),
            (0, "deletes", 1, None, 9), (0, "deletes", 0, None, 8),
            (1, "updates", 0, '{"u":1}', None), (2, "deletes", 0, None, 3)]
    df = spark.createDataFrame(
        rows, "batch_id bigint, kind string, position bigint, feature string, oid bigint"
    )
    assert {r[0]: r[1] for r in batches.batch_bodies(df).collect()} == {
        0: '{"adds":[{"a":1},{"b":1}],"deletes":"8,9"}',
        1: '{"updates":[{"u":1}]}',
        2: '{"deletes":"3"}',
    }
