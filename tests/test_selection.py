"""Windows found by counting against windows of the sorted rows."""

import datetime as dt
import decimal
import random

import pytest
from pyspark.sql import functions as F

from lamina.operators import selection
from lamina.operators.selection import SortKey, take_window
from lamina.session import Staging

N = 1200
SCHEMA = (
    "id bigint, few int, real double, small float, word string, money decimal(12,2), "
    "day date, at timestamp, local timestamp_ntz, flag boolean"
)


def maybe(draw, value):
    return None if draw.random() < 0.1 else value


@pytest.fixture(scope="module")
def rows(spark):
    draw = random.Random(6)
    start = dt.datetime(2021, 3, 28, 0, 30)
    made = []
    for i in range(N):
        at = start + dt.timedelta(microseconds=draw.randint(0, 10**11))
        made.append((
            i, maybe(draw, draw.randint(-3, 3)),
            maybe(draw, draw.choice([float("nan"), float("-inf"), -0.0, 0.0, draw.gauss(0, 1)])),
            maybe(draw, draw.gauss(0, 1)), maybe(draw, draw.choice(["", "a", "É", "😀", "zz", "a'b"])),
            maybe(draw, decimal.Decimal(draw.randint(-999, 999)) / 100),
            maybe(draw, at.date()), maybe(draw, at), maybe(draw, at), maybe(draw, draw.random() < 0.5),
        ))
    draw.shuffle(made)
    return spark.createDataFrame(made, SCHEMA).repartition(5).cache()


@pytest.fixture(autouse=True)
def searching(monkeypatch):
    """Ranges are halved a few times before they can be looked at."""
    monkeypatch.setattr(selection, "MAX_TOP_ROWS", 20)
    monkeypatch.setattr(selection, "SAMPLE_ROWS", 60)


def ids(df):
    return [r["id"] for r in df.collect()]


WINDOWS = [(0, 400), (1, 30), (377, 500), (1199, 5), (1200, 5), (40, None), (5000, None)]


@pytest.mark.parametrize("name", [part.split()[0] for part in SCHEMA.split(", ")])
@pytest.mark.parametrize("down", [False, True])
def test_every_type(rows, name, down):
    order = [SortKey(F.col(name), down), F.col("id")]
    whole = ids(rows.orderBy(*selection.orderings(order)))
    for offset, count in WINDOWS[:: 3 if down else 2]:
        end = N if count is None else offset + count
        assert ids(take_window(rows, order, offset, count)) == whole[offset:end]


def test_orders_of_several_columns(rows):
    order = [SortKey(F.col("few"), True), F.col("word"), SortKey(F.col("at"), True), F.col("id")]
    whole = ids(rows.orderBy(*selection.orderings(order)))
    for offset, count in WINDOWS:
        end = N if count is None else offset + count
        assert ids(take_window(rows, order, offset, count)) == whole[offset:end]


@pytest.mark.parametrize("window", WINDOWS)
def test_rows_alike_in_the_whole_order(rows, window):
    """Some may be taken, but the right number of each."""
    narrow = rows.select("few")
    whole = [r[0] for r in narrow.orderBy("few").collect()]
    end = N if window[1] is None else sum(window)
    found = [r[0] for r in take_window(narrow, [F.col("few")], *window).collect()]
    assert found == whole[window[0] : end]


def test_only_the_window_is_sorted(spark, tmp_path, monkeypatch):
    """No single task, nothing written; the filter between the two rows reaches the scan."""
    spark.range(0, 9000, numPartitions=3).withColumn("x", F.col("id") * 2).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    monkeypatch.setattr(Staging, "write", lambda *_: pytest.fail("something is written"))
    found = take_window(df, [SortKey(F.col("x"), True), F.col("id")], 3000, 3000)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in text and "TakeOrdered" not in text and "Limit" not in text
    assert "GreaterThanOrEqual(x," in text and "LessThanOrEqual(x," in text
    assert text.count("Sort ") == 1 and "rangepartitioning" in text
    assert [r["id"] for r in found.collect()] == list(range(5999, 2999, -1))
