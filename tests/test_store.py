"""Stored layers: what a commit writes, who may commit, what readers see."""

import glob
import os
import threading

import pytest
from conftest import metadata, values
from pyspark.sql import functions as F

from lamina import InvalidParameterError, Layer, LayerContract, LayerStore, StaleLayerError
from lamina.operators import sizes
from lamina.session import Staging
from lamina.sources import store as store_module

ROWS = 200


@pytest.fixture
def numbers(spark):
    return spark.range(1, ROWS + 1).select(
        F.col("id").alias("OBJECTID"), F.lit("n").alias("Name"), F.lit(1).alias("Status"),
        F.lit(0.5).alias("Score"), F.lit(None).cast("timestamp").alias("EventDate"),
    )


@pytest.fixture
def stored(spark, numbers, contract, tmp_path):
    store = LayerStore(spark, str(tmp_path / "layer"))
    store.create(numbers, "OBJECTID", buckets=5)
    return Layer(None, contract, store=store)


def data_files(layer):
    return set(glob.glob(f"{layer.store.path}/data/**/part-*.parquet", recursive=True))


def bucket(file):
    return int(store_module.BUCKET_FILE.search(file)[2])


def one(spark, **given):
    kinds = {"OBJECTID": "bigint", "Name": "string", "Score": "double"}
    schema = ", ".join(f"{n} {kinds[n]}" for n in given)
    return spark.createDataFrame([tuple(given.values())], schema)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_row_rewrites_one_bucket(spark, stored):
    before = data_files(stored)
    stored.apply_edits(updates=one(spark, OBJECTID=7, Name="seven"))
    new = data_files(stored) - before
    home = spark.range(1).select(F.pmod(F.hash(F.lit(7).cast("bigint")), F.lit(5))).first()[0]
    assert {bucket(f) for f in new} == {home} and before <= data_files(stored)
    assert stored.rows.count() == ROWS
    assert values(stored.rows.where("Name <> 'n'"), "OBJECTID", "Name") == [(7, "seven")]
    # what was written are the rows of that bucket, no others
    written = spark.read.parquet(*new)
    assert written.count() == stored.store.read(buckets=[home]).count() < ROWS


def test_an_edit_reads_the_files_of_touched_buckets_only(spark, stored):
    state = stored.store.state()
    some = stored.store.read(buckets=[3])
    assert {bucket(f) for f in some.inputFiles()} == {3}
    assert stored.store.read(state=state, buckets=[]).count() == 0
    total = sum(stored.store.read(buckets=[b]).count() for b in range(5))
    assert total == ROWS


def test_adds_leave_what_is_there(spark, stored):
    before = data_files(stored)
    stored.append(one(spark, Name="new"))
    new = data_files(stored) - before
    assert spark.read.parquet(*new).count() == 1
    assert stored.rows.count() == ROWS + 1 and stored.store.state()["next_object_id"] == ROWS + 2


def test_crowded_buckets_are_written_anew(spark, stored, monkeypatch):
    monkeypatch.setattr(store_module, "MOST_PARTS", 2)
    for _ in range(6):
        stored.append(one(spark, Name="more"))
    state = stored.store.state()
    parts = [sum(b in p["live"] for p in state["parts"]) for b in range(5)]
    assert max(parts) <= 3
    assert values(stored.rows, "OBJECTID") == [(i,) for i in sorted(range(1, ROWS + 7), key=lambda i: repr((i,)))]


def test_a_stale_writer_is_refused_and_loses_nothing(spark, stored):
    slow = Layer(None, stored.contract, store=stored.store)
    job = slow._job(True, apply_coded_values=False, max_batch_bytes=None)
    stored.apply_edits(updates=one(spark, OBJECTID=1, Name="first"))
    with pytest.raises(StaleLayerError):
        slow._commit(job, job.apply(None, one(spark, OBJECTID=2, Name="second"), None))
    assert values(stored.rows.where("Name <> 'n'"), "OBJECTID", "Name") == [(1, "first")]
    # edited again from the new version it goes through
    slow.apply_edits(updates=one(spark, OBJECTID=2, Name="second"))
    assert values(stored.rows.where("Name <> 'n'"), "Name") == [("first",), ("second",)]


def test_of_two_writers_at_once_one_wins(spark, stored, numbers):
    base, told = stored.store.state(), []

    def write(name):
        try:
            told.append(stored.store.commit(numbers.withColumn("Name", F.lit(name)), base=base))
        except StaleLayerError as e:
            told.append(e)

    threads = [threading.Thread(target=write, args=(n,)) for n in ("a", "b")]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(map(str, told))[-1].startswith("Another writer") and 1 in told
    assert len(values(stored.rows.select("Name").distinct())) == 1


def test_a_dead_writer_stands_in_nobodys_way(spark, stored, numbers, monkeypatch):
    """Its files lie there, its manifest does not; readers and writers go on."""

    def die(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patched:
        patched.setattr(LayerStore, "_publish", die)
        with pytest.raises(KeyboardInterrupt):
            stored.store.commit(numbers.limit(3))
    assert stored.rows.count() == ROWS
    stored.apply_edits(deletes=[5])
    assert stored.rows.count() == ROWS - 1 and stored.store.latest() == 1


def test_the_note_of_the_newest_version_may_be_late(stored, spark):
    for i in (1, 2):
        stored.apply_edits(deletes=[i])
    note = f"{stored.store.path}/manifests/LATEST"
    stored.store._rename("0", "manifests/LATEST", replace=True)
    assert open(note).read() == "0" and stored.store.latest() == 2
    stored.store._files().delete(stored.store._place("manifests/LATEST"), False)
    assert stored.store.latest() == 2


def test_results_belong_to_their_version(spark, stored):
    stored.apply_edits(deletes=[1, 999], rollback_on_failure=False)
    told = stored.store.results()
    assert values(told, "object_id", "status") == [(1, "succeeded"), (999, "failed")]
    with pytest.raises(InvalidParameterError):
        stored.store.results(0)
    # a version of which nothing came keeps its results too
    stored.apply_edits(deletes=[998])
    assert stored.store.latest() == 2 and stored.rows.count() == ROWS - 1
    assert values(stored.store.results(2), "status") == [("failed",)]


def test_deleting_everything(spark, stored):
    stored.sync(spark.createDataFrame([], "Name string"), ["Name"])
    assert stored.rows.count() == 0 and stored.store.read(0).count() == ROWS
    stored.append(one(spark, Name="again"))
    assert values(stored.rows, "OBJECTID", "Name") == [(ROWS + 1, "again")]


def test_vacuum(spark, stored):
    stored.apply_edits(updates=one(spark, OBJECTID=1, Name="x"))
    stored.apply_edits(updates=one(spark, OBJECTID=1, Name="y"))
    state = stored.store.state()
    assert stored.store.vacuum(keep=1) == 2
    live = {(p["folder"], b) for p in state["parts"] for b in p["live"]}
    left = {(os.path.basename(os.path.dirname(f)), bucket(f)) for f in data_files(stored)}
    assert left == live and stored.rows.count() == ROWS
    with pytest.raises(Exception):
        stored.store.state(1)
    stored.apply_edits(deletes=[1])
    assert stored.store.latest() == 3 and stored.rows.count() == ROWS - 1


def test_large_edits_move_the_edits_only(spark, stored, monkeypatch):
    """The stored layer is met bucket by bucket, also after commits of some buckets."""
    stored.apply_edits(updates=one(spark, OBJECTID=3, Name="c"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        edits = spark.range(1, 50).select(F.col("id").alias("OBJECTID"), F.lit("e").alias("Name"))
        joined = stored.rows.join(edits, "OBJECTID", "left_anti")
        text = plan_of(joined)
        assert text.count("Exchange") == 1 and "Bucketed: true" in text
        assert joined.count() == ROWS - 49
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_global_ids_differ_between_layers(spark, tmp_path):
    meta = metadata(globalIdField="GlobalID")
    meta["fields"].append({"name": "GlobalID", "type": "esriFieldTypeGlobalID"})
    contract = LayerContract.from_metadata(meta)
    empty = spark.createDataFrame([], "OBJECTID bigint, Name string, GlobalID string")
    layers = [Layer(empty, contract), Layer(empty, contract)]
    for name in "ab":
        store = LayerStore(spark, str(tmp_path / name))
        store.create(empty, "OBJECTID", buckets=2)
        layers.append(Layer(None, contract, store=store))
    ids = [r[0] for x in layers for r in x.append(one(spark, Name="n")).rows.select("GlobalID").collect()]
    assert len(ids) == len(set(ids)) == 4 and all(ids)
    again = layers[3].append(one(spark, Name="m")).rows
    assert again.select("GlobalID").distinct().count() == 2


def wide_exchanges(df, column):
    """Exchanges that move ``column``."""
    utils = df.sparkSession._jvm.org.apache.spark.sql.api.python.PythonSQLUtils
    text = utils.explainString(df._jdf.queryExecution(), "formatted")
    nodes = [n for n in text.split("\n\n") if n.lstrip("\n").split("\n")[0].endswith(("Exchange", "Exchange "))]
    return [n for n in nodes if f"{column}#" in n.split("Arguments")[0]]


def test_wide_rows_of_a_large_upsert_move_once(spark, stored, monkeypatch):
    """To the layer's buckets; matching and judging move keys and verdicts only."""
    monkeypatch.setattr(sizes, "MAX_BROADCAST_ROWS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    staged, write = [], Staging.write
    monkeypatch.setattr(
        Staging, "write", lambda self, df, label: staged.append(df) or write(self, df, label)
    )
    feed = spark.range(150, 260, numPartitions=3).select(
        F.col("id").cast("string").alias("Name"), F.col("id").cast("int").alias("Status"),
        (F.col("id") * 1.5).alias("Score"),
    )
    layer = Layer(None, stored.contract, store=stored.store)
    named = stored.rows.select("OBJECTID", F.col("OBJECTID").cast("string").alias("Name"))
    try:
        layer.apply_edits(updates=named)
        staged.clear()
        job = layer._job(True, apply_coded_values=False, max_batch_bytes=None)
        outcome = job.merge(feed, ["Name"], delete_missing=False)
        change = outcome.change
        assert not any(wide_exchanges(df, "Score") for df in staged)
        assert len(wide_exchanges(change.rows(layer.rows), "Score")) == 1
        assert len(wide_exchanges(change.added(), "Score")) == 1
        rows = layer._commit(job, outcome).rows
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    found = {r["Name"]: (r["OBJECTID"], r["Score"]) for r in rows.collect()}
    assert len(found) == 259 and sorted(i for i, _ in found.values()) == list(range(1, 260))
    assert all(found[str(i)] == (i, 0.5 if i < 150 else i * 1.5) for i in range(1, ROWS + 1))
    assert {found[str(i)][1] for i in range(201, 260)} == {i * 1.5 for i in range(201, 260)}
