"""Exact deduplication as a stream with keyed state.

Arriving files are read as a stream. The state, kept on disk by RocksDB and never expired,
has one entry per digest of a normalised text: the row that stays so far (the largest
doc_id, then the last place), where its content lies (file and row) and how many rows had
the digest. A digest that was met again is a hit, and a hit is believed only after the whole bytes
of both texts were compared: the rows of a hit digest are joined with the text that the entry's
locator points to. Rows whose bytes differ from it are grouped among themselves by digest and whole
text, so even colliding digests give right groups.

A null text counts as empty. Rows without doc_id take part; one stays only if its group has
no other. Repeated doc_ids are told apart by their place, and exactly one row of a group
stays. An empty table gives no rows. Extra columns and their names do not matter.

Everything is DataFrame and streaming code: no Python runs on the executors.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm.common import COMPACT, ascii_lower
from lamina.llm.id_files import output_folder
from lamina.operators.sizes import fits
from lamina.session import Staging

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # many small stores
}
#: A digest with more rows is hot: its entry is copied and its rows are dealt over the copies.
ROWS_PER_COPY = 2000


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def read_rows(docs: DataFrame, id_col: str, text_col: str, digest: Callable) -> DataFrame:
    """doc_id, normalised text, digest and place of every row of a file-backed table."""
    text = ascii_lower(F.coalesce(docs[text_col], F.lit("")))
    source = docs.metadataColumn("_metadata")  # also where the table has a column of that name
    place = F.struct(source["file_path"].alias("file"), source["row_index"].alias("row"))
    return docs.select(docs[id_col].cast("long").alias("doc_id"), text.alias("text"), place.alias("place")).select(
        "*", digest(F.col("text")).alias("digest")
    )


class DedupStream:
    """The state of one corpus; every call of :meth:`absorb` continues where the last ended."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        folder: str,
        id_col: str = "doc_id",
        text_col: str = "text",
        digest: Callable[[Column], Column] = sha256,
        files_per_batch: int = 1000,
    ):
        self.spark, self.path, self.folder = spark, path, folder
        self.columns = (id_col, text_col, digest)
        self.files_per_batch = files_per_batch

    def absorb(self) -> None:
        """Take in all files not seen yet and end."""
        session = self.spark.newSession()  # its settings are the stream's alone
        for key, value in STREAM_CONF.items():
            session.conf.set(key, value)
        session.conf.set(
            "spark.sql.shuffle.partitions", self.spark.conf.get("spark.sql.shuffle.partitions")
        )
        schema = session.read.parquet(self.path).schema
        pattern = f"{self.path[:-1]}[{self.path[-1]}]"  # a stream takes a single file by pattern only
        arriving = (
            session.readStream.schema(schema)
            .option("maxFilesPerTrigger", self.files_per_batch)
            .parquet(pattern)
        )
        rows = read_rows(arriving, *self.columns)
        entry = F.struct(
            F.coalesce("doc_id", F.lit(-(1 << 63))).alias("rank"), "place", "doc_id"
        )
        state = rows.groupBy("digest").agg(
            F.max(entry).alias("entry"), F.count(F.lit(1)).alias("n")
        )

        def keep(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{self.folder}/entries/batch={number}")

        query = (
            state.writeStream.outputMode("update")
            .option("checkpointLocation", f"{self.folder}/state")
            .foreachBatch(keep)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    def entries(self) -> DataFrame:
        """digest, entry (rank, place, doc_id) and n: the newest update of every digest."""
        kind = (
            "digest binary, entry struct<rank long, place struct<file string, row long>, "
            "doc_id long>, n long, batch int"
        )
        updates = self.spark.read.schema(kind).parquet(f"{self.folder}/entries")
        if updates.select("batch").distinct().limit(2).count() < 2:
            return updates.drop("batch")
        newest = updates.groupBy("digest").agg(F.max(F.struct("n", "entry")).alias("x"))
        return newest.select("digest", "x.entry", "x.n")

    def groups(self, staging: Staging) -> DataFrame:
        """doc_id, place, digest, keep_id, group_size, kept for every row, hits checked."""
        rows = read_rows(self.spark.read.parquet(self.path), *self.columns)
        hits = staging.write(
            self.entries()
            .where("n > 1")
            .select("digest", "entry", "n", F.ceil(F.col("n") / ROWS_PER_COPY).cast("int").alias("copies")),
            "dedup-hits",
        )
        small = fits(hits.count(), 200 * hits.count())
        dealt = F.broadcast(hits) if small else hits
        marked = rows.join(dealt, "digest", "left")
        alone = marked.where(F.col("n").isNull()).select(
            "doc_id", "place", "digest", F.col("doc_id").alias("keep_id"),
            F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"),
        )
        # The text an entry points to goes once to each copy; the other rows of the digest
        # are dealt over the copies, so no task gets a whole hot group.
        met = staging.write(marked.where(F.col("n").isNotNull()), "dedup-met")
        first = F.col("place") == F.col("entry.place")
        held = met.where(first).select(
            "digest", F.col("text").alias("held"),
            F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"),
        )
        spread = F.pmod(F.xxhash64("place"), F.col("copies")).cast("int")
        checked = staging.write(
            met.withColumn("copy", spread)
            .join(held, ["digest", "copy"])
            .select(
                "doc_id", "place", "digest", "entry", "n",
                (F.col("text") == F.col("held")).alias("same"),
            ),
            "dedup-checked",
        )
        wrong = staging.write(
            checked.where("not same").groupBy("digest").agg(F.count(F.lit(1)).alias("others")),
            "dedup-wrong",
        )
        right = (
            checked.where("same")
            .join(F.broadcast(wrong) if fits(w := wrong.count(), 100 * w) else wrong, "digest", "left")
            .select(
                "doc_id", "place", "digest", F.col("entry.doc_id").alias("keep_id"),
                (F.col("n") - F.coalesce("others", F.lit(0))).alias("group_size"),
                (F.col("place") == F.col("entry.place")).alias("kept"),
            )
        )
        result = alone.unionByName(right)
        if w:
            result = result.unionByName(self._regrouped(rows, checked, staging))
        return result

    def _regrouped(self, rows: DataFrame, checked: DataFrame, staging: Staging) -> DataFrame:
        """Rows whose digest collided, grouped by digest and whole text."""
        others = checked.where("not same").select("digest", "place")
        left = staging.write(rows.join(others, ["digest", "place"], "left_semi"), "dedup-collided")
        entry = F.struct(F.coalesce("doc_id", F.lit(-(1 << 63))), "place", "doc_id")
        best = left.groupBy("digest", "text").agg(
            F.max(entry).alias("entry"), F.count(F.lit(1)).alias("n")
        )
        return left.join(best, ["digest", "text"]).select(
            "doc_id", "place", "digest", F.col("entry.doc_id").alias("keep_id"),
            F.col("n").alias("group_size"), (F.col("place") == F.col("entry.place")).alias("kept"),
        )


def exact_groups(
    spark: SparkSession, path: str, staging: Staging | None = None, **options
) -> DataFrame:
    """Stream the parquet table at ``path`` through a new state and return its groups."""
    stream = DedupStream(spark, path, output_folder(spark, "dedup"), **options)
    stream.absorb()
    staging = staging or Staging(spark)
    staging.paths.append(stream.folder)  # its entries and state go with what is made of them
    return stream.groups(staging)


def keep_one(docs: DataFrame, staging: Staging) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they are."""
    spark = docs.sparkSession
    passing = Staging(spark)  # what only finding the groups needs
    names = [f"c{i}" for i in range(len(docs.columns))]
    fixed = {"doc_id": "doc_id", "text": "text"}
    others = [(c, n) for c, n in zip(docs.columns, names) if c != "text"]
    plain = docs.select(
        *[docs[c].alias(fixed[c]) for c in fixed],
        F.struct(*[docs[f"`{c}`"].alias(n) for c, n in others]).alias("whole"),
    )
    staging.with_options(**COMPACT).write(plain, "dedup-input")
    path = staging.paths[-1]
    groups = exact_groups(spark, path, passing)
    gone = groups.where("not kept").select("place.file", "place.row")
    gone = staging.write(gone, "dedup-gone")
    passing.release()
    rows = spark.read.parquet(path).select(
        "text",
        "whole",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
    )
    stay = rows.join(gone, ["file", "row"], "left_anti")
    return stay.select(
        *[F.col("text" if c == "text" else f"whole.{n}").alias(c) for c, n in zip(docs.columns, names)]
    )
