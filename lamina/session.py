"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A row tag is (task number << 33) + running number within the task.
TASK_BITS = 33
TASK = "_task"

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("lamina")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", conf.pop("driver_memory", "8g"))
    )
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def pin_utc(spark: SparkSession) -> None:
    """Epoch conversions read wall-clock timestamps as UTC, so the session must too."""
    if spark.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC", "Z"):
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master, where driver and executors are one process, gets a
    temporary folder when the setting is absent; a cluster without it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a folder that all executors share."
        )
    folder = tempfile.mkdtemp(prefix="lamina-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


class Staging:
    """Tables one job writes to the shared folder, and their removal once it is over."""

    def __init__(self, spark: SparkSession, **options: str):
        self.spark, self.options = spark, options
        self.paths: list[str] = []
        self.tables: list[str] = []

    def with_options(self, **options: str) -> Staging:
        """The same staging, what it releases included, with these options of its writer."""
        other = Staging(self.spark, **options)
        other.paths, other.tables = self.paths, self.tables
        return other

    def write(self, df: DataFrame, label: str) -> DataFrame:
        """Write ``df`` once and return the written table.

        This fixes values such as row ids before anything fans out from them, and
        lost executors re-read files instead of recomputing their lineage. Parquet
        keeps later reads pruned to the columns they use.
        """
        name = f"{label}-{uuid.uuid4().hex}"
        path = os.path.join(shared_folder(self.spark), "lamina", name)
        self.paths.append(path)
        df.write.mode("errorifexists").options(**self.options).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def write_by_task(self, df: DataFrame, label: str, tag: str, buckets: int) -> DataFrame:
        """Write ``df`` once as :meth:`write` does, in buckets of the task that wrote a row.

        ``tag`` is a row tag (see :mod:`lamina.operators.numbering`); column ``_task`` is added.
        Nothing is shuffled for it, a task's rows are a file of one bucket, and Spark knows the
        layout: what is brought to ``buckets`` partitions by ``_task`` meets these rows where they lie,
        also in a join by task and tag, once the session allows joins whose sides lie together by some of
        their keys; that is a matter of planning, and set here.
        """
        self.spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
        name = f"lamina_{uuid.uuid4().hex}"
        path = os.path.join(shared_folder(self.spark), "lamina", f"{label}-{name}")
        self.paths.append(path)
        self.tables.append(name)
        tasks = df.withColumn(TASK, F.shiftright(F.col(tag), TASK_BITS))
        writer = tasks.write.mode("errorifexists").bucketBy(buckets, TASK)
        writer.option("path", path).saveAsTable(name)
        return self.spark.table(name)

    def release(self) -> None:
        """Delete the written tables. Whatever still reads them must have run."""
        for name in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.tables.clear()
        conf = self.spark._jsc.hadoopConfiguration()
        for path in self.paths:
            place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(conf).delete(place, True)
        self.paths.clear()


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder, where it stays as long as the folder does."""
    return Staging(df.sparkSession).write(df, label)
