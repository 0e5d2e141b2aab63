"""Session set-up and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "gavelkit", **conf: str) -> SparkSession:
    """A session with UTC dates, AQE and skew-join handling switched on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A local session without that setting gets its own temporary folder once.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = os.environ.get("GAVELKIT_LOCAL_DIR")
    if not folder:
        folder = tempfile.mkdtemp(prefix="gavelkit-")
        os.environ["GAVELKIT_LOCAL_DIR"] = folder
    return folder


def work_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/gavelkit/{label}-{uuid.uuid4().hex}"


def store_of(spark: SparkSession, path: str):
    """Spark's file system of ``path``, and the path with that file system's name, which a name without a scheme leaves out."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return store, store.makeQualified(at)


def mounted(spark: SparkSession, path: str) -> str | None:
    """The plain path of a place that Python in a task can open (``file:``); None for one in a store that only Spark reaches."""
    uri = store_of(spark, path)[1].toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def pinned(df: DataFrame, label: str = "pin") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    This cuts the lineage (executors may be lost at any time), and it gives the
    planner the real size: a later join broadcasts the table only when its files
    are below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles.
    """
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, rows: int | None = None, by: str | None = None) -> DataFrame:
    """Use all cores for per-row work on an input that is read in fewer splits than there are cores, or in uneven ones.

    A file is cut by bytes but read by row groups, so some splits may hold all rows; they are counted, which reads file
    footers only. With ``rows``, for work that takes much time or memory a row, a task gets about that many at most. A big
    input that is read evenly is returned as it is, without a shuffle. ``by`` keeps rows of near values together.
    """
    deal = lambda n: df.repartitionByRange(n, by) if by else df.repartition(n)
    cores, splits = df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()
    if splits < cores and rows is None:
        return deal(cores)
    held = df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"))
    total, fullest = held.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    wanted = max(cores, -(-total // rows) if rows else 0)
    return df if splits >= cores and fullest * wanted <= 2 * total else deal(wanted)
