"""Reading and writing the stores, snapshots, logs and reports."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from gavelkit.operators.store import store_order, with_auction_key, with_listing_key
from gavelkit.schemas import AUCTION, SIGHTING, STATS, conform
from gavelkit.sources.arrays import scan_arrays


def scan_json_array(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The objects of a JSON array file, read in as many tasks as it has splits; no rows if the file is missing, broken or no array."""
    try:
        return scan_arrays(spark, path, schema).select("record.*")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _store_shape(schema: StructType) -> StructType:
    """The shape of a store file, where tags are one joined text and numbers may be text."""
    return StructType([StructField(f.name, StringType()) for f in schema.fields])


def scan_store(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A store file in its table shape. Rows without an id get the key of their fields."""
    raw = scan_json_array(spark, path, _store_shape(schema))
    keyed = (with_auction_key if schema is AUCTION else with_listing_key)(raw.withColumnRenamed("id", "_given"))
    keyed = keyed.withColumn("id", F.coalesce(F.nullif("_given", F.lit("")), F.col("id"))).drop("_given")
    tags = F.filter(F.split(F.coalesce("tags", F.lit("")), "; "), lambda t: t != "")
    return conform(keyed.withColumn("tags", tags), schema)


_PIECES = _store_shape(StructType([f for f in SIGHTING.fields if f.name not in ("date_pulled", "pos")]))


def scan_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """All dated snapshot files of a folder; the date is the file name, the array position is kept. Big files are read in several tasks."""
    rows = scan_arrays(spark, folder, _PIECES, "*.json")
    return conform(rows.select(F.regexp_extract("file", r"([^/]*)\.json$", 1).alias("date_pulled"), "pos", "record.*"), SIGHTING)


def scan_series(spark: SparkSession, path: str) -> DataFrame:
    """The statistics series; rows of older runs lack newer columns."""
    return scan_json_array(spark, path, STATS)


# --- exports ---------------------------------------------------------------------
def _export_shape(store: DataFrame) -> DataFrame:
    """Every column as an export shows it: lists joined, missing values empty."""
    out = []
    for f in store.schema.fields:
        c = F.array_join(f.name, "; ") if f.dataType.simpleString() == "array<string>" else F.col(f.name).cast("string")
        out.append(F.coalesce(c, F.lit("")).alias(f.name))
    return store.select(*out)


def write_csv(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header; a value is quoted only if it must be, quotes are doubled."""
    writer = rows.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
    writer.option("emptyValue", "").option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)


def read_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    schema = StructType([StructField(c, StringType()) for c in columns])
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def write_store(store: DataFrame, price: str, json_path: str, csv_path: str) -> int:
    """Both exports of a store, most expensive first. Returns the number of records.

    The count is taken while writing, not in another pass.
    """
    from pyspark.sql import Observation

    seen = Observation()
    ordered = store_order(store, price).observe(seen, F.count(F.lit(1)).alias("n"))
    ordered.write.mode("overwrite").option("ignoreNullFields", False).json(json_path)
    write_csv(_export_shape(store_order(store, price)), csv_path)
    return seen.get["n"]


def append_log(rows: DataFrame, path: str) -> None:
    """Append sightings to the raw log, one folder per date."""
    rows.write.mode("append").partitionBy("date_pulled").parquet(path)


def write_snapshot(rows: DataFrame, path: str) -> None:
    """Write the snapshot of a date; an earlier one of the same date is replaced, others stay."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date_pulled").parquet(path)


def write_report(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_digest(lines: DataFrame, folder: str, run_date: str) -> None:
    """The digest of a run under its date and as the latest one. A digest has a few hundred lines."""
    ordered = lines.orderBy("section_no", "part", "rank", "tie").select("line").coalesce(1)
    for name in (run_date, "latest"):
        ordered.write.mode("overwrite").text(f"{folder}/{name}")


def pair_report(pairs: DataFrame, members: DataFrame, fields: list[str]) -> DataFrame:
    """Pairs with the details of both sides as nested structs."""
    side = lambda n: members.select(F.col("id").alias(f"id_{n}"), F.struct(*fields).alias(n))
    return pairs.join(side("a"), "id_a").join(side("b"), "id_b")


# --- versioned store ----------------------------------------------------------------
class VersionedStore:
    """A store kept as numbered versions; a version is never changed once it is written.

    A version is a bucketed table: rows are hashed by id into a fixed number of files. A merge
    therefore shuffles only the new batch, never the store. The current version is the highest
    one whose write ended, so a lost job leaves no half-written state behind.
    """

    def __init__(self, spark: SparkSession, name: str, folder: str, schema: StructType, buckets: int = 64) -> None:
        self.spark, self.name, self.folder, self.schema, self.buckets = spark, name, folder.rstrip("/"), schema, buckets

    def _path(self, version: int, tag: str = "") -> str:
        return f"{self.folder}/{self._written().get(version) or f'v={version:010d}' + (f'.{tag}' if tag else '')}"

    def versions(self) -> list[int]:
        return sorted(self._written())

    def tags(self) -> set[str]:
        """Names of the batches that versions were written for."""
        return {label.partition(".")[2] for label in self._written().values()} - {""}

    def _written(self) -> dict[int, str]:
        """Folder names of the versions whose write ended."""
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.folder)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return {}
        done = {}
        for status in fs.listStatus(root):
            label = status.getPath().getName()
            marker = jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
            if label.startswith("v=") and fs.exists(marker):
                done[int(label[2:].partition(".")[0])] = label
        return done

    def read(self, version: int | None = None) -> DataFrame:
        done = self.versions()
        if not done:
            return self.spark.createDataFrame([], self.schema)
        at = done[-1] if version is None else version
        table = f"{self.name}_v{at}"
        if not self.spark.catalog.tableExists(table):
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
            self.spark.sql(
                f"CREATE TABLE {table} ({cols}) USING parquet CLUSTERED BY (id) SORTED BY (id) INTO {self.buckets} BUCKETS "
                f"LOCATION '{self._path(at)}'"
            )
        return self.spark.table(table)

    def write(self, rows: DataFrame, version: int, tag: str = "") -> None:
        """Write a version, for the batch ``tag``; a version that exists is left as it is."""
        if version in self.versions():
            return
        table = f"{self.name}_v{version}"
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        (
            rows.select(*self.schema.fieldNames())
            .repartition(self.buckets, "id")
            .write.format("parquet").mode("overwrite").bucketBy(self.buckets, "id").sortBy("id")
            .option("path", self._path(version, tag)).saveAsTable(table)
        )


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def rebuild(store: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """The whole store with derived columns computed again, after a rule has changed."""
    return store.withColumns(columns)
