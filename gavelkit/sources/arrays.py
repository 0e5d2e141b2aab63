"""Files that hold one JSON array each, read in parallel and written with commit messages.

Spark's text reader cuts a file at closing braces, so that a big array is read in as many tasks as it has splits. What a piece
does to the state of a scan (inside a string or not, depth of brackets) is a column expression, for either state it may begin
in. A first pass folds the pieces of each split, a running sum over the splits of a file gives each split its state and the
number of its first record, and a second pass cuts the records. Texts of records move only where a record spans splits.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from gavelkit.session import mounted, store_of


def _pieces(spark: SparkSession, path: str, glob: str | None) -> DataFrame:
    """file, block (where its split begins), piece, and what the piece with its brace does: turn, out (begun outside a string), in."""
    reader = spark.read.option("lineSep", "}")
    files = (reader.option("pathGlobFilter", glob) if glob else reader).text(path)
    bare = F.regexp_replace("value", r"(?s)\\.", "")
    parts = F.split(F.regexp_replace(bare, r'[^"\[\]{}]', ""), '"', -1)
    rows = files.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("piece"), parts.alias("parts"))
    turn = (F.size("parts") - 1) % 2

    def change(begun: int) -> Column:
        seen = F.array_join(F.filter("parts", lambda _, i: i % 2 == begun), "")
        return F.length(F.translate(seen, "]}", "")) - F.length(F.translate(seen, "[{", "")) - (turn == begun).cast("int")

    return rows.select("file", "block", "piece", turn.alias("turn"), change(0).alias("out"), change(1).alias("in"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], slice]]:
    """The stretches of a batch that are of one split."""
    file, block = np.array(batch.column("file").to_pylist(), object), batch.column("block").to_numpy()
    at = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
    for a, b in zip([0, *at], [*at, len(block)], strict=True):
        if a < b:
            yield (file[a], int(block[a])), slice(int(a), int(b))


def _walk(turn: np.ndarray, out: np.ndarray, in_: np.ndarray, inside: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """After each piece: whether the scan is inside a string, and the depth."""
    after = (inside + np.cumsum(turn)) % 2
    before = (after + turn) % 2
    return after, depth + np.cumsum(np.where(before == 1, in_, out))


def _split_states(pieces: DataFrame) -> DataFrame:
    """A row for each split: what it does to either state, and how many outer braces it has at each relative depth."""
    kind = "file string, block bigint, pieces bigint, turn bigint, opens boolean, closes boolean, out bigint, `in` bigint, d0 array<bigint>, n0 array<bigint>, d1 array<bigint>, n1 array<bigint>"
    lists = pa.list_(pa.int64())
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("pieces", pa.int64()), ("turn", pa.int64()), ("opens", pa.bool_()), ("closes", pa.bool_()), ("out", pa.int64()), ("in", pa.int64()), ("d0", lists), ("n0", lists), ("d1", lists), ("n1", lists)])

    def row(key: tuple[str, int], s: dict) -> pa.RecordBatch:
        found = {f"{k}{b}": list(getattr(s["ends"][b], v)()) for b in (0, 1) for k, v in (("d", "keys"), ("n", "values"))}
        flat = {"file": key[0], "block": key[1], "pieces": s["pieces"], "turn": s["inside"][0], "opens": s["opens"], "closes": s["closes"], "out": s["depth"][0], "in": s["depth"][1]}
        return pa.RecordBatch.from_pylist([flat | found], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, s = None, {}
        for batch in batches:
            turn, out, in_ = (batch.column(k).to_numpy().astype(np.int64) for k in ("turn", "out", "in"))
            for now, at in _runs(batch):
                if now != key:
                    if key:
                        yield row(key, s)
                    key, s = now, {"pieces": 0, "inside": [0, 1], "depth": [0, 0], "ends": [{}, {}], "opens": batch.column("opens")[at.start].as_py()}
                for b in (0, 1):
                    inside, depth = _walk(turn[at], out[at], in_[at], s["inside"][b], s["depth"][b])
                    for d, n in zip(*np.unique(depth[inside == 0], return_counts=True), strict=True):
                        s["ends"][b][int(d)] = s["ends"][b].get(int(d), 0) + int(n)
                    s["inside"][b], s["depth"][b] = int(inside[-1]), int(depth[-1])
                s["pieces"] += at.stop - at.start
                s["closes"] = batch.column("closes")[at.stop - 1].as_py()
        if key:
            yield row(key, s)

    text = F.regexp_replace("piece", r"^\s+|\s+$", "")
    shown = pieces.select("file", "block", "turn", "out", "in", text.startswith("[").alias("opens"), text.endswith("]").alias("closes"))
    return shown.mapInArrow(run, kind)


def _begins(splits: DataFrame) -> DataFrame:
    """file, block, pieces, and the state each split begins in: inside, depth, base (records that end before it). Only files that are one array.

    The piece after the last brace has none, but was counted with one, so a whole array ends at depth -1.
    """
    rows = Window.partitionBy("file").orderBy("block")
    before, whole = rows.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("file")
    past = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    out = splits.withColumn("inside", past("turn") % 2)
    out = out.withColumn("change", F.when(F.col("inside") == 1, F.col("in")).otherwise(F.col("out")))
    out = out.withColumn("depth", past("change"))
    ends = F.when(F.col("inside") == 1, F.map_from_arrays("d1", "n1")).otherwise(F.map_from_arrays("d0", "n0"))
    out = out.withColumn("ends", F.coalesce(F.try_element_at(ends, 1 - F.col("depth")), F.lit(0)))
    good = (F.sum("change").over(whole) == -1) & (F.sum("turn").over(whole) % 2 == 0) & F.min_by("opens", "block").over(whole) & F.max_by("closes", "block").over(whole)
    return out.select("file", "block", "pieces", "inside", "depth", past("ends").alias("base"), good.alias("good"))


def _cut(pieces: DataFrame, begins: DataFrame, spanning: bool) -> DataFrame:
    """file, pos, block, text, ended: the records that lie in one split, or (``spanning``) the parts of the others."""
    schema = pa.schema([("file", pa.string()), ("pos", pa.int64()), ("block", pa.int64()), ("text", pa.string()), ("ended", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, seen, want, kept, inside, depth, pos, part = None, 0, 0, [], 0, 0, 0, False

        def close() -> list:
            if key and seen != want:
                raise ValueError(f"{key[0]} was split in another way in the second pass; set spark.sql.files.minPartitionNum and run again")
            return [(*key[:1], pos, key[1], "}".join([*kept, ""]), False)] if key and kept and spanning else []

        for batch in batches:
            rows = []
            turn, out, in_ = (batch.column(k).to_numpy().astype(np.int64) for k in ("turn", "out", "in"))
            for now, at in _runs(batch):
                if now != key:
                    rows += close()
                    first = {k: batch.column(k)[at.start].as_py() for k in ("good", "pieces", "inside", "depth", "base")}
                    if first["good"] is None:
                        raise ValueError(f"{now[0]} was split in another way in the second pass; set spark.sql.files.minPartitionNum and run again")
                    key, seen, want, kept, good = now, 0, first["pieces"], [], first["good"]
                    inside, depth, pos = first["inside"], first["depth"], first["base"]
                    part = bool(inside) or depth > 1
                seen += at.stop - at.start
                if not good:
                    continue
                text = batch.column("piece").slice(at.start, at.stop - at.start).to_pylist()
                after, deep = _walk(turn[at], out[at], in_[at], inside, depth)
                a = 0
                for b in np.flatnonzero((after == 0) & (deep == 1)):
                    if part == spanning:
                        rows.append((key[0], pos, key[1], "}".join([*kept, *text[a : b + 1], ""]), True))
                    kept, part, a, pos = [], False, int(b) + 1, pos + 1
                kept += text[a:]
                inside, depth = int(after[-1]), int(deep[-1])
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
        if rows := close():
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    # one small row a split, of which the planner of the scan already holds a larger one; a broadcast keeps the pieces in order
    return pieces.join(F.broadcast(begins), ["file", "block"], "left").mapInArrow(run, "file string, pos bigint, block bigint, text string, ended boolean")


def scan_arrays(spark: SparkSession, path: str, schema: StructType | str, glob: str | None = None) -> DataFrame:
    """file, pos and record (a struct of ``schema``) of the objects that stand directly in the arrays of the files.

    A file that isn't one array, or breaks off, gives no rows; so does an empty one. Elements that are no objects are left out
    and take no place. An object in a whole array that can't be parsed keeps its place and has null fields. A brace too many as
    the very last byte goes unnoticed. Repeated objects each give a row. A record of any length is one task's work.
    """
    pieces = _pieces(spark, path, glob)
    begins = _begins(_split_states(pieces))
    parts = _cut(pieces, begins, True).groupBy("file", "pos").agg(F.sort_array(F.collect_list(F.struct("block", "text"))).alias("parts"), F.bool_or("ended").alias("ended"))
    joined = parts.where("ended").select("file", "pos", F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"))
    every = _cut(pieces, begins, False).select("file", "pos", "text").unionByName(joined)
    return every.select("file", "pos", F.from_json(F.regexp_replace("text", r"^[^{]*", ""), schema).alias("record"))


class _Written(WriterCommitMessage):
    def __init__(self, files: list[tuple[str, str]]) -> None:
        self.files = files


class _ArrayWriter(DataSourceWriter):
    def __init__(self, folder: str) -> None:
        self.folder = folder

    def _at(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.folder)

    def write(self, iterator: Iterator[Row]) -> _Written:
        store, root = self._at()
        store.create_dir(root, recursive=True)
        done, name, sink = [], None, None
        try:
            for row in iterator:
                if row[0] != name:
                    if sink:
                        sink.write(b"\n]\n")
                        sink.close()
                    name = row[0]
                    done.append((f"{root}/_{uuid.uuid4().hex}", f"{root}/{name}.json"))
                    sink = store.open_output_stream(done[-1][0], buffer_size=1 << 20)
                    sink.write(b"[\n")
                else:
                    sink.write(b",\n")
                sink.write(row[1].encode())
            if sink:
                sink.write(b"\n]\n")
                sink.close()
        except BaseException:
            if sink and not sink.closed:
                sink.close()
            self._drop(store, done)
            raise
        return _Written(done)

    def _drop(self, store: fs.FileSystem, files: list[tuple[str, str]]) -> None:
        for made, _ in files:
            if store.get_file_info(made).type == fs.FileType.File:
                store.delete_file(made)

    def commit(self, messages: list[_Written | None]) -> None:
        store, _ = self._at()
        for made, final in (f for m in messages if m for f in m.files):
            store.move(made, final)

    def abort(self, messages: list[_Written | None]) -> None:
        store, _ = self._at()
        for m in messages:
            if m:
                self._drop(store, m.files)


class ArrayFiles(DataSource):
    """A sink for rows (name, record as JSON text) that lie by name: one array file for each name, in place once all are written."""

    @classmethod
    def name(cls) -> str:
        return "array_files"

    def schema(self) -> str:
        return "name string, record string"

    def writer(self, schema: StructType, overwrite: bool) -> _ArrayWriter:
        return _ArrayWriter(self.options["path"])


def write_arrays(rows: DataFrame, name: str, order: list[str], folder: str) -> None:
    """One array file for each value of ``name`` (those without a name go to none, so they are refused), objects in the given order.

    A file has one writer, which streams its sorted rows; a file of that name is replaced, others stay. The folder must be one
    that all executors reach. On a mounted file system the tasks write the files; in a store that only Spark reaches, Spark's
    text writer does, and the files get their names once all are written.
    """
    spark = rows.sparkSession
    named = F.when(F.col(name).isNull(), F.raise_error("a row has no file name")).otherwise(F.col(name).cast("string"))
    body = F.to_json(F.struct(*[c for c in rows.columns if c not in (name, *order)]))
    if at := mounted(spark, folder):
        spark.dataSource.register(ArrayFiles)
        laid = rows.repartition(name).sortWithinPartitions(name, *order)
        laid.select(named.alias("name"), body.alias("record")).write.format("array_files").option("path", at).mode("append").save()
        return
    # rows lie by the very column that Spark deals out to files, so it sorts them no more
    kept = rows.select(F.concat(F.lit("="), named).alias("name"), body.alias("record"), F.struct(*order).alias("at"))
    place = Window.partitionBy("name").orderBy("at")
    begins, ends = F.lag("at").over(place).isNull(), F.lead("at").over(place).isNull()
    line = F.concat(F.when(F.col("begins"), "[\n").otherwise(""), "record", F.when(F.col("ends"), "\n]").otherwise(","))
    _write_named(kept.select("name", "record", begins.alias("begins"), ends.alias("ends")).select("name", line.alias("line")), folder)


def _write_named(lines: DataFrame, folder: str) -> None:
    """Write lines, whose rows lie by ``name`` and in order, with one file for each name."""
    spark, staged = lines.sparkSession, f"{folder.rstrip('/')}/_{uuid.uuid4().hex}"
    store, root = store_of(spark, folder)
    path = spark._jvm.org.apache.hadoop.fs.Path
    try:
        writer = lines.write.partitionBy("name").option("lineSep", "\n").option("maxRecordsPerFile", 0).option("compression", "none")
        writer.text(staged)
        made = {}
        for part in store.listStatus(store_of(spark, staged)[1]):
            if part.isDirectory():
                inside, = (f.getPath() for f in store.listStatus(part.getPath()) if f.getPath().getName().startswith("part-"))
                made[inside] = path(root, unquote(part.getPath().getName()).removeprefix("name==") + ".json")
        for inside, final in made.items():
            store.delete(final, False)
            if not store.rename(inside, final):
                raise OSError(f"{final.toString()} can't be put in place")
    finally:
        store.delete(store_of(spark, staged)[1], True)
