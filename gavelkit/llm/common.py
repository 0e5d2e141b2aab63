"""Helpers that several operators share."""

from __future__ import annotations

import contextlib
import ctypes
import re
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gavelkit.session import store_of

#: ASCII letters, the only ones that the word rules below change.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


ROWS = 256
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def arrow_rows(make: Callable[[], Callable[[str | None], tuple]], ddl: str, kind: pa.StructType):
    """A column function that turns each text into a struct.

    ``make`` runs once in a task and returns the function for one text. Rows go through in Arrow batches; the other
    columns of the table stay in the JVM. The function is marked as not deterministic only to keep the planner from
    running it again where its result is used twice.
    """

    @F.arrow_udf(ddl)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        one = make()
        names = [f.name for f in kind]
        for batch in batches:
            # a few rows at a time, so that results are Python objects only shortly
            parts = [pa.array([dict(zip(names, one(x.as_py()), strict=True)) for x in batch.slice(k, ROWS)], type=kind) for k in range(0, len(batch), ROWS)]
            yield pa.concat_arrays(parts) if parts else pa.array([], type=kind)
            del parts
            pa.default_memory_pool().release_unused()
        del one
        release()

    return run.asNondeterministic()


def release() -> None:
    """Give memory that a task has freed back to the system, so that a worker doesn't keep the most it ever held."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int = 500):
    """Inside, Arrow batches between Spark and Python hold up to ``rows`` rows; for rows that are large, such as sets of tokens."""
    before = int(spark.conf.get(_BATCH))
    with batches_of(spark, min(rows, before) if before > 0 else rows):
        yield


@contextlib.contextmanager
def batches_of(spark: SparkSession, rows: int):
    """Inside, Arrow batches between Spark and Python hold ``rows`` rows; for rows of a few numbers."""
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, rows)
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


def new_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    return stem if stem not in taken else f"{stem}_{uuid.uuid4().hex[:12]}"


#: The byte that ends each file of ``write_files``.
END = b"\0"


def write_files(contents: DataFrame, folder: str, suffix: str) -> list[str]:
    """Write the bytes of each row of the one column as a file below ``folder``; return their paths, in order of partitions and rows.

    Spark's text writer writes a row to a file, as it is and with ``END`` behind it, which is why contents must end with
    that byte. So the folder may be in any store that Spark reaches, also one that Python in a task can't open, and a name
    without a scheme means the same to all. Files are put in place once all are written; failed attempts leave none. The
    driver handles names only. A row is held whole, so a file should be some MB.
    """
    spark, column = contents.sparkSession, contents.columns[0]
    staged = f"{folder.rstrip('/')}/_{uuid.uuid4().hex}"
    ends = F.substring(column, -1, 1) == F.lit(END)
    bare = F.when(ends, F.substring(column, F.lit(1), F.octet_length(column) - 1)).otherwise(F.raise_error(F.lit("a file doesn't end with a zero byte")))
    writer = contents.select(bare.cast("string").alias("value")).write
    store, root = store_of(spark, folder)
    try:
        writer.option("lineSep", END.decode()).option("maxRecordsPerFile", 1).option("compression", "none").text(staged)
        made = [(re.match(r"part-(\d+)-.*-c(\d+)\.txt$", f.getPath().getName()), f) for f in store.listStatus(store_of(spark, staged)[1])]
        made = sorted((int(m[1]), int(m[2]), f.getPath()) for m, f in made if m and f.getLen())
        names = [spark._jvm.org.apache.hadoop.fs.Path(root, f"{k:06d}-{uuid.uuid4().hex}.{suffix}") for k in range(len(made))]
        with ThreadPoolExecutor(8) as pool:  # in some stores a rename takes long
            if not all(pool.map(store.rename, [path for _, _, path in made], names)):
                raise OSError(f"files in {staged} can't be put in place")
        return [name.toString() for name in names]
    finally:
        store.delete(store_of(spark, staged)[1], True)


def file_contents(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path and content of files in any store that Spark reaches, one row a file."""
    files = spark.read.format("binaryFile")
    return files.load(paths).select("path", "content") if paths else spark.createDataFrame([], "path string, content binary")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def marked(spots: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of fixed size, as 32-bit words, with the bits of the column ``spot`` set; one row a word comes to the driver."""
    marks = spots.select(F.shiftright("spot", 5).alias("word"), (F.col("spot") % 32).cast("int").alias("bit"))
    words = marks.groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("mask")).toArrow()
    bitmap = np.zeros(1 << (bits - 5), np.uint32)
    bitmap[words.column("word").to_numpy()] = words.column("mask").to_numpy().astype(np.uint32)
    return bitmap


def may_be_in(hashes: DataFrame, most: int = 24):
    """A column function of a 64-bit hash: true for all in the one column of ``hashes``, and for few others.

    It parts a large table without a shuffle into rows that a join may match and rows that it can't. The bitmap has about
    16 bits a hash and 2**most (2 MB) at most: beyond some millions of hashes it fills up, and only saves less.
    """
    bits = min(most, max(10, (16 * hashes.count()).bit_length()))
    spot = F.col(hashes.columns[0]).bitwiseAND(F.lit((1 << bits) - 1))
    bitmap = marked(hashes.select(spot.alias("spot")), bits)

    @F.arrow_udf("boolean")
    def may_be(h: pa.Array) -> pa.Array:
        at = h.to_numpy(zero_copy_only=False) & ((1 << bits) - 1)
        return pa.array((bitmap[at >> 5] >> (at & 31).astype(np.uint32) & 1).astype(bool))

    return may_be


class BoundedCache(dict):
    """A memo of at most ``limit`` entries: when it is full, the older half goes. It bounds a task's memory.

    A text of more than ``LONGEST`` characters is never kept, as it seldom comes again: so entries are bounded in bytes too.
    """

    LONGEST = 64

    def __init__(self, limit: int):
        super().__init__()
        self.limit = limit

    def keep(self, key, value):
        if isinstance(key, str) and len(key) > self.LONGEST:
            return value
        if len(self) >= self.limit:
            for old in list(islice(self, max(1, self.limit // 2))):
                del self[old]
        self[key] = value
        return value

    def keep_all(self, made: dict):
        """Keep many entries at once."""
        made = {k: v for k, v in made.items() if not (isinstance(k, str) and len(k) > self.LONGEST)}
        if len(self) + len(made) > self.limit:
            for old in list(islice(self, max(len(self) // 2, len(self) + len(made) - self.limit))):
                del self[old]
        self.update(islice(made.items(), self.limit))


def shown_bytes() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it is printable Latin-1, else one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}
