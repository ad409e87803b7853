"""What the operators share: inputs, cutting lineage, words, bounded samples."""

from __future__ import annotations

import ctypes
import re
import sys
import types
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, as Java regular expression and as a set of characters to trim.
SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Only where both are one process may the session name none."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return "file:///tmp/checkpoints"


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def cut(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: later jobs, and retries after a lost executor, start from the files.

    They go when the driver ends, or with :func:`discard`.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    fs, at = _file_system(spark, path)
    fs.deleteOnExit(at)
    out = spark.read.schema(df.schema).parquet(path)
    out._quire_path = path
    return out


def discard(*frames: DataFrame) -> None:
    """Removes the files of frames made by :func:`cut`, which nothing reads any more."""
    for df in frames:
        fs, at = _file_system(df.sparkSession, df._quire_path)
        fs.delete(at, True)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is. The fast ``lower`` serves texts of ASCII alone."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def space_words(text: Column) -> Column:
    """Words between ASCII white space; none for null."""
    bare = F.trim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE))


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text is a multiple of 5. A null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def is_held_out(doc_id: int | None) -> bool:
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 5 == 0


def sampled(rows: DataFrame, label: str, per_class: int, key: str = "doc_id", seed: int = 17) -> DataFrame:
    """Near ``per_class`` rows of each value of ``label``, chosen by a hash of ``key``; all rows of a value that has fewer.

    One count by label (a row for each value) sets each value's share; no sort, no row moves.
    """
    counts = {r[label]: r["count"] for r in rows.groupBy(label).count().collect()}
    share = F.lit(0.0)
    for value, n in counts.items():
        share = F.when(F.col(label) == F.lit(value), min(1.0, per_class / n)).otherwise(share)
    at = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1 << 30)) / float(1 << 30)
    return rows.filter(at < share)


def worker_cache() -> dict:
    """A dictionary that lasts as long as the Python worker, over tasks."""
    module = sys.modules.setdefault("_quire_worker_cache", types.ModuleType("_quire_worker_cache"))
    return module.__dict__.setdefault("values", {})


def release() -> None:
    """Gives memory that was freed back to the system, so that a worker holds only what it uses."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def small_batches(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose ``column`` has about ``limit`` bytes, one row at least: bounds what a task makes of them.

    The batches that come are bounded by the session's spark.sql.execution.arrow.maxBytesPerBatch, 64 MB unless set.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        begin = total = 0
        for i, n in enumerate(sizes):
            if i > begin and total + n > limit:
                yield batch.slice(begin, i - begin)
                begin, total = i, 0
            total += n
        if begin < len(sizes):
            yield batch.slice(begin)
    release()


def texts(column: pa.Array) -> pa.Array:
    """A text column with empty strings for nulls."""
    return pc.fill_null(column, "")
