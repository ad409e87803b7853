"""An index of chunks: keyed changes as functions from a frame to a frame, and versions on disk."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire import schemas


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], schemas.INDEX)


def lacks_vector() -> Column:
    return F.col("embeddings").isNull() | (F.size("embeddings") == 0)


def fetch(index: DataFrame, fragment_id: str) -> DataFrame:
    return index.filter(F.col("fragment_id") == fragment_id)


def fetch_existing(index: DataFrame, fragment_id: str) -> DataFrame:
    """As :func:`fetch`, but an id that isn't there is an error, found by a first look at the index."""
    found = fetch(index, fragment_id)
    if found.isEmpty():
        raise KeyError(fragment_id)
    return found


def fetch_content(index: DataFrame, fragment_id: str) -> DataFrame:
    return fetch(index, fragment_id).select("content")


def multi_get(index: DataFrame, ids: DataFrame) -> DataFrame:
    """``ids`` (position, fragment_id) with what the index has of them; nulls for those it hasn't."""
    return ids.join(index, "fragment_id", "left")


def pending(index: DataFrame, most: int = 1000) -> DataFrame:
    """Rows without a vector, ``most`` at a time, in the order of their ids."""
    return index.filter(lacks_vector()).orderBy("fragment_id").limit(most)


def pending_count(index: DataFrame) -> DataFrame:
    return index.agg(F.count_if(lacks_vector()).alias("pending"), F.count("*").alias("total"))


def _last(rows: DataFrame, order: str | None) -> DataFrame:
    """One row for each fragment_id: the last by ``order``, and among those the one of the greatest hash, so that reruns agree."""
    newest = Window.partitionBy("fragment_id").orderBy(*([F.desc(order)] if order else []), F.desc(F.xxhash64(*rows.columns)))
    return rows.withColumn("_nr", F.row_number().over(newest)).filter("_nr = 1").drop("_nr")


def upsert(index: DataFrame, rows: DataFrame, order: str | None = None) -> DataFrame:
    """Whole rows in place of those of the same id; of new rows of one id the last by ``order`` stays. A row without ``embeddings`` has none."""
    if "embeddings" not in rows.columns:
        rows = rows.withColumn("embeddings", F.lit(None).cast(index.schema["embeddings"].dataType))
    rows = _last(rows, order).select(*index.columns)
    return index.join(rows, "fragment_id", "left_anti").select(*index.columns).unionByName(rows)


def insert_with_vectors(index: DataFrame, rows: DataFrame, embed: Callable[[DataFrame], DataFrame], order: str | None = None) -> DataFrame:
    """:func:`upsert` of rows to which ``embed`` adds ``embeddings``, made from their contents."""
    return upsert(index, embed(rows), order)


def add_vectors(index: DataFrame, vectors: DataFrame, order: str | None = None) -> DataFrame:
    """The index with ``embeddings`` of ``vectors`` (fragment_id, embeddings) where it has some; of several for one id the last by ``order``."""
    new = _last(vectors, order).select("fragment_id", F.col("embeddings").alias("_new"))
    return index.join(new, "fragment_id", "left").withColumn("embeddings", F.coalesce("_new", "embeddings")).select(*index.columns)


def bulk_add_vectors(index: DataFrame, embed: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The index with vectors that ``embed`` makes for all rows that lack one: one pass leaves none pending that it can embed.

    A service that takes so many rows a call gets them in batches inside ``embed``, task by task.
    """
    return add_vectors(index, embed(index.filter(lacks_vector()).select("fragment_id", "content")))


def update_content(index: DataFrame, updates: DataFrame, order: str | None = None) -> DataFrame:
    """Content and vector of ``updates`` (fragment_id, content, embeddings), of several for one id the last by ``order``; metadata stays as it was."""
    new = _last(updates, order).select("fragment_id", F.col("content").alias("_text"), F.col("embeddings").alias("_new"), F.lit(True).alias("_hit"))
    rows = index.join(new, "fragment_id", "left")
    hit = F.coalesce("_hit", F.lit(False))
    return rows.withColumn("content", F.when(hit, F.col("_text")).otherwise(F.col("content"))).withColumn("embeddings", F.when(hit, F.col("_new")).otherwise(F.col("embeddings"))).select(*index.columns)


def delete(index: DataFrame, fragment_id: str) -> DataFrame:
    return index.filter(~F.col("fragment_id").eqNullSafe(fragment_id))


def delete_page(index: DataFrame, page: int) -> DataFrame:
    """Without the rows of that page, of all documents."""
    return index.filter(~F.col("metadata.page").eqNullSafe(page))


def delete_pending(index: DataFrame) -> DataFrame:
    return index.filter(~lacks_vector())


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return jvm.org.apache.hadoop.fs.Path, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def newest(spark: SparkSession, path: str) -> str | None:
    """The last whole version under ``path``: one whose mark is there."""
    _, fs, where = _files(spark, path)
    names = [x.getPath().getName() for x in fs.listStatus(where)] if fs.exists(where) else []
    marks = sorted(n for n in names if n.startswith("v-") and n.endswith(".done"))
    return f"{path}/{marks[-1].removesuffix('.done')}" if marks else None


def save(index: DataFrame, path: str) -> str:
    """A new version beside those that may still be read; returns its path. Its mark is written last. One writer at a time."""
    spark = index.sparkSession
    last = newest(spark, path)
    number = int(last.rsplit("/v-", 1)[1].split("-")[0]) + 1 if last else 0
    version = f"{path}/v-{number:012d}-{uuid.uuid4().hex}"
    index.write.parquet(version)
    at, fs, _ = _files(spark, path)
    fs.create(at(version + ".done")).close()
    return version


def load(spark: SparkSession, version: str) -> DataFrame:
    return spark.read.schema(schemas.INDEX).parquet(version)


def drop(spark: SparkSession, path: str) -> bool:
    """Removes all versions under ``path``."""
    _, fs, where = _files(spark, path)
    return fs.delete(where, True)
