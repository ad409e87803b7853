"""Pages that arrive over time: an addition of this engine, beside the batch operators.

A page arrives whole, as one row of lines and blocks, so chunks need no state across batches;
each batch is chunked and put into the index: into the buckets of a store that it touches, or as a new version of a whole index.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quire.modes import ENHANCED, Mode
from quire.operators import index as index_ops
from quire.operators.chunk import chunks
from quire.operators.store import Store

LINE = "struct<ocr_seq:int,content:string,ocr_confidence:double,x1:int,y1:int,x2:int,y2:int>"
BLOCK = "struct<block_idx:int,label:string,content:string,confidence:double,x1:int,y1:int,x2:int,y2:int>"
PAGES = f"item_id string, page int, lines array<{LINE}>, blocks array<{BLOCK}>"


def page_rows(lines: DataFrame, blocks: DataFrame) -> DataFrame:
    """Lines and blocks as whole pages."""
    keys = ["item_id", "page"]
    a = lines.groupBy(*keys).agg(F.collect_list(F.struct(*[c for c in lines.columns if c not in keys])).alias("lines"))
    b = blocks.groupBy(*keys).agg(F.collect_list(F.struct(*[c for c in blocks.columns if c not in keys])).alias("blocks"))
    return a.join(b, keys, "left")


def page_chunks(pages: DataFrame, mode: Mode = ENHANCED) -> DataFrame:
    lines = pages.select("item_id", "page", F.explode("lines").alias("x")).select("item_id", "page", "x.*")
    blocks = pages.select("item_id", "page", F.explode("blocks").alias("x")).select("item_id", "page", "x.*")
    return chunks(lines, blocks, mode)


class VersionedIndex:
    """The newest version of an index under a path; what it is stands in the path alone, so a restart goes on from it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    @property
    def version(self) -> str | None:
        return index_ops.newest(self.spark, self.path)

    def frame(self) -> DataFrame:
        version = self.version
        return index_ops.load(self.spark, version) if version else index_ops.empty(self.spark)

    def change(self, how: Callable[[DataFrame], DataFrame]) -> None:
        index_ops.save(how(self.frame()), self.path)

    def put(self, rows: DataFrame, order: str | None = None, batch: tuple[str, int] | None = None) -> bool:
        """Upserts rows; a batch that comes again makes an equal version."""
        self.change(lambda index: index_ops.upsert(index, rows, order))
        return True


def query_id(spark: SparkSession, checkpoint: str | None) -> str | None:
    """The id that a stream keeps in its checkpoint."""
    if not checkpoint:
        return None
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def ingest(spark: SparkSession, source: str, target: VersionedIndex | Store, mode: Mode = ENHANCED, checkpoint: str | None = None) -> StreamingQuery:
    """Takes every page file that ``source`` has or gets, and puts its chunks into the index. A batch that comes again changes nothing."""
    stream = spark.readStream.schema(PAGES).parquet(source)

    def put(batch: DataFrame, number: int) -> None:
        rows = page_chunks(batch, mode).withColumn("place", F.struct("item_id", "page", "chunk_no")).select("fragment_id", "content", "metadata", "place")
        name = query_id(spark, checkpoint)
        target.put(rows, "place", (name, number) if name else None)  # of chunks of one id the last by place

    writer = stream.writeStream.foreachBatch(put).trigger(availableNow=True)
    return (writer.option("checkpointLocation", checkpoint) if checkpoint else writer).start()
