"""Recognised pages: stored recognition results, and pages composed from plain documents.

``lines``: item_id, page, ocr_seq, content, ocr_confidence, x1, y1, x2, y2.
``blocks``: item_id, page, block_idx, label, content, confidence, x1, y1, x2, y2.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire import schemas


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_ocr(spark: SparkSession, path: str) -> DataFrame:
    """Stored recognition results, a JSON object a page."""
    return spark.read.schema(schemas.OCR_PAGES).json(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return usable_blocks(spark.read.schema(schemas.LAYOUT_BLOCKS).json(path))


def usable_blocks(blocks: DataFrame) -> DataFrame:
    """Blocks with a box and a label; content and confidence have defaults."""
    boxed = F.col("x1").isNotNull() & F.col("y1").isNotNull() & F.col("x2").isNotNull() & F.col("y2").isNotNull()
    return blocks.filter(boxed & F.col("label").isNotNull()).fillna({"content": "", "confidence": 0.0})


def ocr_lines(pages: DataFrame) -> DataFrame:
    """A row for each recognised line; the arrays are cut to the shortest."""
    n = F.least(F.size("rec_texts"), F.size("rec_scores"), F.size("rec_boxes"))
    zipped = F.slice(F.arrays_zip("rec_texts", "rec_scores", "rec_boxes"), F.lit(1), F.greatest(n, F.lit(0)))
    rows = pages.filter(F.col("rec_texts").isNotNull()).select("item_id", "page", F.posexplode(zipped).alias("ocr_seq", "r"))
    box = F.col("r.rec_boxes")
    return rows.select("item_id", "page", "ocr_seq", F.col("r.rec_texts").alias("content"), F.col("r.rec_scores").alias("ocr_confidence"), *[F.get(box, F.lit(i)).alias(c) for i, c in enumerate(("x1", "y1", "x2", "y2"))])


def page_lines(documents: DataFrame) -> DataFrame:
    """Lines of documents set on pages of 25 by integer arithmetic, in an order of their own."""
    rows = documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("ln", "content"))
    rows = rows.select(F.col("doc_id").cast("string").alias("item_id"), "doc_id", "ln", F.expr("cast(ln div 25 as int)").alias("page"), (F.col("ln") % 25).alias("ocr_seq"), "content")
    slot = (F.col("ocr_seq") * 7) % 25
    x1 = (60 + 10 * (F.col("doc_id") % 3)).cast("int")
    y1 = 60 + 28 * slot
    return rows.select(
        "item_id", "page", "ocr_seq", "content",
        ((80 + (F.col("doc_id") * 31 + F.col("ln") * 17) % 20).cast("double") / 100).alias("ocr_confidence"),
        x1.alias("x1"), y1.alias("y1"), (x1 + F.least(F.lit(450), 6 * F.length("content"))).cast("int").alias("x2"), (y1 + F.when(slot % 5 == 0, 26).otherwise(14)).alias("y2"),
    )


def page_blocks(documents: DataFrame) -> DataFrame:
    """Layout blocks of the same pages: five pairs of a heading (not all) and a body."""
    pages = documents.filter(F.col("text").isNotNull()).select("doc_id", F.explode(F.expr("sequence(0, cast((size(split(text, '\\n')) - 1) div 25 as int))")).alias("page"))
    rows = pages.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(4))))
    kinds = F.array(*map(F.lit, ("doc_title", "title", "header", "paragraph_title", "footer")))
    bodies = F.array(*map(F.lit, ("text", "figure", "table", "chart", "text")))
    top = 60 + 140 * F.col("b")
    head = F.struct((2 * F.col("b")).alias("block_idx"), F.get(kinds, ((7 * F.col("doc_id") + 3 * F.col("page") + F.col("b") * F.col("b")) % 5).cast("int")).alias("label"), (top - 4).alias("y1"), (top + 30).alias("y2"))
    body = F.struct((2 * F.col("b") + 1).alias("block_idx"), F.get(bodies, F.col("b")).alias("label"), (top + 24).alias("y1"), (top + 130).alias("y2"))
    rows = rows.select("doc_id", "page", F.explode(F.when((F.col("doc_id") + F.col("b")) % 4 == 0, F.array(body)).otherwise(F.array(head, body))).alias("k"))
    return rows.select(F.col("doc_id").cast("string").alias("item_id"), "page", "k.block_idx", "k.label", F.lit("").alias("content"), F.lit(0.9).alias("confidence"), F.lit(50).alias("x1"), "k.y1", F.lit(560).alias("x2"), "k.y2")
