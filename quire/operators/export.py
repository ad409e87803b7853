"""Chunks and pages as JSON and Markdown."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.text import label_colour


def chunk_json(chunks: DataFrame) -> DataFrame:
    """item_id, page, chunk_no, json: nulls are written, other scripts aren't escaped."""
    return chunks.select("item_id", "page", "chunk_no", F.to_json(F.struct("fragment_id", "content", "metadata"), {"ignoreNullFields": "false"}).alias("json"))


def write_chunks(chunks: DataFrame, path: str) -> DataFrame:
    """JSON lines under ``path``/chunks, and the totals (also returned) under ``path``/summary."""
    chunks.orderBy("item_id", "page", "chunk_no").select("fragment_id", "content", "metadata").write.option("ignoreNullFields", "false").json(f"{path}/chunks")
    rows = chunks.sparkSession.read.schema(chunks.select("metadata").schema).json(f"{path}/chunks")
    totals = rows.agg(F.count("*").alias("total_chunks"), F.array_sort(F.collect_set("metadata.type")).alias("chunk_types"))
    totals.write.json(f"{path}/summary")
    return totals


def write_pages(rows: DataFrame, path: str) -> None:
    """A folder of JSON for each page."""
    rows.write.partitionBy("page").json(path)


def structure_boxes(blocks: DataFrame) -> DataFrame:
    """What is drawn for each block: its box, a caption of label and confidence, and the colour of its label."""
    caption = F.format_string("%s (%.2f)", F.col("label"), F.col("confidence"))
    rgb = label_colour("label")
    return blocks.select("item_id", "page", "block_idx", "x1", "y1", "x2", "y2", caption.alias("caption"), *[F.get(rgb, F.lit(i)).alias(c) for i, c in enumerate(("red", "green", "blue"))])


def markdown(tree: DataFrame) -> DataFrame:
    """item_id, page, markdown: headings by level, other elements as paragraphs, in reading order."""
    line = F.when(F.col("level") < 5, F.concat(F.repeat(F.lit("#"), F.col("level")), F.lit(" "), "content")).otherwise(F.col("content"))
    rows = tree.groupBy("item_id", "page").agg(F.array_sort(F.collect_list(F.struct("id", line.alias("line")))).alias("xs"))
    return rows.select("item_id", "page", F.expr("array_join(transform(xs, x -> x.line), '\\n\\n')").alias("markdown"))


def document_markdown(tree: DataFrame, separator: str = "---") -> DataFrame:
    """item_id, markdown: an item's pages in order, with a separator line between pages. Pages without elements are not there."""
    pages = markdown(tree).groupBy("item_id").agg(F.array_sort(F.collect_list(F.struct("page", "markdown"))).alias("pages"))  # one item's text
    return pages.select("item_id", F.array_join("pages.markdown", f"\n\n{separator}\n\n").alias("markdown"))
