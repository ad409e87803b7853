"""Chunks of a page's elements: a greedy fold with bounds on tokens, and what a chunk says of itself.

A page is one row with its elements in an array, so folding, cutting and describing chunks need
one exchange, by page. The fold's state holds only where chunks begin.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.text import cleaned, is_quality, quality_faults, token_count
from quire.modes import BREAKS, HEADINGS, MAX_TOKENS, MIN_TOKENS, Mode
from quire.operators.match import match, reading_order


def _quoted(names: tuple[str, ...]) -> str:
    return ", ".join(f"'{n}'" for n in names)


#: Indexes at which chunks begin. A chunk ends before an element that would take it over the greater bound, or that is
#: a title, once it has reached the lesser one.
_STARTS = f"""
aggregate(es, named_struct('i', 0, 'cur', 0, 'starts', array(0)),
  (a, e) -> IF(a.i > 0 AND a.cur >= {MIN_TOKENS} AND (a.cur + e.tokens > {MAX_TOKENS} OR e.breaks),
    named_struct('i', a.i + 1, 'cur', e.tokens, 'starts', concat(a.starts, array(a.i))),
    named_struct('i', a.i + 1, 'cur', a.cur + e.tokens, 'starts', a.starts)),
  a -> a.starts)
"""
_CUT = "transform(sequence(0, size(starts) - 1), k -> slice(es, starts[k] + 1, coalesce(get(starts, k + 1), size(es)) - starts[k]))"
_REPR = "concat('[', array_join(transform(bbox, x -> cast(x as string)), ', '), ']')"


def _folded(elements: DataFrame, order: str, breaks: bool) -> DataFrame:
    """item_id, page, chunk_no, es: a row for each chunk, with its elements in order."""
    at = F.col("structure_type").isin(*BREAKS) if breaks else F.lit(False)
    element = F.struct(
        F.col(order).alias("ord"), "content", F.col("structure_type").alias("type"), "level", "ocr_confidence", token_count("content").alias("tokens"), at.alias("breaks"), F.array("x1", "y1", "x2", "y2").alias("bbox"),
    )
    pages = elements.groupBy("item_id", "page").agg(F.array_sort(F.collect_list(element)).alias("es"))
    pages = pages.withColumn("starts", F.expr(_STARTS))
    return pages.select("item_id", "page", F.posexplode(F.expr(_CUT)).alias("chunk_no", "es"))


def semantic_chunks(elements: DataFrame, mode: Mode = Mode()) -> DataFrame:
    """Chunks in reading order: item_id, page, chunk_no, fragment_id, content, metadata."""
    ordered = reading_order(elements)
    if mode.quality:
        ordered = ordered.filter(is_quality("content", "ocr_confidence"))
    rows = _folded(ordered, "id", breaks=True)
    heads = _quoted(HEADINGS)
    rows = rows.withColumn("titles", F.expr(f"transform(filter(es, e -> e.type IN ({heads})), e -> e.content)"))
    rows = rows.withColumn("bodies", F.expr(f"filter(es, e -> e.type NOT IN ({heads}))"))
    rows = rows.withColumn("bbox", F.expr("coalesce(get(bodies, 0).bbox, es[0].bbox)"))
    titled = F.size("titles") > 0
    content = F.concat_ws(": ", F.when(titled, F.array_join("titles", " - ")), F.when(F.size("bodies") > 0, F.expr("array_join(transform(bodies, e -> e.content), ' ')")))
    item = F.concat(F.col("item_id"), F.lit("_")) if mode.item_ids else F.lit("")
    key = F.concat(item, F.lit("page_"), "page", F.lit("_bbox_"), F.expr(_REPR), F.lit("_content_"), F.expr("substring(es[0].content, 1, 50)"))
    fragment = F.concat(item, F.lit("chunk_"), "page", F.lit("_"), F.substring(F.md5(key), 1, 12))
    return rows.select(
        "item_id", "page", "chunk_no", fragment.alias("fragment_id"), content.alias("content"),
        F.struct(
            (F.col("item_id") if mode.item_ids else F.lit(None).cast("string")).alias("item_id"), "page", F.lit("semantic_chunk").alias("type"), F.col("titles").alias("section_titles"), F.get("titles", F.lit(0)).alias("primary_section"),
            F.when(titled, F.array_join("titles", " > ")).alias("context_hierarchy"), "bbox", *_sums(), F.expr("array_sort(array_distinct(transform(es, e -> e.level)))").alias("hierarchy_levels"),
        ).alias("metadata"),
    )


def _sums():
    return (
        F.expr("aggregate(es, 0D, (a, e) -> a + e.ocr_confidence) / size(es)").alias("ocr_confidence"),
        F.size("es").alias("elements_count"),
        F.expr("aggregate(es, 0, (a, e) -> a + e.tokens)").alias("token_count"),
    )


def flat_chunks(elements: DataFrame) -> DataFrame:
    """Chunks in recognition order, without headings: the same columns."""
    rows = elements if "structure_type" in elements.columns else elements.withColumn("structure_type", F.lit("text"))
    rows = _folded(rows.withColumn("level", F.lit(5)), "ocr_seq", breaks=False).withColumn("bbox", F.expr("es[0].bbox"))
    key = F.concat(F.lit("flat_"), "page", F.lit("_bbox_"), F.expr(_REPR), F.lit("_content_"), F.expr("substring(es[0].content, 1, 50)"))
    return rows.select(
        "item_id", "page", "chunk_no", F.concat(F.lit("flat_"), "page", F.lit("_"), F.substring(F.md5(key), 1, 12)).alias("fragment_id"), F.expr("array_join(transform(es, e -> e.content), ' ')").alias("content"),
        F.struct(
            F.lit(None).cast("string").alias("item_id"), "page", F.lit("flat_chunk").alias("type"), F.array().cast("array<string>").alias("section_titles"), F.lit(None).cast("string").alias("primary_section"),
            F.lit(None).cast("string").alias("context_hierarchy"), "bbox", *_sums(), F.array().cast("array<int>").alias("hierarchy_levels"),
        ).alias("metadata"),
    )


def chunks(lines: DataFrame, blocks: DataFrame, mode: Mode = Mode(), hierarchy: bool = True) -> DataFrame:
    """From recognised lines and layout blocks to chunks."""
    lines = lines.withColumn("content", cleaned("content", mode.corrections))
    return semantic_chunks(match(lines, blocks, mode), mode) if hierarchy else flat_chunks(lines)  # flat chunks say nothing of blocks


def filter_counts(lines: DataFrame) -> DataFrame:
    """One row: how many lines there are, how many the quality filter keeps, and how many break each of its rules (a line can break several)."""
    faults = quality_faults("content", "ocr_confidence")
    return lines.agg(F.count("*").alias("lines"), F.count_if(is_quality("content", "ocr_confidence")).alias("kept"), *[F.count_if(broken).alias(f"bad_{name}") for name, broken in faults.items()])


def preview(chunks: DataFrame, most: int = 3) -> DataFrame:
    """The first chunks, by item, page and place."""
    return chunks.orderBy("item_id", "page", "chunk_no").limit(most)


def summary(rows: DataFrame) -> DataFrame:
    """type, total_chunks, total_tokens, total_elements."""
    return rows.groupBy(F.col("metadata.type").alias("type")).agg(F.count("*").alias("total_chunks"), F.sum("metadata.token_count").alias("total_tokens"), F.sum("metadata.elements_count").alias("total_elements"))
