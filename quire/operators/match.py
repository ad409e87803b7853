"""Matching lines to layout blocks by overlap, and reading order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import token_count
from quire.modes import DEEPEST, LEVELS, OVERLAP, Mode


#: Whether a line and a block share more than a part of the smaller of them.
_INSIDE = f"""
least(x2, b.x2) > greatest(x1, b.x1) AND least(y2, b.y2) > greatest(y1, b.y1)
AND (double(least(x2, b.x2) - greatest(x1, b.x1)) * double(least(y2, b.y2) - greatest(y1, b.y1)))
  / least(double(x2 - x1) * double(y2 - y1), double(b.x2 - b.x1) * double(b.y2 - b.y1)) > {OVERLAP}D
"""
_CELLS = """
b.gx BETWEEN greatest(0, floor(x1 / g)) AND greatest(0, floor(x2 / g)) AND b.gy BETWEEN greatest(0, floor(y1 / g)) AND greatest(0, floor(y2 / g))
"""


def match(lines: DataFrame, blocks: DataFrame, mode: Mode = Mode()) -> DataFrame:
    """Lines with structure_type, structure_confidence and structure_content of the first block that overlaps.

    A page's blocks are one array, so a line meets them within its row: one exchange by page. In
    grid mode a block is seen only from lines that cover the cell of its corner, and cells, not
    the blocks' order, say which is first.
    """
    size = F.greatest(F.lit(50), F.least(F.lit(200), F.floor(F.greatest(F.max("x2"), F.max("y2")) / 15))).cast("int")
    row = F.struct("block_idx", "label", "content", "confidence", "x1", "y1", "x2", "y2")
    pages = blocks.groupBy("item_id", "page").agg(size.alias("g"), F.array_sort(F.collect_list(row)).alias("bs"))
    if mode.grid:
        celled = F.expr("array_sort(transform(bs, b -> named_struct('gx', floor(b.x1 / g), 'gy', floor(b.y1 / g), 'block_idx', b.block_idx, 'label', b.label, 'content', b.content, 'confidence', b.confidence, 'x1', b.x1, 'y1', b.y1, 'x2', b.x2, 'y2', b.y2)))")
        pages = pages.withColumn("bs", celled)
    inside = f"({_CELLS}) AND ({_INSIDE})" if mode.grid else _INSIDE
    found = lines.join(pages, ["item_id", "page"], "left").withColumn("b", F.expr(f"get(filter(bs, b -> {inside}), 0)"))
    return found.select(*lines.columns, F.coalesce("b.label", F.lit("text")).alias("structure_type"), F.coalesce("b.confidence", F.lit(0.0)).alias("structure_confidence"), F.col("b.content").alias("structure_content"))


def position(x1: str = "x1", y1: str = "y1", x2: str = "x2", y2: str = "y2") -> Column:
    return F.struct(F.col(x1).cast("int").alias("x"), F.col(y1).cast("int").alias("y"), (F.col(x2) - F.col(x1)).cast("int").alias("width"), (F.col(y2) - F.col(y1)).cast("int").alias("height"))


def level(kind: Column | str) -> Column:
    kind, out = F.col(kind) if isinstance(kind, str) else kind, F.lit(DEEPEST)
    for name, n in LEVELS.items():
        out = F.when(kind == name, n).otherwise(out)
    return out


def reading_order(elements: DataFrame) -> DataFrame:
    """Elements with ``id``, their number on the page from top to bottom and left to right, and ``level``."""
    by_page = Window.partitionBy("item_id", "page").orderBy("y1", "x1", "ocr_seq")
    return elements.withColumn("id", F.row_number().over(by_page) - 1).withColumn("level", level("structure_type"))


def heading_tree(elements: DataFrame, mode: Mode = Mode()) -> DataFrame:
    """Elements in reading order with ``parent_id``: the nearest earlier heading of a smaller level.

    With ``page_parent``, a level-2 element that has none goes under the page's first element of level 1 or 2 before it.
    """
    ordered = reading_order(elements)
    before = Window.partitionBy("item_id", "page").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    nearest = {k: F.max(F.when(F.col("level") <= k, F.col("id"))).over(before) for k in range(1, DEEPEST)}
    parent = F.lit(None).cast("int")
    for k in range(2, DEEPEST + 1):
        found = nearest[k - 1]
        if k == 2 and mode.page_parent:
            found = F.coalesce(found, F.min(F.when(F.col("level") <= 2, F.col("id"))).over(before))
        parent = F.when(F.col("level") == k, found).otherwise(parent)
    return ordered.withColumn("parent_id", parent)


def children(tree: DataFrame) -> DataFrame:
    """The tree with each element's ``children``, their ids in order."""
    below = tree.filter(F.col("parent_id").isNotNull()).groupBy("item_id", "page", F.col("parent_id").alias("_of")).agg(F.array_sort(F.collect_list(tree["id"])).alias("children"))
    below = below.withColumnRenamed("_of", "id")
    return tree.join(below, ["item_id", "page", "id"], "left").withColumn("children", F.coalesce("children", F.array().cast("array<int>")))


def subtrees(tree: DataFrame, mode: Mode = Mode()) -> DataFrame:
    """A tree of :func:`heading_tree` with ``begin`` and ``end``: what is below an element has the ids from begin + 1 to end - 1.

    With them come ``elements`` and ``tokens`` below it. Headings nest, so their ranges do, and sums below are differences of
    running sums: no step is taken from parent to child.
    """
    by_page = Window.partitionBy("item_id", "page").orderBy("id")
    so_far, after = by_page.rowsBetween(Window.unboundedPreceding, 0), by_page.rowsBetween(1, Window.unboundedFollowing)
    everything = Window.partitionBy("item_id", "page").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = tree.withColumn("_tokens", token_count("content"))
    rows = rows.withColumn("_sum", F.sum("_tokens").over(so_far)).withColumn("_high", F.min(F.when(F.col("level") <= 2, F.col("id"))).over(everything))
    rows = rows.withColumn("_last", F.struct((F.max("id").over(everything) + 1).alias("id"), F.max("_sum").over(everything).alias("before")))
    place = F.struct("id", (F.col("_sum") - F.col("_tokens")).alias("before"))
    ends = {k: F.coalesce(F.min(F.when(F.col("level") <= k, place)).over(after), F.col("_last")) for k in range(1, DEEPEST)}
    end = F.struct((F.col("id") + 1).alias("id"), F.col("_sum").alias("before"))
    for k in range(1, DEEPEST):
        own = ends[k]
        if k == 2:  # the page's first heading of level 2 has later ones below it
            own = F.when((F.col("id") == F.col("_high")) & F.lit(mode.page_parent), ends[1]).otherwise(ends[2])
        end = F.when(F.col("level") == k, own).otherwise(end)
    rows = rows.withColumn("_end", end)
    return rows.select(*tree.columns, F.col("id").alias("begin"), F.col("_end.id").alias("end"), (F.col("_end.id") - F.col("id") - 1).alias("elements"), (F.col("_end.before") - F.col("_sum")).alias("tokens"))
