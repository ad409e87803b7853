"""Chunks by place: a table of chunks laid out so that a search by boxes skips what is elsewhere on the page.

Chunks are sorted by the Z-order key of their box's centre, in cells: chunks near each other on the page are near each other in the
files, so that the least and greatest coordinates of files, row groups and pages of values, which Parquet keeps, say where a box can't be.

Defined cases: a box that has no four coordinates has no place, and meets nothing. Boxes meet if they share an area; a box of no area
meets nothing. Asked boxes are few, a page's coordinates not negative (negative ones count as 0 in the key, not in the search).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CORNERS = ("x1", "y1", "x2", "y2")


def z_order(x: Column, y: Column, bits: int = 12) -> Column:
    """The bits of two whole numbers, by turns."""
    out = F.lit(0).cast("long")
    for i in range(bits):
        for k, v in enumerate((x, y)):
            bit = F.shiftright(F.greatest(v, F.lit(0)).cast("long"), i).bitwiseAND(F.lit(1))
            out = out + F.shiftleft(bit, 2 * i + k)
    return out


def placed(chunks: DataFrame, cell: int = 32, bits: int = 12) -> DataFrame:
    """Chunks (with metadata.bbox) with their box as x1, y1, x2, y2 and ``place``, the key of its centre's cell; null without a box."""
    box = F.col("metadata.bbox")
    rows = chunks.withColumns({c: F.when(F.size(box) == 4, F.get(box, F.lit(i))) for i, c in enumerate(CORNERS)})
    most = F.lit((1 << bits) - 1)
    x, y = (F.least(F.floor((F.col(f"{c}1").cast("long") + F.col(f"{c}2")) / (2 * cell)), most) for c in "xy")
    return rows.withColumn("place", F.when(F.col("x1").isNotNull(), z_order(x, y, bits)))


def write_placed(chunks: DataFrame, path: str, files: int | None = None, group_bytes: int = 8 << 20) -> None:
    """A table of chunks in the order of their places; ``files`` of it, by default as many as the session's shuffles have parts."""
    rows = placed(chunks)
    ranged = rows.repartitionByRange(files, "place", "item_id", "page") if files else rows.repartitionByRange("place", "item_id", "page")
    ranged.sortWithinPartitions("place", "item_id", "page").write.option("parquet.block.size", group_bytes).parquet(path)


def read_placed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def meeting(rows: DataFrame, boxes: Sequence[tuple[str, int, int, int, int]]) -> DataFrame:
    """Rows with x1, y1, x2, y2 that meet a box, with ``box``, its name: one row for each pair. ``boxes``: (name, x1, y1, x2, y2).

    Which rows can meet any box is a condition on the four columns, which the scan takes over.
    """
    own = F.col("x1") < F.col("x2"), F.col("y1") < F.col("y2")
    boxes = [b for b in boxes if b[1] < b[3] and b[2] < b[4]]
    meets = {name: (F.col("x1") < x2) & (F.col("x2") > x1) & (F.col("y1") < y2) & (F.col("y2") > y1) for name, x1, y1, x2, y2 in boxes}
    some = F.lit(False)
    for condition in meets.values():
        some = some | condition
    names = F.array(*[F.when(condition, F.lit(name)) for name, condition in meets.items()]).cast("array<string>")
    return rows.filter(some & own[0] & own[1]).withColumn("box", F.explode(F.filter(names, lambda x: x.isNotNull())))
