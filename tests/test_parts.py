"""Pages whose lines and blocks arrive apart: out of order, doubled, late, never; over restarts."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from quire.modes import Mode
from quire.operators.chunk import chunks
from quire.operators.store import Store
from quire.streaming import parts

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def line(seq, text):
    return (seq, text, 0.95, 60, 100 + 30 * seq, 200, 114 + 30 * seq)


def block(number, label, y):
    return (number, label, "", 0.9, 50, y, 560, y + 40)


def row(item, part, of, minute, values):
    return (item, 0, part, of, START + timedelta(minutes=minute) if minute is not None else None, values)


def contents(rows):
    return sorted((r["content"], r["metadata"]["item_id"]) for r in rows.collect())


def test_parts_make_whole_pages(spark, tmp_path):
    where = {k: str(tmp_path / k) for k in ("lines", "blocks", "store", "errors", "cp")}
    mode = Mode(item_ids=True)

    def arrive(lines, blocks):
        spark.createDataFrame(lines, parts.LINE_PARTS).coalesce(1).write.mode("append").parquet(where["lines"])
        spark.createDataFrame(blocks, parts.BLOCK_PARTS).coalesce(1).write.mode("append").parquet(where["blocks"])
        kept = Store(spark, where["store"], 4, 4)
        parts.ingest_parts(spark, where["lines"], where["blocks"], kept, where["errors"], where["cp"], mode).awaitTermination(150)
        return contents(kept.frame()), sorted(tuple(r) for r in spark.read.parquet(where["errors"]).select("item_id", "page", "error").collect())

    first, second, title, body = line(0, "Heading"), line(1, "and its text"), block(0, "title", 90), block(1, "text", 120)
    # the second part of a's lines before the first, one twice; b has no blocks; parts without a time, a number or an id go nowhere
    assert arrive([row("a", 1, 2, 0, [second]), row("a", 1, 2, 0, [second]), row("b", 0, 1, 0, [first]), row("x", 0, 1, None, [first]), row(None, 0, 1, 0, [first]), row("x", None, 1, 0, [first])], [row("a", 0, 1, 0, [title, body])]) == ([], [])
    # a restart: the rest of a, and what is there again with another text
    whole = [("Heading: and its text", "a")]
    assert arrive([row("a", 0, 2, 1, [first]), row("a", 1, 2, 1, [line(1, "other")])], []) == (whole, [])
    # a again, which is whole already; c in one batch, without a block on it; time goes on, so b is given up
    whole.append(("Alone", "c"))
    gone = [("b", 0, "missing: blocks 0")]
    assert arrive([row("a", 0, 2, 60, [line(0, "other")]), row("c", 0, 1, 60, [line(0, "Alone")])], [row("c", 0, 1, 60, [])]) == (sorted(whole), gone)
    # b's blocks are too late
    assert arrive([], [row("b", 0, 1, 1, [title])]) == (sorted(whole), gone)
    at_once = spark.createDataFrame([("a", 0, *first), ("a", 0, *second)], "item_id string, page int, ocr_seq int, content string, ocr_confidence double, x1 int, y1 int, x2 int, y2 int")
    blocks = spark.createDataFrame([("a", 0, *title), ("a", 0, *body)], "item_id string, page int, block_idx int, label string, content string, confidence double, x1 int, y1 int, x2 int, y2 int")
    stored = Store(spark, where["store"], 4, 4).frame().filter(F.col("metadata.item_id") == "a").select("fragment_id", "content", "metadata")
    assert stored.collect() == chunks(at_once, blocks, mode).select("fragment_id", "content", "metadata").collect()


@pytest.mark.parametrize("found, totals, missing", [({}, {"lines": 0, "blocks": 0}, ["lines 0", "blocks 0"]), ({("lines", 1): ""}, {"lines": 2, "blocks": 1}, ["lines 0", "blocks 0"]), ({("lines", 0): "", ("blocks", 0): ""}, {"lines": 1, "blocks": 1}, [])])
def test_missing_parts(found, totals, missing):
    assert parts._missing(found, totals) == missing
