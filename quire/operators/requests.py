"""Page requests: validation, page ranges, and result envelopes."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.text import ascii_json


def page_ranges(requests: DataFrame, items: DataFrame) -> DataFrame:
    """item_id, status, first, last. ``items``: item_id, pages. 400 without an id, 404 for an unknown one; ranges are clamped to the pages there are."""
    rows = requests.select("item_id", F.col("page_range.start").alias("start"), F.col("page_range.end").alias("end")).join(items.select("item_id", "pages"), "item_id", "left")
    status = F.when(F.coalesce("item_id", F.lit("")) == "", 400).when(F.col("pages").isNull(), 404).otherwise(200)
    top = F.col("pages") - 1
    first = F.greatest(F.lit(0), F.least(F.coalesce("start", F.lit(0)), top))
    last = F.greatest(first, F.least(F.coalesce("end", top), top))
    ok = status == 200
    return rows.select("item_id", status.alias("status"), F.when(ok, first).alias("first"), F.when(ok, last).alias("last"))


def in_range(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """Rows of pages that a valid request asks for."""
    asked = ranges.filter("status = 200").select("item_id", "first", "last")
    return rows.join(asked, "item_id").filter(F.col("page").between(F.col("first"), F.col("last"))).select(*rows.columns)


def answered(item_id: str | None, action: Callable[[], DataFrame], spark: SparkSession) -> DataFrame:
    """item_id, status, body of ``action``'s envelopes; status 500 with the error's text where it fails."""
    try:
        rows = action().select("item_id", "status", "body")
        return spark.createDataFrame(rows.collect(), rows.schema)  # one request's answers; they are made here, where an error shows
    except Exception as error:  # whatever fails is the request's answer
        return spark.createDataFrame([(item_id, 500, json.dumps({"error": str(error)}))], "item_id string, status int, body string")


def with_failures(ranges: DataFrame, failures: DataFrame) -> DataFrame:
    """``ranges`` with status 500 and ``error`` for each request with a failure among its pages. ``failures``: item_id, page (null: all of the item), error; the first page's counts."""
    bad = failures.select(F.col("item_id").alias("_item"), F.col("page").alias("_page"), F.col("error").alias("_error"))
    asked = ranges.filter("status = 200").select("item_id", "first", "last").distinct()
    hit = asked.join(bad, (F.col("item_id") == F.col("_item")) & (F.col("_page").isNull() | F.col("_page").between(F.col("first"), F.col("last"))))
    hit = hit.groupBy("_item", F.col("first").alias("_first"), F.col("last").alias("_last")).agg(F.min(F.struct("_page", "_error"))["_error"].alias("error"))
    rows = ranges.join(hit, (F.col("item_id") == F.col("_item")) & (F.col("first") == F.col("_first")) & (F.col("last") == F.col("_last")), "left")
    return rows.select("item_id", F.when(F.col("error").isNotNull(), 500).otherwise(F.col("status")).alias("status"), "first", "last", "error")


def envelopes(ranges: DataFrame, chunks: DataFrame) -> DataFrame:
    """item_id, status, body: the answer to each request as JSON in ASCII; a request's chunks are in page order.

    ``ranges`` may have ``error``, the text of answers with status 500 (:func:`with_failures`); such requests get no chunks.
    """
    chunk = F.struct("page", "chunk_no", F.struct("fragment_id", "content", "metadata").alias("c"))
    made = in_range(chunks, ranges).groupBy("item_id").agg(F.transform(F.array_sort(F.collect_list(chunk)), lambda x: x["c"]).alias("chunks"))
    keep = {"ignoreNullFields": "false"}
    rows = ranges.join(made, "item_id", "left")
    none = F.from_json(F.lit("[]"), chunks.select(F.array(F.struct("fragment_id", "content", "metadata")).alias("x")).schema["x"].dataType)
    found = F.coalesce("chunks", none)
    body = F.struct("item_id", F.concat_ws("-", "first", "last").alias("processed_pages"), F.size(found).alias("total_chunks"), found.alias("chunks"))
    error = F.when(F.col("status") == 400, F.lit("item_id is required")).otherwise(F.concat(F.lit("Document "), "item_id", F.lit(" not found")))
    if "error" in ranges.columns:
        error = F.when(F.col("status") == 500, F.col("error")).otherwise(error)
    return rows.select("item_id", "status", ascii_json(F.when(F.col("status") == 200, F.to_json(body, keep)).otherwise(F.to_json(F.struct(error.alias("error"))))).alias("body"))
