"""Pages whose lines and blocks arrive apart, in numbered parts, on two streams: gathered page by page until they are whole.

A part is one row: item_id, page, ``part`` (from 0) of ``parts``, ``at`` (when it was made), and its lines or blocks.

Defined cases: a page is passed on as soon as all parts of both kinds are there, in the parts' order, whatever the order in which they came. Of a part that comes
twice the first stays (within one batch the lesser as JSON text); ``parts`` is the greatest that was said. A page that is not whole when the watermark passes its last
part's time and ``patience`` gives one row with ``error`` and no lines. A whole page is remembered as long, so that parts that come again change nothing.
Parts older than the watermark are left out, as are those without an id, page, number or time; a part that comes after its page was closed, but isn't that old, opens it anew.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quire.modes import ENHANCED, Mode
from quire.operators.store import Store
from quire.streaming.ingest import BLOCK, LINE, VersionedIndex, page_chunks, query_id

_KEY = "item_id string, page int, part int, parts int, at timestamp"
LINE_PARTS = f"{_KEY}, lines array<{LINE}>"
BLOCK_PARTS = f"{_KEY}, blocks array<{BLOCK}>"
_KINDS = ("lines", "blocks")
_STATE = "kinds array<string>, numbers array<int>, payloads array<string>, lines int, blocks int, closes long, whole boolean"


def _missing(found: dict[tuple[str, int], str], totals: dict[str, int]) -> list[str]:
    return [f"{kind} {n}" for kind in _KINDS for n in range(max(totals[kind], 1)) if (kind, n) not in found]


def _gather(patience: int):
    """A page's parts, kept from batch to batch; ``patience`` in milliseconds."""

    def row(key: tuple, found: dict[tuple[str, int], str], totals: dict[str, int], error: str | None) -> pd.DataFrame:
        texts = [None if error else [found[kind, n] for n in range(max(totals[kind], 1))] for kind in _KINDS]
        return pd.DataFrame([[*key, *texts, error]], columns=["item_id", "page", *_KINDS, "error"])

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        found, totals, closes, whole = {}, dict.fromkeys(_KINDS, 0), 0, False
        if state.exists:
            kinds, numbers, payloads, *most, closes, whole = state.get
            found, totals = dict(zip(zip(kinds, numbers, strict=True), payloads, strict=True)), dict(zip(_KINDS, most, strict=True))
        if state.hasTimedOut:
            state.remove()
            if not whole:
                yield row(key, found, totals, "missing: " + ", ".join(_missing(found, totals)))
            return
        for rows in batches:
            for r in rows.sort_values("payload").itertuples():
                closes = max(closes, int(r.at.timestamp() * 1000) + patience)
                if not whole:
                    found.setdefault((r.kind, int(r.part)), r.payload)
                    totals[r.kind] = max(totals[r.kind], int(r.parts))
        if not whole and not _missing(found, totals):
            yield row(key, found, totals, None)
            found, whole = {}, True
        state.update(([k for k, _ in found], [n for _, n in found], list(found.values()), *totals.values(), closes, whole))
        state.setTimeoutTimestamp(max(closes, state.getCurrentWatermarkMs() + 1))

    return run


def whole_pages(lines: DataFrame, blocks: DataFrame, lateness: str = "10 minutes", patience: int = 600) -> DataFrame:
    """item_id, page, lines, blocks, error of two streams of parts. ``lateness``: the watermark's delay; ``patience`` in seconds."""
    key = ["item_id", "page", "part", "parts", "at"]
    each = [x.select(*key, F.lit(kind).alias("kind"), F.coalesce(F.to_json(kind), F.lit("[]")).alias("payload")) for x, kind in ((lines, "lines"), (blocks, "blocks"))]
    rows = each[0].unionByName(each[1]).dropna(subset=key).withWatermark("at", lateness)
    made = rows.groupBy("item_id", "page").applyInPandasWithState(
        _gather(patience * 1000), "item_id string, page int, lines array<string>, blocks array<string>, error string", _STATE, "append", GroupStateTimeout.EventTimeTimeout
    )

    def parsed(kind: str, schema: str):
        return F.flatten(F.transform(kind, lambda x: F.from_json(x, f"array<{schema}>"))).alias(kind)

    return made.select("item_id", "page", parsed("lines", LINE), parsed("blocks", BLOCK), "error")


def ingest_parts(
    spark: SparkSession, lines: str, blocks: str, target: VersionedIndex | Store, errors: str, checkpoint: str, mode: Mode = ENHANCED, lateness: str = "10 minutes", patience: int = 600
) -> StreamingQuery:
    """Gathers the parts of two folders: chunks of whole pages go into the index, pages that stay incomplete into a folder of ``errors``. A batch that comes again changes nothing."""
    parts = [spark.readStream.schema(schema).parquet(path) for schema, path in ((LINE_PARTS, lines), (BLOCK_PARTS, blocks))]

    def put(batch: DataFrame, number: int) -> None:
        batch = batch.persist()  # two uses, and the state is stepped once
        batch.filter("error IS NOT NULL").select("item_id", "page", "error").write.mode("overwrite").parquet(f"{errors}/batch={number}")
        rows = page_chunks(batch.filter("error IS NULL"), mode).withColumn("place", F.struct("item_id", "page", "chunk_no")).select("fragment_id", "content", "metadata", "place")
        target.put(rows, "place", (query_id(spark, checkpoint), number))
        batch.unpersist()

    return whole_pages(*parts, lateness, patience).writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
