"""Benchmark decontamination by a prefix-filtered join, with expressions of the JVM alone.

Each benchmark item is cut into windows of ``window`` consecutive words (an item of fewer words
is one window). A window's tokens are its ``shingle``-word shingles. One pass over the texts
finds where benchmark shingles stand; their counts over the whole corpus order a window's
shingles by rarity. As containment must be full, the necessary prefix of a window is its rarest
shingle alone: only that is joined with the texts' shingles. The shingle's offset gives the one
possible start (positional bound), which must leave room for the window (length bound), and the
window's words are then compared with the text's words at that place.

A text is split once, and of its shingles only those pass on that a fixed-size Bloom filter of the benchmark's shingles
lets through (2 ** ``bits`` bits, two probes), with the words around them. So what is shuffled is in proportion to the
benchmark words in the texts, and nothing is broadcast but what the planner finds small. A benchmark of more shingles than
about a fifth of the bits wants more of them.

Defined cases: a null text has no words. Rows are matched by doc_id and text hash, so repeated
rows each get the same result. Items with a null id hit words but are not named. Items without
words have no window. Other columns are ignored; empty tables give empty or clean results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm._common import ascii_lower, cut

#: What separates words, after A-Z are in lower case.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

def words_of(text: Column) -> Column:
    lower = ascii_lower(F.coalesce(text, F.lit("")))
    return F.array_remove(F.split(lower, NO_WORD), "")


def _hashes(k: int) -> Column:
    """Hashes of all shingles of ``k`` words of the column ``words``, by position."""
    parts = ", ".join(f"get(words, i + {j})" for j in range(k))
    return F.expr(f"CASE WHEN size(words) < {k} THEN array() ELSE transform(sequence(0, size(words) - {k}), i -> xxhash64({k}, {parts})) END")


def _probes(bits: int) -> list[Column]:
    """Two places in the filter for the hash ``h``."""
    mask = F.lit((1 << bits) - 1)
    return [F.col("h").bitwiseAND(mask), F.shiftrightunsigned(F.col("h"), bits).bitwiseAND(mask)]


def _filter_of(hashes: DataFrame, bits: int) -> DataFrame:
    """One row: an array of ``2 ** bits / 64`` longs, with the bits of the hashes set."""
    spots = hashes.select(F.explode(F.array(*_probes(bits))).alias("at"))
    some = spots.groupBy(F.shiftright("at", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, int(at & 63))")).alias("v"))
    every = hashes.sparkSession.range(1 << (bits - 6)).withColumnRenamed("id", "i").join(some, F.col("i") == F.col("w"), "left")
    return every.agg(F.sort_array(F.collect_list(F.struct("i", F.coalesce("v", F.lit(0)).alias("v")))).alias("l")).select(F.col("l.v").alias("bits"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, shingle: int = 5, bits: int = 22) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated: one row for each row of ``docs``."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("words")).filter(F.size("words") > 0)
    windows = items.withColumn("len", F.least(F.size("words"), F.lit(window)))
    windows = windows.withColumn("start", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("len")))).select("item_id", "len", F.slice("words", F.col("start") + 1, F.col("len")).alias("words"))
    windows = cut(windows.withColumn("wid", F.array_join("words", " ")), "windows")  # words have no spaces: the text is the window
    lengths = sorted(r[0] for r in windows.select(F.least("len", F.lit(shingle)).alias("k")).distinct().collect())  # at most ``shingle`` values
    hashes = F.array().cast("array<bigint>")
    for k in lengths:
        hashes = F.when(F.least("len", F.lit(shingle)) == k, _hashes(k)).otherwise(hashes)
    tokens = cut(windows.dropDuplicates(["wid"]).select("wid", "len", F.posexplode(hashes).alias("offset", "h")), "tokens")
    passing = cut(_filter_of(tokens.select("h").distinct(), bits), "filter")

    # One pass over the texts: a row of each at place -1, and its shingles of all lengths that may be the benchmark's.
    rows = docs.select("doc_id", F.xxhash64("text").alias("th"), words_of(F.col("text")).alias("words")).withColumn("n", F.size("words"))
    every = rows.select("doc_id", "th", "words", "n", F.posexplode(F.concat(F.array(F.lit(None).cast("bigint")), *[_hashes(k) for k in lengths])).alias("i", "h"))
    pos, before = F.col("i") - 1, F.lit(0)
    for k in lengths[:-1]:
        before = before + F.greatest(F.col("n") - k + 1, F.lit(0))
        pos = F.when(F.col("i") > before, F.col("i") - 1 - before).otherwise(pos)
    words = passing.scalar()
    may = None
    for at in _probes(bits):
        bit = F.call_function("shiftrightunsigned", F.get(words, F.shiftright(at, 6).cast("int")), at.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1
        may = bit if may is None else may & bit
    every = every.filter(F.col("h").isNull() | may)
    base = F.greatest(pos - (window - 1), F.lit(0))
    found = every.select("doc_id", "th", "n", pos.alias("pos"), "h", base.alias("base"), F.when(F.col("h").isNotNull(), F.slice("words", base + 1, 2 * window - 1)).alias("near"))
    found = cut(found, "found")
    bare, found = found.filter("h is null").select("doc_id", "th", "n"), found.filter("h is not null")

    # Rarity over the corpus, and each window's prefix: its rarest shingle. A window with an absent shingle stands nowhere.
    counts = found.groupBy("h").agg(F.count("*").alias("df"))
    prefix = tokens.join(counts, "h", "left").groupBy("wid", "len").agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "offset", "h")).alias("p"))
    prefix = prefix.filter(F.col("p.df") > 0).select("wid", "len", F.col("p.offset").alias("offset"), F.col("p.h").alias("h"))
    held = found.join(prefix, "h").withColumn("start", F.col("pos") - F.col("offset")).filter((F.col("start") >= 0) & (F.col("start") + F.col("len") <= F.col("n")))
    held = held.filter(F.array_join(F.slice("near", F.col("start") - F.col("base") + 1, F.col("len")), " ") == F.col("wid")).select("doc_id", "th", "start", "wid", "len")

    named = windows.select("wid", "item_id").distinct()
    hits = held.join(named, "wid").groupBy("doc_id", "th").agg(F.collect_set(F.struct("start", "len")).alias("spans"), F.array_sort(F.collect_set("item_id")).alias("ids"))
    covered = F.size(F.array_distinct(F.expr("flatten(transform(spans, s -> sequence(s.start, s.start + s.len - 1)))")))
    hits = hits.select(F.col("doc_id").alias("h_doc"), F.col("th").alias("h_th"), covered.cast("long").alias("n_hit"), "ids")
    out = bare.join(hits, bare["doc_id"].eqNullSafe(hits["h_doc"]) & bare["th"].eqNullSafe(hits["h_th"]), "left")
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select("doc_id", F.col("n").cast("long").alias("n_words"), n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"), F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


#: The same rows in DuckDB, by joining every window of the texts.
ORACLE_SQL = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
iw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
il AS (SELECT item_id, ws, least(len(ws), 10) AS n FROM iw WHERE len(ws) > 0),
ii AS (SELECT item_id, n, ws, unnest(generate_series(1, len(ws) - n + 1)) AS i FROM il),
win AS (SELECT DISTINCT item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS w FROM ii),
ns AS (SELECT DISTINCT n FROM win),
di AS (SELECT doc_id, ns.n, ws, unnest(generate_series(1, len(ws) - ns.n + 1)) AS i FROM dw JOIN ns ON len(ws) >= ns.n),
hit AS (SELECT d.doc_id, d.i, d.n, win.item_id FROM (SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS w FROM di) d JOIN win ON win.n = d.n AND win.w = d.w),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hit)) GROUP BY doc_id),
its AS (SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS ids FROM hit GROUP BY doc_id)
SELECT dw.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(ids), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)
"""
