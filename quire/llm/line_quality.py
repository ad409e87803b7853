"""Quality rules from cross-document line frequency, with expressions of the JVM alone.

Every line is normalised and hashed; the distinct documents of each (host, line hash) are
counted; lines of more than ``max_docs`` documents of a host are removed, and a document of
which less than ``min_left`` of its words is left is rejected. Base rules on each text come
before that.

Defined cases: a null or empty text has no words and fails the base rules. A null host is a
host of its own. Rows that share a doc_id are one document to the counts, and a line counts
once for it; each row still gets a row, by its own text's lines alone, however often it is there. A null
doc_id counts as one document. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm._common import SPACE, cut, space_words


@dataclass(frozen=True)
class LineRules:
    """min_words, max_repeat_percent: base rules. max_docs: documents of one host in which a line may stand. min_left: least share of words left."""

    min_words: int = 50
    max_repeat_percent: int = 50
    max_docs: int = 20
    min_left: float = 0.3


#: Positions of windows of three words that a text may have twice or more. A window's hash and its position share a
#: long: the low ``b`` bits hold the position, so one sort of longs brings equal windows together.
_MAYBE = """
transform(filter(packed, (x, i) -> shiftright(get(packed, i - 1), b) = shiftright(x, b) OR shiftright(get(packed, i + 1), b) = shiftright(x, b)), x -> int(x & (shiftleft(1L, b) - 1L)))
"""
#: Those, usually few, with whole hashes of their own. What is equal in both is equal.
_WHOLE = "sort_array(transform(maybe, i -> named_struct('h', xxhash64(1, get(words, i), get(words, i + 1), get(words, i + 2)), 'i', i)))"
#: How many words the windows found twice or more cover.
_REPEATED = """
aggregate(
  sort_array(transform(filter(whole, (x, i) -> get(whole, i - 1).h = x.h OR get(whole, i + 1).h = x.h), x -> bigint(x.i))),
  named_struct('n', 0L, 'last', -3L),
  (a, x) -> named_struct('n', a.n + least(3L, x - a.last), 'last', x),
  a -> a.n)
"""


def base_features(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: doc_id, source, th (the text's hash), n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", "source", F.xxhash64("text").alias("th"), text.alias("text"), space_words(F.col("text")).alias("words"))
    rows = rows.select(
        "doc_id", "source", "th", "words",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    rows = rows.withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")).drop("lines")
    rows = rows.withColumn("b", F.length(F.bin("n_words")))
    packed = "CASE WHEN n_words < 3 THEN array() ELSE sort_array(transform(sequence(0, int(n_words) - 3), i -> shiftleft(xxhash64(get(words, i), get(words, i + 1), get(words, i + 2)), b) | i)) END"
    rows = rows.withColumn("packed", F.expr(packed)).withColumn("maybe", F.expr(_MAYBE)).drop("packed", "b")
    rows = rows.withColumn("whole", F.expr(_WHOLE)).drop("words", "maybe")
    return rows.withColumn("n_repeat_words", F.expr(_REPEATED)).drop("whole")


def line_counts(docs: DataFrame) -> DataFrame:
    """doc_id, source, th, h, words: each distinct normalised line of a row (equal rows together), and the words of all its places."""
    line = F.lower(F.trim(F.regexp_replace(F.regexp_replace(F.col("line"), r"\s+", " "), "[0-9]", "0")))
    lines = docs.select("doc_id", "source", F.xxhash64("text").alias("th"), F.explode(F.split("text", "\n")).alias("line")).filter(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
    lines = lines.select("doc_id", "source", "th", F.xxhash64(line).alias("h"), F.size(space_words(F.col("line"))).alias("words"))
    return lines.groupBy("doc_id", "source", "th", "h").agg(F.sum("words").alias("words"))


def line_quality(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """doc_id, the base features, base_failed, n_words_removed, kept."""
    lines = cut(line_counts(docs), "lines")
    source = F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))
    lines = lines.select("doc_id", source.alias("host"), "th", "h", "words")
    common = lines.groupBy("host", "h").agg(F.count_distinct(F.coalesce(F.concat(F.lit("d"), F.col("doc_id").cast("string")), F.lit("n"))).alias("docs"))
    common = common.filter(F.col("docs") > rules.max_docs).select("host", "h")
    removed = lines.join(common, ["host", "h"], "left_semi").groupBy("doc_id", "host", "th").agg(F.sum("words").alias("n_words_removed"))
    copies = docs.select("doc_id", source.alias("host"), F.xxhash64("text").alias("th")).groupBy("doc_id", "host", "th").agg(F.count("*").alias("copies")).filter("copies > 1")

    def same_row(a: DataFrame, b: DataFrame) -> Column:
        return a["doc_id"].eqNullSafe(b["b_doc"]) & (a["host"] == b["b_host"]) & (a["th"] == b["b_th"])

    def named(b: DataFrame) -> DataFrame:
        return b.withColumnsRenamed({"doc_id": "b_doc", "host": "b_host", "th": "b_th"})

    copies = named(copies)
    removed = removed.join(copies, same_row(removed, copies), "left")  # the words of equal rows were summed
    removed = named(removed.select("doc_id", "host", "th", F.expr("n_words_removed div coalesce(copies, 1)").alias("n_words_removed")))
    rows = base_features(docs).withColumn("host", source)
    rows = rows.join(removed, same_row(rows, removed), "left")
    failed = (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words"))
    gone = F.coalesce("n_words_removed", F.lit(0)).cast("long")
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), gone.alias("n_words_removed"),
        (~failed & (F.col("n_words") - gone >= rules.min_left * F.col("n_words"))).alias("kept"),
    )


#: The same rows in DuckDB: base rules by joins of positions, line rules by grouping.
ORACLE_SQL = r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
g AS (SELECT rid, unnest(generate_series(1, len(ws) - 2)) AS i, ws FROM w WHERE len(ws) >= 3),
g3 AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS t FROM g),
dup AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, t) AS c FROM g3) WHERE c > 1),
rep AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, i + unnest([0, 1, 2]) AS p FROM dup) GROUP BY rid),
ln AS (SELECT rid, doc_id, source, unnest(string_split(text, chr(10))) AS line FROM d),
l AS (SELECT rid, doc_id, source, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS k,
             lower(trim(regexp_replace(regexp_replace(line, '\s+', ' ', 'g'), '[0-9]', '0', 'g'))) AS norm
      FROM ln WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dl AS (SELECT rid, count(*) - count(DISTINCT line) AS n FROM l GROUP BY rid),
c AS (SELECT source, norm FROM l GROUP BY source, norm HAVING count(DISTINCT coalesce(doc_id::VARCHAR, 'n')) > 20),
rm AS (SELECT l.rid, sum(l.k) AS n FROM l JOIN c ON c.norm = l.norm AND c.source IS NOT DISTINCT FROM l.source GROUP BY l.rid),
f AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
             (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             coalesce(dl.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
             coalesce(rm.n, 0)::BIGINT AS n_words_removed
      FROM w LEFT JOIN dl USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN rm USING (rid)),
v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_words_removed,
       NOT base_failed AND (n_words - n_words_removed)::DOUBLE >= 0.3::DOUBLE * n_words AS kept
FROM v
"""
