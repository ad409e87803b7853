"""Quotation linking for chat data: from quoting messages to reply-ordered conversations without quotes.

Lines that begin with quote marks (``>``, also ``>>`` or ``> >``) are quotes of that many levels;
runs of lines of one level are passages. Texts are normalised (marks off, lower case, one space) and hashed: each passage as
a whole, by paragraphs (between blank lines, however wrapped), by lines, and by sentences. A quoted passage links to
the earliest earlier message of the same conversation that has it as its own, unquoted text; if there is none, its paragraphs
do, or else its lines, or else its sentences: the first kind of which any is found counts. A message replies to the origin of
most of its quoted words at level 1 (deeper levels only count if no level-1 quote links); ties go
to the later message. Threads come from parents by pointer jumping, and messages are ordered by
their thread's root and turn, so that a reply follows what it answers.

Scale: passages and their parts are rows and join by (conversation, hash) to one row for each such pair, the
earliest; no conversation is collected or paired with itself, and nothing but one message's lines is ever in one row.

Defined cases: null text has no lines and an empty result text. Repeated rows of a (conv_id, turn)
count once as an origin, and get a result each. Messages without conv_id or turn link to nothing.
Quotes of unknown origin are removed from the text, and counted. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm._common import cut

_MARKS = r"^\s*(?:>\s?)+"


def _lines(messages: DataFrame) -> DataFrame:
    """The rows with ``runs``: array of (level, lines), the runs of lines of one level."""
    rows = messages.withColumn("lines", F.transform(F.split(F.coalesce("text", F.lit("")), "\r\n|\n|\r"), lambda x: F.struct(
        F.length(F.regexp_replace(F.regexp_extract(x, _MARKS, 0), r"\s", "")).alias("level"), F.regexp_replace(x, _MARKS, "").alias("text"))))
    starts = F.expr("filter(sequence(0, size(lines) - 1), i -> i = 0 OR get(lines, i).level <> get(lines, i - 1).level)")
    rows = rows.withColumn("starts", starts)
    runs = F.expr("transform(starts, (s, k) -> named_struct('level', get(lines, s).level, 'lines', transform(slice(lines, s + 1, coalesce(get(starts, k + 1), size(lines)) - s), x -> x.text)))")
    return rows.withColumn("runs", runs).drop("starts", "lines")


def _normal(text):
    return F.trim(F.lower(F.regexp_replace(text, r"\s+", " ")))


def _units(pieces: DataFrame) -> DataFrame:
    """conv_id, turn, run, level, kind, h, words: each run as a whole (kind 0), by paragraphs (1), lines (2) and sentences (3)."""
    paragraphs = F.transform(F.split(F.array_join("lines", "\n"), r"\n\s*\n"), _normal)
    pieces = pieces.withColumn("paragraphs", paragraphs)
    sentences = F.flatten(F.transform("paragraphs", lambda x: F.split(F.regexp_replace(x, "([.!?]) ", "$1\n"), "\n")))
    kinds = [F.array(_normal(F.array_join("lines", " "))), F.col("paragraphs"), F.transform("lines", _normal), sentences]
    unit = lambda kind: lambda t: F.struct(F.lit(kind).alias("kind"), t.alias("t"))
    every = F.concat(*[F.transform(texts, unit(kind)) for kind, texts in enumerate(kinds)])
    units = pieces.select("conv_id", "turn", "run", "level", F.explode(every).alias("u")).filter(F.col("u.t") != "")
    return units.select("conv_id", "turn", "run", "level", F.col("u.kind").alias("kind"), F.xxhash64("u.t").alias("h"), F.size(F.split("u.t", " ")).alias("words"))


def quote_threads(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, text (without quotes), n_quotes (quoted passages), n_linked (those of which something is found), parent_turn (-1: replies to none), thread_root, depth: a row for each row of ``messages``, in reply order."""
    rows = cut(_lines(messages.select("conv_id", "turn", "role", "text")), "messages")
    known = rows.filter(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
    pieces = known.select("conv_id", "turn", F.posexplode("runs").alias("run", "r")).select("conv_id", "turn", "run", F.col("r.level").alias("level"), F.col("r.lines").alias("lines"))
    quoted = _units(pieces.filter("level > 0")).groupBy("conv_id", "turn", "run", "level", "kind", "h").agg(F.sum("words").alias("words"))
    quoted = cut(quoted, "quoted")
    quoting = quoted.select("conv_id").distinct()  # other conversations' texts are not hashed
    own = _units(pieces.filter("level = 0").join(quoting, "conv_id", "left_semi")).groupBy("conv_id", "h").agg(F.min("turn").alias("origin"))
    linked = quoted.join(own, ["conv_id", "h"]).filter(F.col("origin") < F.col("turn"))
    coarsest = F.min("kind").over(Window.partitionBy("conv_id", "turn", "run"))  # of one passage
    linked = cut(linked.withColumn("first", coarsest).filter("kind = first").select("conv_id", "turn", "run", "level", "origin", "words"), "linked")
    best = linked.groupBy("conv_id", "turn", "origin").agg(
        F.sum(F.when(F.col("level") == 1, F.col("words")).otherwise(0)).alias("near"), F.sum("words").alias("all"))
    best = best.groupBy("conv_id", "turn").agg(F.max(F.struct("near", "all", "origin"))["origin"].alias("parent_turn"))
    counts = quoted.groupBy("conv_id", "turn").agg(F.count_distinct("run").alias("n_quotes"))
    found = linked.groupBy("conv_id", "turn").agg(F.count_distinct("run").alias("n_linked"))
    links = cut(counts.join(best, ["conv_id", "turn"], "left").join(found, ["conv_id", "turn"], "left"), "replies")

    # Threads: (message, ancestor, distance) jumps until every ancestor is a root.
    at = links.filter(F.col("parent_turn").isNotNull()).select("conv_id", "turn", F.col("parent_turn").alias("root"), F.lit(1).cast("long").alias("depth"))
    while True:
        at = cut(at, "threads")
        up = at.select("conv_id", F.col("turn").alias("root"), F.col("root").alias("further"), F.col("depth").alias("more"))
        if at.join(up, ["conv_id", "root"], "left_semi").isEmpty():
            break
        at = at.join(up, ["conv_id", "root"], "left").select("conv_id", "turn", F.coalesce("further", "root").alias("root"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"))
    links = links.join(at, ["conv_id", "turn"], "left")
    clean = F.array_join(F.flatten(F.transform(F.filter("runs", lambda r: r["level"] == 0), lambda r: r["lines"])), "\n")
    out = rows.select("conv_id", "turn", "role", F.trim(clean, F.lit(" \t\r\n")).alias("text")).join(links, ["conv_id", "turn"], "left")
    zero = F.lit(0).cast("long")
    out = out.select("conv_id", "turn", "role", "text", F.coalesce("n_quotes", zero).alias("n_quotes"), F.coalesce("n_linked", zero).alias("n_linked"), F.coalesce("parent_turn", F.lit(-1).cast("long")).alias("parent_turn"), F.coalesce("root", "turn").alias("thread_root"), F.coalesce("depth", zero).alias("depth"))
    return out.orderBy("conv_id", "thread_root", "turn")


#: The same rows by joins of the texts themselves; for tables with one row for each (conv_id, turn).
ORACLE_SQL = r"""
WITH RECURSIVE l AS (
  SELECT conv_id, turn, unnest(generate_series(1, len(xs))) AS i, unnest(xs) AS x
  FROM (SELECT conv_id, turn, regexp_split_to_array(coalesce(text, ''), '\r\n|\n|\r') AS xs FROM conversations)),
p AS (SELECT conv_id, turn, i, length(regexp_replace(regexp_extract(x, '^\s*(?:>\s?)+'), '\s', '', 'g')) AS level, regexp_replace(x, '^\s*(?:>\s?)+', '') AS x FROM l),
r AS (SELECT *, i - row_number() OVER (PARTITION BY conv_id, turn, level ORDER BY i) AS run FROM p),
g AS (SELECT conv_id, turn, level, run, string_agg(x, ' ' ORDER BY i) AS x, string_agg(x, chr(10) ORDER BY i) AS nl FROM r GROUP BY conv_id, turn, level, run),
pa AS (SELECT conv_id, turn, level, run, trim(lower(regexp_replace(unnest(regexp_split_to_array(nl, '\n\s*\n')), '\s+', ' ', 'g'))) AS t FROM g),
u AS (SELECT conv_id, turn, level, run, kind, t FROM (
        SELECT conv_id, turn, level, run, 0 AS kind, trim(lower(regexp_replace(x, '\s+', ' ', 'g'))) AS t FROM g
        UNION ALL SELECT conv_id, turn, level, run, 1, t FROM pa
        UNION ALL SELECT conv_id, turn, level, run, 2, trim(lower(regexp_replace(x, '\s+', ' ', 'g'))) FROM r
        UNION ALL SELECT conv_id, turn, level, run, 3, unnest(string_split(regexp_replace(t, '([.!?]) ', '\1' || chr(10), 'g'), chr(10))) FROM pa) WHERE t <> ''),
q AS (SELECT conv_id, turn, level, run, kind, t, sum(len(string_split(t, ' '))) AS words FROM u WHERE level > 0 GROUP BY ALL),
o AS (SELECT conv_id, t, min(turn) AS origin FROM u WHERE level = 0 GROUP BY ALL),
k0 AS (SELECT q.*, origin, min(kind) OVER (PARTITION BY conv_id, turn, level, run) AS first FROM q JOIN o USING (conv_id, t) WHERE origin < turn),
k AS (SELECT * FROM k0 WHERE kind = first),
b AS (SELECT conv_id, turn, origin, sum(CASE WHEN level = 1 THEN words ELSE 0 END) AS near, sum(words) AS every FROM k GROUP BY ALL),
par AS (SELECT conv_id, turn, arg_max(origin, (near, every, origin)) AS parent_turn FROM b GROUP BY ALL),
th AS (SELECT conv_id, turn, parent_turn AS root, 1::BIGINT AS depth FROM par
       UNION ALL SELECT th.conv_id, th.turn, par.parent_turn, depth + 1 FROM th JOIN par ON par.conv_id = th.conv_id AND par.turn = th.root),
top AS (SELECT conv_id, turn, arg_max(root, depth) AS root, max(depth) AS depth FROM th GROUP BY ALL),
n AS (SELECT conv_id, turn, count(DISTINCT (level, run)) AS n_quotes FROM q GROUP BY ALL),
m AS (SELECT conv_id, turn, count(DISTINCT (level, run)) AS n_linked FROM k GROUP BY ALL),
c AS (SELECT conv_id, turn, coalesce(string_agg(x, chr(10) ORDER BY i) FILTER (level = 0), '') AS text FROM p GROUP BY ALL)
SELECT s.conv_id, s.turn, s.role, trim(c.text, ' ' || chr(9) || chr(13) || chr(10)) AS text, coalesce(n_quotes, 0)::BIGINT AS n_quotes, coalesce(n_linked, 0)::BIGINT AS n_linked,
       coalesce(parent_turn, -1) AS parent_turn, coalesce(top.root, s.turn) AS thread_root, coalesce(top.depth, 0)::BIGINT AS depth
FROM conversations s JOIN c USING (conv_id, turn) LEFT JOIN par USING (conv_id, turn) LEFT JOIN top USING (conv_id, turn)
LEFT JOIN n USING (conv_id, turn) LEFT JOIN m USING (conv_id, turn)
"""
