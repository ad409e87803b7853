"""Audit of how filters interact: what each removes in every order, from one pass over the texts.

Each document gets a mask of the filters it fails. Counts by part and mask, 32 numbers a part, are
all that is kept; the subset-zeta transform turns them into the survivors of every filter subset,
and every step of every order is a difference between two neighbouring subsets. The same is
done for documents of the labels quality = 1 and toxic = 1.

Filter E (a text that a smaller doc_id has) needs no pairs: of equal texts all but those of the
smallest doc_id fail. Equal texts meet by their SHA-256, after equal rows were summed where they are read,
so a text that a third of all rows have is a few rows by then.

Defined cases: a null text is an empty one. A null lang and an empty one are the same part. A row
with a null doc_id has no label, never fails E and makes no other row fail it. Rows that share a doc_id are
documents of their own, and fail E by smaller doc_ids alone. Of labels that differ for one doc_id the
greatest counts. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm._common import cut, space_words

FILTERS = "ABCDE"
_ALL = (1 << len(FILTERS)) - 1
_E = 1 << FILTERS.index("E")


def text_mask(text: Column, min_words: int = 100, min_distinct: int = 80, max_capitals: int = 10) -> Column:
    """Which of the filters A to D a text fails, as bits 0 to 3. The shares are percentages."""
    words = space_words(text)
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    fails = (
        F.size(words) < min_words,
        100 * F.size(F.array_distinct(words)) < min_distinct * F.size(words),
        100 * capitals > max_capitals * F.length(text),
        text.rlike(r"[#$%&*|]"),
    )
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: how many documents fail just the mask's filters."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text_mask(text).alias("mask"), F.when(F.col("doc_id").isNotNull(), F.sha2(text, 256)).alias("same"))
    rows = rows.groupBy("doc_id", "part", "mask", "same").agg(F.count("*").alias("n"))
    known = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_of")).agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    rows = rows.join(known, F.col("doc_id") == F.col("_of"), "left")
    is_good, is_toxic = F.coalesce(F.col("quality") == 1, F.lit(False)), F.coalesce(F.col("toxic") == 1, F.lit(False))
    # doc_ids of one text are distinct within a kind, so min_by has all rows of the smallest one of it
    kinds = rows.groupBy("same", "part", "mask", is_good.alias("is_good"), is_toxic.alias("is_toxic")).agg(F.sum("n").alias("n"), F.min("doc_id").alias("first"), F.min_by("n", "doc_id").alias("n_first"))
    kinds = cut(kinds, "kinds")  # read twice from here on
    least = kinds.filter("same is not null").groupBy(F.col("same").alias("_same")).agg(F.min("first").alias("least"))
    kinds = kinds.join(least, F.col("same") == F.col("_same"), "left")
    own = F.when(F.col("least").isNull(), F.col("n")).when(F.col("first") == F.col("least"), F.col("n_first")).otherwise(0)
    either = F.explode(F.array(F.struct(F.col("mask").alias("mask"), own.alias("n")), F.struct((F.col("mask") + _E).alias("mask"), (F.col("n") - own).alias("n"))))
    rows = kinds.select("part", "is_good", "is_toxic", either.alias("x")).select("part", "is_good", "is_toxic", "x.*")
    return rows.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("is_good"), F.col("n")).otherwise(0)).alias("good"), F.sum(F.when(F.col("is_toxic"), F.col("n")).otherwise(0)).alias("toxic"))


def survivors(counts: DataFrame) -> DataFrame:
    """part, and n, good, toxic as arrays over all filter subsets: entry s has how many documents the filters of s leave."""
    rows = counts.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("mask", F.struct("n", "good", "toxic")))).alias("m"))  # 32 at most
    kinds = ("n", "good", "toxic")
    rows = rows.select("part", *[F.expr(f"transform(sequence(0, {_ALL}), i -> coalesce(m[i].{k}, 0L))").alias(k) for k in kinds])
    for bit in range(len(FILTERS)):  # zeta: sums over all subsets of the failures that stay allowed
        rows = rows.select("part", *[F.expr(f"transform({k}, (x, i) -> IF(i & {1 << bit} = 0, x, x + get({k}, i - {1 << bit})))").alias(k) for k in kinds])
    return rows.select("part", *[F.reverse(k).alias(k) for k in kinds])  # the complement of s is at the mirrored place


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row for each part, order of the filters and step: part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    rows = survivors(mask_counts(docs, labels))
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    rows = rows.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))

    def bits(letters: Column) -> Column:
        return sum((F.when(F.instr(letters, f) > 0, 1 << i).otherwise(0) for i, f in enumerate(FILTERS)), F.lit(0))

    def at(kind: str, subset: Column | int) -> Column:
        return F.get(F.col(kind), F.lit(subset) if isinstance(subset, int) else subset)

    before, own = F.expr("substring(filter_order, 1, step - 1)"), F.expr("substring(filter_order, step, 1)")
    rows = rows.withColumn("before", bits(before)).withColumn("own", bits(own))
    after = F.col("before") + F.col("own")
    removed = at("n", F.col("before")) - at("n", after)
    # The sum over all orders: a subset stands before its next filter in so many of them.
    weights = [factorial(bin(s).count("1")) * factorial(max(0, len(FILTERS) - 1 - bin(s).count("1"))) for s in range(_ALL + 1)]
    rows = rows.withColumn("w", F.lit(weights).cast("array<bigint>"))
    shapley = F.expr(f"aggregate(sequence(0, {_ALL}), 0L, (a, s) -> IF(s & own = 0, a + get(w, s) * (get(n, s) - get(n, s + own)), a))")
    return rows.select(
        "part", "filter_order", "step", at("n", after).alias("kept"), removed.alias("removed"), (at("n", 0) - at("n", F.col("own")) - removed).alias("redundant"),
        (at("n", F.lit(_ALL) - F.col("own")) - at("n", _ALL)).alias("unique_fails"), (at("good", F.col("before")) - at("good", after)).alias("good_lost"),
        (at("toxic", F.col("before")) - at("toxic", after)).alias("toxic_lost"), shapley.alias("shapley"),
    )


#: The same rows in DuckDB, without the transform: each kind of document falls at the first filter of an order that it fails.
ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
lb AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY text) AS least FROM d),
f AS (SELECT w.doc_id, part, CASE WHEN len(ws) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 'B' ELSE '' END
        || CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 10 * length(text) THEN 'C' ELSE '' END || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
        || CASE WHEN coalesce(w.doc_id > least, false) THEN 'E' ELSE '' END AS fails, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS bad
      FROM w LEFT JOIN lb ON lb.doc_id = w.doc_id),
k AS (SELECT part, fails, good, bad, count(*) AS n FROM f GROUP BY ALL),
five AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
ord AS (SELECT a.x || b.x || c.x || e.x || g.x AS filter_order FROM five a, five b, five c, five e, five g
        WHERE len(list_distinct([a.x, b.x, c.x, e.x, g.x])) = 5),
st AS (SELECT filter_order, step, filter_order[step] AS own FROM ord, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
fall AS (SELECT k.*, filter_order, coalesce(list_min(list_filter([position(x IN filter_order) FOR x IN ['A', 'B', 'C', 'D', 'E'] IF position(x IN fails) > 0], lambda p: p > 0)), 6) AS at_step FROM k, ord),
r AS (SELECT part, st.filter_order, st.step, st.own, sum(CASE WHEN at_step > step THEN n ELSE 0 END) AS kept, sum(CASE WHEN at_step = step THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN at_step < step AND position(own IN fails) > 0 THEN n ELSE 0 END) AS redundant, sum(CASE WHEN fails = own THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN at_step = step AND good THEN n ELSE 0 END) AS good_lost, sum(CASE WHEN at_step = step AND bad THEN n ELSE 0 END) AS toxic_lost
      FROM fall JOIN st USING (filter_order) GROUP BY part, st.filter_order, st.step, st.own)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
  toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM r
"""
