"""Mixing sources to target weights.

Each source's texts, in a fixed pseudorandom order, are one stream of words, packed into blocks
of ``block`` words (the last one of a source may be shorter). Sources of under ``parts`` such blocks
have smaller ones, about ``parts`` of them, so that whole blocks come near their targets too. A source
has a goal of as many slots as blocks of its mean size make its target, in whole numbers (rounded by a random offset) over groups of ``group`` output shards
of ``shard`` slots each. The source counts of a shard are drawn as a multinomial over the sources; each source's chance is what it
lacks, by then, of its part of the goal (so what one shard draws too little or too much, the next ones make up).
Draws that would take a source above ``most`` times its blocks are drawn again over the others. The counts drawn, and nothing
else, say what is taken. A source's slots are numbered over all shards by sums of the counts; slot k is
mapped through the source's pseudorandom permutation of block indexes (swap-or-not, one for each
pass over the source), and slots and blocks are joined by that index. No block is taken more
than ``most`` times, so no document is.

Scale: the driver gets one row for each source (its size), and sends as much back; the sources must be that few.
Streams are laid out by sums over small chunks of documents and sums over groups of chunks, so a source with a third of
all rows is many small groups; groups of shards are drawn, and slots made, in as many tasks as their number asks for.

Defined cases: a null text has size 0 and takes 0. A null source is a source of its own, last in
order. Repeated rows are separate documents, each taken for itself. An empty table, or one
without words, gives targets of 0. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm._common import SPACE_CHARS, cut, space_words


@dataclass(frozen=True)
class Mix:
    """weights repeat over the sources in code point order, null last; most: times a source or document may be taken."""

    weights: tuple[float, ...] = (1, 2, 3)
    most: int = 3
    block: int = 64
    parts: int = 256  # blocks that a source has about, if it has not words for as many of full size
    shard: int = 32  # slots
    group: int = 512  # shards that make up for each other
    chunk: int = 256
    chunks: int = 4096  # whose sums are summed together
    task: int = 1 << 15  # slots that a task makes
    rounds: int = 12
    fine: int = 100  # mixed_rows cuts documents of more than 1/fine of their source's target
    seed: int = 29


def targets(sizes: list[int], weights: list[float], most: int) -> list[float]:
    """Shares of the total by weight, stopped at ``most`` times a size; the excess goes to the others by weight until none is above."""
    total, capped = float(sum(sizes)), set()
    while True:
        free = [i for i in range(len(sizes)) if i not in capped]
        left = total - sum(most * sizes[i] for i in capped)
        weight = sum(weights[i] for i in free)
        rate = left / weight if weight else 0.0
        over = [i for i in free if rate * weights[i] > most * sizes[i]]
        if not over:
            return [float(most * n) if i in capped else rate * weights[i] for i, n in enumerate(sizes)]
        capped.update(over)


def groups_of(n_slots: np.ndarray, how: Mix) -> int:
    return max(1, round(float(n_slots.sum()) / (how.shard * how.group)))


def drawn(n_slots: np.ndarray, caps: np.ndarray, groups: int, group: int, how: Mix) -> Iterator[np.ndarray]:
    """Each source's slots in each shard of a group. n_slots: goals over all groups; caps: the most that a source may get, over all groups."""
    rng = np.random.default_rng([how.seed, group])
    room = (caps * (group + 1)) // groups - (caps * group) // groups
    offset = (np.cumsum(n_slots) - n_slots + np.random.default_rng(how.seed).random()) % 1  # goals are whole numbers in a group, rounded so that those of all groups add up
    goal = np.minimum(np.floor(n_slots * (group + 1) / groups + offset) - np.floor(n_slots * group / groups + offset), room).astype(np.int64)
    size = int(goal.sum())
    taken, shards = np.zeros(len(goal), np.int64), -(-size // how.shard)
    for j in range(shards):
        here, left = np.zeros(len(goal), np.int64), min(how.shard, size - j * how.shard)
        lacks = np.maximum(goal * min(1.0, (j + 1) * how.shard / size) - taken, 0)
        while left:
            free = room - taken - here
            chance = np.where(free > 0, lacks, 0)
            if not chance.sum():
                chance = np.maximum(free, 0)
            got = np.minimum(rng.multinomial(left, chance / chance.sum()), free)
            here, left = here + got, left - int(got.sum())
        taken += here
        yield here


def _before(sums: DataFrame, order: list[str], value: str, how: Mix) -> DataFrame:
    """``sums`` (s, ``order``, of which the last is a number, and ``value``), with ``before``: the sum of a source's values before each row, in two levels."""
    sums = sums.withColumn("group", F.expr(f"{order[-1]} div {how.chunks}"))
    outer, last = [*order[:-1], "group"], Window.unboundedPreceding
    groups = sums.groupBy("s", *outer).agg(F.sum(value).alias("sum"))
    groups = groups.select("s", *outer, F.coalesce(F.sum("sum").over(Window.partitionBy("s").orderBy(*outer).rowsBetween(last, -1)), F.lit(0)).alias("far"))
    near = F.coalesce(F.sum(value).over(Window.partitionBy("s", *outer).orderBy(order[-1]).rowsBetween(last, -1)), F.lit(0))
    return sums.withColumn("near", near).join(groups, ["s", *outer]).select("s", *order, (F.col("far") + F.col("near")).alias("before"))


def mix(docs: DataFrame, how: Mix = Mix()) -> DataFrame:
    """doc_id, size, source_size, target, taken: one row for each row of ``docs``."""
    return _mix(docs, how).select("doc_id", "size", "source_size", "target", "taken")


def _mix(docs: DataFrame, how: Mix) -> DataFrame:
    """As :func:`mix`, with the source's number s and its number of chunks."""
    spark = docs.sparkSession
    sized = docs.select("doc_id", "source", F.size(space_words(F.col("text"))).cast("long").alias("size"), F.xxhash64("text").alias("th"))
    sized = cut(sized, "sizes")
    totals = [(r["source"], r["size"], r["n"]) for r in sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()]
    totals.sort(key=lambda r: (r[0] is None, (r[0] or "").encode("utf-8", "surrogatepass")))
    goals = targets([r[1] for r in totals], [how.weights[i % len(how.weights)] for i in range(len(totals))], how.most)
    block = [max(1, min(how.block, -(-int(r[1]) // how.parts))) for r in totals]
    blocks = [-(-int(r[1]) // b) for r, b in zip(totals, block, strict=True)]
    # Slots by words: never above most * blocks, as no target is above most times its source's size.
    n_slots = np.array([min(g * n / r[1], how.most * n) if r[1] else 0.0 for r, g, n in zip(totals, goals, blocks, strict=True)])
    caps = np.array([how.most * n for n in blocks], dtype=np.int64)
    about = [(i, r[0], int(r[1]), float(g), b, n, max(1, -(-int(r[2]) // how.chunk))) for i, (r, g, b, n) in enumerate(zip(totals, goals, block, blocks, strict=True))]
    sources = spark.createDataFrame(about, "s int, source string, source_size long, target double, block long, blocks long, chunks long")

    # Streams: where each document begins among its source's words.
    docs_of = sized.join(F.broadcast(sources.withColumnRenamed("source", "of")), F.col("source").eqNullSafe(F.col("of"))).drop("of", "source")  # a row for each source
    docs_of = docs_of.withColumn("chunk", F.pmod(F.xxhash64(F.lit(how.seed), "doc_id"), "chunks"))
    chunks = docs_of.groupBy("s", "chunk").agg(F.sum("size").alias("words"))
    chunks = _before(chunks, ["chunk"], "words", how).withColumnRenamed("before", "chunk_start")
    within = F.sum("size").over(Window.partitionBy("s", "chunk").orderBy("doc_id", "th", "size").rowsBetween(Window.unboundedPreceding, -1))
    number = F.row_number().over(Window.partitionBy("s", "chunk").orderBy("doc_id", "th", "size"))
    placed = docs_of.withColumn("start", F.coalesce(within, F.lit(0))).withColumn("nr", number).join(chunks.hint("merge"), ["s", "chunk"])
    placed = placed.withColumn("start", F.col("start") + F.col("chunk_start"))
    first, last = F.expr("start div block"), F.expr("(start + size - 1) div block")
    pieces = placed.withColumn("index", F.explode(F.when(F.col("size") > 0, F.sequence(first, last)).otherwise(F.array(F.lit(-1).cast("long")))))
    words = F.least(F.col("start") + F.col("size"), (F.col("index") + 1) * F.col("block")) - F.greatest(F.col("start"), F.col("index") * F.col("block"))
    pieces = pieces.select("s", "index", "doc_id", "size", "source_size", "target", "chunks", "chunk", "nr", F.when(F.col("index") >= 0, words).otherwise(0).alias("words"))

    # Shards: each source's slots, numbered on from those of earlier shards.
    groups = groups_of(n_slots, how)
    size = int(n_slots.sum())

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in batch.column("id").to_pylist():
                for j, here in enumerate(drawn(n_slots, caps, groups, group, how)):
                    some = np.flatnonzero(here)
                    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(np.full(len(some), group * (2 * how.group + 2) + j)), pa.array(here[some])], ["s", "shard", "n"])

    shards = cut(spark.range(0, groups if size else 0, 1, max(1, min(groups, -(-size // how.task)))).mapInArrow(counts, "s int, shard long, n long"), "shards")
    runs = shards.join(_before(shards, ["shard"], "n", how), ["s", "shard"])
    runs = runs.join(F.broadcast(sources.select("s", "blocks")), "s")  # a row for each source
    # A number of tasks is given: left to itself, the planner sees few bytes before explode and takes one.
    runs = runs.select("s", "blocks", "before", "n").repartition(max(1, -(-size // how.task)), F.col("s"), F.col("before"))
    slots = runs.select("s", "blocks", F.explode(F.expr("sequence(before, before + n - 1)")).alias("k"))
    # Swap-or-not: each round pairs i with key - i and swaps by a hash of the pair: a permutation of 0..blocks-1 for any keys.
    permuted = f"""
        aggregate(sequence(1, {how.rounds}), k % blocks, (i, r) ->
          CASE WHEN xxhash64({how.seed}, s, k div blocks, r, greatest(i, pmod(xxhash64({how.seed}, s, k div blocks, r) - i, blocks))) % 2 = 0
               THEN i ELSE pmod(xxhash64({how.seed}, s, k div blocks, r) - i, blocks) END)"""
    permuted = permuted.replace(f"xxhash64({how.seed}, s, k div blocks, r) - i", f"pmod(xxhash64({how.seed}, s, k div blocks, r), blocks) - i")
    times = slots.select("s", F.expr(permuted).alias("index")).groupBy("s", "index").agg(F.count("*").alias("times"))

    # Both sides grow with the input; the planner doesn't know what explode makes, so it is told not to broadcast.
    return pieces.join(times.hint("merge"), ["s", "index"], "left").groupBy("s", "chunks", "chunk", "nr", "doc_id", "size", "source_size", "target").agg(F.sum(F.col("words") * F.coalesce("times", F.lit(0))).cast("long").alias("taken"))


def _some_words(text: Column, skip: Column, n: Column) -> Column:
    """n words of a text after ``skip`` words, with the white space between them."""
    words = F.split(F.ltrim(text, F.lit(SPACE_CHARS)), r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    return F.rtrim(F.array_join(F.slice(words, skip + 1, n), ""), F.lit(SPACE_CHARS))


def mixed_rows(docs: DataFrame, how: Mix = Mix()) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes its words: whole copies, and for the part left one more or none.

    A document of more than 1/``fine`` of its source's target gets a copy cut to the words left, from a place by hash. The others' parts
    are rounded along their source's stream, by size, so that a source's words stay within about 1/``fine`` of its target.
    """
    one = 1 << 30
    taken = _mix(docs, how).filter("taken > 0").groupBy("doc_id").agg(F.sum("taken").alias("_taken"), F.sum("size").alias("_size"), F.min("s").alias("s"), F.min("chunks").alias("chunks"), F.min("target").alias("target"))
    taken = taken.select(F.col("doc_id").alias("_id"), "_size", (F.col("_taken") % F.col("_size")).alias("_left"), F.expr("_taken div _size").alias("_copies"), "s", "chunks", (F.col("_size") * how.fine > F.col("target")).alias("_long"))
    taken = taken.withColumn("w", F.when(F.col("_long"), 0).otherwise(F.expr(f"_left * {one}L div _size"))).withColumn("class", F.floor(F.log2("_size")))
    taken = cut(taken.withColumn("chunk", F.pmod(F.xxhash64(F.lit(how.seed + 1), "_id"), "chunks")), "taken")
    sums = taken.groupBy("s", "class", "chunk").agg(F.sum("w").alias("sum"))
    sums = _before(sums, ["class", "chunk"], "sum", how)
    within = F.sum("w").over(Window.partitionBy("s", "class", "chunk").orderBy("_size", "_id").rowsBetween(Window.unboundedPreceding, 0))
    taken = taken.withColumn("within", within).join(sums.hint("merge"), ["s", "class", "chunk"])
    taken = taken.withColumn("to", F.col("before") + F.col("within") + F.pmod(F.xxhash64(F.lit(how.seed + 1), "s"), F.lit(one)))
    taken = taken.select("_id", "_size", F.when(F.col("_long"), F.col("_left")).otherwise(0).alias("_left"), (F.col("_copies") + F.expr(f"to div {one}L - (to - w) div {one}L")).cast("int").alias("_copies")).filter("_copies > 0 or _left > 0")
    fields = F.struct(*[docs[c].alias(f"f{i}") for i, c in enumerate(docs.columns)]).alias("_row")
    size = F.size(space_words(docs["text"]))
    rows = docs.select(fields, docs["doc_id"].alias("_key"), size.alias("_words")).join(taken, F.col("_key").eqNullSafe(F.col("_id")))
    rows = rows.withColumn("_part", F.round(F.col("_left") * F.col("_words") / F.col("_size")).cast("int"))
    last = F.col("_copies") + F.when(F.col("_part") > 0, 1).otherwise(0)
    rows = rows.filter(last > 0).withColumn("_copy", F.explode(F.sequence(F.lit(1), last)))
    is_cut = F.col("_copy") > F.col("_copies")
    skip = F.pmod(F.xxhash64(F.lit(how.seed + 2), "_key"), F.col("_words") - F.col("_part") + 1).cast("int")
    of = {c: F.col(f"_row.f{i}") for i, c in enumerate(docs.columns)}
    rows = rows.withColumn("_text", F.when(is_cut, _some_words(of["text"], skip, F.col("_part"))).otherwise(of["text"]))
    of["text"] = F.col("_text")
    if "n_chars" in of:
        of["n_chars"] = F.when(is_cut, F.length("_text").cast(docs.schema["n_chars"].dataType)).otherwise(of["n_chars"])
    return rows.select(*[x.alias(c) for c, x in of.items()])
