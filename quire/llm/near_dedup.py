"""Near-duplicate detection: one-permutation MinHash, banded buckets, star-shaped candidate edges, links confirmed on full sets.

1. Each text becomes the set of 64-bit hashes of its distinct ``shingle``-word shingles; texts of equal sets are one
   class, a node. Whatever follows works on nodes, so copies cost nothing more.
2. One permutation of the hashes is cut into ``bands * rows`` bins; an empty bin takes the value of the first filled bin
   in an order of its own (optimal densification). Each band of bins gives a bucket key.
3. In a bucket, candidates are edges from one centre to the members, never all pairs. Priorities are those of nodes, not
   of (node, bucket), so buckets of one group mostly agree on their centre and make few distinct edges. First each node's
   edge of most shared buckets is confirmed, and links become components; then, in buckets that hold several
   components, ``stars`` rounds of edges from a new centre in the bucket's largest component to the others' members.
4. Nodes of buckets that still hold several components are joined exactly: their shingles are ordered by rarity among
   them, and only pairs that share a shingle in both prefixes, under length and positional bounds and across components,
   are candidates. A node of which a fifth of the shingles stands nowhere else among them has no candidates at all.
5. Every edge is confirmed by the two full sets before it links. The sets are kept once for each candidate node; a
   fixed-size bitmap of candidate ids keeps other texts from being hashed again for that.
6. Links become components by minimum labels with pointer jumping, in written tables.

At similarity 0.8, 40 bands of 6 rows miss a pair with a chance of 5e-6; no candidate is dropped after that.

Defined cases: a text without words (null, empty, blank) has no shingles, and is its own component. A text of fewer words
than a shingle has its whole sequence as the one shingle. Repeated rows give equal result rows. Rows of one doc_id with
different texts are documents of their own, each in the component of its text: the shared id links nothing. A null doc_id
is in no component: component_id null, kept true. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm._common import cut, discard, small_batches, texts

_SIGNED = np.int64


@dataclass(frozen=True)
class Near:
    shingle: int = 5
    percent: int = 80
    bands: int = 40
    rows: int = 6
    stars: int = 1  # rounds of later centres, before what is left is joined by prefixes
    filter_bits: int = 23  # of the bitmap of candidate ids: 1 MB


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of unsigned 64-bit integers (the finaliser of SplitMix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and for each text where its words begin (one more at the end)."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts(column)))
    flat, offsets = lists.flatten(), np.asarray(lists.offsets, dtype=np.int64)
    offsets = offsets - offsets[0]
    filled = np.asarray(pc.not_equal(flat, ""), dtype=bool)
    coded = pc.dictionary_encode(flat)
    codes = np.asarray(coded.indices, dtype=np.int64)
    known = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()), dtype=np.uint64, count=len(coded.dictionary))
    hashes = known[codes][filled] if len(codes) else np.zeros(0, np.uint64)
    return hashes, np.concatenate([[0], np.cumsum(filled)])[offsets]


def shingle_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles."""
    hashes, starts = word_hashes(column)
    with np.errstate(over="ignore"):
        shingles = np.zeros(len(hashes), np.uint64)
        for j in range(k):
            nxt = np.zeros(len(hashes), np.uint64)
            nxt[: max(0, len(hashes) - j)] = hashes[j:]
            shingles = mixed(shingles * np.uint64(0x9E3779B97F4A7C15) + nxt + np.uint64(j + 1))
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            if b - a >= k:
                yield np.unique(shingles[a : b - k + 1])
            elif b > a:
                h = np.zeros(1, np.uint64)
                for x in hashes[a:b]:
                    h = mixed(h * np.uint64(0xD6E8FEB86659FD93) + x)
                yield h
            else:
                yield np.zeros(0, np.uint64)


def bin_orders(bins: int) -> np.ndarray:
    """Row j: the priority of each bin when bin j is empty."""
    with np.errstate(over="ignore"):
        return mixed(np.arange(bins * bins, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(77)).reshape(bins, bins)


def signature(values: np.ndarray, edges: np.ndarray, orders: np.ndarray) -> np.ndarray:
    """The least value of each bin of sorted ``values``; empty bins are densified."""
    at = np.searchsorted(values, edges)
    filled = np.flatnonzero(at[:-1] < at[1:])
    sig = np.zeros(len(orders), np.uint64)
    sig[filled] = values[at[filled]]
    if len(filled) < len(sig):
        empty = np.flatnonzero(at[:-1] == at[1:])
        sig[empty] = sig[filled[np.argmin(orders[np.ix_(empty, filled)], axis=1)]]
    return sig


def _signed(lists: list[np.ndarray]) -> pa.Array:
    flat = np.concatenate(lists).view(_SIGNED) if lists else np.zeros(0, _SIGNED)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(x) for x in lists])]), pa.int32()), pa.array(flat))


def digest_of(values: np.ndarray) -> bytes | None:
    """128 bits of a set; none for an empty one."""
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest() if len(values) else None


def _sketches(how: Near):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = how.bands * how.rows
        edges = np.array([min((j << 64) // bins, (1 << 64) - 1) for j in range(bins + 1)], dtype=np.uint64)
        orders = bin_orders(bins)
        salt = mixed(np.arange(1, how.bands + 1, dtype=np.uint64))
        for batch in small_batches(batches):
            sizes, digests, keys = [], [], []
            for values in shingle_sets(batch.column("text"), how.shingle):
                sizes.append(len(values))
                digests.append(digest_of(values))
                if len(values):
                    rows = signature(values, edges, orders).reshape(how.bands, how.rows)
                    with np.errstate(over="ignore"):
                        key = salt.copy()
                        for j in range(how.rows):
                            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, j])
                    keys.append(key)
                else:
                    keys.append(np.zeros(0, np.uint64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("mark"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), _signed(keys)], ["doc_id", "mark", "n_shingles", "digest", "keys"])

    return run


def _wanted_sets(how: Near, words: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(pc.fill_null(batch.column("doc_id").cast(pa.int64()), 0))
            with np.errstate(over="ignore"):
                at = mixed(ids.view(np.uint64)) >> np.uint64(64 - how.filter_bits)
            wanted = (words[(at >> np.uint64(5)).astype(np.int64)] >> (at & np.uint64(31)).astype(np.int64)) & 1
            batch = batch.filter(pa.array(wanted.astype(bool)))
            for part in small_batches([batch] if len(batch) else []):
                sets = list(shingle_sets(part.column("text"), how.shingle))
                yield pa.RecordBatch.from_arrays([pa.array([digest_of(x) for x in sets], pa.binary()), _signed(sets)], ["digest", "values"])

    return run


def _bitmap(ids: DataFrame, how: Near) -> np.ndarray:
    """A bit for each id's hash: at most ``2 ** filter_bits / 32`` rows reach the driver, whatever the number of ids."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            with np.errstate(over="ignore"):
                at = mixed(np.asarray(batch.column("id")).view(np.uint64)) >> np.uint64(64 - how.filter_bits)
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(5)).astype(np.int64)), pa.array((1 << (at & np.uint64(31)).astype(np.int64)))], ["w", "v"])

    words = np.zeros(1 << (how.filter_bits - 5), np.int64)
    got = ids.mapInArrow(bits, "w long, v long").groupBy("w").agg(F.bit_or("v").alias("v")).toArrow()
    words[np.asarray(got["w"])] = np.asarray(got["v"])
    return words


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """id, comp: the smallest id that each of ``nodes`` (id, comp: a label in its component so far) reaches over ``edges`` (a, b)."""
    both = cut(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = cut(nodes.select("id", "comp"), "labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), F.col("comp").alias("c")), "b").groupBy("a").agg(F.min("c").alias("c"))
        # A label hooks to the least label next to any of its members; then labels jump to their label's label.
        mine = labels.join(near, labels["id"] == near["a"]).select("comp", "c")
        hook = cut(mine.filter("c < comp").groupBy(F.col("comp").alias("from")).agg(F.min("c").alias("to")), "hooks")
        if hook.isEmpty():
            discard(both, hook)
            return labels
        jump = hook.join(hook.select(F.col("from").alias("to"), F.col("to").alias("further")), "to", "left").select("from", F.coalesce("further", "to").alias("to"))
        new = cut(labels.join(jump, labels["comp"] == jump["from"], "left").select("id", F.coalesce("to", "comp").alias("comp")), "labels")
        discard(labels, hook)
        labels = new


def _similar(a: str, b: str, how: Near):
    """Whether two columns of sets are similar enough; sizes too far apart end it before the sets are met."""
    common = F.size(F.array_intersect(a, b))
    near = (100 * F.least(F.size(a), F.size(b)) >= how.percent * F.greatest(F.size(a), F.size(b)))
    return near & ((100 + how.percent) * common >= how.percent * (F.size(a) + F.size(b)))


def _confirmed(edges: DataFrame, sets: DataFrame, how: Near) -> DataFrame:
    """The edges (a, b: ids) whose sets are similar."""
    half = edges.select("a", "b").join(sets.select(F.col("id").alias("b"), F.col("values").alias("vb")), "b")
    return half.join(sets.select(F.col("id").alias("a"), F.col("values").alias("va")), "a").filter(_similar("va", "vb", how)).select("a", "b")


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """key, id, comp of buckets that have two components or more."""
    rows = members.select("key", "id").join(labels, "id")
    both = rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("key")
    return cut(rows.join(both, "key", "left_semi"), "open")


def _later_stars(rows: DataFrame, turn: int) -> DataFrame:
    """Distinct edges from each bucket's centre, a member of its largest component, to the members of the others."""
    p = F.xxhash64(F.lit(turn), "id")
    of = rows.groupBy("key", "comp").agg(F.count("*").alias("n"), F.min_by("id", p).alias("c"))
    top = of.groupBy("key").agg(F.max_by("c", "n").alias("c"), F.max("n").alias("n")).join(of.select("key", "c", F.col("comp").alias("main")), ["key", "c"])
    return rows.join(top.select("key", "c", "main"), "key").filter("comp <> main").select(F.least("id", "c").alias("a"), F.greatest("id", "c").alias("b")).distinct()


def _prefix_pairs(nodes: DataFrame, sets: DataFrame, how: Near) -> DataFrame:
    """a, b: pairs of ``nodes`` (id, comp) across components that may be similar: they share a shingle of both prefixes, and the bounds hold."""
    tokens = nodes.join(sets, "id").select("id", "comp", F.size("values").alias("n"), F.explode("values").alias("h"))
    shared = tokens.groupBy("h").agg(F.count("*").alias("df")).filter("df > 1")
    lists = tokens.join(shared, "h").groupBy("id", "comp", "n").agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("l"))  # one text's shingles
    # the shingles that no other node has come first in the order, and take their part of the prefix
    alone = F.col("n") - F.size("l")
    lists = lists.withColumn("alone", alone).withColumn("need", F.greatest(F.col("n") - F.expr(f"({how.percent} * n + 99) div 100").cast("int") + 1 - alone, F.lit(0)))
    prefix = lists.filter("need > 0").select("id", "comp", "n", "alone", F.posexplode(F.slice("l", 1, F.col("need"))).alias("i", "t"))
    prefix = cut(prefix.select(F.col("t.h").alias("h"), "id", "comp", "n", (F.col("n") - F.col("alone") - F.col("i")).alias("left")), "prefixes")
    other = prefix.select("h", F.col("id").alias("b"), F.col("comp").alias("comp_b"), F.col("n").alias("n_b"), F.col("left").alias("left_b"))
    sizes = (100 * F.least("n", "n_b") >= how.percent * F.greatest("n", "n_b")) & ((100 + how.percent) * F.least("left", "left_b") >= how.percent * (F.col("n") + F.col("n_b")))
    met = prefix.join(other, (prefix["h"] == other["h"]) & (F.col("id") < F.col("b")) & (F.col("comp") != F.col("comp_b")) & sizes)
    return met.select(F.col("id").alias("a"), "b").distinct()


def _linked(nodes: DataFrame, members: DataFrame, sets: DataFrame, how: Near) -> DataFrame:
    """id, comp: components of ``nodes`` (id), whose buckets are ``members`` (key, id, a: the bucket's centre)."""
    edges = members.filter("a <> id").groupBy("a", "id").agg(F.count("*").alias("n"))
    best = edges.groupBy("id").agg(F.max_by("a", F.col("n") * (1 << 32) + F.hash("a")).alias("a")).select("a", F.col("id").alias("b"))
    links = cut(_confirmed(best, sets, how), "links")
    labels = components(nodes.select("id", F.col("id").alias("comp")), links)
    discard(links)
    for turn in range(how.stars):
        open_ = _open(members, labels)
        links = cut(_confirmed(_later_stars(open_, turn), sets, how), "links")
        done = links.isEmpty()
        if not done:
            labels = components(labels, links)
        discard(links, open_)
        if done:
            break
    open_ = _open(members, labels)
    if not open_.isEmpty():
        links = cut(_confirmed(_prefix_pairs(open_.select("id", "comp").distinct(), sets, how), sets, how), "links")
        labels = components(labels, links)
        discard(links)
    discard(open_)
    return labels


def _grouped(rows: DataFrame, how: Near) -> DataFrame:
    """doc_id, mark, n_shingles, component, node (the component's; null without shingles) for rows of doc_id, text and a mark."""
    sketch = cut(rows.mapInArrow(_sketches(how), "doc_id long, mark long, n_shingles long, digest binary, keys array<bigint>"), "sketches")
    named = sketch.filter("doc_id is not null and digest is not null")
    classes = named.groupBy("digest").agg(F.min("doc_id").alias("doc"), F.first("keys").alias("keys"))
    classes = cut(classes.withColumn("id", F.monotonically_increasing_id()), "classes")  # unique, and fixed as written

    members = classes.select("id", F.explode("keys").alias("key"))
    buckets = members.groupBy("key").agg(F.count("*").alias("m"), F.min_by("id", F.xxhash64("id")).alias("a")).filter("m > 1")
    members = cut(members.join(buckets, "key").select("key", "id", "a"), "members")
    candidates = cut(classes.join(members.select("id").distinct(), "id", "left_semi").select("id", "doc", "digest"), "candidates")
    owner = classes.select("digest", F.col("doc").alias("component"), F.col("id").alias("node"))
    if not candidates.isEmpty():
        wanted = _wanted_sets(how, _bitmap(candidates.select(F.col("doc").alias("id")), how))
        found = rows.select("doc_id", "text").mapInArrow(wanted, "digest binary, values array<bigint>")
        sets = cut(found.join(candidates.select("digest", "id"), "digest").dropDuplicates(["digest"]).select("id", "values"), "sets")  # equal digests are equal sets
        labels = _linked(candidates, members, sets, how)
        discard(sets)
        # From nodes back to documents: the smallest doc_id of each component of two classes or more.
        of = candidates.join(labels, "id").select("digest", "doc", "comp")
        least = of.groupBy("comp").agg(F.min("doc").alias("least"), F.count("*").alias("n")).filter("n > 1").select("comp", "least")
        linked = of.join(least, "comp").select(F.col("digest").alias("d"), "comp", "least")
        owner = owner.join(linked, F.col("digest") == F.col("d"), "left").select("digest", F.coalesce("least", "component").alias("component"), F.coalesce("comp", "node").alias("node"))
    owner = cut(owner, "owners")  # a plain table, so that a join of many copies of one text can be split
    out = sketch.select("doc_id", "mark", "n_shingles", "digest").join(owner.withColumnRenamed("digest", "d"), F.col("digest") == F.col("d"), "left")
    return out.select("doc_id", "mark", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component"), "node")


def near_duplicates(docs: DataFrame, how: Near = Near()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row for each row of ``docs``."""
    out = _grouped(docs.select("doc_id", "text", F.lit(0).cast("long").alias("mark")), how)
    return out.select("doc_id", "n_shingles", F.col("component").alias("component_id"), F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True)).alias("kept"))


def without_near_duplicates(docs: DataFrame, how: Near = Near()) -> DataFrame:
    """One row of ``docs`` for each component, with all its columns: of the smallest doc_id, and of its rows the one of the least hash. Rows of null doc_id stay.

    Rows without shingles are one component for each doc_id.
    """
    plain = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), docs["doc_id"].alias("_id"), docs["text"].alias("_text"))
    plain = plain.withColumn("_mark", F.xxhash64("_row"))
    known = plain.filter(F.col("_id").isNotNull())
    groups = _grouped(known.select(F.col("_id").alias("doc_id"), F.col("_text").alias("text"), F.col("_mark").alias("mark")), how)
    keep = groups.filter(F.col("doc_id") == F.col("component")).groupBy("component", "node").agg(F.min("mark").alias("mark"))
    rows = known.join(keep.select("component", "mark").distinct(), (F.col("_id") == F.col("component")) & (F.col("_mark") == F.col("mark")), "left_semi")
    rows = rows.dropDuplicates(["_id", "_mark"])  # equal rows; dealt out by the join already
    of = lambda rows: rows.select(*[F.col(f"_row.`{c}`") for c in docs.columns])
    return of(rows).unionByName(of(plain.filter(F.col("_id").isNull())))
