"""A Merkle manifest of a dataset: a digest for each row, trees of them, and a proof for each row.

Leaves are digests of rows. A tree's nodes are numbered; while several remain, every ``fan``
consecutive ones become the digest of their digests. The leaves of each lang make a tree, and
the langs' roots make one more. Nodes are worked on in blocks of ``fan ** deep`` numbers, which hold
whole runs at ``deep`` levels: a task gets a block as Arrow data, and DuckDB makes its levels with
an ordered string_agg and a sha256 a level. Block roots are the nodes of the next round, until one is left.

Proofs go the other way: a round's blocks are joined (cogroup) with the proofs of the blocks'
roots, and the levels are made once more, so that a leaf's siblings never leave its task; only
its proof's digest does.

Leaves are numbered by a range partitioning by lang and doc_id, and counts of each part: no lang's
rows meet in one task. The driver gets one number for each round.

Defined cases: a null value counts as ``-``. A null doc_id comes before all others of its lang and is
not tampered with; rows that share a doc_id are leaves of their own, in order of their digests. A
null lang has a tree of its own, the first. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm._common import LOWER, UPPER, ascii_lower, cut, discard, worker_cache

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN, DEEP = 8, 4
_HEX = 64
_PATH = "array<struct<l:string,r:string>>"


def leaf_hash(row: dict[str, Column]) -> Column:
    """sha256 of all fields, each with its length before it."""

    def part(value: Column) -> Column:
        value = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*[part(row[c]) for c in FIELDS]), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, tree (its lang's key; keys' order is that of langs), leaf, fake: the leaf of a row that was tampered with, else null."""
    row = {c: docs[c] for c in FIELDS}
    struck = F.coalesce(F.crc32(docs["doc_id"].cast("string").cast("binary")) % 3 == 0, F.lit(False)) & (F.translate(docs["text"], UPPER, LOWER) != docs["text"])
    fake = F.when(struck, leaf_hash(row | {"text": ascii_lower(docs["text"])}))
    return docs.select(docs["doc_id"], F.coalesce(F.concat(F.lit(":"), docs["lang"]), F.lit("-")).alias("tree"), leaf_hash(row).alias("leaf"), fake.alias("fake"))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``nr``, from 0 in each tree by ``order``, and ``n``, the tree's number of rows; written, so that numbers stay."""
    ranged = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    ranged = cut(ranged.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), "ranged")
    parts = ranged.groupBy("tree", "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))  # a row for each part and tree
    whole = Window.partitionBy("tree")
    earlier = F.coalesce(F.sum("_n").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("tree", "_part", (earlier - F.col("_first")).alias("_shift"), F.sum("_n").over(whole).alias("n"))
    out = cut(ranged.join(parts, ["tree", "_part"]).select(*rows.columns, (F.col("_at") + F.col("_shift")).alias("nr"), "n"), "numbered")
    discard(ranged)
    return out


def _levels(n: int) -> int:
    """How many levels a block of a tree of ``n`` nodes makes."""
    levels = 0
    while n > 1 and levels < DEEP:
        n, levels = -(-n // FAN), levels + 1
    return levels


def _engine():
    """The worker's DuckDB: one thread, bounded memory, no files."""
    import duckdb

    cache = worker_cache()
    if "duckdb" not in cache:
        cache["duckdb"] = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
    return cache["duckdb"]


def _climb(db, nodes: pa.Table, levels: int) -> None:
    """Tables run0, run1, ... of each level's runs (up, joined: the run's digests one after the other), and level0, level1, ... of its nodes."""
    db.register("given", nodes.select(["nr", "h"]))
    db.execute("CREATE OR REPLACE TEMP TABLE level0 AS SELECT nr, h FROM given").fetchall()
    for k in range(levels):
        db.execute(f"CREATE OR REPLACE TEMP TABLE run{k} AS SELECT nr // {FAN} AS up, string_agg(h, '' ORDER BY nr) AS joined FROM level{k} GROUP BY 1").fetchall()
        db.execute(f"CREATE OR REPLACE TEMP TABLE level{k + 1} AS SELECT up AS nr, sha256(joined) AS h FROM run{k}").fetchall()
    db.unregister("given")


def _siblings(levels: int) -> tuple[str, str]:
    """Select items l0, r0, l1, ...: what stands left and right of a node of level0 and its ancestors in their runs; and the joins that they need."""
    items, joins = [], []
    for k in range(levels):
        slot = f"(m.nr // {FAN**k}) % {FAN}"
        items.append(f"substring(run{k}.joined, 1, {_HEX} * ({slot})) AS l{k}, substring(run{k}.joined, {_HEX} * ({slot}) + {_HEX + 1}) AS r{k}")
        joins.append(f"JOIN run{k} ON m.nr // {FAN ** (k + 1)} = run{k}.up")
    return ", ".join(items), " ".join(joins)


def _block() -> Column:
    return F.expr(f"nr div {FAN**DEEP}")


def block_roots(nodes: DataFrame) -> DataFrame:
    """The next round's nodes: tree, nr, h, n."""

    def run(block: pa.Table) -> pa.Table:
        n = block["n"][0].as_py()
        levels = _levels(n)
        db = _engine()
        _climb(db, block, levels)
        root = db.execute(f"SELECT h FROM level{levels}").fetchall()
        assert len(root) == 1
        return pa.table({"tree": block["tree"].slice(0, 1), "nr": [block["nr"][0].as_py() // FAN**DEEP], "h": [root[0][0]], "n": [-(-n // FAN**levels)]}, schema=pa.schema([("tree", pa.string()), ("nr", pa.int64()), ("h", pa.string()), ("n", pa.int64())]))

    return nodes.select("tree", "nr", "h", "n").groupBy("tree", _block().alias("block")).applyInArrow(run, "tree string, nr bigint, h string, n bigint")


def rounds(nodes: DataFrame) -> list[DataFrame]:
    """``nodes`` (tree, nr, h, n), and the nodes of each round after it; the last has one for each tree."""
    out = [nodes]
    while (most := out[-1].agg(F.max("n")).first()[0]) is not None and most > 1:
        out.append(cut(block_roots(out[-1]), "roots"))
    return out


def paths(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """tree, nr, path, root of a round's nodes: what stands left and right on each level up to the root. ``above`` has those of the next round's."""

    def run(block: pa.Table, up: pa.Table) -> pa.Table:
        levels = _levels(block["n"][0].as_py())
        db = _engine()
        _climb(db, block, levels)
        items, joins = _siblings(levels)
        pairs = ", ".join(f"{{'l': l{k}, 'r': r{k}}}" for k in range(levels))
        found = db.sql(f"SELECT nr, [{pairs}] AS path FROM (SELECT m.nr, {items} FROM level0 m {joins})" if levels else "SELECT nr, NULL AS path FROM level0 m").to_arrow_table()
        beyond, root = up["path"][0].as_py() or [], up["root"][0].as_py()
        path = [(p or []) + beyond for p in found["path"].to_pylist()]
        size = len(path)
        return pa.table({"tree": [block["tree"][0].as_py()] * size, "nr": found["nr"].cast(pa.int64()), "path": pa.array(path, pa.list_(pa.struct([("l", pa.string()), ("r", pa.string())]))), "root": [root] * size})

    left = nodes.select("tree", "nr", "h", "n").groupBy("tree", _block().alias("block"))
    return left.cogroup(above.select("tree", "nr", "path", "root").groupBy("tree", F.col("nr").alias("block"))).applyInArrow(run, f"tree string, nr bigint, path {_PATH}, root string")


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: one row for each row of ``docs``."""
    found = numbered(cut(leaves(docs), "leaves"), ["doc_id", "leaf"])
    nodes = rounds(found.select("tree", "nr", F.col("leaf").alias("h"), "n"))
    subroots = nodes[-1].select("tree", F.col("h").alias("subroot"))

    # The tree of subroots: one row for each lang.
    tops = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("subroot").alias("h"))
    tops = numbered(tops, ["name"])
    outer = rounds(tops.select("tree", "nr", "h", "n"))
    above = outer[-1].select("tree", "nr", F.array().cast(_PATH).alias("path"), F.col("h").alias("root"))
    for level in reversed(outer[:-1]):
        above = cut(paths(level, above), "outer")
    above = tops.select("nr", F.col("name").alias("of")).join(above.drop("tree"), "nr").select(F.col("of").alias("tree"), F.lit(0).cast("bigint").alias("nr"), "path", "root")
    for level in reversed(nodes[1:-1]):
        above = cut(paths(level, above), "inner")
    above = above.join(subroots, "tree")  # a row for each block of leaves, at most
    whole = len(nodes) > 1  # else every tree is a leaf alone

    def run(block: pa.Table, up: pa.Table) -> pa.Table:
        levels = _levels(block["n"][0].as_py())
        db = _engine()
        _climb(db, block.rename_columns(["h" if c == "leaf" else c for c in block.column_names]), levels)
        db.register("rows_in", block)
        items, joins = _siblings(levels)
        folds = ["coalesce(fake, leaf) AS c0"] + [f"sha256(l{k} || c{k} || r{k}) AS c{k + 1}" for k in range(levels)]
        proof = " || ".join([f"l{k} || r{k}" for k in range(levels)] + ["''"])
        inside = f"SELECT doc_id, leaf, {', '.join(folds)}, {proof} AS proof FROM (SELECT m.doc_id, m.leaf, m.fake{', ' + items if items else ''} FROM rows_in m {joins})"
        beyond = [(p["l"], p["r"]) for p in up["path"][0].as_py() or []]
        fold = f"c{levels}"
        for left, right in beyond:  # digests alone
            fold = f"sha256('{left}' || {fold} || '{right}')"
        rest = "".join(left + right for left, right in beyond)
        root, subroot = up["root"][0].as_py(), up["subroot"][0].as_py()
        out = db.sql(f"SELECT doc_id, leaf, '{subroot}' AS subroot, '{root}' AS root, sha256(proof || '{rest}') AS proof_sha256, {fold} AS folded_root, {fold} = '{root}' AS verified FROM ({inside})").to_arrow_table()
        db.unregister("rows_in")
        return out

    size = FAN**DEEP if whole else 1
    left = found.select("doc_id", "leaf", "fake", "tree", "nr", "n").groupBy("tree", F.expr(f"nr div {size}").alias("block"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return left.cogroup(above.groupBy("tree", F.col("nr").alias("block"))).applyInArrow(run, f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


#: The same rows in DuckDB: levels by recursion over whole trees, proofs by a walk from each leaf to the root.
ORACLE_SQL = r"""
WITH RECURSIVE
d AS (SELECT doc_id, lang, CASE WHEN lang IS NULL THEN '-' ELSE ':' || lang END AS tree, '' AS none,
        coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
        coalesce(strlen(text) || ':' || text, '-') AS tail, coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-') AS low,
        list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
          lambda c, x: list_reduce(list_concat([xor(c, x)], [0::BIGINT, 1, 2, 3, 4, 5, 6, 7]), lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)) AS crc
      FROM documents),
lf AS (SELECT doc_id, tree, sha256(head || tail) AS leaf, CASE WHEN doc_id IS NOT NULL AND xor(crc, 4294967295) % 3 = 0 THEN sha256(head || low) ELSE sha256(head || tail) END AS fake FROM d),
rk AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS nr FROM lf),
nd AS (
  SELECT tree, 0 AS lev, nr, leaf AS h, count(*) OVER (PARTITION BY tree) AS n FROM rk
  UNION ALL
  SELECT tree, lev + 1, nr // 8, sha256(string_agg(h, '' ORDER BY nr)), (n + 7) // 8 FROM nd WHERE n > 1 GROUP BY tree, lev, nr // 8, n),
sub AS (SELECT tree, h AS subroot, lev AS height FROM nd WHERE n = 1),
tops AS (
  SELECT 0 AS lev, row_number() OVER (ORDER BY tree) - 1 AS nr, subroot AS h, count(*) OVER () AS n FROM sub
  UNION ALL
  SELECT lev + 1, nr // 8, sha256(string_agg(h, '' ORDER BY nr)), (n + 7) // 8 FROM tops WHERE n > 1 GROUP BY lev, nr // 8, n),
place AS (SELECT tree, row_number() OVER (ORDER BY tree) - 1 AS seat FROM sub),
runs AS (SELECT tree, lev, nr // 8 AS up, string_agg(h, '' ORDER BY nr) AS joined FROM nd WHERE n > 1 GROUP BY ALL
         UNION ALL
         SELECT s.tree, s.height + t.lev, t.nr // 8, string_agg(t.h, '' ORDER BY t.nr) FROM sub s, tops t WHERE t.n > 1 GROUP BY ALL),
walk AS (
  SELECT rk.doc_id, rk.tree, rk.nr AS leaf_nr, leaf, fake AS cur, '' AS proof, 0 AS lev, rk.nr AS pos, height, seat FROM rk JOIN sub USING (tree) JOIN place USING (tree)
  UNION ALL
  SELECT doc_id, tree, leaf_nr, leaf, sha256(substring(joined, 1, 64 * (p % 8)) || cur || substring(joined, 64 * (p % 8) + 65)), proof || substring(joined, 1, 64 * (p % 8)) || substring(joined, 64 * (p % 8) + 65), lev + 1, p // 8, height, seat
  FROM (SELECT w.*, CASE WHEN lev = height THEN seat ELSE pos END AS p FROM walk w) v JOIN runs r USING (tree, lev) WHERE r.up = p // 8),
fin AS (SELECT * FROM walk QUALIFY row_number() OVER (PARTITION BY tree, leaf_nr ORDER BY lev DESC) = 1),
top AS (SELECT h AS root FROM tops WHERE n = 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = root AS verified FROM fin JOIN sub USING (tree), top
"""
