"""An index of chunks on disk in buckets, with an inverted index of its texts: a change rewrites its own buckets alone, a text query reads its own terms' alone.

Rows are in ``buckets`` parts by a hash of fragment_id. Beside them stand postings in parts by bucket and by a hash of the
term, and each bucket's totals. A row of postings has a term and its documents (fragment_ids, tfs, lens) within a batch of rows; postings are made
where their rows were written, without a shuffle. A change moves each row once and its shuffle files go when it is written; an upsert writes its new
rows to files first and goes through its buckets in parts, so that shuffle files of one part take disk at a time. A change writes the buckets that it touches to a
folder of its own (change=...), then a version file that says which folder each bucket has; the
version file counts from the moment it has its name, so readers never see half a change and a driver that dies leaves none.
Two writers can't take the same version number: the later one fails, and may try again.

A change may carry the number of a stream's batch; the version keeps the last one, and a batch that comes again changes nothing.

Defined cases: a null fragment_id is not stored. Of rows of one id the last by the given order stays. A null text has no terms.
An empty store has no rows and no scores. The driver handles numbers of buckets, and the ids of a search's results.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire import schemas
from quire.functions.text import terms
from quire.operators import index, search
from quire.sources.files import file_system

FIELDS = {"content": "content", "primary_section": "metadata.primary_section"}
_BLOCK = "field string, term string, fragment_ids array<string>, tfs array<int>, lens array<int>"
_POSTINGS = f"{_BLOCK}, change string, bucket int, term_bucket int"
_TOTALS = "field string, n bigint, words bigint, change string, bucket int"
#: Of files, as they are read: a store of another layout is refused.
LAYOUT = 2
#: A bucket of more rows is dealt to several tasks.
ROWS_A_TASK = 10_000
#: An upsert goes through its buckets in so many parts, one after the other.
PARTS = 4
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _part(name: Column | str, parts: int) -> Column:
    return (F.crc32(F.encode(name, "UTF-8")) % parts).cast("int")


@contextmanager
def _cleaned(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is run meanwhile go at its end, not at some later collection of the driver's garbage."""
    before = spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEAN, before) if before is not None else spark.conf.unset(_CLEAN)


def _inverted(fields: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Postings of batches (bucket, fragment_id, and a list of terms for each field). The term "" has all documents with any term, once each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, buckets = batch.column("fragment_id"), batch.column("bucket").to_numpy(zero_copy_only=False)
            for field in fields:
                lists = batch.column(field)
                lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
                coded = pa.concat_arrays([lists.flatten(), pa.array([""] * int((lengths > 0).sum()), pa.string())]).dictionary_encode()
                words, rows = coded.dictionary, np.append(np.repeat(np.arange(len(batch)), lengths), np.flatnonzero(lengths > 0))
                if not len(rows):
                    continue
                # one number for each bucket, term and row; in their order, equal ones side by side
                key = (buckets[rows].astype(np.int64) * len(words) + coded.indices.to_numpy(zero_copy_only=False)) * len(batch) + rows
                key, tf = np.unique(key, return_counts=True)
                row, group = key % len(batch), key // len(batch)
                starts = np.flatnonzero(np.diff(group, prepend=-1))
                docs = (ids.take(pa.array(row)), pa.array(tf.astype(np.int32)), pa.array(lengths[row].astype(np.int32)))
                own, ends = group[starts], pa.array(np.append(starts, len(row)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array((own // len(words)).astype(np.int32)), pa.array([field] * len(own)), words.take(pa.array(own % len(words))), *[pa.ListArray.from_arrays(ends, x) for x in docs]],
                    ["bucket", "field", "term", "fragment_ids", "tfs", "lens"],
                )

    return run


class Store:
    """A store under ``path``. An existing one keeps the numbers of buckets that it was made with."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, term_buckets: int = 32):
        self.spark, self.path = spark, path
        state = self._state()
        if state and state.get("layout") != LAYOUT:
            raise ValueError(f"the store under {path} has another layout of files: write its rows to a new one")
        self.buckets, self.term_buckets = state["shape"] if state else (buckets, term_buckets)

    # Versions

    def _versions(self) -> list[str]:
        fs, where, _ = file_system(self.spark, f"{self.path}/versions")
        names = [x.getPath().getName() for x in fs.listStatus(where)] if fs.exists(where) else []
        return sorted(n for n in names if n.startswith("v-"))

    def _state(self) -> dict | None:
        """The newest version: number, shape, folders (bucket to change), batches (stream to last batch)."""
        names = self._versions()
        if not names:
            return None
        fs, where, _ = file_system(self.spark, f"{self.path}/versions/{names[-1]}")
        stream = fs.open(where)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _publish(self, state: dict) -> None:
        fs, draft, path = file_system(self.spark, f"{self.path}/versions/draft-{uuid.uuid4().hex}")
        stream = fs.create(draft)
        stream.write(json.dumps(state).encode())
        stream.close()
        name = path(f"{self.path}/versions/v-{state['number']:012d}")
        if fs.exists(name) or not fs.rename(draft, name):
            raise RuntimeError(f"version {state['number']} is another writer's")

    def _current(self, kind: str, schema: str, buckets: list[int] | None = None) -> DataFrame | None:
        """The newest version's files, of all buckets or some: conditions on the partition columns alone."""
        state = self._state() or {"folders": {}}
        by_change: dict[str, list[int]] = {}
        for bucket, change in state["folders"].items():
            if buckets is None or int(bucket) in buckets:
                by_change.setdefault(change, []).append(int(bucket))
        if not by_change:
            return None
        root = f"{self.path}/{kind}"
        wanted = F.lit(False)
        for change, some in sorted(by_change.items()):
            wanted = wanted | ((F.col("change") == change) & F.col("bucket").isin(sorted(some)))
        fs, where, _ = file_system(self.spark, root)
        return self.spark.read.schema(schema).parquet(root).filter(wanted) if fs.exists(where) else None

    def rows(self, buckets: list[int] | None = None) -> DataFrame:
        found = self._current("rows", f"{schemas.INDEX}, change string, bucket int", buckets)
        return index.empty(self.spark) if found is None else found.drop("change", "bucket")

    def frame(self) -> DataFrame:
        """All rows of the newest version, as an index."""
        return self.rows()

    # Changes

    def _touched(self, ids: DataFrame) -> dict[int, int]:
        """Buckets of a frame's fragment_ids, with their numbers of rows."""
        return {r["bucket"]: r["count"] for r in ids.filter("fragment_id is not null").groupBy(_part("fragment_id", self.buckets).alias("bucket")).count().collect()}

    def change(self, ids: DataFrame, how: Callable[[DataFrame], DataFrame], batch: tuple[str, int] | None = None) -> bool:
        """Rewrites the buckets of ``ids`` (fragment_id) as ``how`` makes them of their rows. False for a batch that was there before."""
        return self._change(ids, lambda old, placed: placed(how(old)), batch)

    def _change(self, ids: DataFrame, how: Callable[[DataFrame, Callable[[DataFrame], DataFrame]], DataFrame], batch: tuple[str, int] | None) -> bool:
        """:meth:`change`, where ``how`` gets the old rows and a function that deals rows out by bucket, and returns rows dealt out."""
        state = self._open()
        if batch and state["batches"].get(batch[0], -1) >= batch[1]:
            return False
        counts = self._touched(ids)
        name = f"{state['number'] + 1:012d}-{uuid.uuid4().hex}"
        if touched := sorted(counts):
            old = self.rows(touched)
            slices = 1 + (sum(counts.values()) + old.count()) // (len(touched) * ROWS_A_TASK)
            with _cleaned(self.spark):
                self._write(how(old, lambda rows: self._placed(rows, touched, slices)).drop("_slice"), "rows", name, "bucket")
        self._finish(state, touched, name, batch)
        return True

    def _open(self) -> dict:
        """The newest version, or what comes before the first."""
        return self._state() or {"number": -1, "shape": [self.buckets, self.term_buckets], "folders": {}, "batches": {}}

    def _placed(self, rows: DataFrame, buckets: list[int], slices: int) -> DataFrame:
        """Rows of some buckets dealt out, each bucket in so many slices."""
        rows = rows.filter("fragment_id is not null").withColumn("bucket", _part("fragment_id", self.buckets)).filter(F.col("bucket").isin(buckets))
        return rows.withColumn("_slice", F.pmod(F.xxhash64("fragment_id"), F.lit(slices))).repartition(len(buckets) * slices, "bucket", "_slice")

    def _finish(self, state: dict, touched: list[int], name: str, batch: tuple[str, int] | None) -> None:
        """Postings of the rows that were written, and the version that has them."""
        if touched:
            own = self.spark.read.schema(f"{schemas.INDEX}, change string, bucket int").parquet(f"{self.path}/rows").filter((F.col("change") == name) & F.col("bucket").isin(touched))
            with _cleaned(self.spark):
                self._write_terms(own, name)
        folders = dict(state["folders"]) | {str(k): name for k in touched}
        self._publish({"number": state["number"] + 1, "shape": [self.buckets, self.term_buckets], "layout": LAYOUT, "folders": folders, "batches": state["batches"] | ({batch[0]: batch[1]} if batch else {})})

    def _write(self, rows: DataFrame, kind: str, change: str, *parts: str) -> None:
        rows.write.mode("append").option("compression", "zstd").partitionBy(*parts).parquet(f"{self.path}/{kind}/change={change}")

    def _write_terms(self, rows: DataFrame, change: str) -> None:
        lists = [terms(F.coalesce(F.col(column), F.lit(""))).alias(name) for name, column in FIELDS.items()]
        found = rows.select("bucket", "fragment_id", *lists).mapInArrow(_inverted(list(FIELDS)), f"bucket int, {_BLOCK}")
        found = found.withColumn("term_bucket", _part("term", self.term_buckets))
        self._write(found.sortWithinPartitions("bucket", "term_bucket", "field", "term"), "postings", change, "bucket", "term_bucket")
        own = self.spark.read.schema(_POSTINGS).parquet(f"{self.path}/postings").filter((F.col("change") == change) & (F.col("term_bucket") == 0) & (F.col("term") == ""))
        totals = own.select("bucket", "field", F.explode("lens").alias("len")).groupBy("bucket", "field").agg(F.count("*").alias("n"), F.sum("len").alias("words"))
        self._write(totals.coalesce(1), "totals", change, "bucket")  # two rows a bucket

    def upsert(self, rows: DataFrame, order: str | None = None, batch: tuple[str, int] | None = None) -> bool:
        """As :func:`index.upsert`. ``rows`` are made once, into files; then they meet the old ones in their buckets, part by part, so that texts are moved once."""
        state = self._open()
        if batch and state["batches"].get(batch[0], -1) >= batch[1]:
            return False
        if "embeddings" not in rows.columns:
            rows = rows.withColumn("embeddings", F.lit(None).cast("array<float>"))
        names = [f.name for f in index.empty(self.spark).schema]
        new = rows.select(*names, F.struct(F.lit(1).alias("new"), (F.col(order) if order else F.lit(0)).alias("order"), F.xxhash64(*rows.columns).alias("hash")).alias("_rank")).filter("fragment_id is not null")
        rank = new.schema["_rank"].dataType
        name = f"{state['number'] + 1:012d}-{uuid.uuid4().hex}"
        fs, staged, path = file_system(self.spark, f"{self.path}/staged/change={name}")
        try:
            with _cleaned(self.spark):
                self._write(new.withColumn("part", _part("fragment_id", self.buckets) % PARTS), "staged", name, "part")
            new = self.spark.read.schema(new.withColumn("part", F.lit(0)).schema).parquet(f"{self.path}/staged/change={name}")
            counts = self._touched(new)
            touched = sorted(counts)
            old = self.rows(touched)
            total = sum(counts.values()) + old.count()
            step = -(-PARTS // (1 + total // ROWS_A_TASK))  # all at once if they are few
            newest = Window.partitionBy("bucket", "_slice", "fragment_id").orderBy(F.desc("_rank"))
            for parts in (range(k, min(k + step, PARTS)) for k in range(0, PARTS, step)):
                if some := [b for b in touched if b % PARTS in parts]:
                    both = self.rows(some).select(*names, F.lit(None).cast(rank).alias("_rank")).unionByName(new.filter(F.col("part").isin(*parts)).drop("part"))  # old rows after all new ones
                    dealt = self._placed(both, some, 1 + total // (len(touched) * ROWS_A_TASK))
                    with _cleaned(self.spark):
                        self._write(dealt.withColumn("_nr", F.row_number().over(newest)).filter("_nr = 1").drop("_nr", "_rank", "_slice"), "rows", name, "bucket")
                for part in parts:
                    fs.delete(path(f"{self.path}/staged/change={name}/part={part}"), True)
        finally:
            fs.delete(staged, True)
        self._finish(state, touched, name, batch)
        return True

    def put(self, rows: DataFrame, order: str | None = None, batch: tuple[str, int] | None = None) -> bool:
        return self.upsert(rows, order, batch)

    def insert_with_vectors(self, rows: DataFrame, embed: Callable[[DataFrame], DataFrame], order: str | None = None) -> bool:
        return self.change(rows, lambda old: index.insert_with_vectors(old, rows, embed, order))

    def add_vectors(self, vectors: DataFrame, order: str | None = None) -> bool:
        return self.change(vectors, lambda old: index.add_vectors(old, vectors, order))

    def bulk_add_vectors(self, embed: Callable[[DataFrame], DataFrame]) -> bool:
        return self.change(self.rows().filter(index.lacks_vector()), lambda old: index.bulk_add_vectors(old, embed))

    def update_content(self, updates: DataFrame, order: str | None = None) -> bool:
        return self.change(updates, lambda old: index.update_content(old, updates, order))

    def delete(self, fragment_id: str) -> bool:
        return self.change(self.fetch(fragment_id), lambda old: index.delete(old, fragment_id))

    def delete_page(self, page: int) -> bool:
        return self.change(self.rows().filter(F.col("metadata.page") == page), lambda old: index.delete_page(old, page))

    def delete_pending(self) -> bool:
        return self.change(self.rows().filter(index.lacks_vector()), index.delete_pending)

    def tidy(self) -> int:
        """Removes the files that the newest version doesn't name, older versions and changes cut off among them; their number of folders. No reader may be at an older version."""
        state, gone = self._state() or {"folders": {}}, 0
        keep = {f"change={c}/bucket={b}" for b, c in state["folders"].items()}
        for kind in ("rows", "postings", "totals", "staged"):
            fs, root, _ = file_system(self.spark, f"{self.path}/{kind}")
            for change in fs.listStatus(root) if fs.exists(root) else []:
                names = {f"{change.getPath().getName()}/{x.getPath().getName()}": x.getPath() for x in fs.listStatus(change.getPath()) if x.isDirectory()}
                for where in [w for n, w in names.items() if n not in keep]:
                    gone += fs.delete(where, True)
                if not keep & names.keys():
                    fs.delete(change.getPath(), True)
        for name in self._versions()[:-1]:
            fs, where, _ = file_system(self.spark, f"{self.path}/versions/{name}")
            fs.delete(where, False)
        return gone

    # Reading

    def fetch(self, fragment_id: str) -> DataFrame:
        """That row, from its bucket alone."""
        return index.fetch(self.rows([zlib.crc32(fragment_id.encode()) % self.buckets]), fragment_id)

    def fetch_all(self, ids: list[str]) -> DataFrame:
        """The rows of some ids, from their buckets alone."""
        return self.rows(sorted({zlib.crc32(i.encode()) % self.buckets for i in ids})).filter(F.col("fragment_id").isin(ids))

    def postings(self, wanted: list[str], field: str = "content") -> DataFrame | None:
        """field, term, fragment_id, tf, len of some terms, from their parts alone."""
        found = self._current("postings", _POSTINGS)
        if found is None or not wanted:
            return None
        parts = sorted({zlib.crc32(t.encode()) % self.term_buckets for t in wanted})
        found = found.filter(F.col("term_bucket").isin(parts) & (F.col("field") == field) & F.col("term").isin(wanted))
        return found.select("field", "term", F.inline(F.arrays_zip("fragment_ids", "tfs", "lens"))).toDF("field", "term", "fragment_id", "tf", "len")

    def text_scores(self, query: str, field: str = "content") -> DataFrame:
        """fragment_id, score: as :func:`search.text_scores` of the whole index, from the query's postings and the totals."""
        found, totals = self.postings(sorted(set(search.terms_of(query))), field), self._current("totals", _TOTALS)
        if found is None or totals is None:
            return index.empty(self.spark).select("fragment_id", F.lit(0.0).alias("score"))
        n, words = totals.filter(F.col("field") == field).agg(F.sum("n"), F.sum("words")).first()  # two rows a bucket
        if not n:
            return found.select("fragment_id", F.lit(0.0).alias("score")).limit(0)
        df = found.groupBy("term").agg(F.count("*").alias("df"))  # a row for each term of the query
        found = found.join(F.broadcast(df), "term")
        idf = F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))
        score = idf * F.col("tf") * (search.K1 + 1) / (F.col("tf") + search.K1 * (1 - search.B + search.B * F.col("len") / (words / n)))
        parts = found.groupBy("fragment_id").agg(F.array_sort(F.collect_list(F.struct("term", score.alias("x")))).alias("xs"))  # one for each term of the query
        return parts.select("fragment_id", F.aggregate("xs", F.lit(0.0), lambda a, x: a + x["x"]).alias("score"))  # in the terms' order, so that equal rows have equal scores

    def text_search(self, query: str, section: str | None = None, size: int = 10) -> DataFrame:
        """fragment_id, content, score, highlight of the best ``size``: as :func:`search.text_search`; contents are read from the results' buckets alone."""
        scores = self.text_scores(query)
        if section:
            more = self.text_scores(section, "primary_section").withColumnRenamed("score", "more")
            scores = scores.join(more, "fragment_id").select("fragment_id", (F.col("score") + F.col("more")).alias("score"))
        best = search.top(scores, size).collect()
        found = self.spark.createDataFrame(best, "fragment_id string, score double")
        rows = self.fetch_all([r["fragment_id"] for r in best]).select("fragment_id", "content").join(F.broadcast(found), "fragment_id")  # ``size`` rows
        return search.top(search.with_highlights(rows, query), size)

    def hybrid_search(self, query_vector, query: str, alpha: float = 0.7, size: int = 10, boost_mode: str = "sum") -> DataFrame:
        """fragment_id, score: as :func:`search.hybrid_search`, the text side from the query's postings."""
        return search.hybrid_of(search.vector_scores(self.rows(), query_vector), self.text_scores(query), alpha, size, boost_mode)
