"""The bucketed store: its changes and its inverted index, against the plain functions."""

import os
import time

import pytest
from pyspark.sql import functions as F

from quire import schemas
from quire.operators import index, search
from quire.operators.store import Store
from quire.plans import catalogue
from quire.streaming import ingest

LINE = "item_id string, page int, ocr_seq int, content string, ocr_confidence double, x1 int, y1 int, x2 int, y2 int"
BLOCK = "item_id string, page int, block_idx int, label string, content string, confidence double, x1 int, y1 int, x2 int, y2 int"


def rows(spark, names, text="the {} of many words and the end"):
    meta = {"page": 0, "primary_section": "the head", "ocr_confidence": 0.9}
    data = [(n, text.format(n), meta | {"page": i % 5}, [1.0, float(i)] if i % 2 else None) for i, n in enumerate(names)]
    return spark.createDataFrame(data, schemas.INDEX)


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


def same(a, b):
    as_text = lambda df: sorted(map(str, df.select("fragment_id", "content", "metadata.page", "embeddings").collect()))
    assert as_text(a) == as_text(b)


def files_read(df):
    """How many files its scan opens."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size()))


def check(store, plain):
    same(store.frame(), plain)
    for query, field in (("the many", "content"), ("Word7 of none", "content"), ("head", "primary_section"), ("", "content")):
        column = "content" if field == "content" else F.col("metadata.primary_section")
        a = {r[0]: r[1] for r in store.text_scores(query, field).collect()}
        assert a == pytest.approx({r[0]: r[1] for r in search.text_scores(plain, query, column).collect()}), query


def test_changes_are_those_of_the_plain_functions(spark, tmp_path):
    store, plain = Store(spark, str(tmp_path / "s"), 4, 4), rows(spark, [f"word{i}" for i in range(40)])
    assert store.frame().count() == 0 and store.text_scores("the").count() == 0
    store.upsert(plain)
    check(store, plain)
    new = rows(spark, ["word3", "fresh", "fresh"], "other words {} here").withColumn("v", F.monotonically_increasing_id())
    vectors = plain.select("fragment_id", F.array(F.lit(5.0)).cast("array<float>").alias("embeddings")).filter("fragment_id < 'word2'")
    updates = plain.limit(3).select("fragment_id", F.lit("changed the text").alias("content"), F.array(F.lit(2.0)).cast("array<float>").alias("embeddings"))
    embed = lambda x: x.withColumn("embeddings", F.array(F.length("content").cast("float")))
    steps = [
        (lambda: store.upsert(new, "v"), lambda ix: index.upsert(ix, new, "v")), (lambda: store.add_vectors(vectors), lambda ix: index.add_vectors(ix, vectors)),
        (lambda: store.update_content(updates), lambda ix: index.update_content(ix, updates)), (lambda: store.delete("word5"), lambda ix: index.delete(ix, "word5")),
        (lambda: store.delete("none"), lambda ix: ix), (lambda: store.delete_page(3), lambda ix: index.delete_page(ix, 3)),
        (lambda: store.bulk_add_vectors(embed), lambda ix: index.bulk_add_vectors(ix, embed)), (lambda: store.delete_pending(), index.delete_pending),
    ]
    for number, (change, how) in enumerate(steps):
        change()
        plain = spark.createDataFrame(how(plain).collect(), schemas.INDEX)
        if number in (0, 2, 5, 7):
            check(store, plain)
    same(Store(spark, store.path, 99, 99).frame(), plain)  # opened again, with the buckets that it has
    assert store.tidy() > 0
    check(store, plain)
    mixed = [{r[0]: round(r[1], 9) for r in f.collect()} for f in (store.hybrid_search([1.0, 2.0], "the many", size=50), search.hybrid_search(plain, [1.0, 2.0], "the many", size=50))]
    assert mixed[0] == mixed[1] and mixed[0]
    found = store.text_search("the many", "head", 3).collect()
    assert [(r["fragment_id"], round(r["score"], 9), r["highlight"]) for r in found] == [(r["fragment_id"], round(r["score"], 9), r["highlight"]) for r in search.text_search(plain, "the many", "head", 3).collect()]


def test_a_change_rewrites_its_buckets_and_a_query_reads_its_terms(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), 8, 8)
    store.upsert(rows(spark, [f"word{i}" for i in range(60)]))
    before = files(store.path)
    time.sleep(0.01)
    store.upsert(rows(spark, ["word3"], "now {} says another thing"))
    after = files(store.path)
    assert all(after.get(f) == t for f, t in before.items())  # nothing was written over
    new = {f.split("bucket=")[1].split("/")[0] for f in after.keys() - before.keys() if "bucket=" in f}
    assert len(new) == 1
    everything = [f for f in after if "/postings/" in f]
    assert 0 < files_read(store.postings(["word7"])) <= 8 < len(everything)  # one of eight term buckets
    assert files_read(store.fetch("word3")) == 1 and store.fetch("word3").first()["content"] == "now word3 says another thing"


def test_batches_and_writers(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), 2, 2)
    assert store.upsert(rows(spark, ["a"]), batch=("s", 0)) and store.upsert(rows(spark, ["b"]), batch=("s", 1))
    assert not store.upsert(rows(spark, ["a"], "late {}"), batch=("s", 1)) and store.upsert(rows(spark, ["c"]), batch=("t", 0))
    assert sorted(r[0] for r in store.frame().select("fragment_id").collect()) == ["a", "b", "c"] and store.fetch("a").first()["content"].startswith("the a")
    state = store._state()
    with pytest.raises(RuntimeError):
        store._publish(state)  # as a second writer with the same number would
    nulls = rows(spark, ["d"]).withColumn("fragment_id", F.lit(None).cast("string"))
    assert store.upsert(nulls) and store.frame().count() == 3


def test_a_stream_into_a_store(spark, tmp_path):
    where = {k: str(tmp_path / k) for k in ("in", "store", "cp")}
    for item, word in (("a", "one"), ("b", "two"), ("b", "two")):
        line = spark.createDataFrame([(item, 0, 0, word, 0.9, 50, 60, 200, 80)], LINE)
        ingest.page_rows(line, spark.createDataFrame([], BLOCK)).write.mode("append").parquet(where["in"])
        ingest.ingest(spark, where["in"], Store(spark, where["store"], 4, 4), mode=ingest.Mode(item_ids=True), checkpoint=where["cp"]).awaitTermination(120)
    store = Store(spark, where["store"])
    assert sorted(r["content"] for r in store.frame().collect()) == ["one", "two"] and list(store._state()["batches"].values()) == [2]


def test_a_change_takes_little_disk(spark, tmp_path):
    """Postings aren't shuffled, a row is moved once, and neither shuffle files nor, after tidy, replaced files stay."""
    store = Store(spark, str(tmp_path / "s"), 4, 4)
    texts = spark.range(2000).select(F.concat(F.lit("d"), "id").alias("fragment_id"), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(150)), lambda i: F.md5((F.col("id") % 7 * 1000 + i).cast("string"))), " ").alias("content"))
    texts = texts.select("fragment_id", "content", F.lit(None).cast(schemas.METADATA).alias("metadata")).localCheckpoint()
    moves, write = {}, store._write
    store._write = lambda rows, kind, *more: moves.update({kind: rows._jdf.queryExecution().executedPlan().toString().count("Exchange hash")}) or write(rows, kind, *more)
    store.upsert(texts)
    assert moves["rows"] == 1 and moves["postings"] == 0
    size = lambda: sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(store.path) for f in names)
    once = size()
    for _ in range(3):
        store.upsert(texts)
        store.tidy()
    assert size() < 1.2 * once and store.frame().count() == 2000
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    shuffled = lambda: sum(os.path.getsize(os.path.join(d, f)) for top in folders for d, _, names in os.walk(top) for f in names if f.startswith("shuffle_"))
    before = shuffled()
    store.upsert(texts)
    assert shuffled() - before < 20_000  # of counts by bucket; the texts have 10 MB
    assert {r["tf"] for r in store.postings([store.frame().first()["content"].split(" ")[0]]).collect()} == {1}


def test_a_store_of_another_layout_is_refused(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), 2, 2)
    store._publish({"number": 0, "shape": [2, 2], "folders": {}, "batches": {}})
    with pytest.raises(ValueError):
        Store(spark, store.path)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no tables")
def test_the_store_that_hybrid_search_reads_keeps_one_version(spark):
    kept = catalogue._changed_store(spark, "/root/testdata/sf0.001")
    assert kept.tidy() == 0 and len(kept._versions()) == 1 and kept.hybrid_search([1.0] * 64, "the of").count() == 10


def test_an_upsert_goes_part_by_part(spark, tmp_path, monkeypatch):
    """Its new rows are made once, each write of rows shuffles a part of the buckets alone, and files in between go; the rows are those of the plain function."""
    from quire.operators import store as module

    store, plain = Store(spark, str(tmp_path / "s"), 8, 4), rows(spark, [f"word{i}" for i in range(200)])
    monkeypatch.setattr(module, "ROWS_A_TASK", 20)
    store.upsert(plain)
    counted = spark.sparkContext.accumulator(0)

    def made(batches):
        for batch in batches:
            counted.add(batch.num_rows)
            yield batch

    some = rows(spark, ["word3", "fresh", *[f"word{i}" for i in range(50, 120)]], "other words {} here").coalesce(1)
    new = some.mapInArrow(made, some.schema)
    written, write = [], store._write
    store._write = lambda df, kind, *more: (kind == "rows" and written.append({r[0] for r in df.select("bucket").distinct().collect()}), write(df, kind, *more))
    store.upsert(new)
    assert counted.value == 72
    assert len(written) == 4 and all(len(x) == 2 for x in written) and set.union(*written) == set(range(8))
    assert not os.listdir(f"{store.path}/staged") and store.tidy() > 0
    check(store, index.upsert(plain, some))
