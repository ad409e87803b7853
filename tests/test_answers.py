"""Answers, failures by item, searches of many vectors and subtrees, on cases made by hand."""

import json
import random

import pytest
from pyspark.sql import functions as F

from quire import schemas
from quire.functions.text import ascii_json
from quire.modes import LAMBDA, Mode
from quire.operators import index, match, requests, search
from quire.sources import pages, recognition


def test_json_text_is_that_of_plain_ascii(spark):
    value = {"a": 'x, y: "z" \\\\ /', "é, ": ["ü, 日本: 𝄞😀", "", "\\u00e9 \n\t", "\x7f"], "n": [1.5, None, True, {}], "long": "a\"b, c:" * 20_000 + "ß" * 50_000}
    text = json.dumps(value, ensure_ascii=False, separators=(",", ":"))
    got = spark.createDataFrame([(text,), (None,), ("{}",)], "t string").select(ascii_json("t")).collect()
    assert [r[0] for r in got] == [json.dumps(value), None, "{}"]


def images(spark, rows):
    return spark.createDataFrame([(i, p, json.dumps(x).encode()) for i, p, x in rows], "item_id string, page int, png binary")


def page(*words, broken=""):
    return {"rec_texts": list(words), "rec_scores": [0.9] * len(words), "rec_boxes": [[0, 20 * i, 100, 20 * i + 14] for i in range(len(words))], "broken": broken, "blocks": [{"label": "text", "bbox": [0, 0, 200, 300]}, {"label": None, "bbox": [0, 0, 1, 1]}]}


def reader(part):
    def load():
        def predict(png):
            found = json.loads(png)
            if part in found["broken"]:
                raise ValueError(f"no {part}")
            return found["blocks"] if part == "layout" else found

        return predict

    return load


def test_failures_are_of_their_items(spark):
    png = images(spark, [("a", 0, page("one")), ("a", 1, page("two", broken="lines layout")), ("b", 0, page("three", broken="layout")), ("c", 0, page("four")), ("c", 1, page()), ("d", 0, {"broken": ""})])
    lost = spark.createDataFrame([("e", None, None, "no file")], "item_id string, page int, png binary, error string")
    png = png.withColumn("error", F.lit(None).cast("string")).unionByName(lost)
    read, laid = recognition.recognise(png, reader("lines")), recognition.analyse_layout(png, reader("layout"))
    failed = {(r["item_id"], r["page"], r["error"]) for r in recognition.failures(read, laid).collect()}
    assert failed == {("a", 1, "no lines"), ("a", 1, "no layout"), ("b", 0, "no layout"), ("d", 0, "'rec_texts'"), ("d", 0, "'blocks'"), ("e", None, "no file")}
    lines = pages.ocr_lines(recognition.unfailed(read))
    assert sorted(r["content"] for r in lines.collect()) == ["four", "one", "three"]
    blocks = recognition.unfailed(laid)
    assert blocks.columns == [f.name for f in spark.createDataFrame([], schemas.LAYOUT_BLOCKS).schema] and {r["item_id"] for r in blocks.collect()} == {"a", "c"}
    asked = spark.createDataFrame([("a", 0, 0), ("a", 0, 1), ("b", 0, 5), ("c", 0, 1), ("d", 0, 0), ("e", 0, 3), ("", 0, 0), (None, 0, 0), ("f", 0, 0)], "item_id string, start int, end int")
    asked = asked.select("item_id", F.struct("start", "end").alias("page_range"))
    items = spark.createDataFrame([("a", 2), ("b", 1), ("c", 2), ("d", 1), ("e", 4)], "item_id string, pages int")
    ranges = requests.with_failures(requests.page_ranges(asked, items), recognition.failures(read, laid))
    got = {(r["item_id"], r["last"]): (r["status"], r["error"]) for r in ranges.collect()}
    assert got == {("a", 0): (200, None), ("a", 1): (500, "no layout"), ("b", 0): (500, "no layout"), ("c", 1): (200, None), ("d", 0): (500, "'blocks'"), ("e", 3): (500, "no file"), ("", None): (400, None), (None, None): (400, None), ("f", None): (404, None)}
    made = spark.createDataFrame([("c", 0, 0, "x", "four", None), ("a", 0, 0, "y", "one", None), ("a", 1, 0, "z", "two", None)], f"item_id string, page int, chunk_no int, {schemas.CHUNKS}")
    body = {(r["item_id"], r["status"]): json.loads(r["body"]) for r in requests.envelopes(ranges.filter("item_id <> 'a' or last = 1"), made).collect()}
    assert body["a", 500] == {"error": "no layout"} and body["c", 200]["total_chunks"] == 1 and body["f", 404] == {"error": "Document f not found"}


def test_failing_files_and_images_are_rows(spark):
    pytest.importorskip("cv2")
    bad = images(spark, [("a", 0, {})])
    assert recognition.failures(recognition.enhance(bad)).count() == 1


def test_batch_search_is_many_searches(spark):
    rng = random.Random(3)
    vectors = [[rng.choice([-1.0, 0.0, 1.0, 2.0]) for _ in range(4)] for _ in range(300)]
    data = [(f"d{i}", "x", None, v) for i, v in enumerate(vectors)] + [("none", "x", None, None), ("zero", "x", None, [0.0] * 4), ("short", "x", None, [1.0, 1.0]), ("empty", "x", None, []), (None, "x", None, [1.0] * 4)]
    rows = spark.createDataFrame(data, schemas.INDEX).repartition(5)
    asked = [(str(i), vectors[i]) for i in range(40)] + [("two", [1.0, 0.0]), ("zero", [0.0] * 4), ("null", None)]
    queries = spark.createDataFrame(asked, "query_id string, query array<float>")
    for block in (1024, 7):
        got = {}
        for r in search.batch_search(rows, queries, 6, block).orderBy("query_id", "rank").collect():
            got.setdefault(r["query_id"], []).append((r["fragment_id"], round(r["score"], 6)))
        assert set(got) == {str(i) for i in range(40) if any(vectors[i])} | {"two"} and got["two"] == [("short", round(1 + 0.5**0.5, 6))]
        for i in (0, 5, 17):
            same = rows.filter("size(embeddings) = 4 and fragment_id is not null and fragment_id <> 'zero'")
            want = search.vector_scores(same, vectors[i]).filter("score is not null").select("fragment_id", F.round("score", 9).alias("score")).orderBy(F.desc("score"), "fragment_id").limit(6).collect()
            assert got.get(str(i), []) == [(r["fragment_id"], round(r["score"], 6)) for r in want if any(vectors[i])]
    assert search.batch_search(rows, queries.limit(0)).count() == 0 and search.batch_search(index.empty(spark), queries).count() == 0


@pytest.mark.parametrize("mode", [Mode(), LAMBDA])
def test_subtrees_are_what_the_tree_has_below(spark, mode):
    rng = random.Random(9)
    kinds = ["doc_title", "title", "header", "paragraph_title", "text", "text"]
    schema = "item_id string, page int, ocr_seq int, content string, ocr_confidence double, x1 int, y1 int, x2 int, y2 int, structure_type string"
    rows = [(str(i), p, k, " ".join(["w"] * rng.randint(0, 4)), 0.9, 0, 10 * k, 50, 10 * k + 8, rng.choice(kinds[i % 3 :])) for i in range(6) for p in range(3) for k in range(rng.randint(1, 30))]
    tree = match.heading_tree(spark.createDataFrame(rows, schema), mode)
    found = {(r["item_id"], r["page"], r["id"]): r for r in match.subtrees(tree, mode).collect()}
    below = {k: [] for k in found}
    for (item, page_, i), r in found.items():
        up = r["parent_id"]
        while up is not None:
            below[item, page_, up].append((i, len(r["content"].split())))
            up = found[item, page_, up]["parent_id"]
    for key, r in found.items():
        assert sorted(i for i, _ in below[key]) == list(range(r["begin"] + 1, r["end"])), key
        assert (r["elements"], r["tokens"]) == (len(below[key]), sum(n for _, n in below[key]))
