import math

import pytest
from pyspark.sql import functions as F

from quire.functions import text
from quire.modes import ENHANCED, LAMBDA, SHORT_CORRECTIONS, Mode
from quire.operators import chunk, export, index, match, requests, search
from quire.sources import pages
from quire.streaming import ingest

LINE = "item_id string, page int, ocr_seq int, content string, ocr_confidence double, x1 int, y1 int, x2 int, y2 int"
BLOCK = "item_id string, page int, block_idx int, label string, content string, confidence double, x1 int, y1 int, x2 int, y2 int"


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "t string").select(column).first()[0]


def line(seq, content, box, conf=0.9, item="a", page=0):
    return (item, page, seq, content, conf, *box)


def elements(spark, rows, label=None):
    """Rows of (seq, content, label, box, confidence)."""
    data = [("a", 0, s, c, conf, *box, kind) for s, c, kind, box, conf in rows]
    return spark.createDataFrame(data, LINE + ", structure_type string")


@pytest.mark.parametrize("raw, want", [("fieldofartifical x", "field of artificial x"), ("byit.ChatGPT", "by it. Chat GPT"), ("iPhone", "i Phone"), ("heldin2023", "held in 2023"), ("  a\t\n b ", "a b"), ("", "")])
def test_clean_up(spark, raw, want):
    assert one(spark, raw, text.cleaned("t")) == want


def test_short_table_leaves_others(spark):
    assert one(spark, "thischapter andthe", text.cleaned("t", SHORT_CORRECTIONS)) == "thischapter and the"


def test_all_python_white_space(spark):
    blanks = [chr(i) for i in range(0x110000) if chr(i).isspace()]
    assert len(blanks) == 29
    assert one(spark, "x".join(["", *blanks, ""]), text.token_count("t")) == 30
    assert one(spark, "".join(blanks), text.token_count("t")) == 0
    assert one(spark, "", text.token_count("t")) == 0


@pytest.mark.parametrize("content, conf, want", [("ab", 0.85, True), ("ab", 0.8499, False), ("a", 0.9, False), ("", 0.9, False), ("  ", 0.9, False), ("ab12", 0.9, True), ("ab123", 0.9, False), ("ab", math.nan, True), ("é" * 2, 0.9, True), ("á́", 0.9, False)])
def test_quality(spark, content, conf, want):
    assert spark.createDataFrame([(content, conf)], "c string, f double").select(text.is_quality("c", "f")).first()[0] is want


@pytest.mark.parametrize("content, h, y, want", [("x" * 99, 26, 500, "TITLE"), ("x" * 100, 26, 500, "PARAGRAPH"), ("x", 25, 199, "HEADER"), ("x", 25, 200, "CAPTION"), ("x", 20, 0, "CAPTION"), (" - a", 10, 500, "LIST_ITEM"), ("5. a", 10, 500, "LIST_ITEM"), ("6. a", 10, 500, "CAPTION"), ("See Figure", 10, 500, "SECTION"), ("x" * 49, 10, 0, "CAPTION"), ("x" * 50, 10, 0, "PARAGRAPH")])
def test_line_classes(spark, content, h, y, want):
    assert spark.createDataFrame([(content, h, y)], "c string, h int, y int").select(text.line_class("c", "h", "y")).first()[0] == want


def test_ragged_arrays_are_cut_to_the_shortest(spark):
    from quire import schemas

    rows = spark.createDataFrame([("a", 0, ["x", "y", "z"], [0.5, 0.6], [[1, 2, 3, 4]] * 3), ("b", 0, None, [0.1], [[1, 2, 3, 4]])], schemas.OCR_PAGES)
    assert [r["content"] for r in pages.ocr_lines(rows).orderBy("ocr_seq").collect()] == ["x", "y"]


def matched(spark, lines, blocks, mode=Mode()):
    out = match.match(spark.createDataFrame(lines, LINE), spark.createDataFrame(blocks, BLOCK), mode)
    return {r["ocr_seq"]: r["structure_type"] for r in out.collect()}


def test_grid_misses_what_the_page_finds(spark):
    lines, blocks = [line(0, "x", (52, 166, 545, 178))], [("a", 0, 0, "title", "", 0.9, 50, 90, 550, 240)]
    assert matched(spark, lines, blocks) == {0: "title"}
    assert matched(spark, lines, blocks, Mode(grid=True)) == {0: "text"}


def test_first_block_wins_and_half_is_not_enough(spark):
    blocks = [("a", 0, 1, "table", "", 0.9, 0, 0, 100, 100), ("a", 0, 0, "title", "", 0.9, 0, 0, 90, 100)]
    assert matched(spark, [line(0, "x", (0, 0, 80, 80)), line(1, "x", (50, 0, 150, 100)), line(2, "x", (5, 5, 5, 9)), line(3, "x", (80, 80, 0, 0))], blocks) == {0: "title", 1: "text", 2: "text", 3: "text"}
    assert matched(spark, [line(0, "x", (0, 0, 8, 8), page=3)], blocks) == {0: "text"}
    corner = [("a", 0, 0, "title", "", 0.9, -20, -20, 100, 100)]
    assert matched(spark, [line(0, "x", (0, 0, 50, 50))], corner) == {0: "title"}
    assert matched(spark, [line(0, "x", (0, 0, 50, 50))], corner, Mode(grid=True)) == {0: "text"}


def test_heading_trees(spark):
    kind = {1: "doc_title", 2: "title", 3: "header", 4: "paragraph_title", 5: "text"}
    rows = elements(spark, [(i, "x", kind[k], (0, 10 * i, 5, 10 * i + 5), 0.9) for i, k in enumerate([2, 5, 2, 4, 5, 3, 5, 1, 2, 5, 5])])
    tree = match.heading_tree(rows, ENHANCED)
    assert [r["parent_id"] for r in tree.orderBy("id").collect()] == [None, 0, 0, 2, 3, 2, 5, None, 7, 8, 8]
    assert [r["parent_id"] for r in match.heading_tree(rows, LAMBDA).orderBy("id").collect()] == [None, 0, None, 2, 3, 2, 5, None, 7, 8, 8]
    assert match.children(tree).orderBy("id").first()["children"] == [1, 2]


def test_ties_in_reading_order_keep_recognition_order(spark):
    rows = elements(spark, [(2, "c", "text", (0, 0, 1, 1), 0.9), (0, "a", "text", (0, 0, 1, 1), 0.9), (1, "b", "text", (0, 0, 1, 1), 0.9)])
    assert [r["content"] for r in match.reading_order(rows).orderBy("id").collect()] == ["a", "b", "c"]


def sizes(spark, parts, flat=False):
    rows = elements(spark, [(i, " ".join(["w"] * n), kind, (0, 10 * i, 5, 10 * i + 5), 0.9) for i, (n, kind) in enumerate(parts)])
    made = chunk.flat_chunks(rows) if flat else chunk.semantic_chunks(rows)
    return [r["metadata"]["token_count"] for r in made.orderBy("chunk_no").collect()]


@pytest.mark.parametrize("parts, want", [
    ([(149, "text"), (252, "text")], [401]), ([(150, "text"), (250, "text")], [400]), ([(150, "text"), (251, "text")], [150, 251]), ([(500, "text")], [500]),
    ([(149, "text"), (1, "title")], [150]), ([(150, "text"), (1, "title"), (1, "text")], [150, 2]), ([(150, "text"), (1, "header"), (1, "paragraph_title")], [152]),
])
def test_chunk_bounds(spark, parts, want):
    assert sizes(spark, parts) == want


def test_flat_chunks_ignore_titles(spark):
    assert sizes(spark, [(150, "text"), (1, "title")], flat=True) == [151]


def test_content_and_metadata(spark):
    rows = elements(spark, [(0, "Head", "title", (1, 0, 2, 3), 0.9), (1, "", "header", (1, 5, 2, 6), 0.8), (2, "body", "text", (4, 9, 5, 10), 0.7)])
    r = chunk.semantic_chunks(rows, Mode(item_ids=True)).first()
    m = r["metadata"]
    assert (r["content"], m["context_hierarchy"], m["primary_section"], m["bbox"], m["hierarchy_levels"], m["elements_count"]) == ("Head - : body", "Head > ", "Head", [4, 9, 5, 10], [2, 3, 5], 3)
    import hashlib

    key = "a_page_0_bbox_[4, 9, 5, 10]_content_Head"
    assert r["fragment_id"] == "a_chunk_0_" + hashlib.md5(key.encode()).hexdigest()[:12]
    bare = chunk.semantic_chunks(elements(spark, [(0, "", "text", (1, 0, 2, 3), 0.9)])).first()
    assert (bare["content"], bare["metadata"]["context_hierarchy"], bare["metadata"]["section_titles"]) == ("", None, [])


def test_page_ranges(spark):
    asked = [("a", (-5, 1)), ("a", (2, 0)), ("a", (1, 99)), ("a", (None, None)), ("a", (0, 0)), ("", (0, 0)), (None, None), ("zz", None), ("a", None)]
    rows = requests.page_ranges(spark.createDataFrame(asked, "item_id string, page_range struct<start:int,end:int>"), spark.createDataFrame([("a", 4)], "item_id string, pages int"))
    got = sorted((str(r["item_id"]), r["status"], r["first"], r["last"]) for r in rows.collect() if r["status"] == 200)
    assert [g[2:] for g in got] == sorted([(0, 1), (2, 2), (1, 3), (0, 3), (0, 0), (0, 3)])
    assert sorted(r["status"] for r in rows.collect() if r["status"] != 200) == [400, 400, 404]


def small_index(spark):
    meta = lambda page, conf: (None, page, "semantic_chunk", [], "intro the", None, [], conf, 1, 1, [])
    rows = [("a", "the cat sat", meta(0, 0.9), [1.0, 0.0]), ("b", "the dog", meta(1, 0.8), [0.6, 0.8]), ("c", "a bird", meta(0, 0.95), None), ("d", "", meta(2, 0.85), [])]
    from quire import schemas

    return spark.createDataFrame(rows, schemas.INDEX)


def ids(df):
    return [r["fragment_id"] for r in df.collect()]


def test_search(spark):
    ix = small_index(spark)
    assert ids(search.semantic_search(ix, [1.0, 0.0])) == ["a", "b"]
    assert search.semantic_search(ix, [1.0, 0.0]).first()["score"] == pytest.approx(2.0)
    assert ids(search.filtered_search(ix, [1.0, 0.0], page=0)) == ["a"]
    assert ids(search.text_search(ix, "THE dog")) == ["b", "a"]
    assert search.text_search(ix, "the", "intro").first()["highlight"] == "<em>the</em> dog"
    assert set(ids(search.hybrid_search(ix, [1.0, 0.0], "bird"))) == {"a", "b", "c"}
    assert ids(search.text_search(ix, "none")) == [] and ids(search.text_search(ix, "")) == []


def test_index_changes(spark):
    ix = small_index(spark)
    assert ids(index.pending(ix)) == ["c", "d"]
    assert index.pending_count(ix).first()["pending"] == 2
    twice = ix.filter("fragment_id = 'a'").select("fragment_id", F.lit("old").alias("content"), "metadata", F.lit(1).alias("v")).unionByName(ix.filter("fragment_id = 'a'").select("fragment_id", F.lit("new").alias("content"), "metadata", F.lit(2).alias("v")))
    after = index.fetch(index.upsert(ix, twice, "v"), "a").first()
    assert (after["content"], after["embeddings"]) == ("new", None)
    assert sorted(ids(index.delete_page(ix, 0))) == ["b", "d"]
    assert sorted(ids(index.delete_pending(ix))) == ["a", "b"]
    assert sorted(ids(index.delete(ix, "b"))) == ["a", "c", "d"]
    new = spark.createDataFrame([("c", "x", [1.0])], "fragment_id string, content string, embeddings array<float>")
    assert index.fetch(index.add_vectors(ix, new), "c").first()["embeddings"] == [1.0]
    assert index.fetch_content(index.update_content(ix, new), "c").first()["content"] == "x"
    assert index.empty(spark).count() == 0


def test_stream_into_index_and_files(spark, tmp_path):
    lines = spark.createDataFrame([line(0, "Hello", (50, 60, 200, 80)), line(1, "world", (50, 90, 200, 110))], LINE)
    blocks = spark.createDataFrame([("a", 0, 0, "title", "", 0.9, 40, 50, 300, 85)], BLOCK)
    ingest.page_rows(lines, blocks).write.parquet(str(tmp_path / "in"))
    target = ingest.VersionedIndex(spark, str(tmp_path / "index"))
    ingest.ingest(spark, str(tmp_path / "in"), target, checkpoint=str(tmp_path / "cp")).awaitTermination(60)
    assert [r["content"] for r in target.frame().collect()] == ["Hello: world"]
    made = chunk.chunks(lines, blocks)
    assert export.write_chunks(made, str(tmp_path / "out")).first()["total_chunks"] == 1
    assert '"item_id":null' in export.chunk_json(made).first()["json"]
    tree = match.heading_tree(match.match(lines, blocks))
    assert export.markdown(tree).first()["markdown"] == "## Hello\n\nworld"
    assert index.drop(spark, str(tmp_path / "index"))


def test_a_restarted_stream_goes_on_from_the_index_on_disk(spark, tmp_path):
    where = {k: str(tmp_path / k) for k in ("in", "index", "cp")}
    for item, word in (("a", "one"), ("b", "two"), ("b", "two")):  # the last file holds what is there already
        rows = [line(0, word, (50, 60, 200, 80), item=item)]
        ingest.page_rows(spark.createDataFrame(rows, LINE), spark.createDataFrame([], BLOCK)).write.mode("append").parquet(where["in"])
        target = ingest.VersionedIndex(spark, where["index"])
        ingest.ingest(spark, where["in"], target, mode=LAMBDA, checkpoint=where["cp"]).awaitTermination(60)
    assert sorted(r["content"] for r in ingest.VersionedIndex(spark, where["index"]).frame().collect()) == ["one", "two"]
    assert index.newest(spark, str(tmp_path / "none")) is None
    index.empty(spark).write.parquet(f"{where['index']}/v-000000000099-cut-off")  # a version without its mark
    assert len(ids(ingest.VersionedIndex(spark, where["index"]).frame())) == 2


def test_repeated_ids_never_multiply_rows(spark):
    ix = small_index(spark)
    twice = spark.createDataFrame([("c", "x", [1.0], 1), ("c", "y", [2.0], 2), ("c", "y", [2.0], 2)], "fragment_id string, content string, embeddings array<float>, v int")
    for changed in (index.add_vectors(ix, twice, "v"), index.update_content(ix, twice, "v"), index.add_vectors(ix, twice), index.update_content(ix, twice)):
        assert sorted(ids(changed)) == ["a", "b", "c", "d"]
    assert index.fetch(index.update_content(ix, twice, "v"), "c").first()["content"] == "y"
    rows = twice.withColumn("metadata", F.lit(None).cast(ix.schema["metadata"].dataType)).drop("v")
    assert sorted(ids(index.upsert(ix, rows))) == ["a", "b", "c", "d"]


def test_vectors_for_all(spark):
    ix = small_index(spark)
    embed = lambda rows: rows.withColumn("embeddings", F.array(F.length("content").cast("float")))
    assert index.pending_count(index.bulk_add_vectors(ix, embed)).first()["pending"] == 0
    new = ix.filter("fragment_id = 'c'").select(F.lit("e").alias("fragment_id"), "content", "metadata")
    assert index.fetch(index.insert_with_vectors(ix, new, embed), "e").first()["embeddings"] == [6.0]
    assert index.fetch_existing(ix, "a").count() == 1
    with pytest.raises(KeyError):
        index.fetch_existing(ix, "none")


def test_failures_are_answers(spark):
    asked = spark.createDataFrame([("a", (0, 0)), ("", None), ("zz", None)], "item_id string, page_range struct<start:int,end:int>")
    ranges = requests.page_ranges(asked, spark.createDataFrame([("a", 1)], "item_id string, pages int"))
    made = chunk.chunks(spark.createDataFrame([line(0, 'say "x" é', (50, 60, 200, 80))], LINE), spark.createDataFrame([], BLOCK))
    got = {r["item_id"]: r for r in requests.answered("a", lambda: requests.envelopes(ranges, made), spark).collect()}
    assert got["a"]["status"] == 200 and '"processed_pages": "0-0", "total_chunks": 1' in got["a"]["body"] and 'say \\"x\\" \\u00e9' in got["a"]["body"]
    assert (got[""]["body"], got["zz"]["body"]) == ('{"error": "item_id is required"}', '{"error": "Document zz not found"}')
    broken = lambda: requests.envelopes(ranges, made.withColumn("page", F.expr("raise_error('no pages')").cast("int")))
    row = requests.answered("a", broken, spark).first()
    assert row["status"] == 500 and "no pages" in row["body"]


def test_stored_results(spark, tmp_path):
    (tmp_path / "ocr.json").write_text('{"item_id": "a", "page": 0, "rec_texts": ["x", "y"], "rec_scores": [0.9], "rec_boxes": [[1, 2, 3, 4], [5, 6, 7, 8]]}\n{"item_id": "b", "page": 1}\n')
    got = pages.ocr_lines(pages.read_ocr(spark, str(tmp_path / "ocr.json"))).collect()
    assert [tuple(r) for r in got] == [("a", 0, 0, "x", 0.9, 1, 2, 3, 4)]
    (tmp_path / "blocks.json").write_text('{"item_id": "a", "page": 0, "block_idx": 0, "label": "title", "x1": 1, "y1": 2, "x2": 3, "y2": 4}\n{"item_id": "a", "page": 0, "block_idx": 1, "label": "text"}\n')
    got = pages.read_blocks(spark, str(tmp_path / "blocks.json")).collect()
    assert [(r["label"], r["content"], r["confidence"]) for r in got] == [("title", "", 0.0)]
    export.write_pages(spark.createDataFrame([("a", 0), ("b", 3)], "item_id string, page int"), str(tmp_path / "pages"))
    assert {p.name for p in (tmp_path / "pages").iterdir() if p.is_dir()} == {"page=0", "page=3"}


@pytest.mark.parametrize("w, h, want", [(600, 800, (1200, 1600)), (1200, 1200, (1200, 1200)), (3000, 2400, (2400, 1920)), (5000, 1000, (6000, 1200)), (2400, 1300, (2400, 1300))])
def test_image_sizes(spark, w, h, want):
    from quire.sources.recognition import size_factor

    got = spark.createDataFrame([(w, h)], "w int, h int").select(text.image_scale("w", "h").alias("s")).first()["s"]
    assert (got["width"], got["height"]) == want
    factor = size_factor(h, w, 1200, 2400)
    assert (int(w * factor), int(h * factor)) == want


def test_display(spark):
    assert one(spark, "TABLE", text.label_colour("t")) == [255, 0, 255] and one(spark, "other", text.label_colour("t")) == [128, 128, 128]
    report = text.line_report(F.lit(3), F.lit("TITLE"), "t", F.lit(14), F.lit(60), F.lit(0.876))
    assert one(spark, "x" * 60, report) == " 3. [TITLE     ] " + "x" * 50 + " (h: 14, y: 60, conf:0.88)"


def test_hybrid_boost(spark):
    ix = small_index(spark)
    score = lambda **how: {r["fragment_id"]: r["score"] for r in search.hybrid_search(ix, [1.0, 0.0], "bird", **how).collect()}["c"]
    assert score(boost_mode="multiply") == pytest.approx(score() ** 2 / 0.3)


def test_filter_counts(spark):
    rows = [line(0, "good text", (0, 0, 9, 9)), line(1, "x", (0, 0, 9, 9), 0.5), line(2, "12 34", (0, 0, 9, 9)), line(3, "", (0, 0, 9, 9))]
    assert chunk.filter_counts(spark.createDataFrame(rows, LINE)).first().asDict() == {"lines": 4, "kept": 1, "bad_confidence": 1, "bad_length": 2, "bad_letters": 2, "bad_special": 0}
