"""The registered queries, over whole tables, and SQL that gives the same rows another way."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as text_functions
from quire.modes import ENHANCED, LAMBDA, Mode
from quire.operators import chunk, export, index, match, place, requests, search, store
from quire.plans.oracle import ORACLES
from quire.sources import pages, recognition
from quire.sources.files import scratch
from quire.sources.pages import page_blocks, page_lines, table

GRID = Mode(grid=True)
QUERY = "the of and"
SECTION = "the"


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_lines(table(spark, sf_dir, "documents"))


def _blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_blocks(table(spark, sf_dir, "documents"))


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).select("item_id", "page", "ocr_seq", text_functions.cleaned("content").alias("content"))


def clean_text_lambda(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).select("item_id", "page", "ocr_seq", text_functions.cleaned("content", LAMBDA.corrections).alias("content"))


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).select("item_id", "page", "ocr_seq", text_functions.token_count("content").alias("tokens"))


def quality_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _lines(spark, sf_dir).filter(text_functions.is_quality("content", "ocr_confidence"))
    return rows.select("item_id", "page", "ocr_seq", F.round(text_functions.letter_share("content"), 6).alias("letters"), F.round(text_functions.special_share("content"), 6).alias("special"))


def classify_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).select("item_id", "page", "ocr_seq", text_functions.line_class("content", F.col("y2") - F.col("y1"), "y1").alias("line_class"))


def _matched(mode: Mode):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = match.match(_lines(spark, sf_dir), _blocks(spark, sf_dir), mode)
        place = match.position()
        return rows.select("item_id", "page", "ocr_seq", "structure_type", "structure_confidence", "structure_content", *[place[k].alias(k) for k in ("x", "y", "width", "height")])

    return query


def _elements(spark: SparkSession, sf_dir: str, mode: Mode = ENHANCED) -> DataFrame:
    lines = _lines(spark, sf_dir).withColumn("content", text_functions.cleaned("content", mode.corrections))
    return match.match(lines, _blocks(spark, sf_dir), mode)


def reading_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match.reading_order(_elements(spark, sf_dir)).select("item_id", "page", "ocr_seq", "id", "level")


def _tree(mode: Mode):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return match.heading_tree(_elements(spark, sf_dir), mode).select("item_id", "page", "id", "level", F.coalesce("parent_id", F.lit(-1)).alias("parent_id"))

    return query


def tree_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match.children(match.heading_tree(_elements(spark, sf_dir))).select("item_id", "page", "id", F.array_join(F.col("children").cast("array<string>"), ",").alias("children"))


def _flat(rows: DataFrame) -> DataFrame:
    m = "metadata."
    return rows.select(
        F.col("item_id"), "page", "chunk_no", "fragment_id", "content", F.coalesce(m + "item_id", F.lit("")).alias("meta_item_id"), F.col(m + "type").alias("type"), F.array_join(m + "section_titles", "|").alias("section_titles"),
        F.coalesce(m + "primary_section", F.lit("-")).alias("primary_section"), F.coalesce(m + "context_hierarchy", F.lit("-")).alias("context_hierarchy"), F.array_join(F.col(m + "bbox").cast("array<string>"), ",").alias("bbox"),
        F.round(m + "ocr_confidence", 6).alias("ocr_confidence"), F.col(m + "elements_count").alias("elements_count"), F.col(m + "token_count").alias("token_count"), F.array_join(F.col(m + "hierarchy_levels").cast("array<string>"), ",").alias("hierarchy_levels"),
    )


def _chunks(spark: SparkSession, sf_dir: str, mode: Mode, hierarchy: bool = True) -> DataFrame:
    return chunk.chunks(_lines(spark, sf_dir), _blocks(spark, sf_dir), mode, hierarchy)


def semantic_chunks_enhanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(_chunks(spark, sf_dir, ENHANCED))


def semantic_chunks_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(_chunks(spark, sf_dir, GRID))


def semantic_chunks_lambda(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(_chunks(spark, sf_dir, LAMBDA))


def flat_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(_chunks(spark, sf_dir, ENHANCED, hierarchy=False))


def chunk_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _chunks(spark, sf_dir, LAMBDA).unionByName(_chunks(spark, sf_dir, ENHANCED, hierarchy=False))
    return chunk.summary(rows)


def _requests(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A request for each document, with ranges that miss in every way, and some for no document."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    ends = F.when(F.col("doc_id") % 4 == 0, F.lit(None)).otherwise((F.col("doc_id") % 5 - 1).cast("int"))
    spans = F.struct((F.col("doc_id") % 7 - 3).cast("int").alias("start"), ends.cast("int").alias("end"))
    names = F.when(F.col("doc_id") % 11 == 0, "").when(F.col("doc_id") % 13 == 0, F.concat(F.lit("none"), "doc_id")).otherwise(F.col("doc_id").cast("string"))
    items = _lines(spark, sf_dir).groupBy("item_id").agg((F.max("page") + 1).alias("pages"))
    return docs.select(names.alias("item_id"), spans.alias("page_range")), items


def page_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = requests.page_ranges(*_requests(spark, sf_dir))
    return requests.in_range(_lines(spark, sf_dir), asked).select("item_id", "page", "ocr_seq")


def invocation_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = requests.page_ranges(*_requests(spark, sf_dir))
    return rows.select("item_id", "status", F.coalesce("first", F.lit(-1)).alias("first"), F.coalesce("last", F.lit(-1)).alias("last"))


def document_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document as one row of an index, with the vector of the same number if there is one."""
    docs = table(spark, sf_dir, "documents")
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("embeddings"))
    first = F.substring_index("text", "\n", 1)
    metadata = F.struct(
        F.col("doc_id").cast("string").alias("item_id"), (F.col("doc_id") % 10).cast("int").alias("page"), F.lit("semantic_chunk").alias("type"), F.array(first).alias("section_titles"), first.alias("primary_section"), first.alias("context_hierarchy"),
        F.array().cast("array<int>").alias("bbox"), ((80 + (F.col("doc_id") * 31) % 20) / 100.0).cast("double").alias("ocr_confidence"), F.lit(1).alias("elements_count"), text_functions.token_count("text").alias("token_count"), F.array(F.lit(5)).alias("hierarchy_levels"),
    )
    rows = docs.select("doc_id", F.concat(F.lit("doc_"), "doc_id").alias("fragment_id"), F.col("text").alias("content"), metadata.alias("metadata"))
    return rows.join(vectors, "doc_id", "left").select("fragment_id", "content", "metadata", "embeddings")


def _query_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").filter("vec_id = 0").select(F.col("embedding").alias("query"))


def _scored(rows: DataFrame) -> DataFrame:
    return rows.select("fragment_id", F.round("score", 6).alias("score"))


def semantic_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(search.semantic_search(document_index(spark, sf_dir), _query_vector(spark, sf_dir)))


def filtered_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(search.filtered_search(document_index(spark, sf_dir), _query_vector(spark, sf_dir), page=3))


def text_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.text_search(document_index(spark, sf_dir), QUERY, SECTION).select("fragment_id", F.round("score", 6).alias("score"), F.length("highlight").alias("highlight_length"))


def highlights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with the query's terms marked, and its best passages."""
    rows = search.with_highlights(document_index(spark, sf_dir).filter("content IS NOT NULL"), QUERY)
    return rows.select("fragment_id", F.array_join("fragments", " | ").alias("fragments"), F.md5("highlight").alias("highlight_md5"))


def hybrid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(search.hybrid_search(document_index(spark, sf_dir), _query_vector(spark, sf_dir), QUERY))


def fetch_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.fetch(document_index(spark, sf_dir), "doc_7").select("fragment_id", "content", F.col("metadata.page").alias("page"), F.col("metadata.token_count").alias("token_count"))


def fetch_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.fetch_content(document_index(spark, sf_dir), "doc_7")


def multi_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = spark.createDataFrame(list(enumerate(["doc_5", "doc_none", "doc_3", "doc_5"])), "position int, fragment_id string")
    return index.multi_get(document_index(spark, sf_dir), asked).select("position", "fragment_id", F.coalesce(F.length("content"), F.lit(-1)).alias("length")).orderBy("position")


def pending_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.pending(document_index(spark, sf_dir)).select("fragment_id")


def pending_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.pending_count(document_index(spark, sf_dir))


def _state(rows: DataFrame) -> DataFrame:
    return rows.select("fragment_id", F.md5("content").alias("content_md5"), F.coalesce(F.size("embeddings"), F.lit(-1)).alias("dims"), F.col("metadata.page").alias("page"))


def bulk_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without a vector comes again, in two versions of which the later one stays; one comes new."""
    base = document_index(spark, sf_dir)
    again = base.filter(index.lacks_vector())
    old = again.select("fragment_id", F.lit("old").alias("content"), "metadata", F.lit(1).alias("version"))
    new = again.select("fragment_id", F.concat(F.lit("new "), "fragment_id").alias("content"), "metadata", F.lit(2).alias("version"))
    fresh = base.filter("fragment_id = 'doc_1'").select(F.lit("doc_new").alias("fragment_id"), "content", "metadata", F.lit(1).alias("version"))
    return _state(index.upsert(base, old.unionByName(new).unionByName(fresh), "version"))


def add_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = document_index(spark, sf_dir)
    new = base.filter(index.lacks_vector()).select("fragment_id", F.array(F.lit(1.0), F.lit(0.0)).cast("array<float>").alias("embeddings"))
    return _state(index.add_vectors(base, new))


def update_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = document_index(spark, sf_dir)
    new = base.select("fragment_id", F.concat(F.lit("changed "), "fragment_id").alias("content"), F.array(F.lit(1.0)).cast("array<float>").alias("embeddings"))
    return _state(index.update_content(base, new))


def delete_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _state(index.delete(document_index(spark, sf_dir), "doc_7"))


def delete_by_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _state(index.delete_page(document_index(spark, sf_dir), 3))


def delete_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _state(index.delete_pending(document_index(spark, sf_dir)))


def chunks_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.chunk_json(_chunks(spark, sf_dir, LAMBDA))


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.envelopes(requests.page_ranges(*_requests(spark, sf_dir)), _chunks(spark, sf_dir, LAMBDA))


def markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.markdown(match.heading_tree(_elements(spark, sf_dir)))


def document_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.document_markdown(match.heading_tree(_elements(spark, sf_dir)))


def _stored_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page of recognition results for each document: texts, scores and boxes of unequal numbers, and some pages without texts."""
    xs = F.split("text", "\n")
    n = F.size(xs)
    rows = table(spark, sf_dir, "documents").filter(F.col("text").isNotNull()).select(
        F.col("doc_id").cast("string").alias("item_id"), (F.col("doc_id") % 4).cast("int").alias("page"), F.when(F.col("doc_id") % 9 != 0, xs).alias("rec_texts"),
        F.transform(F.sequence(F.lit(1), n), lambda i: (80 + i % 20).cast("double") / 100).alias("s"), F.transform(F.sequence(F.lit(1), n), lambda i: F.array(F.lit(50), 20 * i, F.lit(400), 20 * i + 14)).alias("b"), "doc_id",
    )
    short = F.greatest(F.size("s") - (F.col("doc_id") % 3).cast("int"), F.lit(0))
    return rows.select("item_id", "page", "rec_texts", F.slice("s", F.lit(1), short).alias("rec_scores"), "b").withColumnRenamed("b", "rec_boxes")


def stored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.ocr_lines(_stored_pages(spark, sf_dir))


def stored_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of which some lack a box, a label, a content or a confidence."""
    rows = _blocks(spark, sf_dir)
    k = F.col("item_id").cast("long") + F.col("block_idx")
    lacking = {"x1": k % 7 == 0, "label": k % 11 == 0, "content": k % 5 == 0, "confidence": k % 3 == 0}
    return pages.usable_blocks(rows.select(*[F.when(~lacking[c], F.col(c)).alias(c) if c in lacking else F.col(c) for c in rows.columns]))


def filter_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk.filter_counts(_lines(spark, sf_dir))


def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(chunk.preview(_chunks(spark, sf_dir, LAMBDA)))


def line_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    height = F.col("y2") - F.col("y1")
    kind = text_functions.line_class("content", height, "y1")
    return _lines(spark, sf_dir).select("item_id", "page", "ocr_seq", text_functions.line_report("ocr_seq", kind, "content", height, "y1", "ocr_confidence").alias("report"))


def structure_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.structure_boxes(_blocks(spark, sf_dir))


def _embedded(rows: DataFrame) -> DataFrame:
    """A stand-in for a model: vectors of three numbers made from the text."""
    return rows.withColumn("embeddings", F.array(F.length("content"), F.lit(1), F.lit(0)).cast("array<float>"))


def insert_with_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = document_index(spark, sf_dir)
    new = base.select(F.concat(F.lit("copy_"), "fragment_id").alias("fragment_id"), "content", "metadata")
    return _state(index.insert_with_vectors(base, new, _embedded))


def bulk_add_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _state(index.bulk_add_vectors(document_index(spark, sf_dir), _embedded))


def chunks_json_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chunks that the JSON of chunks_json holds."""
    rows = chunks_json(spark, sf_dir)
    kind = _chunks(spark, sf_dir, LAMBDA).select("fragment_id", "content", "metadata").schema
    return _flat(rows.select("item_id", "page", "chunk_no", F.from_json("json", kind).alias("c")).select("item_id", "page", "chunk_no", "c.*"))


def _answers(rows: DataFrame) -> DataFrame:
    """What the JSON of envelopes says: the pages and number of chunks, the chunks' ids in order, and errors."""
    body = F.from_json("body", "processed_pages string, total_chunks int, chunks array<struct<fragment_id:string,content:string>>, error string")
    rows = rows.select("item_id", "status", body.alias("b"))
    none = F.lit("-")
    return rows.select(
        "item_id", "status", F.coalesce("b.processed_pages", none).alias("processed_pages"), F.coalesce("b.total_chunks", F.lit(-1)).alias("total_chunks"), F.coalesce(F.array_join("b.chunks.fragment_id", ","), none).alias("fragments"),
        F.coalesce(F.md5(F.array_join("b.chunks.content", "|")), none).alias("contents_md5"), F.coalesce("b.error", none).alias("error"),
    )


def envelopes_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _answers(envelopes(spark, sf_dir))


def envelope_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of the answers itself."""
    return envelopes(spark, sf_dir).select("item_id", "status", F.length("body").alias("length"), F.md5("body").alias("body_md5"))


def _page_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stand-in for page images: bytes that say what a model finds on a page. One page in 13 can't be read."""
    lines, blocks = _lines(spark, sf_dir), _blocks(spark, sf_dir)
    box = F.array("x1", "y1", "x2", "y2")
    texts = lines.groupBy("item_id", "page").agg(F.array_sort(F.collect_list(F.struct("ocr_seq", "content", "ocr_confidence", box.alias("box")))).alias("l"))
    found = blocks.groupBy("item_id", "page").agg(F.array_sort(F.collect_list(F.struct("block_idx", "label", "content", "confidence", box.alias("bbox")))).alias("blocks"))
    broken = (F.col("item_id").cast("long") * 7 + F.col("page")) % 13 == 5
    says = F.struct(broken.alias("broken"), F.col("l.content").alias("rec_texts"), F.col("l.ocr_confidence").alias("rec_scores"), F.col("l.box").alias("rec_boxes"), "blocks")
    return texts.join(found, ["item_id", "page"], "left").select("item_id", "page", F.encode(F.to_json(says), "UTF-8").alias("png"))


def _stand_in():
    """Loads a model that reads what :func:`_page_images` wrote."""

    def load():
        import json

        def predict(png: bytes) -> dict:
            found = json.loads(png)
            if found["broken"]:
                raise ValueError("unreadable page")
            return found

        return predict

    return load


def _stand_in_layout():
    load = _stand_in()
    return lambda: lambda png: load()(png)["blocks"]


def failed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers where models fail on some pages: status 500 for requests that ask for such a page, nothing of them in between, and whole results for all others."""
    images = _page_images(spark, sf_dir)
    read, laid = recognition.recognise(images, _stand_in()), recognition.analyse_layout(images, _stand_in_layout())
    made = chunk.chunks(pages.ocr_lines(recognition.unfailed(read)), recognition.unfailed(laid), LAMBDA)
    asked = requests.with_failures(requests.page_ranges(*_requests(spark, sf_dir)), recognition.failures(read, laid))
    return _answers(requests.envelopes(asked, made))


def subtree_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements and tokens below each heading."""
    rows = match.subtrees(match.heading_tree(_elements(spark, sf_dir))).filter("level < 5")
    return rows.select("item_id", "page", "id", "level", "elements", F.col("tokens").cast("long").alias("tokens"))


def batch_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest documents of every fiftieth vector."""
    asked = table(spark, sf_dir, "embeddings").filter("vec_id % 50 = 0").select(F.col("vec_id").cast("string").alias("query_id"), F.col("embedding").alias("query"))
    return search.batch_search(document_index(spark, sf_dir), asked).select("query_id", "fragment_id", F.round("score", 6).alias("score"), "rank")


def _changed_store(spark: SparkSession, sf_dir: str) -> store.Store:
    """All documents in a store; then those without a vector come again with another text, and a page and a row go."""
    kept = store.Store(spark, scratch(spark, "store"), 8, 8)
    pending = lambda: kept.rows().filter(index.lacks_vector()).select("fragment_id", F.concat(F.lit("New text of the "), "fragment_id").alias("content"), "metadata")
    for change in (lambda: kept.upsert(document_index(spark, sf_dir)), lambda: kept.upsert(pending()), lambda: kept.delete_page(3), lambda: kept.delete("doc_7")):
        change()
        kept.tidy()  # nobody else reads it: what a change replaces goes
    return kept


def stored_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _state(_changed_store(spark, sf_dir).frame())


def stored_text_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text search by the postings of a store that was changed."""
    found = _changed_store(spark, sf_dir).text_search(QUERY, SECTION)
    return found.select("fragment_id", F.round("score", 6).alias("score"), F.length("highlight").alias("highlight_length"))


def stored_hybrid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(_changed_store(spark, sf_dir).hybrid_search(_query_vector(spark, sf_dir), QUERY))


#: Boxes that are asked for, on every page.
BOXES = (("top", 0, 0, 600, 100), ("left column", 0, 300, 75, 420), ("foot", 100, 700, 560, 760), ("beside", 565, 0, 700, 800))


def chunks_by_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All chunks written by place, and those that meet some boxes read back."""
    path = f"{scratch(spark, 'placed')}/chunks"
    place.write_placed(_chunks(spark, sf_dir, ENHANCED), path)
    return place.meeting(place.read_placed(spark, path), BOXES).select("box", "item_id", "page", "chunk_no", "fragment_id", *place.CORNERS)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    plain = (
        clean_text, clean_text_lambda, token_counts, quality_filter, classify_lines, reading_order, tree_children, semantic_chunks_enhanced, semantic_chunks_grid, semantic_chunks_lambda, flat_chunks, chunk_summary, page_range,
        invocation_status, semantic_search, filtered_search, text_search, hybrid_search, fetch_one, fetch_content, multi_get, pending_vectors, pending_count, bulk_upsert, add_vectors, update_content, delete_by_id, delete_by_page,
        delete_pending, chunks_json, envelopes, markdown, stored_lines, stored_blocks, filter_counts, preview, line_report, structure_boxes, insert_with_vectors, bulk_add_vectors, chunks_json_read, envelopes_read,
        envelope_bodies, failed_items, subtree_totals, batch_search, stored_changes, stored_text_search, stored_hybrid_search, chunks_by_place, highlights, document_markdown,
    )
    return {f.__name__: f for f in plain} | {
        "spatial_match": _matched(ENHANCED), "spatial_match_grid": _matched(GRID), "heading_tree_enhanced": _tree(ENHANCED), "heading_tree_lambda": _tree(LAMBDA),
    }


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
