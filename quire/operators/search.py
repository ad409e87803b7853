"""Search over an index of chunks: by vector, by text, and both."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions.text import best_passages, marked, terms
from quire.modes import MIN_CONFIDENCE

K1, B = 1.2, 0.75


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine of two vectors, summed in doubles; null if either has no length."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)

    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm)


def vector_scores(index: DataFrame, query: Sequence[float] | DataFrame) -> DataFrame:
    """The index with ``score``: cosine to the query vector (a list, or a frame of one row ``query``) plus 1. Rows without a vector are left out."""
    rows = index.filter(F.col("embeddings").isNotNull() & (F.size("embeddings") > 0))
    if isinstance(query, DataFrame):
        rows = rows.crossJoin(F.broadcast(query.select(F.col("query").alias("_query")).limit(1)))  # one row
        return rows.withColumn("score", cosine("embeddings", "_query") + 1.0).drop("_query")
    return rows.withColumn("score", cosine("embeddings", F.array(*[F.lit(float(x)) for x in query])) + 1.0)


def top(rows: DataFrame, k: int, score: str = "score") -> DataFrame:
    return rows.orderBy(F.desc(score), "fragment_id").limit(k)


def semantic_search(index: DataFrame, query, top_k: int = 5) -> DataFrame:
    return top(vector_scores(index, query), top_k)


def _nearest(ids: list[str], vectors: np.ndarray, top_k: int, dim: int):
    """For each task, the ``top_k`` rows of greatest cosine for each of the queries ``ids``: no more leave it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, scores = [np.zeros(0, object)] * len(ids), [np.zeros(0)] * len(ids)
        for batch in batches:
            flat = batch.column("embeddings").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            rows = flat.reshape(-1, dim)
            length = np.sqrt((rows * rows).sum(axis=1))
            found = np.round(vectors @ (rows / np.where(length > 0, length, 1)[:, None]).T, 9)
            found[:, ~(length > 0)] = np.nan  # a vector without length has no cosine, as one with nulls
            own = np.array(batch.column("fragment_id").to_pylist(), object)
            for q in range(len(ids)):
                some = np.flatnonzero(~np.isnan(found[q]))
                if len(some) > top_k:  # all that reach the k-th score, ties too
                    some = some[found[q, some] >= np.partition(found[q, some], len(some) - top_k)[len(some) - top_k]]
                all_names, all_scores = np.append(names[q], own[some]), np.append(scores[q], found[q, some])
                best = sorted(range(len(all_names)), key=lambda i: (-all_scores[i], all_names[i].encode()))[:top_k]  # noqa: B023
                names[q], scores[q] = all_names[best], all_scores[best]
        if any(len(x) for x in names):
            query = [i for i, x in zip(ids, names, strict=True) for _ in x]
            yield pa.RecordBatch.from_arrays([pa.array(query, pa.string()), pa.array(np.concatenate(names), pa.string()), pa.array(np.concatenate(scores) + 1.0)], ["query_id", "fragment_id", "score"])

    return run


def batch_search(index: DataFrame, queries: DataFrame, top_k: int = 5, block: int = 1024) -> DataFrame:
    """query_id, fragment_id, score, rank: the ``top_k`` nearest rows of every query of ``queries`` (query_id string, query), as :func:`semantic_search` for each.

    Queries go in blocks of about ``block``, each in one pass over the index: their vectors are sent to the tasks, which multiply whole batches of rows
    with them and return ``top_k`` rows a query at most, so that what is shuffled doesn't grow with the index's rows but with its tasks.
    Scores count to nine digits; ties go by id. Rows and queries without a vector, or without length, are left out; rows meet queries of their own
    vector length alone.
    """
    queries = queries.filter(F.col("query").isNotNull() & (F.size("query") > 0)).withColumn("dim", F.size("query"))
    rows = index.filter(F.col("fragment_id").isNotNull() & F.col("embeddings").isNotNull()).select("fragment_id", "embeddings")
    empty = index.select(F.lit("").alias("query_id"), "fragment_id", F.lit(0.0).alias("score")).filter("false")
    found = [empty]
    for dim, n in sorted((r["dim"], r["count"]) for r in queries.groupBy("dim").count().collect()):  # few lengths
        passes = -(-n // block)
        for k in range(passes):
            some = queries.filter((F.col("dim") == dim) & (F.pmod(F.xxhash64("query_id"), F.lit(passes)) == k)).select("query_id", "query").collect()  # about ``block``
            vectors = np.array([r["query"] for r in some], dtype=np.float64).reshape(len(some), dim)
            length = np.sqrt((vectors * vectors).sum(axis=1))
            some = [r["query_id"] for r, n in zip(some, length, strict=True) if n > 0]
            vectors = vectors[length > 0] / length[length > 0, None]
            if some:
                own = rows.filter((F.size("embeddings") == dim) & ~F.exists("embeddings", F.isnull))
                found.append(own.mapInArrow(_nearest(some, vectors, top_k, dim), "query_id string, fragment_id string, score double"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "fragment_id")
    return reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top_k)


def filtered_search(index: DataFrame, query, min_confidence: float = MIN_CONFIDENCE, page: int | None = None, top_k: int = 5) -> DataFrame:
    rows = index.filter(F.col("metadata.ocr_confidence") >= min_confidence)
    if page is not None:
        rows = rows.filter(F.col("metadata.page") == page)
    return top(vector_scores(rows, query), top_k)


def text_scores(index: DataFrame, query: str, field: Column | str = "content", k1_factor: bool = True) -> DataFrame:
    """fragment_id, score: BM25 of rows with any term of the query. Only rows' lengths and query terms' counts are shuffled."""
    field = F.col(field) if isinstance(field, str) else field
    wanted = sorted({t for t in terms_of(query)})
    rows = index.select("fragment_id", terms(F.coalesce(field, F.lit(""))).alias("ts"))  # no filter here: it would split every text again
    counts = [(F.size("ts") - F.size(F.array_remove("ts", t))).alias(f"tf{i}") for i, t in enumerate(wanted)]
    rows = rows.select("fragment_id", F.size("ts").alias("len"), *counts)
    some = F.when(F.col("len") > 0, F.col("len"))
    totals = rows.agg(F.count(some).alias("n"), F.avg(some).alias("avg"), *[F.count_if(F.col(f"tf{i}") > 0).alias(f"df{i}") for i in range(len(wanted))])
    rows = rows.crossJoin(F.broadcast(totals))  # one row
    score = F.lit(0.0)
    for i in range(len(wanted)):
        idf = F.log(1 + (F.col("n") - F.col(f"df{i}") + 0.5) / (F.col(f"df{i}") + 0.5))
        tf = F.col(f"tf{i}")
        score = score + idf * tf * (K1 + 1 if k1_factor else 1.0) / (tf + K1 * (1 - B + B * F.col("len") / F.col("avg")))
    return rows.withColumn("score", score).filter("score > 0").select("fragment_id", "score")


def terms_of(query: str) -> list[str]:
    """The query's own terms, by the same expression as those of texts."""
    return SparkSession.active().sql("SELECT 1").select(terms(F.lit(query))).first()[0]  # folded when planned: no job


def highlighted(text: Column | str, query: str) -> Column:
    """The text with the query's terms in <em> marks."""
    return marked(F.col(text) if isinstance(text, str) else text, sorted(set(terms_of(query))))


def highlight_fragments(text: Column | str, query: str, size: int = 100, number: int = 5) -> Column:
    """The best passages for the query, as :func:`quire.functions.text.best_passages` says; empty if no term is in the text, null if there is none."""
    return best_passages(F.col(text) if isinstance(text, str) else text, sorted(set(terms_of(query))), size, number)


def with_highlights(rows: DataFrame, query: str) -> DataFrame:
    """Rows with ``highlight``, the whole content with marks, and ``fragments``, its best passages."""
    return rows.withColumn("highlight", highlighted("content", query)).withColumn("fragments", highlight_fragments("content", query))


def text_search(index: DataFrame, query: str, section: str | None = None, size: int = 10) -> DataFrame:
    """fragment_id, content, score, highlight, fragments. With ``section``, the primary section must match too, and its score adds."""
    scores = text_scores(index, query)
    if section:
        more = text_scores(index, section, F.col("metadata.primary_section")).withColumnRenamed("score", "more")
        scores = scores.join(more, "fragment_id").select("fragment_id", (F.col("score") + F.col("more")).alias("score"))
    found = top(scores, size)
    return top(with_highlights(index.select("fragment_id", "content").join(F.broadcast(found), "fragment_id"), query), size)  # ``size`` rows


def hybrid_search(index: DataFrame, query_vector, query: str, alpha: float = 0.7, size: int = 10, boost_mode: str = "sum") -> DataFrame:
    """fragment_id, score: alpha * (cosine + 1) plus (1 - alpha) * BM25, a missing side adding 0. boost_mode "multiply": the text side squared."""
    return hybrid_of(vector_scores(index, query_vector), text_scores(index, query), alpha, size, boost_mode)


def hybrid_of(vectors: DataFrame, text: DataFrame, alpha: float = 0.7, size: int = 10, boost_mode: str = "sum") -> DataFrame:
    """:func:`hybrid_search` of the scores of both sides (fragment_id, score)."""
    text = text.withColumnRenamed("score", "text_score")
    vectors = vectors.select("fragment_id", F.col("score").alias("vector_score"))
    by_text = (1 - alpha) * F.coalesce("text_score", F.lit(0.0)) * (F.coalesce("text_score", F.lit(0.0)) if boost_mode == "multiply" else 1)
    both = vectors.join(text, "fragment_id", "full").select("fragment_id", (alpha * F.coalesce("vector_score", F.lit(0.0)) + by_text).alias("score"))
    return top(both, size)
