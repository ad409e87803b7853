"""Language by sparse multinomial logistic regression on TF-IDF of character n-grams.

Characters are lower-cased, all but letters become one space, and the n-grams of 1 to ``most``
characters are hashed to ``2 ** bits`` features, weighted (1 + log count) * idf and scaled to
length 1. Document frequencies count every document to learn from. The weights are trained with
follow-the-regularised-leader, one step a text, with L1 and L2 penalties (many are exactly 0), on
about ``per_class`` texts of each language; a part of these is kept for the temperature that
calibrates the probabilities.

Learning uses no document of the held-out fold, and no null language. All texts are predicted
whole. Defined cases: ``und`` with score 0 for a null text or one without letters (what ``str.isalpha`` says is one), and for all if
there is nothing to learn from. Repeated rows are predicted each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm._common import held_out, is_held_out, sampled, small_batches, texts, worker_cache


@dataclass(frozen=True)
class Language:
    per_class: int = 600
    most: int = 3
    bits: int = 14
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 1e-3
    l2: float = 1e-3
    epochs: int = 3
    hold: int = 5  # every so manieth text learns the temperature
    seed: int = 43


def _letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    cache = worker_cache()
    if "letters" not in cache:
        cache["letters"] = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return cache["letters"]


def counts_of(text: str, how: Language) -> np.ndarray:
    """How often each hashed n-gram stands in the text; a long text is counted in parts."""
    out = np.zeros(1 << how.bits, np.int64)
    for at in range(0, len(text), 1 << 20):
        part = text[at : at + (1 << 20) + how.most - 1].lower()
        c = np.frombuffer(part.encode("utf-32-le", "replace"), np.uint32)
        letter = _letters()[c]
        c = np.where(letter, c, 32)
        c = c[letter | np.concatenate([[True], letter[:-1]])]
        h = np.zeros(len(c), np.uint32)
        for n in range(how.most):
            if len(c) <= n:
                break
            h = (h[: len(c) - n] * np.uint32(0x01000193)) ^ (c[n:] * np.uint32(0x9E3779B1) + np.uint32(n))
            out += np.bincount(((h * np.uint32(0x85EBCA6B)) >> np.uint32(32 - how.bits)).astype(np.int64), minlength=len(out))
    return out


def vector(text: str, idf: np.ndarray, how: Language) -> tuple[np.ndarray, np.ndarray]:
    counts = counts_of(text, how)
    at = np.flatnonzero(counts)
    x = (1 + np.log(counts[at])) * idf[at]
    return at, x / max(np.sqrt(x @ x), 1e-12)


def _frequencies(how: Language):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(1 << how.bits, np.int64)
        for batch in small_batches(batches):
            for t in texts(batch.column("text")).to_pylist():
                df += counts_of(t, how) > 0
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], ["f", "df"])

    return run


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, n_classes: int, how: Language) -> np.ndarray:
    """Weights by features and classes."""
    z, n = np.zeros((1 << how.bits, n_classes)), np.zeros((1 << how.bits, n_classes))

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= how.l1, 0, -(z - np.sign(z) * how.l1) / ((how.beta + np.sqrt(n)) / how.alpha + how.l2))

    rng = np.random.default_rng(how.seed)
    for _ in range(how.epochs):
        for i in rng.permutation(len(rows)):
            at, x = rows[i]
            w = weights(z[at], n[at])
            s = x @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y[i]] -= 1
            g = np.outer(x, p)
            more = n[at] + g * g
            z[at] += g - (np.sqrt(more) - np.sqrt(n[at])) / how.alpha * w
            n[at] = more
    return weights(z, n)


def temperature(scores: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the scores that makes the labels likeliest."""
    if not len(y):
        return 1.0

    def loss(t: float) -> float:
        s = scores / t
        s = s - s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(y)), y]).mean())

    grid = np.exp(np.linspace(np.log(0.05), np.log(5), 60))
    return float(grid[np.argmin([loss(t) for t in grid])])


def fit(docs: DataFrame, how: Language = Language()):
    """classes, idf, weights, temperature; None if there is nothing to learn from."""
    known = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    df = np.zeros(1 << how.bits)
    got = known.select("text").mapInArrow(_frequencies(how), "f long, df long").groupBy("f").agg(F.sum("df").alias("df")).toArrow()  # a row for each feature
    df[np.asarray(got["f"])] = np.asarray(got["df"])
    n = known.select("lang").count()
    idf = np.log((1 + n) / (1 + df)) + 1

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            rows = [vector(t, idf, how) for t in texts(batch.column("text")).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("lang"), pa.array([r[0].astype(np.int32) for r in rows], pa.list_(pa.int32())), pa.array([r[1].astype(np.float32) for r in rows], pa.list_(pa.float32()))], ["doc_id", "lang", "at", "x"])

    got = sampled(known, "lang", how.per_class).select("doc_id", "lang", "text").mapInArrow(vectors, "doc_id long, lang string, at array<int>, x array<float>").toArrow()
    if not len(got):
        return None
    ids, langs = np.asarray(got["doc_id"]), got["lang"].to_pylist()
    classes = sorted(set(langs))
    y = np.array([classes.index(x) for x in langs])
    at, x = got["at"].combine_chunks(), got["x"].combine_chunks()
    rows = [(at[i].values.to_numpy().astype(np.int64), x[i].values.to_numpy().astype(np.float64)) for i in range(len(y))]
    # rows come in any order: by id, language, and what else tells texts apart
    order = np.lexsort([[float(r[1].sum()) for r in rows], [len(r[0]) for r in rows], y, ids])
    hold = [i for k, i in enumerate(order) if k % how.hold == 0]
    learn = [i for k, i in enumerate(order) if k % how.hold] or hold
    w = ftrl([rows[i] for i in learn], y[learn], len(classes), how)
    t = temperature(np.array([rows[i][1] @ w[rows[i][0]] for i in hold]), y[hold])
    return classes, idf, w, t


def identify(docs: DataFrame, how: Language = Language()) -> DataFrame:
    """doc_id, held_out, lang_pred, score: one row for each row of ``docs``."""
    model = fit(docs, how)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            names, scores = [], []
            for text in texts(batch.column("text")).to_pylist():
                if model is None or not any(c.isalpha() for c in text):
                    names.append("und")
                    scores.append(0.0)
                    continue
                classes, idf, w, t = model
                at, x = vector(text, idf, how)
                s = x @ w[at] / t
                p = np.exp(s - s.max())
                k = int(np.argmax(p))
                names.append(classes[k])
                scores.append(float(p[k] / p.sum()))
            held = [is_held_out(i) for i in batch.column("doc_id").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(held, pa.bool_()), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
