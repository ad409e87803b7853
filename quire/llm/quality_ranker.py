"""Quality by Bradley-Terry pairwise ranking.

A text's score is linear in indicator features: each of some measures of the text (symbols,
capitals, repeats, lengths, ...) falls into one of its quantile bins. Of all pairs of a preferred
(label 1) and another text (label 0), the weights maximise the likelihood that the preferred one
wins, the logistic function of the difference of scores. The raw score's threshold is the
quantile of the learning texts' scores at the share of label 0; a shift puts it at ``cut_at``.

Learning uses all labelled texts outside the held-out fold. Quantiles are exact over all of them, of measures kept to 12 binary
digits. A step of learning is two passes over their bins: counts by label and score, from which the driver has the pull on a text of each score
by all texts of the other label, then the sums of those pulls by bin. Scores count to 1/64 there, to 1/4096 for the
threshold. The driver gets counts and sums of bins alone, whole numbers, so that reruns agree. All texts are scored whole.

Defined cases: null and empty texts are scored as texts without words. A label that is null, or
of a document that isn't there, is ignored; of several labels of a doc_id the greatest counts; with no pair to learn from, every score is 0.5.
Repeated rows are scored each. Extra columns are ignored by the scores and kept by the filter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm._common import cut, held_out, is_held_out, small_batches, texts


@dataclass(frozen=True)
class Ranker:
    bins: int = 12
    l2: float = 1e-3
    steps: int = 20
    cut_at: float = 0.3


_CLASSES = {
    "symbols": b"#*$%&|<>", "upper": bytes(range(65, 91)), "digits": b"0123456789", "stops": b".", "commas": b",;:", "shouts": b"!?", "bars": b"|", "lines": b"\n",
    "spaces": b" \t", "quotes": b"\"'()[]{}@=+-_/\\", "other": bytes(range(128, 256)),
}


def measures(text: str) -> list[float]:
    raw = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    n = max(1, int(raw.sum()))
    words = text.split()
    k = max(1, len(words))
    lines = text.split("\n")
    shares = [float(raw[list(c)].sum()) / n for c in _CLASSES.values()]
    distinct = len(set(words))
    same = sum(map(eq, words, words[1:]))
    pairs = len(set(zip(words, words[1:], strict=False)))
    return [*shares, np.log1p(len(words)), n / k, distinct / k, same / k, pairs / k, distinct / k**0.8, len(set(lines)) / len(lines), k / len(lines), sum(map(str.isupper, words)) / k, len(max(words, key=len, default="")) / 20]


_MEASURES = len(_CLASSES) + 10
_LARGEST = 32.0  # of raw scores, for counts
_FIXED = 1 << 20  # of pulls, as whole numbers


def _rows(column: pa.Array) -> np.ndarray:
    """Measures of texts, to 12 binary digits."""
    x = np.array([measures(t) for t in texts(column).to_pylist()], np.float32).reshape(-1, _MEASURES)
    return (x.view(np.int32) & ~np.int32(0xFFF)).view(np.float32)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and measures ``x`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(list(_rows(batch.column("text"))), pa.list_(pa.float32()))], ["doc_id", "x"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, x array<float>")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _summed(rows: DataFrame, of: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]], size: int) -> np.ndarray:
    """Sums over all rows (label, x) of the whole numbers that ``of`` gives for places below ``size``: by task, then by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            if len(batch):
                at, n = of(np.asarray(batch.column("label")), _matrix(batch.column("x")))
                total += np.bincount(at, n, size).astype(np.int64)  # exact below 2**53
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    got = rows.mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size)
    out[np.asarray(got["at"])] = np.asarray(got["n"])
    return out


class Model:
    def __init__(self, edges: list[np.ndarray], weights: np.ndarray, shift: float):
        self.edges, self.weights, self.shift = edges, weights, shift
        self.starts = np.cumsum([0, *[len(e) + 1 for e in edges[:-1]]])

    def codes(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1) + self.starts

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.weights[self.codes(x)].sum(axis=1)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x) + self.shift, -40, 40)))

    def places(self, x: np.ndarray, parts: int) -> np.ndarray:
        """Raw scores as whole numbers, ``parts`` to one."""
        return np.round((np.clip(self.raw(x), -_LARGEST, _LARGEST) + _LARGEST) * parts).astype(np.int64)


def _counts(rows: DataFrame, model: Model, parts: int) -> np.ndarray:
    """How many rows of each label have each raw score."""
    size = int(2 * _LARGEST * parts) + 1
    return _summed(rows, lambda y, x: (y * size + model.places(x, parts), np.ones(len(y))), 2 * size).reshape(2, size)


def _gradient(rows: DataFrame, model: Model, parts: int = 64) -> np.ndarray:
    """Of the mean loss over all pairs: what texts of label 0 pull on each of label 1, and the reverse, summed by bin."""
    counts = _counts(rows, model, parts)
    size = counts.shape[1]
    n0, n1 = counts.sum(axis=1)
    loses = 1 / (1 + np.exp(np.arange(1 - size, size) / parts))  # chance to lose, by the score's lead
    # pull on a text of label 1: the mean chance that it loses; on one of label 0: the mean chance that it wins
    ahead = np.convolve(counts[0], loses)[size - 1 : 2 * size - 1] / n0
    behind = np.convolve(counts[1], loses[::-1])[size - 1 : 2 * size - 1] / n1
    pulls, size = np.round(np.stack([behind, -ahead]) * _FIXED), len(model.weights)

    def of(y: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        codes = model.codes(x) + y[:, None] * size
        return codes.ravel(), np.repeat(pulls[y, model.places(x, parts)], codes.shape[1])

    by_label = _summed(rows, of, 2 * size).reshape(2, size) / _FIXED
    return by_label[0] / n0 + by_label[1] / n1


def _step(g: np.ndarray, past: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """L-BFGS: against the gradient, by the curvature of past steps and their changes of gradient; by 1 at most for a weight, 0.3 at first."""
    r, shares = g.copy(), []
    for s, d in reversed(past):
        shares.append(s @ r / (s @ d))
        r -= shares[-1] * d
    if past:
        s, d = past[-1]
        r *= s @ d / (d @ d)
    for (s, d), share in zip(past, reversed(shares), strict=True):
        r += s * (share - d @ r / (s @ d))
    most = max(np.abs(r).max(), 1e-12)
    return -r * (min(1.0, 1 / most) if past else 0.3 / most)


def fit(rows: DataFrame, labels: DataFrame, how: Ranker = Ranker()) -> Model | None:
    """The model of all labelled rows of ``rows``, as :func:`measured` gives them, outside the held-out fold."""
    ids = labels.filter(F.col("quality").isin(0, 1)).select("doc_id", "quality").filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("quality").alias("label"))
    known = cut(rows.join(ids, "doc_id").select(F.col("label").cast("int").alias("label"), "x"), "measures")
    # exact quantiles of each class, which count alike, so that bins resolve the rarer one too
    inner = F.array(*[F.lit(float(q)) for q in np.linspace(0, 1, how.bins + 1)[1:-1]])
    found = sorted(known.groupBy("label").agg(F.count("*").alias("n"), *[F.percentile(F.col("x")[j], inner).alias(f"q{j}") for j in range(_MEASURES)]).collect())
    if len(found) < 2:
        return None
    edges = [np.unique(np.concatenate([r[f"q{j}"] for r in found])) for j in range(_MEASURES)]
    model = Model(edges, np.zeros(sum(len(e) + 1 for e in edges)), 0.0)
    n0, n1 = (r["n"] for r in found)
    before, past = None, []
    for _ in range(how.steps):
        g = _gradient(known, model) + how.l2 * model.weights
        if before and (model.weights - before[0]) @ (g - before[1]) > 1e-12:
            past = [*past, (model.weights - before[0], g - before[1])][-10:]
        before = model.weights, g
        model = Model(edges, model.weights + _step(g, past), 0.0)
    # where as many learning texts as have label 0 score lower: between two scores that some have
    parts = 4096
    counts = _counts(known, model, parts).sum(axis=0)
    used = np.flatnonzero(counts)
    at = min(int(np.searchsorted(np.cumsum(counts[used]), n0)), len(used) - 1)
    threshold = (used[at] + used[min(at + 1, len(used) - 1)]) / 2 / parts - _LARGEST
    model.shift = float(np.log(how.cut_at / (1 - how.cut_at)) - threshold)
    return model


def rank_quality(docs: DataFrame, labels: DataFrame, how: Ranker = Ranker()) -> DataFrame:
    """doc_id, held_out, score, predicted: one row for each row of ``docs``."""
    rows = cut(measured(docs), "measured")
    model = fit(rows, labels, how)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.scores(_matrix(batch.column("x"))) if model and len(batch) else np.full(len(batch), 0.5)
            held = [is_held_out(i) for i in batch.column("doc_id").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(held, pa.bool_()), pa.array(scores), pa.array((scores >= how.cut_at).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def good_rows(docs: DataFrame, labels: DataFrame, how: Ranker = Ranker()) -> DataFrame:
    """The rows of ``docs`` that score at least ``cut_at``, with all their columns."""
    model = fit(measured(docs.filter(~held_out(F.col("doc_id")))), labels, how)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            yield batch.filter(pa.array(model.scores(_rows(batch.column("text"))) >= how.cut_at)) if model else batch

    return docs.mapInArrow(run, docs.schema)
