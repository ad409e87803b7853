"""Toxicity by the nearest labelled examples, by exact TF-IDF cosine over a block-max inverted index.

The examples are about ``per_class`` labelled texts of each label outside the held-out fold. Words (runs of letters and
digits in lower case) and their beginnings of ``stems`` letters (texts build many forms on one stem) are the terms: all
that any example has. A term's weight is its idf by an emphasis from ``rest`` to 1 by how unevenly it stands in the labels
(chi-squared, 1 from ``surely`` or the ``least``-th greatest on); no term is left out. Document frequencies count every
document outside that fold, chi-squared every labelled one.

An index entry is a (term, block of examples) with the block's greatest weight and its postings; blocks hold examples
alike, so that texts of another kind pass them by. Entries of ``dense`` postings or more are rows of the block's matrix.
Smaller ones hold hardly more than their bound, so their postings stand in one list for each term. Queries come in batches:
each sums what the lists give every example, and bounds what a block can give besides by its entries' greatest weights. It
scores the blocks of greatest bound in full, and then only those other blocks whose bound reaches its k-th best score
so far: the k nearest are exact. Votes weigh each neighbour by exp(-distance / ``width``); a logistic fit on the examples
themselves (each without itself, weighted to the labels' shares) makes the vote a probability.
The neighbours are the evidence.

Defined cases: texts without a word of any example (null and empty ones too) have no neighbour and get
the share of label 1 among the examples without one. Cosines count to six digits; ties among neighbours go to the example first in the index. With no example of both
labels, or none with a term, every score is the share of label 1 (0 if there is none). If the examples
that have a term are of one label, n of them, texts with a term score as near to it as (n + 1/2) / (n + 1). Of several labels of a doc_id the greatest
counts. Repeated rows are scored each; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm._common import held_out, is_held_out, release, sampled, small_batches, texts


@dataclass(frozen=True)
class Nearest:
    per_class: int = 2000
    k: int = 31
    block: int = 64
    first: int = 4  # blocks scored before the bounds count
    dense: int = 8  # postings from which on an entry is a row of its block's matrix
    batch: int = 120_000  # terms of the texts that are scored together
    width: float = 0.1  # of distance, over which a vote falls by a factor of e
    power: float = 1.2  # of the idf
    stems: tuple[int, ...] = (4, 6)  # letters of the beginnings that are terms
    surely: float = 20.0  # chi-squared of a term and the label, from which on a term has its full weight
    least: int = 30  # terms of the greatest chi-squared have it in any case
    rest: float = 0.1  # part of its weight that a term has with a chi-squared of 0


def word_lists(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Where each text's words begin (one more at the end), and the words of all, dictionary encoded."""
    spaced = pc.replace_substring_regex(pc.utf8_lower(texts(column)), r"[^\p{L}\p{N}]+", " ")
    lists = pc.ascii_split_whitespace(spaced)
    flat, offsets = lists.flatten(), np.asarray(lists.offsets, dtype=np.int64)
    filled = np.asarray(pc.not_equal(flat, ""), dtype=bool)
    starts = np.concatenate([[0], np.cumsum(filled)])[offsets - offsets[0]]
    return starts, pc.dictionary_encode(flat.filter(pa.array(filled)))


def word_counts(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Text, code and count of each text's distinct words, by text; the words of the codes."""
    starts, coded = word_lists(column)
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    k = max(1, len(coded.dictionary))
    pairs, counts = np.unique(text * k + np.asarray(coded.indices, dtype=np.int64), return_counts=True)
    return pairs // k, pairs % k, counts, coded.dictionary


def pieces(words: pa.Array, how: Nearest) -> list[pa.Array]:
    """The words, and for each length their beginnings; null where a word isn't longer."""
    words = words.cast(pa.string())
    length = pc.utf8_length(words)
    return [words, *(pc.if_else(pc.greater(length, n), pc.utf8_slice_codeunits(words, 0, n), None) for n in how.stems)]


class Terms:
    """Numbers for the words, and for each length the beginnings, of some words."""

    def __init__(self, words: pa.Array, how: Nearest):
        self.how = how
        self.known = [(u := pc.unique(x.drop_null())).take(pc.array_sort_indices(u)) for x in pieces(words, how)]
        self.begins = np.cumsum([0, *map(len, self.known)])

    def __len__(self) -> int:
        return int(self.begins[-1])

    def numbers(self, words: pa.Array) -> np.ndarray:
        """A row for each word, -1 where a piece of it is no term."""
        out = []
        for x, known, begin in zip(pieces(words, self.how), self.known, self.begins, strict=False):
            at = np.asarray(pc.fill_null(pc.index_in(x, value_set=known, skip_nulls=True), -1), dtype=np.int64)
            out.append(np.where(at < 0, -1, at + begin))
        return np.stack(out, axis=1)

    def count(self, text: np.ndarray, code: np.ndarray, counts: np.ndarray, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, number and count of each text's terms, by text and number."""
        numbers = self.numbers(words)
        bits = int(counts.max()).bit_length() if len(counts) else 1  # a key holds text, term and count
        parts = []
        for j in range(numbers.shape[1]):
            t = numbers[:, j][code]
            has = t >= 0
            parts.append(((text[has] * len(self) + t[has]) << bits) | counts[has])
        packed = np.sort(np.concatenate(parts))
        keys = packed >> bits
        begins = np.flatnonzero(np.diff(keys, prepend=-1))
        keys, k = keys[begins], max(1, len(self))
        return keys // k, keys % k, np.add.reduceat(packed & ((1 << bits) - 1), begins) if len(begins) else begins


def chi_squared(m: np.ndarray, a: np.ndarray, n: int, n_1: int) -> np.ndarray:
    """Of terms that m of n rows have, a of them among the n_1 rows of label 1, with Yates' correction."""
    off = np.maximum(np.abs(a * n - m * n_1) - n / 2, 0)
    return n * off**2 / np.maximum(1.0 * n_1 * (n - n_1) * m * (n - m), 1e-9)


def emphasis(chi: np.ndarray, how: Nearest) -> np.ndarray:
    """The part of its weight that each term has, by its chi-squared: never 0."""
    k = min(how.least, len(chi))
    full = max(min(how.surely, float(np.partition(chi, len(chi) - k)[len(chi) - k])), 1e-9)
    return how.rest + (1 - how.rest) * np.minimum(chi / full, 1)


def _ranges(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All integers of the ranges, none of them empty, one after the other."""
    if not len(begin):
        return np.zeros(0, np.int32)
    stop = np.cumsum(end - begin)
    steps = np.ones(stop[-1], np.int32)
    steps[0] = begin[0]
    steps[stop[:-1]] = begin[1:] - end[:-1] + 1
    return np.cumsum(steps, dtype=np.int32)


def plain(x: Terms | Index) -> dict:
    """What ``x`` has, without classes of this package: a broadcast is unpickled by name, where the package need not be installed."""
    return {k: v for k, v in vars(x).items() if k != "how"}


def restored(kind: type, state: dict, how: Nearest):
    """The object that :func:`plain` took apart."""
    x = object.__new__(kind)
    vars(x).update(state, how=how)
    return x


def _normal(text: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """The weights, each text's scaled to length 1."""
    return (weight / np.sqrt(np.maximum(np.bincount(text, weight * weight, n), 1e-24))[text]).astype(np.float32)


class Index:
    """Examples by their terms: ``example``, ``term`` and ``count`` of each, by example. idf: by term."""

    def __init__(self, idf: np.ndarray, example: np.ndarray, term: np.ndarray, count: np.ndarray, labels: np.ndarray, ids: np.ndarray, how: Nearest):
        self.idf, self.how, n = idf, how, len(labels)
        self._lay_out(example, term, count, labels, ids)
        if n > 2 * how.block:
            order = self._alike(example, term, count, n)
            place = np.empty(n, np.int32)
            place[order] = np.arange(n)
            self._lay_out(place[example], term, count, labels[order], ids[order])
        self.a = self.b = self.base = 0.0

    def _lay_out(self, example: np.ndarray, term: np.ndarray, count: np.ndarray, labels: np.ndarray, ids: np.ndarray) -> None:
        how, n = self.how, len(labels)
        self.labels, self.ids, self.n_blocks = labels, ids, -(-n // how.block)
        weight = _normal(example, self.weights(term, count), n)
        order = np.lexsort([example, term])
        example, term, weight = example[order], term[order], weight[order]
        block = example // how.block
        begin = np.flatnonzero(np.diff(term.astype(np.int64) * self.n_blocks + block, prepend=-1))
        size = np.diff(np.append(begin, len(term)))
        entry = np.repeat(np.arange(len(begin)), size)
        full = size >= how.dense
        # full entries: a row in the block's matrix; the terms that have any are columns of queries
        self.column = np.full(len(self.idf), -1, np.int32)
        columns = np.unique(term[begin[full]])
        self.column[columns] = np.arange(len(columns))
        self.most = np.zeros((len(columns), self.n_blocks), np.float32)
        self.rows, self.matrix = [], []
        bound = np.maximum.reduceat(weight, begin)
        for b in range(self.n_blocks):
            own = np.flatnonzero(full & (block[begin] == b))
            self.rows.append(self.column[term[begin[own]]])
            self.most[self.rows[-1], b] = bound[own]
            place = np.full(len(begin), -1)
            place[own] = np.arange(len(own))
            posts = np.flatnonzero(place[entry] >= 0)
            matrix = np.zeros((how.block, len(own)), np.float32)
            matrix[example[posts] % how.block, place[entry[posts]]] = weight[posts]
            self.matrix.append(matrix)
        # the others: postings by term
        few = ~full[entry]
        self.example, self.weight = example[few].astype(np.int32), weight[few]
        self.first = np.searchsorted(term[few], np.arange(len(self.idf) + 1)).astype(np.int32)

    def _alike(self, example: np.ndarray, term: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
        """An order of the examples: by the nearest of some leaders, one for each block."""
        leaders = np.linspace(0, n - 1, self.n_blocks).astype(np.int64)
        number = np.full(n, -1)
        number[leaders] = np.arange(len(leaders))
        chosen = number[example] >= 0
        scores = np.zeros((len(leaders), n), np.float32)
        for queries, found in self.scored(number[example[chosen]], term[chosen], self.weights(term[chosen], count[chosen]), len(leaders), whole=True):
            scores[queries] = found[:, :n]
        nearest = scores.argmax(axis=0)
        return np.lexsort([np.arange(n), -scores[nearest, np.arange(n)], nearest])

    def weights(self, term: np.ndarray, count: np.ndarray) -> np.ndarray:
        return (1 + np.log(count)) * self.idf[term]

    def scored(self, text: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int, without: np.ndarray | None = None, whole: bool = False) -> Iterator[tuple[slice, np.ndarray]]:
        """Some queries after others, with their cosines to all examples; -1 for blocks that can't hold one of the k nearest, unless ``whole``, and for the example ``without``."""
        weight = _normal(text, weight, n)
        starts = np.searchsorted(text, np.arange(n + 1))
        at = 0
        while at < n:
            to = max(at + 1, int(np.searchsorted(starts, starts[at] + self.how.batch, side="right")) - 1)
            part = slice(starts[at], starts[to])
            yield slice(at, to), self._score(text[part] - at, term[part], weight[part], to - at, None if without is None else without[at:to], whole)
            at = to

    def _score(self, text: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int, without: np.ndarray | None, whole: bool) -> np.ndarray:
        size, blocks = self.how.block, self.n_blocks
        column = self.column[term]
        often = column >= 0
        q = np.zeros((self.most.shape[0], n), np.float32)
        q[column[often], text[often]] = weight[often]
        begin, end = self.first[term], self.first[term + 1]
        some = end > begin
        begin, end = begin[some], end[some]
        posts = _ranges(begin, end)
        cells = np.repeat(text[some].astype(np.int32) * np.int32(blocks * size), end - begin)
        cells += self.example[posts]
        products = np.repeat(weight[some], end - begin)
        products *= self.weight[posts]
        listed = np.bincount(cells, products, n * blocks * size).astype(np.float32).reshape(n, blocks, size)
        bounds = (self.most.T @ q).T + listed.max(axis=2)
        scores = np.full((n, blocks, size), -1, np.float32)

        def score(chosen: np.ndarray) -> None:
            for b in np.flatnonzero(chosen.any(axis=0)):
                texts_ = np.flatnonzero(chosen[:, b])
                mine = q[self.rows[b]]
                scores[texts_, b] = (self.matrix[b] @ (mine if len(texts_) == n else mine[:, texts_])).T + listed[texts_, b]
            flat = scores.reshape(n, -1)
            flat[:, len(self.labels) :] = -1
            if without is not None:
                flat[np.arange(n), without] = -1

        chosen = np.ones((n, blocks), bool)
        if not whole and blocks > self.how.first:
            chosen[:] = False
            np.put_along_axis(chosen, np.argpartition(-bounds, self.how.first - 1, axis=1)[:, : self.how.first], True, axis=1)
            score(chosen)
            flat = scores.reshape(n, -1)
            k = min(self.how.k, flat.shape[1])
            kth = np.partition(flat, flat.shape[1] - k, axis=1)[:, flat.shape[1] - k]
            chosen = ~chosen & (bounds * (1 + 1e-5) + 1e-6 >= kth[:, None]) & (bounds > 0)
        score(chosen)
        return scores.reshape(n, -1)

    def nearest(self, text: np.ndarray, term: np.ndarray, count: np.ndarray, n: int, without: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """For n texts, by text: the k nearest examples and their cosines to each text's known part; cosine -1: none."""
        k = min(self.how.k, len(self.labels))
        top, cosines = np.zeros((n, k), np.int64), np.full((n, k), -1.0)
        for rows, scores in self.scored(text, term, self.weights(term, count), n, without):
            width = scores.shape[1]
            keys = np.rint(scores * 1e6).astype(np.int64) * width + np.arange(width - 1, -1, -1)  # ties go to the example first in the index
            best = np.partition(keys, width - k, axis=1)[:, width - k :]
            best = -np.sort(-best, axis=1)
            top[rows], cosines[rows] = width - 1 - best % width, (best // width) / 1e6
        return top, cosines

    def votes(self, top: np.ndarray, cosines: np.ndarray) -> np.ndarray:
        w = np.where(cosines < 0, 0, np.exp((cosines - cosines.max(axis=1, keepdims=True)) / self.how.width))
        return (w * self.labels[top]).sum(axis=1) / np.maximum(w.sum(axis=1), 1e-12)


def logistic(x: np.ndarray, y: np.ndarray, mass: np.ndarray) -> tuple[float, float]:
    """Slope and intercept by Newton steps, with a little shrinkage of the slope."""
    a = b = 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g, h = mass * (p - y), np.maximum(mass * p * (1 - p), 1e-12)
        ga, gb = g @ x + 1e-2 * a, g.sum()
        haa, hab, hbb = h @ (x * x) + 1e-2, h @ x, h.sum() + 1e-9
        d = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / d, (haa * gb - hab * ga) / d
        a, b = a - da, b - db
        if abs(da) + abs(db) < 1e-9:
            break
    return a, b


def _term_counts(terms, how: Nearest):
    """t, df, m, a: texts with term t, labelled ones among them, those of label 1. t = -1 has the counts of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = restored(Terms, terms.value, how)
        counts, all_ = np.zeros((3, len(known)), np.int64), np.zeros(3, np.int64)
        for batch in small_batches(batches):
            label = np.asarray(pc.fill_null(batch.column("label").cast(pa.int32()), -1))
            text, term, _ = known.count(*word_counts(batch.column("text")))
            for i, least in enumerate((-1, 0, 1)):
                counts[i] += np.bincount(term[label[text] >= least], minlength=len(known))
                all_[i] += (label >= least).sum()
        at = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), *(pa.array(np.append(counts[i, at], all_[i])) for i in range(3))], ["t", "df", "m", "a"])

    return run


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches):
        text, code, counts, words = word_counts(batch.column("text"))
        starts = pa.array(np.searchsorted(text, np.arange(len(batch) + 1)), pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("label").cast(pa.int32()), pa.ListArray.from_arrays(starts, words.cast(pa.string()).take(pa.array(code))), pa.ListArray.from_arrays(starts, pa.array(counts, pa.int32()))], ["doc_id", "label", "words", "counts"])


def fit(docs: DataFrame, labels: DataFrame, how: Nearest = Nearest()) -> tuple[Terms | None, Index | None, float]:
    """The terms and the index of the examples, and the share of label 1."""
    sc = docs.sparkSession.sparkContext
    ids = labels.filter(F.col("toxic").isin(0, 1)).select("doc_id", "toxic").filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("label"))
    n_of = {r["label"]: r["count"] for r in ids.groupBy("label").count().collect()}
    share = n_of.get(1, 0) / max(1, sum(n_of.values()))
    chosen = F.broadcast(sampled(ids, "label", how.per_class))  # about 2 * per_class rows
    got = docs.select("doc_id", "text").join(chosen, "doc_id").select("doc_id", "label", "text").mapInArrow(_examples, "doc_id long, label int, words array<string>, counts array<int>").toArrow()
    got = got.take(pc.sort_indices(got, [("doc_id", "ascending"), ("label", "ascending")])).combine_chunks()
    label, doc = np.asarray(got["label"]), np.asarray(got["doc_id"])
    one = np.flatnonzero(np.diff(doc, prepend=doc[0] - 1 if len(doc) else 0))  # one row of each doc_id: that of the least words
    if len(one) < len(doc):
        rows = got.to_pylist()
        best: dict[int, int] = {}
        for i in sorted(range(len(rows)), key=lambda i: (sorted(zip(rows[i]["words"], rows[i]["counts"], strict=True)), i)):
            best.setdefault(rows[i]["doc_id"], i)
        got = got.take(pa.array(sorted(best.values()))).combine_chunks()
        label, doc = np.asarray(got["label"]), np.asarray(got["doc_id"])
    if len(set(label.tolist())) < 2:
        return None, None, share
    lists, counts = got["words"].combine_chunks(), got["counts"].combine_chunks()
    text = np.repeat(np.arange(len(doc)), np.asarray(pc.list_value_length(lists)))
    coded = pc.dictionary_encode(lists.flatten())
    terms = Terms(coded.dictionary, how)
    example, term, count = terms.count(text, np.asarray(coded.indices, dtype=np.int64), np.asarray(counts.flatten(), dtype=np.int64), coded.dictionary)
    example, term, count = example.astype(np.int32), term.astype(np.int32), count.astype(np.int32)
    del got, lists, counts, text, coded  # the driver keeps numbers alone
    release()
    with_term = np.zeros(len(doc), bool)
    with_term[example] = True
    y = label[with_term]
    if not len(y):
        return None, None, share
    known = docs.select("doc_id", "text").filter(~held_out(F.col("doc_id")) & F.col("text").isNotNull())
    known = known.join(ids.hint("merge"), "doc_id", "left").select("text", "label")  # both grow with the input: not broadcast
    shipped = sc.broadcast(plain(terms))
    table = known.mapInArrow(_term_counts(shipped, how), "t long, df long, m long, a long").groupBy("t").agg(F.sum("df").alias("df"), F.sum("m").alias("m"), F.sum("a").alias("a")).toArrow()  # a row for each term
    sums = np.zeros((3, len(terms) + 1))  # the last column has the counts of all texts, as t = -1
    sums[:, np.asarray(table["t"])] = [np.asarray(table[c]) for c in ("df", "m", "a")]
    (n, n_known, n_known_1), (df, m, a) = sums[:, -1], sums[:, :-1]
    idf = np.maximum(np.log((1 + n) / (1 + df)), 0) ** how.power + 1e-6
    idf *= emphasis(chi_squared(m, a, n_known, n_known_1), how)
    place = (np.cumsum(with_term) - 1).astype(np.int32)
    index = Index(idf, place[example], term, count, y, doc[with_term], how)
    back = np.argsort(index.ids).astype(np.int32)  # ids are distinct and were in order, so this is where each example is now
    example = back[place[example]]
    order = np.lexsort([term, example])
    votes = index.votes(*index.nearest(example[order], term[order], count[order], len(y), without=np.arange(len(y))))
    y = index.labels
    all_1, all_0 = (label == 1).sum(), (label == 0).sum()
    mass = np.where(y == 1, share / all_1, (1 - share) / all_0) * len(y)  # of all examples, those without a term too
    if 0 < y.sum() < len(y):
        index.a, index.b = logistic(votes, y, mass)
    else:  # no example of the other label has a term
        index.b = float(np.log(2 * len(y) + 1)) * (1 if y[0] else -1)
    none = Counter(label[~with_term].tolist())
    none_1, none_0 = share * none[1] / all_1, (1 - share) * none[0] / all_0
    index.base = none_1 / (none_1 + none_0) if none_1 + none_0 else share
    del example, term, count, order, votes
    release()
    return terms, index, share


def score_toxicity(docs: DataFrame, labels: DataFrame, how: Nearest = Nearest(), threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence (doc_ids of the nearest examples): one row for each row of ``docs``."""
    terms, index, share = fit(docs, labels, how)
    shipped = docs.sparkSession.sparkContext.broadcast((plain(terms), plain(index)) if index else None)  # its size is that of the examples
    base = index.base if index else share
    del terms, index

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, index = (restored(kind, state, how) for kind, state in zip((Terms, Index), shipped.value, strict=True)) if shipped.value else (None, None)
        for batch in small_batches(batches):
            n = len(batch)
            scores, evidence = np.full(n, base), [[]] * n
            if index:
                text, term, count = terms.count(*word_counts(batch.column("text")))
                some, text = np.unique(text, return_inverse=True)
                top, cosines = index.nearest(text, term, count, len(some))
                scores[some] = 1 / (1 + np.exp(-np.clip(index.a * index.votes(top, cosines) + index.b, -40, 40)))
                for i, ids, near in zip(some, index.ids[top[:, :5]].tolist(), (cosines[:, :5] > 0).sum(axis=1), strict=True):
                    evidence[i] = ids[: max(1, near)]
            held = [is_held_out(i) for i in batch.column("doc_id").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(held, pa.bool_()), pa.array(scores), pa.array((scores >= threshold).astype(np.int32)), pa.array(evidence, pa.list_(pa.int64()))], ["doc_id", "held_out", "score", "predicted", "evidence"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, evidence array<bigint>")
