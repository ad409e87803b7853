"""Token ids in Parquet: encode, write in document order, read back selectively.

Files hold ``doc_id``, ``n_tokens`` and the list column ``ids``, in ascending doc_id order over
and within files. Ids are dictionary encoded, the other columns delta encoded where a dictionary
doesn't pay (format version 2); row groups and pages are bounded, and page indexes let a reader
of some documents, or of the metadata alone, skip the rest.

The tokenizer drops white space and never joins over it, so a text's ids are those of its words
between ASCII white space, one after the other; a worker keeps the ids of a bounded number of words.

Defined cases: a null or empty text has the end id alone. Repeated rows are encoded each; among
equal doc_ids a hash of the text decides; null ids come first. Other columns are ignored; an empty
table gives empty files and an empty result.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm._common import shared_dir, small_batches, texts, worker_cache


@dataclass(frozen=True)
class Store:
    """end: the id after each document. cache_words: words a worker keeps the ids of. The rest bounds row groups, pages and dictionaries, in bytes or rows."""

    tokenizer: str = "word_bpe_49k.json"
    end: int = 2
    cache_words: int = 400_000
    row_group: int = 32 << 20
    page: int = 256 << 10
    page_rows: int = 1000
    dictionary: int = 1 << 20


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return name if "/" in name else public_tokenizers.path(name)


#: Words of letters alone, and of letters and one mark: the tokenizer splits these into one and two pieces.
_LETTERS = r"[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}]+"
_MARKED = _LETTERS + "[.,;:!?]"


class WordEncoder:
    """Ids of texts through a table of the first ``most`` distinct words met; the others of a batch are encoded with it."""

    def __init__(self, path: str, most: int):
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.forget(pa.string())

    def forget(self, kind: pa.DataType) -> None:
        self.words, self.flat, self.begins, self.lengths = pa.array([], kind), np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int32)

    def one_by_one(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words, and how many each has."""
        flat, lengths = array("i"), []
        for begin in range(0, len(words), 4096):
            for e in self.tokenizer.encode_batch_fast(words[begin : begin + 4096], add_special_tokens=False):
                ids = e.ids
                flat.extend(ids)
                lengths.append(len(ids))
        return np.array(flat, np.int32), np.array(lengths, dtype=np.int32)

    def together(self, words: list[str], pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of known numbers of pieces, as texts of many words. A piece's last id ends a word for the tokenizer."""
        if not words:
            return np.zeros(0, np.int32), np.zeros(0, np.int32)
        parts = []
        for begin in range(0, len(words), 8192):
            joined = [" ".join(words[i : min(i + 1024, begin + 8192)]) for i in range(begin, min(begin + 8192, len(words)), 1024)]
            parts += [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)]
        flat = np.concatenate(parts)
        ends = np.flatnonzero(self.ends[flat])
        last = np.cumsum(pieces)
        if len(ends) != last[-1]:
            return self.one_by_one(words)
        return flat, np.diff(ends[last - 1] + 1, prepend=0)

    def encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where each word's begin, and how many it has."""
        pieces = np.where(np.asarray(pc.match_substring_regex(words, f"^{_LETTERS}$")), 1, np.where(np.asarray(pc.match_substring_regex(words, f"^{_MARKED}$")), 2, 0))
        many = pieces > 0
        a, n_a = self.together(words.filter(pa.array(many)).to_pylist(), pieces[many])
        b, n_b = self.one_by_one(words.filter(pa.array(~many)).to_pylist())
        lengths, begins = np.zeros(len(words), np.int32), np.zeros(len(words), np.int32)
        lengths[many], lengths[~many] = n_a, n_b
        begins[many], begins[~many] = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b + len(a)
        return np.concatenate([a, b]), begins, lengths

    def texts(self, column: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's begin (one more at the end)."""
        lists = pc.ascii_split_whitespace(texts(column))
        offsets, words = np.asarray(lists.offsets, dtype=np.int64), lists.flatten()
        if words.type != self.words.type:
            self.forget(words.type)
        at = pc.index_in(words, value_set=self.words)
        codes = np.array(pc.fill_null(at, -1))
        new = pc.dictionary_encode(words.filter(pc.is_null(at)))
        del lists, words, at
        codes[codes < 0] = len(self.words) + np.asarray(new.indices)
        more, at_more, n_more = self.encode(new.dictionary)
        # the new words' ids, and the end word's, after those of the table
        one = np.ones(1, np.int32)
        begins, lengths = np.concatenate([self.begins, at_more + len(self.flat), one * (len(self.flat) + len(more))]), np.concatenate([self.lengths, n_more, one])
        flat = np.concatenate([self.flat, more, one * end])
        if len(self.words) < self.most:
            self.words, self.flat, self.begins, self.lengths = pa.concat_arrays([self.words, new.dictionary]), flat[:-1], begins[:-1], lengths[:-1]
        del new, more, at_more, n_more
        # the words of all texts, with the end word after each
        codes = np.insert(codes, offsets[1:] - offsets[0], len(lengths) - 1)
        n = lengths[codes]
        ends = np.cumsum(n, dtype=np.int64)
        at = np.repeat((begins[codes] - (ends - n)).astype(np.int32), n)  # a batch has few bytes, or one text: places count to 2**31
        at += np.arange(len(at), dtype=np.int32)
        out = flat[at]
        last = offsets[1:] - offsets[0] + np.arange(len(offsets) - 1)  # where each text's end word is
        return out, np.concatenate([[0], ends[last]])


def _encode(how: Store, path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are parallel already
        cache = worker_cache()
        if (key := ("tokens", path, how.cache_words)) not in cache:
            cache[key] = WordEncoder(path, how.cache_words)
        for batch in small_batches(batches):
            ids, starts = cache[key].texts(batch.column("text"), how.end)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(np.diff(starts)), pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids))], ["doc_id", "n_tokens", "ids"])

    return run


def write_tokens(docs: DataFrame, path: str, how: Store = Store()) -> None:
    rows = docs.select("doc_id", "text").repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    encoded = rows.mapInArrow(_encode(how, tokenizer_path(how.tokenizer)), "doc_id long, n_tokens long, ids array<int>")
    options = {
        "compression": "zstd", "parquet.writer.version": "v2", "parquet.enable.dictionary": "true", "parquet.dictionary.page.size": how.dictionary,
        "parquet.block.size": how.row_group, "parquet.page.size": how.page, "parquet.page.row.count.limit": how.page_rows,
    }
    encoded.write.options(**options).parquet(path)


def read_tokens(spark: SparkSession, path: str, first: int | None = None, last: int | None = None, columns: tuple[str, ...] = ("doc_id", "n_tokens", "ids")) -> DataFrame:
    """Documents of ids from ``first`` to ``last``; the filter and the columns reach the files' page indexes."""
    rows = spark.read.schema("doc_id long, n_tokens long, ids array<int>").parquet(path)
    if first is not None:
        rows = rows.filter(F.col("doc_id") >= first)
    if last is not None:
        rows = rows.filter(F.col("doc_id") <= last)
    return rows.select(*columns)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        offsets, values = np.asarray(lists.offsets), np.asarray(lists.values).astype("<u4", copy=False)
        raw = memoryview(np.ascontiguousarray(values)).cast("B")
        sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("file"), batch.column("row"), pa.array(np.diff(offsets).astype(np.int64)), pa.array(sums, pa.int64())], ["doc_id", "file", "row", "n_tokens", "ids_crc32"])


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 from the files: positions by sums over files (a row each), then within each file."""
    files = spark.read.schema("doc_id long, n_tokens long, ids array<int>").parquet(path)
    rows = files.select("doc_id", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"), "ids").mapInArrow(_sums, "doc_id long, file string, row long, n_tokens long, ids_crc32 long")
    heads = files.select("doc_id", F.col("_metadata.file_path").alias("file"), "n_tokens").groupBy("file").agg(F.sum("n_tokens").alias("words"), F.min("doc_id").alias("lowest"), F.count_if(F.col("doc_id").isNull()).alias("nulls"))
    order = Window.orderBy(F.col("nulls") == 0, F.col("lowest").asc_nulls_first(), "file").rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.select(F.col("file").alias("of"), F.coalesce(F.sum("words").over(order), F.lit(0)).alias("base"))
    rows = rows.join(heads, F.col("file") == F.col("of"))
    within = F.sum("n_tokens").over(Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, -1))
    return rows.select("doc_id", (F.col("base") + F.coalesce(within, F.lit(0))).cast("long").alias("start"), "n_tokens", "ids_crc32")


def store_tokens(docs: DataFrame, how: Store = Store(), path: str | None = None) -> DataFrame:
    """Writes the files (in the shared folder if no path is given), and reads them back."""
    import uuid

    spark = docs.sparkSession
    path = path or f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, path, how)
    return token_digest(spark, path)
