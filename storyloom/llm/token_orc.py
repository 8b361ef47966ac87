"""Token ids in ORC files (operator 6).

Documents are dealt out by ranges of their id, sorted, encoded and written as ORC: integer columns
are run-length encoded (RLE v2), each stripe has row indexes every ``ROW_INDEX_STRIDE`` rows, and
the document id has a Bloom filter, so a read of a few ids skips stripes by their statistics and
row groups by filter, and different stripes of one file are read by different tasks.

A row holds ``doc_id``, ``ids`` (with the end id), ``n_tokens``, ``part`` (number of the id range)
and ``at`` (ids before it in its range). Where a document starts in the whole corpus is ``at`` plus
the tokens of all earlier ranges: a sum over as many numbers as there are files, read from the
``n_tokens`` column alone.

Encoding works by distinct words: the tokenizer (lower case, white space dropped) never joins
characters across ASCII white space, so a word's ids don't depend on its neighbours. Each distinct
word of a slice is encoded once, and a worker remembers a bounded number of words. Plain words are
encoded many at a time and cut where a run's last id is; all others one by one.

Defined results: a null or empty text is the end id alone. Rows that repeat an id follow one
another, ordered by text; a null id comes first. Other columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.llm.arrow import Remembered, column, joined_ids, slices, text_column, words

END_ID = 2
ROW_INDEX_STRIDE = 1000
STRIPE_BYTES = 32 << 20
#: Words whose ids a Python worker remembers, in each of two generations.
CACHE_WORDS = 450_000
#: Words that are certain to be one run of letters, and one of marks at most, to the tokenizer:
#: Latin letters whose lower case is one letter again.
PLAIN = "^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+[.,;:!?]*$"
JOINED = 1000
#: Text bytes whose words are looked up at once.
TEXT_BYTES = 8 << 20


class Words:
    """The ids of single words, as little-endian 32-bit integers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.ends = np.zeros(self.tok.get_vocab_size(), bool)  # ids that close a run of letters or marks
        for piece, i in self.tok.get_vocab().items():
            self.ends[i] = piece.endswith("</w>")
        self.known = Remembered(CACHE_WORDS)

    def _joined(self, words: list[str], runs: np.ndarray) -> list[bytes]:
        """Plain words, encoded as texts of many words and cut at the runs' ends."""
        out: list[bytes] = []
        for k in range(0, len(words), JOINED):
            own = slice(k, k + JOINED)
            (e,) = self.tok.encode_batch_fast([" ".join(words[own])], add_special_tokens=False)
            ids = np.array(e.ids, "<u4")
            close = np.flatnonzero(self.ends[ids]) + 1
            last = np.cumsum(runs[own])
            if not len(last) or last[-1] != len(close) or close[-1] != len(ids):
                out += self._single(words[own])
                continue
            cut = (close[last - 1] * 4).tolist()
            raw = ids.tobytes()
            out += [raw[a:b] for a, b in zip([0, *cut], cut)]
        return out

    def _single(self, words: list[str]) -> list[bytes]:
        out = []
        for k in range(0, len(words), 2000):
            out += [np.array(e.ids, "<u4").tobytes()
                    for e in self.tok.encode_batch_fast(words[k:k + 2000], add_special_tokens=False)]
        return out

    def ids(self, distinct: pa.Array) -> list[bytes]:
        words = distinct.to_pylist()
        out, new = self.known.look_up(words)
        young = self.known.young
        if new:
            part = distinct.take(pa.array(new))
            plain = np.asarray(pc.match_substring_regex(part, PLAIN))
            marks = np.asarray(pc.match_substring_regex(part, "[.,;:!?]$"))
            for which, code in ((plain, lambda i, w: self._joined(w, 1 + marks[i])), (~plain, lambda i, w: self._single(w))):
                at = np.flatnonzero(which)
                own = [words[new[i]] for i in at.tolist()]
                for i, w, x in zip(at.tolist(), own, code(at, own)):
                    out[new[i]] = young[w] = x
        return out


_LOADED: dict[str, Words] = {}


def _words_of(path: str) -> Words:
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core
        _LOADED.clear()
        _LOADED[path] = Words(path)
    return _LOADED[path]


def encode_texts(texts: pa.Array, path: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts one after another, each text closed by ``end_id``, and where each
    begins (one more entry than texts)."""
    flat, begin = words(texts, lower=False)
    n = len(texts)
    if not len(flat):
        return np.full(n, end_id, "<u4"), np.arange(n + 1)
    coded = pc.dictionary_encode(flat)
    own = _words_of(path).ids(coded.dictionary)
    own.append(np.array([end_id], "<u4").tobytes())
    # the sequence of words, with the end after each text
    seq = np.insert(np.asarray(coded.indices), begin[1:], len(own) - 1)
    ids, total = joined_ids(own, seq)
    return ids, np.concatenate(([0], total[begin[1:] + np.arange(1, n + 1)]))


STORED = "part int, at long, doc_id long, n_tokens long, ids array<int>"


def _encode(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part_number, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in slices(batch, "text", TEXT_BYTES):
                ids, begin = encode_texts(text_column(part, "text"), path, end_id)
                n = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, part_number, np.int32)), pa.array(at + begin[:-1]),
                     column(part, "doc_id").cast(pa.int64()), pa.array(np.diff(begin)),
                     pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)),
                                              pa.array(ids.view(np.int32)))],
                    ["part", "at", "doc_id", "n_tokens", "ids"])
                at += int(begin[-1])
    return run


def write_tokens(docs: DataFrame, out: str, tokenizer_path: str, end_id: int = END_ID) -> None:
    """Encode ``docs(doc_id, text)`` into ORC files under ``out``, in ascending order of id.
    ``tokenizer_path`` is a file that every executor has."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .repartitionByRange(F.col("doc_id")).sortWithinPartitions("doc_id", "text")
    (rows.mapInArrow(_encode(tokenizer_path, end_id), STORED).write.mode("overwrite")
     .option("compression", "zstd")
     .option("orc.create.index", "true").option("orc.row.index.stride", str(ROW_INDEX_STRIDE))
     .option("orc.stripe.size", str(STRIPE_BYTES))
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01").orc(out))


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """Rows of the files; ``doc_ids`` is pushed down to stripe statistics and Bloom filters."""
    rows = spark.read.schema(STORED).orc(path)
    return rows if doc_ids is None else rows.where(F.col("doc_id").isin(doc_ids))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = column(batch, "ids")
        raw = np.asarray(ids.values).astype("<i4", copy=False)
        begin = np.asarray(ids.offsets).tolist()
        view = memoryview(np.ascontiguousarray(raw)).cast("B")
        crc = [zlib.crc32(view[4 * a:4 * b]) for a, b in zip(begin, begin[1:])]
        yield pa.RecordBatch.from_arrays(
            [column(batch, "part"), column(batch, "at"), column(batch, "doc_id"),
             pa.array(np.diff(begin), pa.int64()), pa.array(crc, pa.int64())],
            ["part", "at", "doc_id", "n_tokens", "ids_crc32"])


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of each stored document."""
    rows = read_tokens(spark, path)
    per_part = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    # one row a file: a running total needs no more than the list of files
    total = per_part.selectExpr("part", "coalesce(sum(n) over (order by part rows between "
                                "unbounded preceding and 1 preceding), 0) as base")
    found = rows.mapInArrow(_digest, "part int, at long, doc_id long, n_tokens long, ids_crc32 long")
    return found.join(total, "part").select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
