"""Small Arrow helpers for operators that run inside Spark's Python tasks."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Text bytes worked on at once inside a task; bounds the task's arrays, not its input.
SLICE_BYTES = 2 << 20


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def text_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A text column with null read as empty, copied out of the batch: some string kernels
    misread the offsets of a sliced array."""
    own = column(batch, name).take(pa.array(np.arange(batch.num_rows)))
    return pc.fill_null(own.cast(pa.large_string()), "")


def slices(batch: pa.RecordBatch, name: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive row ranges of a batch with about ``most`` text bytes each, and a row at least."""
    size = np.asarray(pc.fill_null(pc.binary_length(column(batch, name)), 0), dtype=np.int64)
    block = (np.cumsum(size) - size) // most
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def give_back() -> None:
    """Return freed memory to the system at the end of a task: Spark uses a worker for many stages."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def words(texts: pa.Array, lower: bool) -> tuple[pa.Array, np.ndarray]:
    """Words between runs of ASCII white space (0x20, 0x09-0x0D) of each text, flat, and
    where each text's words begin (one more entry than texts). ``lower`` maps A-Z only."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    flat = parts.flatten()
    keep = np.asarray(pc.greater(pc.binary_length(flat), 0))
    kept = np.concatenate(([0], np.cumsum(keep)))
    offsets = np.asarray(parts.offsets, dtype=np.int64)
    return flat.filter(pa.array(keep)), kept[offsets - offsets[0]]


def word_hashes(flat: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word; each distinct word of the slice is hashed once."""
    coded = pc.dictionary_encode(flat)
    own = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()),
                      dtype=np.uint64, count=len(coded.dictionary))
    return own[np.asarray(coded.indices)] if len(flat) else np.empty(0, np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """Bijective finaliser, so that every bit of the result depends on every bit of ``h``."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def joined_ids(own: list[bytes], seq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids (little-endian 32-bit integers) of a sequence of words, given the ids of each distinct word,
    and where each word's ids begin (one more entry than words)."""
    size = np.fromiter(map(len, own), np.int64, len(own)) // 4
    first = np.cumsum(size) - size
    every = np.frombuffer(b"".join(own), "<u4")
    length = size[seq]
    total = np.concatenate(([0], np.cumsum(length)))
    return every[np.repeat(first[seq] - total[:-1], length) + np.arange(int(total[-1]))], total


class Remembered:
    """Values of words that a worker has seen, in two generations of bounded size: when the young one
    is full it becomes the old one, and words found in the old one move to the young one."""

    def __init__(self, most: int):
        self.most = most
        self.young: dict = {}
        self.old: dict = {}

    def look_up(self, words: list[str]) -> tuple[list, list[int]]:
        """The known values, and the positions of the words without one."""
        if len(self.young) > self.most:
            self.old, self.young = self.young, {}
        young, old, new = self.young, self.old, []
        out: list = list(map(young.get, words))
        for i in [i for i, x in enumerate(out) if x is None]:
            x = old.get(words[i])
            if x is None:
                new.append(i)
            else:
                out[i] = young[words[i]] = x
        return out, new
