"""Landmarks of a key: grams at places that any longer key around it picks as well.

Keys of ``least(level)`` characters or more, and fewer than twice as many, have a level. At a level with grams of ``g``
characters and windows of ``w`` consecutive grams, a gram is picked if its hash is the least of a window that lies in
the key. A window of an inner key is a window of every key around it, so what the inner key picks
at its own level the outer key picks there too. Of the places of random text about ``2 / (w + 1)`` are picked; widths
double from level to level, so a key picks fewer than two grams a character over all levels, however long it is.

An inner key is looked up by one landmark, the rarest by a bounded sample. Outer keys send those of theirs that some
inner key is looked up by, told by a bit set of fixed size: a wrong bit costs a row, not a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyloom.params import CONTAINMENT_MIN_LEN as SHORTEST

#: Keys (and their leading characters) whose landmarks are counted to tell common ones from rare ones, and how many are kept.
SAMPLE_KEYS, SAMPLE_CHARS, COUNTED = 4096, 4096, 65_536
#: Words of 64 bits of the bit set of landmarks that inner keys are looked up by.
WORDS = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def shape(level: int) -> tuple[int, int]:
    """Characters of a gram, grams of a window."""
    return (SHORTEST, 1) if level == 0 else (2 ** (level + 1) + 1, 2 ** (level + 1))


def least(level: int) -> int:
    """Characters of the shortest key of a level."""
    g, w = shape(level)
    return g + w - 1


def level_of(length: int) -> int:
    return 0 if length < least(1) else length.bit_length() - 3


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return (x ^ (x >> np.uint64(31))) | np.uint64(1)


class Picker:
    """Landmarks of keys, longest first."""

    def __init__(self, keys: list[str]):
        self.length = np.fromiter(map(len, keys), np.int64, len(keys))
        assert (np.diff(self.length) <= 0).all()
        self.start = np.concatenate(([0], np.cumsum(self.length)))
        code = np.frombuffer("".join(keys).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        sums = (code + np.uint64(1)) * _powers(_BASE, len(code))
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(sums, dtype=np.uint64)))
        self.back = _powers(pow(_BASE, -1, 2 ** 64), len(code))

    def at(self, level: int, first: int, last: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the keys from ``first`` up to ``last``: the number of the key, the place in it and the hash of each landmark."""
        g, w = shape(level)
        a, b = int(self.start[first]), int(self.start[last])
        n = b - a - g + 1  # grams
        if first >= last or n < w:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
        gram = (self.sums[a + g:b + 1] - self.sums[a:a + n]) * self.back[a:a + n]
        gram = _mixed(gram + np.uint64((level + 1) * _BASE % 2 ** 64))
        low = gram
        step = 1
        while step < w:
            low = np.minimum(low[:-step], low[step:])
            step *= 2
        ok = np.zeros(len(low) + 1, np.int64)  # windows that lie in one key
        inside = self.length[first:last] >= g + w - 1
        begin = self.start[first:last][inside] - a
        np.add.at(ok, begin, 1)
        np.add.at(ok, begin + self.length[first:last][inside] - (g + w - 1) + 1, -1)
        low = np.where(np.cumsum(ok)[:-1] > 0, low, np.uint64(0))
        high = np.concatenate((np.zeros(w - 1, np.uint64), low, np.zeros(w - 1, np.uint64)))
        step = 1
        while step < w:
            high = np.maximum(high[:-step], high[step:])
            step *= 2
        place = np.flatnonzero(high == gram)
        key = np.searchsorted(self.start, place + a, side="right") - 1
        return key, place + a - self.start[key], gram[place]


def _portions(batch: pa.RecordBatch, chars: int) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Rows of a batch and their keys (the third column), longest first, about ``chars`` characters at a time."""
    keys = batch.column(2).to_pylist()
    length = np.fromiter(map(len, keys), np.int64, len(keys))
    part = (np.cumsum(length) - length) // chars
    for p in np.unique(part).tolist():
        rows = np.flatnonzero(part == p)
        rows = rows[np.argsort(-length[rows], kind="stable")]
        yield rows, [keys[i] for i in rows.tolist()]


def common_landmarks(keys: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The commonest landmarks of a bounded sample of keys, in order, and their number of keys."""
    sample = (keys.where(F.length("key") >= SHORTEST).orderBy(F.xxhash64("key"), "key")
              .select(F.substring("key", 1, SAMPLE_CHARS).alias("key")).limit(SAMPLE_KEYS).collect())
    texts = sorted((r["key"] for r in sample), key=len, reverse=True)
    found = [np.empty(0, np.uint64)]
    picker = Picker(texts)
    for level in range(level_of(len(texts[0])) + 1 if texts else 0):
        key, _, mark = picker.at(level, 0, int((picker.length >= least(level)).sum()))
        if len(key):
            one = np.unique(np.rec.fromarrays((mark, key), names="mark,key"))  # once a key
            found.append(one["mark"])
    mark, n = np.unique(np.concatenate(found), return_counts=True)
    most = np.sort(np.argsort(-n, kind="stable")[:COUNTED])
    return mark[most], n[most]


def looked_up(keys: DataFrame, common, chars: int) -> DataFrame:
    """``(digest_key, kid, mark, place)``: the landmark that each key of ``(digest_key, kid, key)`` is looked up by;
    ``common``: a broadcast of ``common_landmarks``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, number = common.value
        for batch in batches:
            for rows, texts in _portions(batch, chars):
                picker = Picker(texts)
                level = np.array([level_of(n) for n in picker.length.tolist()])  # not ascending, as keys are longest first
                for v in np.unique(level).tolist():
                    own = np.flatnonzero(level == v)
                    key, place, mark = picker.at(v, int(own[0]), int(own[-1]) + 1)
                    seen = np.minimum(np.searchsorted(known, mark), max(len(known) - 1, 0))
                    often = np.where(known[seen] == mark, number[seen], 0) if len(known) else np.zeros(len(mark), np.int64)
                    order = np.lexsort((place, mark, often, key))
                    best = order[np.unique(key[order], return_index=True)[1]]
                    at = pa.array(rows[key[best]])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(at), batch.column(1).take(at), pa.array(mark[best].view(np.int64)), pa.array(place[best])],
                        ["digest_key", "kid", "mark", "place"])
    return keys.select("digest_key", "kid", "key").mapInArrow(run, "digest_key string, kid long, mark long, place long")


def bit_set(marks: DataFrame) -> np.ndarray:
    """A bit for each value of ``mark``, by its hash: ``WORDS`` words whatever the number of rows."""
    word = F.shiftrightunsigned("mark", 6).bitwiseAND(F.lit(WORDS - 1))
    rows = marks.groupBy(word.alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(mark & 63 as int)))").alias("bits")).toArrow()
    out = np.zeros(WORDS, np.int64)
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    return out.view(np.uint64)


def sent(keys: DataFrame, bits, chars: int) -> DataFrame:
    """``(digest_key, kid, mark, place)``: the landmarks at all levels of each key of ``(digest_key, kid, key)`` that
    ``bits``, a broadcast of ``bit_set``, holds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = bits.value
        for batch in batches:
            for rows, texts in _portions(batch, chars):
                picker = Picker(texts)
                for level in range(level_of(int(picker.length[0])) + 1):
                    key, place, mark = picker.at(level, 0, int((picker.length >= least(level)).sum()))
                    hit = (held[((mark >> np.uint64(6)) & np.uint64(WORDS - 1)).astype(np.int64)] >> (mark & np.uint64(63))) & np.uint64(1) > 0
                    if hit.any():
                        at = pa.array(rows[key[hit]])
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).take(at), batch.column(1).take(at), pa.array(mark[hit].view(np.int64)), pa.array(place[hit])],
                            ["digest_key", "kid", "mark", "place"])
    return keys.select("digest_key", "kid", "key").mapInArrow(run, "digest_key string, kid long, mark long, place long")
