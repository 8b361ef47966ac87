"""SentencePiece encoding and decoding by a streaming Viterbi pass (operator 9).

The model file gives pieces and scores. Positions of a text are walked once; for each, every piece that ends
there (at most the longest piece back) and joins a reachable earlier position is a step, and the position keeps
the best step as its back pointer:

* ``unigram``: best is the largest sum of scores.
* ``bpe``: a step is allowed if the pair of the earlier position's last piece and this piece is *stable*, that is
  if merging by score leaves exactly these two. A merge segmentation cut after any of its pieces is the
  segmentation of the text so far, so exactly one step survives, and back pointers give the merge result.

Only the last ``longest piece`` positions can be stepped from, so only these are kept. When all their back
pointers lead through one boundary, the pieces up to it can no longer change: their ids are committed and the
positions before it dropped. The window stays bounded by the longest piece plus the stretch since the last
common boundary, whatever the text's length.

A character that no piece holds is a piece of its own, written as its UTF-8 bytes. Pieces never hold a space mark
after another character (checked when the model is read), so a space run with the word after it is a
stretch that starts and ends at common boundaries; the ids of recent stretches are remembered, a bounded number.

Defined results: a null or empty text has no ids. Rows that repeat give a row each. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyloom.llm.arrow import Remembered, column, joined_ids, slices, text_column

SPACE = "▁"
#: Stretches and pairs of pieces that a Python worker remembers (of each, in two generations).
CACHE_STRETCHES, CACHE_PAIRS = 600_000, 600_000
#: Text bytes whose words are looked up at once.
TEXT_BYTES = 8 << 20


class Pieces:
    """The tables of a model and the two directions of coding."""

    def __init__(self, path: str, kind: str = "bpe"):
        from sentencepiece import SentencePieceProcessor
        sp = SentencePieceProcessor(model_file=path)
        self.kind = kind
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)
                   for i in range(sp.get_piece_size())]
        self.text = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.byte = {int(p[3:5], 16): i for i, p in enumerate(self.text) if sp.is_byte(i)}
        self.id = {p: i for i, p in enumerate(self.text) if not special[i]}
        self.score = {p: sp.get_score(i) for p, i in self.id.items()}
        self.longest = max(map(len, self.id), default=1)
        self.low = min(self.score.values(), default=0.0) - 10.0
        if any(SPACE in p.lstrip(SPACE) for p in self.id):
            raise ValueError("a piece has a space mark after another character")
        self.raw = {i: b for b, i in self.byte.items()}
        self.unknown = sp.unk_id()
        self.ends = {p[k:] for p in self.id for k in range(len(p))}  # what a piece may end with
        self.whole: dict[str, bool] = {}
        self.stable: dict[tuple[str, str], bool] = {}
        self.known = Remembered(CACHE_STRETCHES)
        self.odd: set[str] = set()  # stretches that don't decode to themselves (none if bytes are pieces)

    # -- pairs -----------------------------------------------------------------

    def _merged(self, text: str) -> list[str]:
        """Merging by score, leftmost first among equals (only for texts of two pieces)."""
        part = list(text)
        while len(part) > 1:
            best = max(((self.score[a + b], -k) for k, (a, b) in enumerate(zip(part, part[1:]))
                        if a + b in self.score), default=None)
            if best is None:
                break
            k = -best[1]
            part[k:k + 2] = [part[k] + part[k + 1]]
        return part

    def _joins(self, a: str, b: str) -> bool:
        """May piece ``b`` follow piece ``a``?"""
        if self.kind != "bpe":
            return True
        got = self.stable.get((a, b))
        return self._follows(a, b) if got is None else got

    def _whole(self, b: str) -> bool:
        """Is piece ``b`` what merging makes of its own characters?"""
        if self.kind != "bpe" or len(b) == 1:
            return True
        got = self.whole.get(b)
        if got is None:
            got = self.whole[b] = self._merged(b) == [b]
        return got

    # -- encoding --------------------------------------------------------------

    def segments(self, chars: Iterator[str]) -> Iterator[str]:
        """Pieces of a stream of characters, each as soon as it is certain."""
        tail = ""                      # characters since the last commit
        last: list[str | None] = [""]  # best piece that ends at each position of tail; [0] is the boundary
        total: list[float] = [0.0]
        for c in chars:
            tail += c
            i = len(tail)
            best, best_score = None, 0.0
            reach = i - 1  # the longest text before here that a piece may end with
            while reach > 0 and i - reach < self.longest and tail[reach - 1:] in self.ends:
                reach -= 1
            for at in range(reach, i):
                piece = tail[at:]
                score = self.score.get(piece)
                if score is None:
                    if at < i - 1:
                        continue
                    score = self.low
                before = last[at]
                if before is None or not self._joins(before, piece):
                    continue
                score += total[at]
                if best is None or score > best_score:
                    best, best_score = piece, score
                if self.kind == "bpe":
                    break
            last.append(best)
            total.append(best_score)
            if i >= 2 * self.longest or c not in self.score:
                done, tail, last, total = self._commit(tail, last, total, c not in self.score)
                yield from done
        yield from self._back(last, len(tail))

    def _back(self, last: list, end: int, start: int = 0) -> list[str]:
        out = []
        while end > start:
            out.append(last[end])
            end -= len(last[end])
        return out[::-1]

    def _commit(self, tail: str, last: list, total: list, cut: bool):
        """Commit up to the last boundary that all positions that can still be stepped from share."""
        end = len(tail)
        if cut:  # nothing joins across an unknown character
            at = end
        else:
            heads = {p for p in range(max(0, end - self.longest + 1), end + 1) if last[p] is not None}
            while len(heads) > 1:
                p = max(heads)
                heads.remove(p)
                heads.add(p - len(last[p]))
            at = heads.pop()
        if not at:
            return [], tail, last, total
        # the last committed piece stays as what a following piece must join
        return (self._back(last, at), tail[at:], [last[at] if not cut else "", *last[at + 1:]],
                [0.0, *[t - total[at] for t in total[at + 1:]]])

    def _ids(self, piece: str) -> list[int]:
        i = self.id.get(piece)
        if i is not None:
            return [i]
        return [self.byte[b] for b in piece.encode()] if self.byte else [self.unknown]

    def _follows(self, a: str, b: str) -> bool:
        """May piece ``b`` follow ``a`` (or begin, after the empty piece), remembered."""
        if len(self.stable) > CACHE_PAIRS:
            self.stable.clear()
        got = self.stable[a, b] = self._whole(b) and (not a or self._merged(a + b) == [a, b])
        return got

    def _merge_pass(self, s: str) -> list[str]:
        """The pass of ``segments`` for merges, over a stretch that fits the window."""
        score, ends, stable = self.score, self.ends, self.stable
        last: list[str | None] = [""]
        for i in range(1, len(s) + 1):
            at = i - 1
            while at and s[at - 1:i] in ends:
                at -= 1
            best = None
            while at < i:
                piece = s[at:i]
                if piece in score or at == i - 1:
                    before = last[at]
                    if before is not None:
                        ok = stable.get((before, piece))
                        if ok or ok is None and self._follows(before, piece):
                            best = piece
                            break
                at += 1
            last.append(best)
        return self._back(last, len(s))

    def _stretch(self, s: str) -> bytes:
        short = self.kind == "bpe" and len(s) <= 2 * self.longest
        pieces = self._merge_pass(s) if short else self.segments(iter(s))
        ids = [i for p in pieces for i in self._ids(p)]
        if self._text(ids) != s.replace(SPACE, " "):
            self.odd.add(s)
        return np.array(ids, "<u4").tobytes()

    def encode(self, text: str) -> list[int]:
        """The ids of one text."""
        if not text:
            return []
        found = STRETCH.findall(SPACE + text.replace(" ", SPACE))
        return np.frombuffer(b"".join(self.stretches(found)), "<u4").tolist()

    def stretches(self, found: list[str]) -> list[bytes]:
        """The ids of stretches, as little-endian 32-bit integers."""
        out, new = self.known.look_up(found)
        for i in new:
            out[i] = self.known.young[found[i]] = self._stretch(found[i])
        return out

    def encode_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of many texts one after another, where each text begins (one more entry), and whether
        its stretches decode to themselves. A text's words are coded once per distinct word; runs of
        spaces, which belong to the next word, are put before it first."""
        n = len(texts)
        if pc.any(pc.match_substring(texts, SPACE)).as_py():  # texts with the mark itself: one by one
            each = [self.encode(t) for t in texts.to_pylist()]
            ids = np.array([i for e in each for i in e], "<u4")
            same = np.array([self.decode(e) == t for e, t in zip(each, texts.to_pylist())])
            return ids, np.concatenate(([0], np.cumsum([len(e) for e in each]))), same
        parts = pc.split_pattern(texts, " ")
        flat, offsets = parts.flatten(), np.asarray(parts.offsets, np.int64)
        empty = np.asarray(pc.equal(pc.binary_length(flat), 0))
        offsets = offsets - offsets[0]
        if empty.any():
            blank = np.asarray(pc.equal(pc.binary_length(texts), 0))
            words, offsets = self._runs_joined(flat, empty, offsets, blank)
        else:
            words = pc.binary_join_element_wise(pa.scalar(SPACE, flat.type), flat, pa.scalar("", flat.type))
        if not len(words):
            return np.empty(0, "<u4"), np.zeros(n + 1, np.int64), np.ones(n, bool)
        coded = pc.dictionary_encode(words)
        names = coded.dictionary.to_pylist()
        own = self.stretches(names)
        seq = np.asarray(coded.indices)
        ids, total = joined_ids(own, seq)
        same = np.array([w not in self.odd for w in names])
        wrong = np.concatenate(([0], np.cumsum(~same[seq])))
        return ids, total[offsets], np.diff(wrong[offsets]) == 0

    @staticmethod
    def _runs_joined(flat: pa.Array, empty: np.ndarray, offsets: np.ndarray,
                     blank: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """Words with all the space marks before them; a text's last empty words are a run of marks, and
        an empty text has no word."""
        first = np.repeat(offsets[:-1], np.diff(offsets))
        last = np.zeros(len(flat), bool)
        last[offsets[1:] - 1] = True
        keep = (~empty | last) & ~np.repeat(blank, np.diff(offsets))
        kept = np.flatnonzero(keep)
        before = np.concatenate(([-1], kept[:-1]))
        marks = kept - np.maximum(before, first[kept] - 1)  # one, and one for each empty word in between
        words = pc.binary_join_element_wise(pc.binary_repeat(pa.scalar(SPACE, flat.type), pa.array(marks)),
                                            flat.take(pa.array(kept)), pa.scalar("", flat.type))
        count = np.concatenate(([0], np.cumsum(keep)))
        return words, count[offsets]

    # -- decoding --------------------------------------------------------------

    def _text(self, ids: list[int]) -> str:
        out, raw = [], bytearray()
        for i in ids:
            b = self.raw.get(i)
            if b is not None:
                raw.append(b)
                continue
            if raw:
                out.append(raw.decode(errors="replace"))
                raw.clear()
            out.append(self.text[i])
        out.append(raw.decode(errors="replace"))
        return "".join(out).replace(SPACE, " ")

    def decode(self, ids: list[int]) -> str:
        """Text of a list of ids; bytes that are not UTF-8 become U+FFFD."""
        text = self._text(ids)
        return text[1:] if text.startswith(" ") else text


STRETCH = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_LOADED: dict[tuple[str, str], Pieces] = {}


def pieces(path: str, kind: str) -> Pieces:
    if (path, kind) not in _LOADED:
        _LOADED.clear()
        _LOADED[path, kind] = Pieces(path, kind)
    return _LOADED[path, kind]


def encode(docs: DataFrame, path: str, kind: str = "bpe") -> DataFrame:
    """``(doc_id, ids)`` of each row of ``docs(doc_id, text)``; ``path``: a file on every executor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path, kind)
        for batch in batches:
            for part in slices(batch, "text", TEXT_BYTES):
                ids, begin, _ = model.encode_texts(text_column(part, "text"))
                yield pa.RecordBatch.from_arrays(
                    [column(part, "doc_id").cast(pa.int64()),
                     pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(ids.view(np.int32)))],
                    ["doc_id", "ids"])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, ids array<int>")


def decode(rows: DataFrame, path: str, kind: str = "bpe") -> DataFrame:
    """``(doc_id, text)`` of each row of ``rows(doc_id, ids)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path, kind)
        for batch in batches:
            texts = [model.decode(ids or []) for ids in column(batch, "ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])
    return rows.mapInArrow(run, "doc_id long, text string")


def coded_digest(docs: DataFrame, path: str, kind: str = "bpe") -> DataFrame:
    """``(doc_id, n_tokens, ids_crc32, round_trip)``: ids as little-endian unsigned 32-bit integers, and whether
    decoding gives the text back, tested on its distinct stretches (no byte run crosses their ends)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path, kind)
        for batch in batches:
            for part in slices(batch, "text", TEXT_BYTES):
                ids, begin, same = model.encode_texts(text_column(part, "text"))
                raw, at = memoryview(np.ascontiguousarray(ids)).cast("B"), (4 * begin).tolist()
                crc = [zlib.crc32(raw[a:b]) for a, b in zip(at, at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [column(part, "doc_id").cast(pa.int64()), pa.array(np.diff(begin)), pa.array(crc, pa.int64()),
                     pa.array(same)], ["doc_id", "n_tokens", "ids_crc32", "round_trip"])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long, round_trip boolean")
