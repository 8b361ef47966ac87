"""Title similarity.

Containment is native. The sequence ratio is Python's
``difflib.SequenceMatcher``, run inside Arrow tasks on pairs of blocks of
distinct title keys. Three exact bounds come first, each rejecting most of
what is left: lengths, character multisets (one array operation for a key
against a whole block), and the longest common subsequence (the matched
characters form a common subsequence). All of them work the same way for
any length. Between them comes a bound that follows from how the matcher treats a second
argument of 200 characters or more (see :func:`block_verdicts`). The matcher is not symmetric, so both argument orders are
returned.
"""

from __future__ import annotations

import difflib

import numpy as np


def ratio_above(a: str, b: str, threshold: float) -> bool:
    """X7 for one ordered pair: ``SequenceMatcher(None, a, b).ratio() > t``."""
    return difflib.SequenceMatcher(None, a, b).ratio() > threshold


def position_masks(s: str) -> dict[str, int]:
    """Bit mask of the positions of each character of ``s``."""
    masks: dict[str, int] = {}
    for i, ch in enumerate(s):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    return masks


def lcs_length(a: str, b: str, masks: dict[str, int] | None = None) -> int:
    """Length of the longest common subsequence, bit-parallel over ``a``:
    one big-integer step per character of ``b``."""
    if not a or not b:
        return 0
    masks = position_masks(a) if masks is None else masks
    full = (1 << len(a)) - 1
    v = full
    for ch in b:
        m = masks.get(ch)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def codes(keys: list[str]) -> np.ndarray:
    """The code points of all keys, one after the other."""
    return np.frombuffer("".join(keys).encode("utf-32-le", "surrogatepass"), "<u4")


def character_counts(keys: list[str], alphabet: np.ndarray) -> np.ndarray:
    """(keys x characters) counts; ``alphabet`` has the code points in order."""
    of = np.repeat(np.arange(len(keys)), [len(k) for k in keys]) * len(alphabet)
    counts = np.bincount(of + np.searchsorted(alphabet, codes(keys)), minlength=len(keys) * len(alphabet))
    return counts.reshape(len(keys), len(alphabet)).astype(np.int32)


#: Bits of a word, and bytes that the masks of a block's keys may take; keys beyond them are compared one by one.
WORD, MASK_BYTES = 64, 64_000_000


class Packed:
    """Longest common subsequences of a key and many others at a time: the bit vectors of the others stand side by
    side in one big integer, each with a bit or more above it, where its carry ends. ``alphabet`` has the code points of all keys in order."""

    def __init__(self, keys: list[str], alphabet: np.ndarray):
        self.keys, self.column = keys, {chr(c): i for i, c in enumerate(alphabet.tolist())}
        words = np.array([len(k) // WORD + 1 for k in keys], np.int64)
        order = np.argsort(words, kind="stable")  # the shortest first, as far as the masks may go
        fits = np.cumsum(words[order]) * (len(alphabet) + 1) * 8 <= MASK_BYTES
        self.words = np.zeros(len(keys), np.int64)
        self.words[order[fits]] = words[order[fits]]
        self.begin = np.cumsum(self.words) - self.words
        mask = np.zeros((len(alphabet) + 1, int(self.words.sum()) * 8), np.uint8)
        for i in np.flatnonzero(self.words).tolist():
            at = np.arange(len(keys[i]))
            byte, bit = int(self.begin[i]) * 8 + (at >> 3), (1 << (at & 7)).astype(np.uint8)
            np.add.at(mask, (np.searchsorted(alphabet, codes([keys[i]])), byte), bit)
            np.add.at(mask[-1], byte, bit)  # all its characters
        self.masks = mask.view(np.uint64)

    def lcs(self, x: str, others: np.ndarray) -> np.ndarray:
        """The lengths for ``x`` and the keys numbered ``others``."""
        out = np.zeros(len(others), np.int64)
        words = self.words[others]
        together = words > 0
        if not together.all():
            alone = position_masks(x)
            for i in np.flatnonzero(~together).tolist():
                out[i] = lcs_length(x, self.keys[others[i]], alone)
        if together.any():
            words, begin = words[together], self.begin[others[together]]
            first = np.cumsum(words) - words
            at = np.arange(int(words.sum())) + np.repeat(begin - first, words)
            seen = list(dict.fromkeys(x))
            rows = self.masks[np.ix_([self.column[ch] for ch in seen] + [-1], at)]
            mask = {ch: int.from_bytes(row.tobytes(), "little") for ch, row in zip(seen, rows)}
            v = full = int.from_bytes(rows[-1].tobytes(), "little")
            for m in map(mask.__getitem__, x):
                if m:
                    u = v & m
                    v = ((v + u) | (v ^ u)) & full
            met = np.frombuffer((full ^ v).to_bytes(len(at) * 8, "little"), np.uint64)
            out[together] = np.add.reduceat(np.bitwise_count(met).astype(np.int64), first)
        return out


#: The matcher's rule for long second arguments: from this length on, characters that make up more than a
#: hundredth of it (and one more) start no match.
LONG = 200
#: Characters of the grams that long keys are compared by.
GRAMS = (6, 8)


def starters(counts: np.ndarray, length: np.ndarray) -> np.ndarray:
    """(keys x characters): which characters of a key can start a match if it is the second argument."""
    return (counts > 0) & ((length < LONG)[:, None] | (counts <= (length // 100 + 1)[:, None]))


class GramBits:
    """Bit sets of the hashed grams of long keys, eight bits or more for a character of a key of ``typical`` length, and how many
    grams of a key have no bit of their own."""

    def __init__(self, keys: list[str], gram: int, typical: int):
        size = 1 << max(10, min(16, (8 * typical - 1).bit_length()))
        self.words = np.zeros((len(keys), size // WORD), np.uint64)
        self.rest = np.zeros(len(keys), np.int64)
        for i, key in enumerate(keys):
            code = codes([key]).astype(np.uint64)
            n = len(code) - gram + 1
            if n < 1 or len(key) < LONG:
                continue
            mixed = np.zeros(n, np.uint64)
            for g in range(gram):
                mixed = (mixed ^ code[g:g + n]) * np.uint64(0x9E3779B97F4A7C15)
                mixed ^= mixed >> np.uint64(29)
            bit = np.unique(mixed >> np.uint64(WORD - size.bit_length() + 1))
            np.bitwise_or.at(self.words[i], (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
            self.rest[i] = n - len(bit)

    def shared(self, i: int, other: "GramBits", at: np.ndarray) -> np.ndarray:
        """At least as many as the grams, each as often as both have it, of key ``i`` and of ``other``'s keys ``at``."""
        both = np.bitwise_count(other.words[at] & self.words[i]).sum(axis=1, dtype=np.int64)
        return both + np.minimum(self.rest[i], other.rest[at])


def block_verdicts(left: list[str], right: list[str], threshold: float, same: bool):
    """``(a, b, a_later, b_later)`` for each pair a < b of a left and a right key that
    is similar in an order; ``same``: both lists are one block.

    If the second argument is long, a matching block is a run of common characters that holds one that can start a
    match, or else the common beginning of both keys. With ``n`` common characters that can start one, there are at most
    ``n + 1`` blocks. A block of ``k`` characters has ``k - g + 1`` grams of ``g`` characters, none of which another
    block has, so with ``s`` grams in common no more than ``s + (g - 1)(n + 1)`` characters can match."""
    alphabet = np.unique(np.concatenate((codes(left), codes(right))))
    length, own_length = (np.array([len(k) for k in keys], np.int64) for keys in (right, left))
    by_length = np.argsort(length, kind="stable")
    own, counts = character_counts(left, alphabet), character_counts(right, alphabet)
    first, second = starters(own, own_length), np.ascontiguousarray(starters(counts, length)[by_length].T)
    columns, ordered = np.ascontiguousarray(counts[by_length].T), length[by_length]
    bits = packed = None
    for i, x in enumerate(left):
        total = ordered + len(x)
        may = np.flatnonzero(2.0 * np.minimum(ordered, len(x)) > threshold * total)  # one run, as they are in order
        if not len(may):
            continue
        run = slice(int(may[0]), int(may[-1]) + 1)
        seen = np.flatnonzero(own[i])
        common = np.minimum(columns[seen, run], own[i, seen][:, None])
        enough = 2.0 * common.sum(axis=0, dtype=np.int32) > threshold * total[run]
        if same:
            enough &= by_length[run] > i
        at = np.flatnonzero(enough)
        if not len(at):
            continue
        common, near = common[:, at], by_length[run][at]
        need = threshold * total[run][at] / 2
        # which can be similar with y and with x as the second argument; common characters that can start a match
        y_long, x_long = length[near] >= LONG, len(x) >= LONG
        with_y, with_x = ~y_long, np.full(len(near), not x_long)
        if x_long and y_long.any():
            of_y = (common * second[seen, run][:, at]).sum(axis=0)
            of_x = common[first[i, seen]].sum(axis=0)
            with_y |= y_long
            with_x |= x_long
            if bits is None:
                typical = int(np.median(length[length >= LONG]))
                bits = [(g, GramBits(left, g, typical), GramBits(right, g, typical)) for g in GRAMS]
            for g, mine, others in bits:
                live = np.flatnonzero(y_long & (with_y | with_x))
                most = mine.shared(i, others, near[live])
                with_y[live] &= most + (g - 1) * (of_y[live] + 1) > need[live]
                with_x[live] &= most + (g - 1) * (of_x[live] + 1) > need[live]
        else:
            with_y[:] = with_x[:] = True
        live = with_y | with_x
        if not live.any():
            continue
        packed = packed or Packed(right, alphabet)
        near = near[live]
        for j in near[2.0 * packed.lcs(x, near) > threshold * (length[near] + len(x))].tolist():
            y = right[j]
            a, b = (x, y) if x < y else (y, x)
            ab, ba = ratio_above(a, b, threshold), ratio_above(b, a, threshold)
            if ab or ba:
                yield a, b, ab, ba
