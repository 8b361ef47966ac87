"""Codes against plain integer k-means; bounds against all distances; odd rows."""

import hashlib
import math

import numpy as np
import pytest

from storyloom.llm import pivot_codes
from storyloom.llm.pivot_codes import choose_pivots, compress, nearest_entry

SCHEMA = "code string, vec_id long, embedding array<float>, label int, x int"


def frame(spark, rows):
    return spark.createDataFrame([("c", i, v and [c if c is None else float(c) for c in v], lab, 0) for i, v, lab in rows], SCHEMA)


def plain(rows, parts=8, entries=16, rounds=6):
    """k-means in Python integers."""
    kept = [(i, [float(np.float32(c)) for c in v], lab) for i, v, lab in rows
            if v and len(v) % parts == 0 and all(c is not None and math.isfinite(c) for c in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    dim = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == dim]
    w = dim // parts
    most = pivot_codes.limit(dim)
    xs = [[[math.floor(max(-most, min(most, 4096 * c))) for c in v[p * w:(p + 1) * w]] for p in range(parts)] for _, v, _ in kept]
    books = [[x[p] for x in xs[:entries]] for p in range(parts)]

    def assign(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            mine = {}
            for x in xs:
                mine.setdefault(assign(x[p], books[p])[1], []).append(x[p])
            books[p] = [[sum(c) // len(mine[k]) for c in zip(*mine[k])] if k in mine else e for k, e in enumerate(books[p])]
    got = [[assign(x[p], books[p]) for p in range(parts)] for x in xs]
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    errors = [sum(d for d, _ in g) for g in got]
    total = {}
    for (_, _, lab), e in zip(kept, errors):
        total[lab] = total.get(lab, 0) + e
    return sorted(((i, "".join(f"{k:02x}" for _, k in g), e, total[lab], sha)
                   for (i, _, lab), g, e in zip(kept, got, errors)), key=str)


def result(df):
    assert df.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def odd_rows():
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=16).tolist(), i % 5) for i in range(20, 300)]
    rows += [(i, rng.integers(-2, 3, 16).astype(float).tolist(), None) for i in range(300, 420)]  # ties
    rows += [(500, rows[3][1], 7)] * 30  # repeated rows
    rows += [(5, [1.0] * 16, 1), (6, [1.0] * 16, 1), (7, None, 1), (8, [1.0] * 15 + [None], 1), (9, [float("nan")] * 16, 2),
             (10, [float("inf")] * 16, 2), (11, [], 2), (12, [1.0] * 8, 2), (13, [1.0] * 5, 2), (None, [0.5] * 16, 3),
             (14, [3e38] * 8 + [-3e38] * 8, 3), (14, [1e-40] * 16, 3), (15, [0.0] * 16, 3)]
    return rows


@pytest.mark.parametrize("most", [0, 1000])
def test_equals_plain_integer_k_means(spark, monkeypatch, most):
    monkeypatch.setattr(pivot_codes, "BROADCAST_LABELS", most)
    rows = odd_rows()
    assert result(compress(frame(spark, rows))) == plain(rows)


def test_other_sizes_and_few_rows(spark):
    rows = odd_rows()
    assert result(compress(frame(spark, rows), parts=2, entries=5, rounds=3)) == plain(rows, 2, 5, 3)
    few = [(1, [0.5] * 16, None), (2, [0.5] * 16, None), (3, [-0.5] * 16, 1)]
    assert result(compress(frame(spark, few))) == plain(few)


def test_no_rows(spark):
    assert result(compress(frame(spark, []))) == []
    assert result(compress(frame(spark, [(1, None, 1)]))) == []


def test_bounds_spare_distances_and_miss_none():
    rng = np.random.default_rng(4)
    centres = rng.integers(-4000, 4000, (16, 8))
    x = centres[rng.integers(0, 16, 5000)] + rng.integers(-300, 300, (5000, 8))
    pivots = choose_pivots(centres, pivot_codes.PIVOTS)
    far = np.sqrt(((x[:, None, :] - pivots[None]).astype(float) ** 2).sum(axis=2))
    which, best, computed = nearest_entry(x, far, pivots, centres)
    every = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2)
    assert (which == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()
    assert computed < 0.25 * every.size
