"""Forest search: exact when everything is visited, recall otherwise, and odd rows."""

import numpy as np
import pytest

from storyloom.llm import ann_forest
from storyloom.llm.ann_forest import nearest

SCHEMA = "vec_id long, embedding array<float>, tree int, leaf int"


def brute(rows, queries, k):
    ok = {}
    for i, v in rows:
        if i is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v):
            ok.setdefault(i, []).append(np.array(v, np.float32).astype(float))
    out = {}
    for q in queries:
        if q in ok:
            s = sorted((-max(float((ok[q][0] * x).sum()) for x in xs), i) for i, xs in ok.items() if i != q)
            out[q] = [(i, -x) for x, i in s[:k]]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v and [c if c is None else float(c) for c in v], 0, 0) for i, v in rows], SCHEMA)


def by_query(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def test_all_visited_equals_brute_force_with_ties_blocks_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(ann_forest, "BLOCK_ROWS", 25)
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-3, 4, 6).astype(float).tolist()) for i in range(300)]
    rows += [(i, [1.0, 0, 0, 0, 0, 2.0]) for i in range(400, 520)]  # one very common vector
    rows += [(600, None), (601, [0.0] * 6), (602, [1.0, None, 0, 0, 0, 0]), (603, [float("nan")] * 6),
             (604, [float("inf")] + [0.0] * 5), (605, [1.0, 2.0]), (None, [1.0] * 6), (20, rows[20][1]), (606, [])]
    rows = [r for r in rows if r[0] != 605] + [(605, [1.0, 2.0])]
    df = frame(spark, rows)
    got = by_query(nearest(df, df.where("vec_id % 20 = 0"), k=20, visit=1e9))
    want = brute([r for r in rows if r[0] != 605], [i for i, _ in rows if i is not None and i % 20 == 0], 20)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
    for q, v in got.items():
        assert [s for _, s in v] == pytest.approx([s for _, s in want[q]], abs=1e-12)


def test_an_id_repeated_more_than_k_times_is_one_candidate(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, rng.integers(-3, 4, 6).astype(float).tolist()) for i in range(120)]
    rows += [(7, [9.0, 9.0, 9.0, 9.0, 9.0, 9.0])] * 60  # equal rows
    rows += [(8, [9.0, 9.0, 9.0, 9.0, 9.0, float(x)]) for x in range(60)]  # many vectors
    rows += [(0, rows[0][1])] * 3
    df = frame(spark, rows)
    asked = [i for i, _ in rows if i % 10 == 0 or i in (7, 8)]
    for visit, depth in ((1e9, 6), (0.0, 1)):
        got = by_query(nearest(df, df.where("vec_id % 10 = 0 or vec_id in (7, 8)"), k=20, visit=visit, depth=depth))
        assert set(got) == set(asked) and all(len({i for i, _ in v}) == len(v) == 20 for v in got.values())
        if visit:
            scores = {}
            for q in set(asked):
                for w in [np.array(v) for i, v in rows if i == q]:
                    for i, v in rows:
                        if i != q:
                            scores[q, i] = max(scores.get((q, i), -np.inf), float(w @ np.array(v)))
            for q, v in got.items():
                assert v == [(i, s) for s, i in sorted((-s, i) for (p, i), s in scores.items() if p == q)[:20]
                             for s in [-s]]


def test_recall_on_the_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = by_query(nearest(df, df.where("vec_id % 20 = 0")))
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    x = np.array([v for _, v in rows])
    ids = np.array([i for i, _ in rows])
    hits = []
    for q, v in got.items():
        s = x @ x[np.flatnonzero(ids == q)[0]]
        s[ids == q] = -np.inf
        hits.append(len({i for i, _ in v} & set(ids[np.argsort(-s)[:20]].tolist())) / 20)
    assert len(got) == (ids % 20 == 0).sum() and np.mean(hits) >= 0.9


def test_few_rows_and_none(spark):
    assert nearest(frame(spark, []), frame(spark, [])).collect() == []
    df = frame(spark, [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])])
    assert by_query(nearest(df, df.where("vec_id = 0"))) == {0: [(1, 0.5), (2, -1.0)]}
