"""The range join against all pairs: many cells and blocks, copies, odd rows."""

import numpy as np
import pytest

from storyloom.llm import metric_join
from storyloom.llm.metric_join import links_and_components

SCHEMA = "label int, vec_id long, embedding array<float>, cls int, cell string"


def frame(spark, rows):
    return spark.createDataFrame([(0, i, v and [c if c is None else float(c) for c in v], 1, "x") for i, v in rows], SCHEMA)


def brute(rows, t=0.9):
    ok = [v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v) and any(v) for _, v in rows]
    xs = [np.array(v, np.float32).astype(float) if g else None for (_, v), g in zip(rows, ok)]
    near = [[j for j in range(len(rows)) if j != i and ok[i] and ok[j] and len(xs[i]) == len(xs[j])
             and float(xs[i] @ xs[j]) / float(np.sqrt(xs[i] @ xs[i]) * np.sqrt(xs[j] @ xs[j])) >= t] for i in range(len(rows))]
    out = []
    for i, (vid, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        c = min(ids, default=None)
        out.append((vid, len(near[i]), c, vid is not None and vid == c))
    return sorted(out, key=str)


def result(df):
    assert df.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("dim,spread", [(3, 0.3), (16, 0.11)])
def test_all_pairs_with_many_cells_blocks_and_odd_rows(spark, monkeypatch, dim, spread):
    monkeypatch.setattr(metric_join, "HOME_ROWS", 12)
    monkeypatch.setattr(metric_join, "GUEST_ROWS", 17)
    monkeypatch.setattr(metric_join, "CELLS", 9)
    monkeypatch.setattr(metric_join, "STEP", 5)
    rng = np.random.default_rng(dim)
    centres = rng.normal(size=(25, dim))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    rows = [(i, (centres[i % 25] + spread * rng.normal(size=dim)).tolist()) for i in range(300)]
    rows += [(i, centres[0].tolist()) for i in range(400, 440)]  # one very common vector
    rows += [(500 + i, (centres[1] + 1e-3 * rng.normal(size=dim)).tolist()) for i in range(60)]  # near copies
    rows += [(600, None), (601, []), (602, [0.0] * dim), (603, [float("nan")] * dim), (604, [float("inf")] * dim),
             (605, [None] * dim), (None, centres[2].tolist()), (None, (-centres[3]).tolist()), (7, rows[7][1]),
             (8, rows[9][1]), (700, [2e38] * dim), (701, [1e-38] * dim), (702, [1.0] * (dim + 1)), (703, [1.0] * (dim + 1)),
             (704, [-0.0] + [1.0] * (dim - 1)), (705, [0.0] + [1.0] * (dim - 1))]
    got, want = result(links_and_components(frame(spark, rows))), brute(rows)
    assert got == want
    assert max(n for _, n, _, _ in got) >= 59 and len({c for _, _, c, _ in got}) >= (8 if dim == 3 else 20)


def test_long_chain_is_one_component(spark, monkeypatch):
    monkeypatch.setattr(metric_join, "HOME_ROWS", 10)
    monkeypatch.setattr(metric_join, "GUEST_ROWS", 10)
    step = np.arccos(0.9) * 0.999
    rows = [(int(i), [float(np.cos(step * i / 9)), float(np.sin(step * i / 9))]) for i in range(100)]
    assert result(links_and_components(frame(spark, rows))) == brute(rows)


def test_clustered_vectors_are_sent_to_few_cells(spark, monkeypatch):
    monkeypatch.setattr(metric_join, "HOME_ROWS", 50)
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(20, 32))
    rows = [(i, (centres[i % 20] + 0.1 * rng.normal(size=32)).tolist()) for i in range(1000)]
    df = frame(spark, rows).selectExpr("vec_id cls", "1L n", "embedding v", "32 dim")
    work = metric_join._work(df, "array<float>", 0.9)
    assert work.where("not guest").count() == 1000 and work.where("guest").count() <= 1100


def test_empty_table(spark):
    assert result(links_and_components(frame(spark, []))) == []
    assert result(links_and_components(frame(spark, [(3, None)]))) == [(3, 0, 3, True)]
