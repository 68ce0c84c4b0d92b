"""Search within cells against brute force over the same cells."""

import random

import numpy as np
import pytest

from tessera.operators import cells, retrieve


@pytest.mark.parametrize("reachable", [True, False])
@pytest.mark.parametrize("rows", [7, 4096])
def test_best_of_probed_cells(spark, monkeypatch, reachable, rows):
    monkeypatch.setattr(cells, "reachable", lambda spark: reachable)
    monkeypatch.setattr(cells, "ROWS", rows)
    rng = random.Random(3)
    centres = [[1.0, 0.0], [0.0, 1.0], [-1.0, 0.0], [0.0, 0.0]]  # few values, so scores and distances tie
    made = {i: [rng.choice((-1.0, 0.0, 0.5, 1.0)) for _ in range(2)] for i in range(120)}
    df = spark.createDataFrame(list(made.items()), "id long, v array<double>").repartition(3)
    got = {}
    for r in retrieve.top_k(cells.top(cells.nearest(df, centres, 2), cells.nearest(df, centres, 1), 4), 4).collect():
        got.setdefault(r["source1_id"], []).append((r["rank"], r["candidate_id"], r["score"]))
    near = {i: sorted(range(4), key=lambda c: (sum((x - y) ** 2 for x, y in zip(v, centres[c])), c)) for i, v in made.items()}
    for q, v in made.items():
        held = sorted((-round(float(np.dot(v, made[c])), 6), c) for c in made if c != q and near[c][0] in near[q][:2])[:4]
        assert sorted(got.get(q, [])) == [(n, c, -s) for n, (s, c) in enumerate(held, 1)]


def test_no_pair_is_made(spark):
    """The cells were join keys once, so every pair of a probed cell was a row."""
    rng = random.Random(4)
    df = spark.createDataFrame([(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(200)], "id long, v array<double>")
    found = retrieve.ivf_topk(df, df, "id", "v", 3, cells=4, probe=3)
    assert "Join" not in found._jdf.queryExecution().toString()
    assert found.groupBy("source1_id").count().where("count = 3").count() == 200
