"""Hard negatives against brute force over all rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonefare.llm import hard_negatives as H


def brute(rows, every=10, high=90, low=30):
    taking = []
    for i, label, v in rows:
        if i is None or label is None or v is None or any(c is None or not math.isfinite(c) for c in v):
            continue
        r = (i, (label + 1) % 10 if i % 7 == 0 else label, tuple(v))
        if r not in taking:
            taking.append(r)
    quantised = {r: [math.floor(256 * c) for c in r[2]] for r in taking}
    out = []
    for a in taking:
        if a[0] % every:
            continue
        scored = []
        for r in taking:
            if r[0] != a[0] and len(r[2]) == len(a[2]):
                s = sum(x * y for x, y in zip(quantised[a], quantised[r]))
                scored.append((-max(-(1 << 63), min((1 << 63) - 1, s)), r[0], r[2], r[1]))
        scored.sort()
        for p in [r for r in scored if r[3] == a[1]][:5]:
            near = [r for r in scored if r[3] != a[1] and low * -p[0] <= 100 * -r[0] <= high * -p[0]][:10]
            out += [(a[0], p[1], n, r[1], -p[0], -r[0]) for n, r in enumerate(near, 1)]
    return sorted(out)


def found(spark, rows, **options):
    df = spark.createDataFrame([(i, lab, v, "x", 0) for i, lab, v in rows],
                               "vec_id long, label int, embedding array<double>, row string, score int").repartition(5)
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return sorted(tuple(r) for r in H.mine(df, F.col("vec_id") % 10 == 0, noisy, **options).collect())


def clustered(n, d, rnd):
    centres = rnd.normal(size=(8, d))
    return [(i, int(rnd.integers(3)), (centres[i % 8] + 0.4 * rnd.normal(size=d)).tolist()) for i in range(n)]


def test_many_blocks_chunks_and_a_hot_vector(spark, monkeypatch):
    monkeypatch.setattr(H, "BLOCK_ROWS", 60)
    monkeypatch.setattr(H, "CHUNK_ROWS", 12)
    monkeypatch.setattr(H, "ANCHORS_AT_ONCE", 5)
    rows = clustered(500, 20, np.random.default_rng(3))
    rows += [(1000 + i, i % 4, [0.5] * 20) for i in range(250)]  # a third of all rows are one vector
    want = brute(rows)
    assert len(want) > 500
    assert found(spark, rows) == want


def test_odd_rows(spark):
    rnd = random.Random(6)
    rows = [(i, i % 3, [rnd.choice([-1.0, 0.25, 0.5, 1.0]) for _ in range(5)]) for i in range(60)]
    rows += [(None, 1, [1.0] * 5), (100, None, [1.0] * 5), (110, 1, None), (120, 1, [1.0, None, 1.0, 1.0, 1.0]),
             (130, 1, [float("nan")] * 5), (140, 1, [float("inf")] * 5)]
    rows += [(150, 2, [0.5] * 4), (151, 2, [0.5] * 4), (152, 1, [0.25] * 4)]  # another length
    rows += [rows[0]] * 3 + [(10, 2, [0.5, 0.5, 0.5, 0.5, 0.25])]  # repeated rows, and an id with another vector
    rows += [(160, 1, [1e16, 1.0, 0.0, 0.0, 0.0]), (161, 2, [1e16, 1.0, 0.0, 0.0, 0.0]), (162, 1, [3e14, 0.5, 0.0, 0.0, 0.0])]
    rows += [(170, 1, []), (171, 1, []), (172, 2, [])]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == [] and found(spark, rows[:1]) == []
    assert found(spark, [(0, 1, [1.0, 0.0]), (1, 2, [0.5, 0.0])]) == []  # an anchor without positives


@pytest.mark.parametrize("share", [0.2, 0.6, 0.95])
def test_threshold_join_finds_exactly_the_pairs_that_reach(share):
    rnd = np.random.default_rng(9)
    x = np.floor(256 * np.concatenate([rnd.normal(size=(300, 30)) * np.linspace(0.05, 1, 30), np.zeros((5, 30))]))
    q = x[::11]
    s = q @ x.T
    t = np.quantile(s, share, axis=1)
    t[0], t[1] = -np.inf, s.max() * 2
    got = H.reached(q, x, t)
    assert ((got > -np.inf) == (s >= t[:, None])).all()
    assert (got[got > -np.inf] == s[got > -np.inf]).all()


def test_index_omits_what_cannot_reach(monkeypatch):
    """With high thresholds the omitted dimensions are not read."""
    rnd = np.random.default_rng(2)
    x = np.floor(256 * rnd.normal(size=(400, 64)) * np.concatenate([np.full(48, 0.02), np.full(16, 1.0)]))
    q = x[:20]
    norm = np.sqrt((q ** 2).sum(axis=1))
    t = 0.8 * norm * np.sqrt((x ** 2).sum(axis=1)).max()
    squares = np.sqrt(np.concatenate([np.zeros((len(x), 1)), np.cumsum(np.sort((x ** 2).sum(axis=0))[None] * 0 + (x[:, np.argsort((x ** 2).sum(axis=0), kind="stable")]) ** 2, axis=1)], axis=1)[:, list(range(0, 65, 8))])
    assert ((squares < (t / norm).min()).sum(axis=1) - 1).min() >= 5  # at least 40 of 64 dimensions stay out
    assert ((H.reached(q, x, t) > -np.inf) == (q @ x.T >= t[:, None])).all()
