"""Hard negatives against brute force, with odd rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_fixtures import CLASH
from paperloom.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, every, positives=5, negatives=10, low=30, high=90, scale=256):
    fine = {}
    for i, e, lab in rows:
        if i is None or lab is None or not e or any(x is None or not math.isfinite(x) for x in e):
            continue
        fine[(i, lab, tuple(math.floor(scale * x) for x in e))] = None
    fine = list(fine)
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for i, lab, e in fine:
        if i % every:
            continue
        scored = sorted((-dot(e, f), j, m) for j, m, f in fine if j != i)
        for s, j, _ in [x for x in scored if x[2] == lab][:positives]:
            fit = [(n, t) for t, n, m in scored if m != lab and low * -s <= 100 * -t <= high * -s][:negatives]
            out += [(i, j, rank + 1, n, -s, -t) for rank, (n, t) in enumerate(fit)]
    return sorted(out)


def made(rng, n, dim, near):
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(6)]
    rows = []
    for i in range(n):
        lab = rng.randrange(6) if rng.random() < 0.7 else 0
        at = centres[lab if rng.random() < 0.8 else rng.randrange(6)]
        rows.append((i, [near * c + rng.gauss(0, 1) / 4 for c in at], lab))
    return rows


@pytest.fixture
def small(monkeypatch):
    """Chunks, blocks of anchors and groups small enough that several of each take part."""
    monkeypatch.setattr(H, "FILE", 100)


@pytest.mark.parametrize("dim,near", [(3, 1.0), (24, 0.3), (17, 0.0)])
def test_negatives(spark, small, dim, near):
    rng = random.Random(dim)
    rows = made(rng, 400, dim, near)
    rows += [rows[3], rows[4], (20, rows[7][1], 2)]  # repeated rows, and one id twice
    rows += [(500 + i, [1.0] * dim, i % 3) for i in range(40)]  # ties
    rows += [(600, None, 1), (620, [], 1), (640, [None] * dim, 1), (660, [math.nan] * dim, 2), (680, [math.inf] * dim, 2), (700, [1.0] * dim, None), (None, [1.0] * dim, 1)]
    rows += [(720, [0.0] * dim, 1), (740, [2.0], 3), (760, [1.0] * dim, 99)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", *[f"'x' as {c}" for c in CLASH if c != "label"])
    for tile in (1000, 7):
        got = H.hard_negatives(df, F.col("id") % 20 == 0, F.col("label"), tile=tile)
        assert sorted(tuple(r) for r in got.collect()) == brute(rows, 20)


def test_other_numbers_and_empty(spark, small):
    rng = random.Random(9)
    rows = made(rng, 200, 8, 0.5)
    df = spark.createDataFrame(rows, SCHEMA)
    got = H.hard_negatives(df, F.col("id") % 10 == 0, F.col("label"), positives=2, negatives=30, low=-20, high=70, scale=16)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 10, 2, 30, -20, 70, 16)
    assert H.hard_negatives(df.where("false"), F.col("id") % 10 == 0, F.col("label")).count() == 0
    assert H.hard_negatives(df, F.lit(False), F.col("label")).count() == 0


def test_index_joins_every_pair_above_the_thresholds():
    rng = np.random.default_rng(4)
    for dim in (1, 8, 9, 40):
        rows = np.floor(rng.normal(size=(300, dim)) * np.exp(-np.arange(dim) / 4) * 200).astype(np.int64)
        anchors = rows[:30]
        exact = anchors @ rows.T
        for share in (0.9, 0.5, 0.1, -0.5):
            bars = np.floor(share * exact.max(1)).astype(np.float64)
            a, r, s = H.Index(rows).join(anchors, bars)
            want = exact >= bars[:, None]
            assert len(a) == want.sum() and want[a, r].all() and (s == exact[a, r]).all()


def test_high_thresholds_leave_dimensions_out(monkeypatch):
    """With falling energy most rows keep only their strong groups in the index."""
    rng = np.random.default_rng(5)
    rows = np.floor(rng.normal(size=(500, 64)) * np.exp(-np.arange(64) / 8) * 1000).astype(np.int64)
    index = H.Index(rows)
    bar = 0.5 * index.length.max() ** 2
    kept = (index.rest * index.rest.max(0) >= bar).sum(1)
    assert kept.max() < len(index.edges) - 1 and (kept == 0).any()
