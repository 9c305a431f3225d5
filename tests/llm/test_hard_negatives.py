"""Hard negatives against brute force with whole Python numbers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from nimbusframe.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, positives=5, negatives=5, scale=256):
    part = []
    for vec_id, v, label in rows:
        if label is None or v is None or any(c is None or not math.isfinite(c) for c in v):
            continue
        whole = [math.floor(scale * c) if math.isfinite(scale * c) else int(c) * scale for c in v]
        part.append((vec_id, whole, label))
    out = []
    key = lambda s: (-s[0], s[1] is None, s[1] or 0)
    for i, (anchor, v, label) in enumerate(part):
        if anchor is None or anchor % 100:
            continue
        scored = []
        for j, (other, w, lab) in enumerate(part):
            if i != j and len(v) == len(w):
                s = min(max(sum(a * b for a, b in zip(v, w)), -(1 << 63)), (1 << 63) - 1)
                scored.append((s, other, lab == label))
        for s, pos, _ in sorted((x for x in scored if x[2]), key=key)[:positives]:
            fit = sorted((x for x in scored if not x[2] and 80 * s <= 100 * x[0] <= 100 * s), key=key)
            out += [(anchor, pos, k + 1, n, s, t) for k, (t, n, _) in enumerate(fit[:negatives])]
    return sorted(out, key=str)


def mined(df, **kw):
    return sorted((tuple(r) for r in hn.mine(df, F.col("vec_id") % 100 == 0, **kw).collect()), key=str)


def vectors(n, dim, clusters, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dim))
    return [(i, [float(np.float32(c)) for c in centres[i % clusters] + 0.05 * rng.normal(size=dim)], int(rng.integers(4))) for i in range(n)]


@pytest.mark.parametrize("block, chunk", [(8192, 2048), (100, 3)])
def test_equal_to_brute_force(spark, block, chunk):
    rows = vectors(700, 6, 9, 1)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert mined(df, block=block, chunk=chunk) == brute(rows)


def test_awkward_rows(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice((-0.5, 0.25, 1.0)) for _ in range(3)], rng.randrange(3)) for i in range(150)]  # many ties
    rows += rows[:30]  # repeated rows, anchors among them
    rows += [
        (None, [1.0, 1.0, 1.0], 1), (None, [1.0, 1.0, 0.5], 2), (200, None, 1), (201, [1.0, None, 1.0], 1),
        (202, [float("nan"), 1.0, 1.0], 1), (203, [float("inf"), 1.0, 1.0], 1), (204, [1.0, 1.0, 1.0], None),
        (300, [], 1), (301, [], 1), (302, [], 2), (400, [1.0, 2.0], 1), (401, [1.0, 2.5], 1), (402, [1.0, 2.0], 0),
        (500, [0.0, 0.0, 0.0], 1), (-100, [-1.0, 2.0, 0.1], 2), (600, [3e38, 1.0, 0.0], 1), (601, [3e38, 0.5, 0.0], 1),
        (602, [3e38, 0.25, 0.0], 2),
    ]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in ("uid", "id", "anchor", "v", "block", "chunk", "centre", "width", "rank", "score", "a.b"):
        df = df.withColumn(name, F.lit(1))
    expected = brute(rows)
    assert mined(df) == mined(df, block=20, chunk=2) == expected
    assert any(r[0] == 600 for r in expected) and any(r[0] == 300 for r in expected)


def test_doubles_beyond_scaling(spark):
    rows = [(100, [1.5e308, 1.0], 1), (101, [1e308, 2.0], 1), (102, [1.0, 1.0], 2), (200, [2.0, 1.0], 2), (201, [3.0, 1.0], 2), (202, [3.0, 0.5], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert mined(df) == brute(rows)


def test_empty_tables(spark):
    assert mined(spark.createDataFrame([], SCHEMA)) == []
    assert mined(spark.createDataFrame([(1, [1.0], 1), (2, None, 1)], SCHEMA)) == []


def test_tree_covers_and_leaves_nodes_out():
    rows = vectors(6000, 5, 40, 2)
    x = np.floor(256 * np.array([r[1] for r in rows]))
    labels = np.array([r[2] for r in rows])
    block = hn.Block(np.arange(len(x)), list(range(len(x))), labels, x)
    up = hn.lifted(block.x, block.top)
    for lo, hi, radius, children in block.nodes:
        assert np.sqrt(((up[lo:hi] - up[lo]) ** 2).sum(1)).max() <= radius + 1e-6
        if children:
            ranges = [block.nodes[c][:2] for c in children]
            assert ranges[0][0] == lo and ranges[-1][1] == hi
            assert all(a[1] == b[0] for a, b in zip(ranges, ranges[1:]))
    least, most = block.bounds(x[:50])
    scores = x[:50] @ block.x.T
    for k, (lo, hi, _, _) in enumerate(block.nodes):
        assert (scores[:, lo:hi].max(1) <= most[:, k]).all() and (scores[:, lo:hi].min(1) >= least[:, k]).all()
    scored = []
    exact = block.scores
    block.scores = lambda a, fits, lo, hi: scored.append(hi - lo) or exact(a, fits, lo, hi)
    for i in range(50):
        best = block.search(x[i], i, block.labels == labels[i], [(None, None)], 5, least[i], most[i])[0]
        same = [j for j in range(len(x)) if labels[j] == labels[i] and j != i]
        expected = sorted((-int(x[j] @ x[i]), False, j, j) for j in same)[:5]
        assert best == expected
    assert sum(scored) < 0.5 * 50 * len(x)
