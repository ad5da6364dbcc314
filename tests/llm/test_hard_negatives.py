import math
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from logsift.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<double>, label int, id string, block string, score string"


def table(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, y, "a", "b", "c") for i, v, y in rows], SCHEMA).repartition(parts)


def brute(rows, every=50):
    rows = [(i, [math.floor(256 * x) for x in v], y) for i, v, y in rows
            if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (a, q, y) in enumerate(rows):
        if a % every:
            continue
        scored = [(sum(p * r for p, r in zip(q, x)), i, z) for k, (i, x, z) in enumerate(rows) if k != n and len(x) == len(q)]
        for score, positive, _ in sorted((r for r in scored if r[2] == y), key=lambda r: (-r[0], r[1]))[:5]:
            fit = sorted((r for r in scored if r[2] != y and 50 * score <= 100 * r[0] <= 95 * score), key=lambda r: (-r[0], r[1]))
            out += [(a, positive, k + 1, r[1], score, r[0]) for k, r in enumerate(fit[:3])]
    return sorted(out)


def mined(df, **more):
    return sorted(tuple(r) for r in H.mine_hard_negatives(df, F.col("vec_id") % 50 == 0, **more).collect())


def vectors(n, dim, seed, labels=4, scale=1.0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(8)]
    return [(i, [scale * (c + rng.gauss(0, 0.5)) for c in centres[rng.randrange(8)]], rng.randrange(labels)) for i in range(n)]


def test_matches_brute_force_with_ties_and_odd_rows(spark):
    rows = vectors(700, 12, 1) + [(i, [0.5] * 12, i % 2) for i in range(700, 760)]
    rows += [(1000, None, 1), (1050, [1.0] * 12, None), (None, [1.0] * 12, 1), (1100, [math.nan] * 12, 0), (1150, [None] + [1.0] * 11, 0),
             (1200, [math.inf] * 12, 0), (1250, [1.0, 2.0], 1), (1251, [2.0, 2.0], 1), (1252, [1.0, 0.5], 0), (1300, [], 0), (1301, [], 0),
             (1302, [], 1), (1350, [0.0] * 12, 1)]
    want = brute(rows)
    assert want and mined(table(spark, rows)) == want


def test_small_blocks_and_strips_give_the_same(spark, monkeypatch):
    rows = vectors(400, 40, 2)
    want = brute(rows)
    monkeypatch.setattr(H, "BLOCK_ROWS", 7)
    monkeypatch.setattr(H, "STEPS", (1, 1, 2))
    assert mined(table(spark, rows), strip_bytes=1500) == want


def test_large_components_stay_exact(spark):
    # Products above 2 ** 53 need whole numbers.
    rows = vectors(120, 4, 3, labels=2, scale=3e5)
    assert mined(table(spark, rows)) == brute(rows)
    rows.append((50_000, [1e300] * 4, 0))
    assert not [r for r in mined(table(spark, rows)) if 50_000 in r]


def test_repeated_ids_are_rows_of_their_own_and_empty_tables(spark):
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (3, [0.75, 0.1], 2), (3, [0.75, 0.1], 2)]
    assert mined(table(spark, rows)) == brute(rows)
    assert mined(table(spark, [])) == []
    assert mined(table(spark, [(i, v, 1) for i, v, _ in vectors(60, 4, 4)])) == []


def test_bounds_rule_rows_out():
    rng = np.random.default_rng(0)
    x = rng.integers(-200, 200, (32, 3000))
    x[:, 1500:] //= 20  # rows that the bounds tell apart early
    block = H.Block({"block": 0, "dim": 32, "ids": list(range(3000)), "labels": ["a"] * 3000, "width": 2, "columns": x.astype("<i2").tobytes()})
    shown = []
    query = x[:, 5].astype(np.int64)
    query[10:] //= 50
    scan = block.scan

    def counting(q, rows, keep):
        return scan(q, rows, lambda low, high: (shown.append(len(low)), keep(low, high))[1])

    block.scan = counting
    best = H.best_of_label(block, query, np.arange(3000), [], 5)
    score = query @ x
    assert best == sorted(zip(score.tolist(), range(3000)), key=lambda r: (-r[0], r[1]))[:5]
    assert shown[0] == 3000 and shown[-1] < 100


def test_quantising_floors_and_leaves_out_unusable_rows():
    column = pa.array([[0.5, -0.001], None, [1.0], [float("nan"), 1.0], [2.0, 1e200]], pa.list_(pa.float64()))
    found = {m.shape[1]: (rows.tolist(), m.tolist()) for rows, m in H.quantised(column, 256)}
    assert found == {1: ([2], [[256]]), 2: ([0], [[128, -1]])}
