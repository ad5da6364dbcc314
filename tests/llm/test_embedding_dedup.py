import math
import random
from collections import Counter

import numpy as np

from logsift.llm import embedding_dedup as E

NAN, INF = float("nan"), float("inf")


def cosine(a, b):
    a, b = np.asarray(a, np.float64), np.asarray(b, np.float64)
    return float((a * b).sum() / (math.sqrt((a * a).sum()) * math.sqrt((b * b).sum())))


def usable(v):
    return bool(v) and all(c is not None and math.isfinite(c) for c in v) and any(v)


def brute(rows):
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = Counter()
    for k, (i, v) in enumerate(rows):
        for j, w in rows[k + 1:]:
            if usable(v) and usable(w) and len(v) == len(w) and cosine(v, w) >= 0.9:
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (links[i], find(i)) for i in root}


def table(spark, rows, kind="float"):
    return spark.createDataFrame([("c", i, v, 1) for i, v in rows], f"node string, vec_id long, embedding array<{kind}>, w int").repartition(3)


def vectors(n=400, dim=16, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((30, dim))
    rows = []
    for i in range(n):
        v = centres[rng.integers(30)] + rng.standard_normal(dim) * rng.choice([0.05, 0.35, 0.5])
        rows.append((i, [float(np.float32(x)) for x in v]))
    rows += [(n + k, rows[3][1]) for k in range(40)] + [(n + 100, [2 * x for x in rows[3][1]])]
    random.Random(2).shuffle(rows)
    return rows


def check(spark, rows, kind="float"):
    got = E.embedding_dedup(table(spark, rows, kind)).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == brute(rows)
    assert len(got) == len(rows) and all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_matches_brute_force(spark):
    check(spark, vectors())
    check(spark, vectors(100, 5, 3), "double")


def test_large_buckets_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(E, "BLOCK", 25)
    check(spark, vectors())


def test_chained_candidates_beyond_one_cell(spark, monkeypatch):
    made, links = [], E.links
    monkeypatch.setattr(E, "COMPONENT", 20)
    monkeypatch.setattr(E, "links", lambda *a: made.append(a[0]) or links(*a))
    rows = vectors()
    check(spark, rows)
    # Some vectors went to their buckets, others to their component.
    assert 20 < made[0].count() < len(rows) - 41
    monkeypatch.setattr(E, "BLOCK", 25)
    check(spark, rows)


def test_sketches_keep_pairs_of_the_similarity():
    limit = E.sketch_limit()
    n, p = 64 * E.SKETCH, math.acos(0.9) / math.pi
    tail = [sum(math.comb(n, k) * p ** k * (1 - p) ** (n - k) for k in range(far + 1, n + 1)) for far in (limit - 1, limit)]
    assert tail[1] <= E.MISSED * 1.001 and tail[0] > E.MISSED
    rng = np.random.default_rng(8)
    a = E.unit_rows(rng.standard_normal((20_000, 24)))
    b = rng.standard_normal(a.shape)
    b = E.unit_rows(b - (a * b).sum(axis=1, keepdims=True) * a)
    far = np.bitwise_count(E.sketches(a) ^ E.sketches(0.9 * a + math.sqrt(1 - 0.81) * b)).sum(axis=1)
    assert far.max() <= limit and abs(far.mean() - n * p) < 0.5


def test_sketch_forest_joins_what_pairs_join(monkeypatch):
    monkeypatch.setattr(E, "STRIP", 7)
    rng = np.random.default_rng(9)
    words = rng.integers(0, 2 ** 8, (60, 2)).astype(np.uint64)
    for side in (np.full(60, -1), rng.integers(0, 2, 60)):
        for limit in (0, 2, 3, 4):
            root = np.arange(60)
            for _ in range(60):
                for i in range(60):
                    for j in range(60):
                        if (side[0] < 0 or side[i] != side[j]) and np.bitwise_count(words[i] ^ words[j]).sum() <= limit:
                            root[i] = root[j] = min(root[i], root[j])
            assert (E.sketch_forest(words, side, limit) == root).all()


def test_ids_that_repeat_with_other_vectors(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.01]), (3, [0.01, 1.0]), (4, [-1.0, 0.0])]
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in E.embedding_dedup(table(spark, rows)).collect())
    assert got == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False), (4, 0, 4, True)]


def test_block_size_does_not_grow_with_the_input(spark, monkeypatch):
    monkeypatch.setattr(E, "BLOCK", 3)
    monkeypatch.setattr(E, "STRIP", 4)
    made, links = [], E.cell_links
    x = np.random.default_rng(4).standard_normal((30, 8)) * 0.01 + np.arange(1, 9)
    side, one = np.full(30, -1, np.int32), np.ones(30, np.int64)
    many, root = links(x, np.zeros((30, 1), np.uint16), 0, side, one, 0.9)
    assert (many == 29).all() and (root == 0).all()
    many, root = links(x, np.zeros((30, 1), np.uint16), 0, side + 1, one, 0.9)
    assert not many.any() and (root == np.arange(30)).all()
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(np.float32(x))]
    classes = E._classes(table(spark, rows), "vec_id", "embedding").selectExpr("k1", "id AS node", "1L AS w", "vec")
    monkeypatch.setattr(E, "_cells", lambda *a, own=E._cells: made.append(a[0]) or own(*a))
    # So many tables that a share of the rows would exceed the block.
    E.links(classes, np.dtype(np.float32), 4, 15_000, 0.9)
    blocks = [w.blocks for r in made[-1].select("wide").collect() for w in r.wide]
    assert max(blocks) == 10


def test_odd_vectors(spark):
    rows = [(0, None), (1, []), (2, [0.0, 0.0]), (3, [None, 1.0]), (4, [NAN, 1.0]), (5, [INF, 1.0]), (6, [1.0, 0.0]), (7, [1.0, -0.0]),
            (8, [5.0, 0.0]), (9, [1.0, 0.0, 0.0]), (10, [-1.0, 0.0]), (11, [1e-30, 0.0]), (12, [3e38, 1e37]), (13, [None, None])]
    got = {r.vec_id: r for r in E.embedding_dedup(table(spark, rows)).collect()}
    assert len(got) == len(rows)
    assert {i for i in got if got[i].component_id == 6} == {6, 7, 8, 11, 12}
    assert all(got[i].n_links == 4 for i in (6, 7, 8, 11, 12))
    assert all(got[i].n_links == 0 and got[i].kept for i in (0, 1, 2, 3, 4, 5, 9, 10, 13))
    twice = E.embedding_dedup(table(spark, [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [1.0, 2.0])])).collect()
    assert sorted((r.vec_id or 0, r.n_links) for r in twice) == [(0, 0), (1, 1), (1, 1)]
    assert E.embedding_dedup(table(spark, [])).count() == 0


def test_tables_reach_the_recall():
    for n in (10, 1000, 100_000, 10 ** 8):
        bits, tables = E.tables_for(n)
        same = 1 - math.acos(0.9) / math.pi
        assert (1 - same ** bits) ** tables <= 1 - E.RECALL + 1e-12
        assert n / 2 ** bits <= E.BUCKET or bits == 30
