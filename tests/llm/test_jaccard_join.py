import random
from collections import Counter

import numpy as np

from logsift.llm import jaccard_join as J
from logsift.llm.components import connected_components
from tests.llm.helpers import ODD_ROWS, odd_docs, words


def shingle_set(text):
    w = words(text)
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """For rows with unique ids: id -> (links, smallest id reachable)."""
    sets = {i: shingle_set(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = Counter()
    for a in sets:
        for b in sets:
            if a < b and sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (links[i], find(i)) for i in sets}


def near_copies(n, size, edits, seed):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(size)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(edits):
            own[rng.randrange(size)] = f"v{rng.randrange(10 ** 6)}"
        out.append(" ".join(own))
    return out


def corpus():
    texts = near_copies(60, 80, 1, 1) + near_copies(40, 300, 4, 2) + near_copies(30, 40, 2, 3) + near_copies(5, 3000, 20, 4)
    rng = random.Random(5)
    passage = " ".join(f"p{k}" for k in range(30))
    texts += [passage + " " + " ".join(f"u{rng.randrange(10 ** 6)}" for _ in range(40)) for _ in range(80)]
    texts += [texts[0]] * 30 + ["four words are few"] * 3 + ["four words are many", ""]
    rng.shuffle(texts)
    return list(enumerate(texts))


def check(spark, rows):
    got = J.jaccard_join(odd_docs(spark, rows, 4)).collect()
    want = brute(rows)
    assert {r.doc_id: (r.n_links, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_matches_brute_force(spark):
    check(spark, corpus())


def test_large_buckets_are_split_the_same(spark, monkeypatch):
    monkeypatch.setattr(J, "SMALL", 8)
    monkeypatch.setattr(J, "HOT_SETS", 20)
    monkeypatch.setattr(J, "HOT_SHARE", 0)
    monkeypatch.setattr(J, "BLOCK_SETS", 16)
    monkeypatch.setattr(J, "BROADCAST_BYTES", 0)
    check(spark, corpus())


def test_empty_blocks_count_nothing(spark, monkeypatch):
    monkeypatch.setattr(J, "BLOCK_SHINGLES", 20)
    rows, at = [], 0
    for n in (2, 3, 4, 5):
        rows += list(enumerate(near_copies(n, 120, 1, 20 + n), at))
        at += n
    check(spark, rows)


def test_odd_rows(spark):
    got = J.jaccard_join(odd_docs(spark)).collect()
    assert len(got) == len(ODD_ROWS)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r)
    # 6 and 7 are equal, 6 stands twice; LONG and LONG + one word are near copies.
    assert [r.n_links for r in by_id[6]] == [2, 2] and by_id[7][0].n_links == 2 and by_id[7][0].component_id == 6
    assert by_id[11][0].component_id == 10 and not by_id[11][0].kept
    assert all(r.n_links == 0 and r.kept for i in (0, 1, 2, 3, 9, None) for r in by_id[i])
    assert len(by_id[4]) == 2
    assert J.jaccard_join(odd_docs(spark, [])).count() == 0


def test_stage_keeps_one_of_each_group(spark):
    rows = corpus()
    docs = odd_docs(spark, rows + [(6, rows[6][1]), (None, "x y")])
    kept = J.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    want = sorted(i for i, (_, root) in brute(rows).items() if i == root)
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == want
    assert kept.filter("doc_id IS NULL").count() == 1


def test_an_id_with_unrelated_texts(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    rows = [(3, a), (5, a), (5, b), (7, b + " end"), (8, c), (8, c.upper()), (8, c + " end"), (9, ""), (9, "!"), (9, "!")]
    got = J.jaccard_join(odd_docs(spark, rows))
    assert {(r.doc_id, r.class_id, r.n_links, r.component_id, r.kept) for r in got.collect()} == {
        (3, 3, 1, 3, True), (5, 3, 1, 3, False), (5, 5, 1, 5, True), (7, 7, 1, 5, False), (8, 8, 2, 8, True), (9, 9, 0, 9, True)}
    kept = [(r.doc_id, r.text) for r in J.keep_one_of_each(odd_docs(spark, rows)).collect()]
    assert sorted(k for k in kept if k[0] != 8) == [(3, a), (5, b), (9, ""), (9, "!")]
    assert [k[1] in (c.upper(), c + " end") for k in kept if k[0] == 8] == [True]


def test_recall_of_runs_at_the_similarity():
    rng = np.random.default_rng(0)
    met = 0
    for _ in range(200):
        both = rng.integers(0, 1 << 16, J.TOKENS)
        a, b = both.copy(), both.copy()
        apart = rng.random(J.TOKENS) >= float(J.SIMILARITY)
        a[apart], b[apart] = rng.integers(0, 1 << 16, (2, int(apart.sum())))
        row, path, _ = J.walk(np.stack([a, b]).astype(np.uint16), J.runs_for(), [])
        met += bool(np.intersect1d(path[row == 0], path[row == 1]).size)
    assert met >= 199


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000, k) for k in range(1001, 1060)] + [(5, 5)]
    edges += [(2000 + k, 2001 + k) for k in range(40)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for a, b in edges for x in (a, b) if a != b}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_large_groups_are_joined_by_pivots_like_all_pairs():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 16, (6, J.TOKENS))
    tokens = base[rng.integers(0, 6, 500)].astype(np.uint16)
    noisy = rng.random(tokens.shape) < rng.random((500, 1)) * 0.6
    tokens[noisy] = rng.integers(0, 1 << 16, int(noisy.sum()))
    own = rng.integers(0, 450, 500)
    tokens = tokens[np.unique(own, return_index=True)[1]][np.unique(own, return_inverse=True)[1]]
    for side in (np.zeros(500, np.int32), rng.integers(0, 2, 500).astype(np.int32)):
        a = J.join_agreeing(np.arange(450), own, tokens, np.array([500]), side, J.AGREE)
        b = J.join_pivots(np.arange(450), own, tokens, side, J.AGREE)
        assert np.array_equal(a, b) and len(np.unique(a)) < 450
        pairs = [(i, j) for i in range(500) for j in range(i) if (tokens[i] == tokens[j]).sum() >= J.AGREE and (side[i] != side[j] or not side.any())]
        want = J.joined(np.arange(450), *(own[np.array(x)] for x in zip(*pairs)))
        assert np.array_equal(a, want)


def test_a_group_of_many_near_copies(spark, monkeypatch):
    monkeypatch.setattr(J, "CELL_SETS", 500)
    monkeypatch.setattr(J, "HOT_SETS", 300)
    monkeypatch.setattr(J, "BLOCK_SETS", 200)
    rows = list(enumerate(near_copies(900, 60, 1, 9)))
    check(spark, rows)
