import math

import numpy as np
import pyarrow as pa
import pytest

from logsift.llm import quality as Q
from logsift.llm.common import text_bytes
from tests.llm.helpers import ODD_ROWS, fold, odd_docs, words

SF = "/root/testdata/sf0.1"


def test_measures_by_hand():
    texts = ["One two TWO two.\nx!! | 5", "", "aa aa aa bb", None]
    x = Q.measure(*text_bytes(pa.array(texts, pa.large_string())))
    at = {n: k for k, n in enumerate(Q.FEATURES)}
    assert x.shape == (4, len(Q.FEATURES)) and (x[1] == 0).all() and (x[3] == 0).all()
    w = words(texts[0])
    assert np.isclose(x[0, at["log_words"]], np.log1p(len(w)))
    assert np.isclose(x[0, at["distinct_words"]], len(set(w)) / len(w))
    assert np.isclose(x[0, at["repeats_previous"]], sum(a == b for a, b in zip(w, w[1:])) / len(w))
    assert np.isclose(x[0, at["upper"]], 4 / 13)
    assert np.isclose(x[2, at["top_word"]], 3 / 4) and np.isclose(x[2, at["repeats_pair"]], 1 - 2 / 3)
    assert np.isclose(x[0, at["bangs"]], 2 / len(texts[0]))


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = Q.classify(docs, labels).join(labels, "doc_id").toPandas()
    assert [fold(i) == 0 for i in got.doc_id] == got.held_out.tolist()
    assert (got.predicted == (got.score >= 0.3)).all() and got.score.between(0, 1).all()
    held = got[got.held_out]
    good, bad = held[held.quality == 1].score, held[held.quality == 0].score
    assert len(bad) > 20 and (good.to_numpy()[:, None] > bad.to_numpy()[None, :]).mean() > 0.99
    assert (held.predicted == held.quality).mean() > 0.97


def test_held_out_labels_are_never_read(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet").limit(2000), spark.read.parquet(f"{SF}/labels.parquet")
    from logsift.llm.common import held_in_fold

    flipped = labels.selectExpr("doc_id", "toxic", "1 - quality AS q").withColumn("held", held_in_fold("doc_id", 0)).join(
        labels.select("doc_id", "quality"), "doc_id").selectExpr("doc_id", "toxic", "if(held, q, quality) AS quality")
    a = {r.doc_id: r.score for r in Q.classify(docs, labels).collect()}
    b = {r.doc_id: r.score for r in Q.classify(docs, flipped).collect()}
    assert a == b


def test_odd_rows_and_labels(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(1, 0, None), (2, 0, 0), (5, 1, 0), (10, 1, 1), (11, None, 0), (None, 1, 0), (6, 1, 0), (6, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    got = Q.classify(docs, labels).collect()
    assert len(got) == len(ODD_ROWS) and all(0 <= r.score <= 1 for r in got)
    none = Q.classify(docs, labels.limit(0)).collect()
    assert all(r.score == 0.5 and r.predicted == 1 for r in none)
    ones = Q.classify(docs, labels.filter("quality = 1")).collect()
    assert all(r.predicted == 1 for r in ones)
    assert Q.classify(odd_docs(spark, []), labels).count() == 0
    kept = Q.keep_good(docs, labels.filter("quality = 1"))
    assert kept.columns == docs.columns and kept.count() == len(ODD_ROWS)


def test_additive_tables_and_pairs_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = Q.fit(x[:3000], y[:3000])
    assert {(1, 0)} <= {(a, b) for a, b, _ in model.pairs}
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.95
    # A score is the sum of looked-up values.
    bins = model.bins(x[:5])
    by_hand = [model.intercept + sum(t[b[j]] for j, t in enumerate(model.tables)) + sum(t[b[i], b[j]] for i, j, t in model.pairs) for b in bins]
    assert np.allclose(model.raw(bins), by_hand)


def test_fit_never_reads_more_than_its_bound(spark, monkeypatch):
    # One id holds a third of the texts (some of them equal) and of the labels.
    texts = [(k if k % 3 else 3, f"text {k % 700} of some words " + "x " * (k % 50)) for k in range(3000)]
    labels = spark.createDataFrame([(k if k % 3 else 3, int(k % 2 or k % 3 == 0), 0) for k in range(3000)], "doc_id long, quality int, toxic int")
    seen = []
    fit = Q.fit
    monkeypatch.setattr(Q, "fit", lambda x, y: (seen.append(len(y)), fit(x, y))[1])
    for bound in (50, 400, 50_000):
        Q.train(odd_docs(spark, texts), labels, max_rows=bound)
        assert 0 < seen[-1] <= bound
    # A text counts once for an id, and ids with contradicting labels do not count.
    once = {(i, t) for i, t in texts if i is not None and fold(i) != 0}
    assert seen[-1] == len(once)
    Q.train(odd_docs(spark, [(1, "a b"), (2, "c d"), (3, "e f")]),
            spark.createDataFrame([(1, 0, 0), (1, 1, 0), (2, 1, 0), (2, 1, 0), (3, 0, 0)], "doc_id long, quality int, toxic int"))
    assert seen[-1] == sum(fold(i) != 0 for i in (2, 3))


def slow_fit(x, y, max_bins, rounds, rate, n_pairs, pair_rounds, l2):
    """Cyclic boosting row by row, every cut tried: (score of a row, tables, pairs)."""
    n, m = len(y), len(x[0])

    def quantile(values, q):
        at = q * (n - 1)
        low = int(at)
        return values[low] + (values[min(low + 1, n - 1)] - values[low]) * (at - low)

    cuts = [sorted({quantile(sorted(r[j] for r in x), k / max_bins) for k in range(1, max_bins)}) for j in range(m)]

    def places(row):
        return [sum(c < v for c in cuts[j]) for j, v in enumerate(row)]

    bins = [places(r) for r in x]
    prior = (sum(y) + 0.5) / (n + 1)
    raw = [math.log(prior / (1 - prior))] * n
    tables = [[0.0] * (len(c) + 1) for c in cuts]

    def slopes():
        p = [1 / (1 + math.exp(-r)) for r in raw]
        return [a - b for a, b in zip(y, p)], [max(b * (1 - b), 1e-6) for b in p]

    def leaf(rows, g, h):
        return sum(g[i] for i in rows) / (sum(h[i] for i in rows) + l2)

    def gain(rows, g, h):
        return sum(g[i] for i in rows) ** 2 / (sum(h[i] for i in rows) + l2)

    def best_cut(j, lo, hi, g, h):
        def won(k):
            left, right = ([i for i in range(n) if a <= bins[i][j] < b] for a, b in ((lo, k), (k, hi)))
            return gain(left, g, h) + gain(right, g, h) - gain(left + right, g, h)
        return max(((won(k), -k) for k in range(lo + 1, hi)), default=(0.0, -hi))

    for _ in range(rounds):
        for j, table in enumerate(tables):
            g, h = slopes()
            first = -best_cut(j, 0, len(table), g, h)[1]
            left, right = best_cut(j, 0, first, g, h), best_cut(j, first, len(table), g, h)
            edges = sorted({0, first, -(left if left[0] >= right[0] else right)[1], len(table)})
            for lo, hi in zip(edges, edges[1:]):
                rows = [i for i in range(n) if lo <= bins[i][j] < hi]
                value = rate * leaf(rows, g, h)
                table[lo:hi] = [t + value for t in table[lo:hi]]
                for i in rows:
                    raw[i] += value

    def best_quarters(a, b, g, h):
        found = None
        for ka in range(1, len(tables[a])):
            for kb in range(1, len(tables[b])):
                parts = {(p, q): [i for i in range(n) if (bins[i][a] >= ka) == p and (bins[i][b] >= kb) == q]
                         for p in (False, True) for q in (False, True)}
                total = sum(gain(rows, g, h) for rows in parts.values())
                if found is None or total > found[0]:
                    found = total, ka, kb, {k: leaf(rows, g, h) for k, rows in parts.items()}
        return found

    g, h = slopes()
    order = sorted(((best_quarters(a, b, g, h)[0], a, b) for a in range(m) for b in range(a)), reverse=True)[:n_pairs]
    pairs = {(a, b): [[0.0] * len(tables[b]) for _ in tables[a]] for _, a, b in order}
    for _ in range(pair_rounds):
        for (a, b), table in pairs.items():
            g, h = slopes()
            _, ka, kb, values = best_quarters(a, b, g, h)
            for p, line in enumerate(table):
                for q in range(len(line)):
                    line[q] += rate * values[p >= ka, q >= kb]
            for i in range(n):
                raw[i] += rate * values[bins[i][a] >= ka, bins[i][b] >= kb]

    def score(row):
        at = places(row)
        total = math.log(prior / (1 - prior)) + sum(t[k] for t, k in zip(tables, at))
        return 1 / (1 + math.exp(-total - sum(t[at[a]][at[b]] for (a, b), t in pairs.items())))

    return score, tables, pairs


@pytest.mark.parametrize("seed, max_bins", [(1, 6), (2, 9), (3, 4)])
def test_fit_and_score_equal_a_slow_reference(seed, max_bins):
    rng = np.random.default_rng(seed)
    x = rng.random((90, 4))
    x[:, 3] = np.round(x[:, 3] * 3)  # few kinds: some quantiles coincide
    y = ((x[:, 0] > 0.6) ^ (x[:, 1] > 0.4) ^ (rng.random(90) < 0.1)).astype(float)
    own = dict(max_bins=max_bins, rounds=4, rate=0.3, n_pairs=2, pair_rounds=3, l2=1.5)
    model = Q.fit(x, y, **own)
    score, tables, pairs = slow_fit(x.tolist(), y.tolist(), **own)
    assert all(np.allclose(a, b) for a, b in zip(model.tables, tables)) and len(tables) == 4
    assert [(a, b) for a, b, _ in model.pairs] == list(pairs)
    assert all(np.allclose(t, pairs[a, b]) for a, b, t in model.pairs)
    fresh = rng.random((50, 4)) * 4 - 1
    assert np.allclose(model.score(fresh), [score(r) for r in fresh.tolist()])


def test_classify_equals_the_slow_reference_on_texts(spark):
    rng = np.random.default_rng(5)
    good, bad = ["The", "house", "is", "on", "a", "hill"], ["BUY", "!!!", "x|x", "99", "now"]
    texts = [(i, " ".join(rng.choice(good if i % 3 else bad, rng.integers(1, 25)))) for i in range(60)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(60)], "doc_id long, quality int, toxic int")
    own = dict(max_bins=5, rounds=3, rate=0.3, n_pairs=1, pair_rounds=2, l2=4.0)
    fit, Q.fit = Q.fit, lambda x, y: fit(x, y, **own)
    try:
        got = {r.doc_id: r.score for r in Q.classify(odd_docs(spark, texts), labels).collect()}
    finally:
        Q.fit = fit
    x = Q.measure(*text_bytes(pa.array([t for _, t in texts], pa.large_string())))
    train = sorted(((x[i].tolist(), float(i % 3 > 0)) for i, _ in texts if fold(i) != 0))
    score, _, _ = slow_fit([r for r, _ in train], [c for _, c in train], **own)
    assert got == pytest.approx({i: score(x[i].tolist()) for i, _ in texts}, abs=1e-9)
