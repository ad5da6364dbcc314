import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from logsift.llm import suffix_tree_lm as M
from tests.llm.helpers import ODD_ROWS, fold, odd_docs, tokens

DEPTH = M.DEPTH


def symbols(text):
    return bytes([M.EDGE]) + b"".join(t.replace("\x00", "\x0b").encode() + b" " for t in tokens(text)) + bytes([M.EDGE])


def brute_tree(texts, least):
    """context -> (retained, next-symbol counts), and a function for log10 probabilities."""
    count = defaultdict(Counter)
    for t in texts:
        s = symbols(t)
        for i in range(1, len(s)):
            for d in range(min(DEPTH, i) + 1):
                count[s[i - d:i]][s[i]] += 1
    root = np.full(256, 0.5)
    for b, n in count[b""].items():
        root[b] += n
    root /= root.sum()
    kept = {}

    def probability(context, b):
        p = root[b]
        for d in range(1, len(context) + 1):
            c = kept.get(context[len(context) - d:])
            if c is not None:
                total, kinds = sum(c.values()), len(c)
                p = (c[b] + M.BACKOFF * kinds * p) / (total + M.BACKOFF * kinds)
        return p

    for d in range(1, DEPTH + 1):
        new = {}
        for context, c in count.items():
            total = sum(c.values())
            if len(context) != d or total < least:
                continue
            apart = sum(n / total * math.log(n / total / probability(context[1:], b)) for b, n in c.items())
            if apart >= M.DIVERGENCE and total * apart >= M.EVIDENCE * len(c):
                new[context] = c
        kept.update(new)
    return kept, probability


def brute_score(text, probability):
    s = symbols(text)
    return sum(math.log10(probability(s[max(0, i - DEPTH):i], s[i])) for i in range(1, len(s)))


def corpus(n=120):
    rng = random.Random(2)
    parts = ["the", "on", "er", "ing", "ti", "Ä", "a", "st"]
    lexicon = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(150)]
    return [(i, " ".join(rng.choice(lexicon[: 5 + i]) for _ in range(rng.randint(0, 60))) + rng.choice(["", "\n", "."])) for i in range(n)]


def check(spark, rows, least_share):
    got = M.lm_scores(odd_docs(spark, rows, 4)).collect()
    assert len(got) == len(rows)
    training = [t for i, t in rows if (fold(i) if i is not None else 0) != 1]
    count = Counter(w for t in training for w in [*tokens(t), None])
    total = sum(count.values())
    below = total + 0.5 * (len(count) + 1)
    n_symbols = sum(len(symbols(t)) - 1 for t in training)
    _, probability = brute_tree(training, max(2, int(least_share * n_symbols)))
    want = []
    for i, t in rows:
        own = [*tokens(t), None]
        want.append((str(i), i is not None and fold(i) == 1, len(own), sum(count[w] > 0 for w in own), total,
                     sum(math.log10((count[w] + 0.5) / below) for w in own), brute_score(t, probability)))
    for r, w in zip(sorted(got, key=lambda r: (str(r.doc_id), r.n_tokens, r.score)), sorted(want, key=lambda w: (w[0], w[2], w[6]))):
        assert (str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[:5]
        assert r.base_score == pytest.approx(w[5], rel=1e-9) and r.score == pytest.approx(w[6], rel=1e-9)


@pytest.mark.parametrize("least_share, frequent", [(M.LEAST_SHARE, M.FREQUENT), (3e-3, 1e-2), (3e-3, 2.0)])
def test_matches_brute_force(spark, monkeypatch, least_share, frequent):
    monkeypatch.setattr(M, "LEAST_SHARE", least_share)
    monkeypatch.setattr(M, "FREQUENT", frequent)
    check(spark, corpus(), least_share)


def test_a_larger_corpus_loses_no_context(spark):
    # A passage seen often keeps its full contexts, however much other text there is.
    passage = "zq xj qz vk jx"
    rng = random.Random(7)
    rows = [(i, " ".join("".join(rng.choice("abcdef") for _ in range(8)) for _ in range(12_000))) for i in range(30)]
    rows += [(100 + k, passage) for k in range(4)]
    assert sum((fold(i) != 1) * len(t) for i, t in rows) > 2 * 800_000
    score = {r.doc_id: r.score for r in M.lm_scores(odd_docs(spark, rows)).collect()}
    # Each symbol inside the passage is certain but for the smoothing: under half a digit a symbol.
    assert score[100] > -0.5 * len(passage)


def test_odd_rows(spark):
    check(spark, [(i, t) for i, t in ODD_ROWS if t is None or len(t) < 1000], M.LEAST_SHARE)
    assert M.lm_scores(odd_docs(spark)).count() == len(ODD_ROWS)
    assert M.lm_scores(odd_docs(spark, [])).count() == 0


def test_without_training_rows(spark):
    held = [i for i in range(100) if fold(i) == 1][:3]
    got = M.lm_scores(odd_docs(spark, [(i, "some words") for i in held])).collect()
    assert len(got) == 3 and all(r.held_out and r.train_tokens == 0 and r.n_known == 0 and r.n_tokens == 3 for r in got)
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in got)


@pytest.mark.parametrize("size", ["sf0.01", "sf0.1"])
def test_better_than_the_base_on_held_out_texts(spark, size):
    docs = spark.read.parquet(f"/root/testdata/{size}/documents.parquet")
    row = M.lm_scores(docs).filter("held_out").selectExpr("sum(score) AS s", "sum(base_score) AS b").first()
    assert row.s > row.b


def test_many_teams_and_few_split_pairs(spark, monkeypatch):
    # Chunks of a few texts, several teams a partition; only the commonest pairs are split over buckets.
    monkeypatch.setattr(M, "CHUNK", 700)
    monkeypatch.setattr(M, "TEAM", 2000)
    monkeypatch.setattr(M, "HOT_PAIRS", 60)
    rows = corpus()
    check(spark, rows + [(1000 + i, t) for i, t in rows[-10:]], M.LEAST_SHARE)
    packed = M.pack_chunk(*M.stream(*_words("ab ab")), np.array([True]))
    assert M.unpack(packed["pair_counts"], np.int64).sum() == len(symbols("ab ab")) - 1


def _words(text):
    buf = np.frombuffer(text.encode(), np.uint8)
    return buf, M.nonspace_words(buf, np.array([0, len(buf)])), 1


def test_rounded_scores_differ_by_a_part_in_a_billion_at_most():
    values = -np.random.default_rng(1).exponential(1, 10_000)
    assert np.abs(M.rounded(values) / values - 1).max() < 1e-10
    assert len(M.pack(M.rounded(values))) < 6.2 * len(values)
