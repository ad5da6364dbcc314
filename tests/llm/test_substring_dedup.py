import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from logsift.llm import substring_dedup as S
from tests.llm.helpers import LONG, ODD_ROWS, odd_docs


def brute(rows, window=35):
    """(id, words, removed, hash) of each row."""
    texts = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[k:k + window]) for w in texts for k in range(len(w) - window + 1))
    out = []
    for (i, _), w in zip(rows, texts):
        gone = set()
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k:k + window])] > 1:
                gone.update(range(k, k + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def removed(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=repr)


def corpus(seed, n=120):
    rng = random.Random(seed)

    def some(k, words=4000):
        return [f"w{rng.randrange(words)}" for _ in range(k)]

    passages = [some(k) for k in (34, 35, 36, 50, 90, 200)]
    common = some(60)
    rows = []
    for _ in range(n):
        text = some(rng.randrange(1, 120))
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(text) + 1)
            piece = rng.choice(passages)
            lo = rng.randrange(max(1, len(piece) - 30))
            text[at:at] = piece[lo:lo + rng.randrange(30, 120)]
        if rng.random() < 0.4:
            text[len(text) // 2:len(text) // 2] = common
        if rng.random() < 0.1:
            text += text[-50:]
        rows.append(" ".join(text))
    rows += rows[:4] + [rows[0]] * 5 + [" ".join(["same"] * 80), " ".join(["same"] * 35), " ".join(["ab", "ba"] * 30), "few words", "few words"]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_matches_brute_force(spark):
    rows = corpus(1)
    assert removed(S.remove_repeats(odd_docs(spark, rows))) == brute(rows)


@pytest.mark.parametrize("hot", [1, 3, 10])
def test_anchors_of_many_stretches_are_cut_the_same(spark, hot):
    rows = corpus(2)
    assert removed(S.remove_repeats(odd_docs(spark, rows), hot=hot)) == brute(rows)


@pytest.mark.parametrize("window", [1, 2, 5, 50])
def test_other_windows(spark, window):
    rows = corpus(3, 40)
    assert removed(S.remove_repeats(odd_docs(spark, rows), window=window)) == brute(rows, window)


def test_full_filters_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(S, "MOST_BITS", 64)
    rows = corpus(4, 60)
    assert removed(S.remove_repeats(odd_docs(spark, rows))) == brute(rows)


def test_spans_are_the_removed_words(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    rows = [(1, f"{a} {b}"), (2, f"{c} {b} end"), (3, c), (4, "alone")]
    got = {r.doc_id: [(s["first"], s["last"]) for s in r.spans] for r in S.remove_repeats(odd_docs(spark, rows)).collect()}
    assert got == {1: [(60, 119)], 2: [(0, 119)], 3: [(0, 59)], 4: []}


def test_odd_rows(spark):
    got = removed(S.remove_repeats(odd_docs(spark)))
    assert got == brute(ODD_ROWS)
    assert S.remove_repeats(odd_docs(spark, [])).count() == 0
    # A text in itself: the second half of the words repeats the first.
    rows = [(1, LONG + " " + LONG), (2, "other " * 3)]
    assert removed(S.remove_repeats(odd_docs(spark, rows))) == brute(rows)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), min_size=1, max_size=30), min_size=1, max_size=6), st.integers(1, 6))
def test_greedy_parse_finds_every_repeated_window(texts, window):
    count = np.array([len(t) for t in texts])
    code = np.array([x for t in texts for x in t])
    mask = S.repeated_windows(code, count, np.ones(len(texts), bool), window)
    seen = Counter(tuple(t[k:k + window]) for t in texts for k in range(len(t) - window + 1))
    want = [sum(1 << k for k in range(len(t) - window + 1) if seen[tuple(t[k:k + window])] > 1) for t in texts]
    assert mask.tolist() == want


def test_stretches_cover_every_window_once():
    rng = np.random.default_rng(1)
    count = np.array([0, 10, 34, 35, 36, 200, 3000])
    seq = S.mix64(rng.integers(0, 1 << 62, int(count.sum()), dtype=np.uint64))
    for size in S.anchor_sizes(35):
        h, text, start, windows = S.stretches(seq, count, 35, size)
        first = np.concatenate([[0], np.cumsum(count)])
        covered = np.concatenate([np.arange(a, a + n) for a, n in zip(start, windows)])
        want = np.concatenate([np.arange(first[k], first[k] + max(0, count[k] - 34)) for k in range(len(count))])
        assert covered.tolist() == want.tolist() and (windows <= 35 - size + 1).all()
        assert (text == np.searchsorted(first, start, "right") - 1).all()


@pytest.mark.parametrize("seed", range(4))
def test_ranges_are_the_words_of_all_marked_windows(seed):
    rng, window = np.random.default_rng(seed), 5
    marks = sorted((r, 62 * k, int(rng.integers(0, 1 << 62)) & int(rng.integers(0, 1 << 62)) & -int(rng.integers(0, 2)))
                   for r in range(20) for k in range(6) if rng.random() < 0.7)
    words = {(r, start + bit + k) for r, start, mask in marks for bit in range(62) if mask >> bit & 1 for k in range(window)}
    row, first, last = S.covered_ranges(*(np.array(c, np.int64) for c in zip(*marks)), window)
    ranges = list(zip(row.tolist(), first.tolist(), last.tolist()))
    assert [(r, w) for r, a, b in ranges for w in range(a, b + 1)] == sorted(words)
    assert all(a[0] < b[0] or a[2] + 1 < b[1] for a, b in zip(ranges, ranges[1:]))
    assert [len(c) for c in S.covered_ranges(*(np.zeros(0, np.int64),) * 3, window)] == [0, 0, 0]


def test_marks_of_many_rows_are_put_together_in_small_parts(spark, monkeypatch):
    """However few marks are put together at once, no document is cut, and no part is longer than a document needs."""
    parts, held, merge = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0), S.covered_ranges
    monkeypatch.setattr(S, "MARK_BYTES", 200)

    def seen(row, start, mask, window):
        parts.add(1)
        held.add(int(len(np.unique(row)) > 20))
        return merge(row, start, mask, window)

    monkeypatch.setattr(S, "covered_ranges", seen)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        rows = corpus(5)
        assert removed(S.remove_repeats(odd_docs(spark, rows))) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert parts.value > 8 and held.value == 0
