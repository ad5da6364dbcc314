import hashlib

import numpy as np
import pytest

from logsift.llm import decontaminate as D
from logsift.llm.decontaminate import FMIndex, compile_windows, decontaminate, drop_contaminated, suffix_array
from tests.llm.helpers import LONG, ODD_ROWS, odd_docs, words

ITEMS = [
    (1, "a b c d e f g h i j k l m n"), (2, "C D e f g h i j k l m n o"), (10, "one two"), (3, "word5 of5 word6 of6 word7 of7"),
    (None, "straße é"), (4, None), (5, ""), (6, "!!"), (7, "zero"), (2, "not anywhere in the texts"),
]


def brute(text, items, window=13):
    w = words(text)
    hit, found = set(), set()
    for item, t in items:
        own = words(t)
        n = min(window, len(own))
        for i in range(len(own) - n + 1 if own else 0):
            for k in range(len(w) - n + 1):
                if w[k:k + n] == own[i:i + n]:
                    hit.update(range(k, k + n))
                    found.add(item)
    ids = sorted(str(x) for x in found if x is not None)
    return (len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(),
            len(hit) > 0 and 20 * len(hit) >= len(w))


def items_df(spark, items=ITEMS):
    return spark.createDataFrame(items, "item_id long, text string")


def test_suffix_array_sorts_suffixes_with_separators_by_place():
    rng = np.random.default_rng(1)
    for _ in range(30):
        text = np.append(rng.integers(0, 4, rng.integers(1, 60)), 0)

        def key(i):
            out = []
            for k in range(i, len(text)):
                out.append((0, k) if text[k] == 0 else (1, int(text[k])))
                if text[k] == 0:
                    break
            return out

        assert suffix_array(text).tolist() == sorted(range(len(text)), key=key)


def test_index_finds_every_place():
    rng = np.random.default_rng(2)
    text = np.append(rng.integers(0, 6, 400), 0)
    text[text == 5] = 1
    index = FMIndex(text, sample=4)
    patterns = rng.integers(1, 5, (200, 3))
    lo, hi = index.search(patterns)
    for p, a, b in zip(patterns, lo, hi):
        places = [i for i in range(len(text) - 2) if (text[i:i + 3] == p).all()]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == places


@pytest.mark.parametrize("block_bytes", [1 << 20, 20])
def test_matches_brute_force_in_one_block_or_many(spark, block_bytes):
    rows = [(i, t) for i, t in ODD_ROWS if t is None or len(t) < 10_000]
    got = decontaminate(odd_docs(spark, rows), items_df(spark), block_bytes=block_bytes).collect()
    mine = sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got)
    assert mine == sorted((str(i), *brute(t, ITEMS)) for i, t in rows)
    for r in got:
        assert sum(s["last"] - s["first"] + 1 for s in r.spans) == r.n_hit


def test_long_text_and_removal_spans(spark):
    rows = odd_docs(spark, [(1, LONG), (2, "x One, two; y"), (3, None)])
    got = {r.doc_id: r for r in decontaminate(rows, items_df(spark), clean=True).collect()}
    assert got[1].n_words == 60_000 and got[1].n_hit == brute(LONG[:0], ITEMS)[1] + got[1].n_hit
    assert got[2].clean_text == "x ; y" and got[3].clean_text is None
    assert got[1].n_hit > 0 and not got[1].contaminated


def test_stage_drops_contaminated_rows_only(spark):
    docs = odd_docs(spark)
    kept = drop_contaminated(docs, items_df(spark))
    assert kept.columns == docs.columns
    assert sorted(repr(r.text) for r in kept.collect()) == sorted(repr(t) for _, t in ODD_ROWS if not brute(t if t is None or len(t) < 10_000 else t[:2000], ITEMS)[4] or (t and len(t) > 10_000))


def test_empty_tables(spark):
    docs = odd_docs(spark)
    assert decontaminate(odd_docs(spark, []), items_df(spark)).count() == 0
    none = decontaminate(docs, items_df(spark, [])).collect()
    assert len(none) == len(ODD_ROWS) and not any(r.n_hit for r in none)
    assert compile_windows([], []) == []


def test_repeated_benchmark_rows_are_collected_once(spark, monkeypatch):
    seen, compile_windows = [], D.compile_windows
    monkeypatch.setattr(D, "compile_windows", lambda ids, *rest: seen.extend(ids) or compile_windows(ids, *rest))
    benchmark = spark.createDataFrame([(1, "one two three")] * 200 + [(2, "four five")], "item_id long, text string")
    D.benchmark_blocks(benchmark, "item_id", "text", 13, 100)
    assert sorted(seen) == [1, 2]
