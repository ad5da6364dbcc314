import hashlib
from collections import Counter

import public_tokenizers
import pyarrow as pa
import pytest

from logsift.llm import token_alignment as T
from tests.llm.helpers import ODD_ROWS, odd_docs

BYTE_BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["a▁b", "<|endoftext|> x", "x<|endoftext|>", "<|endoftext|>", "é日本語 🙂 x", "a  b\n\n c ", "<0x41> <s> </s><unk>", "it's  The\tend ",
         "\x00zero", "plain words of a text that repeats words of a text", "ﬁ ½ ÅÅ", "x" * 300, " lead"]


@pytest.fixture(scope="module")
def pair():
    with open(BYTE_BPE, encoding="utf-8") as a, open(PIECES, "rb") as b:
        return T.Pair(a.read(), b.read())


def brute(pair, text):
    """(ids, ids, links, groups) token by token, or None."""
    if not text:
        return None
    a, b = pair.a.plain.encode(" " + text, add_special_tokens=False).ids, pair.b.encode(text)
    raw = (" " + text).encode()
    ends = []
    for ids, table in ((a, pair.bytes_a), (b, pair.bytes_b)):
        parts = [table[i].as_py() for i in ids]
        if b"".join(parts) != raw:
            return None
        ends.append([sum(map(len, parts[:k + 1])) for k in range(len(parts))])
    starts = [[0, *e[:-1]] for e in ends]
    links = [(a[i], b[j]) for i in range(len(a)) for j in range(len(b)) if starts[0][i] < ends[1][j] and starts[1][j] < ends[0][i]]
    groups, at = [], 0
    for cut in sorted(set(ends[0]) & set(ends[1])):
        groups.append("|".join(",".join(str(x) for x, e in zip(ids, e_) if at < e <= cut) for ids, e_ in zip((a, b), ends)))
        at = cut
    return a, b, links, groups


def want(pair, texts):
    found = [brute(pair, t) for t in texts]
    many = Counter(x for f in found if f for x in f[2])
    most = {}
    for (_, b), n in many.items():
        most[b] = max(n, most.get(b, 0))
    return [(0, 0, 0, 0, 0, 0, "") if f is None else
            (len(f[0]), len(f[1]), len(f[3]), len(f[2]), sum(many[x] == most[x[1]] for x in f[2]), sum(many[x] for x in f[2]),
             hashlib.sha256(";".join(f[3]).encode()).hexdigest()) for f in found]


def rows_of(df):
    return [(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()]


@pytest.mark.parametrize("heavy", [T.HEAVY, 0.02, 2.0])
def test_matches_token_by_token(spark, pair, heavy):
    # A share of 2 sends every pair through the join, one of 0.02 a part of them.
    texts = TEXTS + [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(12).collect()]
    texts = [t[:400] for t in texts]
    got = rows_of(T.align_tokens(odd_docs(spark, list(enumerate(texts))), BYTE_BPE, PIECES, heavy=heavy))
    assert sorted(got) == [(i, *w) for i, w in enumerate(want(pair, texts))]


def test_groups_as_strings(spark, pair):
    got = {r.doc_id: r for r in T.align_tokens(odd_docs(spark, list(enumerate(TEXTS))), BYTE_BPE, PIECES, strings=True).collect()}
    for i, text in enumerate(TEXTS):
        found = brute(pair, text)
        assert got[i].groups == (";".join(found[3]) if found else "")


def test_texts_that_tokens_do_not_give_back_have_none(spark):
    got = rows_of(T.align_tokens(odd_docs(spark, [(0, "a▁b"), (1, None), (2, ""), (3, "ok")]), BYTE_BPE, PIECES))
    assert {r[0]: r[1:5] for r in got if r[0] != 3} == {i: (0, 0, 0, 0) for i in range(3)} and all(r[7] == "" for r in got if r[0] != 3)
    assert [r for r in got if r[0] == 3][0][1] > 0


def test_odd_rows_and_empty_tables(spark, pair):
    got = rows_of(T.align_tokens(odd_docs(spark), BYTE_BPE, PIECES))
    assert len(got) == len(ODD_ROWS)
    # Rows that repeat an id are aligned one by one; a null id is carried.
    assert sum(r[0] == 6 for r in got) == 2 and sum(r[0] is None for r in got) == 1
    by_id = {r[0]: r for r in got}
    for i, text in ODD_ROWS:
        if text is not None and len(text) < 200 and i not in (4, 6, None):
            found = brute(pair, text)
            assert by_id[i][1:5] == ((len(found[0]), len(found[1]), len(found[3]), len(found[2])) if found else (0, 0, 0, 0))
    # The long texts, checked by their counts.
    assert by_id[10][1] == len(pair.a.plain.encode(" " + dict(ODD_ROWS[:12])[10], add_special_tokens=False).ids)
    assert T.align_tokens(odd_docs(spark, []), BYTE_BPE, PIECES).count() == 0


def test_ends_join_on_document_and_byte():
    a = T._lists([0, 1, 0], [0, 2, 3])
    b = T._lists([0, 0, 0], [0, 1, 3])
    # Document 0: widths 1 + 2 against 3; document 1: 1 (and one byte more on the other side is not tried).
    found = T.align(a, T._lists([0, 1], [0, 1, 2]), pa.array([1, 2]), pa.array([3, 1])).to_pydict()
    assert found["doc"] == [0, 0, 1] and found["a"] == [0, 1, 0] and found["b"] == [0, 0, 1]
    assert found["end_a"] == [True, True, True] and found["end_b"] == [False, True, True]
    assert len(b) == 2
