import itertools
import random
import zlib
from collections import Counter, defaultdict

from logsift.llm import sharding as S
from tests.llm.helpers import ODD_ROWS, odd_docs


def sums(sizes, shard, n):
    out = [0] * n
    for s, k in zip(sizes, shard):
        out[k] += s
    return out


def test_differencing_known_example():
    # Two-way differencing of 8, 7, 6, 5, 4 leaves a difference of 2.
    a, b = sums([8, 7, 6, 5, 4], S.differencing([8, 7, 6, 5, 4], 2), 2)
    assert abs(a - b) == 2 and a + b == 30


def test_differencing_is_near_the_best_split():
    rng = random.Random(4)
    for _ in range(20):
        sizes = [rng.randint(1, 50) for _ in range(8)]
        best = min(max(s) - min(s) for s in (sums(sizes, k, 3) for k in itertools.product(range(3), repeat=8)))
        mine = sums(sizes, S.differencing(sizes, 3), 3)
        assert sum(mine) == sum(sizes) and max(mine) - min(mine) <= best + max(sizes)
    many = [rng.randint(1, 5000) for _ in range(3000)]
    mine = sums(many, S.differencing(many), 16)
    assert max(mine) - min(mine) <= 5
    assert S.differencing([], 16) == [] and S.differencing([5], 16)[0] in range(16)


def check(got, rows, n=16):
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == sorted(
        (str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    slots = defaultdict(list)
    for r in got:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < n
        slots[r.shard].append(r.slot)
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    by_text = defaultdict(set)
    for r in got:
        by_text[(r.text_crc32, r.size)].add(r.shard)
    total = Counter()
    for r in got:
        total[r.shard] += r.size
    return by_text, total


def test_groups_stay_whole_and_bytes_balance(spark, monkeypatch):
    rng = random.Random(1)
    texts = ["t" * rng.randint(1, 400) + str(rng.randrange(10 ** 6)) for _ in range(3000)]
    rows = list(enumerate(texts + [texts[0]] * 300))
    for cell, block in ((50_000, 100_000), (100, 20)):
        monkeypatch.setattr(S, "CELL_GROUPS", cell)
        monkeypatch.setattr(S, "BLOCK_ROWS", block)
        by_text, total = check(S.shard_by_bytes(odd_docs(spark, rows, 6)).collect(), rows)
        assert all(len(s) == 1 for s in by_text.values())
        hot = (len(texts[0].encode()) + 1) * 301
        even = sum(total.values()) / 16
        assert max(total.values()) <= max(even, hot) * 1.02
    # The same rows in other partitions give the same shards.
    a = {r.doc_id: (r.shard, r.slot) for r in S.shard_by_bytes(odd_docs(spark, rows, 2)).collect()}
    b = {r.doc_id: (r.shard, r.slot) for r in S.shard_by_bytes(odd_docs(spark, rows, 9)).collect()}
    assert a == b


def test_odd_rows(spark):
    by_text, _ = check(S.shard_by_bytes(odd_docs(spark)).collect(), ODD_ROWS)
    assert S.shard_by_bytes(odd_docs(spark, [])).count() == 0
    assert len(S.shard_by_bytes(odd_docs(spark, [(1, None)])).collect()) == 1
