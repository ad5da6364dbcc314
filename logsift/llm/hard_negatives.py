"""Hard negatives by vertical scans with bounds (branch and bound on decomposed vectors).

Vectors are stored column-wise in blocks of bounded size: a block holds, for each
dimension, the quantised components of its rows and their smallest and largest.
An anchor reads a block's dimensions in descending magnitude of its own
components. What the dimensions still unread can add lies between the sums of
their smallest and largest contributions, so every row's score has a lower and
an upper bound. Rows whose bounds rule them out leave the candidate bitmap; the
scores of those that are left after the last dimension are exact.

Two scans are made. The first finds each anchor's best rows of its own label (its
positives): a row stays while its upper bound reaches the worst of the best lower
bounds. The second finds the best rows of other labels inside each positive's
window of scores: a row stays while its bounds meet some window and its upper
bound reaches the worst of the best rows that are surely inside.

Anchors are the stated query set. They go to the tasks in strips of bounded size
by broadcast, and a task keeps only the best few of each anchor, which Spark
merges. No pair is shuffled but these.

Defined cases: rows with a null id, a null label, a null vector or any null or
non-finite component take no part, nor do rows whose quantised vector has a
squared length of 2 ** 62 or more (its scores might not fit a long); vectors of
different length are not compared; empty vectors score 0; rows that repeat an id
are rows of their own, an anchor only leaves out itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logsift.llm.common import Sent
from logsift.session import persist

POSITIVES, NEGATIVES, SCALE = 5, 3, 256
# A negative's score lies between these hundredths of its positive's.
WINDOW = (50, 95)
# Bytes of a block's components, rows of a block, bytes of the anchors of a strip.
BLOCK_BYTES, BLOCK_ROWS, STRIP_BYTES = 4 << 20, 4096, 8 << 20
# Dimensions read between two looks at the bounds: few at first, more later.
STEPS = (6, 6, 8, 12, 16)
# Products of vectors below this squared length are exact in doubles.
_EXACT = 2.0 ** 52


def quantised(column: pa.Array, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix of floor(scale * component)) for every length of usable vectors."""
    size = np.asarray(pc.fill_null(pc.list_value_length(column), -1)).astype(np.int64)
    flat = np.asarray(pc.fill_null(column.flatten().cast(pa.float64()), float("nan")))
    first = np.cumsum(np.maximum(size, 0)) - np.maximum(size, 0)
    for dim in np.unique(size[size >= 0]).tolist():
        rows = np.flatnonzero(size == dim)
        values = np.floor(flat[first[rows][:, None] + np.arange(dim)] * scale)
        with np.errstate(invalid="ignore", over="ignore"):
            usable = np.isfinite(values).all(axis=1) & ((values * values).sum(axis=1) < 2.0 ** 62)
        yield rows[usable], values[usable].astype(np.int64)


_BLOCK = "block long, dim int, ids array<long>, labels array<string>, anchors array<boolean>, width int, columns binary"


def column_blocks(vectors: DataFrame, scale: int) -> DataFrame:
    """Blocks of the rows of (id, label, vector, anchor), dimension by dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for rows, matrix in quantised(batch.column("vector"), scale):
                dim = matrix.shape[1]
                step = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * max(dim, 1))))
                for lo in range(0, len(rows), step):
                    part, own = matrix[lo:lo + step], pa.array(rows[lo:lo + step])
                    top = int(np.abs(part).max(initial=0))
                    width = 2 if top < 1 << 15 else 4 if top < 1 << 31 else 8
                    columns = np.ascontiguousarray(part.T).astype(f"<i{width}").tobytes()
                    lists = [pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), batch.column(c).take(own))
                             for c in ("id", "label", "anchor")]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block], pa.int64()), pa.array([dim], pa.int32()), *lists, pa.array([width], pa.int32()),
                         pa.array([columns], pa.binary())], names=["block", "dim", "ids", "labels", "anchors", "width", "columns"])
                    block += 1

    return vectors.mapInArrow(run, _BLOCK)


class Block:
    """A block in a task: ``x`` (dimensions x rows) and its smallest and largest components."""

    def __init__(self, row: dict):
        self.number, self.dim = row["block"], row["dim"]
        self.ids = np.array(row["ids"], np.int64)
        self.labels = np.array(row["labels"], object)
        self.x = np.frombuffer(row["columns"], f"<i{row['width']}").reshape(self.dim, len(self.ids))
        self.least = self.x.min(axis=1).astype(np.float64) if self.dim else np.zeros(0)
        self.most = self.x.max(axis=1).astype(np.float64) if self.dim else np.zeros(0)
        wide = self.x.astype(np.float64)
        self.exact = float((wide * wide).sum(axis=0).max(initial=0)) < _EXACT

    def scan(self, query: np.ndarray, rows: np.ndarray, keep) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) that ``keep(lower, upper)`` never ruled out; its answer
        is a bitmap of the candidates it is shown."""
        order = np.argsort(-np.abs(query), kind="stable")
        q = query[order].astype(np.float64)
        low = np.minimum(q * self.least[order], q * self.most[order])
        high = np.maximum(q * self.least[order], q * self.most[order])
        # What is left to read from each place on; the slack covers rounding.
        slack = 1e-9 * np.abs(np.concatenate([low, high])).sum()
        low = np.append(np.cumsum(low[::-1])[::-1], 0.0) - slack
        high = np.append(np.cumsum(high[::-1])[::-1], 0.0) + slack
        exact = self.exact and float(q @ q) < _EXACT
        score = np.zeros(len(rows), np.float64 if exact else np.int64)
        weights = q if exact else query[order].astype(np.int64)
        at, steps = 0, iter(STEPS)
        while at < self.dim and len(rows):
            to = min(self.dim, at + next(steps, 32))
            part = self.x[order[at:to]]
            part = part if len(rows) == part.shape[1] else part[:, rows]
            score = score + weights[at:to] @ part.astype(score.dtype)
            at = to
            if at < self.dim:
                stay = keep(score + low[at], score + high[at])
                rows, score = rows[stay], score[stay]
        return rows, score.astype(np.int64)


def _worst_of_best(values: np.ndarray, k: int) -> float:
    """The k-th largest value, or minus infinity."""
    return float(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else -np.inf


def _merge(held: list, score: np.ndarray, ids: np.ndarray, k: int) -> list:
    """The best k of what is held and what is new: (score, id), high scores and small ids first."""
    if len(score) > k:
        worst = _worst_of_best(score, k)
        near = score >= worst
        score, ids = score[near], ids[near]
    return sorted([*held, *zip(score.tolist(), ids.tolist())], key=lambda x: (-x[0], x[1]))[:k]


def best_of_label(block: Block, query: np.ndarray, rows: np.ndarray, held: list, k: int) -> list:
    """``held`` (best k so far) with the block's rows among the given ones."""
    bar = held[-1][0] if len(held) == k else -np.inf

    def keep(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        return upper >= max(bar, _worst_of_best(lower, k))

    found, score = block.scan(query, rows, keep)
    return _merge(held, score, block.ids[found], k)


def best_in_windows(block: Block, query: np.ndarray, rows: np.ndarray, windows: list, held: list[list], k: int) -> list[list]:
    """For each window (low, high) of scores the best k rows inside, merged with ``held``."""
    bars = [h[-1][0] if len(h) == k else low for (low, _), h in zip(windows, held)]

    def keep(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        stay = np.zeros(len(lower), bool)
        for (low, high), bar in zip(windows, bars):
            sure = lower[(upper <= high) & (lower >= low)]
            stay |= (upper >= max(bar, _worst_of_best(sure, k))) & (lower <= high)
        return stay

    found, score = block.scan(query, rows, keep)
    out = []
    for (low, high), h in zip(windows, held):
        inside = (score >= low) & (score <= high)
        out.append(_merge(h, score[inside], block.ids[found[inside]], k))
    return out


def _anchors(blocks: DataFrame, strip_bytes: int) -> tuple[DataFrame, int]:
    """((block, place, anchor_id, label, vector, strip) of every anchor, strips)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                own = np.flatnonzero(np.array(row["anchors"], bool))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(own), block.number)), pa.array(own), pa.array(block.ids[own]),
                     pa.array(block.labels[own].tolist(), pa.string()),
                     pa.array([block.x[:, k].astype("<i8").tobytes() for k in own.tolist()], pa.binary())],
                    names=["block", "place", "anchor_id", "label", "vector"])

    found = persist(blocks.mapInArrow(run, "block long, place long, anchor_id long, label string, vector binary"), "negatives-anchors")
    size = found.agg(F.sum(F.octet_length("vector") + 64)).first()[0] or 0
    strips = max(1, -(-size // strip_bytes))
    return found.withColumn("strip", F.pmod(F.xxhash64("block", "place"), F.lit(strips)).cast("int")), strips


def _rows_of(block: Block, cache: dict, label: str, same: bool) -> np.ndarray:
    if (label, same) not in cache:
        cache[label, same] = np.flatnonzero((block.labels == label) == same)
    return cache[label, same]


def _first_scan(blocks: DataFrame, anchors: list, k: int) -> DataFrame:
    """Each task's best k rows of every anchor's label."""
    sent = Sent(blocks.sparkSession, [(r["block"], r["place"], r["label"], r["vector"]) for r in anchors])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = [(b, p, label, np.frombuffer(v, "<i8")) for b, p, label, v in sent.value]
        held: list[list] = [[] for _ in queries]
        for batch in batches:
            for row in batch.to_pylist():
                block, cache = Block(row), {}
                for n, (own, place, label, query) in enumerate(queries):
                    if len(query) != block.dim:
                        continue
                    rows = _rows_of(block, cache, label, True)
                    rows = rows[rows != place] if own == block.number else rows
                    if len(rows):
                        held[n] = best_of_label(block, query, rows, held[n], k)
        found = [(own, place, score, i) for (own, place, _, _), h in zip(queries, held) for score, i in h]
        columns = list(zip(*found)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["block", "place", "positive_score", "positive_id"])

    return blocks.mapInArrow(run, "block long, place long, positive_score long, positive_id long")


def _second_scan(blocks: DataFrame, anchors: list, positives: list, window: tuple[int, int], k: int) -> DataFrame:
    """Each task's best k rows of other labels in every positive's window."""
    wanted: dict[tuple, list] = {}
    for r in positives:
        low, high = -(-window[0] * r["positive_score"] // 100), window[1] * r["positive_score"] // 100
        if low <= high:
            wanted.setdefault((r["block"], r["place"]), []).append((r["nth"], low, high))
    sent = Sent(blocks.sparkSession, [(r["block"], r["place"], r["label"], r["vector"], wanted[r["block"], r["place"]])
                                      for r in anchors if (r["block"], r["place"]) in wanted])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = [(b, p, label, np.frombuffer(v, "<i8"), [n for n, _, _ in w], [x[1:] for x in w]) for b, p, label, v, w in sent.value]
        held: list[list] = [[[] for _ in q[5]] for q in queries]
        for batch in batches:
            for row in batch.to_pylist():
                block, cache = Block(row), {}
                for n, (_, _, label, query, _, windows) in enumerate(queries):
                    rows = _rows_of(block, cache, label, False) if len(query) == block.dim else ()
                    if len(rows):
                        held[n] = best_in_windows(block, query, rows, windows, held[n], k)
        found = [(q[0], q[1], nth, score, i) for q, h in zip(queries, held) for nth, best in zip(q[4], h) for score, i in best]
        columns = list(zip(*found)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                         names=["block", "place", "nth", "negative_score", "negative_id"])

    return blocks.mapInArrow(run, "block long, place long, nth long, negative_score long, negative_id long")


def _first_of(rows: DataFrame, keys: list[str], score: str, ident: str, k: int, name: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc(ident))
    return rows.withColumn(name, F.row_number().over(order)).filter(F.col(name) <= k)


def mine_hard_negatives(vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding",
                        label_col: str = "label", positives: int = POSITIVES, negatives: int = NEGATIVES, scale: int = SCALE,
                        window: tuple[int, int] = WINDOW, strip_bytes: int = STRIP_BYTES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score):
    the first negatives of every anchor and positive."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
                          F.col(vector_col).alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    blocks = persist(column_blocks(rows.filter("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL"), scale), "negatives-blocks")
    anchors, strips = _anchors(blocks, strip_bytes)
    parts = []
    for k in range(strips):
        strip = anchors.filter(F.col("strip") == k)
        own = strip.collect()  # about strip_bytes
        best = _first_of(_first_scan(blocks, own, positives), ["block", "place"], "positive_score", "positive_id", positives, "nth")
        best = persist(best.withColumn("nth", F.col("nth").cast("long")), "negatives-positives")
        found = _first_of(_second_scan(blocks, own, best.collect(), window, negatives),
                          ["block", "place", "nth"], "negative_score", "negative_id", negatives, "rank")
        named = best.join(strip.select("block", "place", "anchor_id"), ["block", "place"])
        parts.append(persist(named.join(found, ["block", "place", "nth"]).select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"), "negatives"))
    return reduce(DataFrame.unionByName, parts)
