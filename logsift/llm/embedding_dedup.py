"""Embedding near-duplicates by random-hyperplane sign hashing.

Equal vectors are one class from the start. Every class gets a bucket in each of
several tables: the signs of its products with the table's random hyperplanes.
Bits per table grow with the logarithm of the number of classes, so a bucket of
unrelated vectors keeps its size; the number of tables follows from the target
recall at the similarity.

Vectors are not sent to every table. First a class sends its number and a short
sketch (signs of further hyperplanes) to each of its buckets, where sketches at a
distance that a pair of the similarity exceeds once in a million form a forest of
candidates. Connected components join the forests. Then each vector in a
component of up to ``COMPONENT`` classes goes to its component, once, and all
cosines there are computed in double precision and checked exactly. Vectors in a
larger component go to their buckets: a pair that shares several tables is
counted in the first of them only, so the work of a vector stays bounded by its
buckets however far candidates chain. Both ways give link counts and a forest,
never pairs. A bucket of very many classes is cut into blocks, and each pair of
blocks is a piece of work of its own.

Defined cases: null, empty and zero vectors and vectors with null or non-finite
components link with nothing; vectors of different length are never similar;
rows without an id link with nothing; rows that repeat an id count as further
vectors, each with the links of its own vector.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsift.llm.common import join_classes, mix64, whole_groups
from logsift.llm.components import connected_components, local_roots
from logsift.session import persist

SIMILARITY = 0.9
RECALL = 0.9999
# Unrelated vectors expected in a bucket, vectors of a block in a bucket that holds more (whatever
# the size of the input), and rows of a cell compared at once.
BUCKET, BLOCK, STRIP = 512, 2000, 1024
# Words of 64 signs in a sketch, the share of pairs of the similarity that its limit may miss, and
# the classes of a candidate component that are compared in one cell.
SKETCH, MISSED, COMPONENT = 3, 1e-6, 2000


def tables_for(n: int, similarity: float = SIMILARITY, recall: float = RECALL) -> tuple[int, int]:
    """(bits of a table, tables) for n vectors."""
    bits = min(30, max(4, math.ceil(math.log2(max(n, 1) / BUCKET))) if n > BUCKET else 4)
    same = (1 - math.acos(similarity) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - same))


def vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, offsets, usable) of a list column; unusable rows are empty."""
    size = np.asarray(pc.fill_null(pc.list_value_length(column), 0)).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(size)])
    flat = pc.fill_null(column.flatten().cast(pa.float64()), float("nan"))
    values = np.asarray(flat)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    some = np.concatenate([[0], np.cumsum(values != 0)])
    usable = (bad[offsets[1:]] == bad[offsets[:-1]]) & (some[offsets[1:]] > some[offsets[:-1]])
    return values, offsets, usable


def unit_rows(values: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, first by their largest component so that nothing overflows."""
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.sqrt((values * values).sum(axis=1, keepdims=True))


def signatures(unit: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """A bucket number per row and table. The planes depend on the seed and the length only."""
    planes = np.random.default_rng([11, unit.shape[1]]).standard_normal((unit.shape[1], tables * bits))
    signs = (unit @ planes > 0).reshape(len(unit), tables, bits)
    return (signs << np.arange(bits)).sum(axis=2).astype(np.uint32)


def sketches(unit: np.ndarray) -> np.ndarray:
    """``SKETCH`` words of signs a row, by planes that no table uses."""
    planes = np.random.default_rng([12, unit.shape[1]]).standard_normal((unit.shape[1], 64 * SKETCH))
    return np.packbits(unit @ planes > 0, axis=1).view(np.uint64)


def sketch_limit(similarity: float = SIMILARITY, missed: float = MISSED) -> int:
    """The smallest distance of sketches that at most a share ``missed`` of the
    pairs at the similarity exceeds (each sign differs with angle / pi)."""
    n, p = 64 * SKETCH, math.acos(similarity) / math.pi
    over = 1.0
    for far in range(n + 1):
        over -= math.comb(n, far) * p ** far * (1 - p) ** (n - far)
        if over <= missed:
            return far
    return n


def sketch_forest(words: np.ndarray, side: np.ndarray, limit: int) -> np.ndarray:
    """The smallest row that each row reaches by sketches within ``limit``; of two
    sides only by pairs across."""
    n = len(words)
    root, every = np.arange(n), np.arange(n)
    for lo in range(0, n, STRIP):
        far = np.zeros((min(STRIP, n - lo), n - lo), np.uint16)
        for w in range(words.shape[1]):
            far += np.bitwise_count(words[lo:lo + STRIP, None, w] ^ words[None, lo:, w])
        close = np.triu(far <= limit, 1)
        if side[0] >= 0:
            close &= side[lo:lo + STRIP, None] != side[None, lo:]
        # One link a row first; then only pairs that these have not joined.
        a = np.flatnonzero(close.any(axis=1))
        b = close[a].argmax(axis=1)
        while len(a):
            root = local_roots(n, np.concatenate([every, a + lo]), np.concatenate([root, b + lo]))
            close &= root[lo:lo + STRIP, None] != root[None, lo:]
            a = np.flatnonzero(close.any(axis=1))
            b = close[a].argmax(axis=1)
    return root


def _classes(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, k1, k2, vec): the key of each usable vector and its packed components; null keys otherwise."""
    packed = component_type(rows, vector_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values, at, usable = vectors(batch.column(vector_col))
            values = (values + 0.0).astype(packed)  # -0.0 and 0.0 are the same component
            raw = [values[a:b].tobytes() if u else None for a, b, u in zip(at[:-1].tolist(), at[1:].tolist(), usable.tolist())]
            key = np.frombuffer(b"".join(hashlib.blake2b(r or b"", digest_size=16).digest() for r in raw), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), pa.array(key[:, 0], mask=~usable), pa.array(key[:, 1], mask=~usable), pa.array(raw, pa.binary())],
                names=["id", "k1", "k2", "vec"])

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.select(id_col, vector_col).mapInArrow(run, f"id {kind}, k1 long, k2 long, vec binary")


def component_type(rows: DataFrame, vector_col: str) -> np.dtype:
    """Single precision only where the column has it, so that packing loses nothing."""
    return np.dtype(np.float32 if rows.schema[vector_col].dataType.elementType.typeName() == "float" else np.float64)


def unpack(raw: list[bytes], packed: np.dtype) -> np.ndarray:
    """Packed vectors of equal length as rows of doubles."""
    return np.frombuffer(b"".join(raw), packed).reshape(len(raw), -1).astype(np.float64)


def _by_length(column: pa.Array, packed: np.dtype) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) for every vector length in a column of packed vectors."""
    raw = column.to_pylist()
    size = np.array([len(r) for r in raw], np.int64)
    for d in np.unique(size):
        rows = np.flatnonzero(size == d)
        yield rows, unpack([raw[k] for k in rows.tolist()], packed)


def _cells(classes: DataFrame, packed: np.dtype, bits: int, tables: int, payload: str) -> DataFrame:
    """(cell, side, t, node) of every class in every table with its sketch words
    (``payload`` "sketch") or with w, sig, vec ("vector"); (node, t, cell) alone
    for "count". ``wide`` of a class: (t, blocks) of its buckets with too many
    classes. The side is the row's block in a cell of two blocks, else -1."""
    words = [f"s{k}" for k in range(SKETCH)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in _by_length(batch.column("vec"), packed) if batch.num_rows else ():
                unit = unit_rows(x)
                sig = signatures(unit, bits, tables)
                base = mix64(np.uint64(x.shape[1]) * np.uint64(1_000_003) + np.arange(tables, dtype=np.uint64) + np.uint64(1))
                cell = mix64(base[None, :] + sig.astype(np.uint64)).view(np.int64).ravel()
                row = np.repeat(np.arange(len(rows)), tables)
                table = np.tile(np.arange(tables), len(rows))
                part = batch.take(pa.array(rows))
                node = part.column("node").to_numpy()
                if payload == "count":
                    for lo in range(0, len(row), 65536):
                        own = slice(lo, lo + 65536)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(node[row[own]]), pa.array(table[own].astype(np.int32)), pa.array(cell[own])], names=["node", "t", "cell"])
                    continue
                side = np.full(len(row), -1, np.int32)
                blocks = np.ones((len(rows), tables), np.int64)
                for k, found in enumerate(part.column("wide").to_pylist()):
                    for w in found or ():
                        blocks[k, w["t"]] = w["blocks"]
                blocks = blocks.ravel()
                plain = blocks == 1
                out = [(row[plain], table[plain], cell[plain], side[plain])]
                for c in np.unique(cell[~plain]).tolist():
                    here = np.flatnonzero(cell == c)
                    count = int(blocks[here[0]])
                    block = (mix64(node[row[here]].view(np.uint64)) % np.uint64(count)).astype(np.int32)
                    for other in range(count):
                        low, high = np.minimum(block, other), np.maximum(block, other)
                        own = mix64(np.int64(c).view(np.uint64) ^ mix64((low.astype(np.uint64) << np.uint64(32)) + high.astype(np.uint64) + np.uint64(1)))
                        out.append((row[here], table[here], own.view(np.int64), np.where(low == high, np.int32(-1), block)))
                row, table, cell, side = (np.concatenate(c) for c in zip(*out))
                if payload == "sketch":
                    signs = sketches(unit).view(np.int64)
                    for lo in range(0, len(row), 65536):
                        own = slice(lo, lo + 65536)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(cell[own]), pa.array(side[own]), pa.array(node[row[own]]), *[pa.array(c) for c in signs[row[own]].T]],
                            names=["cell", "side", "node", *words])
                    continue
                raw_sig = [s.tobytes() for s in sig.astype(signature_type(bits))]
                for lo in range(0, len(row), 8192):
                    take = pa.array(row[lo:lo + 8192])
                    own = part.take(take)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cell[lo:lo + 8192]), pa.array(side[lo:lo + 8192]), pa.array(table[lo:lo + 8192].astype(np.int32)),
                         own.column("node"), own.column("w"), pa.array([raw_sig[k] for k in take.to_pylist()], pa.binary()), own.column("vec")],
                        names=["cell", "side", "t", "node", "w", "sig", "vec"])

    if payload == "count":
        return classes.select("node", "vec").mapInArrow(run, "node long, t int, cell long")
    schema = {"sketch": "cell long, side int, node long, " + ", ".join(f"{w} long" for w in words),
              "vector": "cell long, side int, t int, node long, w long, sig binary, vec binary"}[payload]
    return classes.select("node", "w", "vec", "wide").mapInArrow(run, schema)


def cell_links(x: np.ndarray, sig: np.ndarray, table: int, side: np.ndarray, weight: np.ndarray,
               similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """(links, root) of each row by the pairs with cosine >= ``similarity`` that
    share no earlier table; of two sides only pairs across. Pairs are summed
    strip by strip and never held for the whole cell."""
    n = len(x)
    unit, norm = unit_rows(x), np.sqrt((x * x).sum(axis=1))
    many, root, every = np.zeros(n), np.arange(n), np.arange(n)
    for lo in range(0, n, STRIP):
        close = unit[lo:lo + STRIP] @ unit[lo:].T >= similarity - 1e-9
        if side[0] >= 0:
            close &= side[lo:lo + STRIP, None] != side[None, lo:]
        a, b = np.nonzero(np.triu(close, 1))
        # Exact check, as dot(a, b) / (|a| |b|).
        for at in range(0, len(a), 100_000):
            i, j = a[at:at + 100_000] + lo, b[at:at + 100_000] + lo
            exact = (x[i] * x[j]).sum(axis=1) / (norm[i] * norm[j])
            exact = np.where(np.isfinite(exact), exact, (unit[i] * unit[j]).sum(axis=1))
            on = (exact >= similarity) & ~(sig[i, :table] == sig[j, :table]).any(axis=1)
            i, j = i[on], j[on]
            if len(i):
                many += np.bincount(i, weight[j], n) + np.bincount(j, weight[i], n)
                # Pairs that the forest joins already add nothing to it.
                new = root[i] != root[j]
                if new.any():
                    root = local_roots(n, np.concatenate([every, i[new]]), np.concatenate([root, j[new]]))
    return many, root


def signature_type(bits: int) -> np.dtype:
    return np.dtype(np.uint16 if bits <= 16 else np.uint32)


def _edges(key: np.ndarray) -> list[tuple[int, int]]:
    """(from, to) of the runs of equal keys with two rows or more."""
    edges = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])).tolist()
    return [(lo, hi) for lo, hi in zip(edges, [*edges[1:], len(key)]) if hi - lo > 1]


def bucketed(classes: DataFrame, packed: np.dtype, bits: int, tables: int, payload: str) -> DataFrame:
    """The rows of ``_cells``, cells together."""
    light = _cells(classes, packed, bits, tables, "count")
    wide = persist(light.groupBy("cell").count().filter(F.col("count") > BLOCK), "vector-wide")
    if wide.isEmpty():
        known = classes.withColumn("wide", F.lit(None).cast("array<struct<t:int,blocks:long>>"))
    else:
        # Each class learns the blocks of its wide buckets, however many of those there are.
        own = join_classes(light, wide, "cell", "count", classes.count() * tables).groupBy("node").agg(
            F.collect_list(F.struct("t", F.ceil(F.col("count") / BLOCK).alias("blocks"))).alias("wide"))
        known = classes.join(own, "node", "left")
    return _cells(known, packed, bits, tables, payload).repartition(F.col("cell")).sortWithinPartitions("cell")


def candidates(classes: DataFrame, packed: np.dtype, bits: int, tables: int, similarity: float) -> DataFrame:
    """(u, v): a forest over classes whose sketches are near each other in a bucket."""
    limit, words = sketch_limit(similarity), [f"s{k}" for k in range(SKETCH)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "cell"):
            cell, side, node = (table.column(c).to_numpy() for c in ("cell", "side", "node"))
            signs = np.stack([table.column(w).to_numpy() for w in words], axis=1).view(np.uint64)
            root = np.arange(len(cell))
            for lo, hi in _edges(cell):
                root[lo:hi] = lo + sketch_forest(signs[lo:hi], side[lo:hi], limit)
            on = np.flatnonzero(root != np.arange(len(cell)))
            yield pa.RecordBatch.from_arrays([pa.array(node[on]), pa.array(node[root[on]])], names=["u", "v"])

    return bucketed(classes, packed, bits, tables, "sketch").mapInArrow(run, "u long, v long")


def component_links(members: DataFrame, packed: np.dtype, similarity: float) -> DataFrame:
    """(node, root, links) of the classes in components that fit one cell each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "component"):
            component, node, w = (table.column(c).to_numpy() for c in ("component", "node", "w"))
            raw = table.column("vec").to_pylist()
            out: list[list] = [[], [], []]
            for lo, hi in _edges(component):
                n = hi - lo
                many, root = cell_links(unpack(raw[lo:hi], packed), np.zeros((n, 0), np.uint16), 0, np.full(n, -1), w[lo:hi], similarity)
                on = np.flatnonzero(many)
                for column, v in zip(out, (node[lo:hi][on], node[lo:hi][root[on]], many[on].astype(np.int64))):
                    column.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c) if c else np.zeros(0, np.int64)) for c in out], names=["node", "root", "links"])

    return (members.repartition(F.col("component")).sortWithinPartitions("component", "node")
            .mapInArrow(run, "node long, root long, links long"))


def links(classes: DataFrame, packed: np.dtype, bits: int, tables: int, similarity: float) -> DataFrame:
    """(node, root, links) rows, by buckets: link counts to be summed by node, and a forest."""
    cells = bucketed(classes, packed, bits, tables, "vector")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "cell"):
            cell, side, t, node, w = (table.column(c).to_numpy() for c in ("cell", "side", "t", "node", "w"))
            sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), signature_type(bits)).reshape(len(cell), -1)
            raw = table.column("vec").to_pylist()
            out: list[list] = [[], [], []]
            for lo, hi in _edges(cell):
                many, root = cell_links(unpack(raw[lo:hi], packed), sig[lo:hi], int(t[lo]), side[lo:hi], w[lo:hi], similarity)
                on = np.flatnonzero(many)
                for column, v in zip(out, (node[lo:hi][on], node[lo:hi][root[on]], many[on].astype(np.int64))):
                    column.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c) if c else np.zeros(0, np.int64)) for c in out], names=["node", "root", "links"])

    return cells.mapInArrow(run, "node long, root long, links long")


def embedding_dedup(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """Per row: id, n_links, component_id (smallest id reachable by links), kept."""
    packed = component_type(rows, vector_col)
    keyed = persist(_classes(rows, id_col, vector_col), "vectors")
    usable = keyed.filter(F.col("k1").isNotNull() & F.col("id").isNotNull())
    # Classes are known by 128 bits of their vector; the written table numbers them.
    classes = persist(usable.groupBy("k1", "k2").agg(
        F.min(F.col("id").cast("long")).alias("low"), F.count("*").alias("w"), F.first("vec").alias("vec"))
        .withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    n = classes.count()
    bits, tables = tables_for(n, similarity, recall)
    near = persist(connected_components(persist(candidates(classes, packed, bits, tables, similarity), "vector-candidates")), "vector-components")
    members = persist(join_classes(near, near.groupBy("component").count(), "component", "count", n), "vector-members")
    vectors_of = classes.select("node", "w", "vec")
    inside = vectors_of.join(members.filter(F.col("count") <= COMPONENT).select("node", "component"), "node")
    found = persist(component_links(inside, packed, similarity), "vector-links")
    # Such a component holds all links of its classes, so its roots are final.
    part_of, counted = found.select("node", F.col("root").alias("component")), found.select("node", "links")
    beyond = members.filter(F.col("count") > COMPONENT).select("node")
    if not beyond.isEmpty():
        more = persist(links(vectors_of.join(beyond, "node"), packed, bits, tables, similarity), "vector-links")
        part_of = part_of.unionByName(connected_components(more.select(F.col("node").alias("u"), F.col("root").alias("v"))))
        counted = counted.unionByName(more.groupBy("node").agg(F.sum("links").alias("links")))
    linked = persist(classes.select("node", "low").join(part_of, "node").join(counted, "node"), "vector-linked")
    lows = linked.groupBy("component").agg(F.min("low").alias("component_id"), F.count("*").alias("count"))
    named = join_classes(linked.select("node", "component", "links"), lows, "component", "count", n).select("node", "component_id", "links")
    result = persist(
        classes.select("k1", "k2", "low", "w", "node").join(named, "node", "left")
        .select("k1", "k2", "w", F.coalesce("component_id", "low").alias("component_id"),
                (F.coalesce("links", F.lit(0)) + F.col("w") - 1).alias("n_links")), "vector-result")
    joined = join_classes(usable.select("id", "k1", "k2"), result, ["k1", "k2"], "w", keyed.count())
    alone = keyed.filter(F.col("k1").isNull() | F.col("id").isNull())
    return joined.select(F.col("id").alias(id_col), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept")).unionByName(
        alone.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").cast("long").alias("component_id"),
                     F.lit(True).alias("kept")))
