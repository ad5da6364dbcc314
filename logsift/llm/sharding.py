"""Byte-balanced sharding by Karmarkar-Karp differencing.

Rows with equal texts are one indivisible group. Groups are dealt to cells by
their hash. Inside a cell every group starts as a partial partition with its
bytes on one shard; the two partial partitions of largest spread are combined
over and over, the larger sums of one meeting the smaller of the other, until
one is left. The subsets of all cells are then differenced in the same way,
together with the groups that hold over a thousandth of the rows or bytes (a
bounded number), so a huge group does not unbalance its cell. The driver sees
``shards`` sums per cell and the huge groups only.

Slots are numbered without gaps by counting rows per shard and block of ids
first and ranking inside a block, so no task holds a whole shard.

Defined cases: a null text has size 1 and crc32 0, and null texts are one group
apart from the empty text; null ids sort first; repeated rows get slots of their own; an empty
table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logsift.llm.common import join_classes, whole_groups
from logsift.session import persist

SHARDS = 16
# Groups differenced together in one task, fewest cells (so that their subsets are small
# against a shard), and rows of a block of slots.
CELL_GROUPS, LEAST_CELLS, BLOCK_ROWS = 200_000, 64, 100_000


def differencing(sizes: list[int], shards: int = SHARDS) -> list[int]:
    """The shard of each item. Combines the partial partitions of largest spread."""
    if not sizes:
        return []
    # (−spread, tie-break, sums in falling order, for each sum the items or pairs of parts under it)
    heap = []
    for k, size in enumerate(sizes):
        heap.append((-size, k, (size,) + (0,) * (shards - 1), ((k,),) + (None,) * (shards - 1)))
    heapq.heapify(heap)
    number = len(sizes)
    while len(heap) > 1:
        _, _, a, parts_a = heapq.heappop(heap)
        _, _, b, parts_b = heapq.heappop(heap)
        merged = sorted(((x + y, p, q) for x, y, p, q in zip(a, reversed(b), parts_a, reversed(parts_b))),
                        key=lambda s: s[0], reverse=True)
        low = merged[-1][0]
        sums = tuple(s[0] for s in merged)
        parts = tuple((p, q) if p is not None and q is not None else (p if p is not None else q) for _, p, q in merged)
        heapq.heappush(heap, (low - sums[0], number, sums, parts))
        number += 1
    shard = [0] * len(sizes)
    for k, tree in enumerate(heap[0][3]):
        stack = [tree] if tree is not None else []
        while stack:
            node = stack.pop()
            if len(node) == 1:
                shard[node[0]] = k
            else:
                stack.extend(node)
    return shard


def _cell_partitions(groups: DataFrame, shards: int) -> DataFrame:
    """(key, weight, bytes, cell, part): the subset of its cell that each group joins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "cell"):
            cell = table.column("cell").to_numpy()
            size = table.column("bytes").to_numpy()
            part = np.zeros(len(cell), np.int32)
            edges = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
            for lo, hi in zip(edges.tolist(), [*edges[1:].tolist(), len(cell)]):
                part[lo:hi] = differencing(size[lo:hi].tolist(), shards)
            yield from table.append_column("part", pa.array(part)).combine_chunks().to_batches()

    # Rows arrive in one order whatever the shuffle did.
    return groups.repartition(F.col("cell")).sortWithinPartitions("cell", "key").mapInArrow(
        run, "key string, weight long, bytes long, cell long, part int")


def assign(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(key, weight, shard) of every group of ``rows`` (key, size)."""
    groups = persist(rows.groupBy("key").agg(F.count("*").alias("weight"), F.sum("size").alias("bytes")), "shard-groups")
    n_groups, n_rows, n_bytes = groups.agg(F.count("*"), F.sum("weight"), F.sum("bytes")).first()
    cells = max(LEAST_CELLS, -(-n_groups // CELL_GROUPS))
    huge = (F.col("weight") * 1000 > (n_rows or 0)) | (F.col("bytes") * 1000 > (n_bytes or 0))
    big = groups.filter(huge).orderBy("key").collect() if n_groups else []  # under 2000 by the shares
    usual = groups.filter(~huge).withColumn("cell", F.pmod(F.xxhash64("key"), F.lit(cells)).cast("long"))
    placed = persist(_cell_partitions(usual, shards), "shard-cells")
    parts = placed.groupBy("cell", "part").agg(F.sum("bytes").alias("bytes")).orderBy("cell", "part").collect()
    found = differencing([r["bytes"] for r in parts] + [r["bytes"] for r in big], shards)
    spark = rows.sparkSession
    of_part = spark.createDataFrame([(r["cell"], r["part"], s) for r, s in zip(parts, found)], "cell long, part int, shard int")
    of_big = spark.createDataFrame([(r["key"], r["weight"], s) for r, s in zip(big, found[len(parts):])], "key string, weight long, shard int")
    return placed.join(F.broadcast(of_part), ["cell", "part"]).select("key", "weight", "shard").union(of_big)


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, size, text_crc32, law, shard, slot, grown_shard."""
    text = F.col(text_col)
    rows = persist(docs.select(
        F.col(id_col).alias("id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("crc"),
        F.coalesce(F.sha2(text, 256), F.lit("null")).alias("key")), "shard-rows")
    total = rows.count()
    groups = persist(assign(rows, shards), "shard-assigned")
    blocks = max(1, -(-total // (shards * BLOCK_ROWS)))
    placed = persist(join_classes(rows, groups, "key", "weight", total).withColumn(
        "block", F.pmod(F.xxhash64("id", "key"), F.lit(blocks))), "shard-placed")
    # Slots before each block of a shard: one row for each of them.
    many = placed.groupBy("shard", "block").agg(F.count("*").alias("many"))
    before = many.withColumn("before", F.sum("many").over(
        Window.partitionBy("shard").orderBy("block")) - F.col("many")).drop("many")
    rank = F.row_number().over(Window.partitionBy("shard", "block").orderBy("id", "key")) - 1
    return placed.withColumn("rank", rank).join(before, ["shard", "block"]).select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
        (F.col("rank") + F.col("before")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
