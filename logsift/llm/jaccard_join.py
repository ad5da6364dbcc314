"""N-gram Jaccard join by chosen paths.

A document is its set of hashed five-word shingles. Sets are embedded as the
minima of independent hashes (``TOKENS`` tokens each). A run hashes every token
of a set with the path walked so far; tokens below a threshold are chosen and
each extends the path, so similar sets keep meeting on shared tokens while the
buckets shrink. Buckets under ``SMALL`` sets are compared by brute force, larger
ones are split again inside their task, and paths that hold very many sets are
split before any shuffle. Runs are independent; their number follows from the
target recall.

Compared sets whose embeddings agree enough are candidates. Candidate pairs are
not emitted: a bucket gives a forest, and connected components gather what has
to be verified. Inside a component all pairs are checked exactly on the whole
shingle sets by sparse counting and block matrix products. Large components
are cut into blocks, and each pair of blocks is a task's work. The work on g
different near copies is therefore g * g / 2 comparisons, as exact link counts
need, but neither rows nor memory of a task grow with it.

Equal word sequences are one class from the start; copies are never expanded.
A class is known by the key of its words, never by an id: rows that repeat an id
with other words are other documents.

Defined cases: fewer than five words, but not none, are one shingle; null and
wordless texts link with nothing; rows with a null id link with nothing; rows
that repeat an id are all reported; the smallest id of a group is kept (the
stage keeps one document of a group, of those with its smallest id the one with
the smallest key).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from logsift.llm.common import Sent, Words, chunks, join_classes, mix64, text_bytes, whole_groups
from logsift.llm.components import connected_components, local_roots
from logsift.session import persist

SHINGLE = 5
SIMILARITY = Fraction(4, 5)
RECALL = 0.9999
TOKENS = 64
# Expected choices per level and set; above 1 for shared tokens, so that paths survive.
BRANCHING = 1.6
DEPTH = 4
# A bucket of at most so many sets is compared pair by pair.
SMALL = 300
# A path with at least so many sets is split before the shuffle. At most 1 / HOT_SHARE paths are
# (32 MB of them): with more than 16e9 rows of paths the bound rises, and larger cells are split in their tasks.
HOT_SETS, HOT_SHARE = 4000, 2.5e-7
# Sets of one block of a bucket that is still hot at full depth (4 MB of tokens).
CELL_SETS = 32_000
# Pairs of a bucket looked at together, and of them compared together.
PAIRS, COMPARED = 400_000, 50_000
# Embeddings that agree in fewer tokens belong to sets below the similarity
# (four standard deviations under the expected agreement).
AGREE = int(TOKENS * (float(SIMILARITY) - 4 * math.sqrt(float(SIMILARITY) * (1 - float(SIMILARITY)) / TOKENS)))
# Verification cells: shingles and sets of a block, bytes of representatives sent by broadcast.
BLOCK_SHINGLES, BLOCK_SETS = 2_000_000, 1000
BROADCAST_BYTES = 64 << 20

_ODD = (np.random.default_rng(5).integers(1, 1 << 62, 2 * TOKENS + SHINGLE, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_CHOSEN = np.uint64(int(BRANCHING / (float(SIMILARITY) * TOKENS) * 2 ** 64))


def runs_for(recall: float = RECALL) -> int:
    """Runs needed so that a pair at the similarity meets with this probability.
    Of the tokens chosen on a level, BRANCHING are shared on average; a path
    survives if some shared choice does."""
    survives = 1.0
    for _ in range(DEPTH):
        survives = 1 - math.exp(-BRANCHING * survives)
    return math.ceil(math.log(1 - recall) / math.log(1 - survives))


def word_keys(buf: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray, np.ndarray]:
    """(words, their hashes, two longs that are the key of each text's word
    sequence; a wordless text's key is that of its bytes)."""
    words = Words(buf, offsets)
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, words.values.to_pylist()), np.uint64, len(words.values))
    seq = mix64(hashed)[words.code] if len(words.code) else np.zeros(0, np.uint64)
    first, raw = words.first(), seq.tobytes()
    keys = [hashlib.blake2b(raw[8 * a:8 * b], digest_size=16).digest() if a < b
            else hashlib.blake2b(buf[lo:hi].tobytes(), digest_size=16, person=b"wordless").digest()
            for a, b, lo, hi in zip(first[:-1].tolist(), first[1:].tolist(), offsets[:-1].tolist(), offsets[1:].tolist())]
    return words, seq, np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)


def shingles(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashed shingles of all texts, where each text's begin, key of each word sequence)."""
    words, seq, keys = word_keys(buf, offsets)
    first, count = words.first(), words.count
    many = np.where(count >= SHINGLE, count - SHINGLE + 1, (count > 0).astype(np.int64))
    start = np.concatenate([[0], np.cumsum(many)])
    doc = np.repeat(np.arange(len(count)), many)
    at = first[doc] + np.arange(int(start[-1])) - start[doc]
    total = np.zeros(len(at), np.uint64)
    padded = np.concatenate([seq, np.zeros(SHINGLE, np.uint64)])
    left = count[doc]
    for k in range(SHINGLE):
        total += np.where(k < left, padded[at + k] * _ODD[2 * TOKENS + k], np.uint64(0))
    total += np.minimum(left, SHINGLE).astype(np.uint64)
    return mix64(total), start, keys


def embed(values: np.ndarray, start: np.ndarray) -> np.ndarray:
    """TOKENS 16-bit tokens of each set (rows of empty sets are 0)."""
    out = np.zeros((len(start) - 1, TOKENS), np.uint16)
    filled = np.flatnonzero(np.diff(start))
    if len(filled):
        for k in range(TOKENS):
            least = np.minimum.reduceat(values * _ODD[2 * k] + _ODD[2 * k + 1], start[filled])
            out[filled, k] = mix64(least) >> np.uint64(48)
    return out


def extend(path: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, longer path) of every token that its row's path chooses."""
    place = np.arange(TOKENS, dtype=np.uint64) << np.uint64(16)
    hashed = mix64((path[:, None] + place[None, :] + tokens.astype(np.uint64)) * _ODD[0])
    row, _ = np.nonzero(hashed < _CHOSEN)
    return row, mix64(hashed[hashed < _CHOSEN] ^ np.uint64(0x5851F42D4C957F2D))


def walk(tokens: np.ndarray, runs: int, hot: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, path, depth) of all sets after the first level of every run; paths
    among the sorted ``hot[d]`` of depth d + 1 are replaced by what extends them."""
    parts = []
    for r in range(runs):
        row, path = extend(np.full(len(tokens), r + 1, np.uint64) * _ODD[1], tokens)
        depth = 1
        while len(hot) >= depth and depth < DEPTH and len(row):
            split = np.isin(path, hot[depth - 1])
            parts.append((row[~split], path[~split], np.full(int((~split).sum()), depth)))
            below, path = extend(path[split], tokens[row[split]])
            row = row[split][below]
            depth += 1
        parts.append((row, path, np.full(len(row), depth)))
    row, path, depth = (np.concatenate(x) for x in zip(*parts))
    # Two tokens of a set may lead to the same path only by a hash clash; keep one.
    _, one = np.unique(np.stack([row.astype(np.uint64), path]), axis=1, return_index=True) if len(row) else (0, [])
    return row[one], path[one], depth[one]


def _matrix(column: pa.Array, dtype, width: int) -> np.ndarray:
    """A binary column of equal sizes as a matrix."""
    flat = b"".join(column.to_pylist())
    return np.frombuffer(flat, dtype).reshape(-1, width)


def _pairs(sizes: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows inside groups of the given sizes (rows stand group by group), some at a time."""
    first = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    member = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    later = np.repeat(sizes, sizes) - member - 1  # partners behind each row
    ends = np.cumsum(later)
    at = 0
    while at < len(later):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
        a = np.repeat(np.arange(at, to), later[at:to])
        yield a, a + 1 + np.arange(len(a)) - np.repeat(ends[at:to] - later[at:to] - base, later[at:to])
        at = to


def joined(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The forest ``root`` (smallest reachable node of each) with the links (a[i], b[i])."""
    nodes = np.arange(len(root))
    return local_roots(len(root), np.concatenate([nodes, a]), np.concatenate([root, b]))


def join_agreeing(root: np.ndarray, own: np.ndarray, tokens: np.ndarray, sizes: np.ndarray, side: np.ndarray, agree: int) -> np.ndarray:
    """The forest with the pairs inside groups whose embeddings agree in at least
    ``agree`` tokens; ``own`` is the node of each row. In a group of two sides only
    pairs across count. A slice of pairs is looked at together, and pairs that are
    joined already are not compared, so memory does not depend on how many agree."""
    group = np.repeat(np.arange(len(sizes)), sizes)
    first = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    mixed = np.zeros(len(sizes), bool)
    np.logical_or.at(mixed, group, side != side[first][group])
    for a, b in _pairs(sizes, PAIRS):
        wanted = (~mixed[group[a]] | (side[a] != side[b])) & (root[own[a]] != root[own[b]])
        a, b = a[wanted], b[wanted]
        for lo in range(0, len(a), COMPARED):
            i, j = a[lo:lo + COMPARED], b[lo:lo + COMPARED]
            if lo:  # what the slice before has joined
                apart = root[own[i]] != root[own[j]]
                i, j = i[apart], j[apart]
            close = (tokens[i] == tokens[j]).sum(axis=1) >= agree
            if close.any():
                root = joined(root, own[i[close]], own[j[close]])
    return root


def join_pivots(root: np.ndarray, own: np.ndarray, tokens: np.ndarray, side: np.ndarray, agree: int) -> np.ndarray:
    """The same for one large group: row by row, each is compared with the later
    rows that are not joined to it yet. A group of near copies is joined by its
    first rows, and no pair is held."""
    label = root[own]
    links: list[tuple[np.ndarray, np.ndarray]] = []
    mixed = bool((side != side[0]).any())
    for i in range(len(own) - 1):
        apart = label[i + 1:] != label[i]
        if not apart.any() and (label == label[0]).all():
            break
        if mixed:
            apart &= side[i + 1:] != side[i]
        later = i + 1 + np.flatnonzero(apart)
        for lo in range(0, len(later), COMPARED):
            part = later[lo:lo + COMPARED]
            close = part[(tokens[part] == tokens[i]).sum(axis=1) >= agree]
            if len(close):
                links.append((np.full(len(close), own[i]), own[close]))
                met = np.unique(np.append(label[close], label[i]))
                label[np.isin(label, met)] = met[0]
    return joined(root, *map(np.concatenate, zip(*links))) if links else root


def _split_again(path: np.ndarray, tokens: np.ndarray, rows: np.ndarray, depth: int) -> Iterator[np.ndarray]:
    """The small buckets below a large one, as arrays of rows."""
    if len(rows) <= SMALL or depth >= DEPTH:
        yield rows
        return
    below, longer = extend(np.full(len(rows), path, np.uint64), tokens[rows])
    order = np.argsort(longer, kind="stable")
    edges = np.flatnonzero(np.concatenate([[True], longer[order][1:] != longer[order][:-1]])) if len(order) else []
    for lo, hi in zip(edges, [*edges[1:], len(order)]):
        if hi - lo > 1:
            yield from _split_again(longer[order[lo]], tokens, rows[below[order[lo:hi]]], depth + 1)


def bucket_links(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Forest of candidates over the buckets in ``table``: (node, root)."""
    cell = table.column("cell").to_numpy()
    node = table.column("node").to_numpy()
    side, depth = table.column("side").to_numpy(), table.column("depth").to_numpy()
    tokens = _matrix(table.column("sketch"), np.uint16, TOKENS)
    edges = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    sizes = np.diff(np.append(edges, len(cell)))
    # Rows of the same set are one node of the forest.
    ids, own = np.unique(node, return_inverse=True)
    root = np.arange(len(ids))
    plain = (sizes > 1) & (sizes <= SMALL)
    rows = np.flatnonzero(np.repeat(plain, sizes))
    root = join_agreeing(root, own[rows], tokens[rows], sizes[plain], side[rows], AGREE)
    for lo, size in zip(edges[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist()):
        small = []
        for part in _split_again(cell.view(np.uint64)[lo], tokens, np.arange(lo, lo + size), int(depth[lo])):
            if len(part) > SMALL:
                root = join_pivots(root, own[part], tokens[part], side[part], AGREE)
            else:
                small.append(part)
        if small:
            rows = np.concatenate(small)
            root = join_agreeing(root, own[rows], tokens[rows], np.array(list(map(len, small))), side[rows], AGREE)
    moved = np.flatnonzero(root != np.arange(len(ids)))
    return ids[moved], ids[root[moved]]


def exact_links(sets: list[np.ndarray], side: np.ndarray, similarity: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of sets (sorted distinct shingles) with at least this Jaccard
    similarity; only across sides unless the sides are -1."""
    m = len(sets)
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(m), size)
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    edges = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    df = np.diff(np.append(edges, len(values)))
    common = np.zeros((m, m), np.float32 if size.max() < 1 << 24 else np.float64)
    few = (df > 1) & (df <= 16)
    if few.any():
        rows = owner[np.repeat(few, df)]
        for a, b in _pairs(df[few], 2_000_000):
            common += np.bincount(rows[a] * m + rows[b], minlength=m * m).reshape(m, m)
    common += np.triu(common, 1).T + np.tril(common, -1).T
    many = np.flatnonzero(df > 16)
    for lo in range(0, len(many), 1024):
        part = many[lo:lo + 1024]
        block = np.zeros((m, len(part)), common.dtype)
        column = np.repeat(np.arange(len(part)), df[part])
        ranges = np.repeat(edges[part] - np.concatenate([[0], np.cumsum(df[part])[:-1]]), df[part])
        block[owner[ranges + np.arange(len(column))], column] = 1
        common += block @ block.T
    shared = common.astype(np.int64)
    p, q = similarity.numerator, similarity.denominator
    linked = shared * (p + q) >= p * (size[:, None] + size[None, :])
    if side[0] >= 0:
        linked &= side[:, None] != side[None, :]
    return np.nonzero(np.triu(linked, 1))


def sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, k1, k2: key of the word sequence, n shingles, sketch); no shingles without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, text_col):
            values, start, key = shingles(*text_bytes(part.column(text_col)))
            tokens = embed(values, start)
            yield pa.RecordBatch.from_arrays(
                [part.column(id_col), pa.array(key[:, 0]), pa.array(key[:, 1]),
                 pa.array(np.diff(start)), pa.array([t.tobytes() for t in tokens], pa.binary())],
                names=["id", "k1", "k2", "n", "sketch"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, k1 long, k2 long, n long, sketch binary")


def _paths(classes: DataFrame, runs: int, hot: list, blocks: dict) -> DataFrame:
    """(cell, side, depth, node, sketch) of every set on every path; the node is the class's first key."""
    sent = Sent(classes.sparkSession, (hot, blocks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, blocks = sent.value
        wide = np.array(sorted(blocks), np.uint64)
        for batch in batches:
            if not batch.num_rows:
                continue
            node = batch.column("k1").to_numpy()
            row, path, depth = walk(_matrix(batch.column("sketch"), np.uint16, TOKENS), runs, hot)
            side = np.zeros(len(row), np.int32)
            plain = ~np.isin(path, wide)
            rows, cells, sides, depths = [row[plain]], [path[plain]], [side[plain]], [depth[plain]]
            for p in np.unique(path[~plain]).tolist():
                # A path still hot at full depth: a cell for each pair of blocks.
                own = row[path == p]
                block = (mix64(node[own].view(np.uint64)) % np.uint64(blocks[p])).astype(np.int32)
                for other in range(blocks[p]):
                    low, high = np.minimum(block, other), np.maximum(block, other)
                    rows.append(own)
                    cells.append(mix64(np.uint64(p) + (low.astype(np.uint64) * np.uint64(1 << 20) + high.astype(np.uint64)) * _ODD[2]))
                    sides.append(block)
                    depths.append(np.full(len(own), DEPTH))
            row = np.concatenate(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(cells).view(np.int64)), pa.array(np.concatenate(sides), pa.int32()),
                 pa.array(np.concatenate(depths), pa.int32()), pa.array(node[row]),
                 batch.column("sketch").take(pa.array(row))], names=["cell", "side", "depth", "node", "sketch"])

    return classes.select("k1", "sketch").mapInArrow(run, "cell long, side int, depth int, node long, sketch binary")


def _path_counts(classes: DataFrame, runs: int, hot: list, depth: int) -> DataFrame:
    """(cell, count) of the paths of one depth, combined before the shuffle."""
    sent = Sent(classes.sparkSession, hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, path, at = walk(_matrix(batch.column("sketch"), np.uint16, TOKENS), runs, sent.value)
            path, many = np.unique(path[at == depth], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(path.view(np.int64)), pa.array(many)], names=["cell", "many"])

    return classes.select("sketch").mapInArrow(run, "cell long, many long").groupBy("cell").agg(F.sum("many").alias("many"))


def candidates(classes: DataFrame, n_classes: int, recall: float) -> DataFrame:
    """Candidate links (u, v) between nodes, a forest for every bucket."""
    runs = runs_for(recall)
    bound = max(HOT_SETS, int(HOT_SHARE * n_classes * runs * BRANCHING / float(SIMILARITY)))
    hot: list[np.ndarray] = []
    blocks: dict[int, int] = {}
    for depth in range(1, DEPTH + 1):
        found = _path_counts(classes, runs, hot, depth).filter(F.col("many") >= bound).collect()
        if not found:
            break
        paths = np.array([r["cell"] for r in found], np.int64).view(np.uint64)
        if depth < DEPTH:
            hot.append(np.sort(paths))
        else:
            blocks = {p: -(-r["many"] // CELL_SETS) for p, r in zip(paths.tolist(), found)}
    cells = _paths(classes, runs, hot, blocks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "cell", 16 << 20):
            node, root = bucket_links(table)
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], names=["u", "v"])

    return cells.repartition(F.col("cell")).sortWithinPartitions("cell").mapInArrow(run, "u long, v long")


def verified(docs: DataFrame, members: DataFrame, similarity: Fraction, id_col: str, text_col: str) -> DataFrame:
    """Exact links inside candidate components: (k1, root, links) rows to be summed
    by k1. ``members``: k1, low (the class's smallest id), w, blocks of its component, component."""
    n = members.count()
    rep = members.select("k1", F.col("low").alias("_id"), "w", "component", "blocks")
    if n * 48 <= BROADCAST_BYTES:
        rep = F.broadcast(rep)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "_text"):
            _, _, key = word_keys(*text_bytes(part.column("_text")))
            yield part.append_column("k1", pa.array(key[:, 0]))

    # One text of a class is enough: by id and key, so that an id with many texts meets each class once.
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")).filter(F.col("_id").isNotNull())
    rows = texts.mapInArrow(keyed, "_id long, _text string, k1 long").join(rep, ["_id", "k1"]).select(
        "k1", "w", "component", "blocks", "_text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for part in chunks(batches, "_text"):
            # Repeated rows bring a class's text more than once.
            fresh = [k for k, key in enumerate(part.column("k1").to_pylist()) if key not in sent and not sent.add(key)]
            part = part.take(pa.array(fresh, pa.int64()))
            if not part.num_rows:
                continue
            values, start, _ = shingles(*text_bytes(part.column("_text")))
            sets = [np.unique(values[a:b]).tobytes() for a, b in zip(start[:-1].tolist(), start[1:].tolist())]
            part = part.select(["k1", "w", "component", "blocks"])
            node, blocks = part.column("k1").to_numpy(), part.column("blocks").to_numpy()
            component = part.column("component").to_numpy().view(np.uint64)
            block = (mix64(node.view(np.uint64)) % blocks.astype(np.uint64)).astype(np.int64)
            row = np.repeat(np.arange(len(node)), blocks)
            other = np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
            low, high = np.minimum(block[row], other), np.maximum(block[row], other)
            cell = mix64(component[row] * _ODD[0] + (low * (1 << 20) + high).astype(np.uint64) * _ODD[2])
            # The cell of a block with itself has no sides; a cell of two blocks keeps them even if one is empty.
            side = np.where(low == high, -1, block[row])
            taken = part.take(pa.array(row))
            # A row for every cell holds its set: written in slices so that no batch grows large.
            for lo in range(0, len(row), 256):
                hi = min(lo + 256, len(row))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell[lo:hi].view(np.int64)), pa.array(side[lo:hi].astype(np.int32)),
                     *[taken.column(c).slice(lo, hi - lo) for c in ("k1", "w")],
                     pa.array([sets[k] for k in row[lo:hi].tolist()], pa.binary())],
                    names=["cell", "side", "k1", "w", "set"])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "cell", 16 << 20):
            cell, side = table.column("cell").to_numpy(), table.column("side").to_numpy()
            k1, w = (table.column(c).to_numpy() for c in ("k1", "w"))
            sets = table.column("set")
            edges = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
            out: list[list] = [[], [], []]
            for lo, hi in zip(edges.tolist(), [*edges[1:].tolist(), len(cell)]):
                # Repeated rows in several tasks bring a class's set more than once.
                _, one = np.unique(k1[lo:hi], return_index=True)
                one = np.sort(one) + lo
                if len(one) < 2 or side[lo] >= 0 and (side[one] == side[lo]).all():
                    continue
                a, b = exact_links([np.frombuffer(sets[k].as_py(), np.uint64) for k in one.tolist()], side[one], similarity)
                if not len(a):
                    continue
                links = np.bincount(a, w[one][b], len(one)) + np.bincount(b, w[one][a], len(one))
                root = local_roots(len(one), a, b)
                on = np.flatnonzero(links)
                for column, x in zip(out, (k1[one][on], k1[one][root[on]], links[on].astype(np.int64))):
                    column.append(x)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x) if x else np.zeros(0, np.int64)) for x in out], names=["k1", "root", "links"])

    spread = rows.mapInArrow(cut, "cell long, side int, k1 long, w long, set binary")
    return spread.repartition(F.col("cell")).sortWithinPartitions("cell").mapInArrow(
        check, "k1 long, root long, links long")


def _judged(docs: DataFrame, id_col: str, text_col: str, recall: float) -> DataFrame:
    """(id, k1, k2, class_id, n_links, component_id, lead) of every row; the lead
    class of a component is the one of its smallest id (of several, the smallest key)."""
    rows = persist(sketches(docs, id_col, text_col), "jaccard-sketches")
    worded = rows.filter((F.col("n") > 0) & F.col("id").isNotNull())
    classes = persist(worded.groupBy("k1", "k2").agg(
        F.min(F.col("id").cast("long")).alias("low"), F.count("*").alias("w"), F.first("n").alias("n"),
        F.first("sketch").alias("sketch")), "jaccard-classes")
    n_rows, n_classes = rows.count(), classes.count()
    near = persist(connected_components(candidates(classes, n_classes, recall)), "jaccard-near")
    # Blocks of each candidate component, by its shingles and sets.
    inside = persist(classes.drop("sketch").join(near.withColumnRenamed("node", "k1"), "k1"), "jaccard-inside")
    size = inside.groupBy("component").agg(F.sum("n").alias("_n"), F.count("*").alias("_sets")).select(
        "component", "_sets", F.greatest(F.ceil(F.col("_n") / BLOCK_SHINGLES), F.ceil(F.col("_sets") / BLOCK_SETS)).alias("blocks"))
    members = persist(join_classes(inside, persist(size, "jaccard-sizes"), "component", "_sets", inside.count()), "jaccard-members")
    links = persist(verified(docs, members, SIMILARITY, id_col, text_col), "jaccard-links")
    part_of = connected_components(links.select(F.col("k1").alias("u"), F.col("root").alias("v")))
    # Components are named by a key; their smallest id is looked up by it.
    joined = persist(classes.select("k1", "low").join(part_of.withColumnRenamed("node", "k1"), "k1"), "jaccard-joined")
    heads = joined.groupBy("component").agg(F.min(F.struct("low", "k1")).alias("head"), F.count("*").alias("_sets")).select(
        "component", "_sets", F.col("head.low").alias("component_id"), F.col("head.k1").alias("lead_key"))
    named = join_classes(joined, persist(heads, "jaccard-heads"), "component", "_sets", joined.count()).select("k1", "component_id", "lead_key")
    linked = links.groupBy("k1").agg(F.sum("links").alias("links"))
    result = persist(
        classes.select("k1", "low", "w").join(linked, "k1", "left").join(named, "k1", "left")
        .select("k1", "w", F.col("low").alias("class_id"), F.coalesce("component_id", "low").alias("component_id"),
                (F.coalesce("links", F.lit(0)) + F.col("w") - 1).alias("n_links"),
                (F.coalesce("lead_key", "k1") == F.col("k1")).alias("lead")), "jaccard-result")
    found = join_classes(worded.select("id", "k1", "k2"), result, "k1", "w", n_rows).select(
        "id", "k1", "k2", "class_id", "n_links", "component_id", "lead")
    alone = rows.filter((F.col("n") == 0) | F.col("id").isNull())
    own = F.col("id").cast("long")
    return found.unionByName(alone.select("id", "k1", "k2", own.alias("class_id"), F.lit(0).cast("long").alias("n_links"),
                                          own.alias("component_id"), F.lit(True).alias("lead")))


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: Fraction = SIMILARITY,
                 recall: float = RECALL) -> DataFrame:
    """Per row of ``docs``: id, class_id (smallest id with the same words),
    n_links (other rows linked directly, copies included), component_id
    (smallest id reachable by links), kept."""
    if similarity != SIMILARITY:
        raise ValueError("the embedding's parameters are set for a similarity of 0.8")
    return _judged(docs, id_col, text_col, recall).select(
        F.col("id").alias(id_col), "class_id", "n_links", "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _free(name: str, columns: list[str]) -> str:
    while name in columns:
        name += "_"
    return name


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group of linked documents: the smallest
    id (of repeated rows with that id and those words, the smallest text). Rows without an id stay."""
    k1, k2 = (_free(k, docs.columns) for k in ("_key1", "_key2"))
    own = F.col("id").cast("long") == F.col("component_id")
    kept = persist(_judged(docs, id_col, text_col, RECALL).filter(F.col("lead") & own).groupBy(
        F.col("id").alias(id_col), F.col("k1").alias(k1), F.col("k2").alias(k2)).agg(F.count("*").alias("_many")), "jaccard-kept")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, text_col):
            _, _, key = word_keys(*text_bytes(part.column(text_col)))
            yield part.append_column(k1, pa.array(key[:, 0])).append_column(k2, pa.array(key[:, 1]))

    schema = StructType([*docs.schema.fields, StructField(k1, LongType()), StructField(k2, LongType())])
    texts = docs.filter(F.col(id_col).isNotNull()).mapInArrow(keyed, schema)
    keys = [id_col, k1, k2]
    # The kept keys are the hashed side: texts are shuffled once and not sorted.
    stay = texts.join(kept.filter("_many = 1").select(keys).hint("shuffle_hash"), keys, "left_semi").select(docs.columns)
    repeated = kept.filter("_many > 1").select(keys)
    if repeated.count():
        # Repeated rows of an id and its words are combined before the shuffle, so neither a hot id nor a hot text
        # meets in one task; of equal texts with other columns the smallest row stays.
        row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
        text = F.coalesce(F.col(text_col), F.lit(""))
        one = texts.groupBy(keys).agg(F.min_by(row, F.struct(text, F.to_json(row))).alias("_row"))
        stay = stay.unionByName(one.join(repeated, keys, "left_semi").select("_row.*").select(docs.columns))
    return stay.unionByName(docs.filter(F.col(id_col).isNull()))
