"""Language-model scoring with a probabilistic suffix tree.

Symbols are the bytes of the lower-cased tokens, a space behind each token and
a line feed at a text's start and end, so the tree spells unknown tokens too.
Contexts are the up to DEPTH symbols before a symbol, packed with it into one
integer. Texts are written once, as compressed symbols, in teams of chunks of one
input partition. A team sends its distinct packed symbols, each with its number in
training texts, as sorted arrays to buckets by the last two symbols of the
context (the last three behind pairs that precede a thousandth of all symbols).
The same rows count and ask: a bucket sums the counts of all teams, builds its
part of the tree in one task, scores every distinct symbol once and sends each
team the scores of its own. There each symbol of the team's texts finds its score
in a hash table. So a symbol is shuffled once a team, not once a place. A context
is a candidate from two training symbols on, whatever the size of the corpus, so
the model grows with it. Only contexts of at most one symbol and the thousand hot
pairs are held by every task.
A context is retained if the next-symbol distribution behind it diverges
from that behind its suffix, by more than chance. A retained distribution is
smoothed by that of the next shorter retained suffix, which weighs ``BACKOFF``
symbols for each kind of symbol behind the context; the root gives every byte a chance.
A text's score sums the log10 probabilities of its symbols, each from the
longest retained suffix of what precedes it.

The unigram base needs counts of all training tokens: distinct tokens of every
task are summed by Spark. Tokens that make up a millionth of the corpus (at most
a million) are broadcast; the others are exploded per text and joined.

Defined cases: null and empty texts have the end token alone; a null id counts
as the empty text for the fold, so such rows train; repeated rows are scored one
by one; without training rows all counts are 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsift.llm.common import Sent, Words, chunks, held_in_fold, lookup, mix64, nonspace_words, release, text_bytes
from logsift.session import persist

HELD_OUT_FOLD = 1
# Symbols of context; the packed context and next symbol fit 8 bytes up to 7.
DEPTH = 6
# A candidate has at least two training symbols behind it, and this share of all: none, so that
# a larger corpus loses no context.
LEAST_SHARE = 0.0
# Retained if the next symbols diverge by so many nats from those behind the suffix, and
# by so many in sum over the context's places for each kind of next symbol.
DIVERGENCE, EVIDENCE = 0.002, 1.0
# Symbols that the next shorter retained suffix counts for, for each kind of symbol behind a context.
BACKOFF = 4.0
# A token is broadcast from this share of the training tokens on, if not longer than so many bytes.
FREQUENT, FREQUENT_BYTES = 1e-6, 64
# Pairs of symbols before a thousandth of all training symbols are split by the symbol before them.
HOT_PAIRS = 1000
# Buckets at least and at most, and training symbols of one in between.
BUCKETS, MOST_BUCKETS, BUCKET_SYMBOLS = 256, 4096, 16 << 20
# Text bytes handled at once (the packed symbols take some forty times as much), text bytes whose
# distinct symbols are asked for together, and distinct symbols scored at once.
CHUNK, TEAM, SLICE = 1 << 20, 64 << 20, 1 << 19
# Of zstd, for what is stored and shuffled.
LEVEL = 6

EDGE, SPACE = 10, 32
CHUNK_TYPE = pa.struct([("team", pa.int64()), ("first", pa.int64()),
                        *((c, pa.binary()) for c in ("symbols", "begin", "train", "pairs", "pair_counts"))])


def stream(buf: np.ndarray, words: Words, n_docs: int, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, where each text's first predicted symbol stands). Before each
    text stand ``depth`` zeros and the start symbol; a text's zero bytes become
    vertical tabs, which no token holds."""
    length = words.end - words.start
    ahead = depth + 1
    total = int(length.sum()) + len(length) + n_docs * (ahead + 1)
    out = np.full(total, EDGE, np.uint8)
    offset = np.concatenate([[0], np.cumsum(length + 1)])
    # Where each token goes: behind all earlier tokens and the edges of its own and earlier texts.
    at = offset[:-1] + words.doc * (ahead + 1) + ahead
    inside = np.repeat(at - np.concatenate([[0], np.cumsum(length)])[:-1], length) + np.arange(int(length.sum()))
    low = np.arange(256, dtype=np.uint8)
    low[65:91] += 32
    low[0] = 11
    blank = np.zeros(256, bool)
    blank[[32, 9, 10, 11, 12, 13]] = True
    out[inside] = low[buf[~blank[buf]]]
    out[at + length] = SPACE
    begin = offset[words.first()[:-1]] + np.arange(n_docs) * (ahead + 1)
    out[(begin[:, None] + np.arange(depth)).ravel()] = 0
    return out, begin + ahead


def grams(symbols: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Each symbol (lowest byte) packed under its context, the nearest symbol highest."""
    wide = symbols.astype(np.uint64)
    out = wide.copy()
    for k in range(1, depth + 1):
        out[k:] |= wide[:-k] << np.uint64(8 * (depth + 1 - k))
    return out


def predicted(n: int, begin: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Which places hold a symbol to predict (not the zeros and start symbols)."""
    out = np.ones(n, bool)
    out[(begin[:, None] - 1 - np.arange(depth + 1)).ravel()] = False
    return out


def merge_counts(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sum of counts by key, sorted by key."""
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    key = np.concatenate([k for k, _ in parts])
    order = np.argsort(key, kind="stable")
    key = key[order]
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    count = np.concatenate([n for _, n in parts])[order]
    return key[start], np.add.reduceat(count, start) if len(start) else count


def pack(values: np.ndarray, rising: bool = False) -> bytes:
    """Compressed bytes of an array, first all lowest bytes; a rising one as its differences."""
    values = np.diff(values, prepend=values.dtype.type(0)) if rising else values
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", compression_level=LEVEL).compress(raw, asbytes=True)


def unpack(raw: bytes, dtype, rising: bool = False) -> np.ndarray:
    size, width = int.from_bytes(raw[:8], "little"), np.dtype(dtype).itemsize
    flat = np.frombuffer(pa.decompress(raw[8:], decompressed_size=size, codec="zstd", asbytes=True), np.uint8)
    values = np.ascontiguousarray(flat.reshape(width, size // width).T).reshape(-1).view(dtype)
    return np.cumsum(values, dtype=dtype) if rising else values


def rounded(values: np.ndarray) -> np.ndarray:
    """Values with 36 bits of fraction (a part in 10^11): their two lowest bytes are zero and pack to nothing."""
    return ((values.view(np.uint64) + np.uint64(1 << 15)) >> np.uint64(16) << np.uint64(16)).view(np.float64)


def _by_bucket(key: np.ndarray, hot: np.ndarray, buckets: int, depth: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, places of its keys). A bucket holds whole contexts of two symbols,
    of three behind the ``hot`` pairs (sorted)."""
    pair = key >> np.uint64(8 * (depth - 1))
    if len(hot):
        split = hot[np.minimum(np.searchsorted(hot, pair), len(hot) - 1)] == pair
        pair = np.where(split, key >> np.uint64(8 * (depth - 2)) << np.uint64(1) | np.uint64(1), pair << np.uint64(1))
    bucket = (mix64(pair) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket.astype(np.uint16), kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in range(buckets):
        if edges[b] < edges[b + 1]:
            yield b, order[edges[b]:edges[b + 1]]


def shorter(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts without the farthest symbol of each context."""
    return merge_counts([((key >> np.uint64(16) << np.uint64(8)) | (key & np.uint64(255)), n)])


def candidates(key: np.ndarray, n: np.ndarray, least: int, depth: int, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(depth, gram, n) of a bucket's contexts of two symbols and more with at least ``least``
    symbols behind them. The ``hot`` pairs themselves are split over buckets, so not among them."""
    found = []
    key, n = key[n > 0], n[n > 0]
    for d in range(depth, 1, -1):
        if d < depth:
            key, n = shorter(key, n)
        context = key >> np.uint64(8)
        start = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if len(key) else np.zeros(0, np.int64)
        total = np.repeat(np.add.reduceat(n, start), np.diff(np.append(start, len(key)))) if len(key) else n
        # A context that reaches beyond the text's start has a zero in its farthest place.
        good = (total >= least) & ((context & np.uint64(255)) != 0)
        if d == 2:
            good &= ~np.isin(context, hot)
        found.append((np.full(int(good.sum()), d), key[good], n[good]))
    return tuple(np.concatenate(c) for c in zip(*found))


def pack_chunk(symbols: np.ndarray, begin: np.ndarray, train: np.ndarray, depth: int = DEPTH) -> dict:
    """A chunk's symbols, where its texts begin, which of them train, and its training
    symbols by the last two symbols before them."""
    pair = _behind_two(symbols)[predicted(len(symbols), begin, depth) & _of_texts(train, begin, len(symbols), depth)]
    many = np.bincount(pair, minlength=1 << 16)
    own = np.flatnonzero(many)
    return {"symbols": pack(symbols), "begin": pack(begin, True), "train": pack(train.astype(np.uint8)),
            "pairs": pack(own.astype(np.uint16), True), "pair_counts": pack(many[own].astype(np.int64))}


def _behind_two(symbols: np.ndarray) -> np.ndarray:
    """The two symbols before each symbol, the nearest one highest."""
    out = np.zeros(len(symbols), np.int64)
    out[1:] = symbols[:-1].astype(np.int64) << 8
    out[2:] |= symbols[:-2]
    return out


def _of_texts(values: np.ndarray, begin: np.ndarray, n: int, depth: int) -> np.ndarray:
    """A value of each text for each of its symbols."""
    return np.repeat(values, np.diff(np.append(begin - depth - 1, n)))


def hot_pairs(packed: DataFrame, n_symbols: int) -> np.ndarray:
    """Sorted pairs of symbols that precede a thousandth of the training symbols: a thousand at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for pairs, many in zip(batch.column("pairs"), batch.column("pair_counts")):
                total[unpack(pairs.as_py(), np.uint16, True)] += unpack(many.as_py(), np.int64)
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(total[own])], names=["pair", "n"])

    found = packed.select("pairs", "pair_counts").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    rows = found.filter(F.col("n") >= max(1, n_symbols // HOT_PAIRS + 1)).collect()
    return np.sort(np.array([r["pair"] for r in rows], np.uint64))


def gram_counts(packed: DataFrame, hot: np.ndarray, buckets: int, depth: int = DEPTH) -> DataFrame:
    """(team, bucket, grams, counts): the sorted distinct symbols with their contexts of each team of
    chunks and how often each of them stands in training texts (0 where only in others)."""

    def flush(team: int, parts: list) -> pa.RecordBatch:
        key, n = merge_counts(parts)
        rows = [(b, pack(key[own], True), pack(n[own])) for b, own in _by_bucket(key, hot, buckets, depth)]
        return pa.RecordBatch.from_arrays(
            [pa.array([team] * len(rows), pa.int64()), pa.array([b for b, _, _ in rows], pa.int32()),
             pa.array([k for _, k, _ in rows], pa.binary()), pa.array([n for _, _, n in rows], pa.binary())],
            names=["team", "bucket", "grams", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts = None, []
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                if row["team"] != at:
                    if parts:
                        yield flush(at, parts)
                    at, parts = row["team"], []
                symbols, begin = unpack(row["symbols"], np.uint8), unpack(row["begin"], np.int64, True)
                train = _of_texts(unpack(row["train"], np.uint8).astype(bool), begin, len(symbols), depth)
                on = predicted(len(symbols), begin, depth)
                key = grams(symbols, depth)
                parts.append(np.unique(key[on & train], return_counts=True))
                other = np.unique(key[on & ~train])
                parts.append((other, np.zeros(len(other), np.int64)))
                if len(parts) >= 16:
                    parts = [merge_counts(parts)]
                del symbols, begin, train, on, key, other
                release()
        if parts:
            yield flush(at, parts)

    return packed.select("team", "symbols", "begin", "train").mapInArrow(run, "team long, bucket int, grams binary, counts binary")


def low_counts(counts: DataFrame, hot: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(depth, gram, n) of the contexts of one symbol and none (at most 65,792) and of the hot pairs (at most 256,000)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[list] = [[], [], []]
        for batch in batches:
            for grams_, counts_ in zip(batch.column("grams"), batch.column("counts")):
                key, n = unpack(grams_.as_py(), np.uint64, True), unpack(counts_.as_py(), np.int64)
                # Straight to two symbols of context; sorted order stays whole contexts together.
                key, n = merge_counts([(key[n > 0] >> np.uint64(8 * (depth - 1)) << np.uint64(8) | key[n > 0] & np.uint64(255), n[n > 0])])
                # A pair that reaches beyond the text's start is no context.
                own = np.isin(key >> np.uint64(8), hot) & ((key >> np.uint64(8) & np.uint64(255)) != 0)
                parts[2].append((key[own], n[own]))
                key, n = shorter(key, n)
                parts[1].append((key, n))
                parts[0].append(merge_counts([(key & np.uint64(255), n)]))
                if len(parts[0]) >= 256:
                    parts = [[merge_counts(p)] for p in parts]
        for d, p in enumerate(parts):
            key, n = merge_counts(p)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(key), d, np.int32)), pa.array(key.view(np.int64)), pa.array(n)], names=["depth", "gram", "n"])

    found = counts.select("grams", "counts").mapInArrow(run, "depth int, gram long, n long").groupBy("depth", "gram").agg(
        F.sum("n").alias("n")).toArrow()
    return found.column("depth").to_numpy(), found.column("gram").to_numpy().view(np.uint64), found.column("n").to_numpy()


def gram_scores(counts: DataFrame, low: tuple, hot: np.ndarray, least: int, depth: int = DEPTH) -> DataFrame:
    """(team, grams, scores): the log10 probabilities of each team's distinct symbols. A bucket's part
    of the tree is built from the sums of all teams, and each distinct symbol is scored once."""
    sent = Sent(counts.sparkSession, (low, hot))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, known, value = None, [], None, None
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                if row["bucket"] != at:
                    at, parts, known = row["bucket"], [], None
                key = unpack(row["grams"], np.uint64, True)
                if row["kind"] == 0:
                    parts.append((key, unpack(row["counts"], np.int64)))
                    if sum(len(k) for k, _ in parts[1:]) > 4_000_000:
                        parts = [merge_counts(parts)]
                    continue
                if known is None:
                    known, n = merge_counts(parts)
                    low, hot = sent.value
                    levels = zip(low, candidates(known, n, least, depth, hot))
                    score = Scorer(SuffixTree(*(np.concatenate(c) for c in levels), least, levels=depth))
                    value = np.concatenate([score(known[lo:lo + SLICE]) for lo in range(0, len(known), SLICE)])
                    parts, levels, score, n = [], None, None, None
                    release()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["team"]], pa.int64()), pa.array([row["grams"]], pa.binary()),
                     pa.array([pack(rounded(value[np.searchsorted(known, key)]))], pa.binary())], names=["team", "grams", "scores"])

    both = counts.select("bucket", F.lit(0).alias("kind"), "team", "grams", "counts").unionByName(
        counts.select("bucket", F.lit(1).alias("kind"), "team", "grams", F.lit(None).cast("binary").alias("counts")))
    return both.repartition(F.col("bucket")).sortWithinPartitions("bucket", "kind").mapInArrow(
        run, "team long, grams binary, scores binary")


def text_scores(packed: DataFrame, scores: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(row, score): each team's chunks meet the scores of the team's distinct symbols."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, table, value = None, [], None, None
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                if row["team"] != at:
                    at, parts, table = row["team"], [], None
                if row["kind"] == 0:
                    parts.append((unpack(row["a"], np.uint64, True), unpack(row["b"], np.float64)))
                    continue
                if table is None:
                    # A team whose chunks were read by two tasks has some symbols twice.
                    keys, own = np.unique(np.concatenate([key for key, _ in parts]), return_index=True)
                    table, value, parts = Table(keys), np.concatenate([v for _, v in parts])[own], []
                symbols, begin = unpack(row["a"], np.uint8), unpack(row["b"], np.int64, True)
                on = predicted(len(symbols), begin, depth)
                doc = _of_texts(np.arange(len(begin)), begin, len(symbols), depth)[on]
                key = grams(symbols, depth)[on]
                score = np.concatenate([value[table(key[lo:lo + SLICE])] for lo in range(0, max(1, len(key)), SLICE)])
                total = np.bincount(doc, score, len(begin))
                del symbols, on, doc, key, score
                release()
                yield pa.RecordBatch.from_arrays([pa.array(row["first"] + np.arange(len(total))), pa.array(total)], names=["row", "score"])

    none = F.lit(None).cast("long")
    both = scores.select("team", F.lit(0).alias("kind"), none.alias("first"), F.col("grams").alias("a"), F.col("scores").alias("b")).unionByName(
        packed.select("team", F.lit(1).alias("kind"), "first", F.col("symbols").alias("a"), F.col("begin").alias("b")))
    return both.repartition(F.col("team")).sortWithinPartitions("team", "kind").mapInArrow(run, "row long, score double")


class SuffixTree:
    """``root``: log10 probability of each byte. ``levels[d - 1]``: sorted retained
    contexts of d symbols and their back-off, sorted packed symbols behind them
    and their log10 probabilities."""

    def __init__(self, depth: np.ndarray, gram: np.ndarray, n: np.ndarray, least: int, divergence: float = DIVERGENCE,
                 evidence: float = EVIDENCE, levels: int = DEPTH):
        self.depth = levels
        count = np.full(256, 0.5)
        np.add.at(count, gram[depth == 0].astype(np.int64), n[depth == 0])
        self.root = np.log10(count / count.sum())
        self.levels: list = []
        for d in range(1, levels + 1):
            on = np.flatnonzero(depth == d)
            on = on[np.argsort(gram[on])]
            key, many = gram[on], n[on].astype(float)
            if not len(key):
                self.levels.append((key, many, key, many))
                continue
            context, back = np.unique(key >> np.uint64(8), return_inverse=True)
            total, kinds = np.bincount(back, many), np.bincount(back)
            low = self.level_score((key >> np.uint64(16) << np.uint64(8)) | (key & np.uint64(255)) if d > 1 else key & np.uint64(255), d - 1)
            share = many / total[back]
            apart = np.bincount(back, share * (np.log(share) - low * np.log(10)))
            keep = (total >= least) & (apart >= divergence) & (total * apart >= evidence * kinds)
            shorter_weight = BACKOFF * kinds
            score = np.log10((many + shorter_weight[back] * 10 ** low) / (total + shorter_weight)[back])
            self.levels.append((context[keep], np.log10((shorter_weight / (total + shorter_weight))[keep]), key[keep[back]], score[keep[back]]))

    def level_score(self, key: np.ndarray, d: int) -> np.ndarray:
        """log10 probability of the lowest byte behind a context of d packed symbols."""
        out = self.root[(key & np.uint64(255)).astype(np.int64)]
        for k in range(1, d + 1):
            context, off, known, score = self.levels[k - 1]
            if not len(context):
                continue
            own = key >> np.uint64(8 * (d - k + 1))
            at = np.minimum(np.searchsorted(context, own), len(context) - 1)
            out = np.where(context[at] == own, out + off[at], out)
            own = own << np.uint64(8) | (key & np.uint64(255))
            at = np.minimum(np.searchsorted(known, own), len(known) - 1)
            out = np.where(known[at] == own, score[at], out)
        return out


class Table:
    """Open-addressing hash table of distinct packed keys: key -> its number."""

    _FREE = np.uint64(0xFFFFFFFFFFFFFFFF)

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(1.5 * max(1, len(keys))).bit_length())
        self._shift, self._mask = np.uint64(64 - bits), (1 << bits) - 1
        self._key = np.full(1 << bits, self._FREE, np.uint64)
        self._number = np.zeros(1 << bits, np.int32)
        rest, at = np.arange(len(keys)), self._home(keys)
        while len(rest):
            free = self._key[at] == self._FREE
            self._key[at[free]] = keys[rest[free]]
            placed = self._key[at] == keys[rest]
            self._number[at[placed]] = rest[placed]
            rest, at = rest[~placed], (at[~placed] + 1) & self._mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return (mix64(keys) >> self._shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Number of each key, or -1."""
        at = self._home(keys)
        there = self._key[at]
        out = np.where(there == keys, self._number[at], -1)
        rest = np.flatnonzero((there != keys) & (there != self._FREE))
        while len(rest):
            at[rest] = (at[rest] + 1) & self._mask
            there = self._key[at[rest]]
            hit = there == keys[rest]
            out[rest[hit]] = self._number[at[rest[hit]]]
            rest = rest[~hit & (there != self._FREE)]
        return out


class Scorer:
    """Scores symbols by the tree, the longest retained context first. Packed keys of
    different lengths differ, since no symbol is zero, so one table serves all levels."""

    def __init__(self, tree: SuffixTree):
        self.depth, self.root = tree.depth, tree.root
        self._contexts = Table(np.concatenate([c for c, _, _, _ in tree.levels]))
        self._off = np.concatenate([o for _, o, _, _ in tree.levels])
        self._known = Table(np.concatenate([k for _, _, k, _ in tree.levels]))
        self._known_score = np.concatenate([v for _, _, _, v in tree.levels])

    def __call__(self, key: np.ndarray) -> np.ndarray:
        """log10 probability of each packed symbol behind its context."""
        depth = self.depth
        out = np.zeros(len(key))
        rest = np.arange(len(key))
        symbol = key & np.uint64(255)
        for k in range(depth, 0, -1):
            context = key[rest] >> np.uint64(8 * (depth - k + 1))
            number = self._contexts(context)
            held = np.flatnonzero(number >= 0)
            at = self._known(context[held] << np.uint64(8) | symbol[rest[held]])
            found = at >= 0
            out[rest[held[found]]] += self._known_score[at[found]]
            out[rest[held[~found]]] += self._off[number[held[~found]]]
            done = np.zeros(len(rest), bool)
            done[held[found]] = True
            rest = rest[~done]
        out[rest] += self.root[symbol[rest].astype(np.int64)]
        return out


def token_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """(token, c) over all texts of ``docs``; the end token is not listed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, text_col, 4 * CHUNK):
            words = nonspace_words(*text_bytes(part.column(text_col)))
            many = np.bincount(words.code, minlength=len(words.values)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([words.values.cast(pa.large_string()).cast(pa.string()), pa.array(many)], names=["token", "c"])

    return docs.select(text_col).mapInArrow(run, "token string, c long").groupBy("token").agg(F.sum("c").alias("c"))


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    training = docs.filter(~held_in_fold(id_col, HELD_OUT_FOLD))
    ends = training.count()
    counts = persist(token_counts(training, text_col), "token-counts")
    kinds, words, spelled = counts.agg(F.count("*"), F.sum("c"), F.sum(F.col("c") * (F.octet_length("token") + 1))).first()
    total = (words or 0) + ends
    # V and N count the end token; the base's denominator.
    below = total + 0.5 * (kinds + (1 if ends else 0) + 1)
    # Every token is followed by a space, every text by its end.
    n_symbols = (spelled or 0) + ends
    least = max(2, int(LEAST_SHARE * n_symbols))
    usual = (F.col("c") >= FREQUENT * total) & (F.octet_length("token") <= FREQUENT_BYTES)
    often = counts.filter(usual).toArrow()
    known = pa.chunked_array(often.column("token")).combine_chunks().cast(pa.large_string()).cast(pa.large_binary()) \
        if often.num_rows else pa.array([], pa.large_binary())
    sent = Sent(spark, (known, often.column("c").to_numpy()))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, often = sent.value
        row = TaskContext.get().partitionId() << 33
        team, in_team = row, 0
        for part in chunks(batches, text_col, CHUNK):
            n = part.num_rows
            buf, offsets = text_bytes(part.column(text_col))
            words = nonspace_words(buf, offsets)
            at = lookup(words.values, known)[words.code] if len(words.code) else np.zeros(0, np.int64)
            frequent = at >= 0
            doc = words.doc
            base = np.full(n, np.log10((ends + 0.5) / below))
            base += np.bincount(doc[frequent], np.log10((often[at[frequent]] + 0.5) / below), minlength=n)
            seen = np.bincount(doc[frequent], minlength=n) + (1 if ends else 0)
            # The other tokens of each text, distinct with their number.
            width = max(1, len(words.values))
            pair, many = np.unique(doc[~frequent] * width + words.code[~frequent], return_counts=True)
            start = np.searchsorted(pair // width, np.arange(n + 1))
            tokens = words.values.take(pa.array(pair % width)).cast(pa.large_string()).cast(pa.string())
            rare = pa.ListArray.from_arrays(start.astype(np.int32), pa.StructArray.from_arrays(
                [tokens, pa.array(many.astype(np.int64))], names=["token", "n"]))
            # The chunk's symbols stand in its first row.
            if in_team + len(buf) > TEAM:
                team, in_team = row, 0
            in_team += len(buf)
            chunk = {"team": team, "first": row} | pack_chunk(*stream(buf, words, n), np.asarray(part.column("_train")).astype(bool))
            yield pa.RecordBatch.from_arrays(
                [pa.array(row + np.arange(n)), part.column(id_col), pa.array(words.count.astype(np.int64) + 1), pa.array(seen.astype(np.int64)),
                 pa.array(base), rare, pa.array([chunk] + [None] * (n - 1), CHUNK_TYPE)],
                names=["row", id_col, "n_tokens", "seen", "base", "rare", "chunk"])
            row += n

    train = (~held_in_fold(id_col, HELD_OUT_FOLD)).alias("_train")
    scored = persist(docs.select(id_col, text_col, train).mapInArrow(
        run, f"row long, `{id_col}` {kind}, n_tokens long, seen long, base double, rare array<struct<token:string,n:long>>, "
             "chunk struct<team:long,first:long,symbols:binary,begin:binary,train:binary,pairs:binary,pair_counts:binary>"), "lm-scored")
    packed = scored.filter(F.col("chunk").isNotNull()).select("chunk.*")
    hot = hot_pairs(packed, n_symbols)
    buckets = min(MOST_BUCKETS, max(BUCKETS, n_symbols // BUCKET_SYMBOLS))
    grams_ = persist(gram_counts(packed, hot, buckets), "lm-grams")
    model = text_scores(packed, gram_scores(grams_, low_counts(grams_, hot), hot, least))
    rare = scored.select("row", F.explode("rare").alias("r")).select("row", "r.token", "r.n")
    c = F.coalesce("c", F.lit(0))
    rest = rare.join(counts.filter(~usual), "token", "left").groupBy("row").agg(
        F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("_seen"),
        F.sum(F.col("n") * F.log10((c + 0.5) / F.lit(float(below)))).alias("_base"))
    return scored.drop("rare", "chunk").join(rest, "row", "left").join(model, "row", "left").select(
        id_col, held_in_fold(id_col, HELD_OUT_FOLD).alias("held_out"), "n_tokens",
        (F.col("seen") + F.coalesce("_seen", F.lit(0))).alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("_base", F.lit(0.0))).alias("base_score"), "score")
