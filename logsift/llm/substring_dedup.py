"""Removal of repeated word windows by relative Lempel-Ziv parsing.

Every window of ``window`` words has an anchor: the leftmost of its word n-grams
with the smallest hash. Equal windows have equal anchors at equal places, so a
document falls into stretches (the windows with one anchor, and their words),
and a window can only repeat among the stretches with its anchor. Anchors are
counted over the corpus first; a bounded Bloom filter of the repeated ones keeps
all other stretches from being shipped. Equal stretches are one row with a count
from there on: all windows of a stretch that occurs twice are repeated.

The distinct stretches of a bucket of anchors are the reference block that the
bucket's documents are factored against; no other block can hold one of their
windows. A block is indexed by a suffix array with the ranks of its power-of-two
substrings. Each stretch that occurs once is parsed greedily: a factor is the
longest piece from the current word on that also stands at another place of the
block. Windows inside one factor are repeated. A window that crosses a boundary
can only lie in the two factors beside it, so only where those are long enough
together its longest factor is looked up as well.

An anchor with very many different stretches (the edge of a passage that very
many documents share) is not sent to one task: its stretches are cut again by
longer anchors, at last by whole windows.

Exact copies of a document are known by the key of their words: such a document
is removed whole, and its text is never shipped.

Defined cases: null and wordless texts have no words, and the hash is that of the
empty string; texts shorter than a window keep all words; rows that repeat an
id, or have none, are documents of their own (a repeated row is a copy).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsift.llm.common import Sent, Words, chunks, join_classes, mix64, nonspace_words, release, text_bytes, whole_groups
from logsift.session import persist

WINDOW = 35
# An anchor with more different stretches is cut by longer anchors.
HOT_STRETCHES = 2000
BLOCK_BYTES = 4 << 20
# Marks (20 bytes each) that are put together at once.
MARK_BYTES = 1 << 20
# Bloom filters: bits a key, bits at most (32 MB), places a key.
KEY_BITS, MOST_BITS, PLACES = 16, 1 << 28, 4
_SLICES = 64

_ODD = (np.random.default_rng(13).integers(1, 1 << 62, 512, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_EMPTY = hashlib.sha256(b"").hexdigest()


def anchor_sizes(window: int) -> list[int]:
    """Words of an anchor, level by level; the last is the whole window."""
    sizes = sorted({max(1, window // 3), max(1, 2 * window // 3), window})
    if window - sizes[0] >= 62 or 2 * window > 256:
        raise ValueError("at most 62 windows of a stretch can be marked")
    return sizes


def hashed_words(words: Words) -> np.ndarray:
    """A 64-bit hash of every word."""
    if not len(words.code):
        return np.zeros(0, np.uint64)
    return mix64(np.fromiter(map(xxhash.xxh64_intdigest, words.values.to_pylist()), np.uint64, len(words.values)))[words.code]


def _linear(seq: np.ndarray, at: np.ndarray, length: np.ndarray | int, salt: int) -> np.ndarray:
    """Hash of the words seq[at:at+length]."""
    most = int(np.max(length)) if len(at) else 0
    padded = np.concatenate([seq, np.zeros(most, np.uint64)])
    total = np.zeros(len(at), np.uint64) + np.asarray(length).astype(np.uint64)
    for k in range(most):
        term = padded[at + k] * _ODD[salt + k]
        total += term if np.isscalar(length) else np.where(k < length, term, np.uint64(0))
    return mix64(total)


def stretches(seq: np.ndarray, count: np.ndarray, window: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor's hash, text, first word, windows) of every stretch. ``seq``: hashed
    words of all texts, ``count``: words of each; first words count from 0 over all texts."""
    first = np.concatenate([[0], np.cumsum(count)])
    many = np.maximum(count - window + 1, 0)
    text = np.repeat(np.arange(len(count)), many)
    if not len(text):
        return np.zeros(0, np.uint64), text, text, text
    start = first[text] + np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
    places = np.arange(max(len(seq) - size + 1, 0))
    value = _linear(seq, places, size, 0)
    # The smallest of the window's n-grams, leftmost of equal ones, by doubling.
    wide, span, best = window - size + 1, 1, places
    while span < wide:
        step = min(span, wide - span)
        right = np.minimum(best[np.minimum(places + step, len(places) - 1)], len(places) - 1)
        best = np.where(value[right] < value[best], right, best)
        span += step
    anchor = best[start]
    fresh = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])])
    at = np.flatnonzero(fresh)
    # Anchors have small hashes: mixed again, their bits are even.
    return mix64(value[anchor[at]] * _ODD[size]), text[at], start[at], np.diff(np.append(at, len(text)))


def stretch_keys(seq: np.ndarray, start: np.ndarray, windows: np.ndarray, window: int) -> list[bytes]:
    """16 bytes that are the key of each stretch's words."""
    length = windows + window - 1
    pair = np.stack([_linear(seq, start, length, 0), _linear(seq, start, length, 256)], axis=1)
    raw = np.ascontiguousarray(pair).tobytes()
    return [raw[16 * k:16 * k + 16] for k in range(len(start))]


class KeyFilter:
    """A Bloom filter of well-mixed longs, of bounded size whatever their number.
    Each slice of the keys (their upper six bits) has a part of the bits to itself."""

    def __init__(self, keys: DataFrame, name: str):
        n = keys.count()
        bits = _SLICES * 64
        while bits < min(n * KEY_BITS, MOST_BITS):
            bits *= 2
        self.part = bits // _SLICES
        part = self.part

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, np.ndarray] = {}
            for batch in batches:
                key = batch.column(0).to_numpy().view(np.uint64)
                for s in np.unique(key >> np.uint64(58)).tolist():
                    own = held.setdefault(s, np.zeros(part // 8, np.uint8))
                    for place in _places(key[key >> np.uint64(58) == s], part):
                        np.bitwise_or.at(own, place >> 3, np.uint8(1) << (place & 7).astype(np.uint8))
            if held:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(held), pa.int32()), pa.array([x.tobytes() for x in held.values()], pa.binary())],
                    names=["slice", "bits"])

        sliced = keys.toDF(name).repartition(F.shiftrightunsigned(name, 58))
        found = np.zeros((_SLICES, part // 8), np.uint8)
        for row in sliced.mapInArrow(run, "slice int, bits binary").collect():  # MOST_BITS / 8 bytes at most
            found[row["slice"]] |= np.frombuffer(row["bits"], np.uint8)
        self.sent = Sent(keys.sparkSession, found)

    def may_hold(self, key: np.ndarray) -> np.ndarray:
        key = key.astype(np.uint64)
        own = (key >> np.uint64(58)).astype(np.int64)
        held = np.ones(len(key), bool)
        for place in _places(key, self.part):
            held &= (self.sent.value[own, place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
        return held


def _places(key: np.ndarray, part: int) -> Iterator[np.ndarray]:
    for k in range(PLACES):
        yield (mix64(key * _ODD[k]) % np.uint64(part)).astype(np.int64)


class Block:
    """An indexed reference block: its texts' words behind one another, a
    separator of its own behind each text, and its suffix array."""

    def __init__(self, code: np.ndarray, count: np.ndarray):
        n = len(count)
        self.start = np.cumsum(count) - count + np.arange(n)
        rank = np.empty(len(code) + n, np.int64)
        gaps = self.start + count
        inside = np.ones(len(rank), bool)
        inside[gaps] = False
        rank[gaps] = np.arange(n)
        rank[inside] = code + n
        # ranks[l][i] names the substring of 2 ** l words at i, in their order.
        self.ranks = [rank]
        step = 1
        while step < int(count.max(initial=1)) + 1:
            second = np.zeros(len(rank), np.int64)
            second[:-step] = rank[step:] + 1
            key = rank * (int(rank.max()) + 2) + second
            order = np.argsort(key, kind="stable")
            new = np.empty(len(rank), np.int64)
            new[order] = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
            rank = new
            step *= 2
            self.ranks.append(rank)
        self.order = np.argsort(rank, kind="stable")
        self.place = np.empty(len(rank), np.int64)
        self.place[self.order] = np.arange(len(rank))

    def _common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that the suffixes at i and j share."""
        n, long = len(self.place), np.zeros(len(i), np.int64)
        for level in range(len(self.ranks) - 1, -1, -1):
            a, b = i + long, j + long
            inside = (a < n) & (b < n)
            same = inside & (self.ranks[level][np.minimum(a, n - 1)] == self.ranks[level][np.minimum(b, n - 1)])
            long += np.where(same, 1 << level, 0)
        return long

    def factor(self, at: np.ndarray) -> np.ndarray:
        """Length of the longest piece from each place on that also stands elsewhere."""
        place = self.place[at]
        before = np.where(place > 0, self._common(at, self.order[np.maximum(place - 1, 0)]), 0)
        last = len(self.place) - 1
        return np.maximum(before, np.where(place < last, self._common(at, self.order[np.minimum(place + 1, last)]), 0))


def repeated_windows(code: np.ndarray, count: np.ndarray, parse: np.ndarray, window: int) -> np.ndarray:
    """For each text of a block a mask of its windows that also stand elsewhere in
    the block (bit k: the window from word k on); only the texts in ``parse``."""
    block = Block(code, count)
    mask = np.zeros(len(count), np.int64)

    def mark(text: np.ndarray, word: np.ndarray) -> None:
        np.bitwise_or.at(mask, text, np.int64(1) << word)

    text = np.flatnonzero(parse & (count >= window))
    at = np.zeros(len(text), np.int64)
    begin, long = at.copy(), at.copy()  # the factor before
    while len(text):
        factor = block.factor(block.start[text] + at)
        inside = np.maximum(factor - window + 1, 0)
        mark(np.repeat(text, inside), np.repeat(at, inside) + _upto(inside))
        # Windows that cross the boundary: begun behind the last factor's first word, not inside it.
        low = np.maximum(begin + 1, begin + long - window + 1)
        across = np.maximum(np.minimum(at - 1, at + factor - window) - low + 1, 0)
        if across.any():
            own, word = np.repeat(text, across), np.repeat(low, across) + _upto(across)
            found = block.factor(block.start[own] + word) >= window
            mark(own[found], word[found])
        begin, long = at, factor
        at = at + np.maximum(factor, 1)
        going = at < count[text]
        text, at, begin, long = text[going], at[going], begin[going], long[going]
    return mask


def _upto(many: np.ndarray) -> np.ndarray:
    """0 .. m - 1 for each m."""
    return np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)


_PIECE = "h long, k binary, many long, windows int, content binary"


def _pieces(batch_words: Words, buf: np.ndarray, h, start, windows, keys, many, window: int) -> list[pa.Array]:
    """Columns of _PIECE; a stretch's content is its part of the text."""
    lo, hi = batch_words.start[start], batch_words.end[start + windows + window - 2]
    return [pa.array(h.view(np.int64)), pa.array(keys, pa.binary()), pa.array(many, pa.int64()), pa.array(windows, pa.int32()),
            pa.array([buf[a:b].tobytes() for a, b in zip(lo.tolist(), hi.tolist())], pa.binary())]


def _repeated_anchors(docs: DataFrame, text_col: str, window: int) -> KeyFilter:
    size = anchor_sizes(window)[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, text_col):
            words = nonspace_words(*text_bytes(part.column(text_col)), lower=False)
            h, many = np.unique(stretches(hashed_words(words), words.count, window, size)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(many)], names=["h", "many"])

    counted = docs.select(text_col).mapInArrow(run, "h long, many long").groupBy("h").agg(F.sum("many").alias("many"))
    return KeyFilter(persist(counted.filter("many > 1").select("h"), "repeats-anchors"), "h")


def _found(docs: DataFrame, anchors: KeyFilter, id_col: str, text_col: str, window: int) -> DataFrame:
    """A row for each document (its key, words, hash, and stretches with a repeated
    anchor) and a row for each distinct such stretch of a chunk (``n`` is null)."""
    size = anchor_sizes(window)[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, n = TaskContext.get().partitionId() << 40, 0
        for part in chunks(batches, text_col):
            buf, offsets = text_bytes(part.column(text_col))
            words = nonspace_words(buf, offsets, lower=False)
            seq = hashed_words(words)
            h, text, start, windows = stretches(seq, words.count, window, size)
            likely = anchors.may_hold(h)
            h, text, start, windows = h[likely], text[likely], start[likely], windows[likely]
            keys = stretch_keys(seq, start, windows, window)
            kept = [b" ".join(buf[a:b].tobytes().split()) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            row, n = row + n, part.num_rows
            cut = np.searchsorted(text, np.arange(n + 1))
            rows = [part.column(id_col), pa.array(np.arange(row, row + n)), pa.array([hashlib.blake2b(x, digest_size=16).digest() for x in kept], pa.binary()),
                    pa.array(words.count, pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in kept]),
                    pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(start - words.first()[text], pa.int32())),
                    pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(keys, pa.binary()))]
            names = ["id", "row", "c", "n", "sha", "starts", "keys", "h", "k", "many", "windows", "content"]
            kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays(rows + [pa.nulls(n, t) for t in kinds], names=names)
            if len(keys):
                code = np.asarray(pa.array(keys, pa.binary()).dictionary_encode().indices)
                _, one, many = np.unique(code, return_index=True, return_counts=True)
                pieces = _pieces(words, buf, h[one], start[one], windows[one], [keys[k] for k in one.tolist()], many, window)
                yield pa.RecordBatch.from_arrays([pa.nulls(len(one), c.type) for c in rows] + pieces, names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    return persist(docs.select(id_col, text_col).mapInArrow(
        run, f"id {kind}, row long, c binary, n long, sha string, starts array<int>, keys array<binary>, {_PIECE}"), "repeats-found")


def judged_stretches(pieces: DataFrame, window: int, level: int = 0, hot: int = HOT_STRETCHES) -> DataFrame:
    """(k, many, mask of repeated windows) of the stretches that have any.
    ``pieces``: rows of _PIECE, to be summed by their key."""
    sizes = anchor_sizes(window)
    stretch = persist(pieces.groupBy("h", "k").agg(F.sum("many").alias("many"), F.first("windows").alias("windows")), "repeats-stretches")
    result = stretch.filter("many > 1").selectExpr("k", "many", "shiftleft(1L, windows) - 1 AS mask")
    # Words are shipped for the groups that have to be parsed only.
    groups = persist(stretch.groupBy("h").agg(F.count("*").alias("kinds"), F.min("many").alias("least"))
                     .filter("kinds > 1 AND least = 1"), "repeats-groups")
    wanted = KeyFilter(groups.select("h"), "h")

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(wanted.may_hold(batch.column("h").to_numpy().view(np.uint64)), pa.bool_()))

    together = pieces.select("h", "k", "many", "content").mapInArrow(likely, "h long, k binary, many long, content binary").groupBy("h", "k").agg(
        F.sum("many").alias("many"), F.first("content").alias("content"))
    hot_groups = groups.filter(F.col("kinds") > hot).select("h")
    last = level + 1 >= len(sizes)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "h", BLOCK_BYTES):
            words = nonspace_words(*_contents(table), lower=False)
            many = table.column("many").to_numpy()
            mask = repeated_windows(words.code, words.count, many == 1, window)
            some = np.flatnonzero(mask)
            release()
            yield pa.RecordBatch.from_arrays([table.column("k").combine_chunks().take(pa.array(some)), pa.array(many[some]), pa.array(mask[some])],
                                             names=["k", "many", "mask"])

    split = not last and hot_groups.count() > 0
    if split:
        together = persist(together, "repeats-together")
    block = together.join(hot_groups, "h", "left_anti") if split else together
    result = result.unionByName(block.repartition(F.col("h")).sortWithinPartitions("h").mapInArrow(parse, "k binary, many long, mask long"))
    if not split:
        return result

    def longer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunks(batches, "content"):
            buf, offsets = _contents(pa.Table.from_batches([table]))
            words = nonspace_words(buf, offsets, lower=False)
            seq = hashed_words(words)
            h, text, start, windows = stretches(seq, words.count, window, sizes[level + 1])
            keys = stretch_keys(seq, start, windows, window)
            own = pa.array(text)
            many = table.column("many").to_numpy()[text]
            yield pa.RecordBatch.from_arrays(
                [table.column("k").take(own), pa.array(many == 1), pa.array(start - words.first()[text], pa.int32()),
                 *_pieces(words, buf, h, start, windows, keys, many, window)],
                names=["parent", "once", "shift", "h", "k", "many", "windows", "content"])

    parts = persist(together.join(hot_groups, "h", "left_semi").select("k", "many", "content").mapInArrow(
        longer, f"parent binary, once boolean, shift int, {_PIECE}"), "repeats-longer")
    below = persist(judged_stretches(parts.drop("parent", "once", "shift"), window, level + 1, hot), "repeats-below")
    total = parts.agg(F.sum("many")).first()[0]
    back = join_classes(parts.filter("once").select("parent", "shift", "k"), below, "k", "many", total)
    return result.unionByName(back.selectExpr("parent AS k", "shiftleft(mask, shift) AS mask").groupBy("k").agg(
        F.lit(1).cast("long").alias("many"), F.bit_or("mask").alias("mask")))


def _contents(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    content = table.column("content").combine_chunks().cast(pa.large_binary())
    offsets = np.frombuffer(content.buffers()[1], np.int64, len(content) + 1, content.offset * 8)
    raw = content.buffers()[2]
    raw = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def covered_ranges(row: np.ndarray, start: np.ndarray, mask: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first, last word) of the ranges that repeated windows cover. Each mark is
    (row, first word, mask) of a stretch; marks are sorted by row and first word."""
    bits = np.unpackbits(np.ascontiguousarray(mask, "<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    mark, bit = np.nonzero(bits)
    # Stretches of a text share no window, so the windows are in order.
    row, at = row[mark], start[mark].astype(np.int64) + bit
    fresh = np.ones(len(at), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (at[1:] > at[:-1] + window)
    head = np.flatnonzero(fresh)
    return row[head], at[head], at[np.append(head[1:], len(at))[:len(head)] - 1] + window - 1


_RANGES = "array<struct<first:long,last:long>>"


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   hot: int = HOT_STRETCHES) -> DataFrame:
    """One row per document: n_words, n_removed, kept_sha256 (of the kept words,
    joined by one space) and the removed ranges of words."""
    found = _found(docs, _repeated_anchors(docs, text_col, window), id_col, text_col, window)
    rows = found.filter(F.col("n").isNotNull())
    pieces = found.filter(F.col("n").isNull()).select("h", "k", "many", "windows", "content")
    outcome = persist(judged_stretches(pieces, window, hot=hot), "repeats-outcome")
    classes = persist(rows.groupBy("c").agg(F.count("*").alias("w")), "repeats-classes")
    known = persist(join_classes(rows.select("id", "row", "c", "n", "sha"), classes, "c", "w", rows.count()), "repeats-known")
    # Documents without a copy: the repeated windows of each, put together.
    places = rows.filter("size(keys) > 0").join(classes.filter("w > 1").select("c"), "c", "left_anti").select(
        "row", F.explode(F.arrays_zip("starts", "keys")).alias("x")).select("row", F.col("x.starts").alias("start"), F.col("x.keys").alias("k"))
    total = pieces.agg(F.sum("many")).first()[0] or 0
    marks = join_classes(places, outcome.select("k", "many", "mask"), "k", "many", total).select("row", "start", "mask")

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "row", MARK_BYTES):
            row, first, last = covered_ranges(*(table.column(c).to_numpy() for c in ("row", "start", "mask")), window)
            if len(row):
                cut = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
                spans = pa.StructArray.from_arrays([pa.array(first), pa.array(last)], names=["first", "last"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row[cut]), pa.array(np.add.reduceat(last - first + 1, cut)),
                     pa.ListArray.from_arrays(pa.array(np.append(cut, len(row)), pa.int32()), spans)], names=["row", "n_removed", "spans"])
            del table
            release()

    merged = marks.repartition(F.col("row")).sortWithinPartitions("row", "start").mapInArrow(cover, f"row long, n_removed long, spans {_RANGES}")
    covered = persist(known.filter("w = 1").select("row", "c", "n").join(merged, "row").select(
        "c", F.conv(F.hex(F.substring("c", 1, 8)), 16, -10).cast("long").alias("lead"), "n", "n_removed", "spans"), "repeats-covered")
    # Only a document that keeps some of its words is read again for their hash.
    partly = covered.filter("n_removed < n")
    wanted = KeyFilter(partly.select("lead"), "lead")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, text_col):
            buf, offsets = text_bytes(part.column(text_col))
            words = [b" ".join(buf[a:b].tobytes().split()) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            keys = [hashlib.blake2b(x, digest_size=16).digest() for x in words]
            likely = np.flatnonzero(wanted.may_hold(np.array([int.from_bytes(k[:8], "big") for k in keys], np.uint64))).tolist()
            yield pa.RecordBatch.from_arrays([pa.array([keys[k] for k in likely], pa.binary()),
                                              pa.array([words[k] for k in likely], pa.binary())], names=["c", "words"])

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "words"):
            left = []
            for words, spans in zip(part.column("words").to_pylist(), part.column("spans").to_pylist()):
                words, at, stay = words.split(), 0, []
                for span in spans:
                    stay += words[at:span["first"]]
                    at = span["last"] + 1
                left.append(hashlib.sha256(b" ".join(stay + words[at:])).hexdigest())
            yield pa.RecordBatch.from_arrays([*map(part.column, ("c", "n_removed")), pa.array(left, pa.string()), part.column("spans")],
                                             names=["c", "n_removed", "kept", "spans"])

    parted = docs.select(text_col).mapInArrow(keyed, "c binary, words binary").join(
        partly.select("c", "n_removed", "spans"), "c").mapInArrow(keep, f"c binary, n_removed long, kept string, spans {_RANGES}")
    judged = persist(parted.unionByName(covered.filter("n_removed = n").select(
        "c", "n_removed", F.lit(_EMPTY).alias("kept"), "spans")), "repeats-judged")
    single = known.filter("w = 1").join(judged, "c", "left").select(
        "id", "n", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), F.coalesce("kept", "sha").alias("kept"), "spans")
    # All windows of an exact copy are repeated.
    gone = F.col("n") >= window
    copied = known.filter("w > 1").select(
        "id", "n", F.when(gone, F.col("n")).otherwise(0).alias("n_removed"), F.when(gone, F.lit(_EMPTY)).otherwise(F.col("sha")).alias("kept"),
        F.when(gone, F.array(F.struct(F.lit(0).cast("long").alias("first"), (F.col("n") - 1).alias("last")))).alias("spans"))
    return copied.unionByName(single).select(
        F.col("id").alias(id_col), F.col("n").alias("n_words"), "n_removed", F.col("kept").alias("kept_sha256"),
        F.coalesce("spans", F.array().cast(_RANGES)).alias("spans"))
