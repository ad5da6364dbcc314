"""Benchmark decontamination with an FM-index per training shard.

A shard (a bounded chunk of a task's texts) is reduced to the benchmark's word
alphabet: a word outside it can be in no occurrence and becomes a separator,
and stretches shorter than a window are left out. Over the rest a suffix array,
its Burrows-Wheeler transform, a wavelet matrix (rank over large alphabets) and
sampled suffix positions form an FM-index. All windows are searched backwards
together, their occurrences are located by walking to sampled positions, and
the located spans are merged into removal spans.

Only the benchmark's windows travel to the tasks: its rows are collected and
broadcast in blocks of bounded size, so a task holds one block at a time. Texts
are never shuffled.

Defined cases: null and wordless texts have no words and no hits; a benchmark
row without words has no window; its null ``item_id`` gives hits but is not
listed; repeated rows are judged one by one; an empty benchmark hits nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsift.llm.common import Sent, Words, chunks, lookup, text_bytes
from logsift.session import persist

WINDOW = 13
# Contaminated: at least one hit word in this many.
HIT_SHARE = 20
# Bytes of benchmark text in a broadcast block, and text positions between two samples.
BLOCK_BYTES = 4 << 20
SAMPLE = 8

_SCHEMA = ("{id} {id_type}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
           "spans array<struct<first:long,last:long>>{clean}")


@dataclass
class Patterns:
    """Windows of one length: ``alphabet`` (binary array of words), ``codes``
    (windows x length, 1-based letters), and the items of each window (numbers in ``names``)."""

    length: int
    alphabet: pa.Array
    codes: np.ndarray
    item_start: np.ndarray
    items: np.ndarray
    names: list


def compile_windows(item_ids: list, texts: list, window: int = WINDOW) -> list[Patterns]:
    """The distinct windows of the benchmark texts, by length."""
    words = Words(*text_bytes(pa.array(texts, pa.large_string())))
    first, code = words.first(), words.code.astype(np.int64)
    names = sorted({x for x in item_ids if x is not None})
    number = {x: k for k, x in enumerate(names)}
    owner = np.array([number.get(x, -1) for x in item_ids], np.int64)
    size = np.minimum(words.count, window)
    out = []
    for length in np.unique(size[size > 0]).tolist():
        rows = np.flatnonzero(size == length)
        many = words.count[rows] - length + 1
        at = np.repeat(first[rows] - np.cumsum(many) + many, many) + np.arange(int(many.sum()))
        # A window's name grows word by word: equal names, equal windows.
        name = code[at]
        for k in range(1, length):
            name = np.unique(name * len(words.values) + code[at + k], return_inverse=True)[1]
        _, one, name = np.unique(name, return_index=True, return_inverse=True)
        at = at[one]
        used = np.zeros(len(words.values), bool)
        for k in range(length):
            used[code[at + k]] = True
        letter = np.cumsum(used).astype(np.int32)
        codes = np.stack([letter[code[at + k]] for k in range(length)], axis=1)
        listed = np.unique(name * (len(names) + 1) + np.repeat(owner[rows], many) + 1)
        named, item = np.divmod(listed, len(names) + 1)
        named, item = named[item > 0], item[item > 0] - 1
        out.append(Patterns(length, words.values.take(pa.array(np.flatnonzero(used))), codes,
                            np.searchsorted(named, np.arange(len(one) + 1)), item.astype(np.int32), names))
    return out


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array of ``text`` (letters >= 0) by prefix doubling. Each 0 is a
    separator of its own, smaller than any letter, ordered by position."""
    n = len(text)
    separators = text == 0
    rank = text + int(separators.sum())
    rank[separators] = np.arange(int(separators.sum()))
    rank = rank.astype(np.int64)
    step = 1
    while True:
        second = np.zeros(n, np.int64)
        second[:-step] = rank[step:] + 1
        key = rank * (int(rank.max()) + 2) + second
        order = np.argsort(key)
        new = np.empty(n, np.int64)
        new[order] = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
        rank = new
        if rank[order[-1]] == n - 1 or step >= n:
            return order
        step *= 2


class Wavelet:
    """Wavelet matrix: ``rank(c, i)`` counts letter ``c`` in the first ``i`` places."""

    def __init__(self, letters: np.ndarray, top: int):
        self.levels = []
        for level in range(max(1, int(top).bit_length()) - 1, -1, -1):
            bit = (letters >> level) & 1
            ones = np.concatenate([[0], np.cumsum(bit)])
            zeros = len(letters) - int(ones[-1])
            self.levels.append((level, ones, zeros))
            letters = np.concatenate([letters[bit == 0], letters[bit == 1]])

    def rank(self, c: np.ndarray, *places: np.ndarray) -> list[np.ndarray]:
        start = np.zeros(len(c), np.int64)
        at = list(places)
        for level, ones, zeros in self.levels:
            set_ = ((c >> level) & 1).astype(bool)
            start = np.where(set_, zeros + ones[start], start - ones[start])
            at = [np.where(set_, zeros + ones[x], x - ones[x]) for x in at]
        return [x - start for x in at]


class FMIndex:
    """FM-index of a text of letters with 0 as separator (the text ends with one)."""

    def __init__(self, text: np.ndarray, sample: int = SAMPLE):
        suffixes = suffix_array(text)
        self.bwt = text[suffixes - 1]
        self.wavelet = Wavelet(self.bwt, int(text.max()))
        self.below = np.concatenate([[0], np.cumsum(np.bincount(text))])
        # A walk never has to cross a separator: the place after one is sampled.
        self.sampled = (suffixes % sample == 0) | (self.bwt == 0)
        self.sample_rank = np.cumsum(self.sampled) - 1
        self.positions = suffixes[self.sampled]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [lo, hi) of the suffixes that begin with each pattern."""
        lo = np.zeros(len(patterns), np.int64)
        hi = np.zeros(len(patterns), np.int64)
        known = (patterns < len(self.below) - 1).all(axis=1)
        alive = np.flatnonzero(known)
        last = patterns[alive, -1]
        lo[alive], hi[alive] = self.below[last], self.below[last + 1]
        for k in range(patterns.shape[1] - 2, -1, -1):
            alive = alive[lo[alive] < hi[alive]]
            if not len(alive):
                break
            c = patterns[alive, k]
            low, high = self.wavelet.rank(c, lo[alive], hi[alive])
            lo[alive], hi[alive] = self.below[c] + low, self.below[c] + high
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows."""
        rows = rows.copy()
        steps = np.zeros(len(rows), np.int64)
        walking = np.flatnonzero(~self.sampled[rows])
        while len(walking):
            c = self.bwt[rows[walking]]
            rows[walking] = self.below[c] + self.wavelet.rank(c, rows[walking])[0]
            steps[walking] += 1
            walking = walking[~self.sampled[rows[walking]]]
        return self.positions[self.sample_rank[rows]] + steps


def occurrences(words: Words, patterns: Patterns) -> tuple[np.ndarray, np.ndarray]:
    """(first word, window) of every place where a window stands within one text."""
    none = np.zeros(0, np.int64)
    letter = (lookup(words.values, patterns.alphabet) + 1)[words.code] if len(words.code) else none
    known = letter > 0
    # Stretches of known words inside one text.
    fresh = known.copy()
    fresh[1:] &= ~(known[:-1] & (words.doc[1:] == words.doc[:-1]))
    starts = np.flatnonzero(fresh)
    if not len(starts):
        return none, none
    stretch = np.cumsum(fresh) - 1
    length = np.bincount(stretch[known], minlength=len(starts))
    keep = known & (length[stretch] >= patterns.length)
    place = np.flatnonzero(keep)
    if not len(place):
        return none, none
    # One separator after each stretch that is kept.
    number = np.cumsum(np.concatenate([[0], np.diff(stretch[place]) != 0]))
    text = np.zeros(len(place) + int(number[-1]) + 1, np.int64)
    text[np.arange(len(place)) + number] = letter[place]
    origin = np.zeros(len(text), np.int64)
    origin[np.arange(len(place)) + number] = place
    index = FMIndex(text)
    lo, hi = index.search(patterns.codes)
    many = hi - lo
    window = np.repeat(np.arange(len(many)), many)
    rows = np.repeat(lo - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(int(many.sum()))
    return origin[index.locate(rows)], window


def _mask(buf: np.ndarray, words: Words, hit: np.ndarray, k: int, offsets: np.ndarray, spans: list) -> str:
    """Text ``k`` without its removal spans."""
    first = words.first()[k]
    parts, at = [], offsets[k]
    for a, b in spans:
        parts.append(buf[at:words.start[first + a]].tobytes())
        at = words.end[first + b]
    parts.append(buf[at:offsets[k + 1]].tobytes())
    return b"".join(parts).decode("utf-8")


def scan(batch: pa.RecordBatch, id_col: str, text_col: str, blocks: list, clean: bool) -> pa.RecordBatch:
    buf, offsets = text_bytes(batch.column(text_col))
    words = Words(buf, offsets)
    n_docs, n_words = len(offsets) - 1, len(words.code)
    edge = np.zeros(n_words + 1, np.int64)
    doc_items: dict[int, set] = {}
    for block in blocks:
        for patterns in block.value:
            first, window = occurrences(words, patterns)
            np.add.at(edge, first, 1)
            np.add.at(edge, first + patterns.length, -1)
            if len(first):
                pairs = np.unique(words.doc[first] * len(patterns.codes) + window)
                for doc, w in zip(*map(np.ndarray.tolist, np.divmod(pairs, len(patterns.codes)))):
                    doc_items.setdefault(doc, set()).update(
                        patterns.names[k] for k in patterns.items[patterns.item_start[w]:patterns.item_start[w + 1]].tolist())
        if len(blocks) > 1:
            block.drop()
    hit = np.cumsum(edge[:-1]) > 0
    n_hit = np.bincount(words.doc[hit], minlength=n_docs).astype(np.int64)
    begin = words.first()
    spans: list[list] = [[] for _ in range(n_docs)]
    for k in np.flatnonzero(n_hit).tolist():
        flags = np.concatenate([[0], hit[begin[k]:begin[k + 1]].astype(np.int8), [0]])
        turn = np.diff(flags)
        spans[k] = list(zip(np.flatnonzero(turn == 1).tolist(), (np.flatnonzero(turn == -1) - 1).tolist()))
    nothing = hashlib.sha256(b"").hexdigest()
    listed = {k: sorted(map(str, s)) for k, s in doc_items.items()}
    sha = [hashlib.sha256(",".join(listed[k]).encode()).hexdigest() if k in listed else nothing for k in range(n_docs)]
    columns = [
        batch.column(id_col), pa.array(words.count.astype(np.int64)), pa.array(n_hit),
        pa.array([len(listed.get(k, ())) for k in range(n_docs)], pa.int64()), pa.array(sha, pa.string()),
        pa.array((n_hit > 0) & (HIT_SHARE * n_hit >= words.count)),
        pa.array([[{"first": a, "last": b} for a, b in s] for s in spans],
                 pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
    ]
    names = [id_col, "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans"]
    if clean:
        original = batch.column(text_col)
        columns.append(pa.array([_mask(buf, words, hit, k, offsets, spans[k]) if spans[k] else original[k].as_py()
                                 for k in range(n_docs)], pa.string()))
        names.append("clean_text")
    return pa.RecordBatch.from_arrays(columns, names=names)


def benchmark_blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int, block_bytes: int) -> list:
    """The compiled benchmark as broadcasts of about ``block_bytes`` text each."""
    spark = benchmark.sparkSession
    # Repeated rows have the same windows and items: one of them is enough, so blocks stay bounded.
    rows = persist(benchmark.select(F.col(item_col).alias("item"), F.col(text_col).alias("text"))
                   .filter(F.col("text").isNotNull()).distinct(), "benchmark-rows")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-total // block_bytes))
    blocks = []
    for k in range(count):
        part = rows if count == 1 else rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == k)
        found = part.collect()  # about block_bytes of benchmark text
        patterns = compile_windows([r["item"] for r in found], [r["text"] for r in found], window)
        if patterns:
            blocks.append(Sent(spark, patterns))
    return blocks


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  block_bytes: int = BLOCK_BYTES, clean: bool = False) -> DataFrame:
    """One row per document: words, hit words, items found, merged removal
    spans (word positions) and, with ``clean``, the text without them."""
    blocks = benchmark_blocks(benchmark, item_col, item_text, window, block_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, text_col):
            yield scan(part, id_col, text_col, blocks, clean)

    schema = _SCHEMA.format(id=f"`{id_col}`", id_type=docs.schema[id_col].dataType.simpleString(),
                            clean=", clean_text string" if clean else "")
    return docs.select(id_col, text_col).mapInArrow(run, schema)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without its contaminated rows; all columns and other rows stay.
    Each text is judged where it is read, so no join is needed."""
    blocks = benchmark_blocks(benchmark, "item_id", "text", WINDOW, BLOCK_BYTES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, text_col):
            judged = scan(part.select([text_col]).add_column(0, "_row", pa.array(range(part.num_rows))),
                          "_row", text_col, blocks, False)
            yield part.filter(pc.invert(judged.column("contaminated")))

    return docs.mapInArrow(run, docs.schema)
