"""Shared helpers of the training-data operators.

Texts reach Python as Arrow buffers. Words are found on the UTF-8 bytes with
numpy and turned into integer codes by Arrow's hash table, so no Python code
runs per word. A null text counts as the empty text everywhere.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Text bytes handled at once inside a task; one longer document is handled alone.
CHUNK_BYTES = 4 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# Words of the contract: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z.
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True
# Tokens between ASCII white space: [^\x20\x09-\x0D]+
_NONSPACE = np.ones(256, bool)
_NONSPACE[[32, 9, 10, 11, 12, 13]] = False

_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, elementwise."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, offsets) of a string column; nulls are empty texts."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def release() -> None:
    """Give freed memory back to the system, so that idle Python workers stay small."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def chunks(batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches' rows in slices of at most ``limit`` text bytes (a longer document alone)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(text).cast(pa.large_string())), 0)
        ends = np.cumsum(np.asarray(size, dtype=np.int64))
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(at, to - at)
            at = to
            release()


class Words:
    """The words of a chunk of texts.

    ``start``/``end``: byte range of each word; ``doc``: its text's index;
    ``code``: index into ``values``, the distinct words as a binary array;
    ``count``: words of each text.
    """

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, allowed: np.ndarray = _WORD, lower: bool = True):
        buf = _LOWER[buf] if lower else buf
        mask = allowed[buf]
        before = np.empty_like(mask)
        after = np.empty_like(mask)
        before[1:], after[:-1] = mask[:-1], mask[1:]
        if len(mask):
            before[0] = after[-1] = False
            inner = offsets[(offsets > 0) & (offsets < len(mask))]
            before[inner] = False
            after[inner - 1] = False
        self.start = np.flatnonzero(mask & ~before)
        self.end = np.flatnonzero(mask & ~after) + 1
        n_docs = len(offsets) - 1
        self.count = np.searchsorted(self.start, offsets[1:]) - np.searchsorted(self.start, offsets[:-1])
        self.doc = np.repeat(np.arange(n_docs), self.count)
        ends = np.zeros(len(self.start) + 1, np.int64)
        np.cumsum(self.end - self.start, out=ends[1:])
        self.code, self.values = distinct(buf[mask], ends)

    def first(self) -> np.ndarray:
        """Index of each text's first word (and the number of words at the end)."""
        return np.concatenate([[0], np.cumsum(self.count)])


def distinct(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Codes and distinct values of the strings data[ends[i]:ends[i+1]]."""
    n = len(ends) - 1
    values = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), n, [None, pa.py_buffer(np.ascontiguousarray(ends, np.int64)),
                               pa.py_buffer(np.ascontiguousarray(data))])
    coded = values.dictionary_encode()
    return np.asarray(coded.indices), coded.dictionary


def nonspace_words(buf: np.ndarray, offsets: np.ndarray, lower: bool = True) -> Words:
    return Words(buf, offsets, _NONSPACE, lower)


def lookup(values: pa.Array, known: pa.Array) -> np.ndarray:
    """Index of each value in ``known``, or -1."""
    if not len(known):
        return np.full(len(values), -1, np.int64)
    found = pc.index_in(values, value_set=known.cast(values.type))
    return np.asarray(pc.fill_null(found, -1)).astype(np.int64)


def whole_groups(batches: Iterator[pa.RecordBatch], key: str, limit: int = 64 << 20) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by ``key``, of some ``limit`` bytes at least."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy()
        if size + batch.nbytes > limit:
            # Cut before the last group of what there is.
            change = np.flatnonzero(keys[1:] != keys[:-1])
            cut = int(change[-1]) + 1 if len(change) else 0
            if cut or (held and held[-1].column(key)[-1].as_py() != keys[0]):
                yield pa.Table.from_batches([*held, batch.slice(0, cut)])
                held, size = [], 0
                batch = batch.slice(cut)
        held.append(batch)
        size += batch.nbytes
    if held:
        yield pa.Table.from_batches(held)


def kept(name: str, key: str, make):
    """An object that a Python worker keeps from task to task, one for each name;
    made anew for another key. A lost worker only makes it again."""
    cache = vars(sys).setdefault("_logsift_kept", {})
    if name not in cache or cache[name][0] != key:
        cache[name] = (key, make())
    return cache[name][1]


class Sent:
    """A broadcast of any object of this package, pickled by value so that
    executors need no copy of the package."""

    def __init__(self, spark: SparkSession, value):
        self._bytes = spark.sparkContext.broadcast(cloudpickle.dumps(value))
        self._value = None

    @property
    def value(self):
        if self._value is None:
            self._value = cloudpickle.loads(self._bytes.value)
        return self._value

    def drop(self) -> None:
        """Free the task's copy; it is loaded again when needed."""
        self._value = None


def held_in_fold(doc_id, fold: int):
    """crc32(doc_id as text) mod 5 == fold; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == fold


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def join_classes(rows: DataFrame, classes: DataFrame, key: str | list[str], weight: str, total: int) -> DataFrame:
    """``rows`` with the columns of their class. Classes that hold over a
    thousandth of the rows number under a thousand: those go by broadcast, so
    no hot key is shuffled; the others by an ordinary join."""
    heavy_from = max(2, total // 1000 + 1)
    heavy = classes.filter(F.col(weight) >= heavy_from)
    light = classes.filter(F.col(weight) < heavy_from)
    hot = rows.join(F.broadcast(heavy), key)
    rest = rows.join(F.broadcast(heavy.select(*([key] if isinstance(key, str) else key))), key, "left_anti").join(light, key)
    return hot.unionByName(rest)
