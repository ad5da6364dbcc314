"""Token ids in ORC files.

Documents are range-partitioned by id, so files hold ascending ids. Each file's
stripes store the ids of a document as an integer list, which ORC run-length
encodes; row indexes and Bloom filters on the document id let readers skip
stripes and row groups, and stripes can be read in parallel. A running count of
ids inside a file is stored with each document; the ids before a file are the
sum of the files before it (one number for each file).

Distinct pieces of a chunk (cut only where pre-tokens end, such as before white
space) are encoded once by the tokenizer library, remembered up to a bound, and
put together by array indexing, which gives the same ids as encoding whole texts.

Defined cases: a null text is empty and gives the end id alone; null ids come
first; rows that repeat an id are ordered by their text's hash; an empty table
gives empty files and no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logsift.llm.common import CHUNK_BYTES, Sent, chunks, distinct, kept, lookup, text_bytes
from logsift.session import shared_dir

END_ID = 2
STRIPE_BYTES, INDEX_ROWS = 16 << 20, 1000

_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
# Pre-tokens end between a letter and a mark. The bar is left out: it follows a
# letter inside special tokens.
_MARK = np.zeros(256, bool)
_MARK[33:48] = _MARK[58:65] = _MARK[91:97] = _MARK[[123, 125, 126]] = True


def wide_blank(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether a non-ASCII white-space character (or another of U+2000 to U+203F)
    ends at each place."""
    a, b, c = buf[np.maximum(at - 2, 0)], buf[np.maximum(at - 1, 0)], buf[at]
    return (((b == 0xC2) & ((c == 0x85) | (c == 0xA0))) | ((a == 0xE1) & (b == 0x9A) & (c == 0x80)) | ((a == 0xE2) & (b == 0x80))
            | ((a == 0xE2) & (b == 0x81) & (c == 0x9F)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80)))


def pieces(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where each piece begins: at a text's start, at each run of ASCII white
    space and at a mark behind a letter. A run that goes on from other white
    space is not cut off from it."""
    blank = _BLANK[buf]
    cut = np.zeros(len(buf), bool)
    cut[1:] = (blank[1:] & ~blank[:-1]) | (_MARK[buf[1:]] & _LETTER[buf[:-1]])
    behind = np.flatnonzero(cut[1:] & (buf[:-1] >= 0x80))
    cut[behind[wide_blank(buf, behind)] + 1] = False
    cut[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(cut)


class PieceEncoder:
    """Ids of texts by way of their distinct pieces. Pieces stay known from chunk
    to chunk and task to task; past ``limit`` of them it starts anew."""

    # Pieces sent to the library at once. Those that begin with white space and end
    # without are put in a row: pre-tokens end between them, and the ids are dealt out
    # again by their numbers of bytes. Others get a special token between them: the
    # library splits there and encodes what is between as if it stood alone.
    TOGETHER = 500

    def __init__(self, tokenizer, limit: int = 1_000_000):
        self.tokenizer = tokenizer
        self.limit = limit
        added = tokenizer.get_added_tokens_decoder()
        self.specials = [t.content for _, t in sorted(added.items()) if t.special and not (t.normalized or t.lstrip or t.rstrip or t.single_word)]
        self.separator = self.specials[0] if self.specials else None
        self.separator_id = tokenizer.token_to_id(self.separator) if self.separator else -1
        vocab = tokenizer.get_vocab()
        # In byte-level vocabularies a token has as many letters as it has bytes.
        self.width = np.zeros(max(vocab.values()) + 1, np.int64)
        self.width[list(vocab.values())] = [len(t) for t in vocab]
        self._clear()

    def _clear(self) -> None:
        self.known = pa.array([], pa.large_binary())
        self.first = np.zeros(1, np.int64)
        self.flat = np.zeros(0, np.int32)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode(self, raw: list[bytes], size: np.ndarray, in_a_row: bool) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces, how many each has)."""
        if in_a_row:
            ids = np.array(self._ids([b"".join(raw).decode("utf-8")])[0], np.int32)
            reached = np.cumsum(self.width[ids])
            last = np.searchsorted(reached, np.cumsum(size))
            if len(ids) and last[-1] == len(ids) - 1 and np.array_equal(reached[last], np.cumsum(size)):
                return ids, np.diff(last, prepend=-1)
        if len(raw) == 1:
            ids = np.array(self._ids([raw[0].decode("utf-8")])[0], np.int32)
            return ids, np.array([len(ids)])
        ids = np.array(self._ids([self.separator.encode().join(raw).decode("utf-8")])[0], np.int32)
        cut = np.flatnonzero(ids == self.separator_id)
        return np.delete(ids, cut), np.diff(np.concatenate([[-1], cut, [len(ids)]])) - 1

    def _learn(self, values: pa.Array) -> np.ndarray:
        """Encode pieces that are not known yet; their numbers."""
        # Pieces with a part of a special token in them are encoded alone.
        plain = np.full(len(values), self.separator is not None)
        for mark in {x for t in self.specials for x in (t[:2], t[-2:])}:
            plain &= ~np.asarray(pc.match_substring(values, mark))
        raw = values.to_pylist()
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        data = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum(size)
        row = plain & _BLANK[data[ends - size]] & ~_BLANK[data[ends - 1]] & ~wide_blank(data, ends - 1)
        parts = [np.flatnonzero(row), np.flatnonzero(plain & ~row), np.flatnonzero(~plain)]
        flat, many = [self.flat], []
        for kind, rows in enumerate(parts):
            step = 1 if kind == 2 else self.TOGETHER
            for lo in range(0, len(rows), step):
                own = rows[lo:lo + step]
                ids, count = self._encode([raw[k] for k in own.tolist()], size[own], kind == 0)
                flat.append(ids)
                many.append(count)
        order = np.concatenate(parts)
        numbers = np.empty(len(values), np.int64)
        numbers[order] = len(self.known) + np.arange(len(values))
        self.known = pa.concat_arrays([self.known, values.take(pa.array(order))])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(np.concatenate(many))])
        self.flat = np.concatenate(flat)
        return numbers

    def encode(self, buf: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each with the end id behind it; offsets of each text's ids)."""
        n = len(offsets) - 1
        starts = pieces(buf, offsets)
        ids, ends = np.zeros(0, np.int32), np.zeros(1, np.int64)
        if len(starts):
            code, values = distinct(buf, np.append(starts, len(buf)))
            if len(self.known) + len(values) > self.limit:
                self._clear()
            at = lookup(values, self.known)
            fresh = np.flatnonzero(at < 0)
            if len(fresh):
                at[fresh] = self._learn(values.take(pa.array(fresh)))
            code = at[code]
            many = np.diff(self.first)[code]
            ends = np.concatenate([[0], np.cumsum(many)])
            ids = self.flat[np.repeat(self.first[code] - ends[:-1], many) + np.arange(int(ends[-1]))]
        at = ends[np.searchsorted(starts, offsets)]
        ids = np.insert(ids, at[1:], end_id)
        return ids.astype(np.int32), at + np.arange(n + 1)


def write_token_files(docs: DataFrame, tokenizer_file: str, path: str, id_col: str = "doc_id", text_col: str = "text",
                      end_id: int = END_ID) -> None:
    """ORC files of (id, part, start_in_part, n_tokens, ids), ascending by id over the files."""
    with open(tokenizer_file, encoding="utf-8") as f:
        spec = Sent(docs.sparkSession, f.read())
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def make() -> PieceEncoder:
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_str(spec.value)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            return PieceEncoder(tokenizer)

        encoder = kept("piece-encoder", spec.value, make)
        number, before = TaskContext.get().partitionId(), 0
        for part in chunks(batches, text_col, 2 * CHUNK_BYTES):
            ids, at = encoder.encode(*text_bytes(part.column(text_col)), end_id)
            yield pa.RecordBatch.from_arrays(
                [part.column(id_col), pa.array(np.full(part.num_rows, number, np.int32)), pa.array(before + at[:-1]),
                 pa.array(np.diff(at)), pa.ListArray.from_arrays(at.astype(np.int32), pa.array(ids))],
                names=[id_col, "part", "start_in_part", "n_tokens", "ids"])
            before += int(at[-1])

    ordered = docs.select(id_col, text_col).withColumn("_tie", F.xxhash64(text_col))
    ordered = ordered.repartitionByRange(F.col(id_col), F.col("_tie")).sortWithinPartitions(id_col, "_tie")
    (ordered.select(id_col, text_col)
     .mapInArrow(run, f"`{id_col}` {kind}, part int, start_in_part long, n_tokens long, ids array<int>")
     .write.option("orc.bloom.filter.columns", id_col).option("orc.bloom.filter.fpp", "0.01")
     .option("orc.stripe.size", str(STRIPE_BYTES)).option("orc.create.index", "true")
     .option("orc.row.index.stride", str(INDEX_ROWS)).orc(path))


def read_token_files(spark: SparkSession, path: str, id_col: str = "doc_id", id_type: str = "bigint") -> DataFrame:
    """id, start, n_tokens, ids of every document in the files."""
    rows = spark.read.schema(f"`{id_col}` {id_type}, part int, start_in_part long, n_tokens long, ids array<int>").orc(path)
    # One row for each file.
    files = rows.groupBy("part").agg(F.sum("n_tokens").alias("own"))
    before = files.select("part", (F.sum("own").over(Window.orderBy("part")) - F.col("own")).alias("before"))
    return rows.join(F.broadcast(before), "part").select(
        id_col, (F.col("before") + F.col("start_in_part")).alias("start"), "n_tokens", "ids")


def digest(rows: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id, start, n_tokens, ids_crc32 (ids as little-endian unsigned 32-bit integers)."""
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            lists = part.column("ids")
            at = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0))]).astype(np.int64)
            raw = memoryview(np.ascontiguousarray(np.asarray(lists.flatten()), "<u4").tobytes())
            crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [part.column(id_col), part.column("start"), pa.array(np.diff(at)), pa.array(crc, pa.int64())],
                names=[id_col, "start", "n_tokens", "ids_crc32"])

    return rows.mapInArrow(run, f"`{id_col}` {kind}, start long, n_tokens long, ids_crc32 long")


def token_files_digest(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the token files to the shared folder, read them back and digest each document."""
    spark = docs.sparkSession
    path = shared_dir(spark, "token-files")
    write_token_files(docs, tokenizer_file, path, id_col, text_col)
    return digest(read_token_files(spark, path, id_col, docs.schema[id_col].dataType.simpleString()), id_col)
