"""Alignment of two tokenizers' tokens over the bytes they share, as an Arrow pipeline.

A chunk of texts is encoded by both tokenizers. The id lists are flattened with
their parent indices, and a segmented cumulative sum of the token widths gives
each token's end inside its document. A full outer Acero hash join on the
document-end key brings the two streams together: a row is a stretch of bytes
between neighbouring ends, so it belongs to one token of each side (the next one
that ends), which is one link; a row with both sides is the end of a group.
Links are counted by Table.group_by for each document and for the chunk, and
Spark sums the chunks' counts over the corpus.

The counts then go back to the documents. Pairs that hold at least ``HEAVY`` of
all links number at most 1 / HEAVY and travel by broadcast; the rest are looked
up by a join of what the documents hold of them. What the first pass found is
stored, so no text is encoded twice.

Defined cases: null and empty texts, and texts whose tokens do not join to the
space and text again, have no tokens (zeros and an empty string); repeated rows
are aligned and counted one by one, also where they repeat an id or have none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsift.llm.common import Sent, chunks, kept, text_bytes
from logsift.llm.token_files import PieceEncoder
from logsift.session import persist

# Pairs with at least this share of all links are looked up by broadcast.
HEAVY = 1e-6
SPACE = "▁"
_COMMA, _SEMICOLON = (pa.scalar(x, pa.large_string()) for x in ",;")


class PlainPieces(PieceEncoder):
    """Ids of texts in which the strings of special tokens are plain text."""

    def __init__(self, tokenizer, plain):
        super().__init__(tokenizer)
        self.plain = plain

    def _encode(self, raw: list[bytes], size: np.ndarray, in_a_row: bool) -> tuple[np.ndarray, np.ndarray]:
        # Pieces with a part of a special string come alone.
        if len(raw) > 1:
            return super()._encode(raw, size, in_a_row)
        ids = np.array(self.plain.encode(raw[0].decode("utf-8"), add_special_tokens=False).ids, np.int32)
        return ids, np.array([len(ids)])


def byte_alphabet() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable
    Latin-1 letters are themselves, the other bytes are letters from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(other)}


class Pair:
    """Both tokenizers and the bytes of their tokens (tables as large as the vocabularies)."""

    def __init__(self, byte_bpe: str, pieces: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        plain = Tokenizer.from_str(byte_bpe)
        plain.encode_special_tokens = True
        self.a = PlainPieces(Tokenizer.from_str(byte_bpe), plain)
        letters = byte_alphabet()
        vocab = plain.get_vocab()
        bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            bytes_a[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.bytes_a = pa.array(bytes_a, pa.large_binary())
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = pa.array([bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode()
                                 for i, p in enumerate(names)], pa.large_binary())

    def encode_a(self, texts: pa.Array) -> pa.Array:
        """Id lists of space + text."""
        ids, ends = self.a.encode(*text_bytes(_spaced(texts)), -1)
        # The encoder puts an end id behind each text: take it out again.
        many = np.diff(ends) - 1
        return _lists(ids[ids >= 0], np.concatenate([[0], np.cumsum(many)]))

    def aligned(self, texts: pa.Array, strings: bool) -> tuple[pa.RecordBatch, list[pa.Array]]:
        """(a row for each text, [pairs, counts] of all of them)."""
        n = len(texts)
        some = np.flatnonzero(np.asarray(pc.binary_length(texts)) > 0)
        a, b = self.encode_a(texts.take(pa.array(some))), self.encode_b(texts.take(pa.array(some)))
        own = texts.take(pa.array(some))
        good = faithful(own, a, self.bytes_a) & faithful(own, b, self.bytes_b)
        some, keep = some[good], pa.array(np.flatnonzero(good))
        a, b = a.take(keep), b.take(keep)
        found = align(a, b, pc.binary_length(self.bytes_a), pc.binary_length(self.bytes_b))
        doc = np.asarray(_one(found.column("doc")))
        both = np.flatnonzero(np.asarray(pc.and_(_one(found.column("end_a")), _one(found.column("end_b")))))
        groups = group_strings(a, b, found, both)
        pair = pc.add(pc.multiply(_one(found.column("a")).cast(pa.int64()), len(self.bytes_b)), _one(found.column("b")).cast(pa.int64()))
        held = pa.table({"doc": found.column("doc"), "pair": pair}).group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
        held = held.sort_by([("doc", "ascending"), ("pair", "ascending")])
        total = held.group_by("pair", use_threads=False).aggregate([("count_all", "sum")])
        counts = np.zeros((4, n), np.int64)
        for k, x in enumerate((pc.list_value_length(a), pc.list_value_length(b), np.bincount(doc[both], minlength=len(some)),
                               np.bincount(doc, minlength=len(some)))):
            counts[k, some] = np.asarray(x)
        sha = np.full(n, "", object)
        sha[some] = [hashlib.sha256(g.as_buffer()).hexdigest() for g in groups]
        shown = np.full(n, None if not strings else "", object)
        if strings:
            shown[some] = groups.to_pylist()
        first = np.zeros(n + 1, np.int64)
        first[some + 1] = np.bincount(np.asarray(_one(held.column("doc"))), minlength=len(some))
        offsets = pa.array(np.cumsum(first), pa.int32())
        rows = pa.RecordBatch.from_arrays(
            [*map(pa.array, counts), pa.array(shown, pa.string()), pa.array(sha, pa.string()),
             pa.ListArray.from_arrays(offsets, _one(held.column("pair"))),
             pa.ListArray.from_arrays(offsets, _one(held.column("count_all")).cast(pa.int32()))],
            names=["n_a", "n_b", "n_groups", "n_links", "groups", "groups_sha256", "pairs", "counts"])
        once = pa.array([0, total.num_rows], pa.int32())
        return rows, [pa.ListArray.from_arrays(once, _one(total.column("pair"))),
                      pa.ListArray.from_arrays(once, _one(total.column("count_all_sum")).cast(pa.int32()))]

    def encode_b(self, texts: pa.Array) -> pa.Array:
        found = self.b.encode(texts.to_pylist(), num_threads=1)
        many = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.concatenate([np.array(x, np.int32) for x in found]) if len(found) else np.zeros(0, np.int32)
        return _lists(ids, np.concatenate([[0], np.cumsum(many)]))


def _spaced(texts: pa.Array) -> pa.Array:
    return pc.binary_join_element_wise(pa.scalar(" ", texts.type), texts, pa.scalar("", texts.type))


def _lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), pa.array(values, pa.int32()))


def _sums(values: np.ndarray, parent: np.ndarray, n: int) -> np.ndarray:
    """Sum of the values of each parent (parents ascend)."""
    total = np.concatenate([[0], np.cumsum(values)])
    return np.diff(total[np.searchsorted(parent, np.arange(n + 1))])


def _bytes_of(values: pa.Array) -> np.ndarray:
    """All bytes of a large binary array."""
    if not len(values):
        return np.zeros(0, np.uint8)
    _, offsets, data = values.buffers()
    at = np.frombuffer(offsets, np.int64, len(values) + 1, values.offset * 8)
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)


def faithful(texts: pa.Array, lists: pa.Array, table: pa.Array) -> np.ndarray:
    """Whether each text's tokens join to space + text."""
    raw, offsets = text_bytes(_spaced(texts))
    ids, parent = lists.flatten(), np.asarray(pc.list_parent_indices(lists))
    width = np.asarray(pc.binary_length(table).take(ids))
    size = np.diff(offsets)
    good = _sums(width, parent, len(lists)) == size
    joined = _bytes_of(table.take(ids.filter(pa.array(good[parent], pa.bool_()))))
    differs = raw[np.repeat(good, size)] != joined
    good[np.repeat(np.flatnonzero(good), size[good])[differs]] = False
    return good


def keyed_ends(lists: pa.Array, width: pa.Array, name: str) -> pa.Table:
    """(key, id) of every token: the key is its document in the chunk (upper half)
    and the byte at which it ends there (lower half)."""
    ids, parent = lists.flatten(), pc.list_parent_indices(lists).cast(pa.int64())
    run = pc.cumulative_sum(width.take(ids))
    # Segmented: take off what stood before the document.
    first = np.searchsorted(np.asarray(parent), np.arange(len(lists)))
    before = pa.array(np.concatenate([[0], np.asarray(run)])[first], pa.int64())
    end = pc.subtract(run, before.take(parent))
    return pa.table({"key": pc.bit_wise_or(pc.shift_left(parent, pa.scalar(32, pa.int64())), end), name: ids})


def align(a: pa.Array, b: pa.Array, width_a: pa.Array, width_b: pa.Array) -> pa.Table:
    """(doc, a, b, end_a, end_b) of every link, in order: the ids, and whether the
    side's token ends with the link. A group ends where both do."""
    table = keyed_ends(a, width_a, "a").join(keyed_ends(b, width_b, "b"), "key", join_type="full outer", use_threads=False)
    key, own_a, own_b = (_one(table.sort_by("key").column(c)) for c in ("key", "a", "b"))
    # Both sides end with a document, so no id is taken from the next one.
    return pa.table({
        "doc": pc.shift_right(key, pa.scalar(32, pa.int64())),
        "a": pc.fill_null_backward(own_a), "b": pc.fill_null_backward(own_b),
        "end_a": pc.is_valid(own_a), "end_b": pc.is_valid(own_b),
    })


def _one(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def group_strings(a: pa.Array, b: pa.Array, found: pa.Table, both: np.ndarray) -> pa.Array:
    """`a1,a2|b1;a3|b2,b3` of each document."""
    sides = []
    for lists, name in ((a, "end_a"), (b, "end_b")):
        ended = np.cumsum(np.asarray(_one(found.column(name))))
        text = pc.cast(lists.flatten(), pa.large_string())
        sides.append(pc.binary_join(_cut(text, np.concatenate([[0], ended[both]])), _COMMA))
    groups = pc.binary_join_element_wise(*sides, pa.scalar("|", pa.large_string()))
    doc = np.asarray(_one(found.column("doc")))[both]
    return pc.binary_join(_cut(groups, np.searchsorted(doc, np.arange(len(a) + 1))), _SEMICOLON)


def _cut(values: pa.Array, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def _first_pass(docs: DataFrame, files: tuple[str, bytes], id_col: str, text_col: str, strings: bool) -> DataFrame:
    """A row for each document (its counts, and the pairs it holds with how often)
    and a row for each chunk (the chunk's counts of pairs; ``row`` is null)."""
    sent = Sent(docs.sparkSession, files)
    name = hashlib.sha256(files[0].encode() + files[1]).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = kept("alignment", name, lambda: Pair(*sent.value))
        row = TaskContext.get().partitionId() << 40
        for part in chunks(batches, text_col):
            texts = pc.fill_null(part.column(text_col).cast(pa.large_string()), "")
            result = pair.aligned(texts, strings)
            whole = pa.RecordBatch.from_arrays(
                [part.column(id_col), pa.array(np.arange(row, row + part.num_rows)), *result[0].columns],
                names=["id", "row", *result[0].schema.names])
            row += part.num_rows
            yield whole
            nothing = [pa.nulls(1, whole.schema.field(k).type) for k in range(whole.num_columns - 2)]
            yield pa.RecordBatch.from_arrays([*nothing, *result[1]], names=whole.schema.names)

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        run, f"id {kind}, row long, n_a long, n_b long, n_groups long, n_links long, groups string, groups_sha256 string, "
             "pairs array<long>, counts array<int>")


def align_tokens(docs: DataFrame, byte_bpe_file: str, piece_file: str, id_col: str = "doc_id", text_col: str = "text",
                 heavy: float = HEAVY, strings: bool = False) -> DataFrame:
    """One row per document: n_a, n_b (tokens), n_groups, n_links, n_best (links
    whose pair is the most frequent of its B id in the corpus, ties included),
    count_sum (corpus-wide counts of its links' pairs), groups_sha256 and, with
    ``strings``, the groups themselves."""
    spark = docs.sparkSession
    with open(byte_bpe_file, encoding="utf-8") as a, open(piece_file, "rb") as b:
        files = a.read(), b.read()
    size_b = len(Pair(*files).bytes_b)
    found = persist(_first_pass(docs, files, id_col, text_col, strings), "alignment")
    counts = (found.filter(F.col("row").isNull()).select(F.explode(F.arrays_zip("pairs", "counts")).alias("x"))
              .groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.counts").alias("many")))
    counts = persist(counts, "alignment-counts")
    best = counts.groupBy((F.col("pair") % size_b).alias("b")).agg(F.max("many").alias("most"))
    # At most one row for each B id: the vocabulary bounds the broadcast.
    judged = persist(counts.join(F.broadcast(best), F.col("pair") % size_b == F.col("b")).select(
        "pair", "many", (F.col("many") == F.col("most")).alias("best")), "alignment-judged")
    total = judged.agg(F.sum("many")).first()[0] or 0
    least = max(1, int(heavy * total))
    known = judged.filter(F.col("many") >= least).orderBy("pair").toArrow()  # 1 / heavy rows at most
    sent = Sent(spark, tuple(np.asarray(_one(known.column(c))) for c in ("pair", "many", "best")))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, many, is_best = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column("pairs")
            own = np.asarray(lists.flatten())
            times = np.asarray(batch.column("counts").flatten()).astype(np.int64)
            parent = np.asarray(pc.list_parent_indices(lists))
            at = np.searchsorted(pairs, own)
            hit = at < len(pairs)
            hit[hit] = pairs[at[hit]] == own[hit]
            weight, flag = np.zeros(len(own), np.int64), np.zeros(len(own), bool)
            weight[hit], flag[hit] = many[at[hit]], is_best[at[hit]]
            rest = np.concatenate([[0], np.cumsum(~hit)])[np.searchsorted(parent, np.arange(batch.num_rows + 1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(_sums(times * flag, parent, batch.num_rows)),
                 pa.array(_sums(times * weight, parent, batch.num_rows)),
                 pa.ListArray.from_arrays(pa.array(rest, pa.int32()), pa.array(own[~hit])),
                 pa.ListArray.from_arrays(pa.array(rest, pa.int32()), pa.array(times[~hit]))],
                names=["row", "n_best", "count_sum", "pairs", "times"])

    rows = found.filter(F.col("row").isNotNull())
    weighed = persist(rows.select("row", "pairs", "counts").mapInArrow(
        weigh, "row long, n_best long, count_sum long, pairs array<long>, times array<long>"), "alignment-weighed")
    light = judged.filter(F.col("many") < least)
    rest = (weighed.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x"))
            .select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times")).join(light, "pair")
            .select("row", F.when(F.col("best"), F.col("times")).otherwise(0).alias("n_best"),
                    (F.col("times") * F.col("many")).alias("count_sum")))
    sums = weighed.select("row", "n_best", "count_sum").unionByName(rest).groupBy("row").agg(
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    columns = [F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return rows.drop("pairs", "counts").join(sums, "row").select(*columns, *(["groups"] if strings else []))
