"""SentencePiece encoding and decoding with a batched numpy Viterbi.

Texts are cut where no piece can cross: before a space that follows another
character, and around ASCII characters that no piece holds. The distinct
segments of a chunk are grouped by length; segments of equal length advance
together, one character at a time; very long segments are cut into windows that
advance together and are stitched where that is proven to change nothing. Rolling hashes of their substrings probe the
sorted hashes of the pieces; for every end position the best last piece is kept
as a backpointer by array operations, and all segments are traced back at once.

A unigram model keeps the largest sum of piece scores. The public model is of
the BPE kind: its library merges greedily, and a plain largest-sum path gives
other ids. For such models the same lattice keeps, at every end, the piece that
merging would leave there: a piece may follow another only if merging their two
strings leaves exactly the pair. That is tested on the merge ranks of the pair's
inner symbols, vectorised, and remembered in a table.

Characters outside the vocabulary become byte pieces. Decoding concatenates the
pieces' bytes and removes the leading space that encoding had put in.

Defined cases: null and empty texts have no ids; repeated rows are encoded one
by one; bytes that form no character decode to U+FFFD; the unknown piece decodes
to " ⁇ " and control pieces to nothing.
"""

from __future__ import annotations

import codecs
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from logsift.llm.common import Sent, chunks, distinct, mix64, text_bytes

SPACE = "▁"
_STEP = np.uint64(0x9E3779B97F4A7C15)
_CACHE_BITS = 20
# Longer segments of BPE models are cut into windows of so many characters that overlap by so many.
LONG_SEGMENT, OVERLAP = 512, 64


class PieceModel:
    """The tables of a SentencePiece model with identity normalisation, read
    once on the driver and sent to the tasks (their size is the vocabulary's)."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        if proto.normalizer_spec.precompiled_charsmap or proto.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("only models that leave texts as they are can be encoded")
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.unigram = proto.trainer_spec.model_type == 1
        self.prefix = bool(proto.normalizer_spec.add_dummy_prefix)
        size = sp.get_piece_size()
        self.size = size
        pieces = [sp.id_to_piece(i) for i in range(size)]
        usual = [i for i in range(size) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.byte_id = np.full(256, sp.unk_id(), np.int64)
        self.bytes = []
        for i, piece in enumerate(pieces):
            if sp.is_byte(i):
                value = int(piece[3:-1], 16)
                self.byte_id[value] = i
                self.bytes.append(bytes([value]))
            elif sp.is_unknown(i):
                self.bytes.append(" ⁇ ".encode())
            else:
                self.bytes.append(b"" if sp.is_control(i) else piece.replace(SPACE, " ").encode())
        self.chars = np.array([len(p) for p in pieces])
        self.spaced = np.array([p.startswith(SPACE) for p in pieces])
        self.control = np.array([sp.is_control(i) for i in range(size)])
        self.score = np.array([sp.get_score(i) for i in range(size)])
        if any(SPACE in p.lstrip(SPACE) for p in (pieces[i] for i in usual)):
            raise ValueError("a piece has a space behind another character")
        self._merges({pieces[i]: i for i in usual})
        reachable = [i for i in usual if self.unigram or self.left[i] >= 0]
        points = [np.array([ord(c) for c in pieces[i]], np.uint64) for i in reachable]
        self.longest = max(len(p) for p in points)
        keys = np.array([_hash_one(p) for p in points], np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(reachable, np.int64)[order]
        held = {c for i in usual for c in pieces[i]}
        # ASCII bytes that no piece holds: always byte pieces of their own.
        self.alone = np.zeros(256, bool)
        self.alone[[b for b in range(128) if chr(b) not in held and b != 32]] = True

    def _merges(self, ids: dict[str, int]) -> None:
        """Ranks, and how merging builds each piece: ``left``/``right`` (the
        piece itself for single characters, -1 if merging never yields it)."""
        base = sorted(i for p, i in ids.items() if len(p) == 1)
        rest = sorted((i for p, i in ids.items() if len(p) > 1), key=lambda i: -self.score[i])
        self.rank = np.full(self.size, -1, np.int64)
        self.rank[base + rest] = np.arange(len(base) + len(rest))
        self.left = np.full(self.size, -1, np.int64)
        self.right = np.full(self.size, -1, np.int64)
        self.left[base] = self.right[base] = base
        for piece, i in ids.items():
            if len(piece) == 1 or self.unigram:
                continue
            parts = list(piece)
            while len(parts) > 1:
                ranks = [self.rank[ids[a + b]] if a + b in ids else self.size for a, b in zip(parts, parts[1:])]
                k = int(np.argmin(ranks))
                if ranks[k] == self.size:
                    break
                if len(parts) == 2:
                    self.left[i], self.right[i] = ids.get(parts[0], -1), ids.get(parts[1], -1)
                parts[k:k + 2] = [parts[k] + parts[k + 1]]
        made = np.flatnonzero((self.left >= 0) & (self.left != np.arange(self.size)))
        key = self.left[made] << 32 | self.right[made]
        order = np.argsort(key)
        self.pair_keys = np.concatenate([key[order], [np.iinfo(np.int64).max]])
        self.pair_rank = np.concatenate([self.rank[made[order]], [-1]])

    def merged_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the piece that merging a and b makes, or a number above all ranks."""
        key = a << 32 | b
        at = np.searchsorted(self.pair_keys, key)
        return np.where(self.pair_keys[at] == key, self.pair_rank[at], self.size)

    def may_follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the strings of pieces a and b leaves exactly (a, b).

        The inner symbols at the boundary are split again from the latest merge
        to the earliest; a pair of them that would have merged before the split
        one was made rules the boundary out. Equal ranks merge leftmost first.
        """
        good = np.ones(len(a), bool)
        rows = np.arange(len(a))
        a, b = a.copy(), b.copy()
        limit = np.full(len(a), self.size, np.int64)
        while len(rows):
            bad = self.merged_rank(a, b) < limit
            good[rows[bad]] = False
            ra, rb = self.rank[a], self.rank[b]
            a_next, b_next = self.right[a], self.left[b]
            split_a = ((ra > rb) & (a_next != a)) | ((ra <= rb) & (b_next == b) & (a_next != a))
            split_b = ~split_a & (b_next != b)
            limit = np.where(split_a, ra, np.where(split_b, rb + 1, limit))
            a, b = np.where(split_a, a_next, a), np.where(split_b, b_next, b)
            on = ~bad & (split_a | split_b)
            rows, a, b, limit = rows[on], a[on], b[on], limit[on]
        return good


def _hash_one(points: np.ndarray) -> int:
    total = 0
    for c in points.tolist():
        total = (total * int(_STEP) + c + 1) & 0xFFFFFFFFFFFFFFFF
    return total


class Encoder:
    """Encodes chunks of texts; keeps the boundary tests already made."""

    def __init__(self, model: PieceModel):
        self.m = model
        self._known = np.full(1 << _CACHE_BITS, -1, np.int64)
        self._good = np.zeros(1 << _CACHE_BITS, bool)

    def follows(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 32 | b
        slot = (mix64(key.astype(np.uint64)) >> np.uint64(64 - _CACHE_BITS)).astype(np.int64)
        good = self._good[slot]
        miss = np.flatnonzero(self._known[slot] != key)
        if len(miss):
            fresh, back = np.unique(key[miss], return_inverse=True)
            answer = self.m.may_follow(fresh >> 32, fresh & 0xFFFFFFFF)
            good[miss] = answer[back]
            self._known[slot[miss]], self._good[slot[miss]] = key[miss], good[miss]
        return good

    def probe(self, points: np.ndarray) -> np.ndarray:
        """ids[l - 1, row, s]: the piece that stands at [s, s + l) of the row, or -1."""
        n, length = points.shape
        prefix = np.zeros((n, length + 1), np.uint64)
        for k in range(length):
            prefix[:, k + 1] = prefix[:, k] * _STEP + (points[:, k] + np.uint64(1))
        out = np.full((min(length, self.m.longest), n, length), -1, np.int32)
        power = 1
        for size in range(1, len(out) + 1):
            power = power * int(_STEP) & 0xFFFFFFFFFFFFFFFF
            key = prefix[:, size:] - prefix[:, :-size] * np.uint64(power)
            at = np.minimum(np.searchsorted(self.m.keys, key), len(self.m.keys) - 1)
            out[size - 1, :, :length - size + 1] = np.where(self.m.keys[at] == key, self.m.ids[at], -1)
        return out

    def advance(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best paths of segments of equal length: (ids, number of ids per row).
        A character outside the vocabulary gives -1 - its code point."""
        m = self.m
        n, length = points.shape
        ids = self.probe(points)
        last = np.full((n, length + 1), -1, np.int64)
        size_of = np.ones((n, length + 1), np.int32)
        score = np.zeros((n, length + 1))
        # An unknown character scores below every piece, as one of itself.
        worst = m.score.min() - 10
        for end in range(1, length + 1):
            last[:, end] = -1 - points[:, end - 1].astype(np.int64)
            if m.unigram:
                score[:, end] = score[:, end - 1] + worst
            for size in range(1, min(end, len(ids)) + 1):
                begin = end - size
                found = ids[size - 1, :, begin]
                rows = np.flatnonzero(found >= 0)
                if not len(rows):
                    continue
                piece = found[rows].astype(np.int64)
                if m.unigram:
                    total = score[rows, begin] + m.score[piece]
                    better = total > score[rows, end]
                    score[rows[better], end] = total[better]
                elif begin:
                    before = last[rows, begin]
                    better = before < 0  # nothing merges with an unknown character
                    inner = np.flatnonzero(~better)
                    better[inner] = self.follows(before[inner], piece[inner])
                else:
                    better = np.ones(len(rows), bool)
                rows = rows[better]
                last[rows, end] = piece[better]
                size_of[rows, end] = size
        # Trace all rows back together; places fill from the right.
        out = np.zeros((n, length), np.int64)
        at, count = np.full(n, length), np.zeros(n, np.int64)
        rows = np.arange(n)
        while len(rows):
            count[rows] += 1
            out[rows, length - count[rows]] = last[rows, at[rows]]
            at[rows] -= size_of[rows, at[rows]]
            rows = rows[at[rows] > 0]
        keep = np.arange(length)[None, :] >= (length - count)[:, None]
        return out[keep], count

    def stitched(self, points: np.ndarray) -> np.ndarray:
        """Ids of one long segment of a BPE model. Its windows overlap and advance
        together; where the paths of two neighbours share a boundary whose two
        pieces may follow one another, one path goes over into the other. Then every
        piece of the whole path may follow the one before it, and only the path that
        merging leaves is like that. Without such a boundary the segment is
        encoded in one go."""
        n, stride = len(points), LONG_SEGMENT - OVERLAP
        starts = np.arange(0, n - OVERLAP, stride)
        full = starts[starts + LONG_SEGMENT <= n]
        windows = []
        for lo in range(0, len(full), 512):
            ids, many = self.advance(points[full[lo:lo + 512][:, None] + np.arange(LONG_SEGMENT)])
            windows += np.split(ids, np.cumsum(many)[:-1])
        for start in starts[len(full):].tolist():
            windows.append(self.advance(points[None, start:])[0])
        done, path, reached = [], windows[0], 0
        for start, ahead in zip(starts[1:].tolist(), windows[1:]):
            ends = reached + np.cumsum(np.where(path < 0, 1, self.m.chars[path]))
            others = start + np.concatenate([[0], np.cumsum(np.where(ahead < 0, 1, self.m.chars[ahead]))[:-1]])
            shared, a, b = np.intersect1d(ends, others, return_indices=True)
            left, right = path[a], ahead[b]
            good = (left < 0) | (right < 0)
            good[~good] = self.follows(left[~good], right[~good])
            if not good.any():
                return self.advance(points[None, :])[0]
            k = int(np.argmax(good))
            done.append(path[:a[k] + 1])
            path, reached = ahead[b[k]:], int(shared[k])
        return np.concatenate([*done, path])

    def segments(self, values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all distinct segments, where each one's begin; the total at the end)."""
        texts = [v.decode("utf-8").replace(" ", SPACE) for v in values.to_pylist()]
        length = np.fromiter(map(len, texts), np.int64, len(texts))
        flat = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        begin = np.concatenate([[0], np.cumsum(length)])[:-1]
        count = np.zeros(len(texts), np.int64)
        groups = []
        long = np.zeros(len(texts), bool) if self.m.unigram else length > LONG_SEGMENT
        for k in np.flatnonzero(long).tolist():
            ids = self.stitched(flat[begin[k]:begin[k] + length[k]].astype(np.uint64))
            ids, many = self._bytes(ids, np.array([len(ids)]))
            count[k] = many[0]
            groups.append((np.array([k]), ids))
        order = np.argsort(length, kind="stable")
        order = order[~long[order]]
        edges = np.flatnonzero(np.diff(length[order], prepend=-1))
        for lo, hi in zip(edges.tolist(), [*edges[1:].tolist(), len(order)]):
            size = int(length[order[lo]])
            step = max(1, (1 << 22) // (size * min(size, self.m.longest)))
            for k in range(lo, hi, step):
                rows = order[k:min(hi, k + step)]
                points = flat[begin[rows][:, None] + np.arange(size)].astype(np.uint64)
                ids, many = self.advance(points)
                ids, many = self._bytes(ids, many)
                count[rows] = many
                groups.append((rows, ids))
        start = np.concatenate([[0], np.cumsum(count)])
        out = np.zeros(int(start[-1]), np.int32)
        for rows, ids in groups:
            many = count[rows]
            out[_ranges(start[rows], many)] = ids
        return out, start

    def _bytes(self, ids: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Unknown characters replaced by their byte pieces."""
        unknown = np.flatnonzero(ids < 0)
        if not len(unknown):
            return ids, many
        raw = [chr(-1 - c).encode() for c in ids[unknown].tolist()]
        width = np.ones(len(ids), np.int64)
        width[unknown] = [len(r) for r in raw]
        owner = np.repeat(np.arange(len(many)), many)
        out = np.repeat(ids, width)
        first = np.concatenate([[0], np.cumsum(width)])[:-1]
        out[_ranges(first[unknown], width[unknown])] = self.m.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
        return out, np.bincount(owner, width, minlength=len(many)).astype(np.int64)

    def encode(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of each text's ids)."""
        n_docs = len(offsets) - 1
        if self.m.prefix and len(buf):
            filled = np.diff(offsets) > 0
            buf = np.insert(buf, offsets[:-1][filled], 32)
            offsets = offsets + np.concatenate([[0], np.cumsum(filled)])
        if not len(buf):
            return np.zeros(0, np.int32), np.zeros(n_docs + 1, np.int64)
        space, alone = buf == 32, self.m.alone[buf]
        cut = np.zeros(len(buf), bool)
        cut[1:] = (space[1:] & ~space[:-1]) | alone[1:] | alone[:-1]
        # The space sign may also stand in a text as itself; no cut behind it.
        sign = np.flatnonzero((buf[2:-1] == 0x81) & (buf[1:-2] == 0x96) & (buf[:-3] == 0xE2))
        cut[sign + 3] &= alone[sign + 3]
        cut[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(cut)
        code, values = distinct(buf, np.concatenate([starts, [len(buf)]]))
        ids, start = self.segments(values)
        many = np.diff(start)[code]
        out = ids[_ranges(start[code], many)]
        total = np.concatenate([[0], np.cumsum(many)])
        return out, total[np.searchsorted(starts, offsets)]


def _ranges(start: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The places start[i] .. start[i] + many[i] - 1, one after the other."""
    ends = np.cumsum(many)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(start - (ends - many), many) + np.arange(total)


def _one_each(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


def decode(model: PieceModel, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
    """The text of each list of ids."""
    codecs.register_error("one-each", _one_each)
    width = np.array([len(b) for b in model.bytes])
    table = np.frombuffer(b"".join(model.bytes), np.uint8)
    first = np.concatenate([[0], np.cumsum(width)])[:-1]
    sizes = width[ids]
    data = table[_ranges(first[ids], sizes)].tobytes()
    ends = np.concatenate([[0], np.cumsum(sizes)])[offsets]
    out = []
    for k in range(len(offsets) - 1):
        own = ids[offsets[k]:offsets[k + 1]]
        lead = own[np.argmin(model.control[own])] if len(own) else -1
        strip = model.prefix and lead >= 0 and model.spaced[lead]
        out.append(data[ends[k] + int(strip):ends[k + 1]].decode("utf-8", "one-each"))
    return out


def load(spark: SparkSession, path: str):
    """The model's tables as a broadcast (as large as its vocabulary)."""
    return Sent(spark, PieceModel(path))


def encode_docs(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, ids array<int> of every whole text."""
    model = load(docs.sparkSession, path)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model.value)
        for part in chunks(batches, text_col):
            ids, at = encoder.encode(*text_bytes(part.column(text_col)))
            yield pa.RecordBatch.from_arrays(
                [part.column(id_col), pa.array(np.diff(at)), pa.ListArray.from_arrays(at.astype(np.int32), pa.array(ids))],
                names=[id_col, "n_tokens", "ids"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, ids array<int>")


def decode_docs(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id, text of every list of ids (null: no ids)."""
    model = load(encoded.sparkSession, path)
    kind = encoded.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            lists = part.column(ids_col)
            at = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0))])
            texts = decode(model.value, np.asarray(lists.flatten()).astype(np.int64), at)
            yield pa.RecordBatch.from_arrays([part.column(id_col), pa.array(texts, pa.string())], names=[id_col, "text"])

    return encoded.select(id_col, ids_col).mapInArrow(run, f"`{id_col}` {kind}, text string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every whole text: id, n_bytes, n_tokens, ids_crc32 (of
    the ids as little-endian unsigned 32-bit integers), same_text."""
    model = load(docs.sparkSession, path)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model.value)
        for part in chunks(batches, text_col):
            buf, offsets = text_bytes(part.column(text_col))
            ids, at = encoder.encode(buf, offsets)
            raw = ids.astype("<u4").tobytes()
            crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            texts = decode(model.value, ids.astype(np.int64), at)
            whole = buf.tobytes()
            same = [t.encode() == whole[a:b] for t, a, b in zip(texts, offsets[:-1].tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [part.column(id_col), pa.array(np.diff(offsets)), pa.array(np.diff(at)), pa.array(crc, pa.int64()),
                 pa.array(same, pa.bool_())], names=[id_col, "n_bytes", "n_tokens", "ids_crc32", "same_text"])

    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, n_bytes long, n_tokens long, ids_crc32 long, same_text boolean")
