"""Token counts by the whole-token shortcut.

Offline, every vocabulary string that stands for a whole pre-token is merged
from its characters; those that come out as one token are proven: a pre-token
equal to one of them counts 1 without merging. A chunk's texts are cut at white
space, which no pre-token crosses, and the distinct pieces are split into
pre-tokens once. Proven pre-tokens are matched by one hash-table probe; only the
rest is merged, all distinct ones of a chunk together: each round finds every
word's best pair by array lookups and joins all its places. Very long words
(unbroken text) are merged alone with a heap, n log n in their length.

The tables are the vocabulary's own (a fixed size) and are sent to the tasks.
Pieces with letters beyond Latin are normalised and split by the tokenizer
file's own rules through its library; counting stays with the shortcut.

Defined cases: a null text counts as empty and has 0 tokens; a special token's
string inside a text is that one token, as the library does by default;
repeated rows are counted one by one.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsift.llm.common import Sent, chunks, lookup, nonspace_words, text_bytes

LIMIT = 2048
# Words of more bytes are merged one by one.
LONG_WORD = 200

# Letters whose normal form is known: ASCII, and Latin letters with their accents composed.
_PLAIN = regex.compile(r"[\x21-\x7eÀ-ɏ]*")


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = {b: chr(b) for b in keep}, 256
    for b in range(256):
        if b not in out:
            out[b] = chr(extra)
            extra += 1
    return [out[b] for b in range(256)]


class WordBpe:
    """Tables of a byte-level BPE file with word ends, and the proven strings."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        steps = [n.get("type") for n in spec["normalizer"]["normalizers"]]
        if steps != ["NFC", "Replace", "Lowercase"]:
            raise ValueError("the file's normaliser is not composition, white space and lower case")
        self.pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.specials = [t["content"] for t in spec["added_tokens"]]
        # Normaliser and splitting without the vocabulary, for the rare letters.
        self.rules = json.dumps(spec | {"added_tokens": [], "model": model | {"vocab": {}, "merges": []}})
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.last = np.array([vocab[c + end] for c in letters], np.int64)
        pairs = [(vocab[a], vocab[b], vocab[a + b]) for a, b in map(tuple, model["merges"])]
        key = np.array([a << 32 | b for a, b, _ in pairs], np.int64)
        order = np.argsort(key)
        self.pair_key = np.append(key[order], np.iinfo(np.int64).max)
        self.pair_rank = np.append(order, 0)
        self.made = np.array([c for _, _, c in pairs], np.int64)
        self._made: dict | None = None
        self.proven = pa.array([], pa.large_binary())
        self._prove(vocab, end, letters)

    def _prove(self, vocab: dict, end: str, letters: list[str]) -> None:
        """Keep the strings that merging turns into their one token."""
        value = {c: b for b, c in enumerate(letters)}
        whole = [(bytes(value[c] for c in t[: len(t) - len(end)]), i) for t, i in vocab.items() if end and t.endswith(end)]
        whole = [(w, i) for w, i in whole if w]
        count, first = self.merge(pa.array([w for w, _ in whole], pa.large_binary()))
        good = [w for (w, i), n, f in zip(whole, count.tolist(), first.tolist()) if n == 1 and f == i]
        self.proven = pa.array(good, pa.large_binary())

    def merge(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(number of tokens, first token) of each non-empty word. Long words are
        merged one by one: the rounds of the others' common merging would grow with them."""
        size = np.asarray(pc.binary_length(words)).astype(np.int64)
        count, first = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        short = np.flatnonzero(size <= LONG_WORD)
        count[short], first[short] = self._merge_together(words.take(pa.array(short)))
        for k in np.flatnonzero(size > LONG_WORD).tolist():
            count[k], first[k] = self._merge_alone(words[k].as_py())
        return count, first

    def _merge_alone(self, word: bytes) -> tuple[int, int]:
        """(number of tokens, first token) of one word: its pairs wait in a heap in the
        order of rank and place, so the work is n log n in its length."""
        if self._made is None:
            self._made = dict(zip(self.pair_key[:-1].tolist(), zip(self.pair_rank[:-1].tolist(), self.made[self.pair_rank[:-1]].tolist())))
        data = np.frombuffer(word, np.uint8)
        array = self.inner[data]
        array[-1] = self.last[data[-1]]
        key = array[:-1] << 32 | array[1:]
        at = np.searchsorted(self.pair_key, key)
        place = np.flatnonzero(self.pair_key[at] == key)
        heap = list(zip(self.pair_rank[at[place]].tolist(), place.tolist()))
        heapq.heapify(heap)
        token, n, made = array.tolist(), len(array), self._made
        behind, before, count = list(range(1, n + 1)), list(range(-1, n - 1)), n
        while heap:
            rank, i = heapq.heappop(heap)
            j = behind[i]
            if token[i] < 0 or j >= n:
                continue
            found = made.get(token[i] << 32 | token[j])
            if found is None or found[0] != rank:
                continue  # one of the two was merged meanwhile
            token[i], token[j] = found[1], -1
            count -= 1
            k, h = behind[j], before[i]
            behind[i] = k
            if k < n:
                before[k] = i
                found = made.get(token[i] << 32 | token[k])
                if found is not None:
                    heapq.heappush(heap, (found[0], i))
            if h >= 0:
                found = made.get(token[h] << 32 | token[i])
                if found is not None:
                    heapq.heappush(heap, (found[0], h))
        return count, token[0]

    def _merge_together(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same for many short words at once: a round merges the best pair of every word."""
        n = len(words)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        raw = words.to_pylist()
        size = np.array([len(w) for w in raw], np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        token = self.inner[data]
        ends = np.cumsum(size)
        token[ends - 1] = self.last[data[ends - 1]]
        word = np.repeat(np.arange(n), size)
        count, first = np.zeros(n, np.int64), np.zeros(n, np.int64)
        never = len(self.made)
        while len(token):
            rank = np.full(len(token), never, np.int64)
            key = token[:-1] << 32 | token[1:]
            at = np.searchsorted(self.pair_key, key)
            rank[:-1] = np.where((self.pair_key[at] == key) & (word[:-1] == word[1:]), self.pair_rank[at], never)
            start = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            best = np.minimum.reduceat(rank, start)
            length = np.diff(np.append(start, len(token)))
            done = best == never
            count[word[start[done]]], first[word[start[done]]] = length[done], token[start[done]]
            going = np.repeat(~done, length)
            hit = going & (rank == np.repeat(best, length))
            # Overlapping places of one pair (aaa): every second one of a run, from the left.
            place = np.flatnonzero(hit)
            if len(place):
                fresh = np.concatenate([[True], np.diff(place) != 1])
                run = np.cumsum(fresh) - 1
                odd = (np.arange(len(place)) - np.flatnonzero(fresh)[run]) % 2 == 1
                place = place[~odd]
            token[place] = self.made[rank[place]]
            keep = going
            keep[place + 1] = False
            token, word = token[keep], word[keep]
        return count, first


class Counter:
    """Counts tokens of chunks of texts with a model's tables."""

    def __init__(self, model: WordBpe):
        self.m = model
        self.find = regex.compile(model.pattern).findall
        self.special = regex.compile("|".join(map(regex.escape, model.specials))) if model.specials else None
        self._library = None

    def _rare(self, piece: str) -> list[str]:
        """Pre-tokens by the file's own rules."""
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_str(self.m.rules)
            letters = byte_letters()
            self._bytes = {c: b for b, c in enumerate(letters)}
        text = self._library.normalizer.normalize_str(piece)
        return [bytes(self._bytes[c] for c in t) for t, _ in self._library.pre_tokenizer.pre_tokenize_str(text)]

    def _pretokens(self, piece: str) -> tuple[list[bytes], int]:
        """The pre-tokens of a piece of text, and the special tokens in it."""
        special = 0
        parts = [piece]
        if self.special is not None and "<|" in piece:
            parts = self.special.split(piece)
            special = len(parts) - 1
        out: list[bytes] = []
        for part in parts:
            if _PLAIN.fullmatch(part):
                out.extend(t.encode() for t in self.find(part.lower()))
            else:
                out.extend(self._rare(part))
        return out, special

    def count(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text."""
        pieces = nonspace_words(buf, offsets, lower=False)
        split = [self._pretokens(v.decode("utf-8")) for v in pieces.values.to_pylist()]
        many = np.array([len(p) for p, _ in split], np.int64)
        coded = pa.array([t for p, _ in split for t in p], pa.large_binary()).dictionary_encode()
        words = coded.dictionary
        tokens = np.ones(len(words), np.int64)
        rest = np.flatnonzero(lookup(words, self.m.proven) < 0)
        tokens[rest] = self.m.merge(words.take(pa.array(rest)))[0]
        per_piece = np.bincount(np.repeat(np.arange(len(split)), many), tokens[np.asarray(coded.indices)], minlength=len(split))
        per_piece += np.array([s for _, s in split], np.int64)
        return np.bincount(pieces.doc, per_piece[pieces.code], minlength=len(offsets) - 1).astype(np.int64)


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """id, n_bytes, n_tokens, over_limit of every whole text."""
    model = Sent(docs.sparkSession, WordBpe(path))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(model.value)
        for part in chunks(batches, text_col):
            buf, offsets = text_bytes(part.column(text_col))
            yield pa.RecordBatch.from_arrays(
                [part.column(id_col), pa.array(np.diff(offsets)), pa.array(counter.count(buf, offsets))],
                names=[id_col, "n_bytes", "n_tokens"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > limit)
