"""Quality classifier: a generalised additive model with pairwise interactions.

Every text is turned into a few shape measures by numpy over whole texts
(nothing is shuffled). Quantile cuts bin each measure. Cyclic boosting visits the measures in turn and fits a two-cut tree on
the binned residuals, adding its leaves to the measure's lookup table; then the
pairs with the largest four-quadrant gain get tables in the same way. A score
is the sum of looked-up bin values through the logistic function.

Only the fit reads labels, on at most ``max_rows`` labelled rows taken by a hash
of the id (a documented bound; the driver holds their bins, a few bytes a row).
The measures use the text alone.

Defined cases: null and empty texts are scored like any text (all measures 0);
without labelled rows the score is 0.5; labels of one kind only give a score
near that label; null labels and ids with contradicting labels are left out;
repeated rows are scored one by one and learnt from once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsift.llm.common import Sent, Words, chunks, held_in_fold, mix64, nonspace_words, text_bytes

THRESHOLD = 0.3
HELD_OUT_FOLD = 0
# Bound of the labelled rows that the fit reads.
MAX_ROWS = 50_000
# Text bytes measured at once; the measures' arrays take some thirty times as much.
CHUNK = 4 << 20

FEATURES = ("log_bytes", "log_words", "word_bytes", "upper", "digits", "symbols", "bangs", "pipes", "stops",
            "newlines", "non_ascii", "distinct_words", "repeats_previous", "repeats_pair", "top_word",
            "symbol_tokens", "short_words", "long_words", "line_words")


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[np.frombuffer(chars, np.uint8)] = True
    return out


_UPPER = _table(bytes(range(65, 91)))
_ALPHA = _UPPER | _table(bytes(range(97, 123)))
_DIGIT = _table(b"0123456789")
_SYMBOL = _table(b"#$%&*@^~<>{}[]\\=+_/")
_BANG = _table(b"!?")
_PIPE = _table(b"|\t")
_STOP = _table(b".,;:")
_LINE = _table(b"\n")
_HIGH = _table(bytes(range(128, 256)))


def measure(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The measures of each text, one row per text."""
    n = len(offsets) - 1
    size = np.diff(offsets)

    filled = np.flatnonzero(size)

    def per_doc(flags: np.ndarray) -> np.ndarray:
        total = np.zeros(n, np.int64)
        if len(filled):
            total[filled] = np.add.reduceat(flags, offsets[filled], dtype=np.int64)
        return total

    def share(part, whole):
        return part / np.maximum(whole, 1)

    count = {k: per_doc(t[buf]) for k, t in
             {"upper": _UPPER, "alpha": _ALPHA, "digit": _DIGIT, "symbol": _SYMBOL, "bang": _BANG, "pipe": _PIPE,
              "stop": _STOP, "line": _LINE, "high": _HIGH}.items()}
    words = Words(buf, offsets)
    tokens = nonspace_words(buf, offsets)
    doc, code, nw = words.doc, words.code.astype(np.int64), words.count
    width = max(1, len(words.values))
    length = words.end - words.start

    key = np.sort(doc * width + code)
    fresh = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
    kinds = np.bincount(key[fresh] // width, minlength=n)
    run = np.diff(np.concatenate([np.flatnonzero(fresh), [len(key)]]))
    top = np.zeros(n)
    if len(run):
        owner = key[fresh] // width
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        top[owner[first]] = np.maximum.reduceat(run, first)

    same_doc = doc[1:] == doc[:-1]
    again = np.bincount(doc[1:][same_doc & (code[1:] == code[:-1])], minlength=n)
    # Pairs of words hashed to 40 bits: a chunk holds fewer than 2^22 texts and words enough to tell them apart.
    pair = np.sort((doc[1:] << 40 | (mix64((code[:-1] * width + code[1:]).astype(np.uint64)) >> np.uint64(24)).astype(
        np.int64))[same_doc])
    pair_kinds = np.bincount(pair[np.concatenate([[True], pair[1:] != pair[:-1]])] >> 40, minlength=n) \
        if len(pair) else np.zeros(n)

    odd = per_doc((_SYMBOL | _BANG | _PIPE)[buf])  # symbols weighed against tokens
    out = np.stack([
        np.log1p(size), np.log1p(nw), share(np.bincount(doc, length, minlength=n), nw),
        share(count["upper"], count["alpha"]), share(count["digit"], size), share(count["symbol"], size),
        share(count["bang"], size), share(count["pipe"], size), share(count["stop"], nw),
        share(count["line"], nw), share(count["high"], size), share(kinds, nw), share(again, nw),
        1 - share(pair_kinds, np.maximum(nw - 1, 0)), share(top, nw), share(odd, tokens.count),
        share(np.bincount(doc, length <= 2, minlength=n), nw), share(np.bincount(doc, length >= 15, minlength=n), nw),
        share(nw, count["line"] + 1),
    ], axis=1)
    out[nw < 2, FEATURES.index("repeats_pair")] = 0
    return out


@dataclass
class Model:
    cuts: list = field(default_factory=list)
    intercept: float = 0.0
    tables: list = field(default_factory=list)
    # (first measure, second measure, table of bins x bins)
    pairs: list = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(self.cuts)], axis=1)

    def raw(self, bins: np.ndarray) -> np.ndarray:
        total = np.full(len(bins), self.intercept)
        for j, table in enumerate(self.tables):
            total += table[bins[:, j]]
        for a, b, table in self.pairs:
            total += table[bins[:, a], bins[:, b]]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.cuts:
            return np.full(len(x), 1 / (1 + np.exp(-self.intercept)))
        return 1 / (1 + np.exp(-np.clip(self.raw(self.bins(x)), -30, 30)))


def _gain(g, h, l2: float):
    return g * g / (h + l2)


def _shallow(g: np.ndarray, h: np.ndarray, l2: float) -> np.ndarray:
    """Leaf value per bin of the best tree with two cuts (three leaves) on one measure."""
    cg, ch = np.cumsum(g), np.cumsum(h)

    def cut(lo: int, hi: int) -> tuple[float, int]:
        """Best cut inside bins [lo, hi): its gain and the first bin of the right side."""
        if hi - lo < 2:
            return 0.0, hi
        bg, bh = (cg[lo - 1], ch[lo - 1]) if lo else (0.0, 0.0)
        lg, lh = cg[lo:hi - 1] - bg, ch[lo:hi - 1] - bh
        tg, th = cg[hi - 1] - bg, ch[hi - 1] - bh
        gain = _gain(lg, lh, l2) + _gain(tg - lg, th - lh, l2) - _gain(tg, th, l2)
        k = int(np.argmax(gain))
        return float(gain[k]), lo + k + 1

    _, first = cut(0, len(g))
    left, right = cut(0, first), cut(first, len(g))
    second = left[1] if left[0] >= right[0] else right[1]
    edges = sorted({0, first, second, len(g)})
    out = np.zeros(len(g))
    for lo, hi in zip(edges, edges[1:]):
        out[lo:hi] = g[lo:hi].sum() / (h[lo:hi].sum() + l2)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, l2: float) -> tuple[float, np.ndarray]:
    """Best four-leaf tree (one cut on each measure) on a grid of bins."""
    if min(g.shape) < 2:
        return 0.0, np.zeros(g.shape)
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    parts = []
    for c in (cg, ch):
        ll = c[:-1, :-1]
        lr, rl = c[:-1, -1:] - ll, c[-1:, :-1] - ll
        parts.append((ll, lr, rl, c[-1, -1] - ll - lr - rl))
    gain = sum(_gain(x, y, l2) for x, y in zip(*parts))
    a, b = np.unravel_index(int(np.argmax(gain)), gain.shape)
    values = [x[a, b] / (y[a, b] + l2) for x, y in zip(*parts)]
    out = np.empty(g.shape)
    out[:a + 1, :b + 1], out[:a + 1, b + 1:], out[a + 1:, :b + 1], out[a + 1:, b + 1:] = values
    return float(gain[a, b]), out


def fit(x: np.ndarray, y: np.ndarray, max_bins: int = 32, rounds: int = 120, rate: float = 0.15, n_pairs: int = 8,
        pair_rounds: int = 40, l2: float = 4.0) -> Model:
    """Cyclic boosting on measures ``x`` and labels ``y`` (0/1)."""
    if not len(y):
        return Model()
    rate_of_ones = (y.sum() + 0.5) / (len(y) + 1)
    model = Model(intercept=float(np.log(rate_of_ones / (1 - rate_of_ones))))
    model.cuts = [np.unique(np.quantile(c, np.linspace(0, 1, max_bins + 1)[1:-1])) for c in x.T]
    bins = model.bins(x)
    widths = [len(c) + 1 for c in model.cuts]
    model.tables = [np.zeros(w) for w in widths]
    raw = np.full(len(y), model.intercept)

    def slopes():
        p = 1 / (1 + np.exp(-raw))
        return y - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(rounds):
        for j, w in enumerate(widths):
            g, h = slopes()
            step = rate * _shallow(np.bincount(bins[:, j], g, w), np.bincount(bins[:, j], h, w), l2)
            model.tables[j] += step
            raw += step[bins[:, j]]

    def grid(a: int, b: int, g, h):
        flat = bins[:, a] * widths[b] + bins[:, b]
        return [np.bincount(flat, v, widths[a] * widths[b]).reshape(widths[a], widths[b]) for v in (g, h)]

    g, h = slopes()
    gains = [(_quadrants(*grid(a, b, g, h), l2)[0], a, b) for a in range(len(widths)) for b in range(a)]
    chosen = [(a, b) for gain, a, b in sorted(gains, reverse=True)[:n_pairs] if gain > 0]
    model.pairs = [(a, b, np.zeros((widths[a], widths[b]))) for a, b in chosen]
    for _ in range(pair_rounds):
        for a, b, table in model.pairs:
            g, h = slopes()
            step = rate * _quadrants(*grid(a, b, g, h), l2)[1]
            table += step
            raw += step[bins[:, a], bins[:, b]]
    return model


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", max_rows: int = MAX_ROWS) -> Model:
    """Fit on the labelled texts outside the held-out fold, at most ``max_rows`` of them.

    An id has one label: ids with contradicting labels are left out. Sampled ids
    are few by the bound, so they go to the texts by broadcast and no text is
    shuffled. An id may have many texts: equal ones count once, and the bound
    holds for the texts that the driver gets, in the order of their hashes."""
    usable = labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_y")).filter(
        F.col("_y").isin(0, 1) & ~held_in_fold("_id", HELD_OUT_FOLD)).groupBy("_id").agg(
        F.min("_y").alias("_y"), F.max("_y").alias("_other")).filter("_y = _other").select("_id", F.col("_y").cast("double").alias("_y"))
    n = usable.count()
    if n > max_rows:
        usable = usable.filter(F.pmod(F.xxhash64("_id", F.lit("quality")), F.lit(1 << 30)) < int(max_rows / n * (1 << 30)))
    texts = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text"))
    rows = texts.join(F.broadcast(usable), F.col("_doc") == F.col("_id"))
    n = rows.count()
    rows = rows.select("_text", "_y", F.xxhash64("_id", "_text").alias("_h"))
    if n > 2 * max_rows:
        rows = rows.filter(F.pmod("_h", F.lit(1 << 30)) < int(2 * max_rows / n * (1 << 30)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "_text", CHUNK):
            x = measure(*text_bytes(part.column("_text")))
            values = pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([values, part.column("_y"), part.column("_h")], names=["x", "y", "h"])

    found = (rows.mapInArrow(run, "x array<double>, y double, h long").dropDuplicates(["h"])
             .orderBy(F.pmod("h", F.lit(1 << 30)), "h").limit(max_rows).toArrow())
    y = found.column("y").to_numpy()
    x = np.array(found.column("x").to_pylist(), dtype=float).reshape(len(y), len(FEATURES))
    # The sums of the fit must not depend on the order in which rows arrive.
    order = np.lexsort([*x.T, y])
    return fit(x[order], y[order])


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             max_rows: int = MAX_ROWS) -> DataFrame:
    """id, held_out, score, predicted for every row of ``docs``."""
    kind = docs.schema[id_col].dataType.simpleString()
    sent = Sent(docs.sparkSession, train(docs, labels, id_col, text_col, max_rows=max_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, text_col, CHUNK):
            score = sent.value.score(measure(*text_bytes(part.column(text_col))))
            yield pa.RecordBatch.from_arrays([part.column(id_col), pa.array(score)], names=[id_col, "score"])

    scored = docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, score double")
    return scored.select(id_col, held_in_fold(id_col, HELD_OUT_FOLD).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows predicted 0; columns and other rows unchanged."""
    sent = Sent(docs.sparkSession, train(docs, labels, id_col, text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, text_col, CHUNK):
            score = sent.value.score(measure(*text_bytes(part.column(text_col))))
            yield part.filter(pa.array(score >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
