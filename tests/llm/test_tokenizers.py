"""SentencePiece ids, token counts and token files against the libraries."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from logsift.llm import sentencepiece_codec as S
from logsift.llm import token_counts as C
from logsift.llm import token_files as T
from logsift.llm.common import text_bytes
from logsift.session import shared_dir
from tests.llm.helpers import ODD_ROWS, ODD_TEXTS, odd_docs

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")


def hard_texts(n=1500):
    rng = random.Random(7)
    letters = "ab'sth erons<|>i \n.,éÉ=日x09İſ½▁>-_   \x1c"
    out = [t for t in ODD_TEXTS if t is not None]
    out += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 80))) for _ in range(n)]
    ranges = [(32, 126), (0xA0, 0x24F), (0x250, 0x5FF), (0x1E00, 0x20FF), (0x4E00, 0x4EFF), (9, 13), (32, 32)]
    out += ["".join(chr(rng.randint(*rng.choice(ranges))) for _ in range(rng.randint(1, 60))) for _ in range(n)]
    return out + ["<|endoftext|>x <|endoftext|>  y \n<|startoftext|>\n", "ΣΑΣ ς ﬁ ½ ² Ǆ ª İI", "<s> </s> <unk> <0x41> ▁▁ ▁a",
                  "we'll 'S it's I'VE", "def f(x):\n    return  x\r\n;\r {\r"]


@pytest.fixture(scope="module")
def model():
    return S.PieceModel(PIECES)


def test_pieces_equal_the_library(model):
    texts = hard_texts()
    ids, at = S.Encoder(model).encode(*text_bytes(pa.array(texts, pa.large_string())))
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    want = sp.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == want
    assert S.decode(model, ids.astype(np.int64), at) == [sp.decode(x) for x in want]


def test_unbroken_texts_equal_the_library(model):
    rng = random.Random(8)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    encoder = S.Encoder(model)
    texts = ["".join(rng.choice(letters) for _ in range(n)) for letters in ("ab", "abcdefghijklmnopqrstuvwxyz", "theraino", "xé日本🙂", " a")
             for n in (510, 512, 513, 960, 961, 5000)]
    texts += [x * n for x in ("a", "ab", "the", "🙂", " ") for n in (600, 3000)] + ["".join(rng.choice(["the", "ing", "er", "x", "▁"]) for _ in range(900))]
    buf, offsets = text_bytes(pa.array(texts, pa.large_string()))
    ids, ends = encoder.encode(buf, offsets)
    assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == library.encode(texts)


def test_a_million_letters_advance_in_windows(model, monkeypatch):
    rng = random.Random(9)
    text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(1_000_000))
    steps = []
    advance = S.Encoder.advance
    monkeypatch.setattr(S.Encoder, "advance", lambda self, points: (steps.append(points.shape[1]), advance(self, points))[1])
    ids, _ = S.Encoder(model).encode(*text_bytes(pa.array([text], pa.large_string())))
    # A step for every character of a window and 512 windows, not one for every letter.
    assert max(steps) <= S.LONG_SEGMENT and len(steps) <= 7
    assert ids.tolist() == sentencepiece.SentencePieceProcessor(model_file=PIECES).encode(text)


def test_decoding_any_ids_equals_the_library(model):
    rng = random.Random(3)
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    lists = [[rng.randrange(3, 300) if rng.random() < 0.5 else rng.randrange(3, model.size) for _ in range(rng.randint(0, 12))]
             for _ in range(800)]
    at = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    assert S.decode(model, np.array([i for x in lists for i in x], np.int64), at) == [sp.decode(x) for x in lists]


def test_unigram_lattice_takes_the_largest_sum(model):
    """The same lattice with scores as a unigram model, against a plain search."""
    import copy

    unigram = copy.copy(model)
    unigram.unigram = True
    pieces = dict(zip(unigram.keys.tolist(), unigram.ids.tolist()))
    rng = random.Random(1)
    words = ["".join(rng.choice("theranosi") for _ in range(9)) for _ in range(40)]
    points = np.array([[ord(c) for c in w] for w in words], np.uint64)
    ids, many = S.Encoder(unigram).advance(points)
    ends = np.cumsum(many)
    for row, (a, b) in enumerate(zip(ends - many, ends)):
        best = [0.0] + [-np.inf] * 9
        for e in range(1, 10):
            for s in range(e):
                piece = pieces.get(S._hash_one(points[row, s:e]))
                if piece is not None:
                    best[e] = max(best[e], best[s] + unigram.score[piece])
        assert unigram.score[ids[a:b]].sum() == pytest.approx(best[9])


def test_codec_over_tables(spark):
    docs = odd_docs(spark)
    encoded = S.encode_docs(docs, PIECES)
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = sorted((str(r.doc_id), r.n_tokens, tuple(r.ids)) for r in encoded.collect())
    assert got == sorted((str(i), len(x), tuple(x)) for i, t in ODD_ROWS for x in [sp.encode(t or "")])
    texts = sorted((str(r.doc_id), r.text) for r in S.decode_docs(encoded, PIECES).collect())
    assert texts == sorted((str(i), t or "") for i, t in ODD_ROWS)
    trip = S.round_trip(docs, PIECES).collect()
    assert all(r.same_text for r in trip) and len(trip) == len(ODD_ROWS)
    for r in trip:
        if r.doc_id == 5:
            assert r.ids_crc32 == zlib.crc32(np.array(sp.encode("One two"), "<u4").tobytes())
    assert S.encode_docs(odd_docs(spark, []), PIECES).count() == 0


def test_counts_equal_the_library(spark):
    texts = hard_texts()
    counter = C.Counter(C.WordBpe(WORD))
    library = Tokenizer.from_file(WORD)
    got = counter.count(*text_bytes(pa.array(texts, pa.large_string())))
    assert got.tolist() == [len(e) for e in library.encode_batch(texts, add_special_tokens=False)]
    rows = C.count_tokens(odd_docs(spark), WORD).collect()
    want = sorted((str(i), len((t or "").encode()), n, n > 2048) for i, t in ODD_ROWS
                  for n in [len(library.encode(t or "", add_special_tokens=False))])
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in rows) == want
    assert C.count_tokens(odd_docs(spark, []), WORD).count() == 0


def test_unbroken_texts_are_counted_like_the_library():
    import random
    import time

    rng = random.Random(3)
    library = Tokenizer.from_file(WORD)
    counter = C.Counter(C.WordBpe(WORD))
    texts = ["".join(rng.choice(letters) for _ in range(n)) for letters in ("ab", "abcdefghijklmnopqrstuvwxyz", "theraino", "xé日")
             for n in (199, 200, 201, 500, 20_000)]
    texts += ["a" * n for n in (200, 201, 4000)] + ["word " + "na" * 300 + " end", "aaab" * 200]
    buf, offsets = text_bytes(pa.array(texts, pa.large_string()))
    assert counter.count(buf, offsets).tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    # A million letters: the heap takes one push for a letter at the start and two for a merge at most.
    long = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(1_000_000))
    at = time.perf_counter()
    got = counter.m.merge(pa.array([long.encode()], pa.large_binary()))[0][0]
    assert got == len(library.encode(long, add_special_tokens=False).ids) and time.perf_counter() - at < 120


def test_proven_strings_are_one_token():
    model = C.WordBpe(WORD)
    library = Tokenizer.from_file(WORD)
    some = [w for w in model.proven.to_pylist()[::97] if w.isalpha()]
    assert some and all(len(library.encode(w.decode(), add_special_tokens=False)) == 1 for w in some)


def test_chunk_ids_equal_the_library():
    rng = random.Random(11)
    blanks = " \n\t\u00a0\u3000\u2003\u0085 "
    texts = hard_texts() + ["".join(rng.choice(blanks + "ab.,'\u201d") for _ in range(rng.randint(1, 30))) for _ in range(3000)]
    library = Tokenizer.from_file(BYTE)
    want = [e.ids + [2] for e in library.encode_batch(texts, add_special_tokens=False)]
    for limit in (1_000_000, 100):
        encoder = T.PieceEncoder(library, limit)
        for lo in range(0, len(texts), 300):
            ids, at = encoder.encode(*text_bytes(pa.array(texts[lo:lo + 300], pa.large_string())), 2)
            assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == want[lo:lo + 300]


def test_token_files_round_trip(spark):
    library = Tokenizer.from_file(BYTE)
    docs = odd_docs(spark, parts=5)
    got = T.token_files_digest(docs, BYTE).collect()
    by_start = sorted(got, key=lambda r: r.start)
    at = 0
    for r in by_start:
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in by_start]
    assert ids == sorted(ids, key=lambda i: -1 if i is None else i)
    want = sorted((str(i), len(x), zlib.crc32(np.array(x, "<u4").tobytes()))
                  for i, t in ODD_ROWS for x in [library.encode(t or "", add_special_tokens=False).ids + [2]])
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == want
    assert T.token_files_digest(odd_docs(spark, []), BYTE).count() == 0


def test_files_prune_by_document_id(spark):
    path = shared_dir(spark, "test-token-files")
    T.write_token_files(odd_docs(spark, [(k, f"text number {k}") for k in range(5000)], 4), BYTE, path)
    read = T.read_token_files(spark, path)
    plan = read.filter("doc_id = 77")._jdf.queryExecution().toString()
    assert "EqualTo(doc_id,77)" in plan
    assert [len(r.ids) == r.n_tokens for r in read.filter("doc_id = 77").collect()] == [True]
    from pyarrow import orc

    folder = path.removeprefix("file:")
    import glob

    bytes_ = b"".join(open(f, "rb").read() for f in glob.glob(f"{folder}/*.orc"))
    assert bytes_ and orc.ORCFile(sorted(glob.glob(f"{folder}/*.orc"))[0]).nstripes >= 1


def test_files_hold_stripes_and_bloom_filters(spark, monkeypatch):
    n = 20_000
    monkeypatch.setattr(T, "STRIPE_BYTES", 64 << 10)
    path = shared_dir(spark, "test-token-stripes")
    T.write_token_files(odd_docs(spark, [(k * 7919, f"text number {k}") for k in range(n)], 4), BYTE, path)
    reader = spark._jvm.org.apache.orc.OrcFile
    conf = spark._jsc.hadoopConfiguration()
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    stripes = index = rows = 0
    for f in folder.getFileSystem(conf).listStatus(folder):
        if f.getPath().getName().endswith(".orc"):
            for stripe in reader.createReader(f.getPath(), reader.readerOptions(conf)).getStripes():
                stripes, index, rows = stripes + 1, index + stripe.getIndexLength(), rows + stripe.getNumberOfRows()
    # A Bloom filter with one false hit in a hundred takes over nine bits an id; bounds alone take a few bytes a row group.
    assert rows == n and stripes > 1 and index > n
    assert T.read_token_files(spark, path).filter("doc_id = 7919").count() == 1
    assert T.read_token_files(spark, path).filter("doc_id = 7920").count() == 0
