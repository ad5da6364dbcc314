"""Brute-force versions and the small tables that all operators are tried on."""

import re
import zlib

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def tokens(text):
    return re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))


def fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5


LONG = " ".join(f"word{i % 977} of{i % 13}" for i in range(30_000))
ODD_TEXTS = [
    None, "", " ", "\n\t ", "one", "One two", "a b c d e f g h i j k l m n o p", "a b c d e f g h i j k l m n o p",
    "ÄÖÜ straße é ñ 日本語 🙂 x", "!!! ??? ...", LONG, LONG + " end", "x" * 5000, "a" * 50 + " " + "ab" * 60, "tab\tand\r\nlines\n\n\nend ",
    "zero\x00byte \x0b vt \x1c fs",
]
# Ids: unique ones, a null id, and rows that repeat an id (one with another text).
ODD_ROWS = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "no id here at all today"), (6, ODD_TEXTS[6]), (4, "another text")]

CLASH = "string"


def odd_docs(spark, rows=None, parts=3):
    """Rows with extra columns whose names the operators use themselves."""
    rows = ODD_ROWS if rows is None else rows
    schema = ("_id string, doc_id long, text string, node string, score string, `_first` string, k1 string, part string, "
              "`key` string, token string, n_words string, lang string")
    return spark.createDataFrame(
        [("x", i, t, "n", "s", "f", "k", "p", "y", "t", "w", "en") for i, t in rows], schema).repartition(parts)


def sorted_rows(df, *columns):
    return sorted(df.select(*columns).collect() if columns else df.collect(), key=repr)
