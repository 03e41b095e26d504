"""Small documents that hold every awkward case, and plain reference versions."""

import re

import duckdb

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(20000))
PASSAGE = " ".join(f"passage{i}" for i in range(40))
CASES = [
    (1, "The quick brown fox.\nThe quick brown fox.\n\n  tabs\tand spaces  "),
    (2, None),
    (3, ""),
    (4, " \n\t\r\n"),
    (5, LONG),
    (6, f"before {PASSAGE} after"),
    (7, f"other start\n{PASSAGE}\nother end"),
    (8, "a b c"),
    (8, "a b c"),
    (9, "a b c"),
    (None, "a null id, some words"),
    (None, None),
    (10, "Été İstanbul ΣΑΣ 你好世界 \U0001f600 é <|endoftext|> x <|startoftext|>"),
    (11, "naïve don't we'll I'M '' 's ''s 12345 ½² \x85 \x1c x​y"),
    (12, "x" * 3000 + " " + "ab" * 2500 + "!" * 700),
    (13, "one two " * 60),
    (14, "café" * 400),
]


def cases(spark, extra: bool = True):
    """CASES with further columns, some named like an operator's own."""
    rows = [(d, t, "en" if (d or 0) % 2 else None, f"s{(d or 0) % 3}", len(t or ""), i, -1.0) for i, (d, t) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept long, score double")
    return df if extra else df.select("doc_id", "text")


def documents():
    return duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet' order by doc_id").fetchall()


def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def words(text):
    return WORD.findall(text or "")
