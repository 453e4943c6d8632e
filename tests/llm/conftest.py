import os
import sys

import pytest
from pyspark.sql import functions as F

# Spark's Python workers import the operators' modules
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

SF001 = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omikron pi rho".split()


def sentence(seed: int, n: int) -> str:
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[x % len(WORDS)] + str(x // 977 % 50))
    return " ".join(out)


def edge_rows() -> list[tuple]:
    """NULLs in every column, empty and blank texts, ties, repeated rows, a very long text."""
    base = sentence(1, 60)
    return [
        (1, base, "en", "a", 10), (1, base, "en", "a", 10),          # a repeated row
        (2, base, "en", "b", None), (3, base + " omega", "en", None, 1),
        (4, "", "en", "a", 0), (5, None, None, None, None), (6, " \n\t ", "fr", "a", 4),
        (7, "word", "en", "a", 4), (8, "Word", "en", "a", 4),
        (None, sentence(2, 30), "en", "a", 1), (None, None, None, None, None),
        (9, sentence(3, 30_000), "en", "a", 1),
        (10, 'password = "hunter2secret9"\ntoken:abc AKIA' + "Q" * 16 + " " + "0a" * 20, "en", "a", 1),
        (11, "é" * 40 + "  doppelt  \n\n " + "日本 " * 12, "xx", "a", 1),
        (12, "x" * 100_000, "en", "a", 1), (13, "  \x1c a b  c ", "en", "a", 1),
    ]


#: Names that the operators use inside, or return.
CLASHES = ("row", "node", "key", "n", "_doc", "_row", "kept", "score", "shard", "length", "spans", "start", "lang2",
           "size", "component", "pair", "_text", "hash", "piece", "n_words", "_c", "_f", "_key", "virtual_slot", "t")


@pytest.fixture(scope="session")
def edge_docs(spark):
    df = spark.createDataFrame(edge_rows(), SCHEMA)
    for c in CLASHES:
        df = df.withColumn(c, F.lit("clash"))
    return df


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    def read(name):
        return spark.read.parquet(f"{SF001}/{name}.parquet")
    return read
