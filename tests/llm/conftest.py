import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text, lang, source) tuples."""

    def build(rows):
        full = [(r + (None,) * (4 - len(r)))[:4] for r in rows]
        return spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None) for r in full], SCHEMA)

    return build


def odd_rows():
    """Nulls in any column, empty and long texts, ties, repeated rows, odd characters."""
    line = "The quick brown fox jumps over the lazy dog near the river bank"
    long = " ".join(f"w{i * 7919 % 3001}" for i in range(6000))
    return [
        (1, None, "en", "a"), (2, "", None, "b"), (3, "   \n\t", "en", None), (4, f"{line}\n{line.upper()}  \nx", "en", "a"),
        (5, f"  {line}\r\ny é", "fr", "a"), (6, f"{line}\n", "fr", "b"), (7, line, None, None), (8, line + "\nend\n", "en", "a"),
        (8, line + "\nend\n", "en", "a"), (9, long, "en", "c"), (10, long + " tail", "en", "c"), (None, f"{line}\nnull id", "en", "a"),
        (11, "naïve façade — “quoted” 漢字かな 🙂 \x00 end", "xx", "é"), (12, "a" * 5000, "en", "a"), (13, "word", "en", "a"),
    ]


@pytest.fixture(scope="session")
def odd(make):
    return make(odd_rows())


@pytest.fixture(scope="session")
def clashing(spark, odd):
    """The odd rows with further columns named like outputs and helpers."""
    from pyspark.sql import functions as F

    names = ("size", "target", "copies", "source_size", "n_lines", "n_dropped", "_q", "_id", "_key", "_a", "_low", "score", "rep", "label", "_row")
    return odd.select("*", *[F.lit(f"own {n}").alias(n) for n in names])


@pytest.fixture(scope="session")
def corpus(spark):
    """A small whole table of the test data."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
