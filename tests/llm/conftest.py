import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_helpers import documents  # noqa: E402

# Names that operators use inside; a table may bring columns of its own with them.
CLASHES = ["score", "size", "fp", "mark", "part", "row", "_mark", "_text", "copies", "hits", "words", "n", "key", "host", "path",
           "at", "target", "spans", "ranges", "tokens", "class", "rank", "held_out", "y", "x", "seed", "pos", "to", "follows"]


@pytest.fixture(scope="session")
def tricky(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, equal
    ids with other texts, and extra columns with clashing names."""
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    rows = [(1, "one two three four five", "en", "a"), (1, "one two three four five", "en", "a"), (1, "another text", "en", "a"),
            (None, "no id here", "en", "a"), (None, None, None, None), (2, None, "de", None), (3, "", "en", "b"), (4, " \t\n ", "en", "b"),
            (5, long, "en", "b"), (6, long, None, "c"), (7, "x" * 50_000, "fr", "a/b"), (8, "é ñ ▁ \U0001F600 \x00 end", "es", "a"),
            (9, "Under the MIT License. CC BY-NC 4.0", "en", "c"), (-5, "negative id", "en", "c")]
    df = documents(spark, rows)
    return df.select("*", *[F.lit(f"extra {c}").alias(c) for c in CLASHES])


@pytest.fixture(scope="session")
def nothing(tricky):
    return tricky.where("false")


@pytest.fixture(scope="session")
def some_labels(spark):
    rows = [(1, 1, 0), (2, 0, 1), (3, 1, 0), (3, 0, 0), (None, 1, 1), (5, None, None), (7, 0, 1), (8, 1, 0), (9, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
