import datetime as dt
import random

import pytest
from pyspark.sql import types as T

DATA = "/root/testdata/sf0.01"
# Columns of other names than the operators read, several of which they use themselves.
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()), T.StructField("id", T.StringType()), T.StructField("key", T.DateType()), T.StructField("size", T.DoubleType()),
    T.StructField("fp", T.StringType()), T.StructField("component_id", T.StringType()), T.StructField("shard", T.StringType()), T.StructField("a.b", T.IntegerType())])


def prose(seed, n, vocabulary=2000):
    r = random.Random(seed)
    return " ".join("w" + str(r.randrange(vocabulary)) for _ in range(n))


PASSAGE = prose("passage", 70)
ODD = [
    (1, prose(1, 120)), (2, prose(1, 120)), (2, prose(1, 120)), (3, prose(1, 119) + " other"), (4, None), (5, ""), (6, "  \n\t "), (None, prose(2, 60)), (None, None),
    (7, "word"), (8, "Two Words"), (9, prose(9, 40) + " " + PASSAGE + " " + prose(10, 50)), (10, prose(11, 200) + "\n" + PASSAGE), (11, prose(12, 60000)),
    (12, "x" * 200_000), (13, "ein zwei  drei \x1c vier\u00a0fünf 日本 \U0001f642"), (14, PASSAGE.upper()), (15, "same same same " * 100), (16, "same same same " * 90),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Null, empty, wordless, repeated, very long and very short documents, with extra columns."""
    rows = [(i, t, "en" if i and i % 2 else None, ("a", "b", None)[k % 3], len(t or ""), "z", dt.date(2024, 1, 1), 0.5, "f", "c", "s", k) for k, (i, t) in enumerate(ODD)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
