import random

import pytest
from pyspark.sql import types as T

WORDS = "the of and stone river light house mountain idiot trash yellow seven Ünder naïve 12 it's".split()

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # Extra columns, named like those the operators add.
    *(T.StructField(n, T.StringType()) for n in (
        "fp", "digest", "norm", "size", "rank", "root", "score", "held_out", "shard", "batch", "old",
        "cell", "length", "_row", "keep_id", "ids", "role", "n")),
])


def made_rows(seed=7):
    rnd = random.Random(seed)
    texts = [None, "", " ", "\n\t", "word", "one two", "ONE  two", "one two\n", "x" * 5000, "é ß ẞ 12³",
             "a\x0bb", "a b", "tok <|endoftext|> en", " nbsp em", "日本語 テキスト"]
    for _ in range(60):
        texts.append(" ".join(rnd.choice(WORDS) for _ in range(rnd.randrange(1, 120))))
    long = " ".join(rnd.choice(WORDS) + str(rnd.randrange(50)) for _ in range(30_000))
    texts.append(long)
    texts += [t + " end" for t in texts[20:40]] + texts[15:30] + [texts[20]] * 25
    rows = [(i * 3 - 5, t) for i, t in enumerate(texts)]
    rows += [(None, "no id"), (None, "no id"), (None, None), (10**17 + 1, "large id"), rows[3], rows[20]]
    return [(i, t, None if k % 5 == 0 else "en", "s", 1, *["?"] * 18) for k, (i, t) in enumerate(rows)]


@pytest.fixture(scope="session")
def odd_rows():
    return [(r[0], r[1]) for r in made_rows()]


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame(made_rows(), SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def docs_of(spark):
    """A documents table of these (doc_id, text) rows."""
    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", 0, *["?"] * 18) for i, t in rows], SCHEMA)

    return make
