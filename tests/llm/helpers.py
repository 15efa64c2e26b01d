"""Small document tables for the tests of this folder."""

import random

from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()),
                   StructField("lang", StringType()), StructField("source", StringType()),
                   StructField("n_chars", LongType())])

#: Names that the operators use inside; a table may have them, too.
CLASHING = ["id", "row", "node", "hash", "rank", "shard", "slot", "block", "length", "at", "h"]


def documents(spark, texts, ids=None, sources=None, partitions=3):
    ids = list(range(len(texts))) if ids is None else ids
    sources = sources or [f"src{i % 3}" for i in range(len(texts))]
    rows = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in zip(ids, texts, sources)]
    return spark.createDataFrame(rows, DOCS).repartition(partitions)


def with_clashing(df):
    from pyspark.sql import functions as F
    return df.withColumns({c: F.lit("x") for c in CLASHING})


def words(rng: random.Random, n: int, vocabulary: int = 5000) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


ODD = [None, "", " \n\t ", "one", "one", "ONE", "one two three", "é̈ ☃ 日本語", "x" * 5000,
       "\x1c \x1d a\x85b c", "a\r\nb\r\n", "<|endoftext|> <|end"]
