import pytest

LONG = " ".join(f"word{k % 977} and more, {k}." for k in range(20_000))

#: doc_id, text: null, empty, blank, long, tied and repeated rows.
ROWS = [
    (1, None), (2, ""), (3, " \t\n "), (4, "The quick brown fox jumps over the lazy dog. It's 9 o'clock!"), (5, LONG), (6, "The quick brown fox jumps over the lazy dog. It's 9 o'clock!"), (7, "Ünïcödé naïve ﬁne ½ 日本語 text"), (7, "Ünïcödé naïve ﬁne ½ 日本語 text"), (None, "a row without an id"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd rows with further columns whose names clash with the operators' own."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ROWS, "doc_id bigint, text string")
    extra = {c: F.lit(k) for k, c in enumerate(("words", "t", "key", "bits", "failed", "kept", "_row", "_gone", "_id", "repeats", "shared", "piece", "part", "gram", "h", "row", "media", "hits", "spans"))}
    return df.withColumns(extra).withColumn("n_chars", F.length("text").cast("bigint")).withColumn("lang", F.lit("en")).withColumn("source", F.lit("s"))


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def corpus(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
