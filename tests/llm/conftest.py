import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def tables(spark, data):
    return lambda name: spark.read.parquet(f"{data}/{name}.parquet")


@pytest.fixture(scope="session")
def odd_rows():
    """Rows that any stage has to bear: nulls in each column, empty, blank, repeated, very long."""
    long_text = " ".join(f"w{i % 997}x{i % 13}" for i in range(60_000))
    return [
        (9001, None, "en", "src1", None), (9002, "", "en", None, 0), (9003, " \t\n\r\x0b\x0c ", None, "src1", 7), (None, "a text without an id", "en", "src2", 20), (9004, long_text, "en", "src3", len(long_text)), (9004, long_text, "en", "src3", len(long_text)),
        (9005, "same same", "fr", "src1", 9), (9006, "same same", "fr", "src1", 9), (9007, "ÀÉ \U0001f680\u00a0x\u2003y", "fr", "\U0001f680", 9), (9008, "nul \x00 and \x01 control", None, None, None), (None, None, None, None, None),
    ]


@pytest.fixture(scope="session")
def docs(spark, tables, odd_rows):
    """The smallest documents and the odd rows, with extra columns whose names the operators use too."""
    return tables("documents").select("doc_id", "text", "lang", "source", "n_chars").unionByName(spark.createDataFrame(odd_rows, DOCS)).coalesce(3).cache()


@pytest.fixture(scope="session")
def clashing(docs):
    names = ["size", "shard", "slot", "n_hit", "spans", "item_ids", "n_words", "toxic_score", "fp", "times", "h", "key", "cell", "mix_hash", "first_id", "place", "gone_", "row", "copy", "place_"]
    return docs.select("*", *[F.lit(f"own {n}").alias(n) for n in names])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
