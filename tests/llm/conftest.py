import pytest

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


#: Rows every operator on documents must take: nulls, empty, long, repeated rows, clashing names.
ODD = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today with friends", "en", 5),
    (1, "The quick brown fox jumps over the lazy dog near the river bank today with friends", "en", 5),
    (2, None, "en", 1),
    (3, "", None, 2),
    (None, "a row without an id", "fr", 3),
    (None, None, None, None),
    (4, "x" * 100_000, "en", 7),
    (5, "word " * 20_000, "de", 7),
    (6, "!!! 123 \x1c  \t\n", "es", 0),
    (7, "é́ ẞ İ 😀 <|endoftext|> Σας", "es", 0),
]
ODD_SCHEMA = "doc_id long, text string, lang string, n_chars long"


@pytest.fixture(scope="session")
def odd(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(ODD, ODD_SCHEMA)
    # Names that operators use themselves.
    return rows.withColumns({
        n: F.lit("x") for n in (
            "score", "fp", "row", "size", "shard", "slot", "ids", "_0", "source", "_gone", "_t", "t", "id",
            "hash", "_before", "n", "word", "cell", "n_tokens", "width", "slab", "bucket", "_score", "_quality",
        )
    })


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("1 = 0")
