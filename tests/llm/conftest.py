import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet").cache()


@pytest.fixture(scope="session")
def benchmark(spark):
    return spark.read.parquet(f"{SF}/benchmark.parquet").cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows and clashing column names."""
    long = " ".join(f"word{i % 977} and the thing{i % 31}" for i in range(30_000))
    rows = [
        (1, "The cat sat on the mat, and the dog ran to the door.", "en", "a", 52),
        (2, None, "en", "a", None),
        (3, "", None, "b", 0),
        (4, "   \n\t ", "en", None, 6),
        (5, "The cat sat on the mat, and the dog ran to the door.", "en", "b", 52),
        (6, long, "en", "a", len(long)),
        (6, long, "en", "a", len(long)),
        (7, "12345 !!! ###", "de", "a", 13),
        (8, "ÄÖÜ der die das Straße und größer", None, None, 33),
        (None, "a row without an id", "en", "a", 19),
        (None, "a row without an id", "en", "a", 19),
        (None, None, None, None, None),
    ]
    clash = ["__n", "__key", "__h", "__m", "__quality", "__block", "row", "quality", "n", "h", "path", "tree"]
    extra = [(*r, i, "x", 1.5, i, *[f"{c}{i}" for c in clash]) for i, r in enumerate(rows)]
    return spark.createDataFrame(extra, SCHEMA + ", fp bigint, key string, score double, shard int, "
                                 + ", ".join(f"{c} string" for c in clash)).repartition(3)
