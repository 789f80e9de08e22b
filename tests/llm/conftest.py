import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    from delayengine.llm.queries import reach

    reach(spark)
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet").cache()


@pytest.fixture(scope="session")
def benchmark(spark):
    return spark.read.parquet(f"{SF}/benchmark.parquet").cache()


ODD = "doc_id long, text string, lang string, source string, n_chars long, score double, removed long, matches string, `a b` int"


@pytest.fixture(scope="session")
def odd(spark, documents):
    """Nulls, empty texts, repeated rows, one id twice, a very long text, and columns with clashing names."""
    long = "lorem ipsum dolor sit amet " * 40_000
    rows = [
        (1, "one two three four five six seven", "en", "s", 1, 0.5, 1, "m", 1),
        (1, "one two three four five six seven", "en", "s", 1, 0.5, 1, "m", 1),
        (1, "another text of this very same id\nwith two lines", "en", None, None, None, None, None, None),
        (None, "one two three four five six seven", None, None, None, None, None, None, None),
        (None, None, None, None, None, None, None, None, None),
        (2, None, "en", "s", 0, 0.1, 0, "", 2),
        (3, "", "en", "s", 0, 0.1, 0, "", 2),
        (4, " \n\t\n ", "en", "s", 0, 0.1, 0, "", 2),
        (5, "123 456 --- !!!", "de", "s", 0, 0.1, 0, "", 2),
        (6, long, "en", "s", 0, 0.1, 0, "", 2),
        (7, "wörter mit ümlauten und 漢字 und 🎉\r\nzweite zeile", "de", "s", 0, 0.1, 0, "", 2),
    ]
    from delayengine.llm.queries import reach

    reach(spark)
    return spark.createDataFrame(rows, ODD).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], ODD)
