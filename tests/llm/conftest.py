import pytest

SF = "/root/testdata/sf0.001"

# NULLs in every column, empty and word-less texts, ties, repeated rows, a long text
EDGE = [
    (1, "The cat sat on the mat", "en", "a", 22),
    (2, "the CAT sat on the mat", "en", "a", 22),
    (2, "the CAT sat on the mat", "en", "a", 22),
    (3, None, "en", "a", None),
    (4, "", None, "b", 0),
    (5, " \n\t ", "de", None, 4),
    (None, "no id here at all", "en", "b", 17),
    (None, None, None, None, None),
    (6, "x" * 5000 + " " + "word " * 3000, "en", "b", 20001),
    (7, "one", "de", "c", 3),
    (8, "öäü 日本 \U0001f600 <|endoftext|> '", "de", "c", 20),
    (9, "1234 567 !!", "fr", "", 11),
]


@pytest.fixture(scope="session")
def edge(spark):
    """Documents with every awkward case, and columns named like working ones."""
    rows = [(*r, 1, "k", 2.0, "z") for r in EDGE]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "size int, shard string, fp double, row string")


@pytest.fixture(scope="session")
def empty(spark, edge):
    return spark.createDataFrame([], edge.schema)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")
