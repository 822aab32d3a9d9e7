from pathlib import Path

import pytest

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    if not Path(SF_DIR).exists():
        pytest.skip("no test tables")
    return SF_DIR


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").cache()


@pytest.fixture(scope="session")
def texts(documents):
    return {row.doc_id: row.text for row in documents.select("doc_id", "text").collect()}


LONG = " ".join(f"word{i % 977} and the other {i}" for i in range(40_000))
ROWS = [
    (1, "The cat and the dog sat on the mat in the house of a friend.", "en", "a", 60),
    (1, "The cat and the dog sat on the mat in the house of a friend.", "en", "a", 60),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (4, " \n\t ", "de", "b", 4),
    (5, LONG, "en", "a", len(LONG)),
    (6, LONG + " end", "en", "a", len(LONG) + 4),
    (None, "no number at all, jo.81@mail7.example.com", "fr", None, None),
    (None, None, None, "c", None),
    (-7, "ÄÖ ü\x00x \x1c y z 🙂 é", "de", "b", 12),
    (9, "same same same same same same same", "en", "b", 34),
    (8, " ".join(f"The good{i} word of plain{i} prose{i} in a{i} line{i}." for i in range(60)), "en", "b", None),
    (10, "The Cat and the dog sat on the mat in the house of a friend.", "en", "a", 60),
]
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that the operators use themselves.
CLASHES = ["votes", "kept", "n_words", "id", "token", "shard", "_block", "weight", "tokens", "fit",
           "_text_key", "_read", "probability", "drawn"]


@pytest.fixture(scope="session")
def edge_rows(spark):
    """Nulls everywhere, empty, blank and very long texts, repeated rows, clashing names."""
    docs = spark.createDataFrame(ROWS, COLUMNS)
    for place, name in enumerate(CLASHES):
        docs = docs.selectExpr("*", f"'x{place}' AS {name}")
    return docs.repartition(3).cache()


@pytest.fixture(scope="session")
def no_rows(edge_rows):
    return edge_rows.limit(0)
