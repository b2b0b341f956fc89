import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
LONG = "le mot " * 60_000

ROWS = [
    (1, "Alpha beta  gamma\tdelta epsilon zeta", "en", "b"),
    (2, "Alpha beta gamma delta\nepsilon zeta", "en", "b"),
    (3, None, "en", None),
    (4, "", None, "a"),
    (5, " \t ", "fr", "a"),
    (6, "12 34 !! %%%", "fr", None),
    (7, LONG, "fr", "c"),
    (7, LONG, "fr", "c"),
    (8, "no id's twin <|endoftext|> Été déjà-vu ÀÉÎ 漢字 x" + "y" * 300, None, "ä"),
    (None, "no id here at all, none", "de", "c"),
    (None, None, None, None),
    (9, "single", "de", "c"),
    (10, "SINGLE", "de", "c"),
]
CLASHES = ["kept", "size", "n", "node", "key", "label", "score", "_t", "_len", "component", "block", "word", "leaf", "start", "length", "copies", "a", "b"]


def schema():
    fields = [T.StructField("doc_id", T.LongType()), *(T.StructField(c, T.StringType()) for c in ("text", "lang", "source"))]
    return T.StructType([*fields, T.StructField("n_chars", T.LongType()), *(T.StructField(c, T.StringType()) for c in CLASHES)])


def frame(spark, rows):
    return spark.createDataFrame([(*r, len(r[1] or ""), *CLASHES) for r in rows], schema())


@pytest.fixture(scope="session")
def llm(spark):
    from tillwise.llm.queries import settle

    return settle(spark)


@pytest.fixture(scope="session")
def edges(llm):
    return frame(llm, ROWS).cache()


@pytest.fixture(scope="session")
def nothing(llm):
    return frame(llm, [])


@pytest.fixture(scope="session")
def documents(llm):
    return llm.read.parquet(f"{SF}/documents.parquet")


def told(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
