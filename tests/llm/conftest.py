import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def rows(documents):
    return {r["doc_id"]: r["text"] for r in documents.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def make(spark):
    """A small documents table with a clashing extra column."""

    def f(texts, ids=None, **extra):
        ids = range(len(texts)) if ids is None else ids
        names = ["doc_id", "text", "lang", *extra]
        schema = "doc_id long, text string, lang string" + "".join(f", {k} string" for k in extra)
        data = [(i, t, None, *["x"] * len(extra)) for i, t in zip(ids, texts, strict=True)]
        return spark.createDataFrame(data, schema).select(*names)

    return f
