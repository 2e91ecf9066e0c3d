import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = {c: "clash" for c in ("shard", "bands", "band", "rep", "key", "line", "unit", "ids", "hash", "label", "score", "piece", "h1", "h2", "first", "words", "node", "root", "edges", "p", "at", "value")}


@pytest.fixture(scope="session")
def docs(spark):
    """A function from (doc_id, text) rows to documents, with columns of clashing names."""
    from pyspark.sql import functions as F

    def make(rows, clash=True):
        full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        df = spark.createDataFrame(full, SCHEMA)
        return df.withColumns({k: F.lit(v) for k, v in CLASH.items()}) if clash else df

    return make


PROSE = " ".join(f"word{i * 7919 % 1000}" for i in range(120))
ODD = [(1, PROSE), (2, PROSE), (2, PROSE), (3, None), (4, ""), (None, "no id at all here"), (5, "Grüße, 日本 😀 \n\n x"), (6, "a" * 30_000), (7, PROSE + " " + "tail " * 5000)]


@pytest.fixture(scope="session")
def odd(docs):
    return docs(ODD)


@pytest.fixture(scope="session")
def none(docs):
    return docs([])
