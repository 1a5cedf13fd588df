import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType([StructField(n, t) for n, t in (("doc_id", LongType()), ("text", StringType()), ("lang", StringType()),
                                                  ("source", StringType()), ("n_chars", LongType()), ("component_id", StringType()))])


@pytest.fixture
def docs(spark):
    """Documents with a column that clashes with a result's, from (id, text) pairs."""
    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), "x") for i, t in rows], DOCS).repartition(3)

    return make


BASE = " ".join(f"word{i}" for i in range(60))
EDGES = [
    (None, "a null key here with words"), (1, None), (2, ""), (3, "  \n\t "), (4, "one two"), (5, BASE), (6, BASE), (6, BASE),
    (7, BASE + " tail"), (8, "é 日本 " * 3000), (9, BASE.upper()), (10, " ".join(f"other{i}" for i in range(60))),
]


@pytest.fixture
def edges(docs):
    return docs(EDGES)


@pytest.fixture(autouse=True)
def default_batches(spark):
    """The pipeline's stages leave the session with their own batch size; no test starts with another's."""
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
