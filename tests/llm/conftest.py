import pytest
from pyspark.sql import functions as F

from servicerank.llm.shipping import ship

SCHEMA = "doc_id long, text string, doc string, node int, n string, start int, component string, _id int"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture
def make(spark):
    """A table of documents (id, text), with further columns whose names operators use inside."""

    def build(rows):
        return spark.createDataFrame([(i, t, "x", 1, "y", 2, "z", 3) for i, t in rows], SCHEMA)

    return build


@pytest.fixture
def documents(spark, tables):
    return spark.read.parquet(f"{tables}/documents.parquet").withColumn("node", F.lit("clash"))
