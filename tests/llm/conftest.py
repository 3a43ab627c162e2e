import pytest
from odd_rows import DOCS
from pyspark.sql import SparkSession
from pyspark.sql import functions as F



@pytest.fixture(scope="session")
def docs_of(spark: SparkSession):
    def make(rows, extra: bool = False):
        df = spark.createDataFrame(rows, DOCS)
        if extra:  # names that the operators use themselves
            for name in ("fp", "Tokens", "h", "__score", "__fp", "sequence_id", "a.b", "nth", "words", "__w", "next_text"):
                df = df.withColumn(name, F.lit(7))
        return df

    return make


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def corpus(spark, sf):
    """The given documents as Python rows."""
    return spark.read.parquet(f"{sf}/documents.parquet").collect()
