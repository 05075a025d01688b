import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def run(spark):
    """Result of a registered query on the smallest tables, as pandas, run once."""
    seen = {}

    def get(name):
        if name not in seen:
            seen[name] = E.queries()[name](spark, SF_SMALL).toPandas()
        return seen[name]
    return get


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet").toPandas().set_index("doc_id")


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty and repeated rows and an extra column."""
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (None, "no id here", "en", "a", 10),
            (3, "same row", "en", "b", 8), (3, "same row", "en", "b", 8), (4, "same row", "en", None, 8),
            (5, "word " * 30000, "de", "c", 150000), (6, "x", None, "a", 1)]
    return spark.createDataFrame([(*r, "extra") for r in rows], DOCS + ", score string")


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)
