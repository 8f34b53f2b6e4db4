import os

import pytest

from ratevane.llm import queries
from tests import oracle

pytestmark = pytest.mark.skipif(not os.path.isdir(oracle.FOLDER), reason="no tables here")


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query(spark, name):
    oracle.agree(spark, queries.QUERIES[name], queries.SQL[name])


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_one_row_for_each_document(spark, name):
    got = queries.QUERIES[name](spark, oracle.FOLDER)
    assert got.count() == spark.read.parquet(f"{oracle.FOLDER}/documents.parquet").count() == got.select("doc_id").distinct().count()
