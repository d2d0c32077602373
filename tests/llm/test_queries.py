"""The registered corpus queries: against their SQL where they have it, else one row per document of the whole table."""

import os

import pytest
from oracle import connection, differences

from recsense.llm.queries import ORACLE_SQL, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    more, missing = differences(spark, connection(SF), QUERIES[name], ORACLE_SQL[name], SF)
    assert not more and not missing, (list(more.items())[:3], list(missing.items())[:3])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL) - {"op3_pack"}))
def test_query_has_a_row_per_document(spark, name):
    ids = sorted(r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())
    assert sorted(r[0] for r in QUERIES[name](spark, SF).select("doc_id").collect()) == ids


def test_packing_covers_every_document(spark):
    pieces = QUERIES["op3_pack"](spark, SF)
    per = pieces.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert len(per) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r["sum(length)"] == r["max(doc_tokens)"] for r in per)
