"""The registered queries: one per operator and the pipeline; SQL where there is some."""

import pytest
from conftest import SF_SMALL

import __spark_entry__ as E
from tallow.llm import queries
from tallow.plans.verify import compare, duckdb_views

ROWS = {"op1_warc_merge": "pages", "op13_embedding_dedup": "embeddings"}


def test_one_query_per_operator_is_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(E.queries())
    assert set(queries.ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_equals_sql(spark, name):
    r = compare(E.queries()[name](spark, SF_SMALL), duckdb_views(SF_SMALL), queries.ORACLE[name])
    assert r["columns_match"] and r["values_match"] and r["spark_rows"] == r["oracle_rows"]


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - {"op10_packing", "op11_lexical_search", "op12_conversation_repair"}))
def test_one_row_per_input_row(spark, name):
    table = spark.read.parquet(f"{SF_SMALL}/{ROWS.get(name, 'documents')}.parquet")
    assert E.queries()[name](spark, SF_SMALL).count() == table.count()


def test_one_row_per_conversation(spark):
    table = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    found = E.queries()["op12_conversation_repair"](spark, SF_SMALL)
    assert sorted(r["conv_id"] for r in found.collect()) == sorted(r["conv_id"] for r in table.select("conv_id").distinct().collect())
