"""All queries against their oracles on data where single keys hold a third of the rows."""

import duckdb
import pytest
from compare import TABLES, differences, oracle_connection

import __spark_entry__ as contract

SOURCE = "/root/testdata/sf0.001"

# One book, one reviewer, one order and one visitor each on about a third of their
# table, and copies of rows.
CHANGED = {
    "lineitem": """select * replace (
            case when l_suppkey % 3 = 0 then 7 else l_partkey end as l_partkey,
            case when l_suppkey % 3 = 1 then 12 else l_orderkey end as l_orderkey)
        from source
        union all select * from source where l_linenumber = 1""",
    "orders": """select * replace (
            case when o_orderkey % 3 = 0 then 5 else o_custkey end as o_custkey) from source""",
    "events": """select * replace (
            case when event_id % 3 = 0 then 7 else user_id end as user_id,
            case when event_id % 3 = 1 then '{"k": 3}' else props end as props) from source""",
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    target = tmp_path_factory.mktemp("skewed")
    for name in TABLES:
        query = CHANGED.get(name, "select * from source")
        source = f"with source as (from '{SOURCE}/{name}.parquet') {query}"
        duckdb.sql(f"copy ({source}) to '{target}/{name}.parquet' (format parquet)")
    return str(target)


@pytest.mark.parametrize("name", list(contract.QUERIES))
def test_query_equals_oracle(spark, folder, name):
    got = contract.queries()[name](spark, folder).toPandas()
    want = oracle_connection(folder).execute(contract.oracle_sql()[name]).df()
    assert differences(got, want) is None
    assert len(got) > 0
