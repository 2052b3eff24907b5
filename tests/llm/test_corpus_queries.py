"""The registered queries of the corpus operators and the pipeline on the given tables."""

import duckdb
import pytest
from compare import differences, oracle_connection

import __spark_entry__ as contract
import corpus_pipeline
from shelfrank.llm import decontamination, mixing, near_dedup, quality, queries

FOLDER = "/root/testdata/sf0.001"


def test_every_query_is_registered_once():
    names = list(contract.queries())
    assert len(names) == len(set(names))
    assert set(queries.QUERIES) | {"pipeline"} <= set(names)
    assert [n for k in range(1, 14) for n in names if n.startswith(f"op{k}_")] == list(queries.QUERIES)
    assert set(queries.ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_equals_oracle(spark, name):
    got = contract.queries()[name](spark, FOLDER).toPandas()
    want = oracle_connection(FOLDER).execute(queries.ORACLES[name]).df()
    assert differences(got, want) is None
    assert len(got) > 0


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in queries.ORACLES])
def test_query_returns_a_row_for_every_row(spark, name):
    got = contract.queries()[name](spark, FOLDER).toPandas()
    table = {"op1": "embeddings", "op8": "pages"}.get(name.split("_")[0], "documents")
    size = duckdb.sql(f"select count(*) from '{FOLDER}/{table}.parquet'").fetchall()[0][0]
    if table == "embeddings":
        asked = duckdb.sql(f"select count(*) from '{FOLDER}/{table}.parquet' where vec_id % 100 = 0")
        size = 10 * asked.fetchall()[0][0]
    assert len(got) == size


def test_stages_apply_their_operators_in_order(spark):
    docs = queries.table(spark, FOLDER, "documents")
    labels, benchmark = queries.table(spark, FOLDER, "labels"), queries.table(spark, FOLDER, "benchmark")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality", "near_dedup", "decontamination", "mix", "tokens",
    ]
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = sorted(r["doc_id"] for r in docs.collect())
        result = stage(spark, docs, FOLDER).cache()
        after = sorted(r["doc_id"] for r in result.collect())
        if name == "quality":
            scores = quality.quality_scores(docs, labels).where("predicted = 1")
            assert after == sorted(r["doc_id"] for r in scores.collect()) and len(after) < len(before)
        elif name == "near_dedup":
            kept = near_dedup.near_duplicates(docs).where("kept")
            assert after == sorted(r["doc_id"] for r in kept.collect()) and len(after) < len(before)
        elif name == "decontamination":
            hit = {r["doc_id"] for r in decontamination.leaks(docs, benchmark).collect()}
            assert after == [d for d in before if d not in hit] and hit
        elif name == "mix":
            mixture = mixing.mix(docs).collect()
            assert after == sorted(r["doc_id"] for r in mixture for _ in range(r["times"]))
        else:
            assert after == before
        if name != "tokens":
            assert result.columns == columns
        docs = result
    final = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(tuple, final.collect())) == sorted(map(tuple, docs.collect()))
