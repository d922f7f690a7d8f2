"""The registered queries against their DuckDB SQL, and the pipeline against brute force."""

import os

import duckdb
import pytest

import corpus_pipeline
from ledgerlake.llm import decontaminate
from ledgerlake.llm.queries import LLM_ORACLE_SQL, LLM_QUERIES
from tests.llm import edge
from tests.llm.test_lines import brute as brute_lines
from tests.llm.test_near_duplicates import brute as brute_classes
from tools.check_oracle import TABLES, duck_types, norm, spark_types

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_operators_are_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in LLM_QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(LLM_ORACLE_SQL))
def test_query_matches_sql(spark, duck, name):
    sdf = LLM_QUERIES[name](spark, SF)
    rel = duck.sql(LLM_ORACLE_SQL[name])
    assert spark_types(sdf.schema) == duck_types(rel)
    assert norm(sdf.toPandas()) == norm(rel.df())


def ids_by_sql(con, sql, docs):
    """The doc_ids of a query's SQL over these documents instead of the table's."""
    con.register("stage_documents", docs.select("doc_id", "text").toPandas())
    # A view of the name shadows the table's.
    con.execute("CREATE OR REPLACE TEMP VIEW documents AS SELECT * FROM stage_documents")
    try:
        return {r[0] for r in con.sql(f"SELECT doc_id FROM ({sql})").fetchall()}
    finally:
        con.execute("DROP VIEW temp.documents")
        con.unregister("stage_documents")


def test_pipeline_stages_by_brute_force(spark, duck):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "line_dedup", "minhash_near_dedup", "benchmark_decontamination", "packing"]
    rows = {r.doc_id: r for r in docs.collect()}

    kept = stages["quality_rules"](spark, docs, SF).collect()
    want = ids_by_sql(duck, f"SELECT * FROM ({LLM_ORACLE_SQL['op3_quality_rules']}) WHERE kept", docs)
    assert len(want) < len(rows)
    assert {r.doc_id for r in kept} == want and all(rows[r.doc_id] == r for r in kept)

    now = spark.createDataFrame(kept, docs.schema)
    cut = stages["line_dedup"](spark, now, SF).collect()
    lines = {i: t for i, t, _ in brute_lines([(r.doc_id, r.text, r.source) for r in kept], 8)}
    assert {r.doc_id: r.text for r in cut} == lines
    assert all(r.n_chars == (len(r.text) if r.text != rows[r.doc_id].text else rows[r.doc_id].n_chars) for r in cut)

    now = spark.createDataFrame(cut, docs.schema)
    single = stages["minhash_near_dedup"](spark, now, SF).collect()
    assert {r.doc_id for r in single} == set(brute_classes([(r.doc_id, r.text) for r in cut]).values())

    now = spark.createDataFrame(single, docs.schema)
    clean = stages["benchmark_decontamination"](spark, now, SF).collect()
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    verbatim = {r.doc_id for r in single if any(x in " ".join(r.text.lower().split()) for x in items)}
    leaks = ids_by_sql(duck, LLM_ORACLE_SQL["op9_decontamination"], now)
    assert verbatim and verbatim <= leaks and {r.doc_id for r in clean} == {r.doc_id for r in single} - leaks

    pieces = stages["packing"](spark, spark.createDataFrame(clean, docs.schema), SF).collect()
    by = {}
    for r in pieces:
        by.setdefault(r.doc_id, []).append(r)
    assert set(by) == {r.doc_id for r in clean}
    assert all(sum(p.length for p in x) == x[0].doc_tokens for x in by.values())


def test_run_writes_every_stage(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and "parquet" in out._jdf.queryExecution().executedPlan().toString().lower()
    assert corpus_pipeline.ORACLE_SQL is None


def test_pipeline_takes_edge_rows(spark):
    docs = edge.docs(spark)
    for name, stage in corpus_pipeline.STAGES:
        for df in (docs, edge.no_docs(spark)):
            out = stage(spark, df, SF)
            if name != "packing":
                assert out.schema.names == edge.DOCS.names, name
            n = out.count()
            assert n == 0 if df is not docs else n >= 0
    assert decontaminate.MASKS
