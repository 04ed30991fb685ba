import collections

import brute
import corpus_pipeline
import duckdb
import pytest

from quillspark.llm import packing, queries, toxicity
from quillspark.llm.common import read

TINY = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{TINY}/{t}.parquet'")
    expected = con.execute(queries.ORACLE[name])
    columns = [c[0] for c in expected.description]
    found = queries.QUERIES[name](spark, TINY)
    assert sorted(found.columns) == sorted(columns)
    assert collections.Counter(map(tuple, found.select(columns).collect())) == collections.Counter(expected.fetchall())


@pytest.mark.parametrize(("name", "table"), [("op2_toxicity", "documents"), ("op3_mixing", "documents"), ("op5_tool_chat", "conversations"), ("op6_suffix_dedup", "documents"), ("op7_simhash", "documents"), ("op8_quality_trees", "documents"), ("op9_quality_rules", "documents"), ("op11_vector_codes", "embeddings"), ("op13_byte_bpe", "documents")])
def test_one_row_for_each_row(spark, name, table):
    assert queries.QUERIES[name](spark, TINY).count() == read(spark, TINY, table).count()


def test_pipeline(spark):
    docs = read(spark, TINY, "documents")
    tables = [docs]
    for _, function in corpus_pipeline.STAGES:
        tables.append(function(spark, tables[-1], TINY))
        tables[-1] = spark.createDataFrame(tables[-1].collect(), tables[-1].schema)
    assert all(t.columns == corpus_pipeline.COLUMNS for t in tables[1:-1])
    rows = [[tuple(r) for r in t.collect()] for t in tables]
    model = toxicity.fit(docs, read(spark, TINY, "labels"))
    toxic = {r.doc_id for r in toxicity.score(docs, model, ["doc_id"]).where("predicted = 1").collect()}
    assert sorted(rows[1]) == sorted(r for r in rows[0] if r[0] not in toxic)
    stay, _ = brute.near_copies([r[:2] for r in rows[1]])
    assert sorted(rows[2]) == sorted(r for r in rows[1] if r[0] in set(stay))
    items = [tuple(r) for r in read(spark, TINY, "benchmark").select("item_id", "text").collect()]
    clean = {r[0] for r in brute.contaminated([r[:2] for r in rows[2]], items) if not r[-1]}
    assert sorted(rows[3]) == sorted(r for r in rows[2] if r[0] in clean)
    copies = collections.Counter(rows[4])
    assert set(copies) <= set(rows[3]) and max(copies.values()) <= 2
    encode = packing.tokenizer()
    assert sum(r[2] for r in rows[5]) == sum(len(encode(r[1])) + 1 for r in rows[4])
