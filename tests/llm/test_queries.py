"""The registered queries on the smallest given tables: DuckDB where SQL can say the
same, brute force or held-out accuracy elsewhere."""

import os

import numpy as np
import pytest

import __spark_entry__ as entry

SMALL = "/root/testdata/sf0.001"
NAMES = ["op1_line_dedup", "op2_decontaminate", "op3_quality", "op4_nearest", "op5_token_files",
         "op6_jaccard_join", "op7_license_scan", "op8_sentence_spans", "op9_mixing",
         "op10_url_filter", "op11_collocations", "op12_main_text", "op13_alignment", "pipeline"]


def test_every_operator_is_registered_once():
    own = [n for n in entry.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted([*own, "pipeline"]) == sorted(NAMES)
    assert set(entry.LLM_QUERIES) == set(NAMES)


needs_tables = pytest.mark.skipif(not os.path.isdir(SMALL), reason="the given tables are not here")


@needs_tables
@pytest.mark.parametrize("name", ["op2_decontaminate", "op10_url_filter", "op11_collocations"])
def test_against_duckdb(spark, name):
    import duckdb
    con = duckdb.connect()
    for table in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    want = con.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    got = entry.queries()[name](spark, SMALL)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(str, map(tuple, got.select(*columns).collect()))) == \
        sorted(map(str, want.fetchall()))


@needs_tables
def test_recall_of_the_search(spark):
    rows = [(r.vec_id, np.array(r.embedding, float))
            for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    unit = {i: v / np.linalg.norm(v) for i, v in rows}
    got = {}
    for r in entry.queries()["op4_nearest"](spark, SMALL).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    right = total = 0
    for q in (i for i in unit if i % 50 == 0):
        best = sorted((i for i in unit if i != q), key=lambda i: (-float(unit[q] @ unit[i]), i))[:5]
        right += len(got[q] & set(best))
        total += len(best)
    assert right >= 0.9 * total


@needs_tables
def test_held_out_accuracy_of_the_classifier(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    rows = [r for r in entry.queries()["op3_quality"](spark, SMALL).collect()
            if r.held_out and r.doc_id in labels]
    assert rows and np.mean([r.predicted == labels[r.doc_id] for r in rows]) >= 0.95
