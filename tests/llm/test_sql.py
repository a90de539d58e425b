"""The queries with SQL against DuckDB, and the contract's columns."""

import duckdb
import pytest

from starloom.llm.catalog import QUERIES, SQL
from tests.conftest import SF_SMALL

COLUMNS = {
    "op1": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
    "op2": {"doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"},
    "op3": {"doc_id", "held_out", "lang_pred", "score"},
    "op4": {"doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"},
    "op5": {"doc_id", "size", "source_size", "target", "taken"},
    "op6": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
    "op7": {"doc_id", "n_lines", "n_removed", "kept_text"},
    "op8": {"doc_id", "keep_id", "group_size", "kept", "text_sha256"},
    "op9": {"doc_id", "class_id", "class_size", "kept"},
    "op10": {"doc_id", "n_words", "n_removed", "kept_sha256"},
    "op11": {"vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"},
    "op12": {"lang", "rank", "phrase", "a", "l", "r", "n", "score"},
    "op13": {"page_id", "url", "text", "n_chars"},
}


def test_all_operators_are_registered():
    assert sorted(COLUMNS) == sorted(n.split("_")[0] for n in QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_SMALL}/{table}.parquet'")
    want = con.execute(SQL[name]).fetchall()
    cols = [c[0] for c in con.description]
    got = QUERIES[name](spark, SF_SMALL).select(*cols).collect()
    assert sorted(map(tuple, got)) == sorted(want)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns_and_rows(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert COLUMNS[name.split("_")[0]] <= set(df.columns)
    if "doc_id" not in df.columns:
        return
    ids = df.select("doc_id").distinct().count()
    assert ids == 200 and (name.startswith("op1_") or df.count() == 200)


@pytest.mark.parametrize("name", ["op6_quality_rules", "op7_line_dedup", "op8_exact_dedup"])
def test_native_plans(spark, name):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    for bad in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"):
        assert bad not in plan
