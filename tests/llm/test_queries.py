"""Every query over the smallest tables: whole results, and SQL where there is some."""

import hashlib
import os

import duckdb
import pytest

import __spark_entry__ as entry
import checks
from cadastria.llm.queries import QUERIES
from cadastria.llm.sql import ORACLE

from . import brute

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
COLUMNS = {
    "op1": "doc_id held_out score predicted",
    "op2": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op3": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op4": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op5": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op6": "page_id url text n_chars",
    "op7": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    "op8": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op9": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op10": "doc_id n_shingles component_id",
    "op11": "doc_id n form prefix_chars middle_chars output_sha256 restored_sha256",
    "op12": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op13": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
}


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    rows = QUERIES[name](spark, SF)
    assert set(COLUMNS[name.split("_")[0]].split()) <= set(rows.columns)
    key = rows.columns[0]
    tables = {"page_id": "pages", "conv_id": "conversations"}
    want = {r[0] for r in spark.read.parquet(f"{SF}/{tables.get(key, 'documents')}.parquet").select(key).collect()}
    got = [r[0] for r in rows.select(key).collect()]
    if name.startswith("op13"):
        # a node's row carries its smallest member, and not every conversation is one
        assert set(got) <= want
        return
    assert set(got) == want | ({-1} if name.startswith("op7") else set())
    if not name.startswith("op3"):
        assert len(got) == len(set(got))


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in checks.TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    assert checks.compare(spark, con, name, SF).startswith(f"{name}: ok")


def test_pipeline_runs(spark):
    rows = entry.queries()["pipeline"](spark, SF)
    assert rows.columns[:3] == ["doc_id", "start", "length"] and rows.count() > 0


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_personal_data_counts_equal_a_plain_search(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in QUERIES["op4_weak_pii"](spark, sf).collect():
        spans = brute.base_spans(texts[r.doc_id])
        assert [r[f"n_{kind}"] for kind in brute.BASE] == [sum(s[3] == kind for s in spans) for kind in brute.BASE]
        listed = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()


def test_secret_counts_follow_from_the_spans(spark):
    for r in QUERIES["op12_trigram_secrets"](spark, "/root/testdata/sf0.01").collect():
        kinds = [s.split(":")[0] for s in r.spans.split(",")]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(kinds.count(k) for k in ("assign", "access", "hex"))
