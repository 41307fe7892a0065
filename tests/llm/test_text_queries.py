"""The registered queries against their SQL, and their columns."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from sparrowscope.llm.oracle import ORACLE
from sparrowscope.llm.queries import QUERIES

DATA = Path("/root/testdata/sf0.001")
COLUMNS = {
    "op1_quality": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op2_pieces": "doc_id rank n_ids ids_crc32 round_trip log_prob log_inclusion",
    "op3_classifier": "doc_id held_out score predicted",
    "op4_warc": "page_id payload_bytes payload_digest record_type refers_to",
    "op5_spans": "doc_id text n_sentences n_removed",
    "op6_language": "doc_id held_out lang_pred score",
    "op7_suffixes": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op8_jaccard": "doc_id n_shingles component_id",
    "op9_tokens": "doc_id start n_tokens ids_crc32",
    "op10_decontaminate": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op11_whitening": "vec_id component n deviation whitened explained identity_error",
    "op12_order_minhash": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op13_manifest": "doc_id leaf subroot root proof_sha256 folded_root verified",
}

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


def test_names():
    assert set(QUERIES) == set(COLUMNS) and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    found = QUERIES[name](spark, str(DATA))
    assert sorted(found.columns) == sorted(COLUMNS[name].split())
    rows = found.collect()
    table = {"op4_warc": "pages", "op11_whitening": "embeddings"}.get(name, "documents")
    key = found.columns[0] if name != "op2_pieces" else "doc_id"
    expected = {r[0] for r in spark.read.parquet(f"{DATA}/{table}.parquet").select(key).collect()}
    assert {r[key] for r in rows} == expected
    if name in ORACLE:
        connection = duckdb.connect()
        for file in DATA.glob("*.parquet"):
            connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
        cursor = connection.execute(ORACLE[name])
        names = [column[0] for column in cursor.description]
        places = [names.index(column) for column in found.columns]
        sql = Counter(repr(tuple(row[i] for i in places)) for row in cursor.fetchall())
        assert Counter(repr(tuple(row)) for row in rows) == sql
