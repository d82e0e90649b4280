"""Every registered training-data query on the smallest tables: whole tables, and the columns that are agreed on."""

from pathlib import Path

import pytest

import corpus_pipeline
from tallybook.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no sample tables")

# Table whose rows the result has one by one, and the columns with their types. Fixed values.
CONTRACTS = {
    "op3_suffixes": ("documents", {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"}),
    "op4_simhash": ("documents", {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"}),
    "op5_language": ("documents", {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"}),
    "op6_pages": ("pages", {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"}),
    "op7_warc": ("pages", {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint"}),
    "op8_mixing": ("documents", {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"}),
    "op9_pii": ("documents", {
        "doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint", "base_sha256": "string", "spans": "string"}),
    "op10_digests": ("documents", {
        "doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string",
        "near_edited": "double", "near_next": "double"}),
    "op13_quality": ("documents", {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}),
}
HEX = {"kept_sha256": 64, "base_sha256": 64, "edited_sha256": 64, "payload_digest": 40, "fingerprint": 16}


@pytest.mark.parametrize("name", sorted(CONTRACTS))
def test_contract(spark, name):
    table, columns = CONTRACTS[name]
    rows = QUERIES[name](spark, SF_DIR)
    types = dict(rows.dtypes)
    assert {c: types[c] for c in columns} == columns
    key = "page_id" if table == "pages" else "doc_id"
    want = [r[0] for r in spark.read.parquet(f"{SF_DIR}/{table}.parquet").select(key).collect()]
    got = rows.collect()
    assert sorted(r[key] for r in got) == sorted(want)
    for column in HEX.keys() & columns.keys():
        if name == "op10_digests" and column == "fingerprint":
            continue
        assert all(len(r[column]) == HEX[column] and set(r[column]) <= set("0123456789abcdef") for r in got)
    for column in {"score", "near_edited", "near_next"} & columns.keys():
        assert all(0 <= r[column] <= 1 for r in got)


def test_licences_and_leaks_cover_their_tables(spark):
    docs = {r.doc_id for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id").collect()}
    for name in ("op1_licences", "op2_decontaminate"):
        rows = QUERIES[name](spark, SF_DIR).select("doc_id").collect()
        assert len(rows) == len(docs) and {r.doc_id for r in rows} == docs


def test_pipeline(spark):
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF_DIR)
        assert kept.columns == docs.columns
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    ids = [r.doc_id for r in rows]
    assert len(ids) == len(set(ids)) and set(ids) < before.keys()
    assert all(r.taken == r.copies * r["size"] <= 2 * r["size"] for r in rows)
    target = {r.source: r.target for r in rows}
    for source, words in target.items():
        own = [r for r in rows if r.source == source]
        # The sources are small here: whole documents come within one of the target.
        assert abs(sum(r.taken for r in own) - words) <= max(r["size"] for r in own)
