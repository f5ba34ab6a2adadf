"""The training-data queries that have SQL give DuckDB's rows; the others keep their contract."""

import os

import pytest
from sql_compare import DATA, compare

from verbena.llm import queries

pytestmark = pytest.mark.skipif(not os.path.exists(DATA) or not os.path.exists(queries.BYTE_BPE), reason="no tables here")
COLUMNS = {
    "p1_found": ["table_name", "first_id", "copy_id"], "p2_found": ["term", "mark"], "p4_found": ["table_name", "row_id"], "p5_found": ["change_id", "defect"],
    "p6_found": ["table_name", "row_id"], "p7_ids": ["doc_id", "ids"], "p9_found": ["doc_id", "kind", "lang"],
}


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    compare(spark, queries.QUERIES[name], queries.SQL[name])


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_columns(spark, name):
    df = queries.QUERIES[name](spark, DATA)
    assert df.columns == COLUMNS.get(name, df.columns)


def rows(spark, name):
    return queries.QUERIES[name](spark, DATA).collect()


def size(spark, table, where="true"):
    return spark.read.parquet(f"{DATA}/{table}.parquet").filter(where).count()


def test_every_document_is_encoded(spark):
    df = queries.p7_ids(spark, DATA)
    assert df.count() == size(spark, "documents") and df.filter("ids is null").count() == 0


def test_restored_records_are_those_found(spark):
    found = {tuple(r) for r in rows(spark, "p4_found")}
    restored = rows(spark, "p4_restored")
    assert found == {(r.table_name, r.row_id) for r in restored} and len(found) == len(restored) > 0
    # most restored texts hold no trace of a wrong decoding any more
    assert sum("Ã" not in r.restored for r in restored) >= 0.95 * len(restored)


def test_forms_differ_where_records_were_found(spark):
    forms = rows(spark, "p6_forms")
    assert len(forms) == size(spark, "dialogue_fields") + size(spark, "localized_entries")
    texts = {("dialogue_fields", r.field_id): r.field_value for r in spark.read.parquet(f"{DATA}/dialogue_fields.parquet").collect()}
    texts |= {("localized_entries", r.row_id): r.m_localized for r in spark.read.parquet(f"{DATA}/localized_entries.parquet").collect()}
    changed = {(r.table_name, r.row_id) for r in forms if r.form != texts[r.table_name, r.row_id]}
    found = {tuple(r) for r in rows(spark, "p6_found")}
    assert changed <= found and len(found) - len(changed) <= 0.01 * len(found)


def test_the_mix_reaches_its_shares(spark):
    """Within two records' size of a source's share, and no record more often than it may be."""
    shares = rows(spark, "p8_shares")
    total = sum(r.mixed_tokens for r in shares)
    wanted = sum(r.target_share for r in shares if r.tokens)
    longest = max(r.n_tokens for r in rows(spark, "p8_mix"))
    assert len(shares) == size(spark, "mix_targets") and total > 0
    for r in shares:
        assert r.most_copies <= r.max_repeats
        if r.tokens:
            assert abs(r.mixed_tokens - total * r.target_share / wanted) <= 2 * max(longest, 256) + 0.01 * total, r.source


def test_segments_lie_in_their_documents(spark):
    lengths = {r.doc_id: len(r.text or "") for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    segments = rows(spark, "p9_segments")
    assert segments and all(0 <= r.begin and r.begin + r.length <= lengths[r.doc_id] and 0 <= r.confidence <= 1.0000001 for r in segments)
    sentences = [r for r in segments if r.sentence]
    assert all(r.lang for r in sentences) and sum(r.confidence > 0.9 for r in sentences) >= 0.95 * len(sentences)
