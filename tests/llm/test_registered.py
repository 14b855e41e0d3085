"""The registered queries over the small tables: contract columns, rows, and the oracle."""

import pytest
from conftest import SF, table_of

from gleanery.llm.queries import ORACLES, QUERIES

COLUMNS = {
    "op1_exact_dedup": {"doc_id": "bigint", "keep_id": "bigint", "group_size": "bigint", "kept": "boolean", "text_sha256": "string"},
    "op2_pii": {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint", "base_sha256": "string", "spans": "string"},
    "op3_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op5_token_count": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
    "op6_sharding": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op7_quality": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op8_token_output": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op10_mixing": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_contract(spark, duck, name):
    df = QUERIES[name](spark, SF)
    assert {k: t for k, t in df.dtypes if k in COLUMNS[name]} == COLUMNS[name]
    rows = df.collect()
    ids = [r[0] for r in duck.sql("SELECT doc_id FROM documents").fetchall()]
    assert sorted(r.doc_id for r in rows) == sorted(ids)
    if name in ORACLES:
        want = duck.sql(ORACLES[name])
        assert table_of(df.columns, [tuple(r) for r in rows]) == table_of(want.columns, want.fetchall())


@pytest.mark.parametrize("name", ["op4_line_dedup", "op9_decontamination"])
def test_findings(spark, duck, name):
    rows = QUERIES[name](spark, SF).collect()
    texts = dict(duck.sql("SELECT doc_id, text FROM documents").fetchall())
    assert rows and all(0 <= r.start < r.end <= len(texts[r.doc_id]) for r in rows)


@pytest.mark.parametrize("name", ["mixing_targets", "token_bytes"])
def test_parts_that_sql_can_express(spark, duck, name):
    df = QUERIES[name](spark, SF)
    want = duck.sql(ORACLES[name])
    assert table_of(df.columns, [tuple(r) for r in df.collect()]) == table_of(want.columns, want.fetchall())
