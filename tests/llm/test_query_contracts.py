"""What the thin queries add to their operators: names, types, and the columns made from ids."""

import re
import zlib

import pytest

from txrisk.llm import queries

SF = "/root/testdata/sf0.001"
LONG, TEXT, BOOL, INT, DOUBLE = "bigint", "string", "boolean", "int", "double"
COLUMNS = {
    "op1_token_counts": {"doc_id": LONG, "n_bytes": LONG, "n_tokens": LONG, "over_limit": BOOL},
    "op2_language_id": {"doc_id": LONG, "held_out": BOOL, "lang_pred": TEXT, "score": DOUBLE},
    "op3_warc_chunks": {"page_id": LONG, "payload_bytes": LONG, "payload_digest": TEXT, "record_type": TEXT, "refers_to": LONG},
    "op4_quality_classifier": {"doc_id": LONG, "held_out": BOOL, "score": DOUBLE, "predicted": INT},
    "op5_simhash_pigeonring": {"doc_id": LONG, "fingerprint": TEXT, "component_id": LONG},
    "op6_bpe_codec": {"doc_id": LONG, "n_tokens": LONG, "ids_sha256": TEXT, "decoded_sha256": TEXT},
    "op7_balanced_shards": {"doc_id": LONG, "size": LONG, "text_crc32": LONG, "law": TEXT, "shard": INT, "slot": LONG, "grown_shard": INT},
    "op8_kmeans_tree": {"query_id": LONG, "rank": INT, "vec_id": LONG, "score": DOUBLE},
}


@pytest.fixture(scope="module")
def texts(sf_docs):
    return {r.doc_id: r.text for r in sf_docs.select("doc_id", "text").collect()}


def remainder(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus


@pytest.mark.parametrize("name", COLUMNS)
def test_query(spark, texts, name):
    df = queries.queries()[name](spark, SF)
    types = dict(df.dtypes)
    assert {c: types.get(c) for c in COLUMNS[name]} == COLUMNS[name]
    rows = df.collect()
    if name not in ("op3_warc_chunks", "op8_kmeans_tree"):
        assert sorted(r.doc_id for r in rows) == sorted(texts)
    if name == "op1_token_counts":
        assert all(r.n_bytes == len((texts[r.doc_id] or "").encode()) and r.over_limit == (r.n_tokens > 2048) for r in rows)
    if name in ("op2_language_id", "op4_quality_classifier"):
        modulus, left = (4, 2) if name.startswith("op2") else (5, 0)
        assert all(r.held_out == (remainder(r.doc_id, modulus) == left) and 0 <= r.score <= 1 for r in rows)
    if name == "op2_language_id":
        lettered = {d for d, t in texts.items() if any(c.isalpha() for c in t or "")}
        assert all((r.lang_pred == "und") == (r.doc_id not in lettered) for r in rows)
    if name == "op4_quality_classifier":
        assert all(r.predicted == int(r.score >= 0.3) for r in rows)
    if name == "op5_simhash_pigeonring":
        assert all(re.fullmatch("[0-9a-f]{16}", r.fingerprint) and r.component_id <= r.doc_id for r in rows)
    if name == "op7_balanced_shards":
        assert {r.law for r in rows} == {"rows"} and {r.grown_shard for r in rows} == {None}
        assert all(r.text_crc32 == zlib.crc32((texts[r.doc_id] or "").encode()) and 0 <= r.shard < 16 for r in rows)
    if name == "op8_kmeans_tree":
        assert all(r.query_id % 50 == 0 and r.vec_id != r.query_id for r in rows)
        assert {r.rank for r in rows} == {1, 2, 3, 4, 5}
