"""The registered queries of the operators: SQL where there is one, contracts elsewhere."""

import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from marquee.llm import queries
from tests.conftest import SF_SMALL
from tests.llm.test_suffix_dedup import brute
from tests.oracle import compare, duck

COLUMNS = {
    "op1_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op2_mixing": ["doc_id", "size", "source_size", "target", "taken"],
    "op3_exact_dedup": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    "op4_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op5_quality_classifier": ["doc_id", "held_out", "score", "predicted"],
    "op6_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op7_warc": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op8_jaccard_join": ["doc_id", "n_shingles", "component_id"],
    "op9_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op10_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                           "base_failed", "kept"],
    "op11_chat_format": ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
    "op12_code_compression": ["vec_id", "code", "error", "label_error", "codebooks_sha256"],
    "op13_ranked_search": ["item_id", "rank", "doc_id", "score"]}


def test_registered():
    assert set(COLUMNS) == set(queries.QUERIES) and set(queries.ORACLE) <= set(COLUMNS)
    assert {*COLUMNS, "pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_matches_sql(spark, name):
    problems, _, _ = compare(spark, duck(SF_SMALL), name, queries.QUERIES[name], queries.ORACLE[name], SF_SMALL)
    assert not problems, problems


@pytest.mark.parametrize("name", ["op1_toxicity", "op5_quality_classifier"])
def test_classifiers(spark, name):
    """One row a document, the folds of the contract, and held-out accuracy."""
    out = queries.QUERIES[name](spark, SF_SMALL)
    assert out.columns[:4] == COLUMNS[name]
    folds, held = (3, 1) if name == "op1_toxicity" else (4, 2)
    label = "toxic" if name == "op1_toxicity" else "quality"
    rows = out.collect()
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in docs.select("doc_id").collect())
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == held)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    known = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    assert sum(a == b for a, b in known) >= 0.85 * len(known)


def test_suffix_query_matches_brute_force(spark):
    got = sorted(map(tuple, queries.op4_suffix_dedup(spark, SF_SMALL).collect()), key=str)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert got == brute([tuple(r) for r in docs])


def test_sharding_and_packing_and_mixing_contracts(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    shards = queries.op6_sharding(spark, SF_SMALL).select(COLUMNS["op6_sharding"]).collect()
    assert {(r.doc_id, r["size"], r.text_crc32) for r in shards} == {
        (i, len(d.text.encode()) + 16, zlib.crc32(d.text.encode())) for i, d in docs.items()}
    mix = queries.op2_mixing(spark, SF_SMALL).select(COLUMNS["op2_mixing"]).collect()
    assert {(r.doc_id, r["size"]) for r in mix} == {
        (i, len(re.findall(r"[^\x20\x09-\x0D]+", d.text))) for i, d in docs.items()}
    pieces = queries.op9_packing(spark, SF_SMALL).select(COLUMNS["op9_packing"])
    assert pieces.agg(F.max("length")).first()[0] <= 1024
    assert {r.doc_id for r in pieces.where("piece = 0").collect()} == set(docs)
