import hashlib
from collections import defaultdict

import pytest

from marquee.llm import exact_dedup
from tests.llm.util import docs, long_text


def brute(rows, pick):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = pick(known) if known else None
        left = 1
        for i in ids:
            kept = left and i == keep
            left -= bool(kept)
            out.append((i, keep, len(ids), bool(kept), hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


ROWS = ([(i, f"text {i % 7}") for i in range(40)] + [(100, None), (101, ""), (102, "é" * 40), (103, "é" * 40)]
        + [(5, "text 5"), (5, "text 5"), (None, "text 1"), (None, "lonely"), (None, "lonely")]
        + [(200 + i, "hot " * 20) for i in range(60)] + [(300, "hot " * 20 + "!"), (301, long_text())])


@pytest.mark.parametrize("keep,pick", [("min", min), ("max", max)])
@pytest.mark.parametrize("heavy", [512, 4])
def test_matches_brute_force(spark, monkeypatch, keep, pick, heavy):
    monkeypatch.setattr(exact_dedup, "HEAVY_TEXTS", heavy)  # 4: the hot texts are salted
    got = exact_dedup.content_sort_dedup(docs(spark, ROWS), keep=keep)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(ROWS, pick)


@pytest.mark.parametrize("keep,pick", [("min", min), ("max", max)])
def test_a_hot_repeated_row_is_cut_into_runs(spark, monkeypatch, keep, pick):
    """Rows equal in id and text, and rows without ids, do not meet in one window."""
    monkeypatch.setattr(exact_dedup, "HEAVY_TEXTS", 8)
    tables, write = [], exact_dedup.written
    monkeypatch.setattr(exact_dedup, "written", lambda df, name: tables.append(write(df, name)) or tables[-1])
    rows = [(i, f"t {i}") for i in range(200)] + [(7, "same")] * 100 + [(None, "void")] * 90 + [(3, "same"), (8, "void")]
    got = exact_dedup.content_sort_dedup(docs(spark, rows), keep=keep)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, pick)
    sizes = tables[-1].where("_hot").groupBy("_sha", "_salt").count().collect()
    assert len(sizes) > 40 and max(r["count"] for r in sizes) < 20
    lonely = exact_dedup.content_sort_dedup(docs(spark, [(None, "void")] * 60 + [(1, "a")]), keep=keep)
    found = lonely.where("text_sha256 = sha2('void', 256)").collect()
    assert len(found) == 60 and {(r.keep_id, r.group_size) for r in found} == {(None, 60)}
    assert sum(r.kept for r in found) == 1


def test_kept_documents_one_of_each_text_with_all_columns(spark):
    table = docs(spark, ROWS)
    kept = exact_dedup.kept_documents(table, keep="max")
    assert kept.columns == table.columns
    texts = [r.text or "" for r in kept.collect()]
    assert sorted(texts) == sorted({t or "" for _, t in ROWS})


def test_normalisation(spark):
    from pyspark.sql import functions as F
    got = exact_dedup.content_sort_dedup(docs(spark, [(1, "A"), (2, "a"), (3, "b")]),
                                         normalise=F.lower)
    assert {(r.doc_id, r.keep_id, r.kept) for r in got.collect()} == {
        (1, 1, True), (2, 1, False), (3, 3, True)}


def test_empty_table(spark):
    assert exact_dedup.content_sort_dedup(docs(spark, [])).count() == 0
    assert exact_dedup.kept_documents(docs(spark, [])).count() == 0


def test_no_exchange_after_the_range_exchange(spark):
    """The window reuses the range partitioning; texts move once."""
    plan = exact_dedup.content_sort_dedup(docs(spark, ROWS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
