"""Ranked search against scoring every document; intervals against plain maxima."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from marquee.llm import ranked_search
from tests.llm.util import CLASHES, docs, long_text, prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute(rows, items, k=20):
    counts = [(i, Counter(words(t))) for i, t in rows]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c, n in counts:
            m = 75 + (25 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((10 ** 9 * c[t]) // (1000 * c[t] + 12 * m)) for t in words(text) if t in c)
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, f[3], -f[0]) for r, f in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def run(spark, rows, items, **options):
    table = spark.createDataFrame(items, "item_id long, text string").selectExpr(
        "*", *[f"'x' AS `{c}`" for c in [*CLASHES, "query", "rank"]])
    return sorted(map(tuple, ranked_search.search(docs(spark, rows), table, **options).collect()), key=str)


def corpus(n, seed=1):
    rng = random.Random(seed)
    rows = [(i, prose(rng, rng.randrange(1, 120), 200)) for i in range(n)]
    items = [(q, prose(rng, rng.randrange(1, 30), 230)) for q in range(12)]
    for q, text in items[:6]:
        for _ in range(rng.randrange(1, 30)):  # copies of passages, and ties among them
            i = rng.randrange(n)
            rows[i] = (i, rng.choice([text, text + " " + rows[i][1]]))
    return rows, items


@pytest.mark.parametrize("block", [1 << 14, 40])
def test_matches_scoring_everything(spark, block, monkeypatch):
    monkeypatch.setattr(ranked_search, "BLOCK_DOCS", block)
    rows, items = corpus(900)
    rows += [(None, items[0][1]), (None, None), (901, ""), (902, "... --"), (903, long_text()), rows[3], rows[3],
             (904, "Straße ÉCOLE a_b"), (905, items[1][1] * 3)]
    items += [(50, None), (51, "zzz nowhere"), (52, "STRASSE Straße École a b"), (None, items[2][1]), items[3],
              (53, items[0][1] + " " + items[0][1]), (54, "z1 z2 z3 " + items[4][1])]
    assert run(spark, rows, items) == brute(rows, items)


def test_queries_in_several_passes(spark):
    rows, items = corpus(200, 2)
    assert run(spark, rows, items, query_terms=15) == run(spark, rows, items) == brute(rows, items)


def test_equal_scores_go_by_document(spark):
    rows = [(i, "same words here") for i in range(300)] + [(i, "others") for i in range(300, 700)]
    assert run(spark, rows, [(1, "words"), (2, "here same")]) == brute(rows, [(1, "words"), (2, "here same")])


def test_terms_of_bytes_are_those_of_the_pattern():
    text = "".join(map(chr, range(0, 1500))) + "Aé-Zz 日本 x\x7fy q r\x85s"
    assert [t.decode() for t in ranked_search.terms(text.encode())] == words(text)


def test_intervals_and_range_maxima():
    rng = np.random.default_rng(4)
    n_docs, n_terms = 500, 30
    term, doc = np.divmod(rng.choice(n_docs * n_terms, 4000, replace=False), n_docs)
    impact = rng.integers(1, 60, 4000)
    block = ranked_search.Block(term, doc, impact, n_docs, n_terms)
    for _ in range(300):
        t = rng.integers(n_terms)
        a, b = np.sort(rng.integers(block.start[t], block.start[t + 1] + 1, 2))
        value, at = block.range_max(np.array([[a]]), np.array([[b]]))
        assert value[0, 0] == block.impact[a:b].max(initial=0)
        assert a == b or block.impact[at[0, 0]] == value[0, 0]
    full = np.zeros((n_terms, n_docs), dtype=np.int64)
    full[term, doc] = impact
    for k in (1, 5, 20):
        asked, times = rng.choice(n_terms, 6, replace=False), rng.integers(1, 3, 6)
        scores = (full[asked] * times[:, None]).sum(axis=0)
        found = dict(zip(*block.best(asked, times, 0, k, width=4)))
        least = np.sort(scores)[-k]
        assert found == {d: s for d, s in enumerate(scores) if s >= max(least, 1)}


def test_few_documents_are_scored():
    """A query whose best documents stand out leaves most intervals unsplit."""
    rng = np.random.default_rng(6)
    n_docs = 4000
    doc = np.concatenate([np.arange(n_docs), rng.choice(n_docs, 40, replace=False)])
    term = np.repeat([0, 1], [n_docs, 40])
    impact = np.concatenate([rng.integers(1, 20, n_docs), rng.integers(1000, 2000, 40)])
    block = ranked_search.Block(term, doc, impact, n_docs, 2)
    scored = []
    block.range_max, plain = lambda a, b: scored.append(len(a)) or plain(a, b), block.range_max
    block.best(np.array([0, 1]), np.array([1, 1]), 0, 20, width=4)
    assert sum(scored) < 400


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a")]) == [] == run(spark, [(1, "a")], [])
    assert run(spark, [(1, None), (2, "--")], [(1, "a")]) == []
