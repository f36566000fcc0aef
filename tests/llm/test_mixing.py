import random
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings, strategies as st

from marquee.llm import mixing
from tests.llm.util import WORDS, docs, long_text, prose

rng = random.Random(8)
ROWS = [(i, prose(rng, int(rng.paretovariate(0.9) * 8)), f"s{i % 5}" if i % 3 else "hot") for i in range(900)]
ROWS += [(2000 + i, prose(rng, 20), None) for i in range(30)]
ROWS += [(3000, None, "s1"), (3001, "", "empty"), (3002, " \n ", "empty"), (3003, long_text(5000), "long"),
         (None, "one two three", "s2"), (4001, "twice here", "s3"), (4001, "twice here", "s3"), (4002, " x\x1cy z", "ß")]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 1000), max_size=8))
def test_targets(sizes):
    weights = [mixing.WEIGHTS[k % 3] for k in range(len(sizes))]
    t = mixing.targets(sizes, weights, 1.5, 2.0)
    assert abs(sum(t) - 1.5 * sum(sizes)) < 1e-6
    assert all(a <= 2 * s + 1e-9 for a, s in zip(t, sizes))
    level = [a / w for a, w, s in zip(t, weights, sizes) if s and a < 2 * s - 1e-9]
    assert not level or max(level) - min(level) < 1e-6  # those below the cap share by weight
    assert all(a / w <= max(level) + 1e-6 for a, w, s in zip(t, weights, sizes) if level)


def test_newton_meets_the_goal():
    words = np.array([100.0, 50.0, 0.0, 7.0])
    goal = np.array([3.0, 100.0, 0.0, 7.0])
    at = mixing.newton(lambda a: words * np.exp(a), goal)
    assert np.allclose(words * np.exp(at), goal)


def test_mix(spark):
    got = mixing.entropy_balance(docs(spark, ROWS)).collect()
    assert len(got) == len(ROWS)
    size = Counter()
    for _, t, s in ROWS:
        size[s] += len(WORDS.findall(t or ""))
    names = sorted((s for s in size if s is not None)) + [None]
    goal = dict(zip(names, mixing.targets([size[s] for s in names], [(3.0, 1.0, 2.0)[k % 3] for k in range(len(names))],
                                          1.5, 2.0)))
    want = Counter((i, len(WORDS.findall(t or "")), size[s], round(goal[s], 6)) for i, t, s in ROWS)
    assert Counter((r.doc_id, r["size"], r.source_size, round(r.target, 6)) for r in got) == want
    source = {i: s for i, _, s in ROWS}
    taken = defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 2 * r["size"] and r.taken == r.copies * r["size"]
        taken[source[r.doc_id]] += r.taken
    for s in names:
        if s != "long" and goal[s]:
            assert abs(taken[s] - goal[s]) <= max(10, 0.02 * goal[s]), s
    again = mixing.entropy_balance(docs(spark, ROWS[::-1])).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_mixed_documents_come_as_often_as_they_are_taken(spark):
    table = docs(spark, ROWS)
    copies = {r.doc_id: (r.copies if r["size"] else 1) for r in mixing.entropy_balance(table).collect()}
    mix = mixing.mixed_documents(table)
    assert mix.columns == table.columns
    times = Counter(r.doc_id for r in mix.collect())
    rows = Counter(i for i, *_ in ROWS)
    assert all(times[i] == copies[i] * rows[i] for i in rows)


def test_empty_table_and_no_words(spark):
    assert mixing.entropy_balance(docs(spark, [])).collect() == []
    got = mixing.entropy_balance(docs(spark, [(1, None, "a"), (2, "", None)])).collect()
    assert [(r.taken, r.target) for r in got] == [(0, 0.0), (0, 0.0)]


def test_rows_without_ids_meet_the_target_too(spark):
    """Two equal sources, one of them without ids or with one id: both end near the target."""
    rng = random.Random(3)
    for hot in (None, 7):
        rows = [(i, prose(rng, 32), "a") for i in range(600)] + [(hot, prose(rng, 32), "b") for _ in range(600)]
        taken, goal = defaultdict(int), {}
        got = mixing.entropy_balance(docs(spark, rows), weights=(1.0,), budget=1.5).collect()
        assert len(got) == 1200
        for r in got:
            source = "a" if r.doc_id is not None and r.doc_id < 600 and r.doc_id != hot else "b"
            taken[source] += r.taken
            goal[source] = r.target
        if hot is None:
            assert abs(taken["a"] - goal["a"]) < 0.02 * goal["a"] and abs(taken["b"] - goal["b"]) < 0.02 * goal["b"]
        assert abs(sum(taken.values()) - 1.5 * 1200 * 32) < 0.02 * 1.5 * 1200 * 32
