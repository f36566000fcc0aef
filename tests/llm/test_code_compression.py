"""Vector codes against a brute-force quantizer; the tree against all distances."""

import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marquee.llm import code_compression
from marquee.llm.code_compression import Gnat
from tests.llm.util import CLASHES


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10 ** 6), st.integers(1, 256), st.integers(1, 16), st.sampled_from([1, 3, 300, 2 ** 25]),
       st.integers(2, 17), st.integers(1, 64))
def test_tree_finds_what_all_distances_find(seed, k, width, top, degree, leaf):
    """Ties and equal entries included (small numbers collide)."""
    rng = np.random.default_rng(seed)
    entries, queries = (rng.integers(-top, top + 1, (n, width)) for n in (k, 200))
    index, squared = Gnat(entries, degree, leaf).nearest(queries)
    all_ = ((queries[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert (index == all_.argmin(axis=1)).all() and (squared == all_.min(axis=1)).all()


def test_tree_eliminates_subtrees():
    rng = np.random.default_rng(5)
    centres = rng.integers(-20_000, 20_000, (16, 8))
    entries = (centres[:, None, :] + rng.integers(-20, 20, (16, 16, 8))).reshape(256, 8)
    tree = Gnat(entries, degree=8, leaf=16)
    tree.nearest(entries[rng.integers(0, 256, 500)] + 1)
    assert tree.measured < 0.4 * 500 * 256


def brute(rows, parts=4, entries=256, rounds=4):
    kept = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    dims = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == dims]
    w = dims // parts
    cut = lambda v, p: v[p * w:(p + 1) * w]
    books = [[cut(r[1], p) for r in kept[:entries]] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            owned = {}
            for _, v, _ in kept:
                owned.setdefault(near(cut(v, p), books[p])[1], []).append(cut(v, p))
            for e, members in owned.items():
                books[p][e] = [sum(c) // len(members) for c in zip(*members)]
    sha = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    out, by_label = [], {}
    for i, v, label in kept:
        found = [near(cut(v, p), books[p]) for p in range(parts)]
        error = sum(d for d, _ in found)
        by_label[label] = by_label.get(label, 0) + error
        out.append((i, "".join(f"{e:02x}" for _, e in found), error, label))
    return sorted(((i, c, e, by_label[label], sha) for i, c, e, label in out), key=str)


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    df = df.selectExpr("*", *[f"'x' AS `{c}`" for c in [*CLASHES, "code", "error", "ints", "part", "entry"]
                              if c != "label"])
    out = code_compression.compress(df.repartition(3) if rows else df, **options)
    return sorted(map(tuple, out.collect()), key=str)


def vectors(n, dims=8, seed=3, levels=None):
    rng = random.Random(seed)
    draw = (lambda: rng.choice(levels)) if levels else (lambda: np.float32(rng.gauss(0, 0.2)).item())
    return [(i, [draw() for _ in range(dims)], rng.choice([None, 0, 1])) for i in range(n)]


@pytest.mark.parametrize("levels", [None, [0.0, 0.001, -0.001]])
def test_codes_match_brute_force(spark, levels):
    """With few levels most distances tie."""
    rows = vectors(400, levels=levels)
    rows += [rows[7], rows[7], (None, [0.5] * 8, 2), (None, [0.25] * 8, None),
             (900, None, 1), (901, [None] + [0.0] * 7, 1), (902, [math.nan] + [0.0] * 7, 1),
             (903, [math.inf] + [0.0] * 7, 1), (904, [-math.inf] * 8, 1), (905, [0.0] * 4, 1), (906, [], 1)]
    assert run(spark, rows, entries=64) == brute(rows, entries=64)


def test_fewer_rows_than_entries(spark):
    rows = vectors(9)
    got = run(spark, rows)
    assert got == brute(rows) and all(r[2] == 0 for r in got)


def test_large_components(spark):
    """Past what doubles hold exactly, the distances are computed in 64-bit integers."""
    rows = [(i, [float(np.float32(x * 60_000)) for x in v], label) for i, v, label in
            vectors(120, levels=[0.9, -0.7, 0.31, 0.5])]
    assert run(spark, rows, entries=16, rounds=2) == brute(rows, entries=16, rounds=2)
    with pytest.raises(Exception, match="after scaling"):
        run(spark, [(1, [70_000.0] * 8, 0)])


def test_empty_tables(spark):
    assert run(spark, []) == [] and run(spark, [(1, None, 2), (2, [math.nan] * 8, 1)]) == []
    with pytest.raises(ValueError, match="equal parts"):
        run(spark, [(1, [0.0] * 7, 0)])
