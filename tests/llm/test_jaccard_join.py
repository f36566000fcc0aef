import random
import re

import numpy as np
import pytest

from marquee.llm import jaccard_join as J
from marquee.llm.common import components
from tests.llm.util import WORDS, docs, long_text, prose


def shingle_set(t):
    w = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < 5 else frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def brute(rows, threshold=75):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= threshold * (len(sets[a]) + len(sets[b]) - both):
                parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return sorted(((i, len(s), least.get(find(k)) if s else i) for k, ((i, _), s) in enumerate(zip(rows, sets))),
                  key=str)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        at = rng.randrange(len(words))
        r = rng.random()
        if r < 0.4:
            words[at] = f"edit{rng.randrange(10 ** 6)}"
        elif r < 0.7:
            words.insert(at, f"new{rng.randrange(10 ** 6)}")
        else:
            del words[at]
    return " ".join(words)


def corpus(seed):
    rng = random.Random(seed)
    passage = prose(rng, 30)
    rows = []
    for base in range(8):
        words = prose(rng, rng.choice([12, 40, 90])).split()
        for _ in range(rng.randrange(2, 12)):
            rows.append(edited(rng, words, rng.randrange(0, max(2, len(words) // 12))))
    rows += [f"{passage} {prose(rng, rng.randrange(1, 30))}" for _ in range(25)]  # a passage many share
    words = prose(rng, 60).split()
    for _ in range(12):  # a chain: each an edit of the one before
        rows.append(" ".join(words))
        words = edited(rng, words, 2).split()
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    rows += [(500, None), (501, ""), (502, " \n"), (503, "A b C"), (504, "a B\tc"), (505, "a b"), (506, "one"),
             (507, "a b c d e"), (3, rows[3][1]), (3, rows[5][1]), (None, rows[7][1]), (None, "alone here now ok yes"),
             (508, long_text(4000)), (509, long_text(4000) + " end"), (510, "ÀÉ x y z w v"), (511, "àé x y z w v")]
    return rows


@pytest.mark.parametrize("seed,overfull", [(1, 16), (2, 1)])
def test_matches_brute_force(spark, monkeypatch, seed, overfull):
    monkeypatch.setattr(J, "OVERFULL", overfull)
    monkeypatch.setattr(J, "PAIRS_PER_SALT", 5)
    rows = corpus(seed)
    got = J.near_duplicates(docs(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows)


def test_threshold_is_met_exactly(spark):
    """7 of 9 and 6 of 8 shingles shared: linked at 75; 5 of 7 is not."""
    a = [f"a{k}" for k in range(30)]
    rows = [(0, " ".join(a[:12])), (1, " ".join(a[:11] + ["x"])),     # 7 / 9
            (10, " ".join(a[12:22])), (11, " ".join(a[12:21] + ["y"])),  # 5 / 7
            (20, " ".join(f"b{k}" for k in range(11))), (21, " ".join(f"b{k}" for k in range(10)) + " z")]  # 6 / 8
    got = {r.doc_id: r.component_id for r in J.near_duplicates(docs(spark, rows)).collect()}
    assert got == {0: 0, 1: 0, 10: 10, 11: 11, 20: 20, 21: 20}


def test_representatives(spark):
    rows = list(dict(r for r in corpus(3) if r[0] is not None).items())
    rows += rows[:2]  # repeated rows come back once
    table = docs(spark, rows)
    kept = J.representatives(table)
    assert kept.columns == table.columns
    comps = {}
    for (i, n, c) in brute(rows):
        if n and c is not None:
            comps.setdefault(c, 0)
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(got) == len(set(got))
    assert sorted(i for i, t in got if t and t.strip()) == sorted(comps)
    assert {500, 501, 502} <= {i for i, _ in got}


def test_representatives_of_documents_without_an_id(spark):
    """A component without any id keeps exactly one row; one with an id keeps that."""
    rng = random.Random(4)
    near, mixed, unique = (prose(rng, 60) for _ in range(3))
    rows = [(None, near), (None, near + " one"), (None, near + " two"), (None, near),
            (None, mixed), (7, mixed + " end"), (9, mixed), (None, unique), (None, None), (8, prose(rng, 60))]
    kept = [(r.doc_id, r.text) for r in J.representatives(docs(spark, rows)).collect()]
    assert len(kept) == len(set(kept)) == 5
    assert sum((t or "").startswith(near) for _, t in kept) == 1
    assert {(7, mixed + " end"), (None, unique), (None, None), rows[-1]} <= set(kept)
    got = J.near_duplicates(docs(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows)


def test_long_ids_beside_null_ids(spark):
    """Ids beyond 2 ** 53 stay exact, and their documents are kept, next to rows without an id."""
    rng = random.Random(8)
    rows = [((1 << 62) + k if k % 3 else None, prose(rng, 40)) for k in range(60)]
    rows += [((1 << 62) + 101, rows[1][1] + " end"), (None, rows[2][1] + " end")]
    got = J.near_duplicates(docs(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows)
    kept = [(r.doc_id, r.text) for r in J.representatives(docs(spark, rows)).collect()]
    assert sorted(kept, key=str) == sorted(rows[:60], key=str)


def test_prefix_length():
    for n in range(1, 300):
        assert J.prefix_length(n) == n - -(-75 * n // 100) + 1
    assert J.prefix_length(0) == 0


def test_parity_maps_never_exceed_the_difference():
    rng = np.random.default_rng(1)
    for _ in range(50):
        pool = rng.integers(0, 2 ** 63, 900).astype(np.uint64)
        a, b = (np.unique(pool[rng.random(900) < 0.6]) for _ in range(2))
        for size in (J.MAPS, J.WIDE):
            differ = (J._parity(a, size) ^ J._parity(b, size)).view(np.uint64)
            assert sum(int(x).bit_count() for x in differ) <= len(np.setxor1d(a, b))
        double, single = J._parity(a, 2 * J.WIDE), J._parity(a, J.WIDE)
        assert (double[:J.WIDE] ^ double[J.WIDE:]).tolist() == single.tolist()
    for n in range(1, 5000, 7):  # sets that may link have maps of like size
        assert 64 * J._wide(n) >= 4 * n and J._wide(-(-n * 100 // 75)) in (J._wide(n), 2 * J._wide(n))


def test_fragments_cut_the_order_without_loss():
    rng = np.random.default_rng(2)
    s = np.unique(rng.integers(0, 2 ** 63, 500).astype(np.uint64) * np.uint64(2))
    counts = np.zeros(1 << J.CELL_BITS, dtype=np.uint32)
    counts[J.cells(s[::7])] = 50 + np.arange(len(s[::7]))
    order = J.Order(counts)
    rare, often = order.split(s)
    assert len(often) >= len(s[::7]) and len(rare) + len(often) == len(s)
    assert sorted(np.concatenate(order.fragments(s)).tolist()) == s.tolist()


def test_components(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(100 + k, 101 + k) for k in range(50)]
    parent = {v: v for e in edges for v in e}

    def find(x):
        return x if parent[x] == x else find(parent[x])
    for a, b in edges:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.node: r.comp for r in components(spark.createDataFrame(edges, "x long, y long")).collect()}
    assert got == {v: find(v) for e in edges if e[0] != e[1] for v in e}
    assert components(spark.createDataFrame([], "x long, y long")).count() == 0


def test_empty_table(spark):
    assert J.near_duplicates(docs(spark, [])).count() == 0
    assert J.representatives(docs(spark, [])).count() == 0


def test_copies_without_ids_are_one_row_of_a_class(spark):
    """Two near texts, many copies each without an id: the fragments that are joined are
    those of two documents, and every copy still has its component."""

    words = prose(random.Random(5), 120).split()
    near = words[:60] + ["changed"] + words[61:]
    rows = [(None, " ".join(words))] * 150 + [(None, " ".join(near))] * 150 + [(7, "something else entirely here now")]
    seen = []
    plain = J._Join.fragments_of

    def counted(self, *args):
        parts = plain(self, *args)
        seen.append((parts.count(), parts.select("node").distinct().count()))
        return parts

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(J._Join, "fragments_of", counted)
        got = J.near_duplicates(docs(spark, rows), threshold=75).collect()
    assert seen and all(n == classes <= 2 for n, classes in seen)
    assert len(got) == 301 and sum(r.first for r in got if r.component_id is None) == 150


def test_the_positional_bound_loses_no_link(spark):
    """Texts around the threshold that share their passage at any place."""

    rng = random.Random(8)
    base = prose(rng, 200).split()
    rows = []
    for i in range(40):
        cut = rng.randrange(10, 60)
        at = rng.randrange(0, 200 - cut)
        rows.append((i, " ".join(base[:at] + prose(rng, rng.randrange(0, cut)).split() + base[at + cut:])))
    got = {r.doc_id: r.component_id for r in J.near_duplicates(docs(spark, rows), threshold=75).collect()}
    sets = {i: set(J.shingles(t).tolist()) for i, t in rows}
    comp = {i: i for i in sets}

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                comp[y] = x
    assert got == {i: root(i) for i in sets} and len(set(got.values())) > 1
