import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from marquee.llm import suffix_dedup as S
from tests.llm.util import docs, long_text


def brute(rows, span=S.SPAN):
    seen = Counter()
    texts = [(i, (t or "").encode()) for i, t in rows]
    for _, b in texts:
        seen.update(hash(b[k:k + span]) for k in range(len(b) - span + 1))
    out = []
    for i, b in texts:
        gone = np.zeros(len(b), dtype=bool)
        for k in range(len(b) - span + 1):
            if seen[hash(b[k:k + span])] > 1:
                gone[k:k + span] = True
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = np.frombuffer(b, dtype=np.uint8)[~gone].tobytes()
        out.append((i, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    make = lambda n, letters="abcdefgh \n": "".join(rng.choice(letters) for _ in range(n))
    passages = [make(rng.choice([150, 199, 200, 201, 230, 400, 700])) for _ in range(10)]
    rows = []
    for i in range(50):
        t = ""
        for _ in range(rng.randrange(6)):
            r = rng.random()
            if r < 0.45:
                t += rng.choice(passages)
            elif r < 0.6:
                p = rng.choice(passages)
                a = rng.randrange(len(p))
                t += p[a:a + rng.randrange(1, 500)]
            elif r < 0.65:
                t += rng.choice("ab\0") * rng.randrange(1, 600)
            elif r < 0.7:
                t += ("xyz" + rng.choice("ab")) * rng.randrange(1, 150)
            else:
                t += make(rng.randrange(300), "abcdefgh é💥\n")
        rows.append((i, t))
    rows += [(3, rows[3][1]), (None, rows[7][1]), (90, None), (91, ""), (92, "x" * 199), (93, "y" * 200),
             (94, "y" * 200), (95, long_text(3000)), (96, long_text(2000)[::-1])]
    return rows


@pytest.mark.parametrize("seed,hot,block,hot_set", [
    (1, 1000, 1 << 17, 10 ** 6), (2, 3, 1 << 17, 10 ** 6), (2, 3, 1 << 17, 0), (3, 3, 700, 10 ** 6)])
def test_matches_brute_force(spark, monkeypatch, seed, hot, block, hot_set):
    """Also with most anchors hot (their windows broadcast or looked up), and with texts
    cut into many blocks."""
    monkeypatch.setattr(S, "HOT_SET", hot_set)
    monkeypatch.setattr(S, "HOT", hot)
    monkeypatch.setattr(S, "BLOCK", block)
    rows = corpus(seed)
    got = sorted(map(tuple, S.remove_repeats(docs(spark, rows)).collect()), key=str)
    assert got == brute(rows)


def test_kept_bytes(spark):
    twice = "".join(random.Random(1).choice("abcd") for _ in range(300))
    got = {r.doc_id: bytes(r.kept) for r in S.remove_repeats(
        docs(spark, [(1, "head " + twice + " tail"), (2, twice + "é"), (3, "short")]), with_bytes=True).collect()}
    assert got == {1: b"head  tail", 2: "é".encode(), 3: b"short"}


def test_empty_table(spark):
    assert S.remove_repeats(docs(spark, [])).collect() == []


def test_merge_is_a_merge_and_gives_true_shared_lengths():
    rng = random.Random(2)
    for _ in range(60):
        runs = []
        for _ in range(rng.randrange(1, 9)):
            words = sorted(bytes(rng.choice(b"\0ab") for _ in range(rng.randrange(1, 12)))
                           for _ in range(rng.randrange(0, 25)))
            runs.append((words, [0] + [common(a, b) for a, b in zip(words, words[1:])][:max(0, len(words) - 1)]))
        order, lcps = S.merge_runs(runs)
        merged = [runs[a][0][i] for a, i in order]
        assert merged == sorted(w for r in runs for w in r[0])
        assert lcps[1:] == [common(a, b) for a, b in zip(merged, merged[1:])]


def common(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def test_front_coded_runs_round_trip():
    rng = random.Random(3)
    keys = [bytes(rng.choice(b"\0ab") for _ in range(rng.randrange(9, 60))) for _ in range(400)]
    facts = np.arange(2000, dtype=np.int64).reshape(400, 5)
    frame = S._run_rows(keys, [b""] * 400, facts, 4)
    back = [S._read_run(r.shared, r.sizes, r.tails) for r in frame.itertuples()]
    assert [k for run in back for k in run] == sorted(keys)
    assert sum(len(r.tails) for r in frame.itertuples()) < sum(map(len, keys))


def test_equal_windows_name_the_same_gram():
    rng = random.Random(4)
    shared = bytes(rng.choice(b"abcdef") for _ in range(450))
    texts = [bytes(rng.choice(b"abcdef") for _ in range(rng.randrange(300))) + shared +
             bytes(rng.choice(b"abcdef") for _ in range(rng.randrange(300))) for _ in range(5)]
    block = S.Block([(k, 0, t) for k, t in enumerate(texts)])
    named = {}
    for w, a in zip(block.windows.tolist(), block.anchors.tolist()):
        key = block.data[w:w + S.SPAN].tobytes()
        assert named.setdefault(key, a - w) == a - w
    assert len(block.windows) == sum(len(t) - S.SPAN + 1 for t in texts)
