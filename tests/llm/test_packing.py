import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from marquee.llm import packing
from tests.llm.util import docs, long_text


def naive(lengths, capacity):
    """Document-by-document best fit decreasing: the multiset of bins."""
    bins = []
    for n in sorted(lengths, reverse=True):
        fits = [b for b in bins if capacity - sum(b) >= n]
        if fits:
            min(fits, key=lambda b: capacity - sum(b)).append(n)
        else:
            bins.append([n])
    return Counter(sum(b) for b in bins)


def by_plan(lengths, capacity):
    moves = packing.plan(dict(Counter(lengths)), capacity)
    fill, places = defaultdict(int), defaultdict(list)
    for n, count in Counter(lengths).items():
        own = [m for m in moves if m[0] == n]
        for rank in range(count):
            _, first_rank, first, per, room = max((m for m in own if m[1] <= rank), key=lambda m: m[1])
            nth = rank - first_rank
            seq = first + nth // per
            places[seq].append((capacity - room + nth % per * n, n))
            fill[seq] += n
    for spots in places.values():
        at = 0
        for offset, n in sorted(spots):
            assert offset == at
            at += n
        assert at <= capacity
    return Counter(fill.values())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=80))
def test_plan_packs_like_best_fit_decreasing(lengths):
    assert by_plan(lengths, 30) == naive(lengths, 30)


def test_plan_at_full_capacity():
    rng = random.Random(1)
    lengths = [min(1024, int(rng.paretovariate(0.7) * 20)) for _ in range(3000)]
    assert by_plan(lengths, 1024) == naive(lengths, 1024)


def test_room_tree():
    tree = packing.RoomTree(50)
    rng, rooms = random.Random(3), set()
    for _ in range(500):
        r = rng.randrange(1, 51)
        rooms ^= {r}
        tree.mark(r, r in rooms)
        need = rng.randrange(1, 51)
        assert tree.tightest(need) == min((x for x in rooms if x >= need), default=None)


def test_cut_only_the_first_piece_is_shorter():
    for n in (1, 5, 10, 11, 25, 30):
        pieces = packing.cut(n, 10)
        assert sum(k for _, k in pieces) == n and all(k == 10 for _, k in pieces[1:])
        assert [s for s, _ in pieces] == list(np.cumsum([0] + [k for _, k in pieces[:-1]]))


ROWS = [(i, f"Some words, number {i}! " * (i % 17)) for i in range(80)] + [
    (90, None), (91, ""), (92, "a <|endoftext|> b"), (93, "<|endoftext|>"), (3, "Some words"),
    (3, "Some words"), (None, "no id"), (94, "ünï\x00 码 💥\r\n\t  x"), (95, long_text(3000)), (96, "a" * 5000)]


@pytest.mark.parametrize("capacity", [1024, 64])
def test_pack_round_trip(spark, capacity):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.tokenizer_path())
    got = packing.pack(docs(spark, ROWS), capacity=capacity, with_ids=True).collect()
    want = Counter()
    for i, t in ROWS:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        for k, (start, n) in enumerate(packing.cut(len(ids), capacity)):
            part = ids[start:start + n]
            want[i, k, start, n, zlib.crc32(np.array(part, dtype="<u4").tobytes()), tuple(part)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for spots in sequences.values():
        at = 0
        for offset, n in sorted(spots):
            assert offset == at
            at += n
        assert at <= capacity
    lengths = [r.length for r in got]
    assert Counter(sum(n for _, n in s) for s in sequences.values()) == naive(lengths, capacity)


def test_empty_table(spark):
    assert packing.pack(docs(spark, [])).collect() == []
