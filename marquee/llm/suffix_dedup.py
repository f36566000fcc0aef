"""Removing repeated byte strings by a common-prefix-aware distributed merge sort of
suffixes.

Every byte covered by a ``SPAN``-byte string that also starts anywhere else, in
the same document or another, is removed; strings are judged on the input.

1. Anchors. Each SPAN-byte window names the ``GRAM``-byte gram in it with the least
   hash (the leftmost of equals): equal windows name the same gram at the same
   place. Grams are counted over the whole corpus; a window whose gram only one group
   of adjacent windows names is unique and needs no sorting. What is left of a
   document are suffixes at anchors, each with the windows that named it.
2. Runs. A task sorts its suffixes (by gram hash, then bytes) and writes each range
   of hashes as a front-coded run: the length shared with the suffix before, and
   the bytes after that. Only these runs are exchanged.
3. Merge. A loser tree merges the runs of a range. Each head carries the length it
   shares with the last suffix put out, so most matches are decided by comparing
   two numbers, and bytes known to be equal are never compared again. The merged
   order comes with the common-prefix length of neighbours.
4. Windows. A window ``d`` bytes before its anchor is repeated if another suffix
   shares SPAN - d bytes from the anchor on and ``d`` bytes before it: for each d,
   classes of suffixes (cuts of the merged order) and classes of reversed left
   contexts are compared as two integers.

Anchors named by more groups of windows than a range is planned for (``HOT``, whatever
the corpus holds) are not gathered in one range: their windows are counted one by one,
by hash, combined in the map tasks and looked up by salted keys. A Bloom filter names
them, since there may be any number of them; an anchor it takes for hot by mistake is
counted so in every task, with the same result. Texts that several documents have
whole are read once a task and removed whole.

Defined cases: a null text is empty; a text shorter than SPAN loses nothing, as
does an empty one; rows repeated whole count as occurrences of each other; null
ids are carried along; an empty table gives an empty table; other columns are
ignored. Texts are known by their length and a 64-bit hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import bloom_bitmap, in_bloom, look_up, written

SPAN = 200
GRAM = 32
REACH = SPAN - GRAM           # an anchor is at most this far into its windows
BLOCK = 1 << 17               # bytes hashed at once: few enough to stay in a core's cache
HOT_SET = 2_000_000           # hashes (16 MB) of hot repeated windows that may be broadcast
RANGE_SUFFIXES = 20_000       # suffixes that one merge is planned for
HOT = RANGE_SUFFIXES          # an anchor with more suffixes is never gathered
RUN_BYTES = 8 << 20           # a task's suffixes are sorted and written when they reach this
HELD = 200_000                # numbers a task holds before it hands them on
KEY = 8                       # bytes of the gram hash before a suffix in the sort key
WIDTH = KEY + SPAN

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_PLACE = np.uint64((1 << 24) - 1)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_BASE), n, 1 << 64))


def _hashes(data: np.ndarray, sizes: tuple[int, ...]) -> dict[int, np.ndarray]:
    """Polynomial hashes of the ``size`` bytes from each position (powers of two)."""
    h, n, out = data.astype(np.uint64) + np.uint64(1), 1, {}
    while n < max(sizes):
        if len(h) <= n:
            h = h[:0]
        else:
            h = h[:-n] * _power(n) + h[n:]
        n *= 2
        if n in sizes:
            out[n] = h
    return out


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def _least(a: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` consecutive values."""
    n = 1
    while 2 * n <= width:
        a = np.minimum(a[:-n], a[n:])
        n *= 2
    return np.minimum(a[:len(a) - (width - n)], a[width - n:]) if width > n else a


class Block:
    """Pieces of texts hashed together: for every window its anchor.

    A piece is (text number, first byte, bytes)."""

    def __init__(self, pieces: list[tuple[int, int, bytes]]):
        self.pieces = pieces
        self.data = np.frombuffer(b"".join(p[2] for p in pieces), dtype=np.uint8)
        sizes = np.array([len(p[2]) for p in pieces])
        self.starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        grams = _mixed(_hashes(self.data, (GRAM,))[GRAM])
        keys = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        anchor = (_least(keys, REACH + 1) & _PLACE).astype(np.int64)
        # windows that lie inside one piece
        inside = np.zeros(len(self.data) + 1, dtype=np.int8)
        inside[self.starts] += 1
        inside[self.starts + sizes - SPAN + 1] -= 1
        self.windows = np.flatnonzero(np.cumsum(inside[:len(anchor)]))
        self.anchors = anchor[self.windows]
        self.grams = grams
        self.first, self.last = _runs(self.windows, self.anchors)

    def names(self, anchors: np.ndarray) -> np.ndarray:
        """The grams at anchors, hashed once more: anchors have the least hashes, which
        are anything but uniform."""
        return _mixed(self.grams[anchors])

    def groups(self) -> np.ndarray:
        """The gram of each group of windows with one anchor."""
        return self.names(self.anchors[self.first])

    def piece_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, at, side="right") - 1

    def open_windows(self, bitmap: np.ndarray) -> np.ndarray:
        """Which windows name a gram that other groups of windows name too."""
        return np.repeat(in_bloom(bitmap, self.groups()), self.last - self.first + 1)


def _runs(windows: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of runs of adjacent windows with one anchor."""
    if not len(windows):
        return windows, windows
    new = np.flatnonzero((np.diff(windows) != 1) | (np.diff(anchors) != 0)) + 1
    return np.concatenate([[0], new]), np.concatenate([new, [len(windows)]]) - 1


def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[Block, list]]:
    """Blocks of the distinct texts of a task (columns ``text``, ``th``, ``n``), and
    for each piece its text's (th, n). Long texts are cut so that every window is in
    one piece."""
    pieces, names, size, seen = [], [], 0, set()
    for b in batches:
        for text, th, n in zip(b["text"], b["th"], b["n"]):
            if n < SPAN or (th, n) in seen:
                continue
            seen.add((th, n))
            data = text.encode("utf-8", "surrogatepass")
            for start in range(0, len(data) - SPAN + 1, BLOCK):
                part = data[start:start + BLOCK + SPAN - 1]
                pieces.append((len(names), start, part))
                names.append((th, n))
                size += len(part)
                if size >= BLOCK:
                    yield Block(pieces), names
                    pieces, names, size = [], [], 0
    if pieces:
        yield Block(pieces), names


# --- front-coded runs -------------------------------------------------------

def _padded(rows: list[bytes], width: int) -> np.ndarray:
    """The rows as a matrix of bytes, zeros behind their ends."""
    if not rows:
        return np.zeros((0, width), dtype=np.uint8)
    return np.frombuffer(b"".join(r.ljust(width, b"\0") for r in rows),
                         dtype=np.uint8).reshape(len(rows), width)


def _order(matrix: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The byte order of the rows (a prefix before what it is a prefix of)."""
    by_size = np.argsort(sizes, kind="stable")
    rows = np.ascontiguousarray(matrix[by_size]).view(f"S{matrix.shape[1]}").ravel()
    return by_size[np.argsort(rows, kind="stable")]


def _shared(matrix: np.ndarray) -> np.ndarray:
    """For each row the length of the prefix it shares with the row before."""
    differ = matrix[1:] != matrix[:-1]
    return np.concatenate([[0], np.where(differ.any(1), differ.argmax(1), matrix.shape[1])])[
        :len(matrix)].astype(np.int64)


RUN_SCHEMA = ("part int, shared binary, sizes binary, tails binary, left_sizes binary, "
              "lefts binary, th binary, n binary, at binary, near binary, far binary")


def _run_rows(keys: list[bytes], lefts: list[bytes], facts: np.ndarray, parts: int) -> pd.DataFrame:
    """Sort one task's suffixes; a front-coded run for each range of gram hashes.

    ``facts``: th, n, anchor, nearest and farthest window distance of each."""
    matrix = _padded(keys, WIDTH)
    sizes = np.array([len(k) for k in keys])
    order = _order(matrix, sizes)
    matrix, facts, sizes = matrix[order], facts[order], sizes[order]
    top = matrix[:, :4].copy().view(">u4").ravel().astype(np.int64)
    part = top * parts >> 32
    shared = np.minimum(_shared(matrix), np.minimum(sizes, np.roll(sizes, 1)))
    rows = []
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]])
    for a, b in zip(cuts[:-1], cuts[1:]):
        own = shared[a:b].copy()
        own[0] = 0
        tails = b"".join(keys[i][s:] for i, s in zip(order[a:b], own))
        left = [lefts[i] for i in order[a:b]]
        rows.append((int(part[a]), own.astype(np.uint8).tobytes(),
                     sizes[a:b].astype(np.uint8).tobytes(),
                     tails, np.array([len(x) for x in left], dtype=np.uint8).tobytes(),
                     b"".join(left), *[np.ascontiguousarray(facts[a:b, k]).tobytes()
                                       for k in range(5)]))
    return pd.DataFrame(rows, columns=[c.split()[0] for c in RUN_SCHEMA.split(", ")])


def _read_run(shared: bytes, sizes: bytes, tails: bytes) -> list[bytes]:
    out, at, before = [], 0, b""
    for s, n in zip(shared, sizes):
        before = before[:s] + tails[at:at + n - s]
        at += n - s
        out.append(before)
    return out


def merge_runs(runs: list[tuple[list[bytes], list[int]]]) -> tuple[list[tuple[int, int]], list[int]]:
    """Merge sorted runs of (suffixes, shared lengths) with a loser tree.

    Each run's head carries the length it shares with the suffix put out last. Of two
    heads the one that shares more is the smaller, and the loser's length stays true;
    only heads that share equally much are compared, from that length on. Returns
    (run, position) in order and the shared length of each with the one before."""
    k = len(runs)
    heads = [0] * k
    share = [0] * k
    items = [r[0] for r in runs]
    known = [r[1] for r in runs]
    size = 1 << max(0, k - 1).bit_length()
    losers = [-1] * (2 * size)

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); an exhausted run is -1."""
        if a < 0:
            return b, a
        if b < 0:
            return a, b
        la, lb = share[a], share[b]
        if la != lb:
            return (a, b) if la > lb else (b, a)
        x, y = items[a][heads[a]], items[b][heads[b]]
        if x == y:
            share[b] = len(y)
            return a, b
        n = max(len(x), len(y)) - la
        differ = (int.from_bytes(x[la:].ljust(n, b"\0"), "big")
                  ^ int.from_bytes(y[la:].ljust(n, b"\0"), "big"))
        common = min(la + n - (differ.bit_length() + 7) // 8, len(x), len(y))
        if x[la:] < y[la:]:
            share[b] = common
            return a, b
        share[a] = common
        return b, a

    def build(node: int) -> int:
        if node >= size:
            return node - size if node - size < k and items[node - size] else -1
        winner, losers[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    order, lcps = [], []
    winner = build(1) if k else -1
    while winner >= 0:
        order.append((winner, heads[winner]))
        lcps.append(share[winner])
        run = winner
        heads[run] += 1
        if heads[run] < len(items[run]):
            share[run] = known[run][heads[run]]
        else:
            winner = -1
        node = (run + size) >> 1
        while node:
            winner, losers[node] = play(winner, losers[node])
            node >>= 1
    return order, lcps


def repeated_windows(pdf: pd.DataFrame) -> pd.DataFrame:
    """Merge the runs of one range; th, n, first and last start of repeated windows."""
    runs, lefts, facts, begin = [], [], [], []
    total = 0
    for r in pdf.itertuples():
        runs.append((_read_run(r.shared, r.sizes, r.tails), list(r.shared)))
        ends = np.cumsum(np.frombuffer(r.left_sizes, dtype=np.uint8))
        lefts += [r.lefts[a:b] for a, b in zip([0, *ends[:-1]], ends)]
        facts.append(np.stack([np.frombuffer(x, dtype=np.int64)
                               for x in (r.th, r.n, r.at, r.near, r.far)], axis=1))
        begin.append(total)
        total += len(runs[-1][0])
    order, lcps = merge_runs(runs)
    index = np.array([begin[a] + i for a, i in order], dtype=np.int64)
    th, n, at, near, far = np.concatenate(facts)[index].T
    right = np.array(lcps, dtype=np.int64) - KEY
    left_matrix = _padded([lefts[i] for i in index], max(1, REACH))
    left_order = _order(left_matrix, np.array([len(lefts[i]) for i in index]))
    left = _shared(left_matrix[left_order])
    m = len(index)
    repeated = np.zeros((m, REACH + 2), dtype=np.int8)
    class_left = np.empty(m, dtype=np.int64)
    for d in range(int(near.min()), int(far.max()) + 1):
        own = np.flatnonzero((near <= d) & (d <= far))
        if len(own) < 2:
            continue
        class_right = np.cumsum(right < SPAN - d)
        class_left[left_order] = np.cumsum(left < d) if d else 0
        both = class_right[own] * (m + 1) + class_left[own]
        sort = np.argsort(both, kind="stable")
        twice = np.flatnonzero(both[sort][1:] == both[sort][:-1])
        repeated[own[sort[twice]], d + 1] = 1
        repeated[own[sort[twice + 1]], d + 1] = 1
    step = np.diff(repeated, axis=1, append=np.int8(0))
    row, first = np.nonzero(step == 1)
    _, last = np.nonzero(step == -1)
    return pd.DataFrame({"th": th[row], "n": n[row], "a": at[row] - (last - 1),
                         "b": at[row] - first})


# --- the job ----------------------------------------------------------------

def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(docs[text_col], F.lit(""))
    return docs.select(docs[id_col].alias("id"), text.alias("text"), F.xxhash64(text).alias("th"),
                       F.octet_length(text).cast("long").alias("n"))


def _count_anchors(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0

        def counted() -> pd.DataFrame:
            h, c = np.unique(np.concatenate(held), return_counts=True)
            return pd.DataFrame({"h": h.view(np.int64), "c": c})

        for block, _ in blocks(batches):
            held.append(block.groups())
            n += len(held[-1])
            if n >= HELD:
                yield counted()
                held, n = [], 0
        if held:
            yield counted()

    return (texts.select("text", "th", "n").mapInPandas(run, "h long, c long")
            .groupBy("h").agg(F.sum("c").alias("c")))


HOT_COLUMNS = ("th", "n", "a", "w")
OPEN_SCHEMA = RUN_SCHEMA + "".join(f", hot_{c} array<long>" for c in HOT_COLUMNS)


def _open_rows(texts: DataFrame, bitmap, hot, parts: int) -> DataFrame:
    """The second scan: front-coded runs of the open suffixes (``part`` not null) and,
    for hot anchors, th, n, start and hash of every open window."""
    names = [c.split()[0] for c in OPEN_SCHEMA.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, lefts, facts, size = [], [], [], 0
        warm, n_warm = [], 0

        def full(frame: pd.DataFrame) -> pd.DataFrame:
            return frame.assign(**{c: None for c in names if c not in frame})[names]

        def runs() -> pd.DataFrame:
            return full(_run_rows(keys, lefts, np.concatenate(facts), parts))

        def windows() -> pd.DataFrame:
            return full(pd.DataFrame([dict(zip(names[-4:], np.concatenate(warm, axis=1)))]))

        for block, of in blocks(batches):
            live = np.flatnonzero(block.open_windows(bitmap.value))
            is_hot = in_bloom(hot.value, block.names(block.anchors[live]))
            shift = np.array([p[1] for p in block.pieces]) - block.starts
            th, n = np.array(of, dtype=np.int64).T
            if is_hot.any():
                warm.append(_hot_windows(block, live[is_hot], th, n, shift))
                n_warm += warm[-1].shape[1]
                if n_warm >= HELD:
                    yield windows()
                    warm, n_warm = [], 0
            live = live[~is_hot]
            win, anchors = block.windows[live], block.anchors[live]
            first, last = _runs(win, anchors)
            lo, hi, at = win[first], win[last], anchors[first]
            piece = block.piece_of(at)
            raw = block.data.tobytes()
            heads = block.names(at).astype(">u8").tobytes()
            for k, (a, b, p) in enumerate(zip(lo.tolist(), hi.tolist(), at.tolist())):
                keys.append(heads[KEY * k:KEY * k + KEY] + raw[p:b + SPAN])
                lefts.append(raw[a:p][::-1])
            facts.append(np.stack([th[piece], n[piece], at + shift[piece], at - hi, at - lo], axis=1))
            size += int((hi - lo).sum()) + (SPAN + KEY) * len(lo)
            if size >= RUN_BYTES:
                yield runs()
                keys, lefts, facts, size = [], [], [], 0
        if keys:
            yield runs()
        if warm:
            yield windows()

    out = texts.select("text", "th", "n").mapInPandas(run, OPEN_SCHEMA)
    return written(out, "suffix-open")


def _hot_windows(block: Block, live: np.ndarray, th: np.ndarray, n: np.ndarray,
                 shift: np.ndarray) -> np.ndarray:
    """th, n, start in the text and hash of windows, a row each."""
    w = block.windows[live]
    h = _hashes(block.data, (8, 64, 128))
    whole = _mixed(h[128][w] * _power(72) + h[64][w + 128] * _power(8) + h[8][w + 192])
    piece = block.piece_of(w)
    return np.stack([th[piece], n[piece], w + shift[piece], whole.view(np.int64)])


def _hot_spans(rows: DataFrame) -> DataFrame:
    """th, n, first and last start of the repeated windows with hot anchors: those whose
    hash is counted twice.

    The repeated hashes (of few passages, however many documents hold them) are
    broadcast if counted to be at most HOT_SET; else windows look them up by salted
    keys."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for hashes in b["hot_w"]:  # of many documents: combined before they are shuffled
                w, k = np.unique(np.asarray(hashes, dtype=np.int64), return_counts=True)
                yield pd.DataFrame({"w": w, "k": k})

    twice = written(rows.select("hot_w").mapInPandas(count, "w long, k long").groupBy("w")
                    .agg(F.sum("k").alias("k")).where("k > 1"), "suffix-hot")
    if twice.count() <= HOT_SET:
        known = rows.sparkSession.sparkContext.broadcast(
            np.sort(twice.select("w").toPandas()["w"].to_numpy(dtype=np.int64)))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for row in b.itertuples(index=False):
                    th, n, a, w = (np.asarray(x, dtype=np.int64) for x in row)
                    own = np.flatnonzero(np.isin(w, known.value))
                    th, n, a = th[own], n[own], a[own]
                    new = (np.diff(th) != 0) | (np.diff(n) != 0) | (np.diff(a) != 1)
                    first = np.concatenate([[0], np.flatnonzero(new) + 1])[:len(own)]
                    last = np.concatenate([first[1:] - 1, [len(own) - 1]])[:len(first)]
                    yield pd.DataFrame({"th": th[first], "n": n[first], "a": a[first], "b": a[last]})

        return rows.select(*[f"hot_{c}" for c in HOT_COLUMNS]).mapInPandas(
            run, "th long, n long, a long, b long")
    windows = rows.select(F.inline(F.arrays_zip(
        *[F.col(f"hot_{c}").alias(c) for c in HOT_COLUMNS]))).toDF(*HOT_COLUMNS)
    counted = look_up(windows, twice, ["w"], F.col("th")).where("k is not null")
    # adjacent windows of a text become one span
    rank = F.dense_rank().over(Window.partitionBy("th", "n").orderBy("a"))
    return (counted.withColumn("island", F.col("a") - rank).groupBy("th", "n", "island")
            .agg(F.min("a").alias("a"), F.max("a").alias("b")).drop("island"))


def repeated_spans(texts: DataFrame) -> DataFrame:
    """th, n, ``starts``: (first, last) starts of repeated windows, of every text that
    has any."""
    classes = texts.where(F.col("n") >= SPAN).groupBy("th", "n").agg(
        F.count(F.lit(1)).alias("copies")).where("copies > 1")
    whole = classes.select("th", "n", F.lit(0).cast("long").alias("a"),
                           (F.col("n") - SPAN).alias("b"))

    counts = written(_count_anchors(texts).where("c > 1"), "suffix-anchors")
    total = counts.agg(F.count(F.lit(1)).alias("k"), F.sum("c").alias("c")).first()
    hot = counts.where(F.col("c") > HOT).select("h")
    hot, bitmap = bloom_bitmap(hot, hot.count()), bloom_bitmap(counts.select("h"), total.k)

    parts = max(1, -(-(total.c or 0) // RANGE_SUFFIXES))
    found = _open_rows(texts, bitmap, hot, parts)
    run_columns = [c.split()[0] for c in RUN_SCHEMA.split(", ")]
    sorted_out = found.where("part is not null").select(*run_columns).groupBy("part").applyInPandas(
        repeated_windows, "th long, n long, a long, b long")

    spans = whole.unionByName(sorted_out).unionByName(_hot_spans(found.where("part is null")))
    return written(spans.groupBy("th", "n").agg(
        F.array_sort(F.collect_set(F.struct("a", "b"))).alias("starts")), "suffix-spans")


def _cut(data: bytes, starts) -> tuple[bytes, int]:
    """What is left of a text, and the number of maximal removed runs."""
    gone = np.zeros(len(data) + 1, dtype=np.int32)
    np.add.at(gone, [s["a"] for s in starts], 1)
    np.add.at(gone, [s["b"] + SPAN for s in starts], -1)
    stay = np.cumsum(gone[:-1]) == 0
    spans = int((np.diff(stay.astype(np.int8), prepend=1) == -1).sum())
    return np.frombuffer(data, dtype=np.uint8)[stay].tobytes(), spans


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   with_bytes: bool = False) -> DataFrame:
    """One row per document: id, ``n_bytes``, ``n_removed``, ``n_spans``,
    ``kept_sha256`` (and the remaining bytes, ``kept``)."""
    texts = _texts(docs, id_col, text_col)
    spans = repeated_spans(texts)
    held = bloom_bitmap(spans.select("th"), spans.count())

    @F.pandas_udf("boolean")
    def maybe(th: pd.Series) -> pd.Series:
        return pd.Series(in_bloom(held.value, th.to_numpy().view(np.uint64)))

    schema = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (
        ", kept binary" if with_bytes else "")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc_id, text, starts in zip(b["id"], b["text"], b["starts"]):
                data = text.encode("utf-8", "surrogatepass")
                kept, n = _cut(data, starts) if starts is not None else (data, 0)
                rows.append((doc_id, len(data), len(data) - len(kept), n,
                             hashlib.sha256(kept).hexdigest()) + ((kept,) if with_bytes else ()))
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])
            out["id"] = out["id"].astype("Int64")
            yield out

    marked = texts.withColumn("maybe", maybe("th"))
    none = F.lit(0).cast("long")
    whole = marked.where(~F.col("maybe")).select(
        "id", F.col("n").alias("n_bytes"), none.alias("n_removed"), none.alias("n_spans"),
        F.sha2("text", 256).alias("kept_sha256"),
        *([F.col("text").cast("binary").alias("kept")] if with_bytes else []))
    cut = look_up(marked.where("maybe").select("id", "text", "th", "n"), spans, ["th", "n"],
                  F.col("id")).select("id", "text", "starts").mapInPandas(run, schema)
    return whole.unionByName(cut).withColumnRenamed("id", id_col)
