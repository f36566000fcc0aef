"""Best-fit-decreasing packing of token sequences.

Best-fit decreasing places items from the longest to the shortest, each into the
open bin with the least room that still takes it. Which bin of equal room, and
which item of equal length, changes nothing in the lengths packed, so the whole
corpus is planned from its histogram of lengths (at most ``capacity`` numbers):
a segment tree over remaining capacities finds the tightest open room in
logarithmic time, and a run of equal items goes into a run of equal bins in one
step. The plan is what document-by-document best fit decreasing would build, its
size depends on ``capacity`` only, and so it is broadcast.

Spark does the rest: tokenizing, and ranking the pieces of each length. A piece's
rank is its rank among the pieces of its length in its task (counted while
tokenizing) plus the pieces of that length in the tasks before (a window over the
per-task counts); rank and plan give sequence and place.

Defined cases: a null text is empty and has the end token only; repeated rows are
packed each; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import base64
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import written

CAPACITY = 1024
END_ID = 2
SPECIAL = "<|endoftext|>"
_ENCODERS: dict[str, object] = {}


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(path: str):
    """text -> ids of the byte-level BPE in a tokenizers file.

    The file's vocabulary is run by tiktoken, which gives the same ids several
    times faster; a text holding the special token's string is encoded as
    tokenizers does, with its id."""
    if path not in _ENCODERS:
        import json

        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        # byte-level vocabularies print each byte as a visible character
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        byte_of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items()
                 if token not in special}
        _ENCODERS[path] = tiktoken.Encoding(
            "file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
            special_tokens=special)
    enc = _ENCODERS[path]

    def encode(text: str) -> np.ndarray:
        if SPECIAL in text:
            return np.array(enc.encode(text, allowed_special="all"), dtype="<u4")
        return np.array(enc.encode_ordinary(text), dtype="<u4")

    return encode


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids; only the first may be shorter."""
    first = n % capacity or min(n, capacity)
    starts = [0, *range(first, n, capacity)]
    return [(s, e - s) for s, e in zip(starts, [*starts[1:], n])]


class RoomTree:
    """Segment tree over remaining capacities: which have open bins."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.any = np.zeros(2 * self.size, dtype=bool)

    def mark(self, room: int, open_bins: bool) -> None:
        i = room + self.size
        self.any[i] = open_bins
        while i > 1:
            i >>= 1
            self.any[i] = self.any[2 * i] or self.any[2 * i + 1]

    def tightest(self, need: int) -> int | None:
        """The least room >= ``need`` with an open bin."""
        i = need + self.size
        if self.any[i]:
            return need
        while i > 1:
            if not i & 1 and self.any[i + 1]:  # a left child whose sibling has one
                i += 1
                while i < self.size:
                    i = 2 * i if self.any[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return None


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Best-fit decreasing over a histogram of lengths.

    Rows: length, first rank, first sequence, items a sequence, room before. Ranks
    of a length are dealt in order: ``items a sequence`` to each sequence in turn."""
    tree, open_bins, moves, opened = RoomTree(capacity), defaultdict(list), [], 0

    def put(room: int, first: int, n: int) -> None:
        if n and room:
            open_bins[room].append((first, n))
            tree.mark(room, True)

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                room, per = capacity, capacity // length
                first, n = opened, -(-left // per)
                opened += n
            else:
                first, n = open_bins[room].pop()
                per = room // length
                if not open_bins[room]:
                    tree.mark(room, False)
            full = min(n, left // per)
            rest = min(left - full * per, per) if full < n else 0
            moves.append((length, rank, first, per, room))
            put(room - per * length, first, full)
            if rest:
                put(room - rest * length, first + full, 1)
            put(room if room < capacity else 0, first + full + bool(rest), n - full - bool(rest))
            rank += full * per + rest
            left -= full * per + rest
    return np.array(moves, dtype=np.int64).reshape(-1, 5)


def pieces(docs: DataFrame, id_col: str, text_col: str, path: str, capacity: int,
           end_id: int, with_ids: bool = False) -> DataFrame:
    """Tokenized pieces, each with its task and its rank among that task's pieces of
    the same length."""
    schema = ("id long, piece int, start long, length long, ids_crc32 long, chunk int, "
              "chunk_rank long" + (", ids array<int>" if with_ids else ""))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(path)
        chunk, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["id"], batch["text"]):
                ids = np.append(encode(text), np.array([end_id], dtype="<u4"))
                for k, (start, n) in enumerate(cut(len(ids), capacity)):
                    part = ids[start:start + n]
                    out.append((doc_id, k, start, n, zlib.crc32(part.tobytes()), chunk, seen[n])
                               + ((part.astype(np.int32),) if with_ids else ()))
                    seen[n] += 1
            frame = pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])
            frame["id"] = frame["id"].astype("Int64")
            yield frame

    text = F.coalesce(docs[text_col], F.lit(""))
    return docs.select(docs[id_col].alias("id"), text.alias("text")).mapInPandas(run, schema)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
         with_ids: bool = False) -> DataFrame:
    """One row per piece: id, ``piece``, ``start``, ``length``, ``ids_crc32``,
    ``sequence_id``, ``offset`` (and the piece's ``ids`` if asked for)."""
    cut_up = written(pieces(docs, id_col, text_col, tokenizer or tokenizer_path(), capacity,
                            end_id, with_ids), "pack-pieces")
    counts = written(cut_up.groupBy("chunk", "length").agg(F.count(F.lit(1)).alias("n")),
                     "pack-counts")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n"))
                 .collect()}  # at most ``capacity`` rows
    moves = cut_up.sparkSession.sparkContext.broadcast(plan(histogram, capacity))
    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = counts.select("chunk", "length",
                            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        length, rank, first, per, room = np.ascontiguousarray(moves.value.T)
        order = np.lexsort((rank, length))
        length, rank, first, per, room = (a[order] for a in (length, rank, first, per, room))
        key = (length << 48) | rank  # ranks stay below 2 ** 48
        for b in batches:
            n, r = b["length"].to_numpy(), b.pop("rank").to_numpy()
            at = np.searchsorted(key, (n << 48) | r, side="right") - 1
            nth = r - rank[at]
            b["sequence_id"] = first[at] + nth // per[at]
            b["offset"] = capacity - room[at] + (nth % per[at]) * n
            yield b

    ranked = cut_up.join(offsets, ["chunk", "length"]).select(
        F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32",
        *(["ids"] if with_ids else []), (F.col("ahead") + F.col("chunk_rank")).alias("rank"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank"]
    return ranked.mapInPandas(place, ", ".join([*fields, "sequence_id long", "offset long"]))
