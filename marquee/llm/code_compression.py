"""Vector code compression: product quantization whose nearest entries a GNAT finds.

Vectors become integers, floor(scale * x), and are cut into equal consecutive parts. A
codebook per part starts as that part of the rows with the smallest ids and is refined by
rounds of assigning every part to its nearest entry (squared Euclidean distance, ties to
the lower index) and moving each entry to the floor of its parts' mean.

The nearest entry comes from a geometric near-neighbour access tree over the entries. A
node's split points, chosen farthest first, own the entries nearest to them, and the node
stores for each pair of a split point and a child the least and greatest distance from the
one to the other's entries. A query measures its distances to the split points, looks into
the nearest one's child, and drops every other child whose stored range lies strictly
outside the query's distance plus or minus the best distance so far. Distances compared
with ranges are rounded away from elimination; the best entry itself is decided on exact
integer squared distances, lower indexes first, so a tie is never lost to rounding.

Spark does the rest: a pass maps the rows to per-task sums (at most ``parts * entries``
rows a task), adds them by entry, and the driver holds the codebooks only: ``parts *
entries * part length`` numbers whatever the table holds.

Defined cases: rows whose vector is null or holds null or non-finite components are left
out, and so are those of another length than the row with the smallest id (they cannot be
cut alike); fewer rows than ``entries`` give smaller codebooks; null ids come after all
others; repeated rows are rows each; null labels are one label; a component of 2 ** 26 or
more after scaling would overflow the 64-bit sums and raises; an empty table, or one
without a kept row, gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import look_up, written

ROUNDED = 1e-12  # more than double arithmetic can be off by, relative to the value
LARGEST = 1 << 26


class Gnat:
    """Exact nearest entries of a small codebook (integers, one entry a row)."""

    def __init__(self, entries: np.ndarray, degree: int = 6, leaf: int = 64):
        self.entries = np.asarray(entries, dtype=np.int64)
        self.largest = int(np.abs(self.entries).max(initial=0))
        self.degree, self.leaf = degree, leaf
        self.root = self._node(np.arange(len(self.entries)))
        self.measured = 0  # distances computed so far

    def _node(self, ids: np.ndarray):
        """(split ids, children, least, greatest), or the ids alone of a leaf."""
        if len(ids) <= self.leaf:
            return ids
        points, chosen = self.entries[ids], [0]
        nearest = self._squares(points, points[:1])[:, 0]
        while len(chosen) < self.degree and nearest.max() > 0:
            chosen.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, self._squares(points, points[chosen[-1:]])[:, 0])
        if len(chosen) == 1:
            return ids  # equal entries cannot be told apart
        chosen = np.sort(chosen)
        apart = self._squares(points, points[chosen])
        owner = apart.argmin(axis=1)
        owner[chosen] = np.arange(len(chosen))
        apart = np.sqrt(apart.astype(np.float64))
        least = np.stack([apart[owner == j].min(axis=0) for j in range(len(chosen))], axis=1)
        greatest = np.stack([apart[owner == j].max(axis=0) for j in range(len(chosen))], axis=1)
        inner = np.ones(len(ids), dtype=bool)
        inner[chosen] = False
        children = [self._node(ids[inner & (owner == j)]) if (inner & (owner == j)).any() else None
                    for j in range(len(chosen))]
        return ids[chosen], children, least * (1 - ROUNDED), greatest * (1 + ROUNDED)

    @staticmethod
    def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Exact squared distances: in doubles as long as every sum fits them."""
        top = max(float(np.abs(a).max(initial=0)), float(np.abs(b).max(initial=0)))
        if 4 * a.shape[1] * top * top < 2.0 ** 53:
            a, b = a.astype(np.float64, copy=False), b.astype(np.float64, copy=False)
        else:
            a, b = a.astype(np.int64), b.astype(np.int64)
        return (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of every query's nearest entry."""
        n = len(queries)
        exact = 4 * queries.shape[1] * max(float(np.abs(queries).max(initial=0)), self.largest) ** 2
        kind = np.float64 if exact < 2.0 ** 53 else np.int64
        queries = queries.astype(kind)
        entries = self.entries.astype(kind)
        norms, own = (entries * entries).sum(axis=1), (queries * queries).sum(axis=1)
        best = np.full(n, np.inf if kind is np.float64 else np.iinfo(np.int64).max, dtype=kind)
        index = np.full(n, len(entries), dtype=np.int64)

        def look(rows: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Distances of rows to entries, the best of them kept."""
            d = own[rows, None] + norms[ids] - 2 * (queries[rows] @ entries[ids].T)
            self.measured += d.size
            first = d.argmin(axis=1)  # ids ascend: the lower index wins a tie
            least, which = d[np.arange(len(rows)), first], ids[first]
            old = best[rows]
            better = (least < old) | ((least == old) & (which < index[rows]))
            best[rows[better]], index[rows[better]] = least[better], which[better]
            return d, first

        def visit(node, rows: np.ndarray) -> None:
            if not isinstance(node, tuple):
                look(rows, node)
                return
            splits, children, least, greatest = node
            d, first = look(rows, splits)
            for j, child in enumerate(children):
                if child is not None and (first == j).any():
                    visit(child, rows[first == j])
            far = np.sqrt(d.astype(np.float64))
            low, high = far * (1 - ROUNDED), far * (1 + ROUNDED)
            for j, child in enumerate(children):
                if child is None:
                    continue
                reach = (np.sqrt(best[rows].astype(np.float64)) * (1 + ROUNDED))[:, None]
                out = ((low - reach > greatest[:, j]) | (high + reach < least[:, j])).any(axis=1)
                left = rows[(first != j) & ~out]
                if len(left):
                    visit(child, left)

        if n:
            visit(self.root, np.arange(n))
        return index, best.astype(np.int64)


def kept_vectors(table: DataFrame, id_col: str, vector_col: str, label_col: str,
                 scale: int) -> DataFrame:
    """``id``, ``label`` and the integer ``parts_`` of the rows that are kept."""
    v = table[vector_col]
    unfit = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return table.where(v.isNotNull() & ~F.coalesce(unfit, F.lit(True))).select(
        table[id_col].alias("id"), table[label_col].alias("label"),
        F.transform(v, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))).alias("ints"))


def _matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    column = batch.column("ints")
    out = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)
    if len(out) and np.abs(out).max() >= LARGEST:
        raise ValueError(f"a component of {LARGEST} or more after scaling")
    return out


def _assigned(x: np.ndarray, books: list[Gnat]) -> tuple[np.ndarray, np.ndarray]:
    """Codes (row, part) and summed squared distances."""
    width = x.shape[1] // len(books)
    found = [book.nearest(x[:, p * width:(p + 1) * width]) for p, book in enumerate(books)]
    return np.stack([f[0] for f in found], axis=1), sum(f[1] for f in found)


def _sums(vectors: DataFrame, codebooks: np.ndarray, dims: int):
    """One round: how many parts each entry got, and their sums."""
    parts, k, width = codebooks.shape
    shared = vectors.sparkSession.sparkContext.broadcast(codebooks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Gnat(b) for b in shared.value]
        n = np.zeros((parts, k), dtype=np.int64)
        total = np.zeros((parts, k, width), dtype=np.int64)
        for batch in batches:
            x = _matrix(batch, dims)
            codes, _ = _assigned(x, books)
            for p in range(parts):
                n[p] += np.bincount(codes[:, p], minlength=k)
                for i in range(width):
                    # exact: a batch's sum of components stays below 2 ** 53
                    total[p, :, i] += np.bincount(codes[:, p], weights=x[:, p * width + i],
                                                  minlength=k).astype(np.int64)
        part, entry = np.nonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(n[part, entry]),
             pa.array(list(total[part, entry]), pa.list_(pa.int64()))],
            names=["part", "entry", "n", "sums"])

    partial = vectors.select("ints").mapInArrow(run, "part int, entry int, n long, sums array<long>")
    rows = partial.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)]).collect()
    shared.unpersist()
    return rows  # at most parts * k of them


def train(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4) -> np.ndarray:
    """The codebooks, as integers [part, entry, position]."""
    first = vectors.orderBy(F.col("id").asc_nulls_last(), "ints").limit(entries).collect()
    dims = len(first[0].ints) if first else 0
    if dims % parts:
        raise ValueError(f"{dims} components cannot be cut into {parts} equal parts")
    start = np.array([r.ints for r in first if len(r.ints) == dims], dtype=np.int64)
    books = np.ascontiguousarray(start.reshape(len(start), parts, dims // parts).transpose(1, 0, 2))
    if dims == 0:
        return books
    alike = vectors.where(F.size("ints") == dims)
    for _ in range(rounds):
        for r in _sums(alike, books, dims):
            books[r.part, r.entry] = [r[f"s{i}"] // r.n for i in range(dims // parts)]
    return books


def encode(vectors: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """``id``, ``label``, ``code`` (two hex digits a part) and ``error`` of every vector."""
    dims = codebooks.shape[0] * codebooks.shape[2]
    shared = vectors.sparkSession.sparkContext.broadcast(codebooks)
    kinds = vectors.schema
    schema = T.StructType([kinds["id"], kinds["label"], T.StructField("code", T.StringType()),
                           T.StructField("error", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Gnat(b) for b in shared.value]
        for batch in batches:
            codes, error = _assigned(_matrix(batch, dims), books)
            digits = [row.tobytes().hex() for row in codes.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(digits, pa.string()), pa.array(error)],
                names=["id", "label", "code", "error"])

    return vectors.where(F.size("ints") == dims).mapInArrow(run, schema)


def codebooks_digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def compress(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
             label_col: str = "label", parts: int = 4, entries: int = 256, rounds: int = 4,
             scale: int = 1024) -> DataFrame:
    """id, ``code``, ``error``, ``label_error`` (summed over equal labels) and
    ``codebooks_sha256`` of every kept row."""
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    vectors = written(kept_vectors(table, id_col, vector_col, label_col, scale), "pq-vectors")
    books = train(vectors, parts, entries, rounds)
    if not books.size:
        coded = vectors.limit(0).select("id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    else:
        coded = written(encode(vectors, books), "pq-codes")
    # nulls are one label: a flag beside the value keeps them apart from any value
    coded = coded.select("id", "code", "error", F.col("label").isNull().alias("no_label"),
                         F.coalesce(F.col("label").cast("string"), F.lit("")).alias("label"))
    summed = coded.groupBy("no_label", "label").agg(F.sum("error").alias("label_error"))
    out = look_up(coded, summed, ["no_label", "label"], F.struct("id", "code"))
    return out.select(F.col("id").alias(id_col), "code", "error", "label_error",
                      F.lit(codebooks_digest(books)).alias("codebooks_sha256"))


__all__ = ["Gnat", "codebooks_digest", "compress", "encode", "kept_vectors", "train"]
