"""Ranked lexical search: best-first document intervals over range-maximum tables.

Every document is matched with every query. The documents of a task are cut into blocks;
a block holds, for the terms that some query has, one posting list a term (documents in
ascending order, each with its impact: what one occurrence of the term in a query adds to
the document's score) and over the lists a sparse table of range maxima, so the largest
impact of a list inside any interval of documents takes two look-ups.

A query starts with the interval of the whole block. An interval's bound is the sum, over
the query's terms, of the range maxima inside it: no document there scores more. The
intervals with the highest bounds are taken first (``width`` of them a step, as numpy works
on rows); each is split at its maximum-impact document, which is scored exactly, and the
two sides come back with bounds of their own. An interval goes when its bound is zero or
below the query's k-th best score so far; equal bounds stay, since ties go by document. The
best ``k`` of a task's blocks carry over from block to block, so later blocks are pruned by
what earlier ones held, and a task sends at most ``k`` rows a query.

Two passes: the first turns every whole text into its number of terms and its counts of
query terms (one scan, written as rows of small integers), from which the number of
documents, their terms and each term's document count are added up; the second scores.
Queries are taken from their table in blocks of at most ``QUERY_TERMS`` distinct (query,
term) pairs, or one query if that has more, so what a pass broadcasts is bounded however
many queries there are.

Defined cases: a null text has no term; documents without a term count nowhere; a query
without a term, or whose terms are in no document, has no result; repeated documents and
repeated queries are rows each; among equal scores a null document id comes last, among
equal ids either row may be the first; empty tables give an empty table; other columns are
ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import written

QUERY_TERMS = 1 << 18       # (query, term) pairs searched in one pass
BLOCK_DOCS = 1 << 14        # documents, and
BLOCK_POSTINGS = 1 << 20    # postings, a block closes at
WIDTH = 64                  # intervals split a step

# A-Z become a-z; ASCII that is neither letter nor digit ends a term; all else stays.
_FOLD = bytes((c + 32 if 65 <= c <= 90 else c) if chr(c).isalnum() or c > 127 else 32
              for c in range(128)) + bytes(range(128, 256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a text's UTF-8 bytes."""
    return text.translate(_FOLD).split()


def _data(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).cast("binary")


def query_blocks(queries: DataFrame, id_col: str, text_col: str,
                 limit: int = QUERY_TERMS) -> Iterator[list[tuple[object, Counter]]]:
    """The queries with their counts of terms, in blocks of bounded size."""
    block, size = [], 0
    for r in queries.select(F.col(id_col).alias("id"), _data(queries[text_col]).alias("text")).toLocalIterator():
        counts = Counter(terms(bytes(r.text)))
        if block and size + len(counts) > limit:
            yield block
            block, size = [], 0
        block.append((r.id, counts))
        size += len(counts)
    if block:
        yield block


def counted(docs: DataFrame, id_col: str, text_col: str, vocabulary: dict[bytes, int]) -> DataFrame:
    """Per document its ``id``, number of terms ``n``, and the query terms it holds
    (``term`` numbers, ascending, and ``tf``). Documents without a term are left out."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("n", T.LongType()),
                           T.StructField("term", T.ArrayType(T.IntegerType())),
                           T.StructField("tf", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            rows, n, found, times = [], [], [], []
            for i, text in enumerate(batch.column("text")):
                words = terms(text.as_py())
                if words:
                    counts = Counter(words)
                    hits = sorted((known[t], counts[t]) for t in counts.keys() & known.keys())
                    rows.append(i)
                    n.append(len(words))
                    found.append([t for t, _ in hits])
                    times.append([c for _, c in hits])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(rows, pa.int64())), pa.array(n, pa.int64()),
                 pa.array(found, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int32()))],
                names=["id", "n", "term", "tf"])

    return docs.select(docs[id_col].alias("id"), _data(docs[text_col]).alias("text")).mapInArrow(run, schema)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Block:
    """Posting lists of some documents, with range-maximum sparse tables over them."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, n_docs: int, n_terms: int):
        order = np.lexsort((doc, term))
        self.n_docs = n_docs
        self.key = term[order].astype(np.int64) * n_docs + doc[order]  # ascending
        self.doc, self.impact = doc[order].astype(np.int64), impact[order]
        self.start = np.searchsorted(term[order], np.arange(n_terms + 1))
        # tables[j][i]: where the largest impact of the 2 ** j postings from i on stands.
        # Lists lie one after another; a query's range never leaves its own list.
        longest = int(np.diff(self.start).max(initial=0))
        level = np.arange(len(doc), dtype=np.int32)
        self.tables = [level]
        while 2 << (len(self.tables) - 1) <= longest:
            half = 1 << (len(self.tables) - 1)
            left, right = level, np.concatenate([level[half:], level[-1:].repeat(min(half, len(level)))])
            level = np.where(self.impact[left] >= self.impact[right], left, right)
            self.tables.append(level)
        self.tables = np.stack(self.tables)

    def range_max(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The largest impact of the postings a .. b - 1 (0 if there are none) and where."""
        some = b > a
        a, b = np.where(some, a, 0), np.where(some, b, 1)
        j = np.frexp((b - a).astype(np.float64))[1] - 1
        left, right = self.tables[j, a], self.tables[j, b - (1 << j)]
        at = np.where(self.impact[left] >= self.impact[right], left, right)
        return np.where(some, self.impact[at], 0), at

    def best(self, term: np.ndarray, times: np.ndarray, floor: int, k: int, width: int = WIDTH):
        """(documents, scores) that may be among the best ``k``: all of them are, that
        score at least the k-th best of the block and ``floor``."""
        a, b = self.start[term][None, :], self.start[term + 1][None, :]
        top, at = self.range_max(a, b)
        top, bound = top * times, (top * times).sum(axis=1)
        docs, scores = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        best = np.empty(0, np.int64)
        low = max(floor, 1)
        while len(bound):
            alive = bound >= low
            if not alive.all():
                a, b, top, at, bound = a[alive], b[alive], top[alive], at[alive], bound[alive]
            if len(bound) > width:
                first = np.zeros(len(bound), dtype=bool)
                first[np.argpartition(bound, -width)[-width:]] = True
            else:
                first = np.ones(len(bound), dtype=bool)
            if not first.any():
                break
            a1, b1 = a[first], b[first]
            strongest = top[first].argmax(axis=1)[:, None]
            doc = self.doc[np.take_along_axis(at[first], strongest, axis=1)]  # splits its interval
            want = term[None, :] * self.n_docs + doc
            mid = np.clip(np.searchsorted(self.key, want), a1, b1)
            hit = mid < b1
            hit[hit] = self.key[mid[hit]] == want[hit]
            score = (np.where(hit, self.impact[np.where(hit, mid, 0)], 0) * times).sum(axis=1)
            docs.append(doc[:, 0])
            scores.append(score)
            best = np.concatenate([best, score])
            if len(best) > k:
                best = np.partition(best, -k)[-k:]
            if len(best) == k:
                low = max(low, int(best.min()))
            left, right = np.concatenate([a1, mid + hit]), np.concatenate([mid, b1])
            new_top, new_at = self.range_max(left, right)
            new_top = new_top * times
            new_bound = new_top.sum(axis=1)
            rest, good = ~first, new_bound >= low
            a, b = np.concatenate([a[rest], left[good]]), np.concatenate([b[rest], right[good]])
            top, at = np.concatenate([top[rest], new_top[good]]), np.concatenate([at[rest], new_at[good]])
            bound = np.concatenate([bound[rest], new_bound[good]])
        docs, scores = np.concatenate(docs), np.concatenate(scores)
        fit = scores >= low
        return docs[fit], scores[fit]


def _order(ids: list) -> list[int]:
    """Positions of the ids in ascending order, nulls last."""
    return sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] if ids[i] is not None else 0))


def _searched(hits: DataFrame, block: list[tuple[object, Counter]], vocabulary: dict[bytes, int],
              weights: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """Each task's best ``k`` documents of every query: ``query`` (its number in the
    block), ``id``, ``score``."""
    asked = [(np.array([vocabulary[t] for t in counts if t in vocabulary], dtype=np.int64),
              np.array([c for t, c in counts.items() if t in vocabulary], dtype=np.int64))
             for _, counts in block]
    shared = hits.sparkSession.sparkContext.broadcast((asked, weights))
    id_type = hits.schema["id"].dataType
    schema = T.StructType([T.StructField("query", T.IntegerType()), T.StructField("id", id_type),
                           T.StructField("score", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weights = shared.value
        best: list[list[tuple]] = [[] for _ in asked]

        def search(ids: list, n: np.ndarray, sizes: np.ndarray, term: np.ndarray, tf: np.ndarray) -> None:
            if not len(term):
                return
            order = _order(ids)
            place = np.empty(len(ids), dtype=np.int64)
            place[order] = np.arange(len(ids))
            m = 75 + (25 * n * n_docs) // n_terms
            of = np.repeat(np.arange(len(ids)), sizes)
            impact = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[of]))
            postings = Block(term, place[of], impact, len(ids), len(weights))
            for q, (terms_, times) in enumerate(asked):
                if not len(terms_):
                    continue
                floor = best[q][-1][0] if len(best[q]) == k else 0
                found, scores = postings.best(terms_, times, floor, k)
                new = best[q] + [(int(s), ids[order[d]]) for d, s in zip(found, scores)]
                new.sort(key=lambda r: (-r[0], r[1] is None, r[1] if r[1] is not None else 0))
                best[q] = new[:k]

        held, n_held, n_postings = [], 0, 0

        def flush() -> None:
            if held:
                search([i for b in held for i in b[0]], *(np.concatenate([b[c] for b in held]) for c in range(1, 5)))

        for batch in batches:
            term, tf = batch.column("term"), batch.column("tf")
            held.append((batch.column("id").to_pylist(), batch.column("n").to_numpy(),
                         np.diff(term.offsets.to_numpy()), term.flatten().to_numpy(),
                         tf.flatten().to_numpy().astype(np.int64)))
            n_held, n_postings = n_held + len(term), n_postings + len(held[-1][3])
            if n_held >= BLOCK_DOCS or n_postings >= BLOCK_POSTINGS:
                flush()
                held, n_held, n_postings = [], 0, 0
        flush()
        rows = [(q, i, s) for q, found in enumerate(best) for s, i in found]
        if rows:
            q, ids, scores = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(q, pa.int32()), pa.array(ids, _arrow(id_type)), pa.array(scores, pa.int64())],
                names=["query", "id", "score"])

    return hits.mapInArrow(run, schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def search(docs: DataFrame, queries: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           query_id_col: str = "item_id", query_text_col: str = "text", k: int = 20,
           query_terms: int = QUERY_TERMS) -> DataFrame:
    """The ``k`` best documents of every query: its id, ``rank`` (from 1), the document's
    id and ``score``. Scores are integers; see the operator's contract for the formula."""
    spark = docs.sparkSession
    kinds = T.StructType([T.StructField("query", T.IntegerType()), queries.schema[query_id_col]])
    out = None
    for block in query_blocks(queries, query_id_col, query_text_col, query_terms):
        vocabulary = {t: i for i, t in enumerate(sorted(set().union(*(c for _, c in block))))}
        hits = written(counted(docs, id_col, text_col, vocabulary), "search-counts")
        n_docs, n_terms = hits.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n_docs:
            break
        weights = np.zeros(len(vocabulary), dtype=np.int64)
        # at most one row a term of the block
        for r in hits.select(F.explode("term").alias("term")).groupBy("term").count().collect():
            weights[r.term] = weight(n_docs, r["count"])
        found = _searched(hits, block, vocabulary, weights, n_docs, n_terms, k)
        place = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
        ranked = found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(block)], kinds)
        part = written(ranked.join(F.broadcast(names), "query").select(
            F.col(query_id_col).alias("query_id"), "rank", "id", "score"), "search-results")
        out = part if out is None else out.unionAll(part)
    if out is None:
        out = spark.createDataFrame([], T.StructType([
            T.StructField("query_id", queries.schema[query_id_col].dataType), T.StructField("rank", T.IntegerType()),
            T.StructField("id", docs.schema[id_col].dataType), T.StructField("score", T.LongType())]))
    return out.select(F.col("query_id").alias(query_id_col), "rank", F.col("id").alias(id_col), "score")


__all__ = ["Block", "search", "terms"]
