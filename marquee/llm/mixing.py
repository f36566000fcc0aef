"""Mixing sources to target weights by entropy balancing.

Every document gets a rate; the rates minimise the entropy divergence (in words)
from taking each document once, subject to one word constraint per source. The
dual is convex with one multiplier a source, and its solution is an exponential
tilt: rate = exp(multiplier of the document's source). Each Newton iteration is
one aggregation over the documents (gradient and Hessian diagonal: the words the
present rates take), started at the multipliers 0.

Rates are then rounded into whole copies. A document of rate r is taken floor(r)
times, and once more if it is among the share r - floor(r) of its source's words
that a seeded hash selects: per source and size class (powers of two, the largest
first), hash bins are taken until the class's share is met as nearly as it can,
and what remains is carried into the next smaller class. So a source ends within
half a bin of its smallest class of its target, not within the luck of a draw.

Per source only counts are gathered: at most 64 classes x ``bins`` rows, combined
in the map tasks, so a hot source is never gathered in one task. A mix names a
weight for each source, so the table of sources is held by the driver; more than
``MAX_SOURCES`` is refused.

Defined cases: a null text has size 0 and nothing of it is taken; a null source
is a source of its own, last in the order; a source without words has target 0;
bins hash the id and the text, so null and repeated ids spread like others, and rows
equal in both share their fate; an empty table
gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import words, written

MAX_SOURCES = 100_000
WEIGHTS = (3.0, 1.0, 2.0)
BUDGET = 1.5
CAP = 2.0


def targets(sizes: Sequence[float], weights: Sequence[float], budget: float,
            cap: float) -> list[float]:
    """Share ``budget`` x all sizes by weight; a target stops at ``cap`` x its size
    and the excess is shared again until none is above."""
    out = [0.0] * len(sizes)
    free, rest = {i for i, s in enumerate(sizes) if s > 0}, budget * sum(sizes)
    while free:
        weight = sum(weights[i] for i in free)
        over = {i for i in free if rest * weights[i] / weight >= cap * sizes[i]}
        for i in over or free:
            out[i] = cap * sizes[i] if over else rest * weights[i] / weight
        rest -= sum(out[i] for i in over)
        free = free - over if over else set()
    return out


def newton(moments: Callable[[np.ndarray], np.ndarray], goal: np.ndarray,
           tolerance: float = 1e-9, limit: int = 50) -> np.ndarray:
    """Multipliers at which ``moments`` (words taken by source) meet ``goal``.

    The dual is a sum of convex functions of one multiplier each; its gradient is
    moments - goal and its Hessian diagonal the moments themselves."""
    at = np.where(goal > 0, 0.0, -np.inf)
    for _ in range(limit):
        now = moments(at)
        gap = now - goal
        if np.all(np.abs(gap) <= tolerance * np.maximum(goal, 1.0)):
            break
        live = (goal > 0) & (now > 0)
        step = np.where(live, gap / np.where(live, now, 1.0), 0.0)
        at = at - np.clip(step, -2.0, 2.0)
    return at


def _cuts(pdf: pd.DataFrame) -> pd.DataFrame:
    """For one source: the hash bins of each size class that get one copy more."""
    share, carry, out = float(pdf["share"].iloc[0]), 0.0, []
    for size_class in sorted(pdf["size_class"].unique(), reverse=True):
        own = pdf[pdf["size_class"] == size_class].sort_values("bin")
        reach = np.concatenate([[0.0], own["words"].cumsum().to_numpy(dtype=float)])
        want = share * reach[-1] + carry
        n = int(np.abs(reach - want).argmin())
        carry = want - reach[n]
        ends = own["bin"].to_numpy()
        out.append((pdf["src"].iloc[0], size_class, int(ends[n - 1]) + 1 if n else 0))
    return pd.DataFrame(out, columns=["src", "size_class", "bins_taken"])


def _measured(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int,
              bins: int, *extra) -> DataFrame:
    size = F.size(words(docs[text_col])).cast("long")
    rows = docs.select(docs[id_col].alias("id"), docs[source_col].alias("source"),
                       size.alias("size"),
                       # the text too: rows without an id, or of one id, do not fall together
                       F.xxhash64(F.lit(seed), docs[id_col], F.coalesce(docs[text_col], F.lit(""))).alias("place"),
                       *extra)
    size_class = F.when(F.col("size") > 0, F.floor(F.log2("size")).cast("int")).otherwise(-1)
    return rows.withColumns({
        "size_class": size_class,
        "bin": F.pmod("place", F.lit(bins)).cast("int")}).drop("place")


class Mix:
    """The solved mix: rates by source, and the bins that get one copy more."""

    def __init__(self, base: DataFrame, weights: Sequence[float], budget: float, cap: float):
        spark = base.sparkSession
        found = base.groupBy("source").agg(F.sum("size").alias("n")).limit(
            MAX_SOURCES + 1).collect()
        if len(found) > MAX_SOURCES:
            raise ValueError(f"more than {MAX_SOURCES} sources")
        found.sort(key=lambda r: (r.source is None, r.source or ""))
        sizes = [r.n for r in found]
        goal = np.array(targets(sizes, [weights[k % len(weights)] for k in range(len(found))],
                                budget, cap))

        def table(**columns) -> DataFrame:
            """One row a source: bounded by MAX_SOURCES, so it may be broadcast."""
            rows = [(r.source, k, *[float(c[k]) for c in columns.values()])
                    for k, r in enumerate(found)]
            schema = "of string, src int" + "".join(f", {c} double" for c in columns)
            return F.broadcast(spark.createDataFrame(rows, schema))

        def moments(at: np.ndarray) -> np.ndarray:
            t = table(at=at)
            # whole words are summed, so the result does not depend on the order of rows
            taken = base.join(t, base["source"].eqNullSafe(t["of"])).groupBy("src", "at").agg(
                (F.sum("size") * F.exp("at")).alias("words"))
            out = np.zeros(len(found))
            for r in taken.collect():
                out[r.src] = r.words
            return out

        at = newton(moments, goal) if found else np.zeros(0)
        rates = np.minimum(np.exp(at), cap)
        rates = np.where(np.abs(rates - np.round(rates)) < 1e-7, np.round(rates), rates)
        whole = np.floor(rates)
        self.spec = table(source_size=sizes, target=goal, rate=rates, whole=whole,
                          share=rates - whole)
        histogram = (self._with_source(base).where("size > 0")
                     .groupBy("src", "share", "size_class", "bin")
                     .agg(F.sum("size").alias("words")))
        # at most 64 classes a source: bounded like the sources
        self.cuts = F.broadcast(written(histogram.groupBy("src").applyInPandas(
            _cuts, "src int, size_class int, bins_taken int"), "mix-cuts"))

    def _with_source(self, rows: DataFrame) -> DataFrame:
        return rows.join(self.spec, rows["source"].eqNullSafe(self.spec["of"]))

    def copies(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the numbers of their source and ``copies``; no shuffle."""
        extra = F.when(F.col("bin") < F.col("bins_taken"), 1).otherwise(0)
        return self._with_source(rows).join(self.cuts, ["src", "size_class"], "left").withColumn(
            "copies", (F.col("whole") + extra).cast("int"))


def entropy_balance(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source", weights: Sequence[float] = WEIGHTS,
                    budget: float = BUDGET, cap: float = CAP, seed: int = 5,
                    bins: int = 1024) -> DataFrame:
    """One row per document: id, ``size``, ``source_size``, ``target``, ``taken``,
    ``copies``, ``rate``. Sources by code point, null last, weigh ``weights``
    repeated."""
    base = written(_measured(docs, id_col, text_col, source_col, seed, bins), "mix-sizes")
    return Mix(base, weights, budget, cap).copies(base).select(
        F.col("id").alias(id_col), "size", F.col("source_size").cast("long").alias("source_size"),
        "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"), "copies", "rate")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source", weights: Sequence[float] = WEIGHTS,
                    budget: float = BUDGET, cap: float = CAP, seed: int = 5,
                    bins: int = 1024) -> DataFrame:
    """The mix itself: every document as often as it is taken, all columns kept.

    Documents the mix takes no copy of are absent; a document without words weighs
    nothing and is kept once."""
    base = written(_measured(docs, id_col, text_col, source_col, seed, bins), "mix-sizes")
    record = F.struct(*[docs[c] for c in docs.columns]).alias("record")
    rows = _measured(docs, id_col, text_col, source_col, seed, bins, record)
    times = F.when(F.col("size") == 0, 1).otherwise(F.col("copies"))
    return (Mix(base, weights, budget, cap).copies(rows)
            .withColumn("copy", F.explode(F.when(times > 0, F.sequence(F.lit(1), times))))
            .select("record.*"))
