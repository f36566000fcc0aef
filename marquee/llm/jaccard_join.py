"""Near-duplicate join on word shingles by vertical partitioning.

Two documents link when the Jaccard similarity of their sets of 5-word shingles
is at least the threshold; the result is each document's connected component.

1. Order. All shingles have one global order: rare ones by hash, then those whose
   cell in a count sketch over all documents is overfull, by rising count. The sketch
   has a fixed size; the order only decides how much work is done.
2. Candidates. Two sets that link share a shingle among the first
   n - ceil(t n) + 1 of each (prefix filter). Documents with equal sets are one
   *class*; prefix shingles of a single class are dropped (exactly: a fixed-size
   Bloom filter first, then a join).
3. Stars. In every remaining shingle's list one central class is the leader; each
   class is tested against the leader it shares most with. Near copies of one text
   are thus connected by a row each, not by all pairs.
4. The rest. Pairs from different components that share a prefix shingle are all
   tested, save those which places, sizes or parity maps rule out: a pair that links
   has, from its first common shingle on, as many shingles left on both sides as the
   link needs; and the maps differ in at most as many bits as the sets differ in
   shingles (inside the join a small map, and one of a bit or two a shingle where a
   set is too large for it; then, for the pairs left, one as wide as the set asks for).
   No link between different components can be missed.
5. Testing, vertically: the global order is cut into ``FRAGMENTS``; each pair's
   overlap is counted fragment by fragment and summed. Only classes that some pair
   needs are cut up, and a hot leader's fragments are spread over salts.

Joins on a shingle are sort-merge joins of written tables, whose hot partitions
Spark's adaptive execution splits.

Shingles are 64-bit hashes; nothing else is approximate. Classes are told apart
by 64 bits of a hash of the whole set.

Defined cases: a text without words (null too) has the empty set and is linked
with nothing; fewer than five words make one shingle; rows repeated are one class;
a null id counts as no id (a component with null ids only has a null id, and its
first document is that with the least text hash); an empty table gives an empty
table; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.session import checked_broadcast

from .common import bloom_bitmap, components, in_bloom, look_up, release_memory, written

WORDS = 5
THRESHOLD = 75          # percent
FRAGMENTS = 8
MAPS = 8                # 64-bit words of the small parity map, one column each
WIDE = 16               # least number of 64-bit words of the wide one
MIDDLE = 64 * MAPS      # larger sets carry a map of a bit or two a shingle into the join
CELL_BITS = 22          # cells of the count sketch (8 MB of counts)
CHUNK_BITS = 15         # cells of one piece of it
TASKS_AT_ONCE = 256     # sketches added up in one group
SLICE = 500             # documents described at once
OVERFULL = 12           # a cell is overfull from mean + max(this, 4 deviations)
PAIRS_PER_SALT = 2_000

# odd multipliers, one for each place in a shingle
_PLACES = [np.uint64(2 * int(x) + 1) for x in
           np.random.default_rng(11).integers(1 << 61, 1 << 62, WORDS)]


def shingles(text: str) -> np.ndarray:
    """The sorted distinct 64-bit shingles of a text; A-Z are lower-cased."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if len(words) < WORDS:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words))][:len(words)], dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    n = len(h) - WORDS + 1
    x = np.zeros(n, dtype=np.uint64)
    for k in range(WORDS):
        x += h[k:k + n] * _PLACES[k]
    x ^= x >> np.uint64(29)
    x *= _PLACES[0]
    x ^= x >> np.uint64(32)
    return np.unique(x)


def prefix_length(n: int, threshold: int = THRESHOLD) -> int:
    return n + (-threshold * n) // 100 + 1 if n else 0


def cells(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(64 - CELL_BITS)).astype(np.int64)


class Order:
    """The global order, from the count sketch."""

    def __init__(self, counts: np.ndarray):
        mean = counts.mean()
        self.counts = np.minimum(counts, 0xFFFF).astype(np.uint16)
        self.limit = mean + max(OVERFULL, 4 * mean ** 0.5)

    def split(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rare and the frequent shingles of a set, in order."""
        n = self.counts[cells(s)]
        often = n >= self.limit
        return s[~often], s[often][np.argsort(n[often], kind="stable")]

    def prefix(self, s: np.ndarray, threshold: int) -> np.ndarray:
        return np.concatenate(self.split(s))[:prefix_length(len(s), threshold)]

    def fragments(self, s: np.ndarray) -> list[np.ndarray]:
        """The set cut along the order: rare ones by ranges of the hash, then the
        frequent ones."""
        rare, often = self.split(s)
        bounds = [np.uint64((k << 64) // (FRAGMENTS - 1)) for k in range(1, FRAGMENTS - 1)]
        return [*np.split(rare, np.searchsorted(rare, bounds)), often]


def _signed(a: np.ndarray) -> np.ndarray:
    return a.astype(np.uint64, copy=False).view(np.int64)


def _node(s: np.ndarray) -> int | None:
    import xxhash

    if not len(s):
        return None
    return int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).view(np.int64))


def _parity(s: np.ndarray, size: int) -> np.ndarray:
    """A map of ``size`` words: for each bit, whether the set holds an odd number of
    the shingles that belong to it."""
    bits = np.bincount((s >> np.uint64(7)) % np.uint64(64 * size), minlength=64 * size) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def _wide(n: int) -> int:
    """Words of the wide map of a set: at least four bits a shingle, a power of two."""
    return max(WIDE, 1 << max(0, (n - 1) >> 4).bit_length())


def _middle(s: np.ndarray) -> np.ndarray:
    """The map of a set that overfills the small one, of 1 to 2 bits a shingle; else none."""
    return _parity(s, 1 << ((len(s) - 1) >> 6).bit_length()) if len(s) > MIDDLE else _signed(s[:0])


def _slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The batches in pieces small enough that their shingles take little memory."""
    for b in batches:
        for start in range(0, len(b), SLICE):
            yield b.iloc[start:start + SLICE].reset_index(drop=True)


def _sketch(texts: DataFrame) -> Order:
    """Count the shingles of all documents by cell. Each task adds up one sketch; the
    tasks' sketches are added piece by piece, some at a time."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(1 << CELL_BITS, dtype=np.uint32)
        for b in batches:
            for text in b["text"]:
                np.add.at(total, cells(shingles(text)), 1)
        yield packed(total.reshape(-1, 1 << CHUNK_BITS), TaskContext.get().partitionId())
        del total
        release_memory()

    def packed(pieces: np.ndarray, task: int, first: int = 0) -> pd.DataFrame:
        return pd.DataFrame({"chunk": range(first, first + len(pieces)), "task": task,
                             "counts": [zlib.compress(p.tobytes(), 1) for p in pieces]})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(1 << CHUNK_BITS, dtype=np.uint32)
        for piece in pdf["counts"]:
            total += np.frombuffer(zlib.decompress(piece), dtype=np.uint32)
        return packed(total[None, :], pdf["task"].iloc[0] // TASKS_AT_ONCE, pdf["chunk"].iloc[0])

    schema = "chunk int, task int, counts binary"
    some = texts.select("text").mapInPandas(count, schema).groupBy(
        "chunk", F.floor(F.col("task") / TASKS_AT_ONCE)).applyInPandas(add, schema)
    counts = np.zeros((1 << (CELL_BITS - CHUNK_BITS), 1 << CHUNK_BITS), dtype=np.uint32)
    for r in some.groupBy("chunk").applyInPandas(add, schema).collect():  # of fixed size
        counts[r.chunk] = np.frombuffer(zlib.decompress(r.counts), dtype=np.uint32)
    return Order(counts.ravel())


def _with_ids(texts: DataFrame) -> DataFrame:
    """No nulls in ``id``, which pandas would turn into rounded floats; see ``_ids``."""
    return texts.withColumn("no_id", F.col("id").isNull()).withColumn(
        "id", F.coalesce(F.col("id").cast("long"), F.lit(0).cast("long")))


def _ids(b: pd.DataFrame) -> pd.Series:
    return pd.Series(pd.arrays.IntegerArray(b["id"].to_numpy(dtype=np.int64),
                                            b["no_id"].to_numpy(dtype=bool)))


class _Join:
    def __init__(self, docs: DataFrame, id_col: str, text_col: str, threshold: int):
        self.threshold = threshold
        self.texts = docs.select(docs[id_col].alias("id"),
                                 F.coalesce(docs[text_col], F.lit("")).alias("text"),
                                 _text_hash(docs[text_col]).alias("th"))
        self.sc = docs.sparkSession.sparkContext
        self.order = self.sc.broadcast(_sketch(self.texts))

    def describe(self) -> DataFrame:
        """id, n, node (the class), prefix and parity map of every document."""
        order, threshold = self.order, self.threshold

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in _slices(batches):
                sets = [shingles(t) for t in b["text"]]
                out = {"id": _ids(b), "th": b["th"], "n": [len(s) for s in sets],
                       "node": pd.array([_node(s) for s in sets], dtype="Int64"),
                       "prefix": [_signed(order.value.prefix(s, threshold)) for s in sets]}
                maps = np.array([_parity(s, MAPS) for s in sets], dtype=np.int64).reshape(-1, MAPS)
                out["wide"] = [_parity(s, _wide(len(s))) for s in sets]
                out["middle"] = [_middle(s) for s in sets]
                yield pd.DataFrame(out | {f"m{k}": maps[:, k] for k in range(MAPS)})
            release_memory()

        maps = ", ".join(f"m{k} long" for k in range(MAPS))
        return written(_with_ids(self.texts).mapInPandas(
            run, "id long, th long, n long, node long, prefix array<long>, wide array<long>, "
                 f"middle array<long>, {maps}"), "jaccard-sets")

    def shared_prefixes(self, sets: DataFrame) -> DataFrame:
        """(s, node, pos) of the prefix shingles that several classes have, with their
        place in the class's order."""
        many = written(sets.select(F.explode("prefix").alias("s"), "node").groupBy("s").agg(
            F.min("node").alias("least"), F.max("node").alias("most")).where("least <> most")
            .select("s"), "jaccard-shared")
        bitmap = bloom_bitmap(many, many.count())

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                lengths = b["prefix"].map(len).to_numpy()
                if lengths.sum():
                    s = np.concatenate(b["prefix"].to_list()).astype(np.int64)
                    keep = in_bloom(bitmap.value, s.view(np.uint64))
                    places = np.concatenate([np.arange(k, dtype=np.int32) for k in lengths])
                    yield pd.DataFrame({
                        "s": s[keep], "node": np.repeat(b["node"].to_numpy(), lengths)[keep],
                        "pos": places[keep]}).drop_duplicates()

        maybe = sets.where("n > 0").select("prefix", "node").mapInPandas(run, "s long, node long, pos int")
        # one exchange: the join's partitioning serves the distinct rows too
        return written(maybe.hint("merge").join(many, "s", "left_semi").distinct(), "jaccard-lists")

    def fits(self, a: str, b: str) -> Column:
        """Neither the sizes nor the small maps of rows ``a`` and ``b`` rule out a link."""
        t = self.threshold
        na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
        differ = sum((F.bit_count(F.col(f"{a}.m{k}").bitwiseXOR(F.col(f"{b}.m{k}")))
                      for k in range(MAPS)), F.lit(0))
        return ((100 * F.least(na, nb) >= t * F.greatest(na, nb))
                & ((100 + t) * differ <= (100 - t) * (na + nb)))

    def in_place(self, a: str, b: str) -> Column:
        """The common shingle of rows ``a`` and ``b`` may be the first that a link shares:
        from its places on, both sets still hold as many shingles as a link needs.
        A pair that links holds this at its first common shingle."""
        t = self.threshold
        left = F.least(F.col(f"{a}.n") - F.col(f"{a}.pos"), F.col(f"{b}.n") - F.col(f"{b}.pos"))
        return (100 + t) * left >= t * (F.col(f"{a}.n") + F.col(f"{b}.n"))

    def wide_fits(self, wa: str, wb: str, na: Column, nb: Column) -> Column:
        """The wide (or middle) maps do not rule out a link."""
        def halved(w: str, least: Column) -> Column:
            """Sets of like sizes have maps of one size, or of one size and its double,
            whose halves add up to the smaller map."""
            half = F.zip_with(F.slice(w, F.lit(1), least), F.slice(w, least + 1, least),
                              lambda a, b: a.bitwiseXOR(b))
            return F.when(F.size(w) > least, half).otherwise(F.col(w))

        least = F.least(F.size(wa), F.size(wb))
        differ = F.aggregate(
            F.zip_with(halved(wa, least), halved(wb, least),
                       lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda a, b: a + b)
        return (100 + self.threshold) * differ <= (100 - self.threshold) * (na + nb)

    def worth_testing(self, pairs: DataFrame, classes: DataFrame) -> DataFrame:
        """The pairs that neither sizes and small maps nor the wide maps rule out, with
        their sizes."""
        fact = F.struct("n", *[f"m{k}" for k in range(MAPS)])
        for side in ("x", "y"):
            pairs = pairs.hint("merge").join(
                classes.select(F.col("node").alias(side), fact.alias(f"f{side}")), side)
        pairs = pairs.where(self.fits("fx", "fy")).select(
            "x", "y", F.col("fx.n").alias("nx"), F.col("fy.n").alias("ny"))
        pairs = written(pairs, "jaccard-fitting")
        for side in ("x", "y"):
            pairs = pairs.hint("merge").join(
                classes.select(F.col("node").alias(side), F.col("wide").alias(f"w{side}")), side)

        return pairs.where(self.wide_fits("wx", "wy", F.col("nx"), F.col("ny"))).drop("wx", "wy")

    def fragments_of(self, wanted: DataFrame, held, cut_up, row_hash: Column) -> DataFrame:
        """(node, parts) of one document of each class that a pair needs: that with the
        least id and text hash. Where a row with both is repeated, the copies are reduced
        in the tasks and by one exchange, so a class has one row whatever repeats."""
        @F.pandas_udf("boolean")
        def maybe(h: pd.Series) -> pd.Series:
            return pd.Series(in_bloom(held.value, h.to_numpy().view(np.uint64)))

        parts = _with_ids(self.texts.where(maybe(row_hash)).select("id", "th", "text")).mapInPandas(
            cut_up, "id long, th long, node long, parts array<array<long>>")
        same = lambda a: ((a["node"] == wanted["node"]) & (a["th"] == wanted["th"])
                          & a["id"].eqNullSafe(wanted["id"]))
        own = parts.join(checked_broadcast(wanted), same(parts), "left_semi").select("node", "parts")
        rows = self.sets.select("id", "th", "node")
        repeated = rows.join(checked_broadcast(wanted), same(rows), "left_semi").groupBy("node").count().where("count > 1")
        return own.dropDuplicates(["node"]) if repeated.take(1) else own

    def linked(self, pairs: DataFrame, classes: DataFrame) -> DataFrame:
        """The pairs (x, y) of classes that link; y is the side that may be hot."""
        pairs = written(self.worth_testing(pairs, classes), "jaccard-worth")
        # a leader is sent once for each PAIRS_PER_SALT of its own pairs, most just once
        hot = pairs.groupBy("y").agg(F.ceil(F.count(F.lit(1)) / PAIRS_PER_SALT).alias("salts")).where("salts > 1")
        pairs = written(pairs.join(checked_broadcast(hot), "y", "left").select(
            "x", "y", "nx", "ny", F.pmod(F.xxhash64("x"), F.coalesce("salts", F.lit(1))).alias("salt")),
            "jaccard-salted")
        wanted = written(
            pairs.select(F.col("x").alias("node")).union(pairs.select(F.col("y").alias("node")))
            .distinct().join(classes.select("node", "first.id", "first.th"), "node"), "jaccard-wanted")
        row_hash = F.xxhash64(F.coalesce(F.col("id"), F.lit(-1)), F.col("th"))
        held = bloom_bitmap(wanted.select(row_hash), wanted.count())
        order = self.order

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in _slices(batches):
                sets = [shingles(t) for t in b["text"]]
                yield pd.DataFrame({
                    "id": _ids(b), "th": b["th"], "node": pd.array([_node(s) for s in sets], dtype="Int64"),
                    "parts": [[_signed(f) for f in order.value.fragments(s)] for s in sets]})
            release_memory()

        parts = self.fragments_of(wanted, held, run, row_hash)
        cut = F.posexplode("parts").alias("fragment", "part")
        left = (parts.join(checked_broadcast(pairs), F.col("x") == F.col("node"))
                .select("x", "y", "nx", "ny", "salt", cut))
        leaders = checked_broadcast(pairs.select("y", "salt").distinct())
        right = (parts.join(leaders, F.col("y") == F.col("node")).select("y", "salt", cut)
                 .withColumnRenamed("part", "other"))
        overlap = (left.hint("merge").join(right, ["y", "salt", "fragment"])
                   .select("x", "y", "nx", "ny", "fragment",
                           F.size(F.array_intersect("part", "other")).alias("both"))
                   .groupBy("x", "y", "nx", "ny", "fragment").agg(F.max("both").alias("both"))
                   .groupBy("x", "y", "nx", "ny").agg(F.sum("both").alias("both")))
        return overlap.where(100 * F.col("both") >= self.threshold
                             * (F.col("nx") + F.col("ny") - F.col("both"))).select("x", "y")

    def stars(self, lists: DataFrame, classes: DataFrame) -> DataFrame:
        """For each class, the leader it shares most prefix shingles with, if sizes and
        maps allow a link."""
        frequency = written(lists.groupBy("s").agg(F.count(F.lit(1)).alias("f")),
                            "jaccard-frequency")
        weight = written(lists.hint("merge").join(frequency, "s").groupBy("node").agg(
            F.sum(F.col("f") - 1).alias("w")), "jaccard-weights")
        # by weight, then by node: a total order, so leaders never lead in a circle
        leaders = written(lists.hint("merge").join(weight, "node").groupBy("s").agg(
            F.max(F.struct("w", "node"))["node"].alias("leader")), "jaccard-leaders")
        shared = (lists.hint("merge").join(leaders, "s").where("node <> leader")
                  .groupBy("node", "leader").agg(F.count(F.lit(1)).alias("c")))
        fact = F.struct("n", *[f"m{k}" for k in range(MAPS)])
        a = shared.hint("merge").join(classes.select("node", fact.alias("a")), "node")
        b = a.hint("merge").join(classes.select(F.col("node").alias("leader"), fact.alias("b")),
                                 "leader")
        best = b.where(self.fits("a", "b")).groupBy("node").agg(F.max_by("leader", "c").alias("y"))
        return written(best.select(F.col("node").alias("x"), "y"), "jaccard-stars")

    def across(self, lists: DataFrame, classes: DataFrame, labels: DataFrame,
               tested: DataFrame) -> DataFrame:
        """All pairs from different components that share a prefix shingle and may link."""
        own = written(lists.hint("merge").join(labels, "node", "left").select(
            "s", "node", "pos", F.coalesce("comp", "node").alias("comp")), "jaccard-comps")
        # of each list, the rows outside its largest component meet all others
        sizes = own.groupBy("s", "comp").agg(F.count(F.lit(1)).alias("c"))
        mixed = written(sizes.groupBy("s").agg(F.max_by("comp", "c").alias("main"),
                                               F.count(F.lit(1)).alias("k"))
                        .where("k > 1").drop("k"), "jaccard-mixed")
        facts = classes.drop("first", "wide")
        # a list of two is its own pair; longer ones are joined
        two = written(own.groupBy("s").agg(F.count(F.lit(1)).alias("k"), F.min("node").alias("x"),
                                           F.max("node").alias("y"), F.min("comp").alias("c"),
                                           F.max("comp").alias("d")).where("k = 2"), "jaccard-twos")
        mixed = written(mixed.hint("merge").join(two.select("s"), "s", "left_anti"), "jaccard-mixed")
        rows = written(own.hint("merge").join(mixed, "s").join(facts, "node"), "jaccard-open")
        a, b = rows.where("comp <> main").alias("a"), rows.alias("b")
        once = (F.col("b.comp") == F.col("b.main")) | (F.col("a.node") < F.col("b.node"))
        pairs = a.join(b.hint("merge"), (F.col("a.s") == F.col("b.s"))
                       & (F.col("a.comp") != F.col("b.comp")) & once & self.in_place("a", "b")
                       & self.fits("a", "b")
                       & ((F.size("a.middle") == 0) | (F.size("b.middle") == 0)
                          | self.wide_fits("a.middle", "b.middle", F.col("a.n"), F.col("b.n"))))
        pairs = pairs.select(F.col("a.node").alias("x"), F.col("b.node").alias("y")).union(
            two.where("c <> d").select("x", "y")).distinct()
        return written(pairs.join(tested, ["x", "y"], "left_anti"), "jaccard-pairs")


def _roots(parents: DataFrame) -> DataFrame:
    """(node, comp): where each node's chain of parents (x, y) ends, by pointer jumping.

    A leader outranks all it leads, so chains have no cycle; round r covers chains of
    2 ** r, and a leader's hot partition is split like any skewed join's."""
    state = written(parents, "jaccard-parents")
    while True:
        above = state.select(F.col("x").alias("y"), F.col("y").alias("far"))
        state = written(state.hint("merge").join(above, "y", "left").select(
            "x", F.coalesce("far", "y").alias("y"), F.col("far").isNotNull().alias("moved")),
            "jaccard-parents")
        if not state.where("moved").take(1):
            break
        state = state.drop("moved")
    return state.select(F.col("x").alias("node"), F.col("y").alias("comp")).union(
        state.select(F.col("y").alias("node"), F.col("y").alias("comp")).distinct())


def _text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    threshold: int = THRESHOLD) -> DataFrame:
    """One row per document: id, ``n_shingles``, ``component_id`` (the smallest id
    reachable by links), ``first`` (it is the document with that id, or, if no document
    of the component has an id, that with the least text hash) and ``text_hash``."""
    join = _Join(docs, id_col, text_col, threshold)
    sets = join.sets = join.describe()
    maps = [f"m{k}" for k in range(MAPS)]
    lists = join.shared_prefixes(sets)
    # documents in order: by id, those without one last, by text hash
    rank = F.struct(F.col("id").isNull().alias("no_id"), "id", "th")
    touched = lists.select("node").distinct()
    classes = written(
        sets.where("n > 0").select("id", "th", "node", "n", *maps, "wide", "middle")
        .join(touched, "node", "left_semi").groupBy("node", "n", *maps)
        .agg(F.min(rank).alias("first"), F.first("wide").alias("wide"), F.first("middle").alias("middle")),
        "jaccard-classes")

    stars = join.stars(lists, classes)
    labels = written(_roots(join.linked(stars, classes)), "jaccard-star-comps")
    rest = join.across(lists, classes, labels, stars)
    links = written(join.linked(rest, classes), "jaccard-more-links")
    # links between components, as edges of a small graph of components
    for side in ("x", "y"):
        links = links.join(labels.select(F.col("node").alias(side), F.col("comp").alias(f"c{side}")),
                           side, "left").withColumn(side, F.coalesce(f"c{side}", side))
    merged = components(links.select("x", "y"), "jaccard-comps")
    singles = merged.join(labels, "node", "left_anti")
    united = labels.join(merged.select(F.col("node").alias("comp"), F.col("comp").alias("to")),
                         "comp", "left").select("node", F.coalesce("to", "comp").alias("comp"))
    labels = written(united.union(singles), "jaccard-labels")

    # the first document of each class, then of each component of classes
    named = written(
        sets.where("n > 0").groupBy("node").agg(F.min(rank).alias("first"))
        .join(labels, "node", "left").select("node", "first", F.coalesce("comp", "node")
                                             .alias("comp")), "jaccard-named")
    of_comp = written(named.groupBy("comp").agg(F.min("first").alias("best")), "jaccard-firsts")
    of_class = written(look_up(named, of_comp, ["comp"], F.col("node")).select("node", "best"),
                       "jaccard-class-firsts")
    out = look_up(sets.select("id", "th", "n", "node"), of_class, ["node"], F.col("id"))
    alone = F.col("n") == 0
    return out.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(alone, F.col("id")).otherwise(F.col("best.id")).alias("component_id"),
        (alone | rank.eqNullSafe(F.col("best"))).alias("first"),
        F.col("th").alias("text_hash"))


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    threshold: int = THRESHOLD) -> DataFrame:
    """The documents that stay when one document of each component -- that with the
    smallest id, or one of those without -- is kept, with all their columns; documents
    without words stay.
    Rows repeated with one id and text come back once."""
    stay = near_duplicates(docs, id_col, text_col, threshold).where("first").select(
        F.xxhash64(id_col).alias("key"), F.col("text_hash").alias("th")).distinct()
    own = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("record"),
                      F.xxhash64(docs[id_col]).alias("key"), _text_hash(docs[text_col]).alias("th"))
    # the join's partitioning serves the last step: texts are shuffled once
    return own.join(stay, ["key", "th"]).dropDuplicates(["key", "th"]).select("record.*")
