"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages (512-byte windows over the whole text), labelled
as a whole. Every passage is described by shares of character classes and word
statistics and encoded by one hidden layer; gated attention learned from the
document labels weighs the passages, and the weighted sum of their codes is the
document's representation, which a logistic unit scores:

    h_k = tanh(W x_k + b)
    a_k = softmax_k( u . (tanh(V h_k) * sigmoid(G h_k)) )
    score = sigmoid( c . sum_k a_k h_k + d )

Spark describes and scores the passages; the model (some thousand numbers) is
fitted by Adam on a hash sample of at most ``max_train`` labelled documents and
broadcast. Labels, language, source and id are never read by a score.

Defined cases: a null or empty text is one passage without characters; a text of
any length is read whole, its passages in blocks, with a running softmax;
repeated rows score alike; labels that are null are left out; without rows of
both labels every score is the share of label 1 (one half without labels); an
empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc32_mod, written

PASSAGE = 512   # bytes
BLOCK = 4096    # passages encoded at once
HIDDEN, GATE = 24, 12
N_CLASSES = 20
N_FEATURES = N_CLASSES + 6


def _byte_classes() -> np.ndarray:
    """The class of each byte: letters by case, digits, white space, each kind of
    mark that junk is made of, other marks, and bytes of non-ASCII characters."""
    classes = np.full(256, 19)
    classes[:128] = 18
    for k, members in enumerate((range(97, 123), range(65, 91), range(48, 58), b" ", b"\n",
                                 b"\t\r\x0b\x0c", b".", b",", b"!", b"?", b"|", b"#*", b"$%",
                                 b"&", b"<>{}[]", b"=_/\\", b"@+-", b"\"'():;")):
        classes[list(members)] = k
    return classes


BYTE_CLASS = _byte_classes()


def describe(text: str) -> np.ndarray:
    """The features of every passage of a text, one row each."""
    data = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    n = max(1, -(-len(data) // PASSAGE))
    at = np.arange(len(data)) // PASSAGE
    counts = np.bincount(at * N_CLASSES + BYTE_CLASS[data], minlength=n * N_CLASSES)
    counts = counts.reshape(n, N_CLASSES).astype(np.float32)
    out = np.zeros((n, N_FEATURES), dtype=np.float32)
    total = np.maximum(counts.sum(1, keepdims=True), 1)
    out[:, :N_CLASSES] = np.sqrt(counts / total)
    raw = data.tobytes()
    for k in range(n):
        words = raw[k * PASSAGE:(k + 1) * PASSAGE].split()
        if words:
            m, kinds = len(words), set(words)
            out[k, N_CLASSES:] = (
                m / 100, len(kinds) / m, sum(map(eq, words, words[1:])) / m,
                sum(map(len, kinds)) / len(kinds) / 10, max(map(len, words)) / 100,
                sum(w.isupper() for w in kinds) / len(kinds))
    return out


@dataclass
class Model:
    weights: dict[str, np.ndarray] | None
    mean: np.ndarray
    scale: np.ndarray
    base: float

    def score(self, text: str) -> float:
        return self.base if self.weights is None else self.score_passages(describe(text))

    def score_passages(self, passages: np.ndarray) -> float:
        w, top, mass, code = self.weights, -np.inf, 0.0, np.zeros(HIDDEN)
        for start in range(0, len(passages), BLOCK):  # softmax kept up block by block
            x = (passages[start:start + BLOCK] - self.mean) / self.scale
            h = np.tanh(x @ w["W"] + w["b"])
            z = (np.tanh(h @ w["V"]) * _sigmoid(h @ w["G"])) @ w["u"]
            new = max(top, float(z.max()))
            e, keep = np.exp(z - new), np.exp(top - new)
            mass, code, top = mass * keep + e.sum(), code * keep + e @ h, new
        return float(_sigmoid(code / mass @ w["c"] + w["d"][0]))


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(bags: list[np.ndarray], y: np.ndarray, epochs: int = 60, batch: int = 128,
        rate: float = 0.01, decay: float = 1e-4, seed: int = 3) -> Model:
    """Adam on the mean log loss of the documents, with gradients by hand."""
    rng = np.random.default_rng(seed)
    every = np.concatenate(bags)
    mean, scale = every.mean(0), every.std(0) + 1e-3
    w = {"W": rng.normal(0, 0.3, (N_FEATURES, HIDDEN)), "b": np.zeros(HIDDEN),
         "V": rng.normal(0, 0.3, (HIDDEN, GATE)), "G": rng.normal(0, 0.3, (HIDDEN, GATE)),
         "u": rng.normal(0, 0.3, GATE), "c": rng.normal(0, 0.3, HIDDEN), "d": np.zeros(1)}
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    bags, step = [(b - mean) / scale for b in bags], 0
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for start in range(0, len(order), batch):
            own = order[start:start + batch]
            x = np.concatenate([bags[i] for i in own])
            ends = np.cumsum([len(bags[i]) for i in own])
            begins = np.concatenate([[0], ends[:-1]])
            doc = np.repeat(np.arange(len(own)), ends - begins)
            h = np.tanh(x @ w["W"] + w["b"])
            t, g = np.tanh(h @ w["V"]), _sigmoid(h @ w["G"])
            z = (t * g) @ w["u"]
            e = np.exp(z - np.maximum.reduceat(z, begins)[doc])
            a = e / np.add.reduceat(e, begins)[doc]
            code = np.add.reduceat(a[:, None] * h, begins)
            p = _sigmoid(code @ w["c"] + w["d"][0])
            out = (p - y[own]) / len(own)
            d_code = out[:, None] * w["c"]
            d_a = (h * d_code[doc]).sum(1)
            d_z = a * (d_a - np.add.reduceat(a * d_a, begins)[doc])
            d_t = d_z[:, None] * w["u"] * g * (1 - t * t)
            d_g = d_z[:, None] * w["u"] * t * g * (1 - g)
            d_h = a[:, None] * d_code[doc] + d_t @ w["V"].T + d_g @ w["G"].T
            d_pre = d_h * (1 - h * h)
            grad = {"W": x.T @ d_pre, "b": d_pre.sum(0), "V": h.T @ d_t, "G": h.T @ d_g,
                    "u": d_z @ (t * g), "c": code.T @ out, "d": np.array([out.sum()])}
            step += 1
            for k in w:
                grad[k] = grad[k] + decay * w[k]
                first[k] = 0.9 * first[k] + 0.1 * grad[k]
                second[k] = 0.999 * second[k] + 0.001 * grad[k] ** 2
                w[k] = w[k] - rate * (first[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    return Model(w, mean, scale, float(y.mean()))


def train(docs: DataFrame, labels: DataFrame, usable: Column | None = None,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          max_train: int = 4_000, max_bytes: int = 256 << 10, **options) -> Model:
    """Learn a model from the labelled rows for which ``usable`` (over the id) holds.

    The driver fits at most some ``max_train`` bags of at most ``max_bytes`` of text:
    rows of a repeated id count once per text, a hash thins out what is too many, and
    longer labelled texts are scored like all others but not learnt from."""
    own = labels.select(labels[id_col].alias("id"), labels[label_col].alias("label")).where(
        F.col("label").isin(0, 1) & (usable if usable is not None else F.lit(True))).distinct()
    n = own.count()
    if n > max_train:  # a hash sample, alike on every run
        own = own.where(F.pmod(F.xxhash64("id", F.lit(2)), F.lit(1 << 20))
                        < int((1 << 20) * max_train / n))
    texts = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit(""))
                        .alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "label": b["label"],
                                "x": [describe(t).ravel() for t in b["text"]]})

    # at most max_train ids, up to the spread of the hash; their rows are counted too
    short = texts.where(F.octet_length("text") <= max_bytes).withColumn("th", F.xxhash64("id", "text"))
    found = written(short.join(F.broadcast(own), "id").dropDuplicates(["id", "th", "label"]), "quality-rows")
    m = found.count()
    if m > 2 * max_train:
        found = found.where(F.pmod("th", F.lit(1 << 20)) < int((1 << 20) * max_train / m))
    rows = written(found.select("id", "text", "label").mapInPandas(
        run, "id long, label int, x array<float>"), "quality-train").toPandas()
    rows = rows.sort_values(["id", "label"])
    if rows["label"].nunique() < 2:
        return Model(None, np.zeros(1), np.ones(1),
                     float(rows["label"].mean()) if len(rows) else 0.5)
    bags = [np.asarray(x, dtype=np.float64).reshape(-1, N_FEATURES) for x in rows["x"]]
    return fit(bags, rows["label"].to_numpy(dtype=float), **options)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = 0.7, held_out: Column | None = None) -> DataFrame:
    """id, ``held_out``, ``score``, ``predicted``, ``passages`` of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series([shared.value.score(t) for t in b], dtype="float64")

    text = F.coalesce(docs[text_col], F.lit(""))
    scored = docs.select(
        docs[id_col].alias("id"), run(text).alias("score"),
        F.greatest(F.lit(1), F.ceil(F.octet_length(text) / PASSAGE)).cast("int").alias("passages"))
    return scored.select(
        F.col("id").alias(id_col), (held_out if held_out is not None else F.lit(None)
                                    .cast("boolean")).alias("held_out"),
        "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "passages")


def trainable(id_col: Column, folds: int = 4, held: int = 2) -> Column:
    """Rows a model may learn from: crc32 of the id's text mod ``folds`` is not ``held``."""
    return F.coalesce(crc32_mod(id_col, folds) != held, F.lit(False))
