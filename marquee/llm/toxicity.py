"""Toxicity by a weighted finite-state pattern grammar.

A text is read clause by clause. Each word becomes a symbol (insult, verb of harm,
intent, intensifier, target, negation, reporting verb, quote mark, other) and five
small weighted transducers read the symbols together, as one composed machine:

* negation: covers the next ``NEGATION_SCOPE`` words;
* reported speech: covers the clause after a reporting verb, or a quotation;
* target: remembers that the clause addresses or names someone;
* insult: emits its word's weight, ``INTENSIFIED`` times that within
  ``INTENSE_SCOPE`` words of an intensifier;
* threat: emits 1 where a verb of harm comes within ``INTENT_SCOPE`` words of an
  intent ("will", "going"), else where its object, a target, comes within
  ``OBJECT_SCOPE`` words of the verb; the verb alone is no threat.

What the machine accepts is a *pattern* -- kind (insult, threat), mode (plain,
negated, reported), with or without a target -- and a text's evidence for a
pattern is the log of one plus the weights of its matched clauses. A logistic
model over the twelve patterns gives the score: an isolated word counts by the
clause it stands in.

Learned from labelled rows: the insult lexicon (words, and word stems marked by
a prefix length, that occur in many toxic texts and hardly any other) with its
weights, and the pattern weights, starting from fixed prior weights. Counts run
over a hash sample of at most ``max_train`` labelled rows; near copies of a text
count once, toxic or clean (by the smallest hash of their runs of three words), and
words only where they are neither negated nor reported. Labels, language, source and id are
never read by a score.

Defined cases: a null or empty text has no clause and scores the model's base
rate; repeated rows score alike; without labelled rows the prior weights stand;
labels that are null are left out; an empty table gives an empty table; other
columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bloom_bitmap, crc32_mod, in_bloom, release_memory, written

# fixed values: closed-class words of the grammar (en, de, fr, es)
TARGETS = frozenset(
    "you your yours yourself he she him her his they them their these those du dich dir dein deine "
    "ihr euch euer sie ihn ihm tu toi te ton ta tes vous votre vos il elle ils elles tú ti tu tus "
    "usted ustedes vosotros él ella ellos ellas".split())
NEGATIONS = frozenset(
    "not no never none neither nor isn't aren't wasn't don't nicht kein keine keinen nie niemals "
    "ne pas jamais aucun aucune non nunca jamás ni ninguno ninguna".split())
REPORTS = frozenset(
    "said says say saying wrote writes reported reports quoted quotes claimed claims called calls "
    "sagte sagt schrieb schreibt berichtete zitierte nannte dit disait écrit rapporte cite appelle "
    "dijo dice escribió escribe cuenta citó llamó".split())
THREATS = frozenset(
    "kill murder hurt destroy beat stab shoot burn töten umbringen schlagen verletzen zerstören "
    "tuer frapper blesser détruire brûler matar golpear herir destruir quemar".split())
INTENTS = frozenset(
    "will shall gonna going must i'll we'll werde werden wird wirst muss müssen vais va allons "
    "vont dois doit voy vamos van debo debe".split())
INTENSIFIERS = frozenset(
    "such so total totally complete completely absolute absolutely utter utterly völlig völliger "
    "totaler absoluter complètement totalement complet absolument totalmente completo absoluto".split())
QUOTES = frozenset("\"“”„«»")

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE, INTENT, INTENSE, END = range(10)
NEGATION_SCOPE = 3
INTENSE_SCOPE, INTENSIFIED = 2, 1.5
INTENT_SCOPE, OBJECT_SCOPE = 4, 3
SLICE = 100             # texts whose terms a task holds at once
REMEMBERED = 100_000    # words whose symbols a task remembers
STEMS = (4, 5, 6)
RUN = 3                 # words of a run that a signature is taken from
MODES = ("plain", "negated", "reported")
PATTERNS = [(kind, mode, target) for kind in ("insult", "threat") for mode in MODES
            for target in (False, True)]
# fixed values: prior weight of a kind's evidence, and what each of its patterns adds
# to it (plain, negated, reported; without and with a target)
PRIOR_KIND = {"insult": 3.0, "threat": 2.0}
PRIOR_PATTERN = {"insult": (0.0, 1.0, -2.0, -2.0, -2.0, -2.0),
                 "threat": (-1.0, 1.0, -2.0, -2.0, -2.0, -2.0)}
PRIOR_BIAS = -3.0
PRIOR = tuple(PRIOR_KIND[k] + a for k in ("insult", "threat") for a in PRIOR_PATTERN[k])

WORD = r"[^\W\d_]+(?:'[^\W\d_]+)?"
TOKEN = re.compile(WORD + r"|[\"“”„«»]|[.,;:!?|\n]")
WORDS = re.compile(WORD)


class Transducer:
    """A deterministic weighted machine: ``step(state, symbol)`` is the next state,
    ``emit(state, symbol)`` the factor of the symbol's weight that it puts out."""

    def __init__(self, step, emit=None, start=0):
        self.step, self.emit, self.start = step, emit or (lambda state, symbol: 0.0), start


def negation_step(state: int, symbol: int) -> int:
    return NEGATION_SCOPE if symbol == NEGATION else max(0, state - (symbol != QUOTE))


def report_step(state: int, symbol: int) -> int:
    """0 outside, 1 after a reporting verb, 2 inside a quotation."""
    if symbol == QUOTE:
        return 0 if state == 2 else 2
    return 1 if symbol == REPORT and state == 0 else state


def target_step(state: int, symbol: int) -> int:
    return int(state or symbol == TARGET)


def insult_step(state: int, symbol: int) -> int:
    """Words left that an intensifier reaches."""
    return INTENSE_SCOPE if symbol == INTENSE else max(0, state - (symbol != QUOTE))


def insult_emit(state: int, symbol: int) -> float:
    return (INTENSIFIED if state else 1.0) if symbol == INSULT else 0.0


def threat_step(state: int, symbol: int) -> int:
    """Above 0: words left in which an intended act may follow; below 0: words left in
    which a verb of harm may find its object."""
    if symbol == QUOTE:
        return state
    if symbol == INTENT:
        return INTENT_SCOPE
    if symbol == THREAT:
        return 0 if state > 0 else -OBJECT_SCOPE
    if symbol == TARGET and state < 0:
        return 0
    return state - 1 if state > 0 else min(0, state + 1)


def threat_emit(state: int, symbol: int) -> float:
    return float((symbol == THREAT and state > 0) or (symbol == TARGET and state < 0))


COMPONENTS = (Transducer(negation_step), Transducer(report_step), Transducer(target_step),
              Transducer(insult_step, insult_emit), Transducer(threat_step, threat_emit))


def compose(parts: tuple[Transducer, ...] = COMPONENTS) -> tuple[
        list[tuple], list[list[int]], list[list[tuple]]]:
    """The product machine: its states and, for each, the next state and the output by
    symbol. Only reachable states are built. An output is a tuple of (first of the
    pattern's two places in ``PATTERNS``, factor): the mode comes from the states of
    negation and reported speech, the factor from insult and threat."""
    start = tuple(p.start for p in parts)
    states, table, output, at = [start], [], [], 0
    number = {start: 0}
    while at < len(states):
        row, out = [], []
        negated, reported = states[at][:2]
        mode = 2 if reported else 1 if negated else 0
        for symbol in range(END):
            then = tuple(p.step(s, symbol) for p, s in zip(parts, states[at]))
            if then not in number:
                number[then] = len(states)
                states.append(then)
            row.append(number[then])
            factors = [p.emit(s, symbol) for p, s in zip(parts, states[at])][3:]
            out.append(tuple((kind * 6 + mode * 2, f) for kind, f in enumerate(factors) if f))
        table.append(row)
        output.append(out)
        at += 1
    return states, table, output


STATES, TABLE, OUTPUT = compose()


@dataclass
class Model:
    lexicon: dict[str, float] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.array(PRIOR))
    bias: float = PRIOR_BIAS


def features_of(word: str) -> list[str]:
    """A word and its stems; a stem of n letters is written as prefix + ``*``."""
    return [word, *(word[:n] + "*" for n in STEMS if len(word) >= n)]


def classify(word: str, lexicon: dict[str, float]) -> tuple[int, float]:
    weight = max((lexicon.get(f, 0.0) for f in features_of(word)), default=0.0)
    if weight > 0:
        return INSULT, weight
    for symbol, members in ((THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS),
                            (REPORT, REPORTS), (INTENT, INTENTS), (INTENSE, INTENSIFIERS)):
        if word in members:
            return symbol, 1.0
    return NOTHING


NOTHING = (OTHER, 0.0)
EACH = ""               # stands for a text itself among its terms
SHIFTS = {w: classify(w, {})[0] for w in NEGATIONS | REPORTS}


class Reader:
    """Reads texts with one model; remembers the symbols of words."""

    def __init__(self, model: Model, memory: int = REMEMBERED):
        self.model, self.memory, self.known = model, memory, {}

    def symbol(self, word: str) -> tuple[int, float]:
        got = self.known.get(word)
        if got is None:
            if len(self.known) >= self.memory:
                self.known.clear()
            got = self.known[word] = classify(word, self.model.lexicon)
        return got

    def evidence(self, text: str) -> tuple[np.ndarray, int]:
        """The evidence for each pattern, and the number of matched clauses."""
        low = text.lower()
        symbol = self.symbol
        total = np.zeros(len(PATTERNS))
        if not any(symbol(w)[0] in (INSULT, THREAT) for w in set(WORDS.findall(low))):
            return total, 0
        matched, state, hits = 0, 0, []
        for token in TOKEN.findall(low) + ["\n"]:
            if token in ".,;:!?|\n":
                if hits:
                    target = STATES[state][2]
                    best: dict[int, float] = defaultdict(float)
                    for pattern, weight in hits:
                        best[pattern + target] += weight
                    for pattern, weight in best.items():
                        total[pattern] += weight
                    matched, hits = matched + 1, []
                # a quotation goes on over the end of a clause
                state = TABLE[0][QUOTE] if STATES[state][1] == 2 else 0
                continue
            kind, weight = (QUOTE, 0.0) if token in QUOTES else symbol(token)
            for pattern, factor in OUTPUT[state][kind]:
                hits.append((pattern, factor * weight))
            state = TABLE[state][kind]
        return np.log1p(total), matched


def signature(words: list[str]) -> int:
    """The smallest hash of the runs of ``RUN`` words: alike for near copies only, while
    long texts that merely share words differ."""
    import xxhash

    runs = {" ".join(words[k:k + RUN]) for k in range(max(1, len(words) - RUN + 1))}
    return min(xxhash.xxh64_intdigest(r) for r in runs) >> 1


def plain_words(low: str) -> set[str]:
    """The words of a lower-cased text that stand somewhere neither negated nor reported."""
    found, state = set(), 0
    for token in TOKEN.findall(low):
        if token in ".,;:!?|\n":
            state = TABLE[0][QUOTE] if STATES[state][1] == 2 else 0
            continue
        if token in QUOTES:
            symbol = QUOTE
        else:
            symbol = SHIFTS.get(token, OTHER)
            negated, reported = STATES[state][:2]
            if not negated and not reported:
                found.add(token)
        state = TABLE[state][symbol]
    return found


def term_hash(term: str) -> int:
    import xxhash

    return int(np.uint64(xxhash.xxh64_intdigest(term)).view(np.int64))


def learn_lexicon(train: DataFrame, min_docs: int = 4, purity: float = 0.05,
                  margin: float = 1.5) -> dict[str, float]:
    """Words and stems that mark toxic texts, with weights of evidence.

    ``train``: text, label. A term counts once per signature, among toxic and among
    clean texts, where it is neither negated nor reported. It enters if it is in at
    least ``min_docs`` of the toxic ones, in few others (``purity`` of its toxic count
    at most), and if so pure a count would not be met by chance among all terms tried
    (log-likelihood plus ``margin``). Clean texts' terms are 64-bit hashes; a part of
    them rules out the common words first."""
    def signed(text: str) -> tuple[int, set[str]]:
        low = text.lower()
        features = {f for w in plain_words(low) for f in features_of(w)}
        return signature(WORDS.findall(low)), features

    def terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for start in range(0, len(b), SLICE):
                rows = set()
                for text in b["text"].iloc[start:start + SLICE]:
                    sig, features = signed(text)
                    rows |= {(f, sig) for f in features | {EACH}}
                yield pd.DataFrame([(f, term_hash(f), sig) for f, sig in rows],
                                   columns=["term", "h", "sig"])
        release_memory()

    def clean_counts(left: DataFrame, parts: int) -> DataFrame:
        """(h, c): in how many clean signatures, of one in ``parts``, a term is."""
        held = bloom_bitmap(left.select("h"), left.count())

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                hashes, sigs = [], []
                for text in b["text"]:
                    sig, features = signed(text)
                    if sig % parts == 0:
                        h = np.array([term_hash(f) for f in features], dtype=np.int64)
                        h = np.append(h[in_bloom(held.value, h.view(np.uint64))], term_hash(EACH))
                        hashes.append(h)
                        sigs.append(np.full(len(h), sig, dtype=np.int64))
                if hashes:
                    yield pd.DataFrame({"h": np.concatenate(hashes), "sig": np.concatenate(sigs)})
            release_memory()

        return written(clean.select("text").mapInPandas(run, "h long, sig long").distinct()
                       .groupBy("h").agg(F.count(F.lit(1)).alias("c")), "toxicity-clean")

    toxic, clean = train.where("label = 1"), train.where("label = 0")
    in_toxic = written(toxic.select("text").mapInPandas(terms, "term string, h long, sig long")
                       .distinct(), "toxicity-terms")
    n_toxic = in_toxic.where(F.col("term") == EACH).count()
    tried = in_toxic.where(F.col("term") != EACH).groupBy("term", "h").agg(
        F.count(F.lit(1)).alias("t"))
    n_terms = max(2, tried.count())
    left = tried.where(F.col("t") >= min_docs)
    for parts in (16, 1):
        left = written(left, "toxicity-left")
        found = clean_counts(left, parts)
        left = left.select("term", "h", "t").join(found, "h", "left").withColumn(
            "c", F.coalesce("c", F.lit(0))).where(F.col("c") <= purity * F.col("t"))
    n_clean = (found.where(F.col("h") == term_hash(EACH)).first() or {"c": 0})["c"]
    if not n_toxic or not n_clean:
        return {}
    rate = n_toxic / (n_toxic + n_clean)
    share = F.col("t") / (F.col("t") + F.col("c"))
    gain = F.col("t") * F.log(share / rate) + F.when(
        F.col("c") > 0, F.col("c") * F.log((1 - share) / (1 - rate))).otherwise(0.0)
    return {r.term: float(np.log((r.t + 0.5) / (n_toxic + 1) * (n_clean + 1) / (r.c + 0.5)))
            for r in left.where(gain >= float(np.log(n_terms) + margin)).collect()}


def fit_patterns(x: np.ndarray, y: np.ndarray, loose: float = 0.05, tight: float = 0.5,
                 steps: int = 50) -> tuple[np.ndarray, float]:
    """Logistic weights by Newton steps, pulled towards the prior weights.

    A pattern's weight is its kind's (loosely held) plus its own (tightly held), so a
    pattern that training never showed moves with its kind."""
    kinds = np.repeat(np.eye(2), 6, axis=0)
    a = np.hstack([x @ kinds, x, np.ones((len(x), 1))])
    prior = np.array([*PRIOR_KIND.values(), *PRIOR_PATTERN["insult"], *PRIOR_PATTERN["threat"],
                      PRIOR_BIAS])
    pull, w = np.array([loose] * 2 + [tight] * 12 + [loose]), prior.copy()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        gradient = a.T @ (p - y) + pull * (w - prior)
        hessian = (a * (p * (1 - p) + 1e-9)[:, None]).T @ a + np.diag(pull)
        step = np.linalg.solve(hessian, gradient)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return kinds @ w[:2] + w[2:14], float(w[14])


def train(docs: DataFrame, labels: DataFrame, usable: Column | None = None,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          max_train: int = 20_000) -> Model:
    """Learn a model from the labelled rows for which ``usable`` (over the id) holds."""
    own = labels.select(labels[id_col].alias("id"), labels[label_col].alias("label")).where(
        F.col("label").isin(0, 1) & (usable if usable is not None else F.lit(True))).distinct()
    n = own.count()
    if n > max_train:  # a hash sample, alike on every run
        own = own.where(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1 << 20))
                        < int((1 << 20) * max_train / n))
    texts = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit(""))
                        .alias("text"))
    # at most max_train ids, up to the spread of the hash; rows of a repeated id count
    # once per text, and if there are still too many, a hash of both thins them out
    sample = written(texts.join(F.broadcast(own), "id").withColumn("th", F.xxhash64("id", "text")).dropDuplicates(
        ["id", "th", "label"]).select("text", "label", "th"), "toxicity-train")
    m = sample.count()
    if m > 2 * max_train:
        sample = sample.where(F.pmod("th", F.lit(1 << 20)) < int((1 << 20) * max_train / m))
    model = Model(lexicon=learn_lexicon(sample))
    rows = sample.select("label", *_evidence_columns(sample, model)).toPandas()
    if len(rows) and rows["label"].nunique() == 2:
        model.weights, model.bias = fit_patterns(
            np.array(rows["evidence"].tolist()).reshape(len(rows), -1),
            rows["label"].to_numpy(dtype=float))
    return model


def _evidence_columns(docs: DataFrame, model: Model, text_col: str = "text") -> list[Column]:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("evidence array<double>, clauses int")
    def evidence(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        reader = Reader(shared.value)
        for b in batches:
            got = [reader.evidence(t) for t in b]
            yield pd.DataFrame({"evidence": [g[0].tolist() for g in got],
                                "clauses": [g[1] for g in got]})
        release_memory()

    both = evidence(F.coalesce(docs[text_col], F.lit("")))
    return [both["evidence"].alias("evidence"), both["clauses"].alias("clauses")]


def _probability(model: Model) -> Column:
    z = F.lit(float(model.bias))
    for k, w in enumerate(model.weights):
        z = z + F.get("evidence", F.lit(k)) * F.lit(float(w))
    return 1 / (1 + F.exp(-z))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = 0.7, held_out: Column | None = None) -> DataFrame:
    """id, ``held_out``, ``score``, ``predicted``, ``clauses`` of every document."""
    read = docs.select(docs[id_col].alias("id"), *_evidence_columns(docs, model, text_col))
    scored = read.select(
        F.col("id").alias(id_col), (held_out if held_out is not None else F.lit(None)
                                    .cast("boolean")).alias("held_out"),
        _probability(model).alias("score"), "clauses")
    return scored.select(id_col, "held_out", "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"), "clauses")


def trainable(id_col: Column, folds: int = 3, held: int = 1) -> Column:
    """Rows a model may learn from: crc32 of the id's text mod ``folds`` is not ``held``."""
    return F.coalesce(crc32_mod(id_col, folds) != held, F.lit(False))


def accepted(docs: DataFrame, model: Model, text_col: str = "text",
             threshold: float = 0.7) -> DataFrame:
    """The documents that score below ``threshold``, with all their columns."""
    record = F.struct(*[docs[c] for c in docs.columns]).alias("record")
    read = docs.select(record, _evidence_columns(docs, model, text_col)[0])
    return read.where(_probability(model) < threshold).select("record.*")
