"""Quality rules as a bitmask ledger.

Every rule is evaluated once a document. The ledger stores the measurements and
one long with a bit for each failed rule; versioned policies then read the bits
(a mask of rules that each reject alone, and a set of weak rules of which some
number together rejects), and the ablation of a policy comes from bitwise
aggregation over the ledger, without reading a text again.

All of it is built-in expressions. The 5-word windows of a text are hashed once;
only where two hashes agree are the windows compared as words (sorted, with
their neighbours), so the count is exact.

Defined cases: a null text has no words, symbols or lines and fails the first
rule; repeated rows are measured like any other; an empty table gives an empty
ledger; other columns of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.session import evaluate_once

from .common import WHITE_CHARS, words

SYMBOLS = "#*$%&|<>"
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """``fails`` is a SQL predicate over the measurements."""

    bit: int
    name: str
    fails: str


# The rules, in bit order; a bit never changes its meaning once released.
RULES = (
    Rule(0, "few_words", "n_words < 10"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > n_words"),
    Rule(3, "duplicate_lines", "10 * n_dup_lines > 3 * n_lines"),
    Rule(4, "short_words", "word_chars < 2 * n_words"),
    Rule(5, "long_words", "word_chars > 15 * n_words"),
    Rule(6, "capitals", "2 * n_upper > n_letters"),
    Rule(7, "exclamations", "5 * n_exclaims > n_words"),
    Rule(8, "few_letters", "2 * n_letters < word_chars"),
    Rule(9, "few_distinct_words", "n_words >= 50 and 10 * n_distinct_words < n_words"),
)
BASE_BITS = 0b11


@dataclass(frozen=True)
class Policy:
    """Rejects a document that fails any rule of ``strict``, or at least ``weak_limit``
    rules of ``weak``."""

    version: str
    strict: int
    weak: int = 0
    weak_limit: int = 1

    def rejects(self, bits: Column) -> Column:
        hard = bits.bitwiseAND(F.lit(self.strict)) != 0
        soft = F.bit_count(bits.bitwiseAND(F.lit(self.weak))) >= self.weak_limit
        return hard | soft if self.weak else hard


POLICIES = {p.version: p for p in (
    Policy("base", strict=BASE_BITS),
    Policy("v1", strict=BASE_BITS | 1 << 2 | 1 << 6 | 1 << 7 | 1 << 8 | 1 << 9,
           weak=1 << 3 | 1 << 4 | 1 << 5, weak_limit=2),
)}
CURRENT = "v1"


def _count_of(chars: str, text: Column) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and every measurement the rules read."""
    text = F.coalesce(docs[text_col], F.lit(""))
    split = evaluate_once(docs.select(
        docs[id_col].alias("_id"), text.alias("_t"), words(text).alias("_w")))
    has_word = lambda line: F.length(F.translate(line, WHITE_CHARS, "")) > 0
    starts = F.when(F.size("_w") >= WINDOW, F.sequence(F.lit(0), F.size("_w") - WINDOW)).otherwise(
        F.array().cast("array<int>"))
    at = lambda i, k: F.get("_w", i + k)
    hashes = F.transform(starts, lambda i: F.xxhash64(*[at(i, k) for k in range(WINDOW)]))
    lower, upper = F.lower("_t"), F.upper("_t")
    stage = evaluate_once(split.select(
        "_id", "_t", "_w", hashes.alias("_h"),
        F.filter(F.split("_t", "\n"), has_word).alias("_lines")))
    # hashes that differ are windows that differ; the rest are compared as words
    suspects = F.when(
        F.size(F.array_distinct("_h")) < F.size("_h"),
        F.array_sort(F.transform(starts, lambda i: F.struct(
            F.concat_ws(" ", *[at(i, k) for k in range(WINDOW)]).alias("g"), i.alias("i")))))
    stage = evaluate_once(stage.select(
        "_id",
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.translate("_t", WHITE_CHARS, "")).cast("long").alias("word_chars"),
        _count_of(SYMBOLS, F.col("_t")).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct("_w")).cast("long").alias("n_distinct_words"),
        _count_of("!", F.col("_t")).cast("long").alias("n_exclaims"),
        F.length(F.regexp_replace("_t", r"[^\p{L}]+", "")).cast("long").alias("n_letters"),
        F.length(F.regexp_replace("_t", r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
        suspects.alias("_s")))
    near = lambda k: F.get("_s", k)["g"]
    twice = F.transform("_s", lambda x, k: F.when(
        F.coalesce(x["g"] == near(k - 1), F.lit(False))
        | F.coalesce(x["g"] == near(k + 1), F.lit(False)), x["i"]))
    stage = evaluate_once(stage.select(
        *[c for c in stage.columns if c != "_s"],
        F.array_sort(F.filter(twice, lambda i: i.isNotNull())).alias("_at")))
    # words covered by the repeated windows, each once
    covered = F.aggregate(
        F.col("_at"), F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda acc, i: F.struct(
            (acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n"), i.alias("last")),
        lambda acc: acc["n"])
    return stage.select(
        F.col("_id").alias(id_col), *[c for c in stage.columns if c[0] != "_"],
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """id, the measurements and ``fail_bits``: every rule evaluated once."""
    m = measure(docs, id_col, text_col)
    bits = F.lit(0).cast("long")
    for r in rules:
        bits = bits.bitwiseOR(F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0))
                              .cast("long"))
    return m.withColumn("fail_bits", bits)


def apply_policy(entries: DataFrame, policy: Policy = POLICIES[CURRENT]) -> DataFrame:
    """The ledger with ``base_failed``, ``kept`` and ``policy``."""
    bits = F.col("fail_bits")
    base = bits.bitwiseAND(F.lit(BASE_BITS)) != 0
    return entries.select("*", base.alias("base_failed"),
                          (~base & ~policy.rejects(bits)).alias("kept"),
                          F.lit(policy.version).alias("policy"))


def ablation(entries: DataFrame, policy: Policy = POLICIES[CURRENT],
             rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """For each rule: documents that fail it, documents the policy rejects, and
    documents it would no longer reject without that rule. Reads one row for each
    distinct bit pattern (at most 2 ** number of rules) after map-side counting."""
    patterns = entries.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    spread = patterns.select("fail_bits", "n", F.explode(F.array(*[
        F.struct(F.lit(r.bit).alias("bit"), F.lit(r.name).alias("rule")) for r in rules])).alias("r"))
    one = F.shiftleft(F.lit(1).cast("long"), 0)
    bits = F.col("fail_bits")
    own = F.call_function("shiftleft", one, F.col("r.bit"))
    fails = bits.bitwiseAND(own) != 0
    rejected = policy.rejects(bits)
    freed = rejected & ~policy.rejects(bits.bitwiseAND(F.bitwise_not(own)))
    count = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0)).alias
    return spread.groupBy(F.col("r.bit").alias("bit"), F.col("r.rule").alias("rule")).agg(
        count(fails)("n_failed"), count(rejected)("n_rejected"), count(freed)("n_freed"))
