import random
from collections import Counter

from marquee.llm import quality_rules as Q
from tests.llm.util import WORDS, docs, long_text

rng = random.Random(2)
ALPHABET = ["a", "b", "c", "dé", "#", "*x", "|", "ß", "A", "!!", "9"]
SPACES = [" ", "  ", "\n", "\r\n", "\t", "\x0b", " ", " ", "\x1c", ". "]
ROWS = [(i, "".join(rng.choice(ALPHABET) + rng.choice(SPACES) for _ in range(rng.randrange(60))))
        for i in range(120)]
ROWS += [(200, None), (201, ""), (202, " \n\t "), (203, "a b c d e a b c d e"), (203, "a b c d e a b c d e"),
         (None, "one two"), (204, "x " * 5000), (205, "\n".join(["same line"] * 50)), (206, long_text(20_000)),
         (207, "💥 𝒳 " * 12)]


def brute(t):
    t = t or ""
    w = WORDS.findall(t)
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    times = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if times[g] > 1 for k in range(5)}
    lines = [x for x in t.split("\n") if WORDS.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)),
            len(covered))


def test_measures_match_brute_force(spark):
    got = Q.ledger(docs(spark, ROWS)).collect()
    assert sorted((r.doc_id or -1, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
                  for r in got) == sorted((i or -1, *brute(t)) for i, t in ROWS)


def test_policy_and_ablation(spark):
    entries = Q.ledger(docs(spark, ROWS))
    for policy in Q.POLICIES.values():
        rows = Q.apply_policy(entries, policy).collect()
        def rejects(bits, p=policy):
            return bool(bits & p.strict) or bool(p.weak) and bin(bits & p.weak).count("1") >= p.weak_limit
        for r in rows:
            assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
            assert r.kept == (not r.base_failed and not rejects(r.fail_bits))
        for a in Q.ablation(entries, policy).collect():
            own = 1 << a.bit
            assert a.n_failed == sum(bool(r.fail_bits & own) for r in rows)
            assert a.n_rejected == sum(rejects(r.fail_bits) for r in rows)
            assert a.n_freed == sum(rejects(r.fail_bits) and not rejects(r.fail_bits & ~own) for r in rows)


def test_rules_have_one_bit_each():
    assert [r.bit for r in Q.RULES] == list(range(len(Q.RULES)))


def test_empty_table_and_native_plan(spark):
    out = Q.apply_policy(Q.ledger(docs(spark, [])))
    assert out.count() == 0
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
