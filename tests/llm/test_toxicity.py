import random

import numpy as np
from pyspark.sql import functions as F

from marquee.llm import toxicity as T
from tests.llm.util import docs, long_text, prose

MODEL = T.Model(lexicon={"idiot": 2.0, "lowei*": 3.0})


def found(text):
    x, clauses = T.Reader(MODEL).evidence(text)
    return {T.PATTERNS[k]: round(float(np.expm1(v)), 6) for k, v in enumerate(x) if v}, clauses


def test_patterns_of_clauses():
    assert found("Nothing here.") == ({}, 0)
    assert found("What an idiot") == ({("insult", "plain", False): 2.0}, 1)
    assert found("You are an IDIOT. Fine.") == ({("insult", "plain", True): 2.0}, 1)
    assert found("She is not an idiot") == ({("insult", "negated", True): 2.0}, 1)
    assert found("not a word about this big idiot") == ({("insult", "plain", False): 2.0}, 1)
    assert found("He said idiot, then left") == ({("insult", "reported", True): 2.0}, 1)
    assert found('the word "idiot" alone') == ({("insult", "reported", False): 2.0}, 1)
    assert found("we will hurt you") == ({("threat", "plain", True): 1.0}, 1)
    assert found("idiot. loweibert idiot\nidiot") == ({("insult", "plain", False): 9.0}, 3)


def test_a_quotation_spans_clauses():
    got, _ = found('"one. idiot" idiot')
    assert got == {("insult", "reported", False): 2.0, ("insult", "plain", False): 2.0} or got == {
        ("insult", "reported", False): 2.0, ("insult", "plain", False): 2.0}


def test_composition_is_the_product_of_the_parts():
    rng = random.Random(1)
    for _ in range(100):
        state, parts = 0, [c.start for c in T.COMPONENTS]
        for _ in range(30):
            symbol = rng.randrange(T.END)
            state = T.TABLE[state][symbol]
            parts = [c.step(s, symbol) for c, s in zip(T.COMPONENTS, parts)]
            assert T.STATES[state] == tuple(parts)


def test_threats_are_patterns_and_intensifiers_weigh():
    assert found("burn the old wood") == ({}, 0)
    assert found("he will burn it") == ({("threat", "plain", True): 1.0}, 1)
    assert found("we did not hurt you") == ({("threat", "negated", True): 1.0}, 1)
    assert found("she said we will kill") == ({("threat", "reported", True): 1.0}, 1)
    assert found("you burn") == ({}, 0)
    assert found("such an idiot") == ({("insult", "plain", False): 3.0}, 1)
    assert found("such is life with an idiot") == ({("insult", "plain", False): 2.0}, 1)


SAID = {"insult": "idiot", "insult2": "loweibert", "threat": "hurt", "target": "you", "negation": "not",
        "report": "said", "quote": '"', "intent": "will", "intense": "such", "other": "tree", "end": "."}


def brute_evidence(names):
    """What the grammar's definitions say, by looking around each word; no machine."""
    total, inside, clause = {}, False, []
    for name in [*names, "end"]:
        if name != "end":
            clause.append(name)
            continue
        hits = []
        for i, name in enumerate(clause):
            back = [w for w in reversed(clause[:i]) if w != "quote"]
            quotes = clause[:i].count("quote") + inside
            since = clause[:i]
            while "quote" in since:
                since = since[since.index("quote") + 1:]
            reported = quotes % 2 == 1 or "report" in since
            mode = "reported" if reported else "negated" if "negation" in back[:3] else "plain"
            if name in ("insult", "insult2"):
                hits.append(("insult", mode, {"insult": 2.0, "insult2": 3.0}[name]
                             * (1.5 if "intense" in back[:2] else 1)))
            intended = lambda words: "intent" in words[:4] and "threat" not in words[:words.index("intent")]
            if name == "threat" and intended(back):
                hits.append(("threat", mode, 1.0))
            if name == "target":
                for k, w in enumerate(back[:3]):
                    if w == "threat":
                        if not intended(back[k + 1:]):
                            hits.append(("threat", mode, 1.0))
                    if w in ("threat", "target", "intent"):
                        break
        for kind, mode, weight in hits:
            key = (kind, mode, "target" in clause)
            total[key] = total.get(key, 0) + weight
        inside, clause = (clause.count("quote") + inside) % 2 == 1, []
    return total


def test_matches_a_reading_without_the_machine():
    rng = random.Random(9)
    for _ in range(3000):
        names = [rng.choice(list(SAID)) for _ in range(rng.randrange(1, 25))]
        assert found(" ".join(SAID[n] for n in names))[0] == brute_evidence(names), names


def test_short_words_can_be_learnt(spark):
    rng = random.Random(8)
    rows = [(f"{prose(rng, 20)} zq", 1) for _ in range(60)] + [(prose(rng, 21), 0) for _ in range(200)]
    assert "zq" in T.learn_lexicon(spark.createDataFrame(rows, "text string, label int").repartition(4))


def corpus():
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(400):
        toxic = i % 5 == 0
        text = prose(rng, 60)
        if toxic:
            text = f"{text}. {rng.choice(['moron', 'vequand', 'vequose'])} {prose(rng, 5)}"
        rows.append((i, text))
        labels.append((i, int(toxic)))
    return rows, labels


def test_learns_words_and_stems_from_the_usable_rows(spark):
    rows, labels = corpus()
    rows += [(1000, None), (1001, ""), (1002, "you moron"), (1003, "vequxyz is here"), (1004, long_text(30_000)),
             (1002, "you moron"), (None, "moron")]
    table = docs(spark, rows)
    marks = spark.createDataFrame(labels + [(1002, None)], "doc_id long, toxic int")
    model = T.train(table, marks, usable=T.trainable(F.col("id")))
    assert "moron" in model.lexicon and any(t.startswith("vequ") for t in model.lexicon)
    assert not any(t.startswith("w") for t in model.lexicon)
    got = T.score(table, model, held_out=T.crc32_mod(F.col("id"), 3) == 1).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[i].predicted == y for i, y in labels)
    assert by_id[1002].predicted == by_id[1003].predicted == by_id[None].predicted == 1
    assert by_id[1000].predicted == by_id[1001].predicted == by_id[1004].predicted == 0
    assert all(0 <= r.score <= 1 and r.held_out is not None for r in got if r.doc_id is not None)
    kept = T.accepted(table, model)
    assert kept.columns == table.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if not r.predicted}


def test_clean_copies_and_quotes_do_not_take_a_word_out(spark):
    """Copies of one clean text count once; quoted and negated uses are no use of the word."""
    rng = random.Random(6)
    rows = [(f"{prose(rng, 40)}. moron {prose(rng, 5)}", 1) for _ in range(60)]
    rows += [(f"{prose(rng, 40)}. bonobo {prose(rng, 5)}", k % 2) for k in range(60)]
    copied = f"{prose(rng, 40)}. moron {prose(rng, 5)}"
    rows += [(prose(rng, 45), 0) for _ in range(200)] + [(copied, 0)] * 30
    rows += [(f'{prose(rng, 40)}. He said "moron" to me', 0) for _ in range(8)]
    rows += [(f"{prose(rng, 40)}. You are no moron", 0) for _ in range(8)]
    lexicon = T.learn_lexicon(spark.createDataFrame(rows, "text string, label int").repartition(4))
    assert "moron" in lexicon and "bonobo" not in lexicon
    assert T.plain_words('a moron. he said idiot, then "fool. oaf" not a big dunce but fine') == {
        "a", "moron", "he", "said", "then", "not", "but", "fine"}


def test_rare_pure_words_enter_however_many_rows_there_are(spark):
    """19 of 2,000 toxic texts have a word that no clean text has; long texts keep apart."""
    rng = random.Random(7)
    rows = [(f"{prose(rng, 8)} {'zounderkite' if k < 19 else 'muppet'}", 1) for k in range(2000)]
    rows += [(prose(rng, 9), 0) for _ in range(2000)]
    lexicon = T.learn_lexicon(spark.createDataFrame(rows, "text string, label int").repartition(4))
    assert {"muppet", "zounderkite"} <= set(lexicon)
    long = [prose(rng, 3000, 10 ** 9).split() for _ in range(2)]
    shared = [w for pair in zip(*long) for w in pair]
    texts = [rng.sample(shared, len(shared)) for _ in range(20)]
    assert len({T.signature(t) for t in texts}) == 20
    assert T.signature(texts[0]) == T.signature(list(texts[0]))


def test_held_out_rows_teach_nothing(spark):
    rows, labels = corpus()
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    usable = T.trainable(F.col("id"))
    spoilt = marks.withColumn("toxic", F.when(T.trainable(F.col("doc_id")), F.col("toxic"))
                              .otherwise(1 - F.col("toxic")))
    a, b = (T.train(docs(spark, rows), m, usable=usable) for m in (marks, spoilt))
    assert a.lexicon == b.lexicon and np.allclose(a.weights, b.weights)


def test_no_labels_and_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = T.train(docs(spark, [(1, "a b c")]), none)
    assert model.lexicon == {}
    assert [r.predicted for r in T.score(docs(spark, [(1, "a b c")]), model).collect()] == [0]
    assert T.score(docs(spark, []), model).collect() == []
    assert T.accepted(docs(spark, []), model).collect() == []
