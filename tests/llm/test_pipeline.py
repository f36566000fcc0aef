import os
from collections import Counter, defaultdict

import corpus_pipeline as P
from marquee.llm import mixing, packing, toxicity
from pyspark.sql import functions as F
from tests.conftest import SF_SMALL
from tests.llm.test_jaccard_join import shingle_set
from tests.llm.util import WORDS, docs


def test_stages_one_by_one(spark):
    """Each stage against brute force over what the stage before it kept."""
    now = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = toxicity.train(now, spark.read.parquet(f"{SF_SMALL}/labels.parquet"),
                           usable=toxicity.trainable(F.col("id")))
    after = {}
    for name, stage in P.STAGES:
        before = {r.doc_id: r for r in now.collect()}
        out = stage(spark, now, SF_SMALL)
        rows = out.collect()
        if name != "packing":
            assert out.columns == now.columns == list(P.COLUMNS)
            assert all(r == before[r.doc_id] for r in rows)
        ids = Counter(r.doc_id for r in rows)
        if name == "toxicity":
            bad = {r.doc_id for r in toxicity.score(now, model).where("predicted = 1").collect()}
            assert set(ids) == set(before) - bad
        elif name == "exact_dedup":
            best = {}
            for r in before.values():
                best[r.text or ""] = max(best.get(r.text or "", -1), r.doc_id)
            assert ids == Counter(best.values())
        elif name == "near_dedup":
            sets = {i: shingle_set(r.text) for i, r in before.items()}
            parent = {i: i for i in before}

            def find(x):
                return x if parent[x] == x else find(parent[x])
            holders = defaultdict(list)
            for i in sorted(sets):
                for s in sets[i]:
                    holders[s].append(i)
            shared = Counter()
            for own in holders.values():
                shared.update((a, b) for k, b in enumerate(own) for a in own[:k])
            for (a, b), n in shared.items():
                if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
            assert ids == Counter({find(i) for i in before})
        elif name == "mixing":
            copies = {r.doc_id: r.copies if r["size"] else 1
                      for r in mixing.entropy_balance(now).collect()}
            assert ids == Counter({i: c for i, c in copies.items() if c})
        else:
            encode = packing.encoder(packing.tokenizer_path())
            want = Counter()
            for r in now.collect():
                want.update((r.doc_id, k, n) for k, (_, n) in enumerate(packing.cut(len(encode(r.text or "")) + 1)))
            assert Counter((r.doc_id, r.piece, r.length) for r in rows) == want
        after[name] = len(rows)
        now = out if name == "packing" else spark.createDataFrame(rows, now.schema)
    assert after["near_dedup"] < after["exact_dedup"] < after["toxicity"]


def test_run_writes_every_stage(spark):
    out = P.run(spark, SF_SMALL)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns) and out.count() > 0


def test_packed_sequences_hold_their_tokens(spark, tmp):
    """The last stage's ids, put together by document, are the text's."""
    texts = {1: "one text", 2: "word " * 3000, 3: None}
    rows = P.packed(spark, docs(spark, list(texts.items())).select(*P.COLUMNS), tmp).collect()
    encode = packing.encoder(packing.tokenizer_path())
    assert all(len(r.ids) == r.length for r in rows)
    for i, text in texts.items():
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.piece)
        assert [k for r in own for k in r.ids] == [*encode(text or "").tolist(), packing.END_ID]


def test_stages_on_odd_rows_and_an_empty_table(spark, tmp):
    rows = [(1, None), (2, ""), (3, "x"), (3, "x"), (None, "no id at all"), (4, "a b c d e f g"), (5, "A b c d e f g"),
            (6, "\n \t"), (7, "word " * 3000, None)]
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp}/labels.parquet")
    for table in (docs(spark, rows), docs(spark, [])):
        empty = not table.take(1)
        for name, stage in P.STAGES:
            table = stage(spark, table, tmp)
            assert bool(table.take(1)) != empty, name


def test_the_library_does_not_import_the_operators():
    root = os.path.dirname(os.path.abspath(P.__file__))
    for folder, _, names in os.walk(os.path.join(root, "marquee")):
        for n in names:
            if n.endswith(".py") and os.path.basename(folder) != "llm":
                text = open(os.path.join(folder, n)).read()
                assert "marquee.llm" not in text and "from .llm" not in text and "..llm" not in text, n
    assert WORDS  # the tests' words are the operators' words
