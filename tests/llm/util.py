"""Small tables for the operators' tests: clashing extra columns on purpose."""

import random
import re

CLASHES = ("size shard slot kept keep_id id n th record rank chunk words copies rate score label "
           "node comp first maybe starts length_ digest payload_ src at").split()
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def table(spark, rows, schema="doc_id long, text string, lang string, source string, n_chars long",
          clash=True):
    """Rows as a DataFrame over several partitions, with columns named like the
    operators' own."""
    df = spark.createDataFrame(rows, schema)
    if clash:
        df = df.selectExpr("*", *[f"'x' AS `{c}`" for c in CLASHES])
    return df.repartition(4) if rows else df


def docs(spark, rows, clash=True):
    """(doc_id, text[, source]) rows as documents."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
    return table(spark, full, clash=clash)


def prose(rng: random.Random, n: int, vocabulary=400) -> str:
    spelt = [str(rng.randrange(vocabulary)) for _ in range(n)]
    return " ".join("w" + "".join("abcdefghij"[int(c)] for c in s) for s in spelt)


def long_text(n=200_000):
    """A text far longer than the rest."""
    rng = random.Random(9)
    return " ".join(f"z{rng.randrange(10 ** 6)}" for _ in range(n))
