"""The registered queries of the training-data operators, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.session import scratch_path

from . import (chat_format, code_compression, exact_dedup, jaccard_join, mixing, packing, quality_mil,
               quality_rules, ranked_search, sharding, suffix_dedup, toxicity, warc)
from .common import crc32_mod, read


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = toxicity.train(docs, read(spark, sf_dir, "labels"),
                           usable=toxicity.trainable(F.col("id")))
    return toxicity.score(docs, model, threshold=0.7, held_out=crc32_mod(F.col("id"), 3) == 1)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.entropy_balance(read(spark, sf_dir, "documents"), weights=(3.0, 1.0, 2.0),
                                  budget=1.5, cap=2.0)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.content_sort_dedup(read(spark, sf_dir, "documents"), keep="max")


SQL_OP3 = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256, coalesce(text, '') AS t
           FROM documents),
     g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.text_sha256
FROM d JOIN g USING (t)
"""


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read(spark, sf_dir, "documents"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = quality_mil.train(docs, read(spark, sf_dir, "labels"),
                              usable=quality_mil.trainable(F.col("id")))
    return quality_mil.score(docs, model, threshold=0.7, held_out=crc32_mod(F.col("id"), 4) == 2)


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = read(spark, sf_dir, "documents"), scratch_path(spark, "shards")
    sharding.write_shards(docs, path, n_shards=40)
    return sharding.read_shards(docs, path, n_shards=40)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages"), with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL_OP7 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
     g AS (SELECT h, min(page_id) AS least FROM p WHERE strlen(h) >= 100 GROUP BY h)
SELECT p.page_id, strlen(p.h) AS payload_bytes, sha256(p.h) AS payload_digest,
       CASE WHEN g.least < p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN g.least < p.page_id THEN g.least END AS refers_to
FROM p LEFT JOIN g USING (h)
"""


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(read(spark, sf_dir, "documents"), threshold=75).select(
        "doc_id", "n_shingles", "component_id")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = quality_rules.ledger(read(spark, sf_dir, "documents"))
    return quality_rules.apply_policy(entries).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "fail_bits")

SQL_OP8 = r"""
WITH RECURSIVE
w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
      FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN w ELSE list_slice(w, i, i + 4) END AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i
            FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
      FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM o JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
      WHERE 100 * c >= 75 * (p.n + q.n - c)),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
r AS (SELECT x AS a, y AS b FROM e UNION SELECT r.a, e.y FROM r JOIN e ON r.b = e.x)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles,
       least(w.doc_id, coalesce(m.b, w.doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id)
LEFT JOIN (SELECT a AS doc_id, min(b) AS b FROM r GROUP BY a) m USING (doc_id)
"""

SQL_OP10 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
l AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(t, chr(10)),
                         lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT doc_id, i, list_slice(w, i, i + 4) AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM l)),
c AS (SELECT doc_id, count(DISTINCT i + k) AS n
      FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS times FROM g)
      CROSS JOIN range(0, 5) r(k) WHERE times > 1 GROUP BY doc_id),
m AS (SELECT l.doc_id, len(w) AS n_words,
             length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
             coalesce(c.n, 0) AS n_repeat_words, len(list_distinct(w)) AS n_distinct,
             length(regexp_replace(t, '[^!]', '', 'g')) AS n_exclaims,
             length(regexp_replace(t, '[^\pL]', '', 'g')) AS n_letters,
             length(regexp_replace(t, '[^\p{Lu}]', '', 'g')) AS n_upper
      FROM l LEFT JOIN c USING (doc_id)),
f AS (SELECT *, n_words < 10 AS f0, 100 * n_repeat_words > 20 * n_words AS f1,
             10 * n_symbols > n_words AS f2, 10 * n_dup_lines > 3 * n_lines AS f3,
             word_chars < 2 * n_words AS f4, word_chars > 15 * n_words AS f5,
             2 * n_upper > n_letters AS f6, 5 * n_exclaims > n_words AS f7,
             2 * n_letters < word_chars AS f8,
             n_words >= 50 AND 10 * n_distinct < n_words AS f9 FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       f0 OR f1 AS base_failed,
       NOT (f0 OR f1 OR f2 OR f6 OR f7 OR f8 OR f9 OR f3::INT + f4::INT + f5::INT >= 2) AS kept,
       (f0::BIGINT + 2 * f1::BIGINT + 4 * f2::BIGINT + 8 * f3::BIGINT + 16 * f4::BIGINT
        + 32 * f5::BIGINT + 64 * f6::BIGINT + 128 * f7::BIGINT + 256 * f8::BIGINT
        + 512 * f9::BIGINT)::BIGINT AS fail_bits
FROM f
"""


def conversation_records(turns: DataFrame) -> DataFrame:
    """Stand-in input of op11: every row of ``conversations`` as one record (JSON) in one of
    the layouts that chat corpora come in, and conversation -7 of two rows."""
    said = "</s>[INST] ok [/INST]"
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").union(
        turns.sparkSession.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                           "conv_id long, turn long, role string, text string"))
    role, text = F.col("role"), F.col("text")
    spoken = F.when(role == "user", "human").when(role == "assistant", "gpt").when(role == "system", "system")

    def record(*fields):
        return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})

    def by_role(user, assistant):
        return F.when(role == "user", record(*user)).when(role == "assistant", record(*assistant))

    layouts = [
        record(role, text),
        record(F.array(F.struct(role, text.alias("content"))).alias("messages")),
        record(F.array(F.struct(role, F.array(F.struct(F.lit("text").alias("type"), text)).alias("content")))
               .alias("messages")),
        record(F.struct(F.struct(role).alias("author"), F.struct(F.array(text).alias("parts")).alias("content"))
               .alias("message")),
        F.when(spoken.isNotNull(), record(F.array(F.struct(spoken.alias("from"), text.alias("value")))
                                          .alias("conversations"))),
        by_role([text.alias("prompt")], [text.alias("completion")]),
        by_role([text.alias("instruction"), F.lit("").alias("input")], [text.alias("output")]),
    ]
    which = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(len(layouts)))
    chosen = F.coalesce(*[F.when(which == i, r) for i, r in enumerate(layouts)], layouts[0])
    return rows.select("conv_id", "turn", chosen.alias("record"))


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = conversation_records(read(spark, sf_dir, "conversations"))
    turns = chat_format.canonical_turns(records, "conv_id", "record", "turn")
    return chat_format.read_back(chat_format.formatted_turns(turns), "conv_id")


def _sql_op11() -> str:
    template = chat_format.Template()

    def escaped(column):
        out = f"replace({column}, '\\', '\\\\')"
        for c in template.controls:
            out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
        return out

    marks = len(template.opens + template.says + template.closes)
    return f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
           UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum({marks} + length({escaped('role')}) + length({escaped('text')}))::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""


def op12_code_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return code_compression.compress(read(spark, sf_dir, "embeddings"), parts=4, entries=256, rounds=4,
                                     scale=1024)


def _sql_op12(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    assigned = """a{r} AS MATERIALIZED (
  SELECT id, part, v, min(d) AS d, arg_min(entry, d * 1000 + entry) AS entry FROM (
    SELECT p.id, p.part, p.v, c.entry, list_inner_product(p.v, p.v) + list_inner_product(c.v, c.v)
           - 2 * list_inner_product(p.v, c.v) AS d
    FROM p JOIN c{r} c ON c.part = p.part) GROUP BY id, part, v)"""
    # doubles hold these integers exactly; // of doubles would not floor, floor() does
    moved = """c{n} AS MATERIALIZED (
  SELECT c.part, c.entry, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN (
    SELECT part, entry, list(x ORDER BY i) AS v FROM (
      SELECT part, entry, i, floor(sum(v[i]) / count(*)) AS x FROM a{r}, range(1, 17) t(i) GROUP BY part, entry, i)
    GROUP BY part, entry) m ON m.part = c.part AND m.entry = c.entry)"""
    steps = []
    for r in range(rounds):
        steps += [assigned.format(r=r), moved.format(r=r, n=r + 1)]
    steps.append(assigned.format(r=rounds))
    return f"""
WITH k AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS id, vec_id, label,
         list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT id, s AS part, list_slice(v, (16 * s + 1)::INT, (16 * s + 16)::INT) AS v
                   FROM k, range({parts}) t(s)),
c0 AS MATERIALIZED (SELECT part, id - 1 AS entry, v FROM p WHERE id <= {entries}),
{", ".join(steps)},
f AS (SELECT id, string_agg(printf('%02x', entry::INT), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
      FROM a{rounds} GROUP BY id),
h AS (SELECT sha256(string_agg(x::BIGINT::VARCHAR, ',' ORDER BY part, entry, i)) AS codebooks_sha256
      FROM (SELECT part, entry, i, v[i] AS x FROM c{rounds}, range(1, 17) t(i)))
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM k JOIN f USING (id), h
"""


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), k=20)


SQL_OP13 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
q AS (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
s AS (SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0),
p AS (SELECT doc_id, t, count(*)::BIGINT AS tf, any_value(n)::BIGINT AS n
      FROM (SELECT doc_id, len(w) AS n, unnest(w) AS t FROM d) GROUP BY doc_id, t),
f AS (SELECT t, count(*) AS df FROM p GROUP BY t),
i AS (SELECT p.doc_id, p.t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * f.df + 1)))::BIGINT
             * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))) AS impact
      FROM p JOIN f USING (t), s),
r AS (SELECT q.item_id, i.doc_id, sum(i.impact)::BIGINT AS score FROM q JOIN i USING (t) GROUP BY 1, 2)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM r WHERE score > 0 QUALIFY rank <= 20
"""


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_mixing": op2_mixing,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_sharding": op6_sharding,
    "op7_warc": op7_warc,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_packing": op9_packing,
    "op10_quality_rules": op10_quality_rules,
    "op11_chat_format": op11_chat_format,
    "op12_code_compression": op12_code_compression,
    "op13_ranked_search": op13_ranked_search,
}
ORACLE = {
    "op3_exact_dedup": SQL_OP3,
    "op7_warc": SQL_OP7,
    "op8_jaccard_join": SQL_OP8,
    "op10_quality_rules": SQL_OP10,
    "op11_chat_format": _sql_op11(),
    "op12_code_compression": _sql_op12(),
    "op13_ranked_search": SQL_OP13,
}
