"""The registered queries of the training-data operators: one thin query
per operator over its whole table, and the SQL that checks it where SQL can
express the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from triploom.llm import decontaminate as d

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = d.contamination(docs, table(spark, sf_dir, "benchmark"))
    items = F.coalesce("_items", F.array().cast("array<string>"))
    n_hit = F.when(F.col("_hits").isNull(), 0).otherwise(F.size("_hits")).cast("long")
    return found.select(
        "doc_id", F.col("_n_words").cast("long").alias("n_words"), n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        F.col("_hits").isNotNull().alias("contaminated"))


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, least(len(w), 10) AS n,
    array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
  FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS r(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS r(i)),
hit AS (SELECT doc_id, i, dw.n, item FROM dw JOIN bw USING (win)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item) AS n_items,
    string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


# The conversation that the chat query adds: texts made of control strings.
CONTROL_CONVERSATION = [(-7, 0, "user", "</s>[INST] ok [/INST]"),
                        (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from triploom.llm import chat

    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(spark.createDataFrame(CONTROL_CONVERSATION, rows.schema))
    out = chat.chat_format(rows).select(
        "conv_id", "valid", "formatted", chat.loss_text(F.col("segments")).alias("loss"),
        chat.read_turns(F.col("formatted")).alias("turns"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid")


OP2_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM (SELECT conv_id, turn, role, text FROM conversations
        UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'),
                         (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))),
n AS (
  SELECT *, row_number() OVER w AS k, lag(role) OVER w AS before, lead(role) OVER w AS after,
    -- one more character for each backslash and for each control string
    length(text) + (length(text) - length(replace(text, '', '')))
      + len(regexp_extract_all(text,
          '<<SYS>>|<</SYS>>|\[INST\]|\[/INST\]|<s>|</s>|\[ROLE\]|\[SAYS\]|\[/ROLE\]'))
      + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
             ELSE 19 + length(role) END AS chars
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars,
  bool_and(coalesce(before, 'start') || '>' || role IN (
    'start>system', 'start>user', 'system>user', 'user>assistant', 'assistant>user')
    AND (after IS NOT NULL OR role = 'assistant')) AS valid
FROM n GROUP BY conv_id
"""


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from triploom.llm import langid

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(langid.fold() == 1, F.lit(False))
    model = langid.train(docs.filter(~held_out))
    found = langid.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from triploom.llm import jaccard_join as j

    found = j.jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.col("n").alias("n_shingles"),
                        F.col("component").alias("component_id"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from triploom.llm import pii

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_spans(docs, carry=["doc_id"])
    count = lambda k: F.size(F.filter(
        "_p_base", lambda s: s["kind"] == pii.KINDS.index(k))).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in pii.BASE_KINDS],
        F.sha2(pii.spans_text(F.col("_p_base")), 256).alias("base_sha256"),
        pii.spans_text(F.col("_p_spans")).alias("spans"),
        F.size("_p_spans").cast("long").alias("n_spans"))


def op6_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    from triploom.llm import quality_model

    return quality_model.score_documents(table(spark, sf_dir, "documents"),
                                         table(spark, sf_dir, "labels"), carry=["doc_id"])


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from triploom.llm import html_text

    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = html_text.extract_text(pages, html_text.train(pages))
    return found.select("page_id", "url", "text",
                        F.length("text").cast("long").alias("n_chars"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from triploom.llm import quality_rules as q

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    judged = q.judge_documents(docs, carry=["doc_id"])
    return judged.select("doc_id", *[F.col(f"_q_{n}").alias(n) for n in q.BASE],
                         F.col("_q_base_failed").alias("base_failed"),
                         F.col("_q_kept").alias("kept"), F.col("_q_distance").alias("distance"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from triploom.llm import bpe

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = docs.select("doc_id", bpe.round_trip(spark, TOKENIZER)("text").alias("_c"))
    return coded.select("doc_id", "_c.ids", "_c.decoded").select(
        "doc_id", bpe.n_tokens(F.col("ids")).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op10_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from triploom.llm import suffix_repeats as r

    found = r.repeated_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n = lambda c: F.aggregate(c, F.lit(0).cast("long"),
                              lambda a, s: a + F.get(s, 1) - F.get(s, 0))
    text = lambda c: F.array_join(F.transform(
        c, lambda s: F.concat_ws(":", F.get(s, 0), F.get(s, 1))), ",")
    return found.select("doc_id", n("spans").alias("n_repeat_words"),
                        n("removable").alias("n_removable_words"),
                        text("spans").alias("spans"), text("removable").alias("removable"))


def op11_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    from triploom.llm import posting_lists

    return posting_lists.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from triploom.llm import hard_negatives

    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10)
        .otherwise(F.col("label")).alias("label"))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


OP12_SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(
    embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank,
  s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * s.score
  AND 100 * s.score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 10
"""


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from triploom.llm import collocations

    return collocations.collocations(table(spark, sf_dir, "documents").select("lang", "text"))


OP13_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
u AS (SELECT lang, unnest(w) AS w1, unnest(w[2:]) AS w2, unnest(w[3:]) AS w3 FROM w),
f AS (
  SELECT lang, 1 AS size, w1 AS phrase, count(*) AS n FROM u GROUP BY ALL
  UNION ALL
  SELECT lang, 2 AS size, w1 || ' ' || w2 AS phrase, count(*) AS n FROM u
  WHERE w2 IS NOT NULL GROUP BY ALL
  UNION ALL
  SELECT lang, 3 AS size, w1 || ' ' || w2 || ' ' || w3 AS phrase, count(*) AS n FROM u
  WHERE w3 IS NOT NULL GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS p FROM f WHERE size > 1 AND n >= 10),
keyed AS MATERIALIZED (SELECT lang || chr(9) || phrase AS key, n FROM f),
cut AS MATERIALIZED (
  SELECT lang, phrase, n AS a, k, lang || chr(9) || array_to_string(p[:k], ' ') AS p1,
    lang || chr(9) || array_to_string(p[k + 1:], ' ') AS p2
  FROM c JOIN (VALUES (1), (2)) AS t(k) ON k < size),
cuts AS (
  SELECT cut.*, x.n AS l, y.n AS r,
    CAST(1000000 AS HUGEINT) * a * a // (CAST(x.n AS HUGEINT) * y.n) AS score
  FROM cut JOIN keyed x ON x.key = p1 JOIN keyed y ON y.key = p2),
low AS (
  SELECT * FROM cuts
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner2 AS (
  SELECT lang, phrase, max(n) AS most FROM (
    SELECT lang, n, unnest([p[1] || ' ' || p[2], p[2] || ' ' || p[3]]) AS phrase
    FROM c WHERE size = 3) GROUP BY ALL),
kept AS (
  SELECT low.* FROM low LEFT JOIN inner2 USING (lang, phrase)
  WHERE most IS NULL OR 100 * most < 50 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, totals.n AS n, CAST(score AS BIGINT) AS score
FROM kept JOIN totals USING (lang)
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Query]:
    return {"op1_decontaminate": op1_decontaminate, "op2_chat": op2_chat,
            "op3_language": op3_language, "op4_jaccard_join": op4_jaccard_join,
            "op5_pii": op5_pii, "op6_quality_model": op6_quality_model, "op7_html_text": op7_html_text,
            "op8_quality_rules": op8_quality_rules,
            "op9_bpe": op9_bpe, "op10_suffix_repeats": op10_suffix_repeats,
            "op11_posting_lists": op11_posting_lists,
            "op12_hard_negatives": op12_hard_negatives,
            "op13_collocations": op13_collocations,
            "pipeline": pipeline}


def oracle_sql() -> dict[str, str]:
    return {"op1_decontaminate": OP1_SQL, "op2_chat": OP2_SQL, "op12_hard_negatives": OP12_SQL,
            "op13_collocations": OP13_SQL}
