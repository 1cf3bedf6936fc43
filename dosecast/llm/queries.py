"""One registered query for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dosecast.llm import (
    bpe, chat, decontaminate, fill_in_middle, filter_audit, html_text, jaccard_join, packed_ids, pii, quality_model,
    quality_rules, sentence_pieces, token_counts,
)
from dosecast.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
OVER_LIMIT = 2048


def _query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql.strip()
        return fn

    return register


@_query()
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(table(spark, sf_dir, "documents"))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > OVER_LIMIT).alias("over_limit"))


@_query(
    """
WITH k AS (
  SELECT conv_id, CAST(floor(turn / 64.0) AS BIGINT) AS part, turn, role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL AND role IS NOT NULL),
s AS (SELECT DISTINCT conv_id, role AS speaker FROM k WHERE role <> 'system'),
v AS (
  SELECT k.*, speaker, '<|im_start|>'
    || CASE WHEN role = 'system' THEN 'system' WHEN role = speaker THEN 'assistant' ELSE 'user name=' || role END
    || chr(10) || text || '<|im_end|>' || chr(10) AS piece,
    CASE WHEN role = speaker THEN length(text) + 11 ELSE 0 END AS learn
  FROM k JOIN s USING (conv_id)),
o AS (
  SELECT *, sum(length(piece)) OVER w AS stop, row_number() OVER w AS rn FROM v
  WINDOW w AS (PARTITION BY conv_id, speaker ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING))
SELECT conv_id, speaker, part, count(*) AS n_turns, CAST(min(stop - length(piece)) AS BIGINT) AS start,
  string_agg(piece, '' ORDER BY rn) AS text,
  coalesce(string_agg(CASE WHEN learn > 0 THEN CAST(stop - learn AS VARCHAR) || ':' || CAST(stop AS VARCHAR) END, ',' ORDER BY rn), '') AS mask
FROM o GROUP BY conv_id, speaker, part
"""
)
def op2_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.perspectives(table(spark, sf_dir, "conversations"))


@_query()
def op3_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_model.train(docs, table(spark, sf_dir, "labels"))
    return quality_model.scores(docs, model)


def trusted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the documents marked as good: the trusted target of operator 4."""
    return table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")


@_query()
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.rules(table(spark, sf_dir, "documents"), trusted_ids(spark, sf_dir))


@_query()
def op5_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_ids.round_trip(table(spark, sf_dir, "documents"))


_WORDS_SQL = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


@_query(
    f"""
WITH d AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
b AS (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark),
grams AS (
  SELECT item_id, len(w) AS k, w AS gram FROM b WHERE len(w) BETWEEN 1 AND 9
  UNION ALL
  SELECT item_id, 10, w[i:i + 9] FROM (SELECT item_id, w, unnest(range(1, len(w) - 8)) AS i FROM b WHERE len(w) >= 10)),
sizes AS (SELECT DISTINCT k FROM grams),
spots AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes WHERE len(w) >= k),
found AS (
  SELECT DISTINCT doc_id, i, spots.k, item_id FROM spots JOIN grams ON grams.k = spots.k AND w[i:i + spots.k - 1] = gram),
words AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS s
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(words.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(items.s, '')) AS items_sha256,
  coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
)
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query()
def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


@_query()
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_texts(table(spark, sf_dir, "documents"))


@_query()
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


@_query()
def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_texts(table(spark, sf_dir, "pages"))


@_query(
    """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, CAST(length(coalesce(text, '')) AS BIGINT) AS n,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
k AS (
  SELECT doc_id, t, n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS c1, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS c2,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
        OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
      WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
p AS (
  SELECT doc_id, t, n, form, least(c1, c2) AS a, greatest(c1, c2) AS b FROM k),
s AS (
  SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1) AS suffix FROM p)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM s
"""
)
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digests(table(spark, sf_dir, "documents"))


@_query()
def op12_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.digests(table(spark, sf_dir, "documents"))


@_query(
    """
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS own, length(regexp_replace(t, '[^A-Z]+', '', 'g')) AS upper,
    min(doc_id) OVER (PARTITION BY t) AS first_id FROM d),
m AS (
  SELECT doc_id, part, concat(
    CASE WHEN len(own) < 50 THEN 'A' ELSE '' END,
    CASE WHEN 100 * len(list_distinct(own)) < 65 * len(own) THEN 'B' ELSE '' END,
    CASE WHEN 100 * upper > 5 * length(t) THEN 'C' ELSE '' END,
    CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END,
    CASE WHEN doc_id > first_id THEN 'E' ELSE '' END) AS mask FROM w),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
c AS (
  SELECT part, mask, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, count(*) AS n
  FROM m LEFT JOIN l USING (doc_id) GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
o AS (
  SELECT x1.f || x2.f || x3.f || x4.f || x5.f AS filter_order FROM x x1, x x2, x x3, x x4, x x5
  WHERE len(list_distinct([x1.f, x2.f, x3.f, x4.f, x5.f])) = 5),
s AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step:step] AS f, filter_order[1:step - 1] AS before
  FROM o, (SELECT unnest(range(1, 6)) AS step)),
r AS (
  SELECT part, filter_order, step, f, n, good, toxic, mask, contains(mask, f) AS fails, translate(mask, before, '') <> mask AS gone FROM s, c),
t AS (
  SELECT part, filter_order, step, f,
    sum(CASE WHEN NOT fails AND NOT gone THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN fails AND gone THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = f THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN fails AND NOT gone AND good = 1 THEN n ELSE 0 END) AS good_lost,
    sum(CASE WHEN fails AND NOT gone AND toxic = 1 THEN n ELSE 0 END) AS toxic_lost
  FROM r GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM t
"""
)
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
