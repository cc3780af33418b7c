"""Queries over the corpus tables: each applies one operator to its whole table, with its production parameters."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, html_text, langid, mixing, phrases, quality, secrets, simhash, spelling, suffix_dedup, syncmers, tokens
from .runtime import small_batches, table

#: Folder of the vocabulary files; each executor reads it at this path.
TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest columns, and the ranges that go and the text that is left (without the characters that a cut parts)."""
    small_batches(spark)
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), length=400, with_text=True)
    return out.withColumnRenamed("kept", "text")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    out = html_text.extract(table(spark, sf_dir, "pages"), keep=["page_id", "url"])
    return out.withColumn("n_chars", F.length("text").cast("long"))


def op3_token_counts(spark: SparkSession, sf_dir: str, tokenizers: str | None = None) -> DataFrame:
    small_batches(spark)
    return tokens.count_tokens(table(spark, sf_dir, "documents"), f"{tokenizers or TOKENIZERS}/piece_bpe_32k.model", keep=["doc_id"])


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~langid.held_out("doc_id")))
    out = langid.identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", langid.held_out("doc_id").alias("held_out"), "lang_pred", "score", "rejected")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source to the same weight, as many characters out as in."""
    mixed = mixing.replicate(table(spark, sf_dir, "documents"))
    return mixed.withColumn("rate", F.round("rate", 9))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.hit_words(docs, table(spark, sf_dir, "benchmark")).drop("text", "items")


def op8_chat_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(table(spark, sf_dir, "conversations"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return quality.judge(table(spark, sf_dir, "documents"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(table(spark, sf_dir, "documents"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the documents, of which a 199th of the (document, word) pairs is misspelt."""
    return spelling.variants(table(spark, sf_dir, "documents"), drop_of=199)


def op13_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.edited_report(table(spark, sf_dir, "documents"))


QUERIES = (op1_suffix_dedup, op2_html_extraction, op3_token_counts, op4_language_id, op5_simhash, op6_mixing, op7_decontamination, op8_chat_collapse, op9_secret_scan, op10_quality_rules, op11_phrases, op12_spelling, op13_syncmers)


def queries() -> dict:
    return {f.__name__: f for f in QUERIES}


OP6_SQL = r"""
WITH sizes AS (
  SELECT coalesce(source, '') AS source_key, coalesce(sum(length(text)), 0)::BIGINT AS chars,
         CASE WHEN coalesce(sum(length(text)), 0) > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS weight
  FROM documents GROUP BY 1),
rates AS (
  SELECT source_key,
    CASE WHEN sum(chars) OVER () = 0 THEN 1.0::DOUBLE
         WHEN chars > 0 THEN 1.0::DOUBLE * weight / sum(weight) OVER () * (sum(chars) OVER ())::DOUBLE / chars::DOUBLE
         ELSE 0.0::DOUBLE END AS rate
  FROM sizes),
cdf AS (
  SELECT source_key, rate, k,
    sum(CASE WHEN rate > 0 THEN exp(k * ln(rate) - rate - lgamma(k + 1)) WHEN k = 0 THEN 1.0 ELSE 0.0 END) OVER (PARTITION BY source_key ORDER BY k) AS c
  FROM (SELECT source_key, rate, unnest(generate_series(0, CASE WHEN rate > 0 THEN ceil(rate + 10 * sqrt(rate) + 30)::BIGINT ELSE 0 END)) AS k FROM rates)),
counted AS (
  SELECT d.doc_id, any_value(c.rate) AS rate, count(*) AS n
  FROM documents d JOIN cdf c ON c.source_key = coalesce(d.source, '')
   AND c.c < (('0x' || substr(md5('count17:' || coalesce(d.doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0
  GROUP BY d.doc_id)
SELECT d.*, round(x.rate, 9) AS rate, r.replica::INT AS replica,
       md5('order17:' || coalesce(d.doc_id::VARCHAR, '') || ':' || r.replica) AS shuffle_key
FROM documents d JOIN counted x ON x.doc_id = d.doc_id, LATERAL (SELECT unnest(generate_series(0, x.n - 1)) AS replica) r
"""

OP7_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
places AS (SELECT item_id, w, least(13, len(w)) AS k, unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) AS i FROM b WHERE len(w) > 0),
patterns AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS s FROM places),
windows AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM d, (SELECT DISTINCT k FROM patterns) WHERE len(w) >= k)),
hits AS (SELECT doc_id, i, k, item_id FROM windows JOIN patterns USING (k, s)),
counts AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, sha256(array_to_string(list_sort(list(DISTINCT item_id::VARCHAR)), ',')) AS items_sha256 FROM hits GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN counts USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP8_SQL = r"""
WITH named AS (
  SELECT conv_id, list({'r': role, 't': text} ORDER BY turn NULLS FIRST, role NULLS FIRST, text) AS turns,
         string_agg('<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text) AS rendered
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
convs AS (
  SELECT * FROM named UNION ALL
  SELECT NULL, [{'r': role, 't': text}], '<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10) FROM conversations WHERE conv_id IS NULL),
firsts AS (SELECT turns, min(conv_id) AS conv_id, any_value(rendered) AS rendered, count(*) AS n_equal FROM convs GROUP BY turns)
SELECT conv_id, len(turns)::BIGINT AS n_turns, n_equal, rendered
FROM firsts a
WHERE NOT EXISTS (SELECT 1 FROM firsts b WHERE len(b.turns) > len(a.turns) AND b.turns[1] = a.turns[1] AND list_slice(b.turns, 1, len(a.turns)) = a.turns)
"""

OP10_SQL = r"""
WITH w AS (
  SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS s
  FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 7)) AS i FROM w WHERE len(words) >= 8)),
repeated AS (
  SELECT doc_id, count(DISTINCT i + j) AS n FROM (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM windows) x, (SELECT unnest(generate_series(0, 7)) AS j) o
  WHERE c > 1 GROUP BY doc_id),
lines AS (
  SELECT doc_id, source, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS words
  FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM w)),
full_lines AS (
  SELECT doc_id, coalesce('=' || source, '') AS host, line, len(words) AS n,
         regexp_replace(translate(array_to_string(words, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9]', '0', 'g') AS plain
  FROM lines WHERE len(words) > 0),
dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM full_lines GROUP BY doc_id),
hosts AS (SELECT coalesce('=' || source, '') AS host, count(*) AS n_docs FROM documents GROUP BY 1),
common AS (
  SELECT host, plain FROM (SELECT host, plain, count(DISTINCT doc_id) AS n FROM full_lines GROUP BY 1, 2) JOIN hosts USING (host)
  WHERE n > 20 OR n >= 3 AND n > 0.1 * n_docs),
lost AS (SELECT doc_id, sum(n) AS n FROM full_lines JOIN common USING (host, plain) GROUP BY doc_id),
base AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(dups.n, 0)::BIGINT AS n_dup_lines, coalesce(repeated.n, 0)::BIGINT AS n_repeat_words, coalesce(lost.n, 0)::BIGINT AS n_common_words
  FROM w LEFT JOIN dups USING (doc_id) LEFT JOIN repeated USING (doc_id) LEFT JOIN lost USING (doc_id))
SELECT *, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND n_words - n_common_words >= 20 AND n_words - n_common_words >= 0.5 * n_words AS kept
FROM base
"""

OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS a
  FROM (SELECT lang, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM pieces, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k) GROUP BY ALL),
totals AS (SELECT lang, sum(a)::BIGINT AS n FROM grams WHERE k = 1 GROUP BY lang),
cands AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM grams WHERE k > 1 AND a >= 10),
cuts AS (
  SELECT c.lang, c.k, c.phrase, c.a, j, x.a AS l, y.a AS r, (1000000::HUGEINT * c.a * c.a // (x.a::HUGEINT * y.a))::BIGINT AS score
  FROM (SELECT *, unnest(generate_series(1, k - 1)) AS j FROM cands) c
  JOIN grams x ON x.lang = c.lang AND x.k = j AND x.phrase = array_to_string(c.w[1:j], ' ')
  JOIN grams y ON y.lang = c.lang AND y.k = c.k - j AND y.phrase = array_to_string(c.w[j + 1:], ' ')),
least AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS nth FROM cuts),
holders AS (
  SELECT lang, phrase, max(a) AS a FROM (
    SELECT lang, a, array_to_string(w[1:2], ' ') AS phrase FROM cands WHERE k = 3 UNION ALL SELECT lang, a, array_to_string(w[2:3], ' ') FROM cands WHERE k = 3) GROUP BY ALL),
ranked AS (
  SELECT c.lang, row_number() OVER (PARTITION BY c.lang ORDER BY score DESC, c.a DESC, encode(c.phrase)) AS rank, c.phrase, c.a, l, r, score
  FROM least c LEFT JOIN holders h ON h.lang = c.lang AND h.phrase = c.phrase AND c.k = 2 WHERE nth = 1 AND NOT coalesce(100 * h.a >= 50 * c.a, false))
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    """The other operators have no equivalent in SQL: their tests compare them with brute force."""
    return {"op6_mixing": OP6_SQL, "op7_decontamination": OP7_SQL, "op8_chat_collapse": OP8_SQL, "op10_quality_rules": OP10_SQL, "op11_phrases": OP11_SQL}
