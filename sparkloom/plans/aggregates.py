"""Counts, dimensions, ordered groups, votes and steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import relational, stats
from ..operators.enrich import echo, enrich_distinct
from ..streaming.pages import windowed_events
from .registry import query

_NAME = "CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 7 = 1 THEN '' WHEN doc_id % 7 = 2 THEN '  ' ELSE ' ' || lang || doc_id % 11 END"


def _named(t):
    k = F.col("doc_id") % 7
    name = F.when(k == 0, None).when(k == 1, "").when(k == 2, "  ").otherwise(F.concat(F.lit(" "), "lang", (F.col("doc_id") % 11).cast("string")))
    return t("documents").select("doc_id", "source", "lang", name.alias("name"))


@query(f"""WITH d AS (SELECT source, {_NAME} AS name FROM documents)
SELECT source AS category, count(*) AS total, count(*) FILTER (trim(coalesce(name, '')) <> '') AS with_name, count(*) FILTER (coalesce(name, '') = '') AS without_name,
  count(*) FILTER (coalesce(name, '') <> '' AND trim(name) = '') AS empty_name, count(DISTINCT nullif(trim(name), '')) AS unique_names
FROM d GROUP BY ROLLUP(source)""")
def extraction_stats(t):
    return stats.extraction_stats(_named(t), "source", "name")


@query(f"""WITH d AS (SELECT lang, trim({_NAME}) AS name FROM documents) SELECT lang, list_sort(list(DISTINCT name)) AS names FROM d WHERE name <> '' GROUP BY lang""")
def collect_by_category(t):
    return stats.names_by_category(_named(t), "lang", "name")


@query("SELECT o_custkey, min(o_orderkey) AS o_orderkey, arg_min(o_orderpriority, o_orderkey) AS o_orderpriority FROM orders GROUP BY o_custkey")
def first_seen_per_key(t):
    return relational.first_seen(t("orders"), ["o_custkey"], "o_orderkey").select("o_custkey", "o_orderkey", "o_orderpriority")


@query("""SELECT DISTINCT c_mktsegment AS city, n_name AS state_province, r_name AS country_region FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def distinct_geo(t):
    rows = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = rows.select(F.col("c_mktsegment").alias("city"), F.col("n_name").alias("state_province"), F.col("r_name").alias("country_region"))
    return relational.geography(rows)["cities"]


@query(f"""WITH d AS (SELECT source, lang, {_NAME} AS name FROM documents)
SELECT field, filled, total, round(filled / greatest(total, 1) * 100, 4) AS rate FROM (
  SELECT unnest([{{'field': 'source', 'filled': count(*) FILTER (source <> '')}}, {{'field': 'lang', 'filled': count(*) FILTER (lang <> '')}}, {{'field': 'name', 'filled': count(*) FILTER (name <> '')}}], recursive := true), count(*) AS total FROM d)""")
def completion_rates(t):
    return stats.completion(_named(t), ["source", "lang", "name"])


_STEP_SQL = """WITH e AS (SELECT *, (row_number() OVER (ORDER BY event_id) - 1) // 64 + 1 AS step FROM events)"""


@query(_STEP_SQL + """
SELECT step, count(*) FILTER (event_type = 'purchase')::BIGINT AS total_correct, count(*) AS possible_correct, count(*) FILTER (event_type = 'purchase') / count(*) AS accuracy,
  round(avg(k), 6) AS avg_length, median(k) AS median_length
FROM (SELECT *, json_extract_string(props, '$.k')::INT AS k FROM e) GROUP BY step""")
def step_metrics(t):
    """Every 64 events one step: rate, mean and median."""
    return _steps(t).withColumn("avg_length", F.round("avg_length", 6))


def _steps(t):
    rows = relational.group_rows(t("events"), "event_id", 64)
    rows = rows.withColumn("lengths", F.array(F.get_json_object("props", "$.k").cast("int")))
    return stats.step_metrics(rows, "step", "lengths", (F.col("event_type") == "purchase").cast("long"))


@query(_STEP_SQL + """, m AS (SELECT step, count(*) FILTER (event_type = 'purchase') / count(*) AS accuracy FROM e GROUP BY step)
SELECT round(regr_slope(accuracy, step), 6) AS slope, round(regr_intercept(accuracy, step), 6) AS intercept, round(avg(accuracy), 6) AS mean, round(arg_max(accuracy, step), 6) AS final FROM m""")
def step_trend(t):
    out = stats.trend(_steps(t), "step", "accuracy")
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@query("""SELECT event_id, last_value(CASE WHEN event_type = 'view' THEN value END IGNORE NULLS) OVER w AS last_view, last_value(CASE WHEN event_type = 'error' THEN event_id END IGNORE NULLS) OVER w AS last_error
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)""")
def log_state_pairing(t):
    marks = {"last_view": F.when(F.col("event_type") == "view", F.col("value")), "last_error": F.when(F.col("event_type") == "error", F.col("event_id"))}
    return relational.carry_forward(t("events"), marks, "event_id", ["user_id"]).select("event_id", *marks)


@query("""SELECT event_id, sum(CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN -1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id)::BIGINT AS outstanding FROM events""")
def running_counter(t):
    delta = F.when(F.col("event_type") == "view", 1).when(F.col("event_type") == "click", -1).otherwise(0)
    return relational.running_sum(t("events"), delta, "event_id", ["user_id"]).select("event_id", "outstanding")


@query("""SELECT event_id, round(row_number() OVER (PARTITION BY user_id ORDER BY event_id) / count(*) OVER (PARTITION BY user_id) * 100, 4) AS progress_pct FROM events""")
def progress_pct(t):
    return relational.progress(t("events"), "event_id", ["user_id"]).select("event_id", "progress_pct")


@query("SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS position FROM events")
def row_positions(t):
    return relational.positions(t("events"), "event_id").select("event_id", "position")


@query("""WITH c AS (SELECT conv_id, role, length(text) % 3 AS vote, turn FROM conversations), n AS (SELECT conv_id, vote, count(*) AS n FROM c GROUP BY 1, 2)
SELECT n.conv_id, arg_min(vote, {'n': -n, 'v': vote}) AS majority, sum(n)::BIGINT AS n_votes, any_value(f.first_vote) AS first_vote
FROM n JOIN (SELECT conv_id, arg_min(vote, turn) AS first_vote FROM c GROUP BY 1) f USING (conv_id) GROUP BY n.conv_id""")
def majority_vote(t):
    rows = t("conversations").select("conv_id", "turn", (F.length("text") % 3).cast("long").alias("vote"))
    return stats.majority(rows, "conv_id", "vote", "turn")


@query("SELECT conv_id, bool_or(length(text) > 2000) AS any_positive FROM conversations GROUP BY conv_id")
def any_positive(t):
    return stats.any_positive(t("conversations"), "conv_id", F.length("text") > 2000)


@query("""SELECT d.doc_id, d.lang FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.quality IS NULL AND d.doc_id % 10 <> 0""")
def needs_label(t):
    rows = t("documents").join(t("labels"), "doc_id", "left").withColumn("is_root", F.col("doc_id") % 10 == 0)
    return stats.needs_label(rows, "is_root", "quality").select("doc_id", "lang")


@query("""SELECT o_orderpriority, count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS failed, count(*) FILTER (o_orderstatus <> 'F') AS completed, list_sort(list(o_orderkey) FILTER (o_orderstatus = 'F'))[:3] AS first_failed FROM orders GROUP BY o_orderpriority""")
def failures_by_category(t):
    """Counts, and the first three failed orders of all, for each priority."""
    out = stats.first_failures(t("orders"), ["o_orderpriority"], F.col("o_orderstatus") == "F", "o_orderkey")
    return out.select("o_orderpriority", "total", "failed", "completed", "first_failed")


@query("""SELECT o_orderpriority, count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS failed, count(*) FILTER (o_orderstatus <> 'F') AS completed, list_sort(list(o_orderkey) FILTER (o_orderstatus = 'F'))[:3] AS first_failed FROM orders GROUP BY o_orderpriority""")
def first_failures_by_category(t):
    out = stats.first_failures(t("orders"), ["o_orderpriority"], F.col("o_orderstatus") == "F", "o_orderkey")
    return out.select("o_orderpriority", "total", "failed", "completed", "first_failed")


@query("SELECT o_orderpriority, o_orderkey FROM orders WHERE o_orderstatus = 'F'")
def failed_items(t):
    return stats.failed_rows(t("orders"), F.col("o_orderstatus") == "F").select("o_orderpriority", "o_orderkey")


@query("""SELECT url_host AS project, count(*) AS total_pages, count(*) FILTER (ok) AS succeeded, count(*) FILTER (NOT ok) AS failed, round(count(*) FILTER (ok) / greatest(count(*), 1) * 100, 4) AS rate
FROM (SELECT regexp_extract(url, '^https?://([^/?#]+)', 1) AS url_host, length(html) > 3000 AS ok FROM pages) GROUP BY 1""")
def page_success_rates(t):
    rows = t("pages").select(F.try_parse_url("url", F.lit("HOST")).alias("project"), F.when(F.length("html") > 3000, "success").otherwise("error").alias("crawl_status"))
    return stats.page_counts(rows, "project", "crawl_status")


@query("""SELECT c_mktsegment, total, succeeded, failed, rate FROM (
  SELECT c_mktsegment, count(*) AS total, count(*) FILTER (c_acctbal > 1e9) AS succeeded, count(*) FILTER (NOT c_acctbal > 1e9) AS failed, round(count(*) FILTER (c_acctbal > 1e9) / count(*) * 100, 4) AS rate FROM customer GROUP BY 1) WHERE rate = 0""")
def zero_success(t):
    return stats.zero_success(stats.success_rate(t("customer"), ["c_mktsegment"], F.col("c_acctbal") > 1e9), "rate")


@query("SELECT 'orders' AS source, count(*) AS total, json_object('o_orderkey', min(o_orderkey), 'o_orderstatus', arg_min(o_orderstatus, o_orderkey))::VARCHAR AS sample_record FROM orders")
def processing_summary(t):
    return stats.processing_summary(t("orders").select("o_orderkey", "o_orderstatus"), "orders", "o_orderkey")


@query("""SELECT doc_id, source FROM documents WHERE doc_id < 300 UNION ALL
SELECT min(doc_id), source FROM documents WHERE doc_id >= 300 AND source NOT IN (SELECT source FROM documents WHERE doc_id < 300 AND source IS NOT NULL) GROUP BY source""")
def merge_new_failures(t):
    rows = t("documents").select("doc_id", "source")
    return relational.merge_new(rows.where("doc_id < 300"), rows.where("doc_id >= 300"), ["source"], "doc_id")


@query("SELECT p_partkey, p_brand, 'Brand: ' || p_brand AS p_brand_en FROM part")
def enrich_distinct_values(t):
    return enrich_distinct(t("part").select("p_partkey", "p_brand"), "p_brand", "p_brand_en", echo, context="Brand").select("p_partkey", "p_brand", "p_brand_en")


@query("SELECT s_suppkey, s_acctbal FROM supplier ORDER BY s_acctbal DESC, s_suppkey LIMIT 20")
def top_n(t):
    return relational.top(t("supplier"), "s_acctbal", 20, "s_suppkey").select("s_suppkey", "s_acctbal")


@query("SELECT greatest(count(*) - 50, 0) AS more FROM supplier")
def overflow_count(t):
    return relational.top_with_rest(t("supplier"), ["s_suppkey"], 50)[1]


@query("""SELECT o_custkey, o_orderkey, rank FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey)::INT AS rank FROM orders) WHERE rank <= 3""")
def top_per_key(t):
    return stats.ranked_within(t("orders"), ["o_custkey"], [F.desc("o_totalprice"), "o_orderkey"], 3).select("o_custkey", "o_orderkey", "rank")


@query("SELECT c_custkey AS key FROM customer UNION ALL SELECT s_suppkey FROM supplier")
def union_files(t):
    return t("customer").select(F.col("c_custkey").alias("key")).unionByName(t("supplier").select(F.col("s_suppkey").alias("key")))


@query("SELECT lang, word, n FROM (SELECT lang, word, count(*) AS n, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, word) AS rn FROM (SELECT lang, unnest(regexp_extract_all(lower(text), '[\\p{L}]+')) AS word FROM documents) GROUP BY lang, word) WHERE rn <= 20")
def topk_tokens(t):
    """The 20 most frequent words of each language."""
    words = t("documents").select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), 0)).alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n"))
    return stats.ranked_within(words, ["lang"], [F.desc("n"), "word"], 20).select("lang", "word", "n")


@query("SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def windowed_counts(t):
    """The streaming aggregate of events, run over a finished table."""
    return windowed_events(t("events")).select(F.col("w.start").alias("hour"), "event_type", "n", F.round("total", 4).alias("total"))
