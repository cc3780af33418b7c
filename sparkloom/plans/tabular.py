"""Cleaning and reshaping of cells."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean, ranks, text
from ..operators import relational, reshape
from .registry import query, strip_sql


@query("SELECT DISTINCT unnest(string_split(p_name, ' ')) AS tag FROM part ORDER BY tag")
def split_explode_tags(t):
    return relational.distinct_parts(t("part"), "p_name", "tag", " ").orderBy("tag")


def _terms(t):
    o = t("orders")
    kind = F.col("o_orderkey") % 4
    terms = F.when(kind == 3, F.col("o_orderpriority")).otherwise(F.concat_ws("；", "o_orderpriority", F.lit(" "), "o_orderstatus"))
    deadlines = F.when(kind == 0, "12-1, 3-1").when(kind == 1, "12-1").otherwise("1-5、2-5，3-5")
    return o.select("o_orderkey", terms.alias("terms_start"), deadlines.alias("deadline"), F.col("o_orderstatus").alias("more_info"))


_TERMS_SQL = """t AS (SELECT o_orderkey, o_orderpriority AS p, o_orderstatus AS s, o_orderkey % 4 AS k,
  CASE o_orderkey % 4 WHEN 0 THEN '12-1, 3-1' WHEN 1 THEN '12-1' ELSE '1-5、2-5，3-5' END AS deadline FROM orders)"""


@query(f"""WITH {_TERMS_SQL}
SELECT o_orderkey, p AS terms_start, CASE WHEN k = 0 THEN '12-1' ELSE deadline END AS deadline FROM t
UNION ALL SELECT o_orderkey, s, CASE WHEN k = 0 THEN '3-1' ELSE deadline END FROM t WHERE k <> 3""")
def split_pairwise(t):
    return reshape.explode_terms(_terms(t)).select("o_orderkey", "terms_start", "deadline")


@query(f"""WITH {_TERMS_SQL}
SELECT o_orderkey, p AS terms_start FROM t UNION ALL SELECT o_orderkey, s FROM t WHERE k <> 3""")
def split_terms_only(t):
    return reshape.explode_terms_only(_terms(t)).select("o_orderkey", "terms_start")


@query(f"""WITH {_TERMS_SQL}
SELECT o_orderkey, CASE WHEN k IN (0, 1) THEN '12-1' ELSE '1-5' END AS deadline,
  CASE k WHEN 0 THEN s || chr(10) || '- Additional deadlines: 3-1' WHEN 1 THEN s ELSE s || chr(10) || '- Additional deadlines: 2-5; 3-5' END AS more_info FROM t""")
def keep_first_deadline(t):
    return reshape.keep_first_deadline(_terms(t)).select("o_orderkey", "deadline", "more_info")


@query(rf"""WITH p AS (SELECT doc_id, source, list_filter(list_transform(regexp_split_to_array(text, '[、，；,;]+'), lambda x: {strip_sql("x")}), lambda x: x <> '') AS parts FROM documents)
SELECT doc_id, md5(CASE WHEN len(parts) > 1 THEN parts[1] ELSE (SELECT text FROM documents d WHERE d.doc_id = p.doc_id) END) AS first_md5,
  CASE WHEN len(parts) > 1 THEN len(parts) - 1 ELSE 0 END AS n_rest, md5(array_to_string(parts[2:], '; ')) AS rest_md5 FROM p""")
def keep_first_append_rest(t):
    """The first comma-separated part of whole texts, and what is left."""
    parts = text.split_list("text")
    first = F.when(F.size("parts") > 1, F.get("parts", F.lit(0))).otherwise(F.col("text"))
    return t("documents").withColumn("parts", parts).select("doc_id", F.md5(first.cast("binary")).alias("first_md5"), F.greatest(F.size("parts") - 1, F.lit(0)).cast("long").alias("n_rest"), F.md5(F.array_join(F.slice("parts", 2, 1 << 30), "; ").cast("binary")).alias("rest_md5"))


@query("SELECT o_orderkey, CASE WHEN regexp_full_match(o_custkey::VARCHAR, '[0-9]{4}') THEN o_custkey::VARCHAR ELSE '' END AS ets_code FROM orders")
def code_validate(t):
    return t("orders").select("o_orderkey", clean.ets_code(F.col("o_custkey").cast("string")).alias("ets_code"))


@query(r"SELECT doc_id, TRY_CAST(nullif(regexp_extract(regexp_replace(text, '[,$]|美元', '', 'g'), '(\d+(?:\.\d+)?)', 1), '') AS DOUBLE) AS first_number FROM documents")
def decimal_clean(t):
    return t("documents").select("doc_id", clean.decimal("text").alias("first_number"))


def _fee_text():
    price = F.col("p_size").cast("string")
    return F.when(F.col("p_partkey") % 5 == 0, F.concat(F.lit("$1,0"), price)).when(F.col("p_partkey") % 5 == 1, F.concat(F.lit("USD 0"), price, F.lit(".50"))).when(F.col("p_partkey") % 5 == 2, F.concat(F.lit("费用"), price, F.lit("美元"))).when(F.col("p_partkey") % 5 == 3, F.col("p_name")).otherwise("")


_FEE_SQL = r"""f AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN '$1,0' || p_size WHEN 1 THEN 'USD 0' || p_size || '.50' WHEN 2 THEN '费用' || p_size || '美元' WHEN 3 THEN p_name ELSE '' END AS t FROM part),
g AS (SELECT *, trim(regexp_replace(t, '[,$€£¥]|usd|USD', '', 'g')) AS plain, nullif(regexp_extract(t, '(\d+(?:\.\d+)?)', 1), '') AS first FROM f)"""


@query(rf"""WITH {_FEE_SQL}
SELECT p_partkey,
  CASE WHEN t = '' THEN '' WHEN regexp_full_match(plain, '[0-9]+(\.[0-9]+)?') THEN coalesce(nullif(ltrim(plain, '0'), ''), '0') WHEN first IS NULL THEN '' ELSE coalesce(nullif(ltrim(first, '0'), ''), '0') END AS fee,
  CASE WHEN t = '' OR regexp_full_match(plain, '[0-9]+(\.[0-9]+)?') THEN '' WHEN first IS NOT NULL THEN 'Original application_fee_usd value corrected from ''' || t || '''.' ELSE 'Invalid application_fee_usd value: ' || t END AS note FROM g""")
def fee_clean(t):
    f = clean.fee(_fee_text())
    return t("part").select("p_partkey", f["value"].alias("fee"), f["note"].alias("note"))


def _date_text():
    k, d = F.col("o_orderkey") % 7, F.col("o_orderdate")
    f = lambda p: F.date_format(d, p)
    return (
        F.when(k == 0, f("M/d/yyyy")).when(k == 1, f("yyyyMMdd")).when(k == 2, f("yyyy-MM-dd"))
        .when(k == 3, F.concat(F.lit("秋季（"), f("M"), F.lit(" 月 "), f("d"), F.lit(" 日 – 12月 1 日）"))).when(k == 4, F.concat(F.lit("Sep "), f("d"))).when(k == 5, "Rolling").otherwise("N/A")
    )


@query("""SELECT o_orderkey, CASE o_orderkey % 7 WHEN 5 THEN 'Rolling' WHEN 6 THEN NULL
  WHEN 3 THEN '2025-' || strftime(o_orderdate, '%m-%d') WHEN 4 THEN '2025-09-' || strftime(o_orderdate, '%d') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS deadline FROM orders""")
def date_normalise(t):
    return t("orders").select("o_orderkey", clean.date_text(_date_text()).alias("deadline"))


def _rank_text():
    k, n = F.col("p_partkey") % 6, F.col("p_size")
    return F.when(k == 0, F.concat(F.lit("="), n.cast("string"))).when(k == 1, F.concat(n.cast("string"), F.lit("-"), (n + 49).cast("string"))).when(k == 2, n.cast("string")).when(k == 3, "-").when(k == 4, F.concat(n.cast("string"), F.lit(".0"))).otherwise(F.concat(F.lit("1,"), F.lpad((n + 100).cast("string"), 3, "0"), F.lit("+")))


@query("SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN p_size::DOUBLE WHEN 1 THEN (p_size + p_size + 49) / 2.0::DOUBLE WHEN 2 THEN p_size::DOUBLE WHEN 4 THEN p_size::DOUBLE END AS rank FROM part")
def rank_clean_mid(t):
    return t("part").select("p_partkey", ranks.rank_middle(_rank_text()).alias("rank"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 6 IN (0, 1, 2) THEN p_size ELSE 9999 END AS rank FROM part")
def rank_parse_min(t):
    return t("part").select("p_partkey", ranks.rank_first(_rank_text()).alias("rank"))


@query("""SELECT n_nationkey, CASE WHEN n_nationkey % 4 = 3 THEN n_name || ', a, b, c' ELSE n_name END AS city, CASE WHEN n_nationkey % 4 IN (0, 3) THEN '' ELSE r_name END AS state, 'United States' AS country
FROM nation JOIN region ON n_regionkey = r_regionkey""")
def city_state_split(t):
    k = F.col("n_nationkey") % 4
    cell = F.when(k == 0, F.col("n_name")).when(k == 1, F.concat_ws(", ", "n_name", "r_name")).when(k == 2, F.concat_ws(", ", "n_name", "r_name", F.lit("x"))).otherwise(F.concat("n_name", F.lit(", a, b, c")))
    place = clean.city_state(cell)
    rows = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).withColumn("p", place)
    return rows.select("n_nationkey", "p.city", "p.state", clean.country("p.state").alias("country"))


@query("""SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'now' WHEN '2-HIGH' THEN 'soon' WHEN '3-MEDIUM' THEN 'later' ELSE 'unknown' END AS label,
  CASE o_orderstatus WHEN 'F' THEN 'Fall' WHEN 'O' THEN 'Spring' ELSE o_orderstatus END AS term FROM orders""")
def keyword_map_first_hit(t):
    label = text.first_mapped("o_orderpriority", [("urgent", "now"), ("HIGH", "soon"), ("medium", "later")], F.lit("unknown"))
    term = clean.term(F.replace(F.replace("o_orderstatus", F.lit("F"), F.lit("秋季")), F.lit("O"), F.lit("in SPRING")))
    return t("orders").select("o_orderkey", label.alias("label"), term.alias("term"))


@query("""SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'rolling' WHEN 1 THEN '12-15' ELSE '' END AS value,
  CASE o_orderkey % 5 WHEN 2 THEN 'More info about deadline. ' || o_orderpriority WHEN 3 THEN 'More info about deadline. ' || o_orderpriority ELSE '' END AS note FROM orders""")
def deadline_answers(t):
    k = F.col("o_orderkey") % 5
    answer = clean.deadline_answer(F.when(k == 0, " Rolling ").when(k == 1, "12-15").when(k == 2, F.concat(F.lit("info: "), "o_orderpriority")).when(k == 3, F.col("o_orderpriority")).otherwise(""))
    return t("orders").select("o_orderkey", answer["value"].alias("value"), answer["note"].alias("note"))


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '3.5' WHEN 1 THEN CASE WHEN p_size <= 4 THEN p_size::VARCHAR ELSE '' END WHEN 2 THEN '' ELSE '4.0' END AS gpa,
  CASE p_partkey % 4 WHEN 0 THEN '3.5' WHEN 1 THEN regexp_extract(p_size::VARCHAR || '/100', '([0-4])', 1) WHEN 2 THEN '' ELSE '4.0' END AS gpa_compat FROM part""")
def gpa_least(t):
    k = F.col("p_partkey") % 4
    cell = F.when(k == 0, "at least 3.5 / 4.0").when(k == 1, F.concat(F.col("p_size").cast("string"), F.lit("/100"))).when(k == 2, "均分 3.5").otherwise("GPA4.0")
    return t("part").select("p_partkey", clean.least_gpa(cell).alias("gpa"), clean.least_gpa(cell, compat=True).alias("gpa_compat"))


@query("""SELECT c_custkey,
  CASE WHEN c_custkey % 5 = 0 THEN 'Optional' WHEN c_custkey % 5 = 1 THEN 'Not needed' WHEN c_custkey % 5 = 2 THEN 'Required' ELSE 'Unknown' END AS interview,
  CASE c_custkey % 3 WHEN 0 THEN 'Not Applicable' WHEN 1 THEN 'Applicable' ELSE 'Unknown' END AS waiver,
  CASE c_custkey % 3 WHEN 0 THEN 'Applicable' WHEN 1 THEN 'Applicable' ELSE 'Unknown' END AS waiver_compat,
  CASE c_custkey % 3 WHEN 0 THEN 'Non-Professional' WHEN 1 THEN 'Professional' ELSE 'Unknown' END AS professional,
  CASE c_custkey % 3 WHEN 0 THEN 'Professional' WHEN 1 THEN 'Professional' ELSE 'Unknown' END AS professional_compat,
  CASE c_custkey % 2 WHEN 0 THEN c_custkey::VARCHAR ELSE 'no explicit demand' END AS letters,
  CASE c_custkey % 2 WHEN 0 THEN '' ELSE c_mktsegment END AS tags FROM customer""")
def option_fields(t):
    k5, k3, k2 = F.col("c_custkey") % 5, F.col("c_custkey") % 3, F.col("c_custkey") % 2
    waiver = F.when(k3 == 0, "it is not applicable").when(k3 == 1, "Applicable").otherwise("")
    kind = F.when(k3 == 0, "非职业项目").when(k3 == 1, "专业硕士").otherwise("x")
    return t("customer").select(
        "c_custkey",
        clean.interview(F.when(k5 == 1, " ").when(k5 == 2, "is required").otherwise("?"), F.when(k5 == 0, "Ph.D. track").otherwise("MS")).alias("interview"),
        clean.fee_waiver(waiver).alias("waiver"), clean.fee_waiver(waiver, compat=True).alias("waiver_compat"),
        clean.professional(kind).alias("professional"), clean.professional(kind, compat=True).alias("professional_compat"),
        clean.letters(F.when(k2 == 0, F.concat(F.col("c_custkey").cast("string"), F.lit("封")))).alias("letters"),
        clean.tags(F.when(k2 == 0, "需要额外确认: x").otherwise(F.concat(F.lit(" "), "c_mktsegment"))).alias("tags"),
    )


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN [split_part(p_name, ' ', 1), split_part(p_name, ' ', 2)] WHEN 1 THEN ['Data Science'] ELSE [p_name] END AS majors FROM part""")
def majors_from_stem(t):
    k = F.col("p_partkey") % 3
    stem = F.when(k == 0, F.concat(F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("(2025)"))).when(k == 1, "数据-2025").otherwise(F.col("p_name"))
    return t("part").select("p_partkey", clean.majors(stem).alias("majors"))


@query(r"""SELECT page_id, regexp_replace(regexp_replace(url, '^https?://', ''), '/+$', '') AS website,
  regexp_replace(regexp_replace(url, '^[htps:/]+', ''), '/+$', '') AS website_compat FROM pages""")
def website_clean(t):
    return t("pages").select("page_id", clean.website("url").alias("website"), clean.website("url", compat=True).alias("website_compat"))


@query(r"""SELECT p_partkey, 'qs_2026_' || replace(p_name, ' ', '_') || '_and_x_rank' AS slug FROM part""")
def slug_columns(t):
    return t("part").select("p_partkey", text.subject_column(F.concat("p_name", F.lit(" & (x)."))).alias("slug"))


@query(r"""SELECT page_id, CASE WHEN u = '' THEN 'unknown' ELSE u END AS file_name FROM (
  SELECT page_id, substr(regexp_replace(regexp_replace(regexp_replace(url, '[^\p{L}\p{N}_\s\-]', '', 'g'), '[-\s]+', '_', 'g'), '^_+|_+$', '', 'g'), 1, 50) AS u FROM pages)""")
def filename_sanitize(t):
    return t("pages").select("page_id", text.file_name("url").alias("file_name"))


@query(r"""SELECT doc_id, md5(x) AS prepared_md5, length(x) AS n_chars FROM (
  SELECT doc_id, lower(trim(regexp_replace(regexp_replace(replace(text, '[HEADING]', ''), '[^\p{L}\p{N}_\s]', ' ', 'g'), '\s+', ' ', 'g'))) AS x FROM documents) WHERE length(x) > 10""")
def text_preprocess(t):
    rows = t("documents").select("doc_id", text.classifier_text("text").alias("x")).where(F.length("x") > 10)
    return rows.select("doc_id", F.md5(F.col("x").cast("binary")).alias("prepared_md5"), F.length("x").cast("long").alias("n_chars"))


@query("""SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k FROM events""")
def json_props(t):
    return t("events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("""SELECT conv_id, turn, role, length(text) AS n FROM conversations WHERE role = 'user'""")
def nested_items(t):
    nested = reshape.nest(t("conversations"), ["conv_id"], "turns", ["turn"], ["role", "text"])
    return reshape.flatten_nested(nested, "turns", ["conv_id"]).where("role = 'user'").select("conv_id", "turn", "role", F.length("text").cast("long").alias("n"))


@query("""SELECT doc_id, 'Document ' || doc_id || ' (' || lang || ') from ' || source AS prompt FROM documents""")
def prompt_build(t):
    from ..operators.enrich import prompt

    return t("documents").select("doc_id", prompt("Document {doc_id} ({lang}) from {source}", ["doc_id", "lang", "source"]).alias("prompt"))


@query("""SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey >= 100 AND o_orderkey < 400""")
def slice_rows(t):
    return reshape.slice_rows(t("orders"), "o_orderkey", 100, 400).select("o_orderkey", "o_custkey")


@query("""SELECT doc_id, lang FROM documents ORDER BY md5('42:' || doc_id) LIMIT 50""")
def sample_n(t):
    return reshape.sample_rows(t("documents"), "doc_id", 50).select("doc_id", "lang")


@query("SELECT s_suppkey, s_name AS name, s_acctbal AS balance FROM supplier")
def nested_projection(t):
    return reshape.nested(t("supplier"), "lookup", {"name": "s_name", "balance": "s_acctbal", "missing": "no_such"}).select("s_suppkey", "lookup.*")


@query("""SELECT o_orderkey, i - 1 AS position, CASE i WHEN 1 THEN split_part(o_orderpriority, '-', 1) ELSE split_part(o_orderpriority, '-', 2) END AS left_part, CASE i WHEN 1 THEN o_orderstatus END AS right_part
FROM orders, (SELECT unnest([1, 2]) AS i)""")
def zip_positions(t):
    rows = t("orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    out = reshape.zip_explode(rows, F.split("o_orderpriority", "-"), F.array("o_orderstatus"), ("left_part", "right_part"))
    return out.select("o_orderkey", "position", "left_part", "right_part")
