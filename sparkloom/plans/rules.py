"""Rules as tables: names found by keywords and gaps, URL paths judged by a trie, rows that break rules, folds by label."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import urls
from ..operators import checks, keywords, paths, scoring
from .registry import query

# names of three columns, and a rule for each first word and brand, for each last word (which asks for a type), and for each brand
_NAMES_SQL = """names AS (SELECT p_partkey, p_name || ' ' || p_brand || ' ' || p_type AS name, p_type AS qualifier FROM part),
rules AS (
  SELECT DISTINCT upper(split_part(p_name, ' ', 1)) || '.*' || p_brand AS pattern, NULL AS qualifier FROM part UNION ALL
  SELECT DISTINCT substr(split_part(p_name, ' ', 2), 2), p_type FROM part WHERE p_size > 48 UNION ALL
  SELECT DISTINCT p_brand || '.*' || substr(p_type, 3, 2) || '.*' || substr(p_type, 5), NULL FROM part)"""


@query(f"""WITH {_NAMES_SQL}
SELECT p_partkey, count(*) AS n_rules, min(pattern) AS first_pattern, count(r.qualifier) AS n_qualified
FROM names n JOIN rules r ON regexp_matches(lower(n.name), lower(r.pattern)) AND (r.qualifier IS NULL OR lower(r.qualifier) = lower(n.qualifier)) GROUP BY p_partkey""")
def keyword_patterns(t):
    """How many rules, of a table of them, find each part's full name, and the first one."""
    part = t("part")
    names = part.select("p_partkey", F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("name"), F.col("p_type").alias("qualifier"))
    word = lambda k: F.split_part("p_name", F.lit(" "), F.lit(k))
    rules = part.select(F.concat(F.upper(word(1)), F.lit(".*"), "p_brand").alias("pattern"), F.lit(None).cast("string").alias("qualifier"))
    rules = rules.union(part.where("p_size > 48").select(F.expr("substr(split_part(p_name, ' ', 2), 2)"), "p_type"))
    rules = rules.union(part.select(F.concat("p_brand", F.lit(".*"), F.substring("p_type", 3, 2), F.lit(".*"), F.expr("substr(p_type, 5)")), F.lit(None)))
    found = keywords.find(names, rules.distinct(), qualifier="qualifier")
    each = found.groupBy("name", "qualifier").agg(F.count("*").alias("n_rules"), F.min("pattern").alias("first_pattern"), F.count("rule_qualifier").alias("n_qualified"))
    return names.join(each, ["name", "qualifier"]).select("p_partkey", "n_rules", "first_pattern", "n_qualified")


_BRANDS = """brands AS (SELECT p_brand, min(p_name) AS least, max(p_name) AS most, max(p_type) AS last_type, min(p_type) AS first_type, max(p_size) AS size FROM part GROUP BY p_brand)"""


@query(f"""WITH {_BRANDS},
rules AS (
  SELECT p_brand AS query, 1 AS rule_no, 'exact' AS kind, upper(least) || CASE WHEN p_brand LIKE '%3' THEN '' ELSE 'x' END AS pattern, last_type AS country FROM brands UNION ALL
  SELECT p_brand, 2, 'keyword', substr(most, 3) || CASE WHEN p_brand LIKE '%1%' THEN '' ELSE 'x' END, first_type FROM brands UNION ALL
  SELECT p_brand, 3, 'regex', substr(least, 2, 2) || '.*' || substr(most, len(most) - 1), NULL FROM brands UNION ALL
  SELECT p_brand, 4, 'exact', most, NULL FROM brands),
hits AS (
  SELECT query, rule_no, kind, rules.country, p_partkey, p_name FROM rules JOIN part ON (rules.country IS NULL OR lower(rules.country) = lower(p_type)) AND
    CASE kind WHEN 'exact' THEN lower(p_name) = lower(pattern) WHEN 'keyword' THEN contains(lower(p_name), lower(pattern)) ELSE regexp_matches(lower(p_name), lower(pattern)) END)
SELECT query, CASE WHEN kind <> 'exact' THEN kind WHEN country IS NULL THEN 'exact' ELSE 'exact_with_country' END AS match_type, count(*) AS n_found, arg_min(p_name, p_partkey) AS target
FROM hits WHERE (query, rule_no) IN (SELECT (query, min(rule_no)) FROM hits GROUP BY query) GROUP BY query, kind, country""")
def keyword_targets(t):
    """Names with rules of their own: an equal name in a country, a keyword in a country, a pattern with a gap; the first that finds something."""
    part = t("part")
    b = part.groupBy("p_brand").agg(F.min("p_name").alias("least"), F.max("p_name").alias("most"), F.max("p_type").alias("last_type"), F.min("p_type").alias("first_type"))
    rule = lambda no, kind, pattern, country: F.struct(F.lit(no).alias("rule_no"), F.lit(kind).alias("kind"), pattern.alias("pattern"), country.cast("string").alias("country"))
    off = lambda like: F.when(F.col("p_brand").like(like), "").otherwise("x")
    rules = b.select(F.col("p_brand").alias("query"), F.inline(F.array(
        rule(1, "exact", F.concat(F.upper("least"), off("%3")), F.col("last_type")),
        rule(2, "keyword", F.concat(F.expr("substr(most, 3)"), off("%1%")), F.col("first_type")),
        rule(3, "regex", F.concat(F.substring("least", 2, 2), F.lit(".*"), F.expr("substr(most, length(most) - 1)")), F.lit(None)),
        rule(4, "exact", F.col("most"), F.lit(None)),
    )))
    return keywords.rule_targets(rules, part, names=("p_name",), country="p_type", order="p_partkey")


def _values(rows) -> str:
    return ", ".join("(" + ", ".join("'" + x.replace("'", "''") + "'" for x in r) + ")" for r in rows)


_LISTED = [(w, "deny") for words in paths.DENIED.values() for w in words] + [(w, "allow") for w in paths.ALLOWED]


@query(rf"""WITH p AS (SELECT page_id, list_filter(string_split(lower(strip_accents(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1))), '/'), lambda s: s <> '') AS s FROM pages),
given AS (
  SELECT * FROM (VALUES {_values(_LISTED)}) v(path, verdict) UNION ALL
  SELECT DISTINCT s[1], 'deny' FROM p WHERE len(s) > 0 UNION ALL
  SELECT DISTINCT array_to_string(s[1:2], '/'), CASE WHEN length(s[2]) = 3 THEN 'allow' ELSE 'deny' END FROM p WHERE len(s) > 1 AND page_id % 3 = 0 UNION ALL
  SELECT DISTINCT s[2], 'allow' FROM p WHERE len(s) > 1 AND page_id % 3 = 1),
rules AS (SELECT lower(strip_accents(path)) AS path, min(verdict) AS verdict FROM given GROUP BY 1),
hits AS (
  SELECT page_id, f, k, path, verdict FROM (SELECT page_id, s, f, unnest(generate_series(1, len(s) - f + 1)) AS k FROM (SELECT page_id, s, unnest(generate_series(1, len(s))) AS f FROM p)) JOIN rules ON path = array_to_string(s[f:f + k - 1], '/')),
best AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY k DESC, verdict, f) AS n FROM hits)
SELECT p.page_id, coalesce(verdict, 'allow') AS verdict, path AS rule FROM p LEFT JOIN best b ON b.page_id = p.page_id AND n = 1""")
def url_path_rules(t):
    """Pages judged by the longest rule of a table: the lists in use, and rules for languages and numbers that the paths have."""
    pages = t("pages").select("page_id", "url")
    s = paths.segments("url")
    cut = pages.withColumn("s", s)
    rules = paths.default_rules(pages.sparkSession).union(cut.where(F.size("s") > 0).select(F.get("s", F.lit(0)), F.lit("deny")))
    rules = rules.union(cut.where((F.size("s") > 1) & (F.col("page_id") % 3 == 0)).select(F.concat_ws("/", F.slice("s", 1, 2)), F.when(F.length(F.get("s", F.lit(1))) == 3, "allow").otherwise("deny")))
    rules = rules.union(cut.where((F.size("s") > 1) & (F.col("page_id") % 3 == 1)).select(F.get("s", F.lit(1)), F.lit("allow")))
    return paths.judge(pages, rules.distinct()).select("page_id", "verdict", "rule")


_RULES = {"quantity": "l_quantity BETWEEN 1 AND 45", "price": "l_extendedprice / l_quantity < 1100", "discount": "l_discount < 0.1", "dates": "l_returnflag <> 'R' OR l_linestatus = 'F'"}


@query(f"""SELECT l_orderkey, l_linenumber, reasons FROM (
  SELECT l_orderkey, l_linenumber, array_to_string(list_filter([{", ".join(f"CASE WHEN coalesce({c}, false) THEN '' ELSE '{n}' END" for n, c in _RULES.items())}], lambda x: x <> ''), ',') AS reasons FROM lineitem) WHERE reasons <> ''""")
def rejected_lines(t):
    """Lines that break rules, with the names of the rules."""
    out = checks.rejected(t("lineitem"), {n: F.expr(c) for n, c in _RULES.items()})
    return out.select("l_orderkey", "l_linenumber", F.array_join("reasons", ",").alias("reasons"))


@query("""SELECT doc_id, quality, ((row_number() OVER (PARTITION BY quality ORDER BY md5('42:' || doc_id), doc_id) - 1) % 5)::INT AS fold FROM labels""")
def stratified_folds(t):
    return scoring.stratified_folds(t("labels"), "quality", "doc_id").select("doc_id", "quality", "fold")


_OFF_TOPIC = " OR ".join(f"regexp_matches(lower(url), '{p.replace('(?!degrees)', '')}')" for p in urls.OFF_TOPIC_PATTERNS)


@query(f"""WITH u AS (SELECT page_id, url FROM pages UNION ALL SELECT page_id, regexp_replace(url, '^(https?://[^/]*)', '\\1/' || word) FROM pages, (VALUES {_values([(w,) for w in ("News-Room", "blog", "labs", "courses", "phd/apply", "research-degrees", "m.jpg")])}) v(word)),
m AS (SELECT page_id, {_OFF_TOPIC} AS topic, list_bool_or(list_transform([{", ".join(f"'{w}'" for w in dict.fromkeys(urls.OFF_TOPIC_WORDS))}], lambda w: contains(lower(url), w))) AS word FROM u)
SELECT page_id, count(*) AS n, count(*) FILTER (topic) AS off_topic, count(*) FILTER (word) AS has_word FROM m GROUP BY page_id""")
def off_topic_defaults(t):
    """Each page's URL, and the same with a word in front of its path, by the patterns and words in use."""
    words = ["News-Room", "blog", "labs", "courses", "phd/apply", "research-degrees", "m.jpg"]
    pages = t("pages").select("page_id", "url")
    more = pages.withColumn("word", F.explode(F.array(*[F.lit(w) for w in words]))).select("page_id", F.regexp_replace("url", F.lit("^(https?://[^/]*)"), F.concat(F.lit("$1/"), "word")).alias("url"))
    every = pages.union(more)
    return every.groupBy("page_id").agg(F.count("*").alias("n"), F.count_if(urls.off_topic("url")).alias("off_topic"), F.count_if(urls.has_word("url")).alias("has_word"))
