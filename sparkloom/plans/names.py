"""Names: normal forms, lookups, cascades, fuzzy matches, ranks by subject."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import relational, resolve
from .registry import query

_STOP_SQL = "('university','universiti','college','the','of','at','and','school','in','for','institute','technological','technology','national','state','federal')"


def canonical_sql(x: str) -> str:
    """SQL of text.canonical_name."""
    plain = rf"regexp_replace(lower(translate({x}, '（）【】《》“”‘’，。；！￥、', repeat(' ', 16))), '[()''`.,\-]', ' ', 'g')"
    return rf"array_to_string(list_filter(regexp_split_to_array({plain}, '\s+'), lambda w: w <> '' AND w NOT IN {_STOP_SQL}), ' ')"


@query(f"SELECT c_custkey, {canonical_sql("c_name || ' (the) of-School, ' || c_mktsegment")} AS canonical FROM customer")
def canonicalize_names(t):
    name = F.concat("c_name", F.lit(" (the) of-School, "), "c_mktsegment")
    return t("customer").select("c_custkey", text.canonical_name(name).alias("canonical"))


@query("SELECT p_partkey, array_to_string(regexp_extract_all(p_type || ' ' || p_brand, '[A-Z]'), '') AS acronym FROM part")
def acronym_names(t):
    return t("part").select("p_partkey", text.acronym(F.concat_ws(" ", "p_type", "p_brand")).alias("acronym"))


@query("""SELECT p_partkey, 'massachusetts institute technology ' || p_name || ' smith' AS normal FROM part""")
def fuzzy_names(t):
    return t("part").select("p_partkey", text.fuzzy_name(F.concat(F.lit("The MIT of "), "p_name", F.lit(" & Smith College"))).alias("normal"))


_INDEX_SQL = f"""keys AS (
  SELECT p_name AS name, p_partkey AS seq, 'lower' AS kind, lower(p_name) AS key FROM part
  UNION ALL SELECT p_name, p_partkey, 'canonical', {canonical_sql('p_name')} FROM part
  UNION ALL SELECT p_name, p_partkey, 'acronym', array_to_string(regexp_extract_all(p_name, '[A-Z]'), '') FROM part),
idx AS (SELECT kind, key, arg_max(name, seq) AS name FROM keys WHERE key <> '' GROUP BY kind, key)"""


@query(f"WITH {_INDEX_SQL} SELECT kind, key, name FROM idx")
def lookup_index_last_wins(t):
    return resolve.lookup_index(t("part"), "p_name", "p_partkey").select("kind", "key", "name")


def _asked(t):
    """Names to resolve, made from the catalogue: as they are, in capitals, with other words, and unknown."""
    k = F.col("p_partkey") % 4
    asked = F.when(k == 0, F.col("p_name")).when(k == 1, F.upper("p_name")).when(k == 2, F.concat(F.lit("The University of "), "p_name")).otherwise(F.concat(F.lit("zzz"), F.col("p_partkey").cast("string")))
    return t("part").select("p_partkey", asked.alias("query"))


_ASKED_SQL = """asked AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN upper(p_name) WHEN 2 THEN 'The University of ' || p_name ELSE 'zzz' || p_partkey END AS query FROM part)"""
_RESOLVED_SQL = f"""WITH {_INDEX_SQL}, {_ASKED_SQL},
resolved AS (
  SELECT a.p_partkey, a.query, coalesce(l.name, c.name, x.name) AS matched_name,
    CASE WHEN l.name IS NOT NULL THEN 'lower' WHEN c.name IS NOT NULL THEN 'canonical' WHEN x.name IS NOT NULL THEN 'acronym' ELSE 'failed' END AS match_type
  FROM asked a LEFT JOIN idx l ON l.kind = 'lower' AND l.key = lower(a.query)
  LEFT JOIN idx c ON c.kind = 'canonical' AND c.key = {canonical_sql('a.query')}
  LEFT JOIN idx x ON x.kind = 'acronym' AND x.key = array_to_string(regexp_extract_all(a.query, '[A-Z]'), ''))"""


@query(_RESOLVED_SQL + """
SELECT match_type, count(*) AS n, round((SELECT count(*) FROM resolved WHERE match_type <> 'failed') / greatest((SELECT count(*) FROM resolved), 1) * 100, 2) AS success_rate FROM resolved GROUP BY match_type""")
def flagship_resolve_stats(t):
    """Names resolved against a catalogue: rows by the layer that matched, and the success rate."""
    return resolve.match_counts(resolve.resolve(_asked(t), t("part"), name="p_name", order="p_partkey"))


@query(_RESOLVED_SQL + " SELECT p_partkey, query, matched_name, match_type FROM resolved")
def resolve_names(t):
    return resolve.resolve(_asked(t), t("part"), name="p_name", order="p_partkey")


@query(_RESOLVED_SQL + """, best AS (SELECT (SELECT min(p_name) FROM part WHERE p_name LIKE '%widget%') AS w, (SELECT max(p_name) FROM part) AS m)
SELECT p_partkey, query,
  CASE WHEN lower(query) = (SELECT lower(min(p_name)) FROM part) THEN m WHEN query LIKE 'zzz%' AND query LIKE '%7' THEN w ELSE matched_name END AS matched_name,
  CASE WHEN lower(query) = (SELECT lower(min(p_name)) FROM part) THEN 'manual' WHEN query LIKE 'zzz%' AND query LIKE '%7' THEN 'rule' ELSE match_type END AS match_type
FROM resolved, best""")
def resolve_with_rules(t):
    """The cascade with an alias table and pattern rules in front; targets that the catalogue lacks don't count."""
    part = t("part")
    aliases = part.agg(F.min("p_name").alias("alias"), F.max("p_name").alias("target"))
    aliases = aliases.union(aliases.select(F.upper("target"), F.lit("not in the catalogue")))
    widget = part.where("p_name like '%widget%'").agg(F.min("p_name")).first()[0]
    return resolve.resolve(_asked(t), part, name="p_name", order="p_partkey", aliases=aliases, rules=[("^qqq", widget), ("^zzz.*7$", widget), ("^zzz", "not in the catalogue")])


@query("""SELECT p_partkey, CASE WHEN p_name LIKE '%cold%' THEN 0 WHEN p_name LIKE '%widget%' THEN 1 ELSE 2 END AS rule_no, CASE WHEN p_name LIKE '%cold%' THEN 'A' WHEN p_name LIKE '%widget%' THEN 'B' ELSE 'C' END AS target FROM part WHERE p_name LIKE '%cold%' OR p_name LIKE '%widget%' OR p_name LIKE 's%'""")
def regex_rule_join(t):
    rows = t("part").select("p_partkey", "p_name")
    return resolve.rule_match(rows, [(r"\bCOLD\b", "A"), (r"\bwidget\b", "B"), ("^s", "C")], "p_name").select("p_partkey", "rule_no", "target")


_FUZZY_SQL = """names AS (SELECT DISTINCT p_name AS c FROM part),
q AS (SELECT c AS query, substr(c, 1, len(c) - 1) || 'q' AS s FROM names)"""


@query(f"""WITH {_FUZZY_SQL}
SELECT query, s, c, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY s ORDER BY score DESC, c) AS rn FROM (
    SELECT query, s, c, 1 - levenshtein(s, c)::DOUBLE / greatest(len(s), len(c), 1) AS score FROM q, names) WHERE score > 0.85) WHERE rn = 1""")
def fuzzy_top1_levenshtein(t):
    """Names with a wrong last letter against all names; candidates share trigrams."""
    names = t("part").select(F.col("p_name").alias("c")).distinct()
    asked = names.select(F.col("c").alias("query"), F.concat(F.expr("substr(c, 1, length(c) - 1)"), F.lit("q")).alias("s"))
    best = resolve.fuzzy_best(asked, names, threshold=0.85, query="s", candidate="c", measure="levenshtein", normalise=False)
    return best.withColumn("score", F.round("score", 6))


def _typos(t):
    names = t("part").select(F.col("p_name").alias("c")).distinct()
    return names.select(F.concat(F.expr("substr(c, 1, length(c) - 1)"), F.lit("q")).alias("s")), names


@query()
def fuzzy_top1_ratio(t):
    asked, names = _typos(t)
    return resolve.fuzzy_best(asked, names, threshold=0.85, query="s", candidate="c").withColumn("score", F.round("score", 6))


@query()
def fuzzy_token_set(t):
    asked, names = _typos(t)
    return resolve.fuzzy_best(asked, names, threshold=85, query="s", candidate="c", measure="token_set").withColumn("score", F.round("score", 6))


@query("""WITH m AS (SELECT p_brand, min(p_type) AS prim, CASE WHEN min(p_type) <> max(p_type) THEN max(p_type) END AS sec FROM part GROUP BY p_brand),
r AS (SELECT p_name, p_type, min(p_size) AS rank FROM part GROUP BY 1, 2)
SELECT p_partkey, a.rank AS primary_rank, b.rank AS secondary_rank FROM part JOIN m USING (p_brand)
LEFT JOIN r a ON a.p_name = part.p_name AND a.p_type = m.prim LEFT JOIN r b ON b.p_name = part.p_name AND b.p_type = m.sec""")
def two_hop_subject_rank(t):
    part = t("part")
    subjects = part.groupBy("p_brand").agg(F.min("p_type").alias("primary"), F.max("p_type").alias("last")).select(F.col("p_brand").alias("category"), "primary", F.when(F.col("primary") != F.col("last"), F.col("last")).alias("secondary"))
    ranks = resolve.least_rank(part, ["p_name", "p_type"], "p_size").withColumnsRenamed({"p_name": "name", "p_type": "subject"})
    programs = part.select("p_partkey", F.col("p_name").alias("name"), F.col("p_brand").alias("category"))
    return resolve.subject_ranks(programs, subjects, ranks).select("p_partkey", "primary_rank", "secondary_rank")


@query("SELECT l_suppkey, min(l_extendedprice) AS rank FROM lineitem GROUP BY l_suppkey")
def best_rank_per_name(t):
    return resolve.least_rank(t("lineitem"), ["l_suppkey"], "l_extendedprice")


_STATES = [("AMERICA", "AM", "R-AM"), ("ASIA", "AS", "R-AS"), ("EUROPE", "EU", "R-EU")]


@query("""WITH s(full_name, abbreviation, region_code) AS (VALUES ('AMERICA', 'AM', 'R-AM'), ('ASIA', 'AS', 'R-AS'), ('EUROPE', 'EU', 'R-EU')),
n AS (SELECT n_nationkey, CASE n_nationkey % 4 WHEN 0 THEN 'am' WHEN 1 THEN 'EU ' WHEN 2 THEN 'ASIA' ELSE n_name END AS v FROM nation)
SELECT n_nationkey, coalesce(full_name, trim(v)) AS state, coalesce(abbreviation, '') AS abbreviation, coalesce(region_code, '') AS region_code
FROM n LEFT JOIN s ON full_name = trim(v) OR (length(trim(v)) = 2 AND abbreviation = upper(trim(v)))""")
def state_lookup_passthrough(t):
    k = F.col("n_nationkey") % 4
    rows = t("nation").select("n_nationkey", F.when(k == 0, "am").when(k == 1, "EU ").when(k == 2, "ASIA").otherwise(F.col("n_name")).alias("state"))
    return resolve.normalised_lookup(rows, "state", _STATES)


@query("SELECT n_nationkey, n_name IN ('NATION_0', 'NATION_3', 'NATION_24') AS is_capital, 'normal' AS city_type, '' AS zip_code FROM nation")
def capital_flag(t):
    return t("nation").select("n_nationkey", F.col("n_name").isin("NATION_0", "NATION_3", "NATION_24").alias("is_capital"), F.lit("normal").alias("city_type"), F.lit("").alias("zip_code"))


@query("SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def semi_failed(t):
    failed = t("orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return relational.only_in(t("customer"), failed, "c_custkey").select("c_custkey")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")
def anti_seen(t):
    """Customers without an order of a high price."""
    seen = t("orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return relational.not_in(t("customer"), seen, "c_custkey").select("c_custkey")


@query("""SELECT p_partkey, p_size AS rank FROM part WHERE p_size <= 20 AND p_partkey % 3 <> 0""")
def unranked_top(t):
    rows = t("part").withColumn("a", F.when(F.col("p_partkey") % 3 == 0, F.lit(1))).withColumn("b", F.lit(None).cast("int"))
    return relational.unranked_top(rows, F.col("p_size"), 20, ["a", "b"]).select("p_partkey", F.col("p_size").alias("rank"))
