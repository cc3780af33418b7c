"""Names found by a table of rules: an equal name with a qualifier, a keyword in the name, or a pattern with gaps (``A.*B``).

Rules are rows, so there may be as many as there are names.  A keyword meets names through an inverted index of character n-grams: of all
n-grams of a rule the one that fewest names have is looked up, together with the rule's qualifier, and only what that finds is
compared.  A pattern's parts are looked for one behind the other in the name, which takes the place of a regular expression
for each rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import edge_strip
from .resolve import grams

GAP = r"\.\*"
#: Longest n-gram of the index.
LONGEST = 3
#: Stands for the qualifier of rules that have none.
ANY = "\u0000"


def literal_parts(pattern: Column | str) -> Column:
    """The parts between gaps, lower-cased, without empty ones; all other characters stand for themselves."""
    return F.filter(F.split(F.lower(pattern), GAP), lambda p: p != "")


def holds_in_order(text: Column | str, parts: Column) -> Column:
    """Each part stands in the text behind the one before it: as the parts joined by gaps, found as a regular expression."""
    text = F.col(text) if isinstance(text, str) else text

    def after(at: Column, part: Column) -> Column:  # 0: not found
        place = F.when(at > 0, F.position(part, text, at)).otherwise(0)
        return F.when(place > 0, place + F.length(part)).otherwise(0)

    return F.aggregate(parts, F.lit(1), after) > 0


def find(names: DataFrame, rules: DataFrame, *, name: str = "name", pattern: str = "pattern", qualifier: str | None = None) -> DataFrame:
    """(name, [qualifier of the name,] pattern, rule_qualifier): every distinct name and rule that finds it, in any case of letters.

    qualifier: a column of both tables; a rule with one finds names with the same one only, a rule without finds all.
    Patterns that are null or have no part find nothing; gaps reach over line ends."""
    own = F.coalesce(F.lower(qualifier), F.lit("")) if qualifier else F.lit("")
    wanted = F.coalesce(F.lower(qualifier), F.lit(ANY)) if qualifier else F.lit(ANY)
    kept = [name, *([qualifier] if qualifier else [])]
    listed = names.select(*kept).where(F.col(name).isNotNull()).distinct().withColumns({"_text": F.lower(name), "_own": own})
    asked = rules.select(F.col(pattern).alias("_pattern"), *([F.col(qualifier).alias("_rule_qualifier")] if qualifier else [F.lit(None).cast("string").alias("_rule_qualifier")]), wanted.alias("_key"))
    asked = asked.where("_pattern is not null").distinct().withColumn("_parts", literal_parts("_pattern")).where(F.size("_parts") > 0)
    keys = asked.select("_pattern", "_rule_qualifier", "_key", "_parts", F.explode(F.array_distinct(F.flatten(F.transform("_parts", lambda p: grams(p, LONGEST))))).alias("_gram"))

    used = keys.select("_gram", "_key").distinct()
    sizes = sorted(r[0] for r in used.select(F.length("_gram")).distinct().collect())  # LONGEST at most
    if not sizes:
        return names.select(*kept, F.lit(None).cast("string").alias(pattern), F.lit(None).cast("string").alias("rule_qualifier")).limit(0)
    every = F.array_distinct(F.concat(*[grams(F.col("_text"), k) for k in sizes]))
    postings = listed.select(*kept, "_text", F.explode(F.array_distinct(F.array("_own", F.lit(ANY)))).alias("_key"), every.alias("_grams"))
    postings = postings.select(*kept, "_text", "_key", F.explode("_grams").alias("_gram")).join(used, ["_gram", "_key"], "left_semi")
    often = postings.groupBy("_gram", "_key").agg(F.count("*").alias("_n"))
    rarest = keys.join(often, ["_gram", "_key"], "left").groupBy("_pattern", "_rule_qualifier", "_key", "_parts").agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), F.col("_gram").alias("gram"))).alias("_least"))
    looked = rarest.where("_least.n > 0").withColumn("_gram", F.col("_least.gram"))
    hits = looked.join(postings, ["_gram", "_key"]).where(holds_in_order("_text", F.col("_parts")))
    return hits.select(*kept, F.col("_pattern").alias(pattern), F.col("_rule_qualifier").alias("rule_qualifier"))


def rule_targets(rules: DataFrame, catalogue: DataFrame, *, names: tuple[str, ...] = ("name",), country: str = "country", order: str = "row_id") -> DataFrame:
    """(query, match_type, n_found, target): what the first rule of each query that finds anything finds first.

    rules: (query, rule_no, kind, pattern, country).  kind exact: a catalogue row with an equal name and country
    (match_type exact_with_country, or exact if the rule names no country); keyword and regex: a name holds the text, or
    the parts of ``A.*B`` in order, in the rule's country if it has one.  target is the first of ``names`` of the first row by ``order``;
    names are compared without regard to case and blanks at the ends."""
    first = names[0]
    rows = catalogue.select(F.col(order).alias("_order"), F.col(first).alias("_target"), F.col(country).alias("_country"), F.explode(F.array_distinct(F.array(*[edge_strip(c) for c in names]))).alias("_name")).where("_name <> ''")
    key = lambda c: F.coalesce(F.lower(c), F.lit(""))
    wanted = rules.select("query", "rule_no", "kind", "pattern", F.col("country").alias("_wanted")).where("pattern is not null and query is not null")

    equal = rows.withColumns({"_k": F.lower("_name"), "_c": F.explode(F.array_distinct(F.array(key("_country"), F.lit(ANY))))})
    exact = wanted.where("kind = 'exact'").withColumns({"_k": F.lower(edge_strip("pattern")), "_c": F.coalesce(F.lower("_wanted"), F.lit(ANY))})
    exact = exact.join(equal, ["_k", "_c"]).withColumn("match_type", F.when(F.col("_wanted").isNull(), "exact").otherwise("exact_with_country"))

    searched = wanted.where("kind in ('keyword', 'regex')")
    found = find(rows.select(F.col("_name").alias("name"), F.col("_country").alias("country")), searched.select("pattern", F.col("_wanted").alias("country")), qualifier="country")
    found = found.withColumnsRenamed({"name": "_name", "country": "_country"})
    same = lambda a, b: F.coalesce(F.lower(a), F.lit(ANY)) == F.coalesce(F.lower(b), F.lit(ANY))
    hits = found.alias("f").join(rows.alias("r"), (F.col("f._name") == F.col("r._name")) & same("f._country", "r._country")).select("f.pattern", "f.rule_qualifier", "r._order", "r._target")
    keyed = searched.withColumnRenamed("kind", "match_type").alias("s").join(hits.alias("h"), (F.col("s.pattern") == F.col("h.pattern")) & same("s._wanted", "h.rule_qualifier"))
    both = exact.select("query", "rule_no", "match_type", "_order", "_target").union(keyed.select("s.query", "s.rule_no", "s.match_type", "h._order", "h._target"))

    each = both.distinct().groupBy("query", "rule_no", "match_type").agg(F.count("*").alias("n_found"), F.min_by("_target", F.struct("_order", "_target")).alias("target"))
    return each.groupBy("query").agg(F.min(F.struct("rule_no", "match_type", "n_found", "target")).alias("b")).select("query", "b.match_type", "b.n_found", "b.target")


def fill_failed(resolved: DataFrame, targets: DataFrame, query: str = "query") -> DataFrame:
    """What ``resolve`` gave, with the targets of rules in the rows that failed."""
    given = targets.select(F.col("query").alias("_query"), F.col("match_type").alias("_type"), F.col("target").alias("_target"))
    # only failed rows have a key, so that the others meet nothing
    out = resolved.withColumn("_key", F.when(F.col("match_type") == "failed", F.col(query))).join(given, F.col("_key") == F.col("_query"), "left")
    return out.withColumns({"match_type": F.coalesce("_type", "match_type"), "matched_name": F.coalesce("matched_name", "_target")}).drop("_key", "_query", "_type", "_target")
