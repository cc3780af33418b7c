"""Allow and deny rules for URL paths, held as a trie in a table.

A rule is a row: one or more path segments and a verdict.  The trie has a row for each beginning of a rule, with its verdict if a rule ends there.
Paths walk down the trie by one join for each level, from every segment (or from the first one only), as long as something
goes on; the longest rule found decides, of equally long ones an allowing rule."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import col

# Path words that are denied, by language.
DENIED = {
    "en": (
        "news", "media", "press", "events", "event-calendar", "stories", "story", "press-office", "podcasts", "videos", "webinars", "magazine", "newsletter", "campaigns", "blogs", "features", "spotlights",
        "people", "staff", "faculty", "team", "directory", "profiles", "experts", "researchers", "departments", "schools", "centres", "centers", "institutes",
        "alumni", "advancement", "giving", "donate", "support-us", "fundraising", "foundation",
        "legal", "privacy", "terms", "policy", "policies", "accessibility", "cookies", "disclaimer", "compliance", "gdpr", "governance", "sitemap",
        "about", "contact", "history", "leadership", "organization", "maps", "visit", "find-us", "directions", "parking", "transport",
        "accommodation", "housing", "student-life", "campus-life", "sports", "health", "counseling", "welfare", "support", "clubs", "societies",
        "jobs", "careers", "vacancies", "recruitment", "work-with-us", "hr",
        "library", "archives", "collections", "bookstore", "shop", "merchandise",
        "undergraduate", "ug", "bachelors", "minor", "foundation-year", "phd", "doctoral", "doctorate", "postdoc", "dphil",
        "publications", "journals", "papers", "reports", "theses", "dissertations", "projects", "labs",
        "search", "login", "sign-in", "account", "profile", "basket", "cart", "portal", "intranet", "admin", "dashboard", "system",
        "facebook", "twitter", "instagram", "linkedin", "youtube", "social",
    ),
    "other": ("actualites", "actualités", "evenements", "veranstaltungen", "nachrichten", "medien", "presse", "nieuws", "evenementen", "pers", "carrieres", "carrières", "empleo", "karriere", "vacatures"),
}
# Words that are allowed.
ALLOWED = (
    "master", "graduate", "program", "course", "curriculum", "structure", "module", "apply", "admission", "requirements", "deadline", "tuition", "fee", "funding", "scholarship", "duration",
    "thesis", "dissertation", "toefl", "ielts", "transcript", "recommendation", "cv", "personal-statement",
)

#: Letters with marks and the letters without them.
_PLAIN = {chr(c): base for c in range(0xC0, 0x250) if (base := "".join(x for x in unicodedata.normalize("NFD", chr(c)) if not unicodedata.combining(x))) != chr(c) and len(base) == 1}


def fold(c: Column | str) -> Column:
    """Lower case, without accents (of Latin letters, and of combining marks)."""
    plain = F.translate(col(c), "".join(_PLAIN), "".join(_PLAIN.values()))
    return F.lower(F.regexp_replace(plain, r"\p{Mn}+", ""))


def segments(url: Column | str) -> Column:
    """The folded segments of a URL's path, percent signs decoded; empty ones are left out."""
    path = F.regexp_extract(F.coalesce(col(url), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    whole = F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)
    return F.filter(F.split(fold(whole), "/"), lambda s: s != "")


def default_rules(spark) -> DataFrame:
    """(path, verdict) of the lists in use."""
    return spark.createDataFrame([(w, "deny") for words in DENIED.values() for w in words] + [(w, "allow") for w in ALLOWED], "path string, verdict string")


def trie(rules: DataFrame, path: str = "path", verdict: str = "verdict") -> DataFrame:
    """(node, depth, verdict): every beginning of a rule as its segments joined by /, with the verdict of the rule that ends there, if any.

    Rules that say both allow for a path; rules without a segment, or with another verdict than allow or deny, are left out."""
    rows = rules.where(F.col(verdict).isin("allow", "deny")).select(F.filter(F.split(fold(F.coalesce(col(path), F.lit(""))), "/"), lambda s: s != "").alias("s"), F.col(verdict).alias("v"))
    steps = rows.where(F.size("s") > 0).select("s", "v", F.explode(F.sequence(F.lit(1), F.size("s"))).alias("depth"))
    node = F.array_join(F.slice("s", F.lit(1), F.col("depth")), "/")
    return steps.groupBy(node.alias("node"), "depth").agg(F.min(F.when(F.col("depth") == F.size("s"), F.col("v"))).alias("verdict"))


def judge(urls: DataFrame, rules: DataFrame, *, url: str = "url", anywhere: bool = True, default: str = "allow") -> DataFrame:
    """urls with ``verdict`` and ``rule``, the path of the rule that decided (null where none does, and the default holds).

    anywhere: a rule may begin at any segment of the path, else at the first one.  Distinct paths are judged once."""
    nodes = trie(rules)
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    paths = urls.select(segments(url).alias("_s")).where(F.size("_s") > 0).distinct().withColumn("_path", F.array_join("_s", "/"))
    starts = F.sequence(F.lit(1), F.size("_s")) if anywhere else F.array(F.lit(1))
    at = paths.select("_path", "_s", F.explode(starts).alias("_from"), F.lit("").alias("_node"))
    found = None
    for depth in range(1, deepest + 1):
        level = nodes.where(F.col("depth") == depth).select("node", "verdict")
        step = F.get("_s", F.col("_from") + depth - 2)
        at = at.where(step.isNotNull()).withColumn("node", step if depth == 1 else F.concat_ws("/", "_node", step)).join(level, "node")
        ends = at.where("verdict is not null").select("_path", F.lit(depth).alias("_depth"), F.col("verdict").alias("_verdict"), F.col("node").alias("_rule"), "_from")
        found = ends if found is None else found.union(ends)
        at = at.select("_path", "_s", "_from", F.col("node").alias("_node"))
    out = urls.withColumn("_path", F.array_join(segments(url), "/"))
    if found is None:
        return out.drop("_path").withColumns({"verdict": F.lit(default), "rule": F.lit(None).cast("string")})
    # allow comes before deny in the alphabet
    best = found.groupBy("_path").agg(F.min(F.struct((-F.col("_depth")).alias("depth"), F.col("_verdict").alias("verdict"), F.col("_from").alias("at"), F.col("_rule").alias("rule"))).alias("b"))
    best = best.select("_path", F.col("b.verdict").alias("verdict"), F.col("b.rule").alias("rule"))
    return out.join(best, "_path", "left").drop("_path").withColumn("verdict", F.coalesce("verdict", F.lit(default)))
