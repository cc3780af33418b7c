"""Name resolution: queries against a catalogue, by a cascade of joins.

Each layer sees what the layers before left open.  Layers are equi-joins on keys; pattern rules are a table of
bounded size; the fuzzy layer compares only names that share a blocking key."""

from __future__ import annotations

from collections.abc import Iterable
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import acronym, canonical_name, edge_strip, fuzzy_name, let

LAYERS = ("manual", "rule", "lower", "canonical", "acronym", "fuzzy", "secondary")


def lookup_index(catalogue: DataFrame, name: str = "name", order: str = "row_id") -> DataFrame:
    """(kind, key, name): lower-cased, canonical and acronym keys of each name; the last name written under a key wins."""
    n = edge_strip(name)
    keys = F.array(F.struct(F.lit("lower").alias("kind"), F.lower(n).alias("key")), F.struct(F.lit("canonical").alias("kind"), canonical_name(n).alias("key")), F.struct(F.lit("acronym").alias("kind"), acronym(n).alias("key")))
    rows = catalogue.select(F.col(name).alias("name"), F.col(order).alias("_seq"), F.inline(keys)).where("key <> ''")
    return rows.groupBy("kind", "key").agg(F.max_by("name", F.struct("_seq", "name")).alias("name"))


def rule_match(queries: DataFrame, rules: list[tuple[str, str]], query: str = "query") -> DataFrame:
    """(query, rule_no, target) of the first rule, in order, whose pattern is found; rules are a list in the plan."""
    first = F.lit(None).cast("int")
    for i in range(len(rules) - 1, -1, -1):
        first = F.when(F.col(query).rlike(f"(?i){rules[i][0]}"), F.lit(i)).otherwise(first)
    targets = F.array(*[F.lit(t) for _, t in rules]) if rules else F.array().cast("array<string>")
    return queries.withColumn("rule_no", first).where("rule_no is not null").withColumn("target", F.get(targets, F.col("rule_no")))


def resolve(queries: DataFrame, catalogue: DataFrame, *, query: str = "query", name: str = "name", order: str = "row_id", aliases: DataFrame | None = None, rules: list[tuple[str, str]] | None = None, fuzzy_threshold: float | None = None, second: tuple[str, str] | None = None) -> DataFrame:
    """queries with matched_name and match_type: manual, rule, lower, canonical, acronym, fuzzy, secondary or failed.

    aliases: (alias, target), compared in lower case.  Targets of aliases and rules count only if the catalogue
    has them.  Distinct query names are resolved once and joined back.

    second: columns of queries and catalogue with a second name (of another language, say); rows that fail by the first
    get the first catalogue row, by ``order``, whose second name is equal."""
    names = queries.select(F.col(query).alias("q")).where("q is not null").distinct().withColumn("s", edge_strip("q")).where("s <> ''")
    index = lookup_index(catalogue, name, order)
    known = catalogue.select(F.col(name).alias("target")).distinct()
    keyed = lambda kind: index.where(F.col("kind") == kind).select(F.col("key").alias(f"k_{kind}"), F.col("name").alias(f"m_{kind}"))
    out = names.withColumns({"k_lower": F.lower("s"), "k_canonical": F.nullif(canonical_name("s"), F.lit("")), "k_acronym": F.nullif(acronym("s"), F.lit(""))})
    for kind in ("lower", "canonical", "acronym"):
        out = out.join(keyed(kind), f"k_{kind}", "left")
    if aliases is not None:
        ok = aliases.join(known, "target", "left_semi").select(F.lower("alias").alias("k_lower"), F.col("target").alias("m_manual")).dropDuplicates(["k_lower"])
        out = out.join(ok, "k_lower", "left")
    else:
        out = out.withColumn("m_manual", F.lit(None).cast("string"))
    if rules:
        hits = rule_match(names, rules, "s").join(known, "target", "left_semi").select("q", F.col("target").alias("m_rule"))
        out = out.join(hits, "q", "left")
    else:
        out = out.withColumn("m_rule", F.lit(None).cast("string"))
    kinds = ["manual", "rule", "lower", "canonical", "acronym"]
    if fuzzy_threshold is not None:
        rest = out.where(F.coalesce(*[F.col(f"m_{k}") for k in kinds]).isNull()).select("q", "s")
        best = fuzzy_best(rest, catalogue.select(F.col(name).alias("c")).distinct(), threshold=fuzzy_threshold, query="s", candidate="c")
        out = out.join(best.select("q", F.col("c").alias("m_fuzzy")), "q", "left")
        kinds.append("fuzzy")
    matched = F.coalesce(*[F.col(f"m_{k}") for k in kinds])
    kind = F.coalesce(*[F.when(F.col(f"m_{k}").isNotNull(), k) for k in kinds], F.lit("failed"))
    found = out.select("q", matched.alias("matched_name"), kind.alias("match_type"))
    out = queries.join(found, queries[query] == found["q"], "left").drop("q").withColumn("match_type", F.coalesce("match_type", F.lit("failed")))
    if second is None:
        return out
    asked, given = second
    by_second = catalogue.where(F.col(given) != "").groupBy(F.col(given).alias("_second")).agg(F.min_by(name, F.struct(order, name)).alias("_m"))
    # only rows that failed have a key, so that those already matched meet nothing
    out = out.withColumn("_key", F.when((F.col("match_type") == "failed") & (F.coalesce(query, F.lit("")) != ""), F.col(asked))).join(by_second, F.col("_key") == F.col("_second"), "left")
    out = out.withColumns({"match_type": F.when(F.col("_m").isNotNull(), "secondary").otherwise(F.col("match_type")), "matched_name": F.coalesce("matched_name", "_m")})
    return out.drop("_key", "_second", "_m")


def overall_ranks(resolved: DataFrame, records: DataFrame, ranks: list[str], *, matched: str = "matched_name", name: str = "name") -> DataFrame:
    """resolved with ``<rank>_rank`` of the matched record for each of the rank columns, null without a match.

    records: one row for each name."""
    chosen = records.select(F.col(name).alias("_name"), *[F.col(c).alias(f"{c}_rank") for c in ranks])
    return resolved.join(chosen, F.col(matched) == F.col("_name"), "left").drop("_name")


def grams(c: Column, size: int = 3) -> Column:
    """Distinct character n-grams of a text, the text itself if it is shorter."""
    n = F.length(c)
    return F.when(n < size, F.array(c)).otherwise(F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(n - size + 1, F.lit(1))), lambda i: F.substr(c, i, F.lit(size)))))


@F.pandas_udf(T.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Matching-blocks similarity of two texts, in argument order."""
    return pd.Series([SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)])


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, a row of the table in the bits of one number."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & places.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def indel_ratio(a: str, b: str) -> float:
    """Similarity, 0 to 100, by insertions and deletions."""
    return 200 * common_subsequence(a, b) / (len(a) + len(b)) if a or b else 100.0


def token_set(a: str, b: str) -> float:
    """Similarity, 0 to 100, of two texts as sets of words: 100 if one holds all words of the other, else the best of the
    indel similarities among the shared words, and these with the rest of either text; 0 if a text has no word."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, left, right = (" ".join(sorted(z)) for z in (x & y, x - y, y - x))
    if both and not (left and right):
        return 100.0
    if not both:
        return indel_ratio(left, right)
    one, other = f"{both} {left}", f"{both} {right}"
    return max(indel_ratio(one, other), indel_ratio(both, one), indel_ratio(both, other))


@F.pandas_udf(T.DoubleType())
def token_set_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([token_set(x, y) for x, y in zip(a, b, strict=True)])


def levenshtein_ratio(a: Column, b: Column) -> Column:
    """1 less the edit distance over the longer length."""
    return 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1))


def gram_size(n: Column, share: float) -> Column:
    """Length of the n-grams by which a name of n characters is looked up: the longest, up to 3, of which near names surely
    share one."""
    return F.when(_shared(n, F.lit(3), share) >= 1, 3).when(_shared(n, F.lit(2), share) >= 1, 2).otherwise(1)


def _numbered(c: Column, size: int) -> Column:
    """The n-grams of a text, each with the number of its occurrence, so that a set of them is a multiset of n-grams."""
    cut = lambda t: F.transform(F.sequence(F.lit(1), F.greatest(F.length(t) - size + 1, F.lit(1))), lambda i: F.substr(t, i, F.lit(size)))
    every = let(c, lambda t: F.when(F.length(t) >= size, F.sort_array(cut(t))).otherwise(F.array().cast("array<string>")))
    number = lambda all_: F.transform(all_, lambda g, i: F.concat(F.lit(f"{size}:"), g, F.lit("#"), (i - F.array_position(all_, g) + 1).cast("string")))
    return let(every, number)


def _shared(n: Column, size: Column, share: float) -> Column:
    """N-grams of a text of n characters that stay if the edits are at most 1 - ``share`` of n, each spoiling ``size`` of them."""
    return n - size + 1 - size * F.floor(n * (1 - share) + F.lit(1e-9)).cast("int")


def _rare_first(asked: DataFrame, other: DataFrame, bound: Column) -> DataFrame:
    """(a, b): rows of asked (a, keys, drop) and other (b, keys) that share a key and are within a bound, where ``drop`` of the keys of a
    row of asked, the most frequent ones in other, aren't looked up.

    Frequent keys are left to rows that have nothing rarer, so that no key has all rows meet all rows."""
    listed = other.select("b", F.explode("keys").alias("key"))
    often = listed.groupBy("key").agg(F.count("*").alias("n"))
    rows = asked.select("a", "drop", F.explode("keys").alias("key")).join(often, "key", "left")
    ranked = rows.groupBy("a").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "key"))).alias("keys"), F.any_value("drop").alias("drop"))
    kept = ranked.select("a", F.explode(F.slice("keys", F.lit(1), F.greatest(F.size("keys") - F.col("drop"), F.lit(0)))).alias("k")).where("k.n > 0")
    return kept.select("a", F.col("k.key").alias("key")).join(listed, "key").where(bound).select("a", "b").distinct()


def near_names(queries: DataFrame, candidates: DataFrame, *, share: float, words: bool = False, bound: Column | None = None) -> DataFrame:
    """(a, b): pairs of distinct names of queries (a) and candidates (b).  None is missed that is apart by at most 1 - ``share``
    edits for each character of a, where ``share`` is above 0.

    Names meet by n-grams, the rarest first: of the n-grams that a name has, only so many are looked up that a near
    name must have one of them.  words: also names that share words which make up the greater part of one of them.  bound: what all
    pairs that are wanted keep to; it is looked at where names meet."""
    bound = F.lit(True) if bound is None else bound
    a, b = queries.select("a").where("a is not null").distinct(), candidates.select("b").where("b is not null").distinct()
    order = (lambda c: F.array_join(F.array_sort(F.array_distinct(F.split(F.trim(c), r"\s+"))), " ")) if words else F.col
    n = F.length(order("a"))
    size = gram_size(n, share)
    own = F.when(size == 3, _numbered(order("a"), 3)).when(size == 2, _numbered(order("a"), 2)).otherwise(_numbered(order("a"), 1))
    asked = a.select("a", own.alias("keys"), (F.greatest(_shared(n, size, share), F.lit(1)) - 1).alias("drop"))
    listed = b.select("b", F.concat(*[_numbered(order("b"), k) for k in (1, 2, 3)]).alias("keys"))
    out = _rare_first(asked, listed, bound)
    if words:
        parts = lambda c: F.filter(F.array_distinct(F.split(F.trim(c), r"\s+")), lambda w: w != "")
        one, other = a.select("a", parts("a").alias("keys")), b.select("b", parts("b").alias("keys"))
        out = out.union(_rare_first(one.withColumn("drop", F.lit(0)), other, bound)).distinct()
    return out


def fuzzy_best(queries: DataFrame, candidates: DataFrame, *, threshold: float, query: str = "query", candidate: str = "candidate", measure: str = "ratio", normalise: bool = True) -> DataFrame:
    """Each query with the best candidate whose similarity is over the threshold; of equals the smallest name.

    measure: ratio (matching blocks, 0 to 1, over the threshold), token_set (0 to 100, at least the threshold) or
    levenshtein (0 to 1, native, over the threshold).  Distinct normal forms are compared once, and only those that meet by
    ``near_names``, which misses none over a threshold above 0.67 (0.5 for levenshtein)."""
    key = (lambda c: fuzzy_name(c)) if normalise else F.col
    level = threshold / 100 if measure == "token_set" else threshold
    asked, given = queries.withColumn("a", key(query)), candidates.withColumn("b", key(candidate))
    # edits for each character of a: a name that passes is at most 1 / level (by edits) or 2 / level - 1 (by indels) times as long
    share = 2 - 1 / level if measure == "levenshtein" else 1 - 2 * (1 - level) / level
    longest = {"levenshtein": F.least(F.length("a"), F.length("b")) > level * F.greatest(F.length("a"), F.length("b")) - 1e-9, "ratio": 2 * F.least(F.length("a"), F.length("b")) > level * (F.length("a") + F.length("b")) - 1e-9}
    pairs = near_names(asked, given, share=share, words=measure == "token_set", bound=longest.get(measure))
    if measure == "ratio":  # matching blocks hold no more letters than both texts have
        common = F.size(F.array_intersect(_numbered(F.col("a"), 1), _numbered(F.col("b"), 1)))
        pairs = pairs.where(2 * common > level * (F.length("a") + F.length("b")) - 1e-9)
    score = {"ratio": sequence_ratio, "token_set": token_set_ratio, "levenshtein": levenshtein_ratio}[measure](F.col("a"), F.col("b"))
    scored = pairs.withColumn("score", score).where(F.col("score") > threshold if measure != "token_set" else F.col("score") >= threshold)
    names = given.groupBy("b").agg(F.min_by(F.struct(*candidates.columns), candidate).alias("c"))
    best = scored.join(names, "b").groupBy("a").agg(F.min_by(F.struct("c", "score"), F.struct((-F.col("score")).alias("s"), F.col(f"c.{candidate}"))).alias("best"))
    return asked.join(best, "a").select(*queries.columns, "best.c.*", "best.score")


def match_counts(resolved: DataFrame, match_type: str = "match_type") -> DataFrame:
    """(match_type, n, rate): rows by how they were matched, and the share of all matched in percent."""
    n = resolved.groupBy(match_type).agg(F.count("*").alias("n"))
    total = n.agg(F.sum("n").alias("_all"), F.sum(F.when(F.col(match_type) != "failed", F.col("n")).otherwise(0)).alias("_hit"))
    return n.crossJoin(F.broadcast(total)).select(match_type, "n", F.round(F.col("_hit") / F.greatest("_all", F.lit(1)) * 100, 2).alias("success_rate"))  # total is one row


def subject_ranks(programs: DataFrame, subject_map: DataFrame, ranks: DataFrame, *, category: str = "category", name: str = "name") -> DataFrame:
    """programs with primary_rank and secondary_rank.

    subject_map: (category, primary, secondary); ranks: (name, subject, rank), one row for each name and subject."""
    mapped = programs.join(subject_map.withColumnRenamed("category", category), category, "left")
    one = ranks.select(F.col("name").alias(name), F.col("subject").alias("primary"), F.col("rank").alias("primary_rank"))
    two = ranks.select(F.col("name").alias(name), F.col("subject").alias("secondary"), F.col("rank").alias("secondary_rank"))
    return mapped.join(one, [name, "primary"], "left").join(two, [name, "secondary"], "left")


def least_rank(ranks: DataFrame, keys: list[str], rank: Column | str) -> DataFrame:
    """The least rank of each key; nulls don't count."""
    return ranks.groupBy(*keys).agg(F.min(rank).alias("rank"))


def normalised_lookup(df: DataFrame, column: str, table: Iterable[tuple[str, str, str]]) -> DataFrame:
    """df with ``column`` as a full name, and its abbreviation and code; unknown values pass through.

    table: (full name, abbreviation, code), of a size that fits the plan; two-letter values are read as abbreviations."""
    rows = df.sparkSession.createDataFrame(list(table), "full string, abbreviation string, region_code string")
    value = edge_strip(F.coalesce(column, F.lit("")))
    keyed = df.withColumn("_key", F.when(F.length(value) == 2, F.upper(value)).otherwise(value))
    keys = rows.select(F.explode(F.array("full", "abbreviation")).alias("_key"), "full", "abbreviation", "region_code")
    out = keyed.join(keys, "_key", "left").withColumn(column, F.coalesce("full", value))
    return out.withColumns({"abbreviation": F.coalesce("abbreviation", F.lit("")), "region_code": F.coalesce("region_code", F.lit(""))}).drop("_key", "full")
