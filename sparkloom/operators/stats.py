"""Counts, rates, completion, votes and step metrics."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import edge_strip


def extraction_stats(df: DataFrame, category: str, name: str) -> DataFrame:
    """(category, total, with_name, without_name, empty_name, unique_names); a null category row holds the total of all.

    A null or empty name is without one; one of white space alone is empty."""
    raw, stripped = F.coalesce(F.col(name), F.lit("")), edge_strip(F.coalesce(F.col(name), F.lit("")))
    rows = df.select(F.coalesce(category, F.lit("")).alias("category"), raw.alias("raw"), stripped.alias("name"))
    return rows.rollup("category").agg(
        F.count("*").alias("total"),
        F.count_if(F.col("name") != "").alias("with_name"),
        F.count_if(F.col("raw") == "").alias("without_name"),
        F.count_if((F.col("raw") != "") & (F.col("name") == "")).alias("empty_name"),
        F.countDistinct(F.nullif("name", F.lit(""))).alias("unique_names"),
    )


def names_by_category(df: DataFrame, category: str, name: str) -> DataFrame:
    """(category, names): sorted distinct non-blank names."""
    return df.select(category, edge_strip(name).alias("name")).where("name <> ''").distinct().groupBy(category).agg(F.array_sort(F.collect_list("name")).alias("names"))


def completion(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """(field, filled, total, rate): share of non-null, non-empty values of each column in percent.

    One pass; the columns become rows of the one-row aggregate."""
    columns = list(columns)
    filled = [F.count_if(F.col(c).isNotNull() & (F.col(c).cast("string") != "")).alias(f"c{i}") for i, c in enumerate(columns)]
    one = df.agg(F.count("*").alias("total"), *filled)
    rows = F.inline(F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"c{i}").alias("filled")) for i, c in enumerate(columns)]))
    return one.select("total", rows).withColumn("rate", F.round(F.col("filled") / F.greatest("total", F.lit(1)) * 100, 4))


def success_rate(df: DataFrame, keys: list[str], good: Column) -> DataFrame:
    """(keys, total, succeeded, failed, rate) for each key; rate in percent of at least one row."""
    return df.groupBy(*keys).agg(F.count("*").alias("total"), F.count_if(good).alias("succeeded"), F.count_if(~F.coalesce(good, F.lit(False))).alias("failed")).withColumn("rate", F.round(F.col("succeeded") / F.greatest("total", F.lit(1)) * 100, 4))


def failures(df: DataFrame, keys: list[str], bad: Column, detail: list[str], order: str) -> DataFrame:
    """(keys, total, completed, failed, failed_items: the failed rows' detail in order), for failures that fit in a row for
    each key; ``failed_rows`` gives them as rows, ``first_failures`` the first of them, whatever their number."""
    item = F.struct(order, *[c for c in detail if c != order])
    return df.groupBy(*keys).agg(F.count("*").alias("total"), F.count_if(~bad).alias("completed"), F.count_if(bad).alias("failed"), F.array_sort(F.collect_list(F.when(bad, item))).alias("failed_items"))


def failed_rows(df: DataFrame, bad: Column) -> DataFrame:
    """All failed rows, as rows: a key's failures may be too many for an array."""
    return df.where(bad)


def first_failures(df: DataFrame, keys: list[str], bad: Column, item: str, n: int = 3) -> DataFrame:
    """(keys, total, completed, failed, first_failed: the n smallest items of all failed rows of the key, null if none failed).

    Rows of a key are dealt to slices by their item first, so that a hot key isn't sorted in one task."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("total"), F.count_if(~bad).alias("completed"), F.count_if(bad).alias("failed"))
    few = ranked_within(failed_rows(df, bad).select(*keys, item, F.pmod(F.xxhash64(item), F.lit(64)).alias("_slice")), [*keys, "_slice"], [item], n)
    few = ranked_within(few.select(*keys, item), keys, [item], n).groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("first_failed"))
    a, b = counts.alias("a"), few.alias("b")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    return a.join(b, same, "left").select("a.*", "b.first_failed")


def failure_detail(df: DataFrame, headers: str = "headers", body: str = "body", longest: int = 200, most_headers: int = 5) -> DataFrame:
    """Cut a failed response's headers (a map) and body to a preview."""
    few = F.slice(F.map_entries(headers), 1, most_headers)
    cut = F.map_from_entries(F.transform(few, lambda e: F.struct(e["key"], F.substring(e["value"], 1, longest))))
    return df.withColumns({headers: cut, body: F.substring(body, 1, longest), "crawl_status": F.lit("failed")})


def majority(df: DataFrame, key: str, vote: str, order: str) -> DataFrame:
    """(key, majority, n_votes, first_vote): the most frequent vote (of equals the smallest), and the first one by order."""
    counts = df.where(F.col(vote).isNotNull()).groupBy(key, vote).agg(F.count("*").alias("n"), F.min(F.struct(order, vote)).alias("first"))
    return counts.groupBy(key).agg(F.min_by(vote, F.struct(-F.col("n"), F.col(vote))).alias("majority"), F.sum("n").alias("n_votes"), F.min("first")[vote].alias("first_vote"))


def any_positive(df: DataFrame, key: str, positive: Column) -> DataFrame:
    """(key, any_positive): true if one row's is; nulls don't count."""
    return df.groupBy(key).agg(F.coalesce(F.bool_or(positive), F.lit(False)).alias("any_positive"))


def needs_label(pages: DataFrame, is_root: str = "is_root", label: str = "is_valuable") -> DataFrame:
    """Rows that are no root and have no label yet."""
    return pages.where(~F.coalesce(F.col(is_root), F.lit(False)) & F.col(label).isNull())


def tensor_lists(line: Column | str) -> Column:
    """struct(lengths, correct): the numbers of a log line's two lists of tensors."""
    c = F.col(line) if isinstance(line, str) else line
    numbers = lambda name: F.transform(F.regexp_extract_all(F.regexp_extract(c, name + r"=\[(.*?)\](?:,|\s|$)", 1), F.lit(r"tensor\(([0-9]+)\)"), 1), lambda x: x.cast("int"))
    return F.struct(numbers("Lengths").alias("lengths"), numbers("Correct").alias("correct"))


def step_metrics(df: DataFrame, step: str, lengths: str, correct: Column, responses_per_row: int = 1, max_steps: int | None = None) -> DataFrame:
    """Per step: accuracy over what was possible, mean and median of all lengths (an array column), and totals.

    Steps are sized by what they hold, so that a last, shorter one has its own denominator."""
    base = df if max_steps is None else df.where(F.col(step) <= max_steps)
    base = base.select(F.col(step).alias("step"), F.col(lengths).alias("lengths"), correct.alias("correct"))
    totals = base.groupBy("step").agg(F.sum("correct").alias("total_correct"), (F.count("*") * responses_per_row).alias("possible_correct"))
    sizes = base.select("step", F.explode("lengths").alias("length")).groupBy("step").agg(F.avg("length").alias("avg_length"), F.median("length").alias("median_length"))
    out = totals.join(sizes, "step", "left").withColumns({"avg_length": F.coalesce("avg_length", F.lit(0.0)), "median_length": F.coalesce("median_length", F.lit(0.0))})
    return out.withColumn("accuracy", F.col("total_correct") / F.greatest("possible_correct", F.lit(1)))


def trend(metrics: DataFrame, step: str, value: str) -> DataFrame:
    """One row: slope and intercept of a least-squares line, mean and last value."""
    return metrics.agg(F.regr_slope(value, step).alias("slope"), F.regr_intercept(value, step).alias("intercept"), F.avg(value).alias("mean"), F.max_by(value, step).alias("final"))


def processing_summary(df: DataFrame, source: str, order: str) -> DataFrame:
    """One row: the source, the number of records, and the first one as JSON."""
    return df.agg(F.lit(source).alias("source"), F.count("*").alias("total"), F.to_json(F.min_by(F.struct(*df.columns), order)).alias("sample_record"))


def zero_success(df: DataFrame, rate: str) -> DataFrame:
    """Rows with a rate of exactly nothing."""
    return df.where(F.col(rate) == 0.0)


def page_counts(pages: DataFrame, project: str, status: str, ok: str = "success") -> DataFrame:
    """(project, total_pages, succeeded, failed, rate) of a crawl."""
    return success_rate(pages, [project], F.coalesce(F.col(status) == ok, F.lit(False))).withColumnRenamed("total", "total_pages")


def ranked_within(df: DataFrame, keys: list[str], order: list[Column | str], n: int, name: str = "rank") -> DataFrame:
    """The first n rows of each key."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(name) <= n)
