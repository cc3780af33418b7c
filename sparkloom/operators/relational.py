"""Deduplication, dimensions, set operations, ordered groups and running values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import edge_strip, split_list


def first_seen(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row of each key by ``order``; null keys are equal.  An aggregate, so it combines before the shuffle."""
    row = F.min_by(F.struct(*df.columns), F.col(order)).alias("row")
    return df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(row).select("row.*")


def last_written(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row of each key by ``order``."""
    return df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.max_by(F.struct(*df.columns), F.col(order)).alias("row")).select("row.*")


def distinct_values(df: DataFrame, column: str, alias: str | None = None) -> DataFrame:
    """Stripped, non-blank, distinct values of a column."""
    return df.select(edge_strip(column).alias(alias or column)).where(F.col(alias or column) != "").distinct()


def distinct_parts(df: DataFrame, column: str, alias: str, separators: str | None = None) -> DataFrame:
    """Distinct parts of a multi-valued column."""
    parts = split_list(column) if separators is None else split_list(column, separators)
    return df.select(F.explode(parts).alias(alias)).distinct()


def geography(df: DataFrame, city: str = "city", state: str = "state_province", country: str = "country_region") -> dict[str, DataFrame]:
    """The distinct cities, states and countries of a table."""
    return {"cities": df.select(city, state, country).distinct(), "states": df.where(F.coalesce(state, F.lit("")) != "").select(state, country).distinct(), "countries": df.select(country).distinct()}


def only_in(df: DataFrame, other: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows whose key the other table has."""
    return df.join(other, on, "left_semi")


def not_in(df: DataFrame, other: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows whose key the other table lacks."""
    return df.join(other, on, "left_anti")


def merge_new(old: DataFrame, new: DataFrame, keys: list[str], order: str) -> DataFrame:
    """old, and the first of each key in new that old lacks."""
    return old.unionByName(not_in(first_seen(new, keys, order), old, keys), allowMissingColumns=True)


def group_rows(df: DataFrame, order: str, every: int, within: list[str] | None = None, name: str = "step") -> DataFrame:
    """Number each run of ``every`` consecutive rows by ``order``: 1, 2, ...

    With ``within`` the count starts anew for each key.  Without it positions come from a range-partitioned sort: only
    partition sizes meet on one side, not rows."""
    if within:
        n = F.row_number().over(Window.partitionBy(*within).orderBy(order))
        return df.withColumn(name, F.floor((n - 1) / every).cast("long") + 1)
    return positions(df, order, "_n").withColumn(name, F.floor(F.col("_n") / every).cast("long") + 1).drop("_n")


def positions(df: DataFrame, order: str, name: str = "position", depth: int = 10) -> DataFrame:
    """0-based position of each row by a numeric ``order`` that tells rows apart.

    Rows are cut to 2**depth ranges that hold about as many rows each, however the numbers lie (bounds are approximate
    percentiles, one row); the ranges' sizes are summed up, a table of bounded size, and rows are numbered within their
    range, so no task sorts the whole table.  Rows without a number come first."""
    n = 1 << depth
    bounds = df.agg(F.percentile_approx(order, [i / n for i in range(1, n)], 10 * n).alias("_bounds"))  # one row
    halves = F.array(*[F.lit(1 << i) for i in range(depth - 1, -1, -1)])
    place = F.aggregate(halves, F.lit(0), lambda a, s: F.when(F.coalesce(F.get("_bounds", a + s - 1) < F.col(order), F.lit(False)), a + s).otherwise(a))
    cut = df.crossJoin(F.broadcast(bounds)).withColumn("_b", place).drop("_bounds")
    sizes = cut.groupBy("_b").agg(F.count("*").alias("_c"))
    before = sizes.withColumn("_before", F.sum("_c").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))).select("_b", F.coalesce("_before", F.lit(0)).alias("_before"))
    numbered = cut.withColumn("_r", F.row_number().over(Window.partitionBy("_b").orderBy(order)))
    return numbered.join(F.broadcast(before), "_b").withColumn(name, F.col("_before") + F.col("_r") - 1).drop("_b", "_before", "_r")  # at most 2**depth rows


def places_within(df: DataFrame, keys: list[str], by: Column, tie: list[str], name: str = "place", digits: int = 3) -> DataFrame:
    """0-based place of each row among the rows of its key, in the order of an MD5 of ``by``: an even shuffle that other engines can make too.

    The leading hex digits of the hash deal a key's rows to 16**digits ranges of about equal size.  Ranges are counted for each key and the counts added
    up, so rows are numbered in their range only and a hot key is never sorted in one task.  Rows of equal hash are ordered by ``tie``."""
    rows = df.withColumn("_h", F.md5(F.coalesce(by.cast("string"), F.lit("")).cast("binary")))
    rows = rows.withColumn("_b", F.substring("_h", 1, digits))
    sizes = rows.groupBy(*keys, "_b").agg(F.count("*").alias("_c"))
    before = F.sum("_c").over(Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_c")
    sizes = sizes.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_b").alias("_range"), before.alias("_before"))  # 16**digits rows for each key at most
    numbered = rows.withColumn("_r", F.row_number().over(Window.partitionBy(*keys, "_b").orderBy("_h", *tie)))
    same = F.col("_b") == F.col("_range")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return numbered.join(sizes, same).withColumn(name, F.col("_before") + F.col("_r") - 1).select(*df.columns, name)


def carry_forward(df: DataFrame, markers: dict[str, Column], order: str, within: list[str]) -> DataFrame:
    """Add the last non-null value of each marker up to the row, for each key."""
    w = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({name: F.last(m, ignorenulls=True).over(w) for name, m in markers.items()})


def running_sum(df: DataFrame, delta: Column, order: str, within: list[str], name: str = "outstanding") -> DataFrame:
    """Add the sum of delta up to the row, for each key."""
    w = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.sum(delta).over(w))


def progress(df: DataFrame, order: str, within: list[str], name: str = "progress_pct") -> DataFrame:
    """Add how much of each key's rows is done at the row, in percent."""
    w = Window.partitionBy(*within)
    return df.withColumn(name, F.round(F.row_number().over(w.orderBy(order)) / F.count("*").over(w) * 100, 4))


def top(df: DataFrame, by: str, n: int, tie: str) -> DataFrame:
    """The n rows with the largest value; of equals the smallest tie."""
    return df.orderBy(F.desc(by), tie).limit(n)


def top_with_rest(df: DataFrame, order: list[str], n: int) -> tuple[DataFrame, DataFrame]:
    """The first n rows, and a one-row table with how many more there are."""
    return df.orderBy(*order).limit(n), df.agg(F.greatest(F.count("*") - n, F.lit(0)).alias("more"))


def unranked_top(df: DataFrame, rank: Column, limit: int, subjects: list[str]) -> DataFrame:
    """Rows ranked within the limit that have no subject rank at all."""
    return df.where((rank <= limit) & reduce(lambda a, b: a & b, [F.col(c).isNull() for c in subjects], F.lit(True)))
