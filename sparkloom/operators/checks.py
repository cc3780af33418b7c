"""Rows that break rules leave with their reasons, in the pass that lets the others through."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def reasons(rules: dict[str, Column]) -> Column:
    """The names of the rules, in their order, that don't hold for a row; a rule that gives null doesn't hold."""
    return F.array_compact(F.array(*[F.when(~F.coalesce(rule, F.lit(False)), name) for name, rule in rules.items()]))


def rejected(df: DataFrame, rules: dict[str, Column], name: str = "reasons") -> DataFrame:
    """The rows for which a rule doesn't hold, with the names of those rules."""
    return df.withColumn(name, reasons(rules)).where(F.size(name) > 0)


def reason_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(reason, n): rows for which each rule doesn't hold."""
    return df.select(F.explode(reasons(rules)).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def write_checked(df: DataFrame, rules: dict[str, Column], path: str, *, mode: str = "overwrite") -> dict[str, int]:
    """Write good rows to ``path/state=good`` and the others, with ``reasons``, to ``path/state=rejected``, in one job that reads df once.

    Gives the counts that the job observed: all, good, rejected, and a count for each rule."""
    seen = Observation()
    flagged = df.withColumn("reasons", reasons(rules)).withColumn("state", F.when(F.size("reasons") > 0, "rejected").otherwise("good"))
    counts = [F.count("*").alias("all"), F.count_if(F.col("state") == "good").alias("good"), F.count_if(F.col("state") == "rejected").alias("rejected")]
    counts += [F.count_if(F.array_contains("reasons", name)).alias(f"rule:{name}") for name in rules]
    flagged.observe(seen, *counts).write.mode(mode).partitionBy("state").parquet(path)
    return seen.get
