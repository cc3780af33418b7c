"""Crawl logs: projects that begin and end in lines of text, paired by what stands before them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .relational import carry_forward

# How a project's name, its address, its end and its success rate are marked.
MARKS = {"project": r"项目名称: (.+)", "root_url": r"根URL: (.+)", "completed": r"项目完成: (.+)", "rate": r"成功率: ([\d.]+)%"}
# Fixed value: the address of a project that has none.
NO_ADDRESS = "未知URL"


def mark(line: Column | str, kind: str) -> Column:
    """What stands behind a mark in a line, null if the line doesn't have it."""
    line = F.col(line) if isinstance(line, str) else line
    return F.when(line.rlike(MARKS[kind]), F.trim(F.regexp_extract(line, MARKS[kind], 1)))


def project_outcomes(lines: DataFrame, *, file: str = "file", order: str = "line_no", line: str = "value") -> DataFrame:
    """(file, line_no, project, root_url, rate) for each project that ended with a rate.

    An address belongs to the project named before it, the first one if several follow; a rate likewise to the project completed
    before it.  A project's address is the last one it had up to then.  Only marked lines are sorted, within their file."""
    marked = lines.select(file, order, *[mark(line, k).alias(k) for k in MARKS])
    kind = F.when(F.col("project").isNotNull(), "project").when(F.col("root_url").isNotNull(), "root_url").when(F.col("completed").isNotNull(), "completed").when(F.col("rate").isNotNull(), "rate")
    marked = marked.withColumn("_kind", kind).where("_kind is not null").withColumn("_pair", F.col("_kind").isin("project", "root_url"))
    before = Window.partitionBy(file, "_pair").orderBy(order)
    marked = marked.withColumns({"_last": F.lag("_kind").over(before), "_name": F.lag(F.coalesce("project", "completed")).over(before)})
    owned = marked.where("(_kind = 'root_url' and _last = 'project') or (_kind = 'rate' and _last = 'completed')").withColumnRenamed("_name", "name")
    known = carry_forward(owned, {"_url": F.col("root_url")}, order, [file, "name"])
    return known.where("_kind = 'rate'").select(file, order, F.col("name").alias("project"), F.coalesce("_url", F.lit(NO_ADDRESS)).alias("root_url"), F.col("rate").try_cast("double").alias("rate"))
