"""Writers.  Tables are written by the executors; only reports of bounded size pass through the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import file_name


def write_csv(df: DataFrame, path: str, *, bom: bool = False, mode: str = "overwrite") -> None:
    """CSV with a header, quoted where needed.  With ``bom`` each file's first column name carries a byte-order mark."""
    if bom:
        df = df.toDF("\ufeff" + df.columns[0], *df.columns[1:])
    df.write.mode(mode).option("header", True).option("quoteAll", False).option("escape", '"').csv(path)


def write_csv_per_column(df: DataFrame, core: list[str], path: str, columns: list[str] | None = None) -> list[str]:
    """A CSV folder for each further column, with the core columns."""
    out = []
    for c in columns or [c for c in df.columns if c not in core]:
        write_csv(df.select(*core, c), f"{path}/{c}")
        out.append(c)
    return out


def write_json(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    """A JSON object on each line; fields that are null are written too."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_by_entity(df: DataFrame, path: str, folder: str | Column, *, mode: str = "overwrite") -> None:
    """JSON in a folder for each (safe) value of a column; only folders that get rows are replaced."""
    name = file_name(folder)
    df.withColumn("folder", name).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("folder").json(path)


def write_name_list(df: DataFrame, column: str, path: str) -> None:
    """Sorted distinct values as text, one on each line."""
    df.select(F.col(column).cast("string").alias("value")).where("value is not null").distinct().orderBy("value").write.mode("overwrite").text(path)


def markdown_table(df: DataFrame, most: int = 200) -> str:
    """A Markdown table of the first rows, and how many more there are; all rows belong in a table of their own."""
    rows = df.limit(most + 1).collect()
    more = df.count() - most if len(rows) > most else 0
    cell = lambda v: "" if v is None else str(v).replace("|", "\\|").replace("\n", " ")
    lines = ["| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
    lines += ["| " + " | ".join(cell(v) for v in r) + " |" for r in rows[:most]]
    return "\n".join([*lines, "", f"... and {more} more rows"] if more else lines)


def write_markdown_report(sections: dict[str, DataFrame], path: str, title: str, most: int = 200) -> None:
    """A report with a table for each section, as one text file in the folder."""
    spark = next(iter(sections.values())).sparkSession
    text = "\n\n".join([f"# {title}", *(f"## {name}\n\n{markdown_table(df, most)}" for name, df in sections.items())])
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
