"""Saving a table again touches only the partitions whose rows have changed.

Each partition has a fingerprint of its rows, whatever their order.  A log beside the data has the fingerprint of what was last
written; before a partition is written its entry is opened (no fingerprint), so that a write that breaks off is done again and
one that was finished is not."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batch_log import BatchLog
from .hadoop import Folder

#: Folders of the logs beside the data: fingerprints of partitions, and what each save found.
PRINTS, SAVES = "_fingerprints", "_saves"


def row_hash(df: DataFrame, columns: list[str]) -> Column:
    """A hash of a row's values that tells nulls apart."""
    parts = []
    for c in sorted(columns):
        kind = dict(df.dtypes)[c]
        value = F.to_json(F.struct(F.col(f"`{c}`")), {"ignoreNullFields": "false"}) if kind.startswith(("map", "array", "struct", "variant")) else F.col(f"`{c}`")
        parts += [value, F.col(f"`{c}`").isNull()]
    return F.xxhash64(*parts) if parts else F.lit(0).cast("long")


def fingerprints(df: DataFrame, partition: str) -> DataFrame:
    """(part, rows, print) for each value of the partition column: a sum and a xor of the rows' hashes, so repeated rows count."""
    rows = df.select(F.col(partition).cast("string").alias("part"), row_hash(df, [c for c in df.columns if c != partition]).alias("h"))
    each = rows.groupBy("part").agg(F.count("*").alias("rows"), F.sum(F.col("h").cast("decimal(38,0)")).alias("s"), F.bit_xor("h").alias("x"))
    return each.select("part", "rows", F.concat_ws(":", F.col("rows").cast("string"), F.col("s").cast("string"), F.col("x").cast("string")).alias("print"))


def save_changed(df: DataFrame, path: str, partition: str, *, drop_missing: bool = False) -> DataFrame:
    """Write df by a partition column, without touching the partitions that already hold its rows; gives (part, rows, state).

    state: added, changed, same, or missing (there before and not in df; it stays unless drop_missing).  Partitions are told apart
    by the column's text, a null is one of its own.  df is read twice, so it must give the same rows each time."""
    spark, path = df.sparkSession, path.rstrip("/")
    prints = BatchLog(spark, f"{path}/{PRINTS}", "part string, rows long, print string")
    saves = BatchLog(spark, f"{path}/{SAVES}", "part string, rows long, print string, state string")
    before, now = prints.latest(["part"]).where("rows <> 0").alias("b"), fingerprints(df, partition).alias("n")
    state = F.when(F.col("n.rows").isNull(), "missing").when(F.col("b.rows").isNull(), "added").when(F.col("n.print") == F.coalesce("b.print", F.lit("")), "same").otherwise("changed")
    found = now.join(before, F.col("n.part").eqNullSafe(F.col("b.part")), "full").select(F.coalesce("n.part", "b.part").alias("part"), F.coalesce("n.rows", F.lit(0).cast("long")).alias("rows"), "n.print", state.alias("state"))
    found = saves.read([saves.append(found)])  # worked out once, before anything is written
    touched = found.where(F.col("state").isin("added", "changed", *(["missing"] if drop_missing else [])))
    if not touched.isEmpty():
        prints.append(touched.select("part", F.lit(-1).cast("long").alias("rows"), F.lit(None).cast("string").alias("print")))
        rows = df.join(touched.select(F.col("part").alias("_part")), F.col(partition).cast("string").eqNullSafe(F.col("_part")), "left_semi")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
        lost = {r["part"] for r in touched.where("state = 'missing'").select("part").toLocalIterator()}  # partitions, each of them a folder
        folder = Folder(spark, path)
        for name in folder.names(f"{partition}=*") if lost else []:
            value = unquote(name.partition("=")[2])
            if (None if value == "__HIVE_DEFAULT_PARTITION__" else value) in lost:
                folder.remove(name)
        prints.append(touched.select("part", "rows", "print"))
    return found.select("part", "rows", "state")
