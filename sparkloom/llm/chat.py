"""Chat formatting: collapse cumulative snapshots, then render.

Logged conversations are often saved after every turn, so that one is a prefix of another.  Each turn is hashed
with its position; the running sum of these hashes over a conversation, in four lanes of 32 bits, is the
hash of the prefix that ends there (SHA-256 supplies the bits).  A conversation whose whole hash and length
equal a proper prefix of some other one is dropped by an anti-join; of equal conversations the one with the
smallest id stays.  What remains is rendered.

Prefixes are made distinct, and equal conversations one row, before the join, so a first turn or a conversation
that a large part of the rows shares is one row on either side.  The running sum streams over a sorted
partition and holds no list; lists of turns are made only for the conversations that are rendered.

Nulls and odd input: turns are rendered in the order of turn, role, text, nulls first (for hashes, text counts by its
own hash); repeated rows are repeated turns; a null role or text differs from an empty one; a row with a null conversation id
is a conversation of its own, so that such rows, however many, form no group; an empty table gives an empty result; other
columns are ignored.  A conversation is one row of the result, so its turns must fit in a row; texts may be as long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LANES = 4


def _marked(c: str) -> Column:
    """Text that tells null from any string."""
    return F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit(""))


def _named(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    return turns.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))


def _content() -> Column:
    return F.sha2(F.concat_ws("\u0000", F.length(_marked("role")).cast("string"), _marked("role"), _marked("text")), 256)


def _lanes(n: Column, content: Column) -> dict[str, Column]:
    place = F.sha2(F.concat_ws(":", n, content), 256)
    return {f"h{i}": F.conv(F.substring(place, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(LANES)}


def turn_prefixes(turns: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, n: turns so far, h0..h3: hash of the prefix) for each turn of the conversations that have an id."""
    base = _named(turns, conv, turn, role, text).where("conv is not null").select("conv", "turn", "role", _content().alias("content"))
    order = Window.partitionBy("conv").orderBy("turn", F.col("role").asc_nulls_first(), "content")
    placed = base.withColumn("n", F.row_number().over(order).cast("long"))
    placed = placed.withColumns(_lanes(F.col("n"), F.col("content")))
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    return placed.select("conv", "n", *[F.sum(f"h{i}").over(running).alias(f"h{i}") for i in range(LANES)])


def maximal_conversations(turns: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, n_turns, n_equal, alone) of the conversations that are no prefix of another; alone: (role, text) of one
    whose rows have no id."""
    hashes = [f"h{i}" for i in range(LANES)]
    prefixes = turn_prefixes(turns, conv=conv, turn=turn, role=role, text=text)
    whole = prefixes.groupBy("conv").agg(F.max_by(F.struct("n", *hashes), "n").alias("w")).select("conv", "w.*")
    proper = prefixes.join(whole.select("conv", F.col("n").alias("last")), "conv").where("n < last").select("n", *hashes).distinct()
    single = _named(turns, conv, turn, role, text).where("conv is null").withColumns({"n": F.lit(1).cast("long")} | _lanes(F.lit(1), _content()))
    single = single.groupBy("n", *hashes).agg(F.any_value(F.struct("role", "text")).alias("alone"), F.count("*").alias("m"))
    rows = whole.select("conv", "n", *hashes, F.lit(None).cast(single.schema["alone"].dataType).alias("alone"), F.lit(1).cast("long").alias("m"))
    rows = rows.union(single.select(F.lit(None).cast(rows.schema["conv"].dataType), "n", *hashes, "alone", "m"))
    first = rows.groupBy("n", *hashes).agg(F.min("conv").alias("conv"), F.sum("m").alias("n_equal"), F.any_value("alone", F.lit(True)).alias("alone"))
    kept = first.join(proper, ["n", *hashes], "left_anti")
    return kept.select("conv", F.col("n").alias("n_turns"), "n_equal", F.when(F.col("conv").isNull(), F.col("alone")).alias("alone"))


def render(turns: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", opening: str = "<|im_start|>", closing: str = "<|im_end|>") -> DataFrame:
    """(conv, n_turns, n_equal: equal conversations merged, rendered) of each maximal conversation."""
    kept = maximal_conversations(turns, conv=conv, turn=turn, role=role, text=text)
    line = lambda t: F.concat(F.lit(opening), F.coalesce(t["role"], F.lit("")), F.lit("\n"), F.coalesce(t["text"], F.lit("")), F.lit(closing + "\n"))
    named = kept.where("conv is not null").drop("alone")
    listed = _named(turns, conv, turn, role, text).join(named, "conv").groupBy("conv", "n_turns", "n_equal").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    out = listed.select("conv", "n_turns", "n_equal", F.array_join(F.transform("turns", line), "").alias("rendered"))
    alone = kept.where("conv is null").select("conv", "n_turns", "n_equal", line(F.col("alone")).alias("rendered"))
    return out.union(alone).withColumnRenamed("conv", conv)
