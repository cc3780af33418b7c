"""Mixing sources to target weights by Poisson replication, with DataFrame functions only.

A source's mean repetition rate is its target share of the output over its share of the input (in characters).
Each document draws a uniform number from a hash of its id and the seed, and takes as its count the inverse of the
Poisson distribution function at that number; it is then exploded by the count and the copies are shuffled over
all partitions by a second hash.  Counts depend on the id, the seed and the rates alone, so a lost executor's
work comes out the same again.

Rates are one row for each source, written once, with the probabilities of the counts around the rate (ten standard deviations to
either side, so a rate of 1e9 has 700,000).  If these rows and tables are small enough
(``most_sources``, ``most_bytes``, both counted first), they are broadcast and documents aren't moved to meet them.  Beyond
that the join is by source and a salt of the document, with each rate repeated for ``SALTS`` salts, so that a hot
source is met in that many tasks.

Nulls and odd input: a null source is a source of its own with key ''; a null text counts no characters; a null
or repeated id draws what that id draws, in every row that has it; sources without characters have rate 0,
unless all are so, then rate 1; texts are never looked into, so their length doesn't matter; an empty table gives an
empty result.  Input columns named rate, replica or shuffle_key are replaced, all others stay.
"""

from __future__ import annotations

from math import pi

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import checkpointed, fresh

#: Tasks that a source is met in where rates are too many to broadcast.
SALTS = 64
#: Copies of a document that are made together.
RUN = 10_000
#: Hex digits of the hash that make the uniform number: 52 bits, exact in a double.
DIGITS = 13


def uniform(key: Column, salt: str) -> Column:
    """A number in (0, 1) from a hash of the key and the salt."""
    digest = F.md5(F.concat(F.lit(f"{salt}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))
    return (F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("long").cast("double") + 0.5) / float(1 << 4 * DIGITS)


def first_count(rate: Column) -> Column:
    """The least count in the table of a rate: ten standard deviations below it, less 30; what lies before is below 2**-60."""
    return F.floor(F.greatest(rate - 10 * F.sqrt(rate) - 30, F.lit(0.0))).cast("long")


def mass(k: Column, rate: Column) -> Column:
    """The Poisson probability of the count k, exact to some 1e-13 of it also for rates of 1e9 and more.

    Beyond 20, the factorial is written by Stirling's series, and k * ln(k / rate) - (k - rate) by the difference of both, so that
    no large numbers cancel out."""
    x = k.cast("double")
    small = F.exp(x * F.ln(rate) - rate) / F.factorial(F.least(k, F.lit(20)).cast("int"))
    series = (1 - (1 - 2 / (7 * x * x)) / (30 * x * x)) / (12 * x)
    apart = x * F.log1p((x - rate) / rate) - (x - rate)
    return F.when(k <= 20, small).otherwise(F.exp(-series - apart) / F.sqrt(2 * pi * x))


def masses(rate: Column) -> Column:
    """The probabilities of the counts from first_count(rate) on, some 20 * sqrt(rate) + 60 of them."""
    last = F.ceil(rate + 10 * F.sqrt(rate) + 30).cast("long")
    return F.when(rate > 0, F.transform(F.sequence(first_count(rate), last), lambda k: mass(k, rate))).otherwise(F.array(F.lit(1.0)))


def inverse(u: Column, first: Column, probabilities: Column) -> Column:
    """The count at which the distribution function reaches u: how many counts it is below u for."""
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(0).cast("long").alias("n"))
    step = lambda a, p: F.struct((a["sum"] + p).alias("sum"), (a["n"] + F.when(a["sum"] + p < u, 1).otherwise(0)).alias("n"))
    return first + F.aggregate(probabilities, start, step)["n"]


def rates(docs: DataFrame, weights: DataFrame | None = None, *, source: str = "source", text: str = "text", growth: float = 1.0) -> DataFrame:
    """(source_key, rate) for each source of docs.

    weights: (source, weight) targets, relative; sources that it lacks get weight 0.  Without it every
    source weighs the same.  growth: expected characters of the output for each one of the input."""
    key = F.coalesce(F.col(source).cast("string"), F.lit(""))
    sizes = docs.groupBy(key.alias("source_key")).agg(F.coalesce(F.sum(F.length(text).cast("long")), F.lit(0).cast("long")).alias("chars"))
    if weights is None:
        sizes = sizes.withColumn("weight", F.lit(1.0))
    else:
        given = weights.groupBy(F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source_key")).agg(F.sum(F.col("weight").cast("double")).alias("weight"))
        sizes = sizes.join(given, "source_key", "left").withColumn("weight", F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0)))
    # a source with no characters can't take its share, which the others then divide
    sizes = sizes.withColumn("weight", F.when(F.col("chars") > 0, F.col("weight")).otherwise(0.0))
    total = sizes.agg(F.sum("chars").alias("all_chars"), F.sum("weight").alias("all_weight"))
    rate = F.when(F.col("all_chars") == 0, 1.0).when((F.col("chars") > 0) & (F.col("all_weight") > 0), F.lit(float(growth)) * F.col("weight") / F.col("all_weight") * F.col("all_chars") / F.col("chars")).otherwise(0.0)
    return sizes.join(F.broadcast(total)).select("source_key", rate.alias("rate"))  # total is one row


def replicate(docs: DataFrame, weights: DataFrame | None = None, *, id_column: str = "doc_id", source: str = "source", text: str = "text", growth: float = 1.0, seed: int = 17, most_sources: int = 100_000, most_bytes: int = 64 << 20) -> DataFrame:
    """The input's columns for each copy, and rate, replica (0, 1, ...) and shuffle_key, which orders the result globally."""
    docs = docs.drop("rate", "replica", "shuffle_key")
    key, first, odds, n, salt = (fresh(docs, c) for c in ("_source_key", "_first", "_odds", "_n", "_salt"))
    table = rates(docs, weights, source=source, text=text, growth=growth).withColumns({first: first_count(F.col("rate")), odds: masses(F.col("rate"))}).withColumnRenamed("source_key", key)
    table = checkpointed(table)
    size = table.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.octet_length(key) + 8 * F.size(odds) + 32), F.lit(0)).alias("bytes")).first()
    rows = docs.withColumn(key, F.coalesce(F.col(source).cast("string"), F.lit("")))
    if size["rows"] <= most_sources and size["bytes"] <= most_bytes:
        rows = rows.join(F.broadcast(table), key)
    else:
        rows = rows.withColumn(salt, F.pmod(F.xxhash64(id_column, text), F.lit(SALTS)).cast("int"))
        rows = rows.join(table.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), [key, salt]).drop(salt)
    u = uniform(F.col(id_column), f"count{seed}")
    rows = rows.withColumn(n, inverse(u, F.col(first), F.col(odds))).where(F.col(n) > 0).drop(first, odds)
    # in runs of RUN copies, so that no row lists all copies of a document
    rows = rows.withColumn(salt, F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(n) - 1) / RUN))))
    rows = rows.withColumn("replica", F.explode(F.sequence(F.col(salt) * RUN, F.least(F.col(n), F.col(salt) * RUN + RUN) - 1))).select(*docs.columns, "rate", F.col("replica").cast("int").alias("replica"))
    order = F.md5(F.concat_ws(":", F.lit(f"order{seed}"), F.coalesce(F.col(id_column).cast("string"), F.lit("")), F.col("replica")).cast("binary"))
    # rows whose ids are equal or null are dealt by what they hold
    return rows.withColumn("shuffle_key", order).repartition("shuffle_key", F.xxhash64(text, source)).sortWithinPartitions("shuffle_key")
