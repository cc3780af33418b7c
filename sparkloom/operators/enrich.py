"""Enrichment of values by a service, behind a small protocol; offline use goes through a deterministic stand-in."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.batch_log import BatchLog


class Enricher(Protocol):
    """Answers a block of values at once, in order; it must be picklable and may raise."""

    def __call__(self, values: list[str], context: str) -> list[str]: ...


def echo(values: list[str], context: str) -> list[str]:
    """A stand-in that answers with the context and the value."""
    return [f"{context}: {v}" if context else v for v in values]


def with_retries(call: Callable[[list[str], str], list[str]], values: list[str], context: str, retries: int = 3, pause: float = 1.0) -> list[str | None]:
    """Answers of a block; a failed call is tried again after 1, 2, 4, ... pauses, then each value by itself.

    A value whose own calls fail is answered by 'Error: ...'; a block answered with another number of lines
    than it has goes value by value too."""

    def attempt(block: list[str]) -> list[str] | Exception:
        last: Exception = ValueError("no attempt")
        for k in range(retries):
            try:
                return call(block, context)
            except Exception as e:
                last = e
                time.sleep(pause * 2**k)
        return last

    got = attempt(values)
    if not isinstance(got, Exception) and len(got) == len(values):
        return got
    out: list[str | None] = []
    for v in values:
        one = attempt([v])
        out.append(f"Error: {one}" if isinstance(one, Exception) else one[0] if one else None)
    return out


def _answers(asked: DataFrame, call: Enricher, context: str, block: int, retries: int, pause: float) -> DataFrame:
    """(value, answer) of a table of values, asked for in blocks."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), block):
                part = frame["value"].tolist()[at : at + block]
                yield pd.DataFrame({"value": part, "answer": with_retries(call, part, context, retries, pause)})

    return asked.select("value").mapInPandas(run, "value string, answer string")


def enrich_distinct(df: DataFrame, column: str, answer: str, call: Enricher, *, context: str = "", block: int = 50, retries: int = 3, pause: float = 1.0, cache: DataFrame | None = None) -> DataFrame:
    """df with the answers for ``column``; each distinct non-blank value is asked for once, in blocks.

    cache: (value, answer) known from before, whose values aren't asked for again."""
    values = df.select(F.col(column).alias("value")).where("value is not null and trim(value) <> ''").distinct()
    asked = values if cache is None else values.join(cache, "value", "left_anti")
    found = _answers(asked, call, context, block, retries, pause)
    if cache is not None:
        found = found.union(cache.select("value", "answer"))
    return df.join(found.withColumnsRenamed({"value": column, "answer": answer}), column, "left")


def prompt(template: str, columns: list[str]) -> Column:
    """A prompt from a template with {column} in the places of values; nulls are written as ''."""
    out = F.lit(template)
    for c in columns:
        out = F.replace(out, F.lit("{" + c + "}"), F.coalesce(F.col(c).cast("string"), F.lit("")))
    return out


def ask_repeatedly(df: DataFrame, prompt_column: str, call: Enricher, votes: int = 3, **options) -> DataFrame:
    """A row for each of ``votes`` answers to each row's prompt, numbered by ``vote``."""
    rows = df.withColumn("vote", F.explode(F.sequence(F.lit(1), F.lit(votes))))
    rows = rows.withColumn("_ask", F.concat_ws("\u0001", F.col("vote").cast("string"), prompt_column))

    def numbered(values: list[str], context: str) -> list[str]:
        return call([v.split("\u0001", 1)[1] for v in values], context)

    return enrich_distinct(rows, "_ask", "answer", numbered, **options).drop("_ask")


class AnswerLog:
    """Answers that outlive a run: (context, value, ok, answer) in a folder of batches that any number of runs add to at once.

    The answer written last holds; one that failed never takes the place of one that didn't."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.log = BatchLog(spark, path, "context string, value string, ok boolean, answer string")

    def known(self, context: str = "", batches: list[str] | None = None) -> DataFrame:
        """(value, answer) of the values that have been answered in a context."""
        rows = self.log.latest(["context", "value", "ok"], batches)
        return rows.where((F.col("context") == context) & F.col("ok")).select("value", "answer")

    def add(self, answers: DataFrame, context: str = "") -> str:
        """Add (value, answer) as a batch; gives its name."""
        ok = F.coalesce(~F.startswith("answer", F.lit("Error: ")), F.lit(False))
        return self.log.append(answers.select(F.lit(context).alias("context"), "value", ok.alias("ok"), "answer"))

    def merge(self) -> str | None:
        return self.log.merge(["context", "value", "ok"])


def enrich_logged(df: DataFrame, column: str, answer: str, call: Enricher, log: AnswerLog, *, context: str = "", block: int = 50, retries: int = 3, pause: float = 1.0) -> DataFrame:
    """As ``enrich_distinct``, with a log as the cache: answers are in the log before the result is read, so no later run asks for them.

    Values whose calls fail are answered by 'Error: ...' here, and asked for again by the next run."""
    known = log.known(context)
    values = df.select(F.col(column).alias("value")).where("value is not null and trim(value) <> ''").distinct()
    mine = log.add(_answers(values.join(known, "value", "left_anti"), call, context, block, retries, pause), context)
    fresh = log.log.read([mine]).select("value", "answer")
    found = known.union(fresh).withColumnsRenamed({"value": column, "answer": answer})
    return df.join(found, column, "left")
