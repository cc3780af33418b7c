"""Pages and events as streams."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from ..operators.pages import structured


def ingest_pages(spark: SparkSession, folder: str, schema: StructType, files_per_trigger: int = 100) -> DataFrame:
    """A stream of pages from Parquet files that arrive in a folder, with their structure."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)
    return structured(stream)


def windowed_events(events: DataFrame, *, time: str = "ts", late: str = "10 minutes", size: str = "1 hour", keys: tuple[str, ...] = ("event_type",)) -> DataFrame:
    """Counts and sums over tumbling windows; rows later than the watermark are left out when streamed."""
    return events.withWatermark(time, late).groupBy(F.window(time, size).alias("w"), *keys).agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def crawl_progress(requests: DataFrame, *, project: str = "project_id", delta: str = "delta") -> DataFrame:
    """A row for each project when its outstanding requests come down to none: (project, requests, completed).

    requests: +1 for a request sent, -1 for one that ended.  State is two numbers for each project."""

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        open_, sent = state.get if state.exists else (0, 0)
        for frame in frames:
            open_ += int(frame[delta].sum())
            sent += int((frame[delta] > 0).sum())
        state.update((open_, sent))
        if open_ == 0 and sent:
            yield pd.DataFrame({project: [key[0]], "requests": [sent], "completed": [True]})

    kind = dict(requests.dtypes)[project]
    return requests.select(project, delta).groupBy(project).applyInPandasWithState(update, f"{project} {kind}, requests long, completed boolean", "open long, sent long", "update", GroupStateTimeout.NoTimeout)
