"""Jobs done group after group, with a durable record: a run stops at the first group that fails, and the next run goes on from there."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.batch_log import BatchLog

Job = Callable[[SparkSession], DataFrame]


class GroupFailed(RuntimeError):
    """A group's job failed; the groups behind it were not begun."""


class Ledger:
    """What became of each group: entries (name, state, run, detail) are added and never changed, the last one holds.

    An entry is in the folder before the step behind it begins, so a driver that is lost between a group's rows and its entry
    does that group again, which replaces its rows by the same ones."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.log = spark, BatchLog(spark, path, "name string, state string, run string, detail string")

    def note(self, name: str, state: str, run: str, detail: str = "") -> None:
        self.log.append(self.spark.createDataFrame([(name, state, run, detail)], "name string, state string, run string, detail string").coalesce(1))

    def states(self) -> DataFrame:
        """(name, state, run, detail, _at, _batch): the last entry of each group."""
        return self.log.latest(["name"])

    def done(self) -> set[str]:
        return {r["name"] for r in self.states().where("state = 'done'").collect()}  # names of groups, which the driver has anyway


def run_groups(spark: SparkSession, groups: Iterable[tuple[str, Job]], ledger: Ledger, output: str) -> list[str]:
    """Write each group's rows to ``output/group=<name>``, in order; gives the groups that this call did.

    Groups that are done are passed over.  A failure is noted and raised as GroupFailed, and no group behind it begins.  Names are letters,
    digits, _ and -."""
    groups = list(groups)
    for name, _ in groups:
        if not name.replace("_", "").replace("-", "").isalnum():
            raise ValueError(f"{name!r} can't name a folder")
    if len({name for name, _ in groups}) < len(groups):
        raise ValueError("two groups have one name")
    finished, run, mine = ledger.done(), uuid.uuid4().hex, []
    for name, job in groups:
        if name in finished:
            continue
        ledger.note(name, "started", run)
        try:
            job(spark).write.mode("overwrite").parquet(f"{output}/group={name}")
        except Exception as e:
            ledger.note(name, "failed", run, str(e)[:1000])
            raise GroupFailed(name) from e
        ledger.note(name, "done", run)
        mine.append(name)
    return mine


def groups_of(df: DataFrame, column: str, job: Callable[[DataFrame], DataFrame]) -> list[tuple[str, Job]]:
    """A group for each value of a column, in order of the values: the job gets its rows.  Values name folders, so there are few."""
    names = [r[0] for r in df.where(F.col(column).isNotNull()).select(F.col(column).cast("string")).distinct().collect()]
    return [(name, lambda _, n=name: job(df.where(F.col(column).cast("string") == n))) for name in sorted(names)]
