"""What outlives a run: batches, saved partitions, answers, the record of groups; and the line of projects that wait."""

import datetime

import pytest
from pyspark.sql import functions as F

from sparkloom.operators import batches, enrich
from sparkloom.sources.batch_log import BatchLog
from sparkloom.sources.incremental import save_changed


def files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in path.rglob("part-*") if not any(x.startswith("_") for x in p.relative_to(path).parts)}


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_batches_of_two_writers(spark, tmp_path):
    one, two = (BatchLog(spark, str(tmp_path / "log"), "k string, v int") for _ in range(2))
    df = lambda *rows: spark.createDataFrame(rows, "k string, v int")
    assert one.read().count() == 0 and one.merge(["k"]) is None
    one.append(df(("a", 1), ("b", 1)))
    two.append(df(("a", 2)))
    assert rows_of(one.latest(["k"]).select("k", "v")) == [("a", 2), ("b", 1)]
    seen = one.batches()
    late = two.append(df(("c", 5)))  # comes while one merges what it has seen
    one.batches = lambda: seen
    merged = one.merge(["k"])
    assert two.batches() == sorted([late, merged]) and rows_of(two.latest(["k"]).select("k", "v")) == [("a", 2), ("b", 1), ("c", 5)]
    (tmp_path / "log" / "_writing-x").mkdir()  # of a writer that broke off
    assert two.read().count() == 3


def test_only_changed_partitions_are_written(spark, tmp_path):
    out = tmp_path / "t"
    df = lambda *rows: spark.createDataFrame(rows, "p string, v int, w string")
    first = [("a", 1, None), ("a", 2, "x"), ("b/c", 1, "y"), (None, 3, "z"), ("d", 9, "d")]
    state = lambda rows, **k: {r["part"]: r["state"] for r in save_changed(df(*rows), str(out), "p", **k).collect()}
    assert state(first) == {"a": "added", "b/c": "added", None: "added", "d": "added"}
    before = files(out)
    assert state([first[1], first[0], *first[2:]]) == dict.fromkeys(["a", "b/c", None, "d"], "same") and files(out) == before
    second = [("a", 1, "x"), ("a", 2, None), ("b/c", 1, "y"), ("e", 1, "n"), (None, 3, "z")]
    assert state(second) == {"a": "changed", "b/c": "same", None: "same", "e": "added", "d": "missing"}
    after = files(out)
    assert {k for k in before if before[k] != after.get(k)} == {k for k in before if k.startswith("p=a/")}
    assert rows_of(spark.read.parquet(str(out)).select("p", "v", "w")) == sorted([*second, first[4]], key=repr)
    assert state(second, drop_missing=True)["d"] == "missing" and not (out / "p=d").exists()
    assert state(second, drop_missing=True) == dict.fromkeys(["a", "b/c", None, "e"], "same")
    assert state([*second, first[4]])["d"] == "added"


def test_a_save_that_broke_off_is_done_again(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "t")
    df = lambda v: spark.createDataFrame([("a", v), ("b", 1)], "p string, v int")
    save_changed(df(1), out, "p")
    real, calls = BatchLog.append, []

    def append(self, rows):
        calls.append(self.folder.path)
        if len(calls) == 3:  # the rows are there, the entry that closes isn't
            raise OSError("lost")
        return real(self, rows)

    monkeypatch.setattr(BatchLog, "append", append)
    with pytest.raises(OSError):
        save_changed(df(2), out, "p")
    monkeypatch.setattr(BatchLog, "append", real)
    assert {r["part"]: r["state"] for r in save_changed(df(1), out, "p").collect()} == {"a": "changed", "b": "same"}
    assert rows_of(spark.read.parquet(out).select("p", "v")) == [("a", 1), ("b", 1)]


def test_answers_are_asked_for_once(spark, tmp_path):
    asked = tmp_path / "asked"
    asked.mkdir()

    def call(values, context):
        for v in values:
            if v == "bad" and not (asked / "mend").exists():
                raise ValueError("no")
            with (asked / f"of-{v}").open("a") as f:
                f.write("x")
        return [f"{context}{v.upper()}" for v in values]

    df = spark.createDataFrame([("a",), ("b",), ("a",), ("bad",), (None,), (" ",)], "v string")
    log = enrich.AnswerLog(spark, str(tmp_path / "log"))
    get = lambda log, **k: dict(rows_of(enrich.enrich_logged(df.where("v is not null"), "v", "w", call, log, block=1, pause=0, **k)))
    assert get(log) == {"a": "A", "b": "B", "bad": "Error: no", " ": None}
    count = lambda v: len((asked / f"of-{v}").read_text())
    (asked / "mend").touch()
    again = enrich.AnswerLog(spark, str(tmp_path / "log"))
    assert get(again) == {"a": "A", "b": "B", "bad": "BAD", " ": None} and (count("a"), count("b"), count("bad")) == (1, 1, 1)
    # an error that another writer adds later doesn't hide an answer, also after merging
    log.add(spark.createDataFrame([("a", "Error: late"), ("c", None)], "value string, answer string"))
    assert again.merge() and len(again.log.batches()) == 1
    assert get(log) == {"a": "A", "b": "B", "bad": "BAD", " ": None} and count("a") == 1
    assert get(log, context="de:")["a"] == "de:A" and count("a") == 2


def test_groups_stop_and_go_on(spark, tmp_path):
    ran, broken = [], {"b"}

    def job(name, n):
        def run(session):
            ran.append(name)
            if name in broken:
                raise ValueError("no pages")
            return session.range(n)

        return name, run

    groups = [job("a", 3), job("b", 4), job("c", 5)]
    ledger = batches.Ledger(spark, str(tmp_path / "ledger"))
    with pytest.raises(batches.GroupFailed, match="b"):
        batches.run_groups(spark, groups, ledger, str(tmp_path / "out"))
    assert ran == ["a", "b"] and {r["name"]: r["state"] for r in ledger.states().collect()} == {"a": "done", "b": "failed"}
    assert "no pages" in ledger.states().where("name = 'b'").first()["detail"]
    broken.clear()
    ledger.note("c", "started", "lost run")  # a driver that was lost before c was done
    assert batches.run_groups(spark, groups, batches.Ledger(spark, str(tmp_path / "ledger")), str(tmp_path / "out")) == ["b", "c"]
    assert ran == ["a", "b", "b", "c"] and batches.run_groups(spark, groups, ledger, str(tmp_path / "out")) == []
    assert {r["group"]: r["n"] for r in spark.read.parquet(str(tmp_path / "out")).groupBy("group").agg(F.count("*").alias("n")).collect()} == {"a": 3, "b": 4, "c": 5}
    for bad in ([job("x/y", 1)], [job("x", 1), job("x", 1)]):
        with pytest.raises(ValueError):
            batches.run_groups(spark, bad, ledger, str(tmp_path / "out"))
    df = spark.createDataFrame([("q", 1), ("p", 2), (None, 3)], "g string, v int")
    assert batches.run_groups(spark, batches.groups_of(df, "g", lambda x: x.select("v")), ledger, str(tmp_path / "by")) == ["p", "q"]


def test_the_next_project_begins_when_one_is_idle(spark, tmp_path):
    from sparkloom.streaming.idle import next_when_idle

    at = lambda m, s=0: datetime.datetime(2025, 1, 1, 10, m, s)
    # a works until 10:03 and is idle at 10:08, so b begins; the late row of b (10:00) changes nothing, that of 10:12 does; c comes when nothing runs
    steps = [
        [("k", at(0), "queue", "a"), ("k", at(0), "queue", "b"), ("k", at(1), "page", "a"), ("k", at(3), "page", "a"), ("other", at(0), "queue", "z")],
        [("clock", at(12), "tick", None)],
        [("k", at(0), "page", "b"), ("k", at(12), "page", "b"), ("clock", at(20), "tick", None)],
        [("k", at(30), "queue", "c"), ("clock", at(31), "tick", None)],
        [("clock", at(50), "tick", None)],
        [("clock", at(51), "tick", None)],
    ]
    schema = "crawler string, ts timestamp, kind string, project string"
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        for k, rows in enumerate(steps):
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
            q = next_when_idle(stream, gap="5 minutes", late="1 minute").writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
            q.awaitTermination(120)
            assert q.exception() is None
    finally:
        spark.conf.set(provider, before)
    got = [(r["crawler"], r["project"], r["event"], r["at"]) for r in spark.read.parquet(str(tmp_path / "out")).orderBy("crawler", "at", "project").collect()]
    assert got == [
        ("k", "a", "start", at(0)), ("k", "a", "idle", at(8)), ("k", "b", "start", at(8)), ("k", "b", "idle", at(17)), ("k", "c", "start", at(30)), ("k", "c", "idle", at(35)),
        ("other", "z", "start", at(0)), ("other", "z", "idle", at(5)),
    ]
