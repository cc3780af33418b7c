import decimal
import math

import pytest

from sparkloom.llm import mixing
from sparkloom.llm.queries import OP6_SQL, op6_mixing


def test_sql(spark, sf_dir):
    from oracle import assert_same, connect

    assert_same(op6_mixing(spark, sf_dir), connect(sf_dir), OP6_SQL)


def test_no_python_in_the_plan(spark, sf_dir):
    plan = op6_mixing(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


@pytest.mark.parametrize("rate", [0.0, 1e-6, 0.3, 2.5, 40.0, 1200.0, 1e6, 1e9])
def test_masses(spark, rate):
    from pyspark.sql import functions as F

    row = spark.range(1).select(mixing.first_count(F.lit(rate)).alias("first"), mixing.masses(F.lit(rate)).alias("p")).first()
    got, first = row["p"], row["first"]
    assert len(got) <= 20 * math.sqrt(rate) + 63 and abs(math.fsum(got) - 1) < 1e-9
    with decimal.localcontext(prec=40):
        r = decimal.Decimal(rate)
        for at in range(0, len(got), max(1, len(got) // 7)):
            k = first + at
            if rate == 0:
                want = 1.0
            elif rate <= 1200:
                want = float((r**k) * (-r).exp() / math.factorial(k)) if k else math.exp(-rate)
            else:  # from the neighbour: p(k + 1) = p(k) * rate / (k + 1)
                want = got[at - 1] * rate / k if at else got[at]
            assert got[at] == pytest.approx(want, rel=1e-10, abs=1e-300)


@pytest.mark.parametrize("rate", [0.0, 0.7, 30.0, 50_000.0])
def test_inverse(spark, rate):
    from pyspark.sql import functions as F

    df = spark.range(300).select(((F.col("id") + 0.5) / 300).alias("u"), F.lit(rate).alias("r"))
    got = [r["n"] for r in df.select("u", mixing.inverse(F.col("u"), mixing.first_count(F.col("r")), mixing.masses(F.col("r"))).alias("n")).orderBy("u").collect()]
    p, first = spark.range(1).select(mixing.masses(F.lit(rate)).alias("p"), mixing.first_count(F.lit(rate)).alias("f")).first()
    cdf, total = [], 0.0
    for x in p:
        total += x
        cdf.append(total)
    assert got == [first + sum(c < (i + 0.5) / 300 for c in cdf) for i in range(300)]
    assert abs(sum(got) / 300 - rate) < 0.1 * math.sqrt(rate) + 0.01


def test_one_character_beside_ten_megabytes(spark):
    """The small source is repeated ten million times over, in expectation."""
    df = spark.createDataFrame([(1, "x", "small")] + [(i, "y" * 100_000, "large") for i in range(2, 102)], "doc_id long, text string, source string")
    assert mixing.rates(df).where("source_key = 'small'").first()["rate"] == pytest.approx(5_000_000.5)
    n = {r["source"]: r["n"] for r in mixing.replicate(df).groupBy("source").agg({"replica": "count"}).withColumnRenamed("count(replica)", "n").collect()}
    assert abs(n["small"] - 5_000_000) < 12_000 and 30 < n["large"] < 75


def test_weights_and_odd_rows(spark):
    rows = [(i, "x" * 100, "a") for i in range(4000)] + [(10000 + i, "y" * 100, None) for i in range(1000)] + [(20000, None, "empty"), (None, "z" * 100, "b"), (5, "x" * 100, "a")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, replica int")
    out = mixing.replicate(df)
    n = {r["source"]: r["count"] for r in out.groupBy("source").count().collect()}
    assert n.get("empty") is None and abs(n["a"] - 5003 / 3) < 150 and abs(n[None] - 5003 / 3) < 150
    weights = spark.createDataFrame([("a", 3.0), (None, 1.0), ("absent", 5.0)], "source string, weight double")
    n = {r["source"]: r["count"] for r in mixing.replicate(df, weights).groupBy("source").count().collect()}
    assert "b" not in n and abs(n["a"] / n[None] - 3) < 0.4
    assert sorted(map(tuple, out.select("doc_id", "replica").collect()), key=repr) == sorted(map(tuple, mixing.replicate(df.repartition(7)).select("doc_id", "replica").collect()), key=repr)
    keys = [r["shuffle_key"] for r in out.where("doc_id is not null and doc_id <> 5").collect()]
    assert len(set(keys)) == len(keys)
    assert mixing.replicate(df.limit(0)).count() == 0


def test_salted_join_and_clashing_columns(spark):
    rows = [(i, "x" * (50 + i % 7), "ab"[i % 3 == 0], i, i, i) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, source_key int, _n int, _cdf int")
    one, other = (mixing.replicate(df, most_sources=k) for k in (10, 1))
    assert one.columns == [*df.columns, "rate", "replica", "shuffle_key"] == other.columns
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, other.collect())) and one.count() > 400
