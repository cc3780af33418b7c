"""Every query with SQL gives its rows; the others run and give the columns they always give."""

import pytest
from oracle import assert_same, connect

from sparkloom import plans


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(plans.oracle_sql()))
def test_matches_sql(name, spark, sf_dir, con):
    assert_same(plans.queries()[name](spark, sf_dir), con, plans.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(plans.queries()) - set(plans.oracle_sql())))
def test_runs(name, spark, sf_dir):
    df = plans.queries()[name](spark, sf_dir)
    rows = df.collect()
    assert df.columns and len(rows) == df.count()


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_tfidf_vectors_prepare_each_text_once(spark, sf_dir):
    """The prepared text is read three times, so it is written; no plan that follows cleans it anew."""
    plan = plans.queries()["tfidf_vectors"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan
