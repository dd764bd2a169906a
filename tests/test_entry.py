"""The driver contract: entry runs, every query has a callable, every
oracle names a query, and the flagship output has the expected shape."""

import re

import __spark_entry__ as E


def _own(names):
    """Without the queries of the optional subpackage."""
    return {n for n in names if n != "pipeline" and not re.match(r"op\d+_", n)}


def test_entry_runs_on_smoke_tables(spark):
    df = E.entry(spark)
    assert df.columns == ["patientid", "save_feature"]
    rows = df.collect()
    assert len(rows) == 163                 # 150 patients, some with two mortality rows
    assert all(r["save_feature"][0] in "01" for r in rows)


def test_every_query_has_an_oracle():
    q, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(q)
    assert _own(q) == _own(sql)


def test_as_many_scores_as_samples(spark):
    assert E.queries()["score"](spark, E.SMOKE_DIR).count() == E.queries()["svmlight_samples"](spark, E.SMOKE_DIR).count()
    spark.catalog.clearCache()
