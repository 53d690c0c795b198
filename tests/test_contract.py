"""Driver contract and plan shape."""

import __spark_entry__ as E

from conftest import SF_SMALL


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "is_anomaly" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 30


def test_scans_are_pruned_and_filters_pushed(spark):
    q = E.queries()["hourly_load"](spark, SF_SMALL)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(value), GreaterThan(value,0.0)]" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,value:double,props:string>" in plan


def test_profile_pass_is_one_scan(spark):
    from meterlake.operators import profiles
    from meterlake.sources import fixtures as fx
    plan = profiles.statistics_document(fx.readings(spark, SF_SMALL))._jdf.queryExecution() \
        .executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
