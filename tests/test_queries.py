"""Every query with an SQL equivalent agrees with it; the others return rows."""

import pytest
from check_oracles import compare

from __spark_entry__ import entry, oracle_sql, queries

SLOW = {"m8_tuning", "m9_ablation", "m10_rolling_validation", "run_panel", "m22_logistic_auc", "m23_svc_auc"}


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert {"ra", "epi_sunday", "cases", "cases_lag_1", "umidmed_lag_8", "sin_week"} <= set(df.columns)
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_oracle(spark, con, sf, name):
    result = compare(spark, con, name, queries()[name], oracle_sql()[name], sf)
    assert result.startswith("ok"), result


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql()) - SLOW))
def test_rows(spark, sf, name):
    assert queries()[name](spark, sf).limit(1).count() == 1
