"""Every query with SQL against DuckDB on the smallest tables; the others must give rows."""

from __future__ import annotations

import oracle
import pytest

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_against_sql(spark, duck, name):
    df = queries()[name](spark, SF_DIR)
    columns, mine = oracle.spark_rows(df)
    other_columns, theirs = oracle.duck_rows(duck, oracle_sql()[name])
    assert columns == other_columns
    assert not oracle.type_differences(df, duck, oracle_sql()[name])
    assert not oracle.differences(mine, theirs)


SLOW = {"predict_registered", "compare_models", "compare_models_by_type", "compare_models_curve", "ocsvm_rff_scores"}


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql()) - SLOW))
def test_rows_only(spark, name):
    assert queries()[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry(spark).count() > 0
