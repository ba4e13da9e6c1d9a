"""The driver contract."""

import __spark_entry__ as driver


def test_entry_runs(spark):
    assert driver.entry(spark).count() == 5


def test_catalogue_is_consistent():
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert len(driver.oracle_sql()) >= 80
