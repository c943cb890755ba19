"""The entry point works with and without the optional corpus subpackage."""

import __spark_entry__


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_oracles_name_queries():
    assert __spark_entry__.oracle_sql().keys() <= __spark_entry__.queries().keys()
