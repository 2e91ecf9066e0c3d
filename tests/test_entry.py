import os

import pytest

import __spark_entry__ as e

SF = "/root/testdata/sf0.001"


def test_names_match():
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")
def test_flagship(spark):
    df = e.entry(spark)
    assert df.columns == ["event_id", "track", "secondary_date", "reference_date", "secondary", "reference"]
    df.count()
