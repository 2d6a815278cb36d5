"""Every registered query against its SQL oracle on the smallest test tables."""

import os

import pytest

from oracle_harness import compare

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables missing")
def test_all_queries_match_oracle(spark):
    res = compare(spark, SF, verbose=False)
    bad = {k: v for k, v in res.items() if v[0] not in ("OK", "NO_ORACLE")}  # the latter have tests of their own
    assert not bad, bad


def test_entry_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    rows = df.collect()
    assert len(rows) == 6 and {"rule_name", "fail_count", "sample_failures"} <= set(df.columns)
