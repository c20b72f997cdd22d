"""Driver contract: entry() on sf0.001 and registry consistency."""

import __spark_entry__ as E
from conftest import SF001


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and "rsi_14" in df.columns and "regime_label" in df.columns


def test_every_query_has_oracle_sql():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    from ledgerline.plans import registry

    missing = sorted(set(registry()) - set(s))
    assert missing == [], missing


def test_some_queries_run_on_smallest_scale(spark):
    q = E.queries()
    for name in ["bars_ohlcv", "jn7_grand_join", "j12_gold_features", "s06_tier_quota_topk"]:
        assert q[name](spark, SF001).count() >= 0
