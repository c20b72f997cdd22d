"""Market queries size their partitions by the input; others keep the session's."""

import __spark_entry__ as E
from conftest import SF001
from ledgerline.session import PARTITION_ROWS, SPLIT_BYTES, TASK_BYTES, deal_as_before, deal_finely

SIZE, COUNT = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def test_partitions_follow_the_rows(spark):
    before = spark.conf.get(SIZE, None), spark.conf.get(COUNT, None)
    try:
        for rows in (1, 36_000_000, 216_000_000):
            deal_finely(spark, rows)
            parts = int(spark.conf.get(COUNT))
            assert parts >= 200 and parts * PARTITION_ROWS >= rows and int(spark.conf.get(SIZE)) == TASK_BYTES
            assert int(spark.conf.get("spark.sql.files.maxPartitionBytes")) == SPLIT_BYTES
    finally:
        deal_as_before(spark)
    assert (spark.conf.get(SIZE, None), spark.conf.get(COUNT, None)) == before


def test_market_queries_set_sizes_and_operators_do_not(spark):
    try:
        E.queries()["j12_gold_features"](spark, SF001)
        assert int(spark.conf.get(SIZE)) == TASK_BYTES and int(spark.conf.get(COUNT)) >= 200
        E.queries()["op7_quality_rules"](spark, SF001)
        assert spark.conf.get(COUNT, None) is None
    finally:
        deal_as_before(spark)


def test_market_queries_run_no_method_that_the_jvm_never_compiles(spark):
    key = "spark.sql.codegen.hugeMethodLimit"
    deal_as_before(spark)
    before = spark.conf.get(key)
    try:
        deal_finely(spark, 1)
        assert int(spark.conf.get(key)) == 8000
    finally:
        deal_as_before(spark)
    assert spark.conf.get(key) == before
