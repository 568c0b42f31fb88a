"""What the physical plans may and may not contain."""

from __future__ import annotations

import pytest

from strata.plans import QUERIES

# Streams and table queries write when they are built; their read plans are covered by the rest.
BUILT_BY_WRITING = {k for k, f in QUERIES.items() if k.startswith(("stream_", "table_", "partition_add"))}
PYTHON = {"vector_search_cosine", "vector_search_dot", "vector_search_euclid", "vector_search_threshold",
          "vector_search_filtered", "vector_store_search", "vector_search_ann", "semantic_search"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(set(QUERIES) - BUILT_BY_WRITING))
def test_plan_shape(spark, sf, key):
    text = plan(QUERIES[key](spark, sf))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    assert ("MapInArrow" in text) == (key in PYTHON)


@pytest.mark.parametrize("key", ["dedupe_last", "dedupe_first", "changelog_apply", "topic_compact", "batch_cap",
                                 "sql_topk_per_group", "vector_search_batch"])
def test_first_rows_are_kept_before_the_shuffle(spark, sf, key):
    """Hot keys: each map task keeps only the rows that can win."""
    assert plan(QUERIES[key](spark, sf)).count("WindowGroupLimit") >= 2


def test_scan_reads_and_filters_what_it_needs(spark, sf):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        text = plan(QUERIES["scan_project_filter"](spark, sf))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThan(l_discount,0.05)" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_discount:double,l_shipdate:timestamp_ntz>" in text


@pytest.mark.parametrize("key", ["partition_pruned_read", "read_incremental"])
def test_partition_filter_reaches_the_directories(spark, sf, key):
    text = plan(QUERIES[key](spark, sf))
    assert "PartitionFilters: [isnotnull(ts_day" in text


def test_log_ranges_are_read_without_a_shuffle_of_the_log(spark, sf):
    """The positions of partitions are few and go to the log, even where no join is broadcast by itself."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES["offset_range_read"](spark, sf))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_not_in_needs_no_broadcast(spark, sf):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Broadcast" not in plan(QUERIES["sql_semi_anti"](spark, sf))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_limit_is_part_of_the_plan(spark, sf):
    assert "TakeOrderedAndProject" in plan(QUERIES["sql_query"](spark, sf))
    assert "TakeOrderedAndProject" in plan(QUERIES["scan_limit"](spark, sf))


def test_quality_suite_scans_once(spark, sf):
    assert plan(QUERIES["dq_suite"](spark, sf)).count("FileScan") == 1
