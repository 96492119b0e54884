"""What the plans must look like."""

import re

from catalog import all_queries
from catalog.base import Layers
from siltstone.operators.joins import orphans
from siltstone.operators.tags import share_of_class


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_summary_shuffles(spark, sf):
    """One shuffle to deduplicate, one per (class, value), one per class, beside the spread scan."""
    text = plan(Layers(spark, sf).summary)
    assert text.count("Exchange hashpartitioning") == 3
    assert text.count("WindowGroupLimit") == 2
    assert text.count("from_json") == 1


def test_share_of_class_needs_no_join_to_the_dimension(spark, sf):
    text = plan(Layers(spark, sf).shares)
    assert "count(distinct" not in text


def test_band_case_needs_no_join(spark, sf):
    assert "Join" not in plan(Layers(spark, sf).dim)


def test_columns_reach_the_scan(spark, sf):
    text = plan(all_queries()["dedupe_documents"](spark, sf))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_orphans_gather_no_keys_on_the_driver(spark):
    text = plan(orphans(spark.range(3).toDF("k"), spark.range(2).toDF("p"), "k", "p"))
    assert "SortMergeJoin" in text and "Broadcast" not in text


def test_joined_shares_gather_no_entities_on_the_driver(spark):
    dim = spark.range(4).selectExpr("id as entity_id", "cast(id % 2 as string) as size_class")
    bridge = spark.range(4).selectExpr("id as entity_id", "'calm' as tag", "'Calm' as tag_display")
    text = plan(share_of_class(bridge, dim))
    assert re.search(r"SortMergeJoin \[entity_id", text) and not re.search(r"BroadcastHashJoin \[entity_id", text)


def test_joined_shares_of_defects_gather_no_entities_on_the_driver(spark, sf):
    text = plan(all_queries()["share_of_class_joined_defects"](spark, sf))
    assert re.search(r"SortMergeJoin \[entity_id", text) and not re.search(r"BroadcastHashJoin \[entity_id", text)
