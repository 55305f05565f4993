"""What the plans of the named queries must and must not contain."""

import re

import pytest
from conftest import DATA

import __spark_entry__ as entry
from catalog import registry

WRITES = {
    name for name in registry.QUERIES
    if name.startswith("stream_") or name in {
        "text_label_sink_round_trip", "json_lines_round_trip", "partitioned_layout_prune", "topic_routing_partitioned",
        "staged_final_label",
    }
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - WRITES))
def test_no_cross_join_and_no_python_in_the_plan(spark, name):
    text = plan(entry.queries()[name](spark, DATA))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "EvalPython" not in text and "Arrow" not in text


def test_scans_read_only_the_needed_columns(spark):
    text = plan(entry.queries()["order_detail_interval_join_30d"](spark, DATA))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert any("l_orderkey" in s and "l_extendedprice" not in s for s in schemas)
    assert any("o_orderkey" in s and "o_orderpriority" not in s for s in schemas)


def test_choosing_one_row_per_key_limits_before_the_shuffle(spark):
    text = plan(entry.queries()["detail_monotone_dedup"](spark, DATA))
    assert "Partial" in text and "Final" in text and "WindowGroupLimit" in text


def test_change_text_is_parsed_once(spark):
    text = plan(entry.queries()["cdc_demux_order_info"](spark, DATA))
    one_branch = text.split("+- ")
    assert not any("Filter" in part and "from_json" in part for part in one_branch)


def test_day_list_prunes_partitions(spark):
    df = entry.queries()["partitioned_layout_prune"](spark, DATA)
    assert "PartitionFilters: [dt" in plan(df) or "PartitionFilters: [isnotnull(dt" in plan(df)


def test_feeds_parse_the_envelope_once(spark, tmp_path):
    """All tables of a change feed are written in one job with one parser; readers open their own folder only."""
    from tidemark.operators import cdc

    spark.createDataFrame([('{"after":{"id":"1"},"source":{"table":"order_info"},"op":"c","ts_ms":1}',)], "value STRING").write.text(f"{tmp_path}/in")
    envelopes = cdc.parse_envelope(spark.read.text(f"{tmp_path}/in"))
    stored = cdc.split_tables(envelopes, f"{tmp_path}/tables")
    text = plan(stored("order_info"))
    assert text.count("from_json") == 1 and "table=order_info" in text.replace("`", "") or "PartitionFilters" in text
    assert "ENVELOPE" not in text and "(table" in text
    assert stored("order_info").count() == 1 and stored("user_info").count() == 0
