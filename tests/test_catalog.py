"""Every named query against its SQL, whole results."""

import duckdb
import pytest
from compare import TABLES, differences, duck
from conftest import DATA

import __spark_entry__ as entry
from catalog import registry
from tidemark.operators import joins, skew

QUERIES = {name: entry.queries()[name] for name in registry.QUERIES}
CHECKS = entry.oracle_sql()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, db, name):
    df = QUERIES[name](spark, DATA)
    assert name in CHECKS
    assert differences(df, db, CHECKS[name]) == []


def test_entry_has_rows_and_columns(spark):
    assert set(entry.entry(spark).columns) == {"uid", "ts_ms", "ageLevel"}
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Tokyo"])
@pytest.mark.parametrize("name", ["epoch_to_dates", "datetime_to_epoch", "order_project_time_slot", "page_log_project"])
def test_results_do_not_depend_on_the_session_zone(spark, db, name, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert differences(QUERIES[name](spark, DATA), db, CHECKS[name]) == []
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


FORCED = [
    "page_running_pv_sets", "page_window_last_snapshot", "order_running_sets", "user_monotone_dedup", "base2_feed",
    "order_detail_interval_join_2h", "order_detail_interval_join_30d", "sku_enrich_lookup",
    "order_category_left_chain", "base4_feed", "user_sup_interval_join", "age_level_label", "final_label_merge",
    "user_sum_interval_join_30h", "user_sum_with_page_scores_12h", "user_latest_only", "dim_lookup_left",
    "comment_order_prefix_join", "cdc_route_columns", "order_running_counts", "user_order_totals_30h", "user_page_totals_12h", "asof_dim_lookup",
]


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """The tables with a third of the events, orders and lines moved to one user or order."""
    folder = str(tmp_path_factory.mktemp("skewed"))
    moved = {
        "events": "* REPLACE (CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END AS user_id)",
        "orders": "* REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey)",
        "lineitem": "* REPLACE (CASE WHEN l_partkey % 3 = 0 THEN 9 ELSE l_orderkey END AS l_orderkey)",
    }
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"COPY (SELECT {moved.get(name, '*')} FROM '{DATA}/{name}.parquet') TO '{folder}/{name}.parquet'")
    return folder, duck(folder)


@pytest.mark.parametrize("name", FORCED)
def test_query_with_hot_keys_split_and_nothing_broadcast(spark, skewed, name, monkeypatch):
    """The paths for hot keys and large dimensions give the same rows, whole queries composed of them too."""
    monkeypatch.setattr(skew, "HOT_ROWS", 100)
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    folder, con = skewed
    assert differences(QUERIES[name](spark, folder), con, CHECKS[name]) == []
