"""Schemas of the feeds."""

from __future__ import annotations

# Change envelope. ``before`` and ``after`` stay text and are parsed per table, after filtering.
ENVELOPE = """
    before STRING, after STRING,
    source STRUCT<db: STRING, `table`: STRING, ts_ms: BIGINT>,
    op STRING, ts_ms BIGINT
"""

ORDER_INFO = """
    id STRING, user_id STRING, consignee STRING, create_time BIGINT, original_total_amount STRING,
    total_amount STRING, province_id BIGINT
"""

ORDER_DETAIL = """
    id STRING, order_id STRING, sku_id BIGINT, sku_name STRING, sku_num BIGINT, order_price STRING,
    create_time BIGINT, split_coupon_amount STRING, split_activity_amount STRING, split_total_amount STRING
"""

USER_INFO = """
    id STRING, name STRING, user_level STRING, login_name STRING, phone_num STRING, email STRING,
    gender STRING, birthday INT
"""

USER_INFO_SUP = """
    uid STRING, height STRING, unit_height STRING, weight STRING, unit_weight STRING, create_ts BIGINT
"""

TABLES = {
    "order_info": ORDER_INFO,
    "order_detail": ORDER_DETAIL,
    "user_info": USER_INFO,
    "user_info_sup_msg": USER_INFO_SUP,
}

PAGE_LOG = """
    common STRUCT<ar: STRING, ba: STRING, ch: STRING, is_new: STRING, md: STRING, mid: STRING, os: STRING,
                  sid: STRING, uid: STRING, vc: STRING>,
    page STRUCT<during_time: BIGINT, item: STRING, item_type: STRING, last_page_id: STRING, page_id: STRING>,
    ts BIGINT
"""

ORDER = "id STRING, user_id STRING, total_amount STRING"

DIM_ROUTE = """
    sourceTable STRING, sinkTable STRING, sinkColumns STRING, sinkFamily STRING, sinkRowKey STRING, op STRING
"""

FACT_ROUTE = "sourceTable STRING, sourceType STRING, sinkTable STRING, sinkColumns STRING, op STRING"
