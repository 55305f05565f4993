"""Batch form of the flows. Inputs are change rows and page logs; outputs are the label feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.functions.dates import DAY_MS, HOUR_MS, MINUTE_MS
from tidemark.operators import dedup, dimensions, feed_joins, projections, running, scoring

# Column order in which equal lines of an order are told apart.
DETAIL_TIES = (
    "sku_id", "order_price", "sku_num", "split_total_amount", "split_coupon_amount",
    "split_activity_amount", "sku_name",
)


def page_feed(page_logs: DataFrame, keywords: DataFrame, window_ms: int = 2 * MINUTE_MS) -> DataFrame:
    """base2: device and search scores of each user's last page statistics per window."""
    pages = projections.with_uid(projections.page(page_logs))
    snapshots = running.page_window_snapshots(dedup.full_row(pages), window_ms, hot_from=pages).drop("window_start")
    scored = scoring.add_page_scores(dimensions.add_search_category(snapshots, keywords))
    return projections.restamp(scored)


def order_feed(
    order_changes: DataFrame,
    detail_changes: DataFrame,
    sku_dim: DataFrame,
    categories: DataFrame,
    bound_ms: int = 2 * HOUR_MS,
) -> DataFrame:
    """base4: pay-time, amount, brand and category scores of each order line."""
    orders = projections.with_id(projections.order(order_changes))
    details = projections.with_id(projections.order_detail(detail_changes), "order_id")
    lines = feed_joins.orders_with_details(orders, details, bound_ms)
    fresh = dedup.first_in_event_order(lines, "detail_id", "ts_ms", DETAIL_TIES)
    return scoring.add_order_scores(dimensions.enrich_by_sku(fresh, sku_dim, categories, details))


def user_feed(
    user_changes: DataFrame, supplement_changes: DataFrame, as_of: str | None = None, bound_ms: int = 5 * DAY_MS
) -> DataFrame:
    """base6: demographic labels with height and weight."""
    users = projections.with_uid(projections.user(user_changes, as_of))
    supplements = projections.with_uid(projections.user_supplement(supplement_changes))
    return feed_joins.users_with_supplement(users, supplements, bound_ms)


def order_sums(
    order_changes: DataFrame, detail_changes: DataFrame, names: DataFrame, overrides: DataFrame
) -> DataFrame:
    """``sum_*`` scores of orders: lines joined in, repeats removed, names looked up, scored."""
    orders = projections.order_change(order_changes)
    details = projections.order_detail_change(detail_changes)
    fresh = dedup.by_key_and_time(feed_joins.orders_with_sku(orders, details), "order_id")
    return scoring.add_order_sums(dimensions.add_order_names(fresh, names, overrides))


def order_age_levels(scored_lines: DataFrame) -> DataFrame:
    """Which age bucket each buyer's latest order line points to, from order scores alone."""
    newest = dedup.latest(scored_lines, "uid", ["ts_ms", "detail_id"])
    totals = [
        scoring.sum_of(*[f"{p}_{b}" for p in ("pay_time", "b1name", "tname", "amount")])
        for b in scoring.V.BUCKETS
    ]
    return newest.select("uid", "ts_ms", scoring.first_largest(scoring.V.BUCKETS, totals).alias("ageLevel"))


final_labels = feed_joins.latest_labels
user_sums = feed_joins.latest_user_sums
