"""The interval joins between orders, details, users, pages and comments.

In each, the right side is the one with many rows per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import fixed_values as V
from tidemark.functions.dates import DAY_MS, HOUR_MS
from tidemark.operators import dedup, joins, scoring, skew

RIGHT_TIME = "_right_ts"


def _right(df: DataFrame, *columns) -> DataFrame:
    return df.select(*columns, F.col("ts_ms").alias(RIGHT_TIME))


def orders_with_sku(orders: DataFrame, details: DataFrame, bound_ms: int = 30 * DAY_MS) -> DataFrame:
    """Narrow orders, each with the sku of every line in reach."""
    right = _right(details, "order_id", "sku_id")
    return joins.hot_interval_join(orders, right, "order_id", -bound_ms, bound_ms).drop(RIGHT_TIME)


def orders_with_details(orders: DataFrame, details: DataFrame, bound_ms: int = 2 * HOUR_MS) -> DataFrame:
    """Orders, each with every line in reach."""
    right = _right(
        details,
        F.col("order_id").alias("id"),
        "sku_num",
        "split_coupon_amount",
        "sku_name",
        "order_price",
        F.col("id").alias("detail_id"),
        "order_id",
        "sku_id",
        F.col("split_activity_amount").try_cast("double").alias("split_activity_amount"),
        F.col("split_total_amount").try_cast("double").alias("split_total_amount"),
    )
    return joins.hot_interval_join(orders, right, "id", -bound_ms, bound_ms).drop(RIGHT_TIME)


def users_with_supplement(users: DataFrame, supplements: DataFrame, bound_ms: int = 5 * DAY_MS) -> DataFrame:
    """Users, each with every height and weight message in reach."""
    right = _right(supplements, "uid", "height", "unit_height", "weight", "unit_weight")
    return joins.hot_interval_join(users, right, "uid", -bound_ms, bound_ms).drop(RIGHT_TIME)


def users_with_order_sums(
    users: DataFrame, scored_orders: DataFrame, bound_ms: int = 30 * HOUR_MS,
    hot_rows: int | None = None, hot_from: DataFrame | None = None,
) -> DataFrame:
    """Users, each with the ``sum_*`` scores of every order in reach."""
    right = _right(scored_orders, "uid", *scoring.score_columns("sum"))
    return joins.hot_interval_join(
        users, right, "uid", -bound_ms, bound_ms, hot_rows=hot_rows, hot_from=hot_from
    ).drop(RIGHT_TIME)


def users_with_page_scores(
    users: DataFrame, scored_pages: DataFrame, bound_ms: int = 12 * HOUR_MS,
    hot_rows: int | None = None, hot_from: DataFrame | None = None, left_hot_from: DataFrame | None = None,
) -> DataFrame:
    """Users with order sums, to which the scores of every page row in reach are added."""
    scores = scoring.score_columns("search") + scoring.score_columns("device")
    joined = joins.hot_interval_join(
        users, _right(scored_pages, "uid", *scores), "uid", -bound_ms, bound_ms,
        hot_rows=hot_rows, hot_from=hot_from, left_hot_from=left_hot_from,
    )
    return add_page_scores_to_sums(joined).drop(RIGHT_TIME, *scores)


def add_page_scores_to_sums(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {f"sum_{b}": scoring.sum_of(f"sum_{b}", f"search_{b}", f"device_{b}") for b in V.BUCKETS}
    )


def user_totals(
    users: DataFrame,
    scored_orders: DataFrame,
    scored_pages: DataFrame | None = None,
    order_bound_ms: int = 30 * HOUR_MS,
    page_bound_ms: int = 12 * HOUR_MS,
    hot_rows: int | None = None,
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """Users with counts and totals over all orders and page rows in reach, without pairs or triples.

    Alone with orders: ``orders`` and the total of each ``sum_*``. With pages too: ``pages`` as well, and ``sum_*`` is the total over
    all combinations of an order and a page row in reach, each with the page's search and device scores added: every
    order's sum counts once per page row, and every page row's scores once per order.
    """
    sums = scoring.score_columns("sum")
    sides = [joins.Within(scored_orders, -order_bound_ms, order_bound_ms, "orders", {s: F.col(s) for s in sums})]
    if scored_pages is None:
        return joins.totals_within(users, sides, "uid", hot_rows=hot_rows, hot_from=hot_from)
    scores = {f"_page_{b}": scoring.sum_of(f"search_{b}", f"device_{b}") for b in V.BUCKETS}
    sides.append(joins.Within(scored_pages, -page_bound_ms, page_bound_ms, "pages", scores))
    found = joins.totals_within(users, sides, "uid", hot_rows=hot_rows, hot_from=hot_from)
    exact = lambda c: F.col(c).cast("decimal(30,6)")
    pair = lambda b: exact(f"sum_{b}") * F.col("pages") + exact(f"_page_{b}") * F.col("orders")
    return found.withColumns({f"sum_{b}": pair(b).cast("double") for b in V.BUCKETS}).drop(*scores)


def comments_with_orders(
    comments: DataFrame, orders: DataFrame, key: str, lower_ms: int, upper_ms: int
) -> DataFrame:
    """Comments, each with every order in reach, order columns prefixed with ``info_``."""
    info = joins.prefixed(orders, "info_").withColumn(key, F.col(f"info_{key}"))
    joined = joins.hot_interval_join(info, comments, key, -upper_ms, -lower_ms, "info_ts_ms", "ts_ms")
    return joined.select(*comments.columns, *[f"info_{c}" for c in orders.columns])


def age_level_pairs(
    base2: DataFrame, base4: DataFrame, bound_ms: int = 24 * DAY_MS, hot_rows: int | None = None
) -> DataFrame:
    """uid, ts_ms and ageLevel of every page row and order row in reach of each other."""
    scores = [c for p in ("pay_time", "b1name", "tname", "amount") for c in scoring.score_columns(p)]
    pairs = joins.hot_interval_join(
        base2, _right(base4, "uid", *scores), "uid", -bound_ms, bound_ms, hot_rows=hot_rows, left_hot_from=base2
    )
    return pairs.select("uid", "ts_ms", scoring.age_level().alias("ageLevel"))


def latest_age_levels(
    base2: DataFrame,
    base4: DataFrame,
    bound_ms: int = 24 * DAY_MS,
    hot_rows: int | None = None,
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """The last of each user's :func:`age_level_pairs`, without forming the pairs.

    That is the pair with the latest page row that has an order in reach, and the latest such order.
    """
    scores = [c for p in ("pay_time", "b1name", "tname", "amount") for c in scoring.score_columns(p)]
    order_rows = base4.select("uid", "ts_ms", "detail_id", *scores)
    page_scores = scoring.score_columns("search") + scoring.score_columns("device")
    met = joins.latest_within(
        base2.select("uid", "ts_ms", *page_scores),
        {"order_row": (order_rows, "ts_ms", -bound_ms, bound_ms)},
        "uid", hot_rows=hot_rows, hot_from=hot_from,
    ).filter(F.col("order_row").isNotNull())
    newest = dedup.latest(met, "uid", ["ts_ms", *page_scores])
    return newest.select("uid", "ts_ms", *page_scores, *[F.col(f"order_row.{c}").alias(c) for c in scores]).select(
        "uid", "ts_ms", scoring.age_level().alias("ageLevel")
    )


def latest_labels(
    base2: DataFrame,
    base4: DataFrame,
    base6: DataFrame,
    bound_ms: int = 24 * DAY_MS,
    hot_rows: int | None = None,
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """Each user's last label row: base6 with ageLevel, base6 columns winning equal names.

    Orders and demographics are both looked up in one ordered pass per user.
    """
    scores = [c for p in ("pay_time", "b1name", "tname", "amount") for c in scoring.score_columns(p)]
    page_scores = scoring.score_columns("search") + scoring.score_columns("device")
    met = joins.latest_within(
        base2.select("uid", "ts_ms", *page_scores),
        {
            "order_row": (base4.select("uid", "ts_ms", "detail_id", *scores), "ts_ms", -bound_ms, bound_ms),
            "user_row": (base6, "ts_ms", -bound_ms, bound_ms),
        },
        "uid", hot_rows=hot_rows, hot_from=hot_from,
    ).filter(F.col("order_row").isNotNull() & F.col("user_row").isNotNull())
    newest = dedup.latest(met, "uid", ["ts_ms", *page_scores])
    flat = newest.select(
        "uid", "user_row", *page_scores, *[F.col(f"order_row.{c}").alias(c) for c in scores]
    ).withColumn("ageLevel", scoring.age_level())
    return flat.select("uid", "user_row.*", "ageLevel")


def latest_user_sums(
    users: DataFrame,
    scored_orders: DataFrame,
    scored_pages: DataFrame,
    order_bound_ms: int = 30 * HOUR_MS,
    page_bound_ms: int = 12 * HOUR_MS,
    hot_rows: int | None = None,
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """Each user's last row of users with order sums and page scores, without forming the pairs."""
    sums = scoring.score_columns("sum")
    scores = scoring.score_columns("search") + scoring.score_columns("device")
    met = joins.latest_within(
        users,
        {
            "order_row": (
                scored_orders.select("uid", "ts_ms", "order_id", "sku_id", *sums),
                "ts_ms", -order_bound_ms, order_bound_ms,
            ),
            "page_row": (scored_pages.select("uid", "ts_ms", *scores), "ts_ms", -page_bound_ms, page_bound_ms),
        },
        "uid", hot_rows=hot_rows, hot_from=hot_from,
    ).filter(F.col("order_row").isNotNull() & F.col("page_row").isNotNull())
    newest = dedup.latest(met, "uid", ["ts_ms", "order_row", "page_row"])
    flat = newest.select(
        *users.columns,
        *[F.col(f"order_row.{c}").alias(c) for c in sums],
        *[F.col(f"page_row.{c}").alias(c) for c in scores],
    )
    return add_page_scores_to_sums(flat).drop(*scores)
