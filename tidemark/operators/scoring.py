"""Age-bucket scores. A score is ``round(weight * coefficient, 3)`` per bucket.

Rules are data: a mapping from a value to its weight vector. Each model becomes one CASE over literal
vectors, folded by Catalyst at planning time, so scoring is a narrow projection without joins or UDFs.
A vector column is added first and split into ``<prefix>_<bucket>`` columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import fixed_values as V
from tidemark.functions.numbers import number_or_zero, round3
from tidemark.functions.text import first_item, is_present

Vector = Sequence[float]
ZERO = (0.0,) * len(V.BUCKETS)


def weighted(weights: Vector, coefficient: float) -> Column:
    return F.array(*[round3(F.lit(float(w)) * F.lit(coefficient)) for w in weights])


def by_value(
    value: Column, rules: Mapping[str, Vector], coefficient: float, other: Vector | None = None
) -> Column:
    """Score vector by value; values without a rule get ``other`` or null, as does a missing value null."""
    groups: dict[tuple[float, ...], list[str]] = {}
    for name, weights in rules.items():
        groups.setdefault(tuple(weights), []).append(name)
    vector = None
    for weights, names in groups.items():
        hit = value.isin(names)
        score = weighted(weights, coefficient)
        vector = F.when(hit, score) if vector is None else vector.when(hit, score)
    if other is not None:
        vector = vector.when(is_present(value), weighted(other, coefficient))
    return vector


def add_scores(df: DataFrame, vectors: Mapping[str, Column]) -> DataFrame:
    """Add ``<prefix>_<bucket>`` columns for each score vector."""
    held = df.withColumns({f"_vector_{p}": v for p, v in vectors.items()})
    return held.select(
        *df.columns,
        *[F.col(f"_vector_{p}")[i].alias(f"{p}_{b}") for p in vectors for i, b in enumerate(V.BUCKETS)],
    )


def score_columns(prefix: str) -> list[str]:
    return [f"{prefix}_{b}" for b in V.BUCKETS]


def judged_os(os_list: Column) -> Column:
    """The system that stands for a user: iOS if among them, else Android, else the first."""
    systems = F.split(os_list, ",")
    choice = F.when(F.array_contains(systems, "iOS"), "iOS").when(F.array_contains(systems, "Android"), "Android")
    return choice.otherwise(first_item(os_list))


def device_vector(judge_os: Column, rules: Mapping[str, Vector] = V.DEVICE_WEIGHTS) -> Column:
    return by_value(judge_os, rules, V.DEVICE_COEFFICIENT)


def search_vector(search_category: Column, rules: Mapping[str, Vector] = V.SEARCH_WEIGHTS) -> Column:
    return F.coalesce(by_value(search_category, rules, V.SEARCH_COEFFICIENT), weighted(ZERO, 1.0))


def pay_time_vector(slot: Column, rules: Mapping[str, Vector] = V.PAY_TIME_WEIGHTS) -> Column:
    return by_value(slot, rules, V.PAY_TIME_COEFFICIENT)


def amount_vector(total_amount: Column) -> Column:
    """Both limits themselves fall to the last tier."""
    amount = number_or_zero(total_amount)
    k = V.AMOUNT_COEFFICIENT
    return (
        F.when(amount < V.AMOUNT_LOW_LIMIT, weighted(V.AMOUNT_LOW, k))
        .when((amount > V.AMOUNT_LOW_LIMIT) & (amount < V.AMOUNT_HIGH_LIMIT), weighted(V.AMOUNT_MIDDLE, k))
        .otherwise(weighted(V.AMOUNT_OTHER, k))
    )


def brand_vector(brand: Column, rules: Mapping[str, Vector] = V.BRAND_WEIGHTS) -> Column:
    return by_value(brand, rules, V.BRAND_COEFFICIENT, V.BRAND_OTHER)


def category_vector(category: Column, rules: Mapping[str, Vector] = V.CATEGORY_WEIGHTS) -> Column:
    return by_value(category, rules, V.CATEGORY_COEFFICIENT, V.CATEGORY_OTHER)


def order_price_vector(total_amount: Column) -> Column:
    """Tiers of the order sum score: both limits belong to the tier below them, negatives to the last."""
    amount = number_or_zero(total_amount)
    k = V.AMOUNT_COEFFICIENT
    return (
        F.when((amount >= 0) & (amount <= V.AMOUNT_LOW_LIMIT), weighted(V.AMOUNT_LOW, k))
        .when((amount > V.AMOUNT_LOW_LIMIT) & (amount <= V.AMOUNT_HIGH_LIMIT), weighted(V.AMOUNT_MIDDLE, k))
        .otherwise(weighted(V.AMOUNT_OTHER, k))
    )


def order_brand_vector(brand: Column, rules: Mapping[str, Vector] = V.ORDER_BRAND_WEIGHTS) -> Column:
    return by_value(brand, rules, V.BRAND_COEFFICIENT, V.ORDER_BRAND_OTHER)


def order_category_vector(category: Column, rules: Mapping[str, Vector] = V.SEARCH_WEIGHTS) -> Column:
    return F.coalesce(by_value(category, rules, V.CATEGORY_COEFFICIENT), weighted(ZERO, 1.0))


def add_page_scores(df: DataFrame) -> DataFrame:
    """Device and search scores of a page-statistics row with ``os`` and ``searchCategory``."""
    judged = df.withColumn("judge_os", judged_os(F.col("os")))
    return add_scores(
        judged,
        {"device": device_vector(F.col("judge_os")), "search": search_vector(F.col("searchCategory"))},
    )


def add_order_scores(df: DataFrame) -> DataFrame:
    """Pay-time, amount, brand and category scores of an enriched order line."""
    return add_scores(
        df,
        {
            "pay_time": pay_time_vector(F.col("pay_time_slot")),
            "amount": amount_vector(F.col("total_amount")),
            "tname": brand_vector(F.col("tname")),
            "b1name": category_vector(F.col("b1_name")),
        },
    )


def add_order_sums(df: DataFrame) -> DataFrame:
    """``sum_<bucket>``: brand + category + price score of an order, absent scores as 0."""
    scored = add_scores(
        df,
        {
            "_brand": order_brand_vector(F.col("btname")),
            "_category": order_category_vector(F.col("bcname")),
            "_price": order_price_vector(F.col("total_amount")),
        },
    )
    total = lambda b: sum_of(f"_brand_{b}", f"_category_{b}", f"_price_{b}")
    return scored.select(*df.columns, *[total(b).alias(f"sum_{b}") for b in V.BUCKETS])


def sum_of(*names: str) -> Column:
    """Sum in the order given, absent values as 0."""
    total = number_or_zero(F.col(names[0]))
    for name in names[1:]:
        total = total + number_or_zero(F.col(name))
    return total


TOTAL_ORDER = ("search", "device", "pay_time", "b1name", "tname", "amount")


def age_level() -> Column:
    """The bucket with the largest total of all six scores; the first of equal ones."""
    return first_largest(V.BUCKETS, [sum_of(*[f"{p}_{b}" for p in TOTAL_ORDER]) for b in V.BUCKETS])


def first_largest(names: Sequence[str], values: Sequence[Column]) -> Column:
    scores = F.array(*values)
    place = F.array_position(scores, F.array_max(scores)).cast("int")
    return F.element_at(F.array(*[F.lit(n) for n in names]), place)
