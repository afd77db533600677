"""Age-band score tables and the expressions that apply them.

A table is a literal map inside the expression, so scoring needs neither a join nor a shuffle.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

SCORE = "decimal(4,3)"

# Age bands in order, and the weight of each model.
BANDS = ["18_24", "25_29", "30_34", "35_39", "40_49", "50"]
DEVICE_WEIGHT = "0.1"
SEARCH_WEIGHT = "0.15"
TIME_WEIGHT = "0.1"
AMOUNT_WEIGHT = "0.15"
BRAND_WEIGHT = "0.2"
CATEGORY_WEIGHT = "0.3"

# Score per band, by first operating system.
DEVICE = {
    "iOS": "0.7 0.6 0.5 0.4 0.3 0.2",
    "Android": "0.8 0.7 0.6 0.5 0.4 0.3",
}
# Score per band, by search category; any other category scores 0.
SEARCH = {
    "时尚与潮流": "0.9 0.7 0.5 0.3 0.2 0.1",
    "性价比": "0.2 0.4 0.6 0.7 0.8 0.8",
    "健康与养生": "0.1 0.2 0.4 0.6 0.8 0.7",
    "家庭与育儿": "0.1 0.2 0.4 0.6 0.8 0.7",
    "科技与数码": "0.8 0.6 0.4 0.3 0.2 0.1",
    "学习与发展": "0.4 0.5 0.6 0.7 0.8 0.7",
}
# The stand-alone scoring job has its own row for this category.
SEARCH_VARIANT = SEARCH | {"健康与养生": "0.1 0.2 0.4 0.6 0.8 0.9"}
NO_SEARCH = "0 0 0 0 0 0"
# Score per band, by pay-time slot.
PAY_TIME = {
    "凌晨": "0.2 0.1 0.1 0.1 0.1 0.1",
    "早晨": "0.1 0.1 0.1 0.1 0.2 0.3",
    "上午": "0.2 0.2 0.2 0.2 0.3 0.4",
    "中午": "0.4 0.4 0.4 0.4 0.4 0.3",
    "下午": "0.4 0.5 0.5 0.5 0.5 0.4",
    "晚上": "0.8 0.7 0.6 0.5 0.4 0.3",
    "夜间": "0.9 0.7 0.5 0.3 0.2 0.1",
}
# Score per band, by amount class.
AMOUNT_LOW = "0.8 0.6 0.4 0.3 0.2 0.1"
AMOUNT_MIDDLE = "0.2 0.4 0.6 0.7 0.8 0.7"
AMOUNT_HIGH = "0.1 0.2 0.3 0.4 0.5 0.6"
# Score per band, by brand.
BRAND = {
    "TCL": "0.2 0.3 0.4 0.5 0.6 0.7",
    "苹果": "0.9 0.8 0.7 0.7 0.7 0.5",
    "联想": "0.9 0.8 0.7 0.7 0.7 0.5",
    "小米": "0.9 0.8 0.7 0.7 0.7 0.5",
    "欧莱雅": "0.5 0.6 0.8 0.8 0.9 0.2",
    "香奈儿": "0.3 0.4 0.6 0.8 0.9 0.2",
}
OTHER_BRAND = "0.1 0.2 0.3 0.4 0.5 0.6"
# Score per band, by top category.
YOUNG_CATEGORIES = ["数码", "手机", "电脑办公", "个护化妆", "服饰内衣"]
YOUNG_CATEGORY = "0.9 0.8 0.6 0.4 0.2 0.1"
HOME_CATEGORIES = ["家居家装", "图书、音像、电子书刊", "厨具", "鞋靴", "母婴", "汽车用品", "珠宝", "家用电器"]
HOME_CATEGORY = "0.2 0.4 0.6 0.8 0.9 0.7"
OTHER_CATEGORY = "0.1 0.2 0.4 0.5 0.8 0.9"


def weighted(row: str, weight: str) -> list[Decimal]:
    """A table row times its weight: exact, and never more than three places."""
    return [Decimal(v) * Decimal(weight) for v in row.split()]


def _array(row: str, weight: str) -> str:
    values = ", ".join(f"{v:.3f}" for v in weighted(row, weight))
    return f"CAST(array({values}) AS array<{SCORE}>)"


def _table(key: str, rows: dict[str, str], weight: str) -> str:
    """A score table as a CASE over the column ``key``; keys outside the table give null."""
    by_row: dict[str, list[str]] = {}
    for name, row in rows.items():
        by_row.setdefault(row, []).append(f"'{name}'")
    cases = " ".join(f"WHEN `{key}` IN ({', '.join(names)}) THEN {_array(row, weight)}" for row, names in by_row.items())
    return f"CASE {cases} END"


def device_scores(os: str) -> Column:
    """Six scores; null for an operating system outside the table."""
    return F.expr(_table(os, DEVICE, DEVICE_WEIGHT))


def search_scores(category: str, variant: bool = False) -> Column:
    table = SEARCH_VARIANT if variant else SEARCH
    return F.expr(f"coalesce({_table(category, table, SEARCH_WEIGHT)}, {_array(NO_SEARCH, SEARCH_WEIGHT)})")


def pay_time_scores(slot: str) -> Column:
    return F.expr(_table(slot, PAY_TIME, TIME_WEIGHT))


def amount_scores(amount: str) -> Column:
    """A missing amount counts as 0; exactly 1000 belongs to the last class, as do 4000 and above."""
    return F.expr(f"""
        CASE WHEN coalesce(`{amount}`, 0) < 1000 THEN {_array(AMOUNT_LOW, AMOUNT_WEIGHT)}
             WHEN `{amount}` > 1000 AND `{amount}` < 4000 THEN {_array(AMOUNT_MIDDLE, AMOUNT_WEIGHT)}
             ELSE {_array(AMOUNT_HIGH, AMOUNT_WEIGHT)} END""")


def brand_scores(brand: str) -> Column:
    """Null for a missing or empty brand."""
    other = _array(OTHER_BRAND, BRAND_WEIGHT)
    return F.expr(f"CASE WHEN `{brand}` <> '' THEN coalesce({_table(brand, BRAND, BRAND_WEIGHT)}, {other}) END")


def category_scores(category: str) -> Column:
    """Null for a missing or empty category."""
    rows = {c: YOUNG_CATEGORY for c in YOUNG_CATEGORIES} | {c: HOME_CATEGORY for c in HOME_CATEGORIES}
    other = _array(OTHER_CATEGORY, CATEGORY_WEIGHT)
    return F.expr(
        f"CASE WHEN `{category}` <> '' THEN coalesce({_table(category, rows, CATEGORY_WEIGHT)}, {other}) END")


def as_columns(scores: str, model: str) -> list[Column]:
    """The six scores of the array column ``scores`` as columns ``<model>_<band>``."""
    return [F.expr(f"`{scores}`[{i}] AS `{model}_{band}`") for i, band in enumerate(BANDS)]
