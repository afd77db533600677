"""Scalar column functions: time, age, zodiac, slots, text, numbers.

The session time zone must be UTC (``session.tune`` sets it); ``tz`` is the business zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BUSINESS_TZ = "Asia/Shanghai"

# Last day of the sign by month, as month * 100 + day, and the sign.
ZODIAC = [
    (119, "摩羯座"), (218, "水瓶座"), (320, "双鱼座"), (419, "白羊座"), (520, "金牛座"), (621, "双子座"),
    (722, "巨蟹座"), (822, "狮子座"), (922, "处女座"), (1022, "天秤座"), (1122, "天蝎座"), (1221, "射手座"),
    (1231, "摩羯座"),
]
# First hour after the slot, and the slot.
PAY_SLOTS = [(6, "凌晨"), (9, "早晨"), (12, "上午"), (14, "中午"), (18, "下午"), (22, "晚上"), (24, "夜间")]


def wall_clock(ms: Column, tz: str = BUSINESS_TZ) -> Column:
    """Epoch milliseconds as the wall-clock timestamp of ``tz``."""
    ts = F.timestamp_millis(ms.cast("bigint"))
    return ts if tz == "UTC" else F.from_utc_timestamp(ts, tz)


def ms_to_date(ms: Column, tz: str = BUSINESS_TZ) -> Column:
    return F.date_format(wall_clock(ms, tz), "yyyy-MM-dd")


def ms_to_datetime(ms: Column, tz: str = BUSINESS_TZ) -> Column:
    return F.date_format(wall_clock(ms, tz), "yyyy-MM-dd HH:mm:ss")


def ms_to_compact_date(ms: Column, tz: str = BUSINESS_TZ) -> Column:
    return F.date_format(wall_clock(ms, tz), "yyyyMMdd")


def ms_to_day(ms: Column, tz: str = BUSINESS_TZ) -> Column:
    """Calendar day as a DATE: cheaper to group on than its text."""
    return F.to_date(wall_clock(ms, tz))


def text_to_ms(text: Column, tz: str = BUSINESS_TZ) -> Column:
    """``yyyy-MM-dd`` or ``yyyy-MM-dd HH:mm:ss`` in ``tz`` as epoch milliseconds; bad text gives null."""
    ts = F.try_to_timestamp(text)
    return F.unix_millis(ts if tz == "UTC" else F.to_utc_timestamp(ts, tz))


def compact_date_int(day: Column) -> Column:
    """A DATE as the integer yyyyMMdd. Pass ``F.current_date()`` for today."""
    return F.date_format(day, "yyyyMMdd").cast("int")


def date_id(ms_text: Column, tz: str = BUSINESS_TZ) -> Column:
    """Date id of an epoch-millisecond text; non-numeric text gives null."""
    return ms_to_date(ms_text.try_cast("bigint"), tz)


def epoch_day_to_date(n: Column) -> Column:
    return F.date_from_unix_date(n.cast("int"))


def age_years(birth: Column, today: Column) -> Column:
    """Whole calendar years between two dates."""
    before_birthday = F.month(today) * 100 + F.dayofmonth(today) < F.month(birth) * 100 + F.dayofmonth(birth)
    return F.year(today) - F.year(birth) - before_birthday.cast("int")


def decade(birth: Column) -> Column:
    return (F.floor(F.year(birth) / 10) * 10).cast("int")


def zodiac(birth: Column, late_scorpio: bool = False) -> Column:
    """Sign of the month and day. ``late_scorpio`` keeps 23 October in Libra, as one job variant does."""
    md = F.month(birth) * 100 + F.dayofmonth(birth)
    out = F.when(birth.isNull(), F.lit(None).cast("string"))
    for last, sign in ZODIAC:
        if late_scorpio and last == 1022:
            last = 1023
        out = out.when(md <= last, F.lit(sign))
    return out


def pay_slot(ms: Column, tz: str = BUSINESS_TZ) -> Column:
    hour = F.hour(wall_clock(ms, tz))
    out = F.when(ms.isNull(), F.lit(None).cast("string"))
    for end, slot in PAY_SLOTS:
        out = out.when(hour < end, F.lit(slot))
    return out


def round_half_up(value: Column, places: int = 3) -> Column:
    return F.round(value, places)


def product_text(a: Column, b: Column) -> Column:
    """Product of two money texts, as text."""
    money = "decimal(16,2)"
    return (a.try_cast(money) * b.try_cast(money)).cast("string")


def first_token(text: Column, separator: str = " ") -> Column:
    return F.split_part(text, F.lit(separator), F.lit(1))


def joined(values: Column) -> Column:
    return F.array_join(values, ",")


def is_empty(text: Column) -> Column:
    """True for null and for the empty string."""
    return F.coalesce(text, F.lit("")) == ""


def merged(left: Column, right: Column) -> Column:
    """Two string maps as one; the right one wins."""
    return F.map_from_entries(
        F.concat(
            F.map_entries(F.map_filter(left, lambda k, _: ~F.map_contains_key(right, k))),
            F.map_entries(right),
        )
    )


def negated(amount: Column) -> Column:
    """Arithmetic negation; prefixing "-" to the text would break on amounts that are already negative."""
    return -amount


def snake_to_camel(name: str) -> str:
    head, *rest = name.split("_")
    return head + "".join(part.capitalize() for part in rest)


def camel_to_snake(name: str) -> str:
    return "".join("_" + ch.lower() if ch.isupper() else ch for ch in name)
