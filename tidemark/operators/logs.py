"""App-log parsing, splitting and projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import scalars as S
from tidemark.operators.skew import lookup_join
from tidemark.operators.versions import first_by_key
from tidemark.schemas import APP_LOG


CORRUPT = "_corrupt"


def is_json_object(value: Column) -> Column:
    """True for text holding a JSON object. ``from_json`` alone cannot tell: bad text gives a struct of nulls."""
    parsed = F.try_parse_json(value)
    return F.coalesce(parsed.isNotNull() & F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))


def checked_log(values: DataFrame, *keep: str | Column) -> DataFrame:
    """Each text with its record ``_r`` and whether it is ``_clean``; null payloads are left out. ``keep`` are further columns.

    The record parser marks what it could not read. Only those texts are parsed a second time, to keep the
    ones that are JSON objects all the same but hold a field of another type.
    """
    schema = T.StructType([*APP_LOG.fields, T.StructField(CORRUPT, T.StringType())])
    record = F.from_json("value", schema, {"columnNameOfCorruptRecord": CORRUPT})
    read = F.col(f"_r.{CORRUPT}").isNull() & F.ltrim("value").startswith("{")
    return (
        values.filter(F.col("value").isNotNull())
        .select("value", record.alias("_r"), *keep)
        .withColumn("_clean", F.when(read, F.lit(True)).otherwise(is_json_object(F.col("value"))))
    )


def _records(checked: DataFrame, *keep: str) -> DataFrame:
    # As a generator, not a filter: a filter would be pushed below the parsing and parse every text again.
    names = [f.name for f in APP_LOG.fields]
    record = F.struct(*[F.col(f"_r.{n}").alias(n) for n in names], *keep, F.lit(True).alias("_is"))
    return _each(checked.select(F.when(F.col("_clean"), F.array(record)).alias("_o")), "_is").select(*names, *keep)


def _each(lists: DataFrame, never_null: str) -> DataFrame:
    """The entries of the lists ``_o``. As an outer generator: of an inner one Spark makes a filter of the rows that have entries, which works out
    the lists, and parses the texts behind them, once more for each field they hold."""
    return lists.select(F.inline_outer("_o")).filter(F.col(never_null).isNotNull())


def dirty_rows(values: DataFrame) -> DataFrame:
    """Non-null texts that are not JSON objects, unchanged."""
    return checked_log(values).filter("NOT _clean").select("value")


def parsed_log(values: DataFrame, *keep: str) -> DataFrame:
    """Log records of the clean texts, with further columns of ``values``."""
    return _records(checked_log(values, *keep), *keep)


def with_common(log: DataFrame, name: str, value: Column) -> DataFrame:
    return log.withColumn("common", F.col("common").withField(name, value))


def stored_dates(log: DataFrame, tz: str = S.BUSINESS_TZ) -> DataFrame:
    """Per device the date its first record fixes: its own if flagged new, else the day before."""
    first = first_by_key(
        log.select(F.col("common.mid").alias("mid"), "ts", F.col("common.is_new").alias("is_new")), ["mid"], ["ts"])
    day = S.ms_to_day(F.col("ts"), tz)
    return first.select("mid", F.when(F.col("is_new") == "1", day).otherwise(F.date_sub(day, 1)).alias("stored"))


def repair_is_new(log: DataFrame, tz: str = S.BUSINESS_TZ, limit: int | None = None) -> DataFrame:
    """Set ``is_new`` to "0" on records that claim a new device on a day other than its stored date."""
    keyed = log.withColumn("mid", F.col("common.mid"))
    joined = lookup_join(keyed, stored_dates(log, tz), ["mid"], "left", limit)
    wrong = (F.col("common.is_new") == "1") & (S.ms_to_day(F.col("ts"), tz) != F.col("stored"))
    fixed = F.when(wrong, F.lit("0")).otherwise(F.col("common.is_new"))
    return with_common(joined, "is_new", fixed).select(*log.columns)


def repaired_checked(checked: DataFrame, tz: str = S.BUSINESS_TZ, limit: int | None = None) -> DataFrame:
    """``repair_is_new`` of the records of ``checked_log``; dirty texts stay among them."""
    mid = F.when(F.col("_clean"), F.col("_r.common.mid"))
    joined = lookup_join(checked.withColumn("mid", mid), stored_dates(_records(checked), tz), ["mid"], "left", limit)
    wrong = (F.col("_r.common.is_new") == "1") & (S.ms_to_day(F.col("_r.ts"), tz) != F.col("stored"))
    fixed = F.when(wrong, F.lit("0")).otherwise(F.col("_r.common.is_new"))
    common = F.when(F.col("_r.common").isNotNull(), F.col("_r.common").withField("is_new", fixed))
    return joined.withColumn("_r", F.col("_r").withField("common", common)).select(*checked.columns)


# -- five-way split -----------------------------------------------------------------------------------

def error_log(log: DataFrame) -> DataFrame:
    return log.filter(F.col("err").isNotNull())


def start_log(log: DataFrame) -> DataFrame:
    return log.filter(F.col("start").isNotNull()).drop("err")


def _pages(log: DataFrame) -> DataFrame:
    return log.filter(F.col("start").isNull())


def display_log(log: DataFrame) -> DataFrame:
    return _pages(log).select("common", "page", F.explode("displays").alias("display"), "ts")


def action_log(log: DataFrame, with_ts: bool = False) -> DataFrame:
    extra = ["ts"] if with_ts else []
    return _pages(log).select("common", "page", F.explode("actions").alias("action"), *extra)


def page_log(log: DataFrame) -> DataFrame:
    return _pages(log).select("common", "page", "ts")


SPLITS = {
    "err": error_log,
    "start": start_log,
    "display": display_log,
    "action": action_log,
    "page": page_log,
}


def split_log(log: DataFrame) -> dict[str, DataFrame]:
    """All five outputs by name."""
    return {name: split(log) for name, split in SPLITS.items()}


_OUTPUTS = "array<struct<output:string,value:string>>"


def _output(condition: Column, name: str, values: Column) -> Column:
    rows = F.transform(values, lambda v: F.struct(F.lit(name).alias("output"), v.alias("value")))
    return F.when(condition, rows).otherwise(F.array().cast(_OUTPUTS))


def _log_outputs(prefix: str = "") -> Column:
    """Every output record of one log record, whose fields are under ``prefix``."""

    def fields(*names: str) -> list[Column]:
        return [F.col(prefix + n).alias(n) for n in names]

    def each(items: str, name: str, *rest: str) -> Column:
        return F.transform(
            prefix + items, lambda item: F.to_json(F.struct(*fields("common", "page"), item.alias(name), *fields(*rest))))

    names = [f.name for f in APP_LOG.fields]
    pages = F.col(prefix + "start").isNull()
    return F.concat(
        _output(F.col(prefix + "err").isNotNull(), "err", F.array(F.to_json(F.struct(*fields(*names))))),
        _output(~pages, "start", F.array(F.to_json(F.struct(*fields(*[n for n in names if n != "err"]))))),
        _output(pages & F.col(prefix + "displays").isNotNull(), "display", each("displays", "display", "ts")),
        _output(pages & F.col(prefix + "actions").isNotNull(), "action", each("actions", "action")),
        _output(pages, "page", F.array(F.to_json(F.struct(*fields("common", "page", "ts"))))),
    )


def tagged_outputs(log: DataFrame) -> DataFrame:
    """The five outputs in one pass: (output, value), the value being the JSON record of that output.

    Each record is read once and gives one row per output record, ready to be written by ``output``.
    """
    return _each(log.select(_log_outputs().alias("_o")), "output")


def tagged_texts(checked: DataFrame) -> DataFrame:
    """The same straight from ``checked_log``, with the dirty texts as a sixth output."""
    dirty = F.array(F.struct(F.lit("dirty").alias("output"), F.col("value").alias("value")))
    return _each(checked.select(F.when(F.col("_clean"), _log_outputs("_r.")).otherwise(dirty).alias("_o")), "output")


def claims(checked: DataFrame) -> DataFrame:
    """Of each text of ``checked_log`` what its repair needs: (mid, ts, is_new, value); a dirty text has only its value."""
    clean = lambda c: F.when(F.col("_clean"), F.col(c))
    return checked.select(clean("_r.common.mid").alias("mid"), clean("_r.ts").alias("ts"), clean("_r.common.is_new").alias("is_new"), "value")


def repaired_texts(claimed: DataFrame) -> DataFrame:
    """All six outputs of ``claims`` whose ``is_new`` is repaired."""
    checked = checked_log(claimed, F.col("is_new").alias("_is_new"))
    common = F.when(F.col("_r.common").isNotNull(), F.col("_r.common").withField("is_new", F.col("_is_new")))
    return tagged_texts(checked.withColumn("_r", F.col("_r").withField("common", common)))


# -- filters and projections --------------------------------------------------------------------------

def on_pages(log: DataFrame, *page_ids: str) -> DataFrame:
    return log.filter(F.col("page.page_id").isin(*page_ids))


def logins(log: DataFrame) -> DataFrame:
    """Records of a known user that came from the login page or started a session."""
    last = F.coalesce(F.col("page.last_page_id"), F.lit(""))
    return log.filter(~S.is_empty(F.col("common.uid")) & last.isin("login", ""))


def searches(log: DataFrame, time: str = "ts") -> DataFrame:
    """Search texts: (fullword, ts), or with another column of time."""
    return log.filter(
        (F.col("page.last_page_id") == "search") & (F.col("page.item_type") == "keyword") & F.col("page.item").isNotNull()
    ).select(F.col("page.item").alias("fullword"), time)


def device_and_search(log: DataFrame) -> DataFrame:
    """User, time, device fields and search word of each record that has ``common``."""
    keyword = F.when(F.col("page.item_type") == "keyword", F.col("page.item"))
    return log.filter(F.col("common").isNotNull()).select(
        F.coalesce("common.uid", F.lit("-1")).alias("uid"),
        F.coalesce("ts", F.lit(0)).alias("ts"),
        F.col("common.vc").alias("vc"), F.col("common.ch").alias("ch"), F.col("common.ar").alias("ar"),
        S.first_token(F.col("common.os")).alias("os"),
        F.col("common.md").alias("md"), F.col("common.ba").alias("ba"),
        keyword.alias("search_item"),
    )


def not_empty(df: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        df = df.filter(~S.is_empty(F.col(c)))
    return df


def page_measures(log: DataFrame) -> DataFrame:
    """Per record its traffic dimensions, a session flag, a page view and its duration."""
    return log.select(
        F.col("common.mid").alias("mid"), F.col("common.vc").alias("vc"), F.col("common.ch").alias("ch"),
        F.col("common.ar").alias("ar"), F.col("common.is_new").alias("is_new"), "ts",
        F.when(S.is_empty(F.col("page.last_page_id")), 1).otherwise(0).cast("bigint").alias("sv"),
        F.lit(1).cast("bigint").alias("pv"),
        F.coalesce("page.during_time", F.lit(0)).cast("bigint").alias("dur"),
    )


def words(texts: DataFrame, column: str, *keep: str, tokens: Column | None = None, name: str = "keyword") -> DataFrame:
    """One row per token. The default tokens are the runs of letters and digits, in lower case."""
    if tokens is None:
        tokens = F.regexp_extract_all(F.lower(F.col(column)), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))
    return texts.select(*keep, F.explode(tokens).alias(name))
