"""Dimension lookups. A missing dimension row leaves nulls; it never drops or fails the record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.skew import lookup_join
from tidemark.operators.versions import first_by_key, latest_by_key


def enrich(
    df: DataFrame, dim: DataFrame, key: str, columns: Sequence[str], dim_key: str | None = None,
    limit: int | None = None, sized_by: DataFrame | None = None,
) -> DataFrame:
    """Add ``columns`` of ``dim`` to the rows of ``df`` by ``key``. ``dim`` has one row per key."""
    side = dim.select(F.col(dim_key or key).alias(key), *columns)
    return lookup_join(df, side, [key], "left", limit, sized_by).select(*df.columns, *columns)


def single_match(dim: DataFrame, key: str, order: Sequence[str], last: bool = False) -> DataFrame:
    """One row per key: the first match, or the last where later rows overwrite earlier ones."""
    pick = latest_by_key if last else first_by_key
    return pick(dim, [key], order)


def province_names(df: DataFrame, provinces: DataFrame, limit: int | None = None) -> DataFrame:
    names = provinces.select(F.col("id").alias("province_id"), F.col("name").alias("province_name"))
    return enrich(df, names, "province_id", ["province_name"], limit=limit)


SKU_COLUMNS = [
    "spu_id", "spu_name", "trademark_id", "trademark_name", "category3_id", "category3_name", "category2_id",
    "category2_name", "category1_id", "category1_name",
]


def sku_dimension(
    skus: DataFrame, trademarks: DataFrame, category3: DataFrame, category2: DataFrame, category1: DataFrame
) -> DataFrame:
    """The five lookups behind a SKU joined into one dimension: dimension rows meet dimension rows once,
    instead of every fact row taking five hops."""
    base = skus.select(
        F.col("id").alias("sku_id"), "spu_id", "spu_name", F.col("tm_id").alias("trademark_id"), "category3_id")
    marks = trademarks.select(F.col("id").alias("trademark_id"), F.col("tm_name").alias("trademark_name"))
    c3 = category3.select(F.col("id").alias("category3_id"), F.col("name").alias("category3_name"), "category2_id")
    c2 = category2.select(F.col("id").alias("category2_id"), F.col("name").alias("category2_name"), "category1_id")
    c1 = category1.select(F.col("id").alias("category1_id"), F.col("name").alias("category1_name"))
    out = lookup_join(base, marks, ["trademark_id"], "left")
    out = lookup_join(out, c3, ["category3_id"], "left")
    out = lookup_join(out, c2, ["category2_id"], "left")
    out = lookup_join(out, c1, ["category1_id"], "left")
    return out.select("sku_id", *SKU_COLUMNS)


def sku_lookups(
    df: DataFrame, sku_dim: DataFrame, limit: int | None = None, skus: DataFrame | None = None
) -> DataFrame:
    """Add the SKU dimension; ``skus``, the table it was built from, gives its size."""
    return enrich(df, sku_dim, "sku_id", SKU_COLUMNS, limit=limit, sized_by=skus)


def category_tree(category3: DataFrame, category2: DataFrame, category1: DataFrame) -> DataFrame:
    """Leaf categories with the names of their three levels."""
    c3 = category3.select("id", F.col("name").alias("b3name"), "category2_id")
    c2 = category2.select(F.col("id").alias("category2_id"), F.col("name").alias("b2name"), "category1_id")
    c1 = category1.select(F.col("id").alias("category1_id"), F.col("name").alias("b1name"))
    joined = lookup_join(lookup_join(c3, c2, ["category2_id"]), c1, ["category1_id"])
    return joined.select("id", "b3name", "b2name", "b1name")


def sku_brands(skus: DataFrame, spus: DataFrame, trademarks: DataFrame) -> DataFrame:
    """SKU with its SPU, leaf category and brand name."""
    sku = skus.select(F.col("id").alias("skuid"), F.col("spu_id").alias("spuid"))
    spu = spus.select(F.col("id").alias("spuid"), F.col("category3_id").alias("c3id"), "tm_id")
    mark = trademarks.select(F.col("id").alias("tm_id"), F.col("tm_name").alias("tname"))
    joined = lookup_join(lookup_join(sku, spu, ["spuid"]), mark, ["tm_id"])
    return joined.select("skuid", "spuid", "c3id", "tname")


def search_category(df: DataFrame, tree: DataFrame, compare: DataFrame) -> DataFrame:
    """Add ``b1_category`` of the search word and its ``search_category``.

    The word matches a leaf category name, the last of equal names winning; the first comparison row of
    the top category gives the search category. Both lookups meet on the category side, so the records
    take one join.
    """
    leaves = single_match(
        tree.select(F.col("b3name").alias("search_item"), F.col("b1name").alias("b1_category"), "id"),
        "search_item", ["id"], last=True).drop("id")
    groups = single_match(
        compare.select(F.col("category_name").alias("b1_category"), "search_category", "id"),
        "b1_category", ["id"]).drop("id")
    words = lookup_join(leaves, groups, ["b1_category"], "left", sized_by=compare)
    return enrich(df, words, "search_item", ["b1_category", "search_category"], sized_by=leaves)


def brand_and_category(
    df: DataFrame, brands: DataFrame, tree: DataFrame, skus: DataFrame | None = None
) -> DataFrame:
    """Add ``c3id``, ``tname`` and ``b1_name`` by ``sku_id``; the first match wins on both hops. ``skus``, the table
    ``brands`` was built from, gives its size."""
    sku_id = F.col("skuid").cast(df.schema["sku_id"].dataType).alias("sku_id")
    sku = single_match(brands.select(sku_id, "c3id", "tname"), "sku_id", ["c3id", "tname"])
    top = single_match(tree.select(F.col("id").alias("c3id"), F.col("b1name").alias("b1_name")), "c3id", ["b1_name"])
    both = lookup_join(sku, top, ["c3id"], "left")
    return enrich(df, both, "sku_id", ["c3id", "tname", "b1_name"], sized_by=skus)
