"""Mixing sources to target weights: a token budget handed down a tree of domain, language and source.

A node's share of its parent's budget follows its weight among its siblings. No node gets more than its documents hold in
``max_epochs`` passes. What a node cannot take goes to its siblings first, by their weights; as a parent never gets more than
its children can hold together, only a shortage of all siblings reaches the level above. Among siblings in order of capacity by
weight this is a running sum. A leaf then takes whole epochs and a prefix of one more. Each epoch has an order of its own: by
MD5 of seed, epoch and document, where copies of a row follow one another.

Prefixes are found in two steps, so that a leaf with a third of all documents is never sorted in one task: token sums by the
first digits of the hash show the slice in which the budget ends, and only documents of that slice are ranked.

Null levels count as the name ``none``, null texts as 0 tokens; a document of 0 tokens is taken with the place it has in the
order. Unlisted names weigh 1. Siblings of weight 0 get nothing. An empty table gives an empty result. Columns of the
documents keep their names; the operator's own are put together in one struct until the end.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.stage import staged

LEVELS = ("domain", "lang", "source")
SEED = "tidemark-mix"
#: Hexadecimal digits of the hash that name a slice of an epoch.
SLICE_DIGITS = 3

#: Weights of the registered query; names not listed weigh 1.
WEIGHTS: dict[str, dict[str, float]] = {"domain": {"d0": 1.0, "d1": 2.0, "d2": 1.0, "d3": 1.0},
                                        "lang": {"en": 4.0, "de": 2.0, "fr": 2.0, "es": 1.0}, "source": {}}
#: Percent of all tokens that the query's mix has.
PERCENT = 60
MAX_EPOCHS = 2


def domain_of(source: Column) -> Column:
    """Sources are spread over four domains by their number; those without one are ``d0``."""
    number = F.regexp_extract(source, r"(\d{1,9})$", 1)
    return F.concat(F.lit("d"), F.when(number == "", 0).otherwise(F.try_to_number(number, F.lit("999999999")).cast("bigint") % 4).cast("string"))


def tokens_in(text: Column) -> Column:
    """Words of the text, which stand for tokens: runs of other than ASCII white space."""
    spaced = F.translate(text, "\t\n\u000b\f\r", "     ")
    # A word begins at each character that is not a space and follows one (or the start).
    return F.coalesce(F.regexp_count(spaced, F.lit(r"[^ ]+")), F.lit(0)).cast("bigint")


def shared_out(nodes: DataFrame, budgets: DataFrame, parent: Sequence[str], child: str) -> DataFrame:
    """``nodes`` (parent, child, weight, capacity) with ``budget``, from ``budgets`` (parent, budget).

    In order of capacity by weight, a node is full if its capacity is at most its share of what the nodes before it left.
    """
    joined = nodes.join(budgets, list(parent))
    ratio = F.when(F.col("weight") > 0, F.col("capacity") / F.col("weight")).otherwise(F.lit(float("inf")))
    rows = Window.partitionBy(*parent).orderBy("_ratio", child).rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.partitionBy(*parent).orderBy("_ratio", child).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    siblings = Window.partitionBy(*parent)
    led = (joined.withColumn("_ratio", ratio)
           .withColumn("_level", F.when(F.sum("weight").over(rest) > 0, (F.col("budget") - F.coalesce(F.sum("capacity").over(rows), F.lit(0.0)))
                                        / F.sum("weight").over(rest)).otherwise(0.0))
           .withColumn("_full", (F.col("weight") > 0) & (F.col("_ratio") <= F.col("_level"))))
    # All that are not full share what is left by weight, at one level: that of the first of them.
    level = F.min(F.when(~F.col("_full") & (F.col("weight") > 0), F.struct("_ratio", child, "_level"))).over(siblings)["_level"]
    given = F.when(F.col("_full"), F.col("capacity")).otherwise(F.least("capacity", F.greatest(F.lit(0.0), F.col("weight") * level)))
    return led.withColumn("_given", F.coalesce(given, F.lit(0.0))).drop("budget", "_ratio", "_level", "_full").withColumnRenamed("_given", "budget")


def leaf_budgets(leaves: DataFrame, weights: Mapping[str, Mapping[str, float]], budget: Column, max_epochs: int) -> DataFrame:
    """``leaves`` (levels, tokens) with ``budget``; the argument is an expression over the total ``tokens``."""
    leaves = leaves.withColumn("_root", F.lit(0))

    def weight(level: str) -> Column:
        given = weights.get(level) or {}
        pairs = [x for k, v in sorted(given.items()) for x in (F.lit(k), F.lit(float(v)))]
        return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(level)), F.lit(1.0)) if pairs else F.lit(1.0)

    # What gets nothing by a weight on its way down holds nothing for the levels above either.
    given = F.lit(True)
    for level in LEVELS:
        given = given & (weight(level) > 0)
    room = F.when(given, F.col("tokens")).otherwise(0) * F.lit(float(max_epochs))
    total = leaves.groupBy("_root").agg(F.sum("tokens").alias("tokens"))
    budgets = total.select("_root", F.least(budget.cast("double"), F.col("tokens") * F.lit(float(max_epochs))).alias("budget"))
    for depth, level in enumerate(LEVELS):
        parent = ["_root", *LEVELS[:depth]]
        nodes = leaves.groupBy(*parent, level).agg(F.sum(room).alias("capacity"))
        budgets = shared_out(nodes.withColumn("weight", weight(level)), budgets, parent, level).select(*parent, level, "budget")
    return leaves.drop("_root").join(budgets.drop("_root"), list(LEVELS))


def leaf_plan(sizes: DataFrame, weights: Mapping[str, Mapping[str, float]], percent: int, max_epochs: int, seed: str) -> DataFrame:
    """Of each leaf the whole epochs ``_whole`` and the last hash ``_cutoff`` of the epoch begun after them."""
    leaves = sizes.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))
    given = leaf_budgets(leaves, weights, F.floor(F.col("tokens") * F.lit(percent) / 100), max_epochs).select(
        *LEVELS, F.col("tokens").alias("_all"), F.floor(F.col("budget") + 1e-6).cast("bigint").alias("_budget"))
    whole = F.when(F.col("_all") > 0, F.floor(F.col("_budget") / F.col("_all"))).otherwise(0).cast("int")
    plan = given.withColumn("_whole", whole).withColumn("_part", F.col("_budget") - F.col("_whole") * F.col("_all")).drop("_all", "_budget")
    hashed = (sizes.join(plan.filter("_part > 0"), list(LEVELS)).withColumn("_hash", epoch_hash(seed, F.col("_whole")))
              .withColumn("_slice", F.substring("_hash", 1, SLICE_DIGITS)))
    before = Window.partitionBy(*LEVELS).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    last = (hashed.groupBy(*LEVELS, "_slice").agg(F.sum("tokens").alias("_here"))
            .withColumn("_before", F.coalesce(F.sum("_here").over(before), F.lit(0)))
            .join(plan, list(LEVELS)).filter((F.col("_before") <= F.col("_part")) & (F.col("_before") + F.col("_here") > F.col("_part")))
            .select(*LEVELS, "_slice", "_before"))
    # Copies share a hash, so they are taken together or not at all.
    up_to = Window.partitionBy(*LEVELS, "_slice").orderBy("_hash").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    taken = (hashed.join(last, [*LEVELS, "_slice"]).withColumn("_sum", F.sum("tokens").over(up_to) + F.col("_before"))
             .groupBy(*LEVELS, "_slice").agg(F.max(F.when(F.col("_sum") <= F.col("_part"), F.col("_hash"))).alias("_hash"))
             # A slice of which nothing fits: its name sorts after all hashes before it and before all its own.
             .select(*LEVELS, F.coalesce("_hash", "_slice").alias("_cutoff")))
    return plan.join(taken, list(LEVELS), "left").select(*LEVELS, "_whole", F.coalesce("_cutoff", F.lit("")).alias("_cutoff"))


def epoch_hash(seed: str, epoch: Column) -> Column:
    """Place of a document in an epoch."""
    return F.md5(F.concat_ws(":", F.lit(seed), epoch.cast("string"), F.col("_id"), F.col("_text")))


def mix(docs: DataFrame, weights: Mapping[str, Mapping[str, float]] = WEIGHTS, percent: int = PERCENT, max_epochs: int = MAX_EPOCHS,
        seed: str = SEED, domain: Column | None = None, lang: str = "lang", source: str = "source") -> DataFrame:
    """Struct ``doc`` (the document's columns) and ``domain, lang, source, tokens, epoch`` of each document chosen, by epoch."""
    named = lambda c: F.coalesce(c.cast("string"), F.lit("none"))
    chosen = domain if domain is not None else domain_of(F.coalesce(F.col(source), F.lit("")))
    spark = docs.sparkSession
    rows = docs.select(F.struct("*").alias("doc"), named(chosen).alias("domain"), named(F.col(lang)).alias("lang"),
                       named(F.col(source)).alias("source"), tokens_in(F.col("text")).alias("tokens"),
                       F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"),
                       F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("")).alias("_text"))
    sizes = staged(spark, rows.drop("doc"), "mix-sizes")
    # One row per leaf; as a stored table its size is known, and Spark broadcasts it only if it is small.
    plan = staged(spark, leaf_plan(sizes, weights, percent, max_epochs, seed), "mix-plan")
    chosen_epochs = F.col("_whole") + F.when(epoch_hash(seed, F.col("_whole")) <= F.col("_cutoff"), 1).otherwise(0)
    return (rows.join(plan, list(LEVELS)).withColumn("_epochs", chosen_epochs).filter("_epochs > 0")
            .select("doc", *LEVELS, "tokens", F.explode(F.sequence(F.lit(0), F.col("_epochs") - 1)).alias("epoch")))
