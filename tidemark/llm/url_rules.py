"""URL filter: explicit host and path rules, and association rules that FP-growth mines from labelled URLs.

A URL's tokens are its scheme, the parts of its host, the segments of its path (digits as ``0``) and the names in its query.
Labelled URLs are transactions of their tokens and their label. Of the association rules that lead to ``block`` those that rest on
enough URLs and are confident enough are kept, but for rules that a shorter one at least as confident covers. All of these are a table,
however many: an inverted index by each rule's rarest token. Each distinct set of tokens among the URLs looks up its own tokens there, and its
URLs are blocked if all tokens of a rule found are in the set.

Equally rare tokens are told apart by name; of mined rules it does not matter which one blocks. Long URLs have many tokens and nothing
else about them. Null URLs and URLs without ``://`` have an empty host and path, no rule and verdict ``allow``. Repeated rows give repeated
results, an empty table an empty one; without labelled URLs no rule is mined.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.stage import staged

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """Holds for ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str


#: The rules of the registered query.
RULES = (Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
         Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"))

MIN_CONFIDENCE = 0.5
#: Blocked URLs that a rule has to rest on, whatever the size of the table.
MIN_COUNT = 20
BLOCK = "label:block"

MINED = "tokens array<string>, confidence double, token string"


def rest_of(url: Column) -> Column:
    """What follows the first ``://``; empty if there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(rest_of(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(rest_of(url), r"^[^/?#]*([^?#]*)", 1)


def suffixes(host: Column) -> Column:
    """The host, its parent domain, and so on."""
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, k, F.size(parts)), "."))


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct (size, host, path, verdict) of the longest rule that fits; of two equally long ones that with the greater host."""
    by_host: dict[str, list[Rule]] = {}
    for rule in rules:
        by_host.setdefault(rule.host, []).append(rule)
    if not by_host:
        return F.lit(None).cast("struct<size:int,host:string,path:string,verdict:string>")
    index = F.create_map(*[x for h, found in sorted(by_host.items()) for x in (F.lit(h), F.array(*[
        F.struct(F.lit(len(r.host) + len(r.path)).alias("size"), F.lit(r.host).alias("host"), F.lit(r.path).alias("path"),
                 F.lit(r.verdict).alias("verdict")) for r in found]))])
    here = F.flatten(F.filter(F.transform(suffixes(host), lambda h: F.try_element_at(index, h)), lambda x: x.isNotNull()))
    return F.array_max(F.filter(here, lambda r: F.startswith(path, r["path"])))


def tokens_of(url: Column) -> Column:
    """Distinct tokens of a URL."""
    named = lambda prefix, parts: F.transform(
        F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(prefix), F.regexp_replace(x, r"\d+", "0")))
    query = F.regexp_extract(rest_of(url), r"^[^?#]*\?([^#]*)", 1)
    names = F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1))
    scheme = F.array(F.concat(F.lit("scheme:"), F.substring_index(url, "://", 1)))
    found = F.concat(scheme, named("host:", F.split(host_of(url), r"\.")), named("path:", F.split(path_of(url), "/")), named("query:", names))
    return F.when(F.instr(url, "://") > 0, F.array_distinct(found)).otherwise(F.array().cast("array<string>"))


def mine(labelled: DataFrame, min_confidence: float = MIN_CONFIDENCE, min_count: int = MIN_COUNT) -> DataFrame:
    """Token combinations that lead to ``block`` (tokens, confidence, and token, the rarest of them), of ``labelled`` (url, blocked: boolean)."""
    spark = labelled.sparkSession
    marked = F.when(F.col("blocked"), F.array_append(tokens_of(F.col("url")), F.lit(BLOCK))).otherwise(tokens_of(F.col("url")))
    transactions = staged(spark, labelled.filter(F.col("url").isNotNull() & F.col("blocked").isNotNull()).select(marked.alias("items")), "transactions")
    n = transactions.count()
    if n < min_count:
        return spark.createDataFrame([], MINED)
    # Half a URL less, so that no rounding asks for one more.
    model = FPGrowth(itemsCol="items", minSupport=(min_count - 0.5) / n, minConfidence=min_confidence).fit(transactions)
    rules = model.associationRules.filter(F.element_at("consequent", 1) == BLOCK).select(F.array_sort("antecedent").alias("tokens"), "confidence")
    seen = transactions.select(F.explode("items").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    each = rules.select("tokens", "confidence", F.explode("tokens").alias("token")).join(seen, "token")
    rarest = each.groupBy("tokens", "confidence").agg(F.min(F.struct("n", "token"))["token"].alias("token"))
    rules = staged(spark, rarest, "rules")
    wide = rules.select(F.col("tokens").alias("wide"), F.col("confidence").alias("_confidence"), F.explode("tokens").alias("token"))
    covers = ((F.size("tokens") < F.size("wide")) & (F.col("confidence") >= F.col("_confidence"))
              & (F.size(F.array_except("tokens", "wide")) == 0))
    covered = wide.join(rules, "token").filter(covers).select(F.col("wide").alias("tokens")).distinct()
    return staged(spark, rules.join(covered, "tokens", "left_anti"), "mined")


def rule_table(spark: SparkSession, rules: Sequence[Sequence[str]]) -> DataFrame:
    """Rules given by hand, as ``mine`` gives them; long tokens are the rarest as a rule."""
    return spark.createDataFrame([(sorted(r), 1.0, max(r, key=len)) for r in rules], MINED)


def matched(tokens: DataFrame, mined: DataFrame) -> DataFrame:
    """The distinct token sets of ``tokens`` that hold all tokens of some mined rule."""
    rules = mined.select("token", F.col("tokens").alias("_rule"))
    sets = tokens.select("tokens").distinct()
    return sets.withColumn("token", F.explode("tokens")).join(rules, "token").filter(
        F.size(F.array_except("_rule", "tokens")) == 0).select("tokens").distinct()


def judge(pages: DataFrame, rules: Sequence[Rule], mined: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict and whether a mined rule blocks."""
    url = F.col("url")
    read = pages.select(F.col("page_id").cast("bigint").alias("page_id"), url.cast("string").alias("url"))
    # Tokens are a column of their own: inside a lambda an expression would be evaluated for each element.
    found = read.select("page_id", F.coalesce(host_of(url), F.lit("")).alias("host"), F.coalesce(path_of(url), F.lit("")).alias("path"),
                        F.coalesce(tokens_of(url), F.array().cast("array<string>")).alias("tokens"))
    hits = matched(found, mined).withColumn("_hit", F.lit(True))
    ruled = found.join(hits, "tokens", "left").withColumn("mined_block", F.coalesce("_hit", F.lit(False))).withColumn(
        "r", longest_rule(F.col("host"), F.col("path"), rules))
    return ruled.select(
        "page_id", "host", "path", F.concat(F.col("r.host"), F.col("r.path")).alias("rule"),
        F.coalesce(F.col("r.verdict"), F.when(F.col("mined_block"), "block").otherwise("allow")).alias("verdict"), "mined_block")


def labelled_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(url, blocked) of pages that show a labelled document: its number is the path's last one. Toxic or poor ones block."""
    number = F.regexp_extract(path_of(F.col("url")), r"(\d{1,18})\D*$", 1)
    shown = pages.select("url", F.when(number != "", number.cast("bigint")).alias("_doc")).filter("_doc is not null")
    marks = labels.select(F.col("doc_id").alias("_doc"), ((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("blocked"))
    return shown.join(marks, "_doc").select("url", "blocked")
