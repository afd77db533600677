"""The registered queries of this subpackage: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe_tree, budgets, count_vectors, feistel, induced, licences, merkle, multi_index, pivots, repetition, rule_ensemble, runs, url_rules,
)
from tidemark.llm.sql import SQL
from tidemark.llm.stage import ready, table

__all__ = ["QUERIES", "SQL", "VOCABULARY"]

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def tuned(spark: SparkSession, sf: str) -> DataFrame:
        return run(ready(spark), sf)

    tuned.__name__, tuned.__doc__ = run.__name__, run.__doc__
    QUERIES[run.__name__] = tuned
    return tuned


@query
def op1_suffix_repetition(spark: SparkSession, sf: str) -> DataFrame:
    return repetition.repetition(table(spark, sf, "documents"))


@query
def op2_rule_ensemble(spark: SparkSession, sf: str) -> DataFrame:
    return rule_ensemble.quality_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op3_hierarchical_budget(spark: SparkSession, sf: str) -> DataFrame:
    chosen = budgets.mix(table(spark, sf, "documents"))
    return chosen.select(F.col("doc.doc_id").alias("doc_id"), "domain", "lang", "source", "tokens", "epoch")


@query
def op4_bpe_tree(spark: SparkSession, sf: str) -> DataFrame:
    found = bpe_tree.encode(table(spark, sf, "documents"), VOCABULARY)
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op5_feistel_pseudonyms(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return feistel.pseudonymise(docs, count="n_pseudonyms")


@query
def op6_induced_sorting(spark: SparkSession, sf: str) -> DataFrame:
    found = induced.remove_repeats(table(spark, sf, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["b"] - s["a"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


@query
def op7_licence_paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return licences.scan(docs, licences.fit(docs))


@query
def op8_count_vector_join(spark: SparkSession, sf: str) -> DataFrame:
    return count_vectors.near_duplicates(table(spark, sf, "documents"))


@query
def op9_url_rules(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select("page_id", "url")
    mined = url_rules.mine(url_rules.labelled_urls(pages, table(spark, sf, "labels")))
    return url_rules.judge(pages, url_rules.RULES, mined)


@query
def op10_pivot_index(spark: SparkSession, sf: str) -> DataFrame:
    return pivots.near_vectors(table(spark, sf, "embeddings"))


@query
def op11_multi_index_hashing(spark: SparkSession, sf: str) -> DataFrame:
    return multi_index.nearest(table(spark, sf, "embeddings"))


@query
def op12_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    found = F.when(tampered, merkle.leaf(text=F.translate("text", "\n", ""))).otherwise(merkle.leaf())
    return merkle.verified(merkle.manifest(table(spark, sf, "documents"), found))


@query
def op13_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    found = runs.periodic_runs(table(spark, sf, "documents"), plant=runs.planted).withColumn("best", runs.greatest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "")
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
