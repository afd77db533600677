"""Quality classifier: an ensemble of rules over text statistics.

Trees of a random forest give rules: the path to a node is a conjunction of comparisons of statistics. A logistic regression with
lasso penalty weighs the rules (and drops most), and the rest is one column expression that Spark runs inside its generated
code. Labels are the only thing learned from; statistics are of the text alone.

The fit takes a sample of labelled rows with ``SAMPLE`` rows expected, by hash of the id. Null and empty texts have
statistics 0 and get a score as any other. Without labelled rows of both kinds all scores are 0.5. Repeated rows give repeated results.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.stage import staged

#: Labelled rows that the fit expects to use; bounds its work.
SAMPLE = 20_000
TREES, DEPTH, LASSO = 16, 4, 0.001
SEED = 7


def with_statistics(docs: DataFrame, text: str = "text") -> tuple[DataFrame, list[str]]:
    """doc_id and statistics of whole texts, all of them shares or logarithms; and their names."""
    t, words, lines, triples = map(F.col, ("_t", "_words", "_lines", "_triples"))
    chars, many = F.greatest(F.length(t), F.lit(1)), F.greatest(F.size(words), F.lit(1))
    share = lambda letters: (F.length(t) - F.length(F.translate(t, letters, ""))) / chars
    found = {
        "log_words": F.log1p(F.size(words)),
        "word_chars": F.log1p(F.length(t) / many),
        "distinct_words": F.size(F.array_distinct(words)) / many,
        "distinct_triples": F.size(F.array_distinct(triples)) / F.greatest(F.size(triples), F.lit(1)),
        "distinct_lines": F.size(F.array_distinct(lines)) / F.greatest(F.size(lines), F.lit(1)),
        "line_chars": F.log1p(F.length(t) / F.greatest(F.size(lines), F.lit(1))),
        "capitals": F.regexp_count(t, F.lit(r"\p{Lu}")) / chars,
        "symbols": share("#*$%&|<>~^=+@_{}[]\\/"),
        "shouts": share("!?"),
        "digits": share("0123456789"),
        "stops": share(".,;:"),
        "spaces": share(" "),
    }
    # Arrays are columns of their own: inside a lambda an expression would be evaluated for each element.
    read = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_t"))
    split = read.select("doc_id", "_t", F.filter(F.split(F.translate("_t", "\t\n\u000b\f\r", "     "), " "), lambda w: w != "").alias("_words"),
                        F.filter(F.split("_t", "\n"), lambda x: x != "").alias("_lines"))
    # Hashes of three neighbouring words; the last ones run into nulls.
    grouped = split.select("*", F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))).alias("_triples"))
    return grouped.select("doc_id", *[c.cast("double").alias(n) for n, c in found.items()]), list(found)


@dataclass(frozen=True)
class Rule:
    """Holds where each named statistic is at most (or over) its bound."""

    conditions: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        tests = [F.col(name) <= bound if most else F.col(name) > bound for name, most, bound in self.conditions]
        return reduce(lambda a, b: a & b, tests)


def tree_rules(text: str, names: list[str]) -> list[Rule]:
    """The paths to all nodes below the root, from a tree's printed form."""
    rules: list[Rule] = []
    path: list[tuple[int, tuple[str, bool, float]]] = []
    for line in text.splitlines():
        m = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) ([-+.\dEe]+)\)", line)
        if not m:
            continue
        depth = len(m[1])
        path = [p for p in path if p[0] < depth] + [(depth, (names[int(m[2])], m[3] == "<=", float(m[4])))]
        bounds: dict[tuple[str, bool], float] = {}
        for _, (name, most, bound) in path:  # of two bounds on one side the tighter one holds
            old = bounds.get((name, most))
            bounds[name, most] = bound if old is None else min(old, bound) if most else max(old, bound)
        rules.append(Rule(tuple(sorted((name, most, bound) for (name, most), bound in bounds.items()))))
    return rules


@dataclass(frozen=True)
class Ensemble:
    rules: tuple[tuple[Rule, float], ...]
    intercept: float

    def score(self) -> Column:
        total = reduce(lambda a, b: a + b, [F.when(r.column(), F.lit(w)).otherwise(F.lit(0.0)) for r, w in self.rules], F.lit(self.intercept))
        return 1 / (1 + F.exp(-total))


def fit(labelled: DataFrame, names: list[str]) -> Ensemble:
    """``labelled``: the statistics ``names`` and ``label`` (0.0 or 1.0)."""
    data = labelled.select("label", array_to_vector(F.array(*names)).alias("features"), *names).persist()
    if data.select("label").distinct().count() < 2:
        data.unpersist()
        return Ensemble((), 0.0)
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, minInstancesPerNode=10, subsamplingRate=0.7).fit(data)
    rules = list(dict.fromkeys(r for tree in forest.trees for r in tree_rules(tree.toDebugString, names)))
    if not rules:
        data.unpersist()
        return Ensemble((), 0.0)
    held = data.select("label", array_to_vector(F.array(*[r.column().cast("double") for r in rules])).alias("features"))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, maxIter=60, standardization=False).fit(held)
    data.unpersist()
    weighed = tuple((r, float(w)) for r, w in zip(rules, lasso.coefficients.toArray(), strict=True) if w)
    return Ensemble(weighed, float(lasso.intercept))


def quality_scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted of every document. ``labels``: doc_id and quality; held out are ids whose crc32 mod 3 is 1."""
    spark = docs.sparkSession
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    stats, names = with_statistics(docs)
    found = staged(spark, stats, "statistics")
    marks = labels.filter("quality in (0, 1)").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("double").alias("label")).filter(~held_out)
    n = marks.count()
    # A document's place in 0 ... 999999 decides whether it is in the sample, at every size of the table.
    chosen = marks.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < 1_000_000 * min(1.0, sample / max(n, 1)))
    model = fit(found.join(chosen, "doc_id").select("label", *names), names)
    scored = found.withColumn("score", model.score())
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
