"""Quality scores by a sparse rule ensemble.

Statistics of the whole text are Spark columns. Shallow trees are grown on a bounded sample of labelled rows; every path from a
root is a rule, a conjunction of bounds on statistics. A logistic regression with lasso penalty weighs the rules and drops
most of them. What is left is compiled into one Spark expression, so scoring is a projection: no Python, no shuffle.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, materialize, release

#: Labelled rows that the trees and weights are fitted on, at most: those with the smallest hashes of their doc_id.
SAMPLE_ROWS = 20_000
TREES, DEPTH, SEED = 20, 3, 6
#: Penalty on the weights of the rules.
LASSO = 0.002


def statistics(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, list[str]]:
    """``docs`` with a column per statistic of its whole text (null as empty), and their names."""
    text, words_of, lines_of, stats = (free_name(docs, c) for c in ("q_text", "q_words", "q_lines", "q_stats"))
    df = docs.withColumn(text, F.coalesce(F.col(text_col), F.lit("")))
    df = df.withColumn(words_of, F.array_remove(F.split(F.trim(F.col(text)), "[ \\t\\n\\r\\f\\x0B]+"), "")).withColumn(lines_of, F.split(text, "\n"))
    t, n = F.col(text), F.greatest(F.length(text), F.lit(1))
    words = F.greatest(F.size(words_of), F.lit(1))
    without = lambda pattern: F.length(F.regexp_replace(t, pattern, ""))
    found = {
        "chars": F.log1p(F.length(t).cast("double")),
        "mean_word": (F.length(t) - F.size(words_of)) / words,
        "distinct_words": F.size(F.array_distinct(words_of)) / words,
        "distinct_lines": F.size(F.array_distinct(lines_of)) / F.greatest(F.size(lines_of), F.lit(1)),
        "upper": (n - without("\\p{Lu}+")) / n,
        "digits": (n - without("[0-9]+")) / n,
        "symbols": (n - without("[^\\p{L}\\p{N}\\s.,]+")) / n,
        "stops": (n - without("[.,;:]+")) / n,
        "symbol_runs": F.regexp_count(t, F.lit("([#$%&*!?|~=])\\1")) / words,
        "pipes": (n - F.length(F.replace(t, F.lit("|"), F.lit("")))) / words,
    }
    # Through explode, no later filter is moved below the statistics, where it would work them out again for every rule.
    measured = df.withColumn(stats, F.explode(F.array(F.struct(*[F.coalesce(v.cast("double"), F.lit(0.0)).alias(k) for k, v in found.items()]))))
    # Rules name the statistics, so the columns are called the same for every table; one of that name in the input comes back by keep_good.
    names = [f"q_stat_{k}" for k in found]
    return measured.select(*[F.col(f"`{c}`") for c in docs.columns if c not in names], *[F.col(f"{stats}.{k}").alias(m) for k, m in zip(found, names, strict=True)]), names


def held_out(id_col: Column, of: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; a null id is never held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % of == remainder, F.lit(False))


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, is it at most the bound, bound)."""

    bounds: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        out = F.lit(True)
        for name, at_most, bound in self.bounds:
            out = out & (F.col(name) <= bound if at_most else F.col(name) > bound)
        return out


@dataclass
class RuleModel:
    """Weighted rules; ``score`` is a logistic function of the sum of the weights of the rules that hold."""

    intercept: float
    weights: dict[Rule, float]

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.weights.items():
            total = total + F.when(rule.column(), weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


_LINE = re.compile(r"^( *)(If|Else) \(feature (\d+) (<=|>) (\S+)\)$")


def paths(tree: str, names: list[str]) -> set[Rule]:
    """Rules of all paths from the root in the printed form of a tree, bounds of one statistic drawn together."""
    rules: set[Rule] = set()
    stack: list[tuple[int, tuple[str, bool, float]]] = []
    for line in tree.splitlines():
        m = _LINE.match(line)
        if not m:
            continue
        depth = len(m[1])
        while stack and stack[-1][0] >= depth:
            stack.pop()
        stack.append((depth, (names[int(m[3])], m[4] == "<=", float(m[5]))))
        tight: dict[tuple[str, bool], float] = {}
        for _, (name, at_most, bound) in stack:
            old = tight.get((name, at_most), bound)
            tight[name, at_most] = min(old, bound) if at_most else max(old, bound)
        rules.add(Rule(tuple(sorted((n, a, b) for (n, a), b in tight.items()))))
    return rules


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> RuleModel:
    """Fit on the labelled rows that are not held out; with one class alone, the model is a constant."""
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("double").alias("label")).where(F.col("label").isNotNull() & F.col("_id").isNotNull() & ~held_out(F.col("_id"), 3, 1))
    # Bounded by sample_rows, so it may be sent to every executor.
    sample = known.orderBy(F.xxhash64("_id"), "label").limit(sample_rows)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "_id")
    counted, names = statistics(texts, "text")
    rows = materialize(counted.select("label", *names), "quality-sample")
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(counts) < 2:
        share = (sum(k * n for k, n in counts.items()) + 1) / (sum(counts.values()) + 2)
        return RuleModel(math.log(share / (1 - share)), {})
    vectors = rows.select("label", array_to_vector(F.array(*names)).alias("features")).coalesce(2).cache()
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, featureSubsetStrategy="onethird", maxBins=64, seed=SEED).fit(vectors)
    vectors.unpersist()
    rules = sorted({r for t in forest.trees for r in paths(t.toDebugString, names)}, key=lambda r: r.bounds)
    held = rows.select("label", array_to_vector(F.array(*[r.column().cast("double") for r in rules])).alias("features")).coalesce(2).cache()
    lasso = LogisticRegression(regParam=LASSO, elasticNetParam=1.0, maxIter=60, standardization=False).fit(held)
    held.unpersist()
    release(rows)
    return RuleModel(float(lasso.intercept), {r: float(w) for r, w in zip(rules, lasso.coefficients.toArray(), strict=True) if abs(w) > 1e-6})


def report(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every document.

    Null text is scored as empty, a very long one whole. Rows that share a doc_id, repeated rows too, are scored each for itself,
    equal texts equally. Without labels the score is 0.5. Other columns are ignored, whatever their names. No rows: no rows.
    """
    model = fit(docs, labels, id_col=id_col, text_col=text_col)
    counted, _ = statistics(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text")
    return counted.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), model.score().alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are predicted to be of quality, with all their columns, whatever their names.

    Null and empty texts are scored as empty, very long ones whole; repeated rows are scored each for itself and so share their fate. No
    rows: no rows. Without labels the score is 0.5, so all rows stay.
    """
    model = fit(docs, labels, id_col=id_col, text_col=text_col)
    whole = free_name(docs, "q_row")
    # The whole row rides in one struct, apart from the names of the statistics.
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(whole), F.col(text_col).alias("text"))
    counted, _ = statistics(held, "text")
    return counted.where(model.score() >= 0.5).select(f"{whole}.*")
