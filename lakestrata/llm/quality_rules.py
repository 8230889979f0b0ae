"""Quality classifier as a sparse ensemble of rules.

1. Statistics of each whole text are computed (``text_stats``).
2. On at most ``MOST_LABELLED`` labelled rows outside the held-out fifth, a random forest of
   shallow trees is grown. Every path from a root to a node is a rule: a conjunction of
   bounds on statistics. Equal rules count once.
3. A logistic regression with an L1 penalty weighs the rules and leaves most at zero.
4. What remains is compiled into one Spark column expression over the statistics.

Inputs of a score are statistics of the text alone. Defined cases: null and empty texts have
all statistics 0 and are scored by the rules that this satisfies; null ids are kept, never
held out and never learned from; repeated rows are scored each; extra columns are ignored; an
empty table gives no rows; without labels of both kinds every score is the share of label 1
(0.5 without labels).
"""

from __future__ import annotations

import re
from math import log

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held_out, labelled_sample, ship, stage
from .text_stats import STATS, with_stats

MOST_LABELLED = 20_000
TREES = 24
DEPTH = 4
LASSO = 0.001
CUT = 0.3
Rule = tuple[tuple[str, float, float], ...]  # statistic, above, up to


def rules_of(text: str) -> set[Rule]:
    """The paths of a forest's description, from each root to each node, as merged bounds."""
    out: set[Rule] = set()
    path: list[tuple[str, str, float]] = []
    for line in text.splitlines():
        if "Tree" in line:
            path = []
        m = re.match(r"\s*(If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if not m:
            continue
        depth = (len(line) - len(line.lstrip()) - 4) // 1
        path = [p for p in path if p[0] < depth] + [(depth, STATS[int(m[2])], m[3], float(m[4]))]
        bounds: dict[str, tuple[float, float]] = {}
        for _, name, sign, value in path:
            lo, hi = bounds.get(name, (float("-inf"), float("inf")))
            bounds[name] = (lo, min(hi, value)) if sign == "<=" else (max(lo, value), hi)
        out.add(tuple(sorted((k, *v) for k, v in bounds.items())))
    return out


def compiled(rule: Rule) -> Column:
    """1.0 where all bounds hold, else 0.0."""
    hold = F.lit(True)
    for name, lo, hi in rule:
        if lo != float("-inf"):
            hold &= F.col(name) > lo
        if hi != float("inf"):
            hold &= F.col(name) <= hi
    return F.when(hold, 1.0).otherwise(0.0)


def learn(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> tuple[list[tuple[Rule, float]], float]:
    """Rules with weights, and the constant."""
    sample = stage(with_stats(labelled_sample(docs, labels, "quality", most), ["doc_id", "y"]).dropDuplicates(["doc_id"]),
                   "quality")
    count = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    if len(count) < 2:
        share = count.get(1, 0) / sum(count.values()) if count else 0.5
        return [], log((share + 1e-9) / (1 - share + 1e-9))
    rows = VectorAssembler(inputCols=list(STATS), outputCol="x").transform(sample)
    forest = RandomForestClassifier(labelCol="y", featuresCol="x", numTrees=TREES, maxDepth=DEPTH, seed=7,
                                    featureSubsetStrategy="onethird", minInstancesPerNode=5).fit(rows.select("x", "y"))
    rules = sorted(rules_of(forest.toDebugString))
    if not rules:
        return [], log(count[1] / count[0])
    met = F.array(*map(compiled, rules))
    wide = sample.select("y", met.alias("m")).select("y", F.transform("m", lambda v: v).alias("m"))
    from pyspark.ml.functions import array_to_vector

    lasso = LogisticRegression(labelCol="y", featuresCol="r", elasticNetParam=1.0, regParam=LASSO, maxIter=100,
                               standardization=True)
    model = lasso.fit(stage(wide.select("y", array_to_vector("m").alias("r")), "rules"))
    kept = [(r, float(w)) for r, w in zip(rules, model.coefficients.toArray(), strict=True) if w]
    return kept, float(model.intercept)


def quality(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED, cut: float = CUT) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of each row of ``docs``."""
    ship(docs.sparkSession)
    rules, constant = learn(docs, labels, most)
    margin = F.lit(constant)
    for rule, weight in rules:
        margin = margin + F.lit(weight) * compiled(rule)
    return (with_stats(docs, ["doc_id"]).select("doc_id", (1 / (1 + F.exp(-margin))).alias("score"))
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= cut).cast("int").alias("predicted")))
