"""Quality classifier as a sparse rule ensemble.

Shallow trees are grown on statistics of the texts. Every path from a root is a
conjunctive rule over these statistics; a lasso logistic regression gives most rules
the weight zero, and what is left is compiled into one Spark column expression, so
that scoring is a projection over the texts.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfrank.llm.mixing import ODD_MARKS, word_count
from shelfrank.llm.spark_io import delete, named, narrow_side, written

FOLDS = 5
ACCEPTED = 0.3
TREES = 24
DEPTH = 3
LASSO = 0.002
SEED = 11
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# A word that comes a second time right away.
ECHO = r"(?<!\S)(\S+) \1(?!\S)"

# A condition is (statistic, threshold, above); a rule is a set of them.
Condition = tuple[str, float, bool]
Rule = frozenset[Condition]


def held_out(identity: Column, folds: int = FOLDS, fold: int = 0) -> Column:
    """Whether the id falls into the fold from which no labels are learnt."""
    return F.crc32(identity.cast("string").cast("binary")) % folds == fold


def statistics(text: Column) -> dict[str, Column]:
    """Numbers that describe a whole text; those of an empty text for null."""
    text = F.coalesce(text, F.lit(""))
    length = F.length(text)

    def share(marks: str) -> Column:
        return (length - F.length(F.translate(text, marks, ""))) / (length + 1)

    lines = F.split(text, "\n")
    words = word_count(text)
    return {
        "log_words": F.log1p(words.cast("double")),
        "word_length": length / (words + 1),
        "odd_share": share(ODD_MARKS),
        "pipe_share": share("|"),
        "shout_share": share("!"),
        "upper_share": share(UPPER),
        "digit_share": share("0123456789"),
        "point_share": share(".,;:?"),
        "quote_share": share("\"'()[]/\\-"),
        "echo_share": F.regexp_count(text, F.lit(ECHO)) / (words + 1),
        "log_lines": F.log1p(F.size(lines).cast("double")),
        "line_repeats": 1 - F.size(F.array_distinct(lines)) / F.size(lines),
        "line_length": length / F.size(lines),
    }


def _holds(rule: Rule, statistic: Callable[[str], Column]) -> Column:
    parts = [
        statistic(name) > threshold if above else statistic(name) <= threshold
        for name, threshold, above in sorted(rule)
    ]
    return reduce(lambda x, y: x & y, parts).cast("double")


def tree_rules(model, names: list[str]) -> list[Rule]:
    """The conjunctions along all paths of a fitted forest, each once."""
    found: dict[Rule, None] = {}

    def descend(node, path: tuple[Condition, ...]) -> None:
        if path:
            found[frozenset(path)] = None
        if node.getClass().getSimpleName() == "LeafNode":
            return
        split = node.split()
        name, threshold = names[split.featureIndex()], split.threshold()
        descend(node.leftChild(), (*path, (name, threshold, False)))
        descend(node.rightChild(), (*path, (name, threshold, True)))

    for tree in model.trees:
        descend(tree._java_obj.rootNode(), ())
    return list(found)


@dataclass(frozen=True)
class RuleEnsemble:
    """Weighted rules; `probability` compiles them into a column over the statistics, which
    the given function looks up by name."""

    rules: tuple[tuple[Rule, float], ...]
    intercept: float

    def probability(self, statistic: Callable[[str], Column] = F.col) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + _holds(rule, statistic) * weight
        return 1 / (1 + F.exp(-total))


def fit(rows: DataFrame, label: str = "label") -> RuleEnsemble:
    """Fit on all rows of a table of statistics and a 0/1 label.

    Without rows, or with a single label, the ensemble is a constant: the share of
    label 1 with one row of either label added.
    """
    names = [c for c in rows.columns if c != label]
    counts = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(label).alias("ones")).first()
    n, ones = counts["n"], counts["ones"] or 0
    if not 0 < ones < n:
        return RuleEnsemble((), math.log((ones + 1) / (n - ones + 1)))
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(rows)
    forest = RandomForestClassifier(
        labelCol=label, numTrees=TREES, maxDepth=DEPTH, seed=SEED, subsamplingRate=0.7,
        featureSubsetStrategy="onethird", minInstancesPerNode=max(2, min(20, n // 200)),
    ).fit(vectors.select("features", label))
    rules = tree_rules(forest, names)
    if not rules:
        return RuleEnsemble((), math.log((ones + 1) / (n - ones + 1)))
    held = rows.select(label, *[_holds(rule, F.col).alias(f"r{k}") for k, rule in enumerate(rules)])
    held = VectorAssembler(
        inputCols=[f"r{k}" for k in range(len(rules))], outputCol="features"
    ).transform(held)
    lasso = LogisticRegression(
        labelCol=label, elasticNetParam=1.0, regParam=LASSO, standardization=False, maxIter=60
    ).fit(held.select("features", label))
    weights = lasso.coefficients.toArray()
    kept = tuple((rule, float(w)) for rule, w in zip(rules, weights, strict=True) if w)
    return RuleEnsemble(kept, float(lasso.intercept))


def train(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    label_column: str = "quality",
) -> RuleEnsemble:
    """Ensemble from all labelled documents outside the held-out fold.

    Labels other than 0 and 1, null ids and held-out rows are left out.
    """
    spark = docs.sparkSession
    marks = labels.select(F.col(id_column).alias("id"), F.col(label_column).cast("double").alias("label"))
    marks = marks.where(F.col("label").isin(0.0, 1.0) & F.col("id").isNotNull() & ~held_out(F.col("id")))
    texts = named(docs, {"id": id_column, "text": text_column})
    columns = [c.alias(name) for name, c in statistics(F.col("text")).items()]
    rows = written(texts.join(narrow_side(marks), "id").select("label", *columns), "statistics")
    model = fit(rows)
    delete(spark, rows)
    return model


def _rows_and_scores(docs: DataFrame, model: RuleEnsemble, text_column: str) -> DataFrame:
    numbers = F.struct(*[c.alias(n) for n, c in statistics(docs[f"`{text_column}`"]).items()])
    # As the argument of a function, the statistics are computed once and not for every
    # condition that looks at them.
    score = F.get(F.transform(F.array(numbers), lambda s: model.probability(s.getField)), 0)
    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns])
    return docs.select(row.alias("row"), score.alias("score"))


def scored(
    docs: DataFrame, model: RuleEnsemble, text_column: str = "text", score: str = "quality_score"
) -> DataFrame:
    """The documents with their score from 0 to 1; empty and null texts have one too."""
    return _rows_and_scores(docs, model, text_column).select("row.*", F.col("score").alias(score))


def accepted_documents(
    docs: DataFrame, model: RuleEnsemble, text_column: str = "text", accepted: float = ACCEPTED
) -> DataFrame:
    """The documents whose score reaches `accepted`, with their own columns."""
    rows = _rows_and_scores(docs, model, text_column)
    return rows.where(F.col("score") >= accepted).select("row.*")


def quality_scores(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    label_column: str = "quality", accepted: float = ACCEPTED,
) -> DataFrame:
    """Per row: id, held_out, score and predicted (1 from `accepted` on).

    Labels are learnt only outside the held-out fold; neither they nor the id, language
    or source enter a score. Null and empty texts are scored as empty ones; rows that
    repeat are scored alike; an empty table gives an empty result. Further columns are
    ignored.
    """
    model = train(docs, labels, id_column, text_column, label_column)
    texts = named(docs, {"id": id_column, "text": text_column})
    score = scored(texts, model, "text", "score")
    return score.select(
        F.col("id").alias(id_column), F.coalesce(held_out(F.col("id")), F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= accepted).cast("int").alias("predicted"),
    )
