import random
import zlib

import pytest
from corpus import documents, edge_rows, prose, with_clashes
from pyspark.sql import functions as F

from shelfrank.llm import quality

LABELS = "doc_id long, quality int, toxic int"


def labelled(size=400):
    rng = random.Random(12)
    rows, labels = [], []
    for k in range(size):
        words = prose(rng, rng.randint(20, 90)).split()
        kind = k % 4
        if kind == 0:
            words = [w + " |" for w in words]
        elif kind == 1:
            words = [w for w in words[:12] for _ in range(6)]
        rows.append((k, " ".join(words)))
        labels.append((k, int(kind > 1), 0))
    return rows, labels


def test_held_out_documents_are_told_apart(spark):
    rows, labels = labelled()
    labels += [(10**6, 1, 0), (None, 1, 0), (5, None, 0), (6, 7, 0)]
    found = quality.quality_scores(documents(spark, rows), spark.createDataFrame(labels, LABELS)).collect()
    truth = {k: q for k, q, _ in labels[:400]}
    held = [r for r in found if r["held_out"]]
    assert {r["doc_id"] for r in held} == {k for k in range(400) if zlib.crc32(str(k).encode()) % 5 == 0}
    assert sum(r["predicted"] != truth[r["doc_id"]] for r in held) <= 1
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in found)


def test_rules_are_paths_and_lasso_drops_most(spark):
    rows, labels = labelled()
    docs, marks = documents(spark, rows), spark.createDataFrame(labels, LABELS)
    model = quality.train(docs, marks)
    names = set(quality.statistics(F.lit("")))
    assert 0 < len(model.rules) < quality.TREES * (2 ** (quality.DEPTH + 1) - 2) / 2
    for rule, weight in model.rules:
        assert weight and 1 <= len(rule) <= quality.DEPTH
        assert {name for name, _, _ in rule} <= names


def test_compiled_score_equals_rules_by_hand(spark):
    rule = frozenset({("a", 1.0, True), ("b", 2.0, False)})
    model = quality.RuleEnsemble(((rule, 2.0),), -1.0)
    rows = spark.createDataFrame([(2.0, 2.0), (2.0, 3.0), (1.0, 0.0)], "a double, b double")
    got = [r["p"] for r in rows.select(model.probability().alias("p")).collect()]
    assert got == pytest.approx([0.7310585786, 0.2689414214, 0.2689414214])


def test_accepted_documents_keep_their_columns(spark):
    rows, labels = labelled()
    docs = with_clashes(documents(spark, rows))
    model = quality.train(docs, spark.createDataFrame(labels, LABELS))
    kept = quality.accepted_documents(docs, model)
    assert kept.columns == docs.columns
    assert abs(kept.count() - 200) <= 4


def test_edge_cases(spark):
    rows, labels = labelled(120)
    rows += [(10**5 + r[0], r[1]) if r[0] is not None else r[:2] for r in edge_rows()]
    docs = with_clashes(documents(spark, rows))
    marks = with_clashes(spark.createDataFrame(labels, LABELS))
    found = quality.quality_scores(docs, marks).collect()
    assert len(found) == len(rows)
    assert len({r["score"] for r in found if r["doc_id"] in (10**5 + 1, 10**5 + 2)}) == 1
    constant = quality.quality_scores(docs, marks.where("quality = 1")).collect()
    assert len({r["score"] for r in constant}) == 1 and {r["predicted"] for r in constant} == {1}
    assert {r["score"] for r in quality.quality_scores(docs, marks.limit(0)).collect()} == {0.5}
    assert quality.quality_scores(docs.limit(0), marks).count() == 0
