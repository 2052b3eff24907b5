"""Exact duplicates against a plain grouping, and the filters that screen them."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
from corpus import documents, edge_rows, with_clashes
from pyspark.sql import functions as F

from shelfrank.llm import binary_fuse, exact_dedup


def plain(rows):
    groups = defaultdict(list)
    for own, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups[body].append((-len(text or ""), own is None, own or 0, own))
    out = []
    for body, members in groups.items():
        keep = min(members, key=lambda m: m[:3])[3]
        sha = hashlib.sha256(body.encode()).hexdigest()
        out += [(m[3], keep, len(members), m[3] == keep, sha) for m in members]
    return sorted(out, key=str)


def found(df, **options):
    return sorted(map(tuple, exact_dedup.exact_duplicates(df, **options).collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    # A hot group, ties in length, ids on either side of zero, repeated rows.
    more = [(100 + k, "a b " + "c " * (k % 3)) for k in range(200)]
    more += [(-5, "a b"), (-5, "a b"), (1 << 62, "x  y"), (-(1 << 62), "xy  "), (None, "x  y ")]
    return [row[:2] for row in edge_rows()] + more


@pytest.mark.parametrize(
    "options",
    [{}, {"batches": 1}, {"batches": 5, "keys_per_bucket": 2}, {"digest": lambda body: F.substring(F.sha2(body, 256), 1, 1)}],
    ids=["default", "one batch", "many buckets", "digest that confuses texts"],
)
def test_equals_plain_grouping(spark, rows, options):
    assert found(with_clashes(documents(spark, rows)), **options) == plain(rows)


def test_few_heavy_texts_and_the_rest_are_joined_alike(spark, rows, monkeypatch):
    monkeypatch.setattr(exact_dedup, "HEAVY", 10)
    assert found(documents(spark, rows)) == plain(rows)


def test_empty_table(spark):
    assert found(documents(spark, [])) == []


def test_a_snapshot_screens_out_almost_all_new_digests(spark):
    first = [(k, f"old {k}") for k in range(4000)]
    second = [(k, f"new {k}") for k in range(4000)] + [(k, f"old {k}") for k in range(50)]
    kinds = "n long, best decimal(34,0), digest binary, key long"

    def classes(rows):
        frame = documents(spark, rows).withColumn("digest", exact_dedup.sha256(F.col("text")))
        return frame.select(F.lit(1).alias("n"), F.lit(1).alias("best"), "digest", F.xxhash64("digest").alias("key")).to(
            spark.createDataFrame([], kinds).schema
        )

    snapshots = exact_dedup.Snapshots(spark, 3, [], [])
    snapshots.add(classes(first))
    passed = snapshots.screened(classes(second)).where("passed")
    assert 50 <= passed.count() < 50 + 4000 * 0.02
    assert snapshots.found(passed).count() == 50


@pytest.mark.parametrize("size", [0, 1, 2, 3, 7, 50, 1000, 50_000])
def test_filter_holds_all_members_and_few_others(size):
    rng = np.random.default_rng(size)
    keys = rng.integers(0, 1 << 63, size, dtype=np.uint64)
    made = binary_fuse.build(np.concatenate([keys, keys[:10]]))
    assert binary_fuse.contains(made, keys).all()
    others = rng.integers(1 << 63, (1 << 64) - 1, 100_000, dtype=np.uint64)
    assert binary_fuse.contains(made, others).mean() < 0.006
    if size >= 50_000:
        assert len(made) * 8 < 10 * size
