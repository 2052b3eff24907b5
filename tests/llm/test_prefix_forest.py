import numpy as np
from corpus import with_clashes
from pyspark.sql import functions as F

from shelfrank.llm import prefix_forest

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)


def clustered(size, dims=16, seed=13):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((8, dims)) * 2
    vectors = centres[rng.integers(0, 8, size)] + rng.standard_normal((size, dims)) * 0.5
    return [(k, [float(np.float32(x)) for x in v]) for k, v in enumerate(vectors)]


def brute(rows, queries, k=10):
    found = []
    for q in queries:
        own = np.array(dict(rows)[q])
        near = sorted(
            (float(np.sqrt(((np.array(v) - own) ** 2).sum())), i) for i, v in rows if i != q
        )
        found += [(q, rank + 1, i, d) for rank, (d, i) in enumerate(near[:k])]
    return found


def searched(df, every=100, **settings):
    result = prefix_forest.nearest(df, F.col("vec_id") % every == 0, **settings)
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in result.collect())


def test_with_all_rows_as_candidates_the_search_is_exact(spark, monkeypatch):
    monkeypatch.setattr(prefix_forest, "SLICE_ROWS", 150)
    monkeypatch.setattr(prefix_forest, "QUERY_ROWS", 3)
    rows = clustered(700)
    got = searched(table(spark, rows), share=1.0)
    want = brute(rows, range(0, 700, 100))
    assert [x[:3] for x in got] == [x[:3] for x in want]
    assert np.allclose([x[3] for x in got], [x[3] for x in want], rtol=1e-12)


def test_recall_on_the_given_vectors(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], list(r["embedding"])) for r in vectors.collect()]
    got = {x[::2] for x in searched(vectors, 20)}
    want = {x[::2] for x in brute(rows, [i for i, _ in rows if i % 20 == 0])}
    assert len({x[:2] for x in got} & {x[:2] for x in want}) >= 0.9 * len(want)


def test_ascent_takes_in_the_longest_prefixes_first():
    rng = np.random.default_rng(1)
    rows = rng.standard_normal((300, 8))
    forest = prefix_forest.Forest(rows, rows.mean(axis=0))
    codes = forest.codes(rows)
    for q, met in zip(range(5), forest.candidates(rows[:5], 40), strict=True):
        differ = codes ^ codes[:, q : q + 1]
        lengths = prefix_forest.BITS - np.ceil(np.log2(differ.astype(float) + 1))
        longest = lengths.max(axis=0)
        assert len(met) >= 40
        assert longest[met].min() >= np.delete(longest, met).max(initial=-1)


def test_copies_ties_and_few_rows(spark):
    rows = [(k, [1.0, 2.0]) for k in range(0, 400, 4)] + [(1, [1.0, 3.0]), (3, [5.0, 5.0])]
    got = searched(table(spark, rows), 100)
    for q in (0, 100, 200, 300):
        ids = [x[2] for x in got if x[0] == q]
        assert ids == [i for i in range(0, 44, 4) if i != q][:10]
    few = searched(table(spark, [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])]))
    assert [x[:3] for x in few] == [(0, 1, 2), (0, 2, 1)]


def test_edge_cases(spark):
    rows = clustered(60, 4)
    odd = [
        (100, None), (200, []), (300, [0.0] * 4), (400, [1.0, None, 1.0, 1.0]),
        (500, [1.0, float("nan"), 0.0, 0.0]), (600, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0] * 4),
        (700, [1.0, 2.0]), (800, [3.0, 4.0]), rows[0],
    ]
    got = searched(with_clashes(table(spark, rows + odd)))
    assert {x[0] for x in got} == {0, 700, 800}
    assert [x[:3] for x in got if x[0] == 700] == [(700, 1, 800)]
    assert [x[2] for x in got if x[0] == 0] == [x[2] for x in brute(rows, [0])]
    assert searched(table(spark, [])) == []


def test_an_id_with_several_vectors_is_several_points(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [1.0, 0.25]), (2, [0.5, 1.0]), (1, [0.0, 1.5]), (1, [0.0, 1.5])]
    points = sorted({(i, tuple(v)) for i, v in rows})
    pairs = sorted(
        (float(np.hypot(a[0] - b[0], a[1] - b[1])), i) for q, a in points if q == 0 for i, b in points if i
    )
    got = searched(table(spark, rows), 100, k=4)
    assert [(x[2], x[1]) for x in got] == [(i, rank + 1) for rank, (_, i) in enumerate(pairs[:4])]
    assert np.allclose([x[3] for x in got], [d for d, _ in pairs[:4]])
