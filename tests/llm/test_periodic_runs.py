"""Periodic stretches against a plain search over all lags."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from corpus import documents, edge_rows, with_clashes

from shelfrank.llm import periodic_runs, queries

FOLDER = "/root/testdata/sf0.001"


def plain(words):
    """All runs of one text, lag by lag."""
    spans = {}
    for lag in range(1, len(words) // 3 + 1):
        place = 0
        while place + lag < len(words):
            end = place
            while end + lag < len(words) and words[end] == words[end + lag]:
                end += 1
            if end > place and end - place + lag >= max(24, 3 * lag):
                spans.setdefault((place, end - place + lag), lag)
            place = end + 1
    return sorted((start, length, lag) for (start, length), lag in spans.items())


def strongest(runs):
    return max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else None


def collapsed(words, runs):
    gone = {k for start, length, lag in runs for k in range(start + lag, start + length)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def laid_out(texts):
    texts = sorted(texts, key=len, reverse=True)
    flat = [w for k, text in enumerate(texts) for w in (*text, -1 - k)]
    sizes = [len(text) for text in texts]
    starts = np.concatenate([[0], np.cumsum(np.array(sizes, dtype=int) + 1)])
    want = [(s + int(at), n, q) for text, at in zip(texts, starts, strict=False) for s, n, q in plain(text)]
    return np.array(flat, dtype=np.int64), np.array(sizes, dtype=np.int64), sorted(want)


def repetitive(rng):
    letters = rng.choice([1, 2, 3, 50])
    words = [rng.randrange(letters) for _ in range(rng.randrange(150))]
    for _ in range(rng.randrange(4)):
        lag = rng.choice([1, 2, 5, 8, 9, 10, 12, 13, 18, 19, 27, 28, 41, 60, 61, 70])
        block = [rng.randrange(letters) for _ in range(lag)]
        words += (block * 12)[: rng.choice([2 * lag, 3 * lag - 1, 3 * lag, 3 * lag + 1, 10 * lag + 3])]
        words += [rng.randrange(letters) for _ in range(rng.randrange(30))]
    return words


@pytest.mark.parametrize("seed", range(60))
def test_runs_equal_a_plain_search(seed):
    rng = random.Random(seed)
    words, sizes, want = laid_out([repetitive(rng) for _ in range(rng.randrange(8))])
    assert periodic_runs.find_runs(words, sizes) == want


def test_self_similar_texts():
    halves = [bin(k).count("1") & 1 for k in range(400)]
    golden = [0]
    while len(golden) < 400:
        golden = [x for w in golden for x in ([0, 1] if w == 0 else [0])]
    words, sizes, want = laid_out([halves * 3, golden, golden[:90] * 4, [0] * 500, [0, 1] * 300])
    assert periodic_runs.find_runs(words, sizes) == want and len(want) > 4


def test_every_period_of_three_repeats_is_found_at_its_least_length():
    rng = random.Random(8)
    for lag in range(1, 120):
        block = [rng.randrange(1 << 30) for _ in range(lag)]
        text = [-7, *(block * 24)[: max(24, 3 * lag)], -8]
        words, sizes = np.array([*text, -9]), np.array([len(text)])
        assert periodic_runs.find_runs(words, sizes) == [(1, max(24, 3 * lag), lag)]


def test_a_very_long_repetitive_text():
    rng = random.Random(4)
    block = [rng.randrange(1 << 20) for _ in range(70_000)]
    text = [1] * 200_000 + block * 3 + [2, 3] * 100_000
    found = periodic_runs.find_runs(np.array([*text, -1]), np.array([len(text)]))
    assert [(n, q) for _, n, q in found] == [(200_000, 1), (210_000, 70_000), (200_000, 2)]


def test_documents_with_odd_rows(spark):
    rows = [*edge_rows(), (20, "a\u00a0b c " * 30, "a"), (None, "x y " * 20, "b"), (21, "x\x1cy " * 40, "b")]
    got = periodic_runs.periodic_runs(with_clashes(documents(spark, rows))).collect()
    want = []
    for own, text, _ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        runs = plain(words) if len(words) < 3000 else []
        want.append((own, len(words), runs, strongest(runs), collapsed(words, runs)))
    told = [(r[0], r[1], [tuple(x) for x in r[2]], r[3] and tuple(r[3]), r[4]) for r in got]
    assert sorted(told, key=str) == sorted(want, key=str)
    assert periodic_runs.periodic_runs(documents(spark, [])).collect() == []


def test_query_equals_a_plain_version(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r) for r in queries.op12_minimizer_runs(spark, FOLDER).collect()}
    several = 0
    for own, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h, n = zlib.crc32(str(own).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        if n > 4000:
            continue
        runs = plain(words)
        several += bool(runs)
        best = strongest(runs)
        milli = best and 1000 * best[1] // best[2]
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        digests = [hashlib.sha256(t.encode()).hexdigest() for t in (lines, collapsed(words, runs))]
        assert got[own] == (own, len(runs), *(best or (None,) * 3), milli, *digests)
    assert several > 5 and len(got) == len(docs)
