"""Aligned tokens against whole encodings, and external counts against a plain counter."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from corpus import documents, edge_rows, with_clashes
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from shelfrank.llm import queries, token_alignment

FIRST, SECOND = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
FOLDER = "/root/testdata/sf0.001"


def spans(parts):
    ends = np.cumsum([len(p) for p in parts]).tolist()
    return list(zip([0, *ends], ends, strict=False))


def plain(rows):
    """Documents and pairs from whole texts, pair by pair."""
    first, second = Tokenizer.from_file(FIRST), SentencePieceProcessor(model_file=SECOND)
    first.encode_special_tokens = True
    both = token_alignment.tokenizers(FIRST, SECOND)
    told, counts = [], Counter()
    for own, text in rows:
        a = first.encode(" " + (text or ""), add_special_tokens=False).ids
        b = second.encode(text or "")
        parts = [both.bytes_a[k] for k in a], [both.bytes_b[k] for k in b]
        if not text or any(b"".join(p) != (" " + text).encode() for p in parts):
            told.append((own, [], [], [], []))
            continue
        of_a, of_b = map(spans, parts)
        links, at = [], 0
        for k, (low, high) in zip(a, of_a, strict=True):
            while of_b[at][1] <= low:
                at += 1
            j = at
            while j < len(b) and of_b[j][0] < high:
                links.append((k, b[j]))
                j += 1
        cuts = sorted({x[1] for x in of_a} & {x[1] for x in of_b})
        groups, low = [], 0
        for cut in cuts:
            sides = [
                ",".join(str(k) for k, s in zip(ids, of, strict=True) if low <= s[0] and s[1] <= cut)
                for ids, of in ((a, of_a), (b, of_b))
            ] if len(a) < 500 else ["", ""]
            groups.append("|".join(sides))
            low = cut
        counts.update(links)
        told.append((own, a, b, groups, links))
    top = {}
    for (_, y), n in counts.items():
        top[y] = max(top.get(y, 0), n)
    out = []
    for own, a, b, groups, links in told:
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        best = sum(counts[x] == top[x[1]] for x in links)
        out.append((own, len(a), len(b), len(groups), len(links), best, sum(counts[x] for x in links), len(a) < 500 and sha))
    return sorted(out, key=str), counts, top


def found(alignment):
    rows = [tuple(r) for r in alignment.documents.collect()]
    return sorted([(*r[:7], r[1] < 500 and r[7]) for r in rows], key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    parts = list(" \n\t\u3000\xa0a b's\u00e9\u4e2d\U0001F600\u25811234.,!-_\x1c\x85e\u0301\u200b\u0905\u093f")
    parts += ["  ", "   ", " \n", " the", " word", "'s", "<unk>", "</s>", "<|endoftext|>", " <s>", "<0x41>"]
    made = [(1000 + k, "".join(rng.choice(parts) for _ in range(rng.randrange(40)))) for k in range(800)]
    return [row[:2] for row in edge_rows()] + made


@pytest.mark.parametrize("options", [{}, {"spill_records": 300, "fan_in": 3}], ids=["one run", "many runs"])
def test_equals_whole_encodings_and_plain_counts(spark, rows, options):
    want, counts, top = plain(rows)
    df = with_clashes(documents(spark, rows)).repartition(3)
    got = token_alignment.align(df, FIRST, SECOND, **options)
    assert found(got) == want
    pairs = {(r.a, r.b): (r.links, r.best) for r in got.pairs.collect()}
    assert pairs == {x: (n, n == top[x[1]]) for x, n in counts.items()}
    assert sum(r[1] == 0 for r in want) > 50


def test_empty_table(spark):
    got = token_alignment.align(documents(spark, []), FIRST, SECOND)
    assert got.documents.collect() == [] and got.pairs.collect() == []


def test_query_equals_a_plain_version(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    want, _, _ = plain([tuple(r) for r in docs.collect()])
    got = [tuple(r) for r in queries.op13_spill_alignment(spark, FOLDER).collect()]
    assert sorted([(*r[:7], r[1] < 500 and r[7]) for r in got], key=str) == want


def test_cache_is_emptied_when_full(monkeypatch):
    monkeypatch.setattr(token_alignment, "CACHED_CELLS", 5)
    aligner = token_alignment.Aligner(token_alignment.tokenizers(FIRST, SECOND))
    for k in range(20):
        sizes, groups, links, _ = aligner.align([f"one two{k} three{k}", ""])
        assert sizes[1].tolist() == [0, 0, 0, 0] and groups[0] and len(links) == sizes[0, 3]
        assert len(aligner.listed) <= 9


def test_runs_pack_and_merge():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 1 << 40, 500, dtype=np.uint64) % np.uint64(700)) for _ in range(9)]
    runs = [token_alignment.pack(s, s + np.uint64(1)) for s in sets]
    keys, sums = token_alignment._merged(runs)
    want = Counter()
    for s in sets:
        want.update({int(k): int(k) + 1 for k in s})
    assert dict(zip(keys.tolist(), sums.tolist(), strict=True)) == want
    assert (np.diff(keys.astype(np.int64)) > 0).all()
