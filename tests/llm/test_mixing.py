import random
from collections import Counter, defaultdict

import pytest
from corpus import documents, edge_rows, prose, with_clashes
from pyspark.sql import functions as F

from shelfrank.llm import mixing
from shelfrank.llm.spark_io import written


def targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(s for s in sizes if s is not None) + [s for s in sizes if s is None]
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    left, open_, found = sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        above = [s for s in open_ if weight[s] * left / total >= most * sizes[s]]
        if not above:
            return found | {s: weight[s] * left / total for s in open_}
        for s in above:
            found[s] = most * sizes[s]
        left -= sum(found[s] for s in above)
        open_ -= set(above)
    return found


def corpus(seed=8):
    rng = random.Random(seed)
    shares = {"a": 5, "b": 200, "c": 40, "d": 300, "é": 1, None: 60}
    names = list(shares)
    weights = list(shares.values())
    return [(k, prose(rng, rng.randint(1, 90)), rng.choices(names, weights)[0]) for k in range(700)]


def mixed(docs):
    return mixing.mix(docs).collect()


def test_targets_epochs_and_budgets(spark):
    rows = corpus()
    found = mixed(documents(spark, rows))
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(text.split())
    want = targets(dict(sizes))
    taken, times = Counter(), defaultdict(set)
    for r in found:
        assert r["target"] == pytest.approx(want[r["source"]])
        assert r["source_size"] == sizes[r["source"]]
        assert r["taken"] == r["times"] * r["size"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        times[r["source"]].add(r["times"])
    for source, target in want.items():
        whole = int(target / sizes[source] + 1e-9)
        assert times[source] <= {whole, whole + 1}  # complete epochs before a fraction of one
        assert target - 90 <= taken[source] <= target


def test_no_document_that_still_fits_is_left(spark):
    # Short documents come late in many sources: three rounds do not reach all that fit.
    rng = random.Random(5)
    rows = [(k, prose(rng, rng.choice([1, 2, 5, 12, 30, 80])), f"s{k % 40:02}") for k in range(2400)]
    left, waiting = {}, defaultdict(list)
    found = mixed(documents(spark, rows))
    least = {}
    for r in found:
        left[r["source"]] = left.get(r["source"], r["target"]) - r["taken"]
        least[r["source"]] = min(least.get(r["source"], 3), r["times"])
    for r in found:
        if r["times"] == least[r["source"]] < 3:
            waiting[r["source"]].append(r["size"])
    assert all(min(sizes) > left[source] - 1e-6 for source, sizes in waiting.items() if left[source] > 1e-6)


def test_one_pass_takes_what_round_after_round_takes(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(k, prose(rng, rng.choice([0, 1, 2, 5, 12, 30, 80])), f"s{k % 9}") for k in range(900)]
    docs, calls, step = documents(spark, rows), [], mixing._next_round
    monkeypatch.setattr(mixing, "_next_round", lambda *args: calls.append(1) or step(*args))
    found = sorted(mixed(docs))
    assert len(calls) == 1
    monkeypatch.setattr(mixing, "LAST_BUDGET", -1)
    assert sorted(mixed(docs)) == found
    assert len(calls) > 3


def test_partitioning_changes_nothing(spark):
    rows = corpus()
    docs = documents(spark, rows)
    again = documents(spark, rows[::-1]).repartition(7)
    assert sorted(map(str, mixed(docs))) == sorted(map(str, mixed(again)))


def test_few_key_ranges_give_the_same_sample(spark, monkeypatch):
    docs = documents(spark, corpus())
    want = sorted(map(str, mixed(docs)))
    monkeypatch.setattr(mixing, "KEY_RANGES", 3)
    assert sorted(map(str, mixed(docs))) == want


def test_large_ranges_are_parted_before_they_are_sorted(spark, monkeypatch):
    # Light documents: almost all keys lie in the last of the first ranges.
    rows = [(k, "|#$%&*@{}<>| word" + " w" * (k % 7), "a" if k < 600 else "b") for k in range(700)]
    docs = documents(spark, rows)
    want = sorted(map(str, mixed(docs)))
    monkeypatch.setattr(mixing, "KEY_RANGES", 4)
    monkeypatch.setattr(mixing, "RANGE_ROWS", 10)
    sorted_rows, edges = [], mixing._edges

    def seen(part):
        found = edges(part)
        sorted_rows.append(max((r["rows"] for r in found.collect()), default=0))
        return found

    monkeypatch.setattr(mixing, "_edges", seen)
    assert sorted(map(str, mixed(docs))) == want
    assert max(sorted_rows) > 10 >= sorted_rows[-1] and len(sorted_rows) > 3


def test_smallest_keys_of_a_source_are_taken_first(spark):
    docs = documents(spark, [(k, "one two three four", "a" if k < 90 else "b") for k in range(120)])
    keys = docs.select("doc_id", mixing.sampling_key(F.struct("doc_id", "text"), F.lit(1.0)).alias("key"))
    rows = mixing.mix(docs).join(keys, "doc_id").where("source = 'a'").orderBy("key").collect()
    times = [r["times"] for r in rows]
    assert times == sorted(times, reverse=True) and len(set(times)) == 2


def test_heavier_documents_are_drawn_more_often(spark):
    text = "plain words only"
    docs = documents(spark, [(k, text if k % 2 else "|odd| #text# $here$", "a") for k in range(4000)])
    docs = docs.unionByName(documents(spark, [(9000 + k, text, "b") for k in range(400)]))
    taken = mixing.mix(docs).where("source = 'a' and taken > 0").groupBy((F.col("doc_id") % 2).alias("p"))
    counts = {r["p"]: r["count"] for r in taken.count().collect()}
    assert counts[1] > 1.2 * counts[0]


def test_edge_cases(spark):
    docs = with_clashes(documents(spark, edge_rows()))
    found = mixed(docs)
    assert len(found) == len(edge_rows())
    sizes = {r["doc_id"]: r["size"] for r in found}
    assert sizes[1] == sizes[2] == sizes[3] == 0 and sizes[6] == 2 and sizes[8] == 30_000
    assert all(r["taken"] <= 3 * r["size"] for r in found)
    assert mixing.mix(docs.limit(0)).count() == 0
    wordless = documents(spark, [(1, "", "a"), (2, None, None)])
    assert {(r["target"], r["times"]) for r in mixed(wordless)} == {(0.0, 0)}


def test_mixed_documents_keep_their_columns(spark):
    docs = with_clashes(documents(spark, corpus()))
    mixture = mixing.mix(docs)
    copies = mixing.mixed_documents(docs, mixture)
    assert copies.columns == docs.columns
    counted = Counter(r["doc_id"] for r in copies.collect())
    assert counted == {r["doc_id"]: r["times"] for r in mixture.collect() if r["times"]}


def test_documents_follow_their_own_draw_without_a_join_of_their_own(spark):
    rows = corpus()
    rows += [(None, text, source) for _, text, source in corpus(9)[:60]]
    rows += [(k, text, source) for k, (_, text, source) in enumerate(corpus(10)[:60])]
    docs = with_clashes(documents(spark, rows))
    copies = mixing.mix_documents(docs)
    assert copies.columns == docs.columns
    assert copies._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
    want = Counter()
    for r in mixed(docs):
        want[r["doc_id"], r["source"], r["size"]] += r["times"]
    counted = Counter((r["doc_id"], r["source"], len(r["text"].split())) for r in copies.collect())
    assert counted == +want and any(k[0] is None for k in counted)


def test_null_and_repeated_ids_lose_no_budget(spark, monkeypatch):
    rng = random.Random(12)
    texts = [prose(rng, rng.randint(1, 40)) for _ in range(300)]
    lone = [(9000 + k, prose(rng, 30), "b") for k in range(20)]
    monkeypatch.setattr(mixing, "RANGE_ROWS", 20)
    for rows in (
        [(None, t, "a") for t in texts],
        [(k % 3, t, "a") for k, t in enumerate(texts)],
        [(k // 100, "one two three", "a") for k in range(300)],
        [(None, "seven words are in this short text", "a")] * 300,
    ):
        found = mixed(documents(spark, rows + lone))
        for source in "ab":
            own = [r for r in found if r["source"] == source]
            target, taken = own[0]["target"], sum(r["taken"] for r in own)
            least = min(r["times"] for r in own)
            waiting = [r["size"] for r in own if r["times"] == least < 3]
            assert taken <= target + 1e-6
            assert not waiting or taken + min(waiting) > target
        copies = mixing.mix_documents(written(documents(spark, rows + lone).repartition(3), "docs"))
        assert copies.count() == sum(r["times"] for r in found)
