import random

import pytest
from corpus import documents, edge_rows, prose, with_clashes

from shelfrank.llm import toxicity

LABELS = "doc_id long, quality int, toxic int"
INSULTS = ["vexgrump", "zorklout", "blimfool"]


def brute_segments(hits, loss):
    """Maximal segments by definition: best first, then what is left on either side."""
    if not hits:
        return []
    best, place = None, None
    for a in range(len(hits)):
        total = 0.0
        for b in range(a, len(hits)):
            if b > a:
                total -= loss * max(hits[b][0] - hits[b - 1][1], 0)
            total += hits[b][2]
            if best is None or total > best + 1e-12:
                best, place = total, (a, b)
    a, b = place
    return (
        brute_segments(hits[:a], loss)
        + [(hits[a][0], hits[b][1], pytest.approx(best))]
        + brute_segments(hits[b + 1 :], loss)
    )


def test_segments_equal_their_definition():
    rng = random.Random(10)
    for _ in range(300):
        place, hits = 0, []
        for _ in range(rng.randint(0, 9)):
            place += rng.randint(1, 60)
            hits.append((place, place + 5, rng.uniform(0.1, 4)))
            place += 5
        assert toxicity.maximal_segments(hits, 0.1) == brute_segments(hits, 0.1)


def test_every_passage_of_a_text_is_found_where_it_stands():
    hits = toxicity.matcher({"vex": 5.0, "vexgr": 7.0, "ex": 9.0})
    text = "a vexed É VEXGRUMP" + " calm" * 700 + " vexgrump"
    found = toxicity.maximal_segments(hits(text))
    assert [text[a:b] for a, b, _ in found] == ["vexed É VEXGRUMP", "vexgrump"]


def test_lower_case_keeps_places():
    assert toxicity.lowered("İX") == "İx" and len(toxicity.lowered("İIß")) == 3


def test_rising_probabilities():
    levels = [(1, 100), (0, 0), (5, 10), (1, 10), (9, 9)]
    found = toxicity.monotone(levels)
    assert len(found) == 5 and found == sorted(found) and 0 < found[0] < found[-1] < 1


@pytest.mark.parametrize("rate", [0.02, 0.1])
@pytest.mark.parametrize("rows", [3_000, 50_000])
def test_words_of_toxic_documents_alone_are_learnt_however_rare(rate, rows):
    n_toxic = int(rate * rows)
    count = max(2, round(0.03 * n_toxic))
    toxic = {"clean": count, "seen": count, "chance": round(0.5 * n_toxic), "once": 1}
    other = {"seen": 1, "chance": round(0.5 * (rows - n_toxic))}
    found = toxicity.log_odds(toxic, other, n_toxic, rows - n_toxic)
    assert "clean" in found and not {"chance", "once"} & set(found)
    assert found["clean"] > found.get("seen", 0)


def test_rare_insults_are_found(spark):
    rng = random.Random(12)
    rows, labels = [], []
    for k in range(3000):
        words = prose(rng, 40).split()
        toxic = int(k % 10 == 0)
        if toxic:
            # Each insult is in about 3 % of the toxic documents and in no other.
            words[20:20] = [f"{chr(97 + k // 10 % 26)}qzxwvj"] * 2
        rows.append((k, " ".join(words)))
        labels.append((k, 1, toxic))
    found = toxicity.toxic_passages(documents(spark, rows), spark.createDataFrame(labels, LABELS))
    held = found.where("held_out").collect()
    assert sum(r["predicted"] != (r["doc_id"] % 10 == 0) for r in held) <= 0.02 * len(held)


def labelled(seed=11, size=500):
    rng = random.Random(seed)
    rows, labels = [], []
    for k in range(size):
        words = prose(rng, rng.randint(30, 120)).split()
        toxic = int(k % 8 == 0)
        if toxic:
            start = rng.randrange(len(words))
            words[start:start] = [rng.choice(INSULTS) + rng.choice(["", "ing", "est"]) for _ in range(4)]
        rows.append((k, " ".join(words)))
        labels.append((k, 1, toxic))
    return rows, labels


def test_held_out_documents_are_told_apart(spark):
    rows, labels = labelled()
    labels += [(10**6, 1, 1), (None, 1, 1), (3, 1, None), (4, 1, 9)]
    docs = documents(spark, rows)
    found = toxicity.toxic_passages(docs, spark.createDataFrame(labels, LABELS)).collect()
    truth = {k: t for k, _, t in labels[:500]}
    held = [r for r in found if r["held_out"]]
    assert 60 < len(held) < 200
    assert all(r["predicted"] == truth[r["doc_id"]] for r in held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in found)
    texts = dict(rows)
    for r in held:
        for s in r["segments"]:
            assert texts[r["doc_id"]][s["start"] : s["end"]][:4] in ("vexg", "zork", "blim")


def test_edge_cases(spark):
    rows, labels = labelled()
    rows += [(10**5 + (r[0] or 0), r[1]) if r[0] is not None else r[:2] for r in edge_rows()]
    docs = with_clashes(documents(spark, rows))
    marks = with_clashes(spark.createDataFrame(labels, LABELS))
    found = toxicity.toxic_passages(docs, marks).collect()
    assert len(found) == len(rows)
    blank = [r for r in found if r["doc_id"] in (10**5 + 1, 10**5 + 2, 10**5 + 3)]
    assert len({r["score"] for r in blank}) == 1 and {r["predicted"] for r in blank} == {0}
    assert all(r["segments"] == [] for r in blank)
    unlabelled = toxicity.toxic_passages(docs, marks.limit(0)).collect()
    assert len(unlabelled) == len(rows) and {r["score"] for r in unlabelled} == {0.0}
    assert toxicity.toxic_passages(docs.limit(0), marks).count() == 0
