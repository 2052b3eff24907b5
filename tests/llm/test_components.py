import random

from shelfrank.llm.components import components


def smallest_reachable(pairs):
    near = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    found = {}
    for node in sorted(near):
        if node in found:
            continue
        stack = [node]
        while stack:
            n = stack.pop()
            if n not in found:
                found[n] = node
                stack.extend(near[n])
    return found


def computed(spark, pairs):
    rows = components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert len(rows) == len({r["node"] for r in rows})
    return {r["node"]: r["component"] for r in rows}


def test_random_links_a_long_path_and_a_hub(spark):
    rng = random.Random(4)
    pairs = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)]
    pairs += [(1000 + k, 1001 + k) for k in range(40)]
    pairs += [(5000, 2000 + k) for k in range(50)]
    pairs = [(a, b) for a, b in pairs if a != b]
    assert computed(spark, pairs) == smallest_reachable(pairs)


def test_null_ends_loops_and_no_links(spark):
    assert computed(spark, [(1, 1), (None, 2), (3, None)]) == {}
    assert computed(spark, [(2, 1), (2, 1), (1, 2)]) == {1: 1, 2: 1}
