import random

import numpy as np
import pyarrow as pa
from corpus import prose

from shelfrank.llm.hashing import chunks, shingle_sets


def sets_of(texts, width=5):
    found = []
    for _, sets in shingle_sets(pa.array(texts, pa.string()), width):
        found += sets
    return found


def reference(text, width=5):
    words = (text or "").encode().lower().split()
    if 0 < len(words) < width:
        return {tuple(words)}
    return {tuple(words[k : k + width]) for k in range(len(words) - width + 1)}


def test_sizes_and_intersections_equal_those_of_exact_sets():
    rng = random.Random(1)
    texts = [prose(rng, rng.randint(0, 60)) for _ in range(60)]
    texts += [None, "", "  \n", "A b", "a B", "x\x0by\x0cz", "é ñ Ä ä", texts[0].upper(), "a a a a a a a a"]
    exact, hashed = [reference(t) for t in texts], sets_of(texts)
    assert [len(s) for s in hashed] == [len(s) for s in exact]
    for k in range(len(texts)):
        for other in range(k):
            shared = len(np.intersect1d(hashed[k], hashed[other]))
            assert shared == len(exact[k] & exact[other])


def test_runs_of_texts_give_the_same_sets(monkeypatch):
    rng = random.Random(2)
    texts = [prose(rng, 40) for _ in range(30)]
    whole = sets_of(texts)
    parts = [sets_of([t])[0] for t in texts]
    assert all(np.array_equal(a, b) for a, b in zip(whole, parts, strict=True))
    offsets = np.array([0, 10, 10, 500, 510])
    assert list(chunks(offsets, 100)) == [(0, 2), (2, 3), (3, 4)]


def test_slices_of_arrow_arrays_are_read_at_their_place():
    array = pa.array(["x y z", "one two three four five six", None, "last"], pa.string())
    found = [s for _, sets in shingle_sets(array.slice(1, 2), 5) for s in sets]
    assert [len(s) for s in found] == [2, 0]
