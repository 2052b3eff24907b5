"""Secrets by fixed patterns and by character Markov models.

Fixed patterns find what announces itself. Other long runs of key characters are judged
by two first-order Markov models of their characters, one of random strings, learnt
from what the patterns found, and one of ordinary words, learnt from a sample of texts:
a run whose log-likelihood ratio is high enough is a secret. All of it is columns.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfrank.llm.spark_io import delete, named, written

# Fixed patterns, in the order in which kinds are listed: (kind, pattern, group, least length).
# The last two are greedy runs, so that a least length inside the pattern finds the same.
PATTERNS = (
    (
        "assign",
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        1,
        6,
    ),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
MARKOV = "markov"
KINDS = (*(p[0] for p in PATTERNS), MARKOV)
RUN_LENGTH = 16
RUN = rf"[A-Za-z0-9+/_=-]{{{RUN_LENGTH},}}"
# Ordinary words are runs too short to be judged, from the texts of so many documents without
# a base span, by smallest hash of their id.
ORDINARY = r"[A-Za-z0-9+/_=-]{4,}"
SAMPLE_DOCS = 2000
LEAST_RATIO = 12.0
# Weight of the characters' own frequencies in a transition, in observations.
PRIOR = 10.0
CODES = 128
BLOCK = 128

_SPAN = "struct<start: int, kind: int, `end`: int, value: string>"


def _bound(value: Column, use) -> Column:
    """use(value) with the value computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def _folded(items: Column, first: Column, step) -> Column:
    """(carry, found): a pass over items that carries a value and collects spans.

    `step` takes what is carried and an item; it returns what to carry on and a span or null.
    Spans are collected by blocks, as every addition copies what it adds to.
    """
    none = F.array().cast(f"array<{_SPAN}>").alias("found")

    def one(state, item):
        carry, span = step(state["carry"], item)
        more = F.when(span.isNull(), state["found"]).otherwise(F.concat(state["found"], F.array(span)))
        return F.struct(carry.alias("carry"), more.alias("found"))

    def over(all_items):
        def block(state, number):
            part = F.slice(all_items, number * BLOCK + 1, BLOCK)
            inner = F.aggregate(part, F.struct(state["carry"].alias("carry"), none), one)
            return _bound(
                inner,
                lambda i: F.struct(
                    i["carry"].alias("carry"), F.concat(state["found"], i["found"]).alias("found")
                ),
            )

        last = F.floor(F.greatest(F.size(all_items) - 1, F.lit(0)) / BLOCK).cast("int")
        return F.aggregate(F.sequence(F.lit(0), last), F.struct(first.alias("carry"), none), block)

    return _bound(items, over)


def _spans(text: Column, kind: int, pattern: str, group: int, least: int) -> Column:
    """All leftmost matches that do not overlap, with places in code points.

    The pieces between the matches and the matches themselves make up the text, so one pass
    that adds up their lengths gives all places.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    lengths = F.zip_with(
        F.split(text, pattern, -1),
        value,
        lambda piece, v: F.struct(F.length(piece).alias("piece"), v.alias("value")),
    )
    parts = F.zip_with(
        lengths,
        whole,
        lambda p, match: F.struct(
            p["piece"].alias("piece"), F.length(match).alias("length"), p["value"].alias("value")
        ),
    )

    def step(at, part):
        start = at + part["piece"]
        end = start + part["length"]
        one = F.struct(
            start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), part["value"].alias("value")
        )
        # The last piece has no match behind it.
        return end, F.when(F.length(part["value"]) >= least, one)

    long_enough = _folded(parts, F.lit(0), step)["found"]
    return F.when(F.regexp_like(text, F.lit(pattern)), long_enough).otherwise(
        F.array().cast(f"array<{_SPAN}>")
    )


def _pairs(runs: DataFrame) -> DataFrame:
    """(a, b, n): how often character b follows a in the strings of a column `value`."""
    at = F.explode(F.expr("sequence(1, length(value) - 1)")).alias("at")
    rows = runs.where(F.length("value") > 1).select("value", at)
    pair = rows.select(
        F.ascii(F.expr("substring(value, at, 1)")).alias("a"),
        F.ascii(F.expr("substring(value, at + 1, 1)")).alias("b"),
    )
    return pair.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))


def _likelihoods(pairs: DataFrame) -> dict[tuple[int, int], float]:
    """Logarithms of transitions, smoothed towards how often each character comes at all.

    At most CODES * CODES rows come to the driver.
    """
    counts = {(r["a"], r["b"]): r["n"] for r in pairs.collect()}
    alphabet = [ord(c) for c in "+-/=_"] + [*range(48, 58), *range(65, 91), *range(97, 123)]
    coming = {b: sum(counts.get((a, b), 0) for a in alphabet) + 0.5 for b in alphabet}
    whole = sum(coming.values())
    found = {}
    for a in alphabet:
        total = sum(counts.get((a, b), 0) for b in alphabet)
        for b in alphabet:
            smoothed = counts.get((a, b), 0) + PRIOR * coming[b] / whole
            found[a, b] = math.log(smoothed / (total + PRIOR))
    return found


@dataclass(frozen=True)
class MarkovRatio:
    """Logarithm of the likelihood ratio, random to ordinary, of a character after another."""

    table: tuple[float, ...]

    def of(self, value: Column) -> Column:
        # A constant that the optimizer folds into one array.
        table = F.split(F.lit(",".join(f"{x:.3f}" for x in self.table)), ",").cast("array<double>")
        at = F.sequence(F.lit(1), F.length(value) - 1)

        def step(total, k):
            a, b = F.ascii(F.substr(value, k, F.lit(1))), F.ascii(F.substr(value, k + 1, F.lit(1)))
            return total + F.coalesce(F.get(table, a * CODES + b), F.lit(0.0))

        return F.when(F.length(value) > 1, F.aggregate(at, F.lit(0.0), step)).otherwise(0.0)


def fit(random: DataFrame, ordinary: DataFrame) -> MarkovRatio:
    """Both models from labelled samples, each a table with a column `value`."""
    one, other = _likelihoods(_pairs(random)), _likelihoods(_pairs(ordinary))
    return MarkovRatio(
        tuple(
            one[a, b] - other[a, b] if (a, b) in one else 0.0
            for a in range(CODES)
            for b in range(CODES)
        )
    )


def _apart(runs: Column, base: Column) -> Column:
    """The runs that no base span overlaps, from one pass over both in the order of places.

    Runs do not overlap each other, so a base span can only meet the last run before it; and a
    run meets a base span before it if any of those reaches beyond its start.
    """
    first = F.struct(F.lit(0).alias("reach"), F.lit(None).cast(_SPAN).alias("open"))

    def step(state, s):
        is_run = s["kind"] == len(PATTERNS)
        met = s["start"] < state["open"]["end"]
        still_open = F.when(is_run, F.when(s["start"] >= state["reach"], s)).otherwise(
            F.when(~F.coalesce(met, F.lit(False)), state["open"])
        )
        reach = F.when(is_run, state["reach"]).otherwise(F.greatest(state["reach"], s["end"]))
        return F.struct(reach.alias("reach"), still_open.alias("open")), F.when(is_run, state["open"])

    def with_last(state):
        last = state["carry"]["open"]
        return F.when(last.isNull(), state["found"]).otherwise(F.concat(state["found"], F.array(last)))

    swept = _bound(_folded(F.array_sort(F.concat(base, runs)), first, step), with_last)
    return F.when(F.size(base) == 0, runs).otherwise(swept)


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    text = F.transform(
        F.array_sort(spans),
        lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"]),
    )
    return F.array_join(text, ",")


def secret_spans(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    sample_docs: int = SAMPLE_DOCS, least_ratio: float = LEAST_RATIO,
) -> DataFrame:
    """Per row: id, `base` and `added` spans (start, kind number, end, value) of whole texts.

    Places count code points and ends are exclusive; kinds are numbered as in KINDS. `added`
    are the runs that the Markov models call random and that no base span overlaps. Without
    base spans there is no sample of random strings and nothing is added. Null counts as
    empty; repeated rows give the same spans; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = named(docs, {"id": id_column, "text": text_column})
    text = F.coalesce("text", F.lit(""))
    base = F.concat(*[_spans(text, k, *p[1:]) for k, p in enumerate(PATTERNS)])
    found = written(
        rows.select("id", base.alias("base"), _spans(text, len(PATTERNS), RUN, 0, 0).alias("runs")),
        "spans",
    )
    # The ids are chosen first: only they pass through a top-n.
    chosen = (
        rows.select("id").where("id is not null").distinct()
        .orderBy(F.xxhash64("id"), "id").limit(sample_docs)
    )
    sample = rows.join(F.broadcast(chosen), "id", "left_semi").join(
        found.where(F.size("base") == 0).select("id"), "id", "left_semi"
    )
    ordinary = sample.select(
        F.explode(F.regexp_extract_all("text", F.lit(ORDINARY), F.lit(0))).alias("value")
    ).where(F.length("value") < RUN_LENGTH)
    random = found.select(F.explode("base.value").alias("value"))
    if random.isEmpty():
        added = F.array().cast(f"array<{_SPAN}>")
    else:
        ratio = fit(random, ordinary)
        apart = _apart(F.col("runs"), F.col("base"))
        added = F.filter(apart, lambda s: ratio.of(s["value"]) >= least_ratio)
    result = written(found.select(F.col("id").alias(id_column), "base", added.alias("added")), "secrets")
    delete(spark, found)
    return result


def summary(spans: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Counts by kind, a digest of the base spans and a list of all spans."""
    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return spans.select(
        id_column,
        *[count(k).alias(f"n_{p[0]}") for k, p in enumerate(PATTERNS)],
        F.sha2(_listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _listed(F.concat("base", "added")).alias("spans"),
        F.size("added").cast("long").alias(f"n_{MARKOV}"),
    )
