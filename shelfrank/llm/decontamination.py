"""Benchmark decontamination with spaced seeds.

A seed is a window of words of which a fixed mask ignores some positions, so that a
substituted word at an ignored position leaves the seed's hash as it was. Hashes of all
windows of the benchmark under all masks are joined with those of every window of the
documents; around each hit, document and benchmark item are laid over each other and
the best stretch of the overlap, with substitutions allowed, decides.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfrank.llm.spark_io import BROADCAST_ROWS, delete, free_name, named, without, written

# Fixed masks over eleven words; 1 marks the words that must agree.
MASKS = ("11100100101", "11010001011", "10110100011", "10011101001")
# Items of 5 to 14 words are read by four words in a row, those of seven also around their middle
# word: every overlap that scores enough has such a hit.
SHORT_ITEM = (5, 14)
SHORT_MASKS = {"1111": SHORT_ITEM, "1110111": (7, 7)}
# A stretch scores one for an equal word and minus one for a substituted one.
LEAST_SCORE = 12
LEAST_SHARE = 0.7


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits; an empty array for null."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.array_remove(parts, "")


def _hash(mask: str, tokens: Column, at: Column) -> Column:
    """Hash of the words the mask looks at, in the window that starts at `at`."""
    picked = [F.get(tokens, at + k) for k, mark in enumerate(mask) if mark == "1"]
    return F.xxhash64(F.lit(mask), *picked)


def _windows(rows: DataFrame, masks: tuple[str, ...], *keep: str) -> DataFrame:
    """(keep, at, mask, seed) for every window of `words` that the masks, all of one span, fit in."""
    span, tokens = len(masks[0]), F.col("words")
    starts = F.sequence(F.lit(0), F.size(tokens) - span)
    at = rows.where(F.size(tokens) >= span).select(*keep, F.explode(starts).alias("at"))
    seeds = F.array(*[_hash(mask, tokens, F.col("at")) for mask in masks])
    if "words" not in keep:
        raise ValueError("the windows read the words")
    return at.select(*keep, "at", F.posexplode(seeds).alias("mask", "seed"))


def _hash_before(masks: tuple[str, ...], tokens: Column) -> Column:
    """Seed of the window one word earlier, under the mask of the row; null for the first window."""
    earlier = F.when(F.lit(False), F.lit(0).cast("long"))
    for number, mask in enumerate(masks):
        earlier = earlier.when(F.col("mask") == number, _hash(mask, tokens, F.col("at") - 1))
    return F.when(F.col("at") > 0, earlier)


def _score(item: Column, over: Column) -> Column:
    """Best score of a stretch of words laid over each other."""
    equal = F.zip_with(item, over, lambda x, y: x == y)
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("best"))

    def step(state, same):
        now = F.greatest(F.lit(0), state["now"] + F.when(same, 1).otherwise(-1))
        return F.struct(now.alias("now"), F.greatest(state["best"], now).alias("best"))

    return F.aggregate(equal, start, step, lambda state: state["best"])


def _leaks(docs: DataFrame, seeds: DataFrame, items: DataFrame, masks: tuple[str, ...]) -> DataFrame:
    """Overlaps around the hits of a bounded block of seeds.

    Of neighbouring hits that lay document and item over each other alike, only the first under
    a mask goes on, and only with the words that the item covers. So a text that says one word
    over and over has a row per way to lay it, not per hit, and no row carries the text.
    """
    first = (F.col("mask") == F.col("item_mask")) & ~F.coalesce(
        _hash_before(masks, F.col("words")) == F.col("before"), F.lit(False)
    )
    shift = F.col("at") - F.col("place")
    low = F.greatest(F.lit(0), -shift)
    length = F.least(F.col("item_size"), F.size("words") - shift) - low
    laid = (
        _windows(docs, masks, "id", "words")
        .join(F.broadcast(seeds), "seed")
        .where(first)
        .select("id", "item_id", "item_digest", low.alias("low"), F.slice("words", low + shift + 1, length).alias("over"))
        .distinct()
    )
    both = laid.join(F.broadcast(items), ["item_id", "item_digest"])
    part = F.slice("item", F.col("low") + 1, F.size("over"))
    return both.select("id", "item_id", "needed", _score(part, F.col("over")).alias("score"))


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    least_score: int = LEAST_SCORE,
    least_share: float = LEAST_SHARE,
) -> DataFrame:
    """(id, item, score) for every document that holds a passage of a benchmark item.

    The score is that of the best stretch around any hit; it must reach `least_score`,
    or `least_share` of the words of a shorter item. Overlaps with items of 5 to 14 words are
    all found; those with longer items if a mask of eleven words fits between the substitutions.
    Texts are whole; null and empty texts, and items of fewer than five words, match nothing. Rows that repeat
    an id or an item's id count as one with either text. Empty tables give an empty
    result. Only windows of the benchmark are broadcast, in blocks of at most
    BROADCAST_ROWS seeds, with a pass over the documents for each block.
    """
    spark = docs.sparkSession
    texts = named(docs, {"id": id_column, "text": text_column})
    texts = texts.select("id", words(F.col("text")).alias("words"))
    items = named(benchmark, {"item_id": item_column, "text": item_text_column})
    items = items.select("item_id", words(F.col("text")).alias("words")).distinct()
    items = items.withColumn(
        "needed", F.least(F.lit(least_score), F.ceil(F.size("words") * F.lit(least_share)))
    )
    # Rows that repeat an item's id are told apart by their words.
    items = items.withColumn("item_digest", F.xxhash64("words"))
    found, scratch = [], []
    kinds = [(MASKS, F.size("words") > SHORT_ITEM[1])]
    kinds += [((mask,), F.size("words").between(*sizes)) for mask, sizes in SHORT_MASKS.items()]
    for masks, fits in kinds:
        side = written(items.where(fits), "items")
        seeds = written(
            _windows(side, masks, "item_id", "item_digest", "words").select(
                "seed", "item_id", "item_digest", F.size("words").alias("item_size"), F.col("mask").alias("item_mask"),
                F.col("at").alias("place"), _hash_before(masks, F.col("words")).alias("before"),
            ),
            "seeds",
        )
        scratch += [side, seeds]
        total = seeds.count()
        blocks = -(-total // BROADCAST_ROWS)
        for block in range(blocks):
            here = F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block
            found.append(
                _leaks(
                    texts,
                    seeds.where(here),
                    side.where(here).withColumnRenamed("words", "item"),
                    masks,
                )
            )
    if not found:
        found = [_leaks(texts, seeds, side.withColumnRenamed("words", "item"), masks)]
    every = reduce(DataFrame.unionByName, found)
    result = written(
        every.where("score >= needed").groupBy("id", "item_id").agg(F.max("score").alias("score"))
        .select(F.col("id").alias(id_column), F.col("item_id").alias(item_column), "score"),
        "leaks",
    )
    delete(spark, *scratch)
    return result


def clean_documents(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The documents without a passage of the benchmark, with all columns.

    Rows are known by a hash of id and text, so that one without an id, or with that of another
    row, is judged by its own text.
    """
    name = free_name(docs, "decontamination_id")
    keyed = docs.withColumn(name, F.xxhash64(docs[f"`{id_column}`"], docs[f"`{text_column}`"]))
    found = leaks(keyed, benchmark, name, text_column)
    return without(keyed, found.select(name), name).drop(name)
