"""Mixing sources to target weights by weighted sampling without replacement.

Every document draws an Efraimidis-Spirakis key, an exponential variable divided by
its quality weight, so that the smallest keys of a source are a weighted sample of
it. A source's target first buys complete epochs, each taking every document once.
What is left buys a fraction of one more: documents in order of their key while the
running sum of sizes stays within the budget, and then in further rounds, in the
same order, those that still fit, until none does.

A running sum over a whole source would sort it in one task. The keys are cut into
ranges instead: sums per source and range find the range in which the budget runs
out, which is parted again by its own keys while it holds many rows, and only the
last part is sorted. The outcome of a round is one row per source,
the key at which it stopped; whether a document is taken is an expression of it.

Keys are drawn from id and text, so that only rows that repeat both share one. Among those it
does not matter which are taken, only how many: they are told apart by their place in the
input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfrank.llm.spark_io import delete, narrow_side, written

WEIGHTS = (5.0, 2.0, 1.0)
MOST_EPOCHS = 3
KEY_RANGES = 1024
# A range of more rows is parted again before it is sorted.
RANGE_ROWS = 100_000
# Rounds of no more than this budget are found in one pass; of each source it looks at some
# LAST_BUDGET * log(LAST_BUDGET) documents.
LAST_BUDGET = 5_000
KEY_PARTS = 64
SEED = 17
WORD = r"[^\x20\x09-\x0D]+"
# Marks that ordinary prose hardly uses.
ODD_MARKS = "|#$%&*@{}<>~^_=+"
_BITS = 52


def word_count(text: str | Column) -> Column:
    """Words of a text, runs of characters other than ASCII blanks; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: str | Column) -> Column:
    """From 0.1 to 1: lower, the more odd marks a text has; 1 for an empty or null text."""
    text = F.col(text) if isinstance(text, str) else text
    rest = F.length(F.translate(text, ODD_MARKS, ""))
    share = (rest + 1) / (F.length(text) + 1)
    return F.greatest(F.coalesce(share * share, F.lit(1.0)), F.lit(0.1))


def sampling_key(identity: Column, weight: Column, seed: int = SEED) -> Column:
    """Exponential draw over weight; the draw depends on the seed and the identity alone."""
    drawn = F.shiftrightunsigned(F.xxhash64(F.lit(seed), identity), 64 - _BITS)
    return -F.log((drawn + 0.5) / float(1 << _BITS)) / weight


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_EPOCHS
) -> DataFrame:
    """Targets from (source, source_size), one row per source: adds `number`, `target`.

    Sources in code point order, null last, take the weights in turn and share the sum
    of all sizes by weight. A target stops at `most` times its source's size, and what
    is above is shared again by weight until no target is above.
    """
    # One row per source: windows without partitions hold nothing else.
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]), (F.col("number") % len(weights) + 1).cast("int")
    )
    listed = sizes.withColumn("number", F.row_number().over(by_name) - 1).withColumn("weight", weight)
    # The source that reaches its stop first comes first; each looks at what is left for
    # it and those behind.
    by_stop = Window.orderBy(F.col("stop") / F.col("weight"), "number")
    before = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    onwards = by_stop.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    stopped = listed.withColumn("stop", F.col("source_size") * F.lit(most))
    left = F.sum("source_size").over(Window.partitionBy()) - F.coalesce(
        F.sum("stop").over(before), F.lit(0)
    )
    shared = stopped.withColumn("share", left / F.sum("weight").over(onwards))
    open_share = F.when(F.col("stop") > F.col("share") * F.col("weight"), F.col("share"))
    level = F.min(F.when(open_share.isNotNull(), F.struct("stop_order", "share"))).over(
        Window.partitionBy()
    )
    ordered = shared.withColumn("stop_order", F.row_number().over(by_stop))
    levelled = ordered.withColumn("level", level)
    open_source = F.col("stop_order") >= F.col("level.stop_order")
    target = F.when(open_source, F.col("weight") * F.col("level.share")).otherwise(
        F.col("stop").cast("double")
    )
    return levelled.select("source", "number", "source_size", target.alias("target"))


def _taken() -> Column:
    """Whether a row fits a round of its source and comes before the key at which it stopped."""

    def in_round(found: Column) -> Column:
        within = F.struct("key", "tie") < found["stop"]
        return (F.col("size") <= found["budget"]) & F.coalesce(within, F.lit(True))

    return F.exists("rounds", in_round)


def _edges(part: DataFrame) -> DataFrame:
    """Per source the range its budget runs out in: rows, least and largest key, sum before."""
    sums = part.groupBy("number", "budget", "before", "range").agg(
        F.sum("size").alias("sum"), F.count(F.lit(1)).alias("rows"),
        F.min("key").alias("low"), F.max("key").alias("high"),
        F.min("tie").alias("low_tie"), F.max("tie").alias("high_tie"),
    )
    # At most KEY_RANGES rows per source.
    ranges = Window.partitionBy("number").orderBy("range")
    so_far = F.sum("sum").over(ranges.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    start = (F.col("so_far") - F.col("sum")).alias("before")
    return (
        sums.withColumn("so_far", F.col("before") + so_far).where("so_far > budget")
        .groupBy("number")
        .agg(F.min(F.struct("range", start, "rows", "low", "high", "low_tie", "high_tie")).alias("edge"))
        .select("number", *[f"edge.{c}" for c in ("before", "rows", "low", "high", "low_tie", "high_tie")])
    )


def _next_round(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Sources with one more of `rounds` and the `budget` it leaves; `open` if a stop was met."""
    spark = rows.sparkSession
    budget = F.col("budget")
    waiting = rows.join(narrow_side(sources), "number").where(~_taken() & (F.col("size") <= budget))
    step = F.floor(KEY_RANGES * (1 - F.exp(-F.col("key")))).cast("int")
    waiting = waiting.select(
        "number", "budget", F.lit(0).cast("long").alias("before"), "tie", "size", "key", step.alias("range")
    )
    everything = waiting.groupBy("number").agg(F.sum("size").alias("all"))
    part, scratch = waiting, []
    while True:
        edge = written(_edges(part), "edges")
        scratch.append(edge)
        one_key = F.col("low") == F.col("high")
        inside = waiting.drop("before", "range").join(narrow_side(edge), "number").where(
            F.col("key").between(F.col("low"), F.col("high"))
            & (~one_key | F.col("tie").between(F.col("low_tie"), F.col("high_tie")))
        )
        if edge.where(F.col("rows") > RANGE_ROWS).isEmpty():
            break
        # Rows of one key are parted by their places.
        by_key = F.try_divide(F.col("key") - F.col("low"), F.col("high") - F.col("low"))
        by_tie = F.try_divide(F.col("tie") - F.col("low_tie"), F.col("high_tie") - F.col("low_tie"))
        share = F.when(one_key, by_tie).otherwise(by_key)
        finer = F.least(F.floor(KEY_RANGES * share), F.lit(KEY_RANGES - 1)).cast("int")
        part = inside.withColumn("range", F.coalesce(finer, F.lit(0)))
    in_order = Window.partitionBy("number").orderBy("key", "tie")
    running = F.sum("size").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    over = inside.withColumn("sum", F.col("before") + running).where("sum > budget")
    found = over.groupBy("number").agg(
        F.min(F.struct("key", "tie")).alias("stop"),
        F.min(F.col("sum") - F.col("size")).alias("spent"),
    )
    spent = F.coalesce("spent", "all", F.lit(0))
    result = written(
        sources.join(found, "number", "left")
        .join(everything, "number", "left")
        .withColumn("rounds", F.concat("rounds", F.array(F.struct("budget", "stop"))))
        .withColumn("budget", budget - spent)
        .withColumn("open", F.col("stop").isNotNull())
        .drop("spent", "all", "stop"),
        "sources",
    )
    delete(spark, *scratch)
    return result


def _last_rounds(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Sources with all rounds that are left, of budgets up to LAST_BUDGET, found in one pass.

    The rounds walk the waiting documents in order of their keys, take what still fits and never come back
    to what did not. Of one size they take budget / size documents at most and stop at one more, so
    that the first of each size in order are all they look at.
    """
    waiting = rows.join(narrow_side(sources), "number").where(
        F.col("open") & ~_taken() & (F.col("size") > 0) & (F.col("size") <= F.col("budget"))
    )
    few = waiting.select("number", "budget", "size", "key", "tie", F.pmod(F.xxhash64("tie"), F.lit(KEY_PARTS)).alias("part"))
    # Sizes that very many documents share are cut in parts first.
    for by in (["number", "size", "part"], ["number", "size"]):
        place = F.row_number().over(Window.partitionBy(*by).orderBy("key", "tie"))
        few = few.withColumn("place", place).where(F.col("place") <= F.floor(F.col("budget") / F.col("size")) + 1)
    in_order = F.sort_array(F.collect_list(F.struct("key", "tie", "size")))

    def step(state: Column, doc: Column) -> Column:
        stop = F.struct(doc["key"].alias("key"), doc["tie"].alias("tie"))
        fits = F.struct(state["budget"].alias("budget"), (state["left"] - doc["size"]).alias("left"), state["found"].alias("found"))
        stopped = F.struct(
            state["left"].alias("budget"), state["left"].alias("left"),
            F.concat(state["found"], F.array(F.struct(state["budget"].alias("budget"), stop.alias("stop")))).alias("found"),
        )
        return F.when(doc["size"] > state["budget"], state).when(doc["size"] <= state["left"], fits).otherwise(stopped)

    start = F.struct(F.col("budget"), F.col("budget").alias("left"), F.expr(f"cast(array() as {_ROUNDS})").alias("found"))
    walked = few.groupBy("number", "budget").agg(in_order.alias("docs"))
    ended = walked.select("number", F.aggregate("docs", start, step).alias("end"))
    found = F.coalesce("end.found", F.expr(f"cast(array() as {_ROUNDS})"))
    nothing = F.lit(None).cast("struct<key: double, tie: bigint>")
    last = F.array(F.struct(F.coalesce("end.budget", "budget").alias("budget"), nothing.alias("stop")))
    rounds = F.when(F.col("open"), F.concat("rounds", found, last)).otherwise(F.col("rounds"))
    return written(
        sources.join(ended, "number", "left").withColumn("rounds", rounds).drop("end", "open"), "sources"
    )


_ROUNDS = "array<struct<budget: double, stop: struct<key: double, tie: bigint>>>"


def _drawn(
    docs: DataFrame, id_column: str, text_column: str, source_column: str, weight: Column | None, seed: int
) -> list[Column]:
    """Columns id, source, size, key and tie, expressions over the documents alone."""
    text, identity = docs[f"`{text_column}`"], docs[f"`{id_column}`"]
    drawn = quality_weight(text) if weight is None else weight
    return [
        identity.alias("id"), docs[f"`{source_column}`"].alias("source"), word_count(text).alias("size"),
        sampling_key(F.struct(identity, text), drawn, seed).alias("key"),
        F.monotonically_increasing_id().alias("tie"),
    ]


def _sources(rows: DataFrame, weights: tuple[float, ...], most: int) -> DataFrame:
    """The outcome of the mix, a stored row per source: target, epochs and rounds."""
    spark = rows.sparkSession
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    whole = F.floor(F.col("target") / F.col("source_size") + F.lit(1e-9))
    epochs = F.when(F.col("source_size") > 0, F.least(whole, F.lit(most))).otherwise(0).cast("long")
    sources = written(
        source_targets(sizes, weights, most)
        .withColumn("epochs", epochs)
        .withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
        .withColumn("rounds", F.expr(f"cast(array() as {_ROUNDS})")),
        "sources",
    )
    names = sources.select(F.col("source").alias("name"), "number")
    same_source = F.col("source").eqNullSafe(F.col("name"))
    numbered = written(
        rows.join(narrow_side(names), same_source).select("number", "size", "key", "tie"), "numbered"
    )
    scratch = [numbered]
    # A round takes a waiting document at least, and leaves less than the one it stopped at.
    waits = float("inf")
    while waits is not None and waits > LAST_BUDGET:
        scratch.append(sources)
        sources = _next_round(numbered, sources.drop("open"))
        waits = sources.where("open").agg(F.max("budget")).first()[0]
    if waits is not None:
        scratch.append(sources)
        sources = _last_rounds(numbered, sources)
    delete(spark, *scratch)
    return sources


def _with_times(rows: DataFrame, sources: DataFrame, most: int) -> DataFrame:
    """Rows of id, source, size and key with what is known of their source, and `times`."""
    known = sources.select(F.col("source").alias("name"), "source_size", "target", "epochs", "rounds")
    times = F.least(F.col("epochs") + _taken().cast("long"), F.lit(most))
    times = F.when(F.col("source_size") > 0, times).otherwise(0)
    same_source = F.col("source").eqNullSafe(F.col("name"))
    return rows.join(narrow_side(known), same_source).withColumn("times", times)


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    most: int = MOST_EPOCHS,
    weight: Column | None = None,
    seed: int = SEED,
) -> DataFrame:
    """Per row: id, source, size, source_size, target, times and taken = times * size.

    Sizes are words of whole texts. `times` is how often the mix holds the document: the
    complete epochs of its source, plus one if the fractional epoch takes it. Whole
    documents only, so a source meets its target up to what no waiting document fits in.
    A null or empty text has size 0; a source without words has target 0 and times 0.
    Null is a source of its own. Null and repeated ids change nothing: a row is drawn by id and
    text, and of rows that repeat both as many are taken as fit. An empty table
    gives an empty result. `weight` is a column expression over `docs`, by default
    quality_weight of the text. The same input gives the same mix, however partitioned.
    """
    spark = docs.sparkSession
    rows = written(docs.select(*_drawn(docs, id_column, text_column, source_column, weight, seed)), "sizes")
    sources = _sources(rows, weights, most)
    result = written(
        _with_times(rows, sources, most).select(
            F.col("id").alias(id_column), F.col("source").alias(source_column), "size", "source_size",
            "target", "times", (F.col("times") * F.col("size")).alias("taken"),
        ),
        "mix",
    )
    delete(spark, rows, sources)
    return result


def mix_documents(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    most: int = MOST_EPOCHS,
    weight: Column | None = None,
    seed: int = SEED,
) -> DataFrame:
    """The documents, each as often as `mix` takes it, with their own columns.

    Size and key of a row are expressions of it and are computed again, so that only the
    table of one row per source is joined, and every row, with a null or repeated id too,
    follows its own draw. Documents are read once more for it; of rows that repeat id and
    text, the same ones are taken where both reads divide the input alike, as those of a
    stored table do.
    """
    drawn = _drawn(docs, id_column, text_column, source_column, weight, seed)
    rows = written(docs.select(*drawn), "sizes")
    sources = _sources(rows, weights, most)
    delete(docs.sparkSession, rows)
    own = F.struct(*[docs[f"`{column}`"] for column in docs.columns]).alias("row")
    placed = _with_times(docs.select(own, *drawn), sources, most).where("times > 0")
    copies = F.explode(F.array_repeat("row", F.col("times").cast("int"))).alias("row")
    return placed.select(copies).select("row.*")


def mixed_documents(docs: DataFrame, mixture: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The documents of a mix, each as often as the mix takes it, with their own columns.

    Rows are found by their id: those without one are left out, and rows that repeat an id
    take one count. `mix_documents` needs no ids.
    """
    times = mixture.where("times > 0").select(
        F.col(id_column).alias("id"), F.col("times").cast("int").alias("times")
    )
    once = narrow_side(times.dropDuplicates(["id"]))
    pairs = docs.alias("d").join(once.alias("t"), F.col(f"d.`{id_column}`") == F.col("t.id"))
    row = F.explode(F.array_repeat(F.struct("d.*"), F.col("t.times"))).alias("row")
    return pairs.select(row).select("row.*")
