"""Toxic passages as maximum-scoring segments.

Word beginnings get the log-odds of occurring in toxic rather than other documents, with
half a document added on either side, so that what no other document holds has odds too.
Those count that chance hardly gives, however rare they are. A text is a sequence of
such scores with a small loss for every character between them; all its maximal
segments are found in one linear scan. How often a segment of that score turns up by
chance in a text of that length is an extreme-value statistic, and a document's
evidence is the sum over its significant segments.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfrank.llm.spark_io import delete, named, narrow_side, written

FOLDS, HELD_FOLD = 4, 2
ACCEPTED = 0.3
BEGINNINGS = (3, 4, 5, 6, 8, 12)
# A beginning counts from so many toxic documents on, if documents drawn regardless of their
# label would be toxic that often with at most this chance.
LEAST_DOCS = 2
CHANCE = 0.001
PRIOR = 0.5
MOST_COUNTS = 500_000
CERTAINTY = 1.64
LEAST_ODDS = 1.5
LOSS = 0.004
SIGNIFICANT = 0.5
MOST_EVIDENCE = 40

_WORD = re.compile(r"[^\W\d_]+")


def held_out(identity: Column) -> Column:
    return F.crc32(identity.cast("string").cast("binary")) % FOLDS == HELD_FOLD


def lowered(text: str | None) -> str:
    """Lower case with every character in its place."""
    text = text or ""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    return low


def beginnings(text: str | None) -> set[str]:
    """Distinct beginnings of the words of a text."""
    words = set(_WORD.findall(lowered(text)))
    return {word[:n] for word in words for n in BEGINNINGS if len(word) >= n}


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Toxic and other documents by beginning; every beginning once per task or bounded table."""
    kinds: tuple[Counter[str], Counter[str]] = (Counter(), Counter())

    def flush():
        other, toxic = kinds
        tokens = list(toxic.keys() | other.keys())
        columns = [pa.array([kind[token] for token in tokens], pa.int64()) for kind in (toxic, other)]
        found = pa.RecordBatch.from_arrays(
            [pa.array(tokens, pa.string()), *columns], names=["token", "toxic", "other"]
        )
        toxic.clear()
        other.clear()
        return found

    for batch in batches:
        pairs = zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True)
        for text, label in pairs:
            kinds[label].update(beginnings(text))
            if len(kinds[0]) + len(kinds[1]) > MOST_COUNTS:
                yield flush()
    if kinds[0] or kinds[1]:
        yield flush()


def _admitted(n_toxic: int, n_other: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = batch.column("token").to_pylist()
            toxic, other = (
                dict(zip(tokens, batch.column(name).to_pylist(), strict=True)) for name in ("toxic", "other")
            )
            found = log_odds(toxic, other, n_toxic, n_other)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.float64())],
                names=["token", "score"],
            )

    return run


def surprise(count: int, rest: int, rate: float) -> float:
    """Chernoff's bound of -log the chance that `count` or more of all are toxic at that rate."""
    total = count + rest
    if count <= rate * total:
        return 0.0
    found = count * math.log(count / total / rate)
    return found + rest * math.log(rest / total / (1 - rate)) if rest else found


def log_odds(toxic: dict[str, int], other: dict[str, int], n_toxic: int, n_other: int) -> dict[str, float]:
    """Lower bounds of the log-odds of each token, for those that reach LEAST_ODDS.

    A token has to be in LEAST_DOCS toxic documents, and in more of them than chance gives.
    """
    found = {}
    rate = n_toxic / (n_toxic + n_other)
    for token, count in toxic.items():
        rest = other.get(token, 0)
        if count < LEAST_DOCS or surprise(count, rest, rate) < -math.log(CHANCE):
            continue
        a, b = count + PRIOR, rest + PRIOR
        odds = math.log(a / (n_toxic + 2 * PRIOR - a)) - math.log(b / (n_other + 2 * PRIOR - b))
        bound = odds - CERTAINTY * math.sqrt(1 / a + 1 / b)
        if bound >= LEAST_ODDS:
            found[token] = bound
    return found


def maximal_segments(hits: list[tuple[int, int, float]], loss: float = LOSS):
    """All maximal scoring segments (start, end, score) of (start, end, score) hits.

    A linear scan: a stack of disjoint candidates with the running total before and after
    each; a candidate is merged with an earlier one whose left total is lower as soon as
    that raises the score of both.
    """
    stack: list[tuple[int, int, float, float]] = []
    total, place = 0.0, None
    for start, end, score in hits:
        if place is not None:
            total -= loss * max(start - place, 0)
        left, right, first = total, total + score, start
        total, place = right, end
        while stack:
            k = len(stack) - 1
            while k >= 0 and stack[k][2] >= left:
                k -= 1
            if k < 0 or stack[k][3] >= right:
                break
            first, left = stack[k][0], stack[k][2]
            del stack[k:]
        stack.append((first, end, left, right))
    return [(first, end, right - left) for first, end, left, right in stack]


@dataclass(frozen=True)
class ToxicityModel:
    lexicon: dict[str, float]
    rate: float  # of the extreme-value law
    scale: float
    steps: tuple[float, ...]  # probability by whole units of evidence

    def chance(self, score: float, length: int) -> float:
        """Segments of at least this score expected by chance in a text of that length."""
        return self.scale * max(length, 1) * math.exp(-self.rate * score)

    def evidence(self, segments, length: int) -> float:
        total = 0.0
        for _, _, score in segments:
            chance = self.chance(score, length)
            if chance < SIGNIFICANT:
                total -= math.log(max(chance, 1e-300))
        return total


def matcher(lexicon: dict[str, float]):
    """Function from a text to its hits (start, end, score), the best beginning per word."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for token, score in lexicon.items():
        automaton.add_word(token, (len(token), score))
    if lexicon:
        automaton.make_automaton()

    def hits(text: str | None) -> list[tuple[int, int, float]]:
        if not lexicon or not text:
            return []
        low = lowered(text)
        best: dict[int, float] = {}
        for last, (length, score) in automaton.iter(low):
            start = last - length + 1
            if (start == 0 or not low[start - 1].isalpha()) and score > best.get(start, 0.0):
                best[start] = score
        found = []
        for start in sorted(best):
            end = _WORD.match(low, start).end()
            found.append((start, end, best[start]))
        return found

    return hits


_SEGMENTS = "id long, length long, segments array<struct<start: int, `end`: int, score: double>>"


def _scan(lexicon: dict[str, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = matcher(lexicon)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        for batch in batches:
            texts = batch.column("text").to_pylist()
            segments = [
                [{"start": a, "end": b, "score": s} for a, b, s in maximal_segments(hits(text))]
                for text in texts
            ]
            lengths = pa.array([len(text or "") for text in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), lengths, pa.array(segments, kind)],
                names=["id", "length", "segments"],
            )

    return run


def monotone(counts: list[tuple[int, int]]) -> list[float]:
    """Rising probabilities from (ones, rows) by level, neighbours pooled where they fall."""
    pools: list[list[float]] = []
    for ones, rows in counts:
        pools.append([ones, rows, 1])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            ones_, rows_, width = pools.pop()
            pools[-1][0] += ones_
            pools[-1][1] += rows_
            pools[-1][2] += width
    return [p for ones, rows, width in pools for p in [(ones + 0.25) / (rows + 0.5)] * int(width)]


def _level(evidence: Column) -> Column:
    return F.least(F.floor(evidence), F.lit(MOST_EVIDENCE)).cast("int")


def _evidence(rate: float, scale: float) -> Column:
    """ToxicityModel.evidence as a column expression over `length` and `segments`."""
    chance = lambda s: F.lit(scale) * F.greatest("length", F.lit(1)) * F.exp(-rate * s["score"])
    part = lambda s: F.when(
        chance(s) < SIGNIFICANT, -F.log(F.greatest(chance(s), F.lit(1e-300)))
    ).otherwise(0.0)
    return F.aggregate("segments", F.lit(0.0), lambda total, s: total + part(s))


def _marks(labels: DataFrame, id_column: str, label_column: str) -> DataFrame:
    label = F.col(label_column).cast("int")
    marks = labels.select(F.col(id_column).alias("id"), label.alias("label"))
    return marks.where(F.col("label").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id")))


def lexicon_of(docs: DataFrame, marks: DataFrame) -> dict[str, float]:
    """Scores of word beginnings from all labelled documents, (id, text) and (id, label)."""
    spark = docs.sparkSession
    labelled = docs.join(narrow_side(marks), "id").select("text", "label")
    sizes = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_other = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_other:
        return {}
    counts = labelled.mapInArrow(_document_counts, "token string, toxic long, other long")
    counts = counts.groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    counts = counts.where(F.col("toxic") >= LEAST_DOCS)
    table = written(counts.mapInArrow(_admitted(n_toxic, n_other), "token string, score double"), "tokens")
    lexicon = {r["token"]: r["score"] for r in table.toLocalIterator()}
    delete(spark, table)
    return lexicon


def toxic_passages(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    label_column: str = "toxic", accepted: float = ACCEPTED,
) -> DataFrame:
    """Per row: id, held_out, score, predicted, evidence and the significant segments.

    Segments carry start and end (exclusive) in code points and their score. Labels are
    learnt only outside the held-out fold, from all labelled documents; the lexicon holds
    every beginning that CHANCE admits. Null and empty texts have no segment and the score of texts
    without evidence. Without labels of both kinds every score is 0. Repeated rows are
    scored alike; an empty table gives an empty result; further columns are ignored.
    """
    spark = docs.sparkSession
    texts = named(docs, {"id": id_column, "text": text_column})
    texts = texts.withColumn("id", F.col("id").cast("long"))
    marks = written(_marks(labels, id_column, label_column), "marks")
    lexicon = lexicon_of(texts, marks)
    scans = written(texts.mapInArrow(_scan(lexicon), _SEGMENTS), "segments")

    known = scans.join(narrow_side(marks), "id")
    clean = known.where("label = 0")
    chars = clean.agg(F.sum("length")).first()[0] or 0
    # Scores are log-odds, whose extreme-value rate is 1. The scale makes the expected number
    # of segments in the clean labelled texts the observed one.
    seen = clean.select(F.explode("segments.score").alias("s")).agg(
        F.count("s").alias("n"), F.sum(F.exp(-F.col("s"))).alias("weight"), F.avg("s").alias("mean")
    ).first()
    rate = 1.0
    count = seen["n"] or 0
    middle = seen["mean"] if count else LEAST_ODDS
    scale = (count + 0.5) * math.exp(rate * middle) / 2 / max(chars, 1)
    evidence = _evidence(rate, scale)
    levels = {
        r["level"]: (r["ones"], r["n"])
        for r in known.select(_level(evidence).alias("level"), "label")
        .groupBy("level").agg(F.sum("label").alias("ones"), F.count(F.lit(1)).alias("n")).collect()
    }
    steps = monotone([levels.get(k, (0, 0)) for k in range(MOST_EVIDENCE + 1)]) if levels else [0.0]
    table = F.array(*[F.lit(float(p)) for p in steps])
    score = F.get(table, F.least(_level(F.col("evidence")), F.lit(len(steps) - 1)))
    significant = F.filter(
        "segments",
        lambda s: F.lit(scale) * F.greatest("length", F.lit(1)) * F.exp(-rate * s["score"]) < SIGNIFICANT,
    )
    result = written(
        scans.withColumn("evidence", evidence).withColumn("score", score)
        .select(
            F.col("id").alias(id_column),
            F.coalesce(held_out(F.col("id")), F.lit(False)).alias("held_out"),
            "score", (F.col("score") >= accepted).cast("int").alias("predicted"),
            "evidence", significant.alias("segments"),
        ),
        "toxicity",
    )
    delete(spark, marks, scans)
    return result
