"""Periodic stretches of words, found from minimizers at several scales.

A run is a stretch of words with smallest period q that holds at least three periods and
24 words and that no neighbouring word extends. Periods up to 8 are too short to leave
distinct shingles; they are found by comparing every word with the one q places on.

Longer periods are found scale by scale. A scale covers the periods from above `low` to
`high` with shingles of `high` words, at least a period long, so that inside a run equal
shingles lie a multiple of q apart. Of every window of neighbouring shingles those of least
hash are kept. A window and the one a period on read the same words, so both keep the same
shingle; two such windows fit into three periods. Hence every run holds two kept shingles
that are equal, exactly q apart and with no equal one between them. Such a pair is a seed,
extended word by word to both sides.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.llm.hashing import chunks, mixed, text_buffer
from shelfrank.llm.spark_io import named

LEAST_WORDS = 24
LEAST_PERIODS = 3
# With at least 24 words asked for, periods up to here need no more than that.
SHORT_PERIODS = LEAST_WORDS // LEAST_PERIODS

_U = np.uint64
_LEFT = _U(0x9E3779B97F4A7C15)
_RUN = "struct<start: long, length: long, period: long>"
_RESULT = f"id long, n_words long, runs array<{_RUN}>, strongest {_RUN}, collapsed string"
_ARROW_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def scales(longest: int) -> Iterator[tuple[int, int]]:
    """(low, high] of every scale for texts of at most so many words."""
    low = SHORT_PERIODS
    while LEAST_PERIODS * (low + 1) <= longest:
        high = low * 3 // 2
        yield low, high
        low = high


def _sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """Least or greatest of every `width` neighbours, by doubling."""
    done = 1
    while done * 2 <= width:
        values = pick(values[: len(values) - done], values[done:])
        done *= 2
    rest = width - done
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


class _Shingles:
    """Hashes of all shingles of a growing width, each from two of a power of two."""

    def __init__(self, words: np.ndarray):
        self.width, self.values = 1, mixed(words.astype(_U) + _LEFT)

    def of(self, width: int) -> np.ndarray:
        while self.width * 2 <= width:
            self.values = self._joined(self.width)
            self.width *= 2
        return self._joined(width - self.width) if width > self.width else self.values

    def _joined(self, step: int) -> np.ndarray:
        count = max(len(self.values) - step, 0)
        return mixed(self.values[:count] * _LEFT + self.values[step : step + count])

    def shorten(self, words: int) -> None:
        """Only the first words are of use from now on."""
        self.values = self.values[: max(words - self.width + 1, 0)]


def _kept(values: np.ndarray, width: int) -> np.ndarray:
    """Places that are the least of some window of so many values, equal ones all alike."""
    if len(values) < width:
        return np.empty(0, dtype=np.int64)
    least = _sliding(values, width, np.minimum)
    edge = np.zeros(width - 1, dtype=_U)
    # A value is the least of some window if the greatest least among its windows reaches it.
    return np.flatnonzero(_sliding(np.concatenate([edge, least, edge]), width, np.maximum) == values)


def _seeds(values: np.ndarray, low: int, high: int) -> list[tuple[int, int]]:
    """(distance, place) of neighbouring equal minimizers at a distance of this scale."""
    places = _kept(values, 2 * (low + 1) - high + 1)
    own = values[places]
    order = np.argsort(own, kind="stable")
    places, own = places[order], own[order]
    apart = np.diff(places)
    good = np.flatnonzero((own[1:] == own[:-1]) & (apart > low) & (apart <= high))
    return sorted(zip(apart[good].tolist(), places[good].tolist(), strict=True))


def _end(words: np.ndarray, place: int, lag: int) -> int:
    """First place from here on whose word differs from that `lag` places on."""
    step, last = 64, len(words) - lag
    while place < last:
        stop = min(place + step, last)
        differs = words[place:stop] != words[place + lag : stop + lag]
        if differs.any():
            return place + int(differs.argmax())
        place, step = stop, step * 2
    return last


def _begin(words: np.ndarray, place: int, lag: int) -> int:
    """First place of the stretch of words up to here that equal those `lag` places on."""
    step = 64
    while place > 0:
        stop = max(place - step, 0)
        differs = words[stop:place] != words[stop + lag : place + lag]
        if differs.any():
            return place - int(differs[::-1].argmax())
        place, step = stop, step * 2
    return 0


def _short(words: np.ndarray, lag: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the runs of one short period or of a divisor of it."""
    if len(words) <= lag:
        return
    breaks = np.flatnonzero(words[lag:] != words[:-lag])
    breaks = np.concatenate([[-1], breaks, [len(words) - lag]])
    sizes = np.diff(breaks) - 1
    for k in np.flatnonzero(sizes >= LEAST_WORDS - lag).tolist():
        yield int(breaks[k]) + 1, int(sizes[k]) + lag


def find_runs(words: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) in texts laid end to end, by start and period.

    `words` holds numbers that are equal for equal words, with a number of its own behind
    every text; `sizes` are the words of each text, the longest first.
    """
    found: dict[tuple[int, int], int] = {}
    for lag in range(1, SHORT_PERIODS + 1):
        for span in _short(words, lag):
            found.setdefault(span, lag)
    ends = np.cumsum(sizes + 1)
    shingles = _Shingles(words)
    for low, high in scales(int(sizes[0]) if len(sizes) else 0):
        long = int(np.searchsorted(-sizes, -LEAST_PERIODS * (low + 1), side="right"))
        shingles.shorten(int(ends[long - 1]))
        lag_before, reached = 0, 0
        for lag, place in _seeds(shingles.of(high), low, high):
            if lag == lag_before and place < reached:
                continue
            start, stop = _begin(words, place, lag), _end(words, place, lag)
            lag_before, reached = lag, stop
            length = stop - start + lag
            if stop > start and length >= max(LEAST_WORDS, LEAST_PERIODS * lag):
                # A stretch of a multiple of its period is the same stretch.
                span = (start, length)
                found[span] = min(found.get(span, lag), lag)
    return sorted((start, length, period) for (start, length), period in found.items())


def _strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    if not runs:
        return None
    return max(runs, key=lambda run: (Fraction(run[1], run[2]), -run[0], -run[2]))


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that repeat the first period of a run."""
    if runs:
        keep = np.ones(len(words), dtype=bool)
        for start, length, period in runs:
            keep[start + period : start + length] = False
        words = [words[k] for k in np.flatnonzero(keep).tolist()]
    return b" ".join(words)


def _as_run(run: tuple[int, int, int] | None) -> dict | None:
    return None if run is None else dict(zip(("start", "length", "period"), run, strict=True))


def _judged(ids: pa.Array, texts: list[bytes]) -> pa.RecordBatch:
    # bytes.split() cuts at the six ASCII blanks only.
    split = [text.split() for text in texts]
    order = sorted(range(len(split)), key=lambda k: -len(split[k]))
    sizes = np.array([len(split[k]) for k in order], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    numbers: dict[bytes, int] = {}
    words = np.empty(int(starts[-1]), dtype=np.int64)
    for place, k in enumerate(order):
        low = starts[place]
        words[low : low + sizes[place]] = [numbers.setdefault(w, len(numbers)) for w in split[k]]
        words[low + sizes[place]] = -1 - place
    runs: list[list[tuple[int, int, int]]] = [[] for _ in split]
    for start, length, period in find_runs(words, sizes):
        place = int(np.searchsorted(starts, start, side="right")) - 1
        runs[order[place]].append((start - int(starts[place]), length, period))
    kept = [_collapsed(own, found) for own, found in zip(split, runs, strict=True)]
    columns = {
        "id": ids,
        "n_words": pa.array(map(len, split), pa.int64()),
        "runs": pa.array([list(map(_as_run, found)) for found in runs], pa.list_(_ARROW_RUN)),
        "strongest": pa.array([_as_run(_strongest(found)) for found in runs], _ARROW_RUN),
        "collapsed": pa.array(kept, pa.binary()).cast(pa.string()),
    }
    return pa.RecordBatch.from_pydict(columns)


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_buffer(batch.column("text"))
        for first, last in chunks(offsets):
            texts = [data[offsets[k] : offsets[k + 1]].tobytes() for k in range(first, last)]
            yield _judged(batch.column("id").slice(first, last - first), texts)


def periodic_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document doc_id, n_words, its runs, the strongest of them and the collapsed text.

    Words are what stands between ASCII blanks; runs are numbered by words from 0 and listed
    by start, then period. `strongest` has the greatest length by period, of equal ones the
    first start, then the least period; it is null without a run. `collapsed` is the text
    without the words that repeat the first period of a run, joined by single spaces. A null
    text counts as empty and has no words; every row gives a row, whatever its id, also
    where ids are null or repeated. Other columns are not read. No document leaves its task, and
    a task holds texts of about two megabytes, or one longer text, at a time.
    """
    texts = named(docs, {"id": id_column, "text": text_column})
    texts = texts.select(F.col("id").cast("long").alias("id"), "text")
    return texts.mapInArrow(_judge, _RESULT).withColumnRenamed("id", "doc_id")
