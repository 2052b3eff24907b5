"""Language identification of web pages by fusing evidence.

The visible text has a likelihood under a character trigram model of every language.
What a page declares in its markup has a likelihood too, learnt from how often pages of
a language declare what. The prior of a page is that of its host, smoothed towards its
registered domain, that towards the address suffix and that towards all pages; all are
grouped sums over the other pages. The posterior is their normalised product.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfrank.llm.spark_io import BROADCAST_ROWS, delete, named, written

BINS = 1 << 15
# Labelled texts per language that the trigram models are fitted on, by smallest hash of id.
SAMPLE_DOCS = 1500
RANGE_BITS = 10
# Trigrams of a text are far from independent: it counts as at most so many.
EFFECTIVE = 40
SMOOTHING = 4.0
NO_MARK = ""

_HIDDEN = re.compile(r"(?is)<!--.*?-->|<(script|style|noscript|template)\b.*?</\1\s*>")
_TAG = re.compile(r"<[^>]*>")
_LETTERS = re.compile(r"[\W\d_]+")
_DECLARED = re.compile(r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?\s*([a-z]{2,3})\b""")


def visible_text(page: str | None) -> str:
    """Text of a page without scripts, styles, comments and tags, entities resolved."""
    return entities.unescape(_TAG.sub(" ", _HIDDEN.sub(" ", page or "")))


def declared_language(page: str | None) -> str:
    found = _DECLARED.search(page or "")
    return found[1].lower() if found else NO_MARK


def trigrams(text: str | None) -> np.ndarray:
    """Bins of all trigrams of the letters of a text, words parted by one blank."""
    clean = f" {_LETTERS.sub(' ', (text or '').lower()).strip()} "
    codes = np.frombuffer(clean.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    if len(codes) < 3:
        return np.empty(0, dtype=np.int64)
    joined = (codes[:-2] * np.uint32(0x9E3779B1)) ^ (codes[1:-1] * np.uint32(0x85EBCA77))
    joined = (joined ^ (codes[2:] * np.uint32(0xC2B2AE3D))) * np.uint32(0x27D4EB2F)
    return (joined >> np.uint32(17)).astype(np.int64)


@dataclass(frozen=True)
class TextModel:
    languages: tuple[str, ...]
    logs: np.ndarray  # languages x BINS

    def likelihood(self, text: str) -> list[float]:
        """Tempered log-likelihood of a text by language; zeros without letters."""
        bins = trigrams(text)
        if not len(bins):
            return [0.0] * len(self.languages)
        return (self.logs[:, bins].mean(axis=1) * min(len(bins), EFFECTIVE)).tolist()


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(
            batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True
        ):
            counts = found.setdefault(lang, np.zeros(BINS, dtype=np.int64))
            counts += np.bincount(trigrams(text), minlength=BINS)
    for lang, counts in found.items():
        bins = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * len(bins), pa.string()), pa.array(bins, pa.int32()),
                pa.array(counts[bins], pa.int64()),
            ],
            names=["lang", "bin", "n"],
        )


def _least_hashes(ids: DataFrame, n: int) -> DataFrame:
    """The n rows (lang, id) of least hash of every language.

    Counts by ranges of the hash show up to which range all rows belong; only the rows of
    the range at the border are sorted, so no task sorts a language.
    """
    hashed = ids.withColumn("hash", F.xxhash64("id"))
    hashed = hashed.withColumn("range", F.shiftright("hash", 64 - RANGE_BITS))
    counts = hashed.groupBy("lang", "range").agg(F.count(F.lit(1)).alias("rows"))
    # At most 2 ** RANGE_BITS rows a language.
    upto = Window.partitionBy("lang").orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    before = (F.sum("rows").over(upto) - F.col("rows")).alias("before")
    wanted = counts.select("lang", "range", before).where(F.col("before") < n)
    last = wanted.groupBy("lang").agg(F.max(F.struct("range", "before")).alias("last"))
    # One row a language.
    border = last.select("lang", F.col("last.range").alias("border"), F.col("last.before").alias("sure"))
    near = hashed.join(F.broadcast(border), "lang").where(F.col("range") <= F.col("border"))
    order = Window.partitionBy("lang").orderBy("hash", "id")
    edge = near.where(F.col("range") == F.col("border")).withColumn("place", F.row_number().over(order))
    edge = edge.where(F.col("place") <= F.lit(n) - F.col("sure"))
    return near.where(F.col("range") < F.col("border")).select("id", "lang").unionByName(edge.select("id", "lang"))


def fit_text_model(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    lang_column: str = "lang", sample_docs: int = SAMPLE_DOCS,
) -> TextModel:
    """Trigram models from a bounded sample of labelled documents, `sample_docs` a language.

    The ids are chosen before any text is read. Rows without text, id or language are left out.
    """
    rows = named(docs, {"id": id_column, "text": text_column, "lang": lang_column})
    ids = rows.where("id is not null and lang is not null").select("id", "lang")
    chosen = _least_hashes(ids, sample_docs)
    sample = rows.join(F.broadcast(chosen.select("id", "lang")), ["id", "lang"], "left_semi")
    table = (
        sample.where("text is not null").select("lang", "text")
        .mapInArrow(_counts, "lang string, bin int, n long")
        .groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    )
    counts = table.toPandas()
    languages = tuple(sorted(counts["lang"].unique()))
    sums = np.zeros((len(languages), BINS))
    place = {lang: k for k, lang in enumerate(languages)}
    sums[counts["lang"].map(place).to_numpy(dtype=int), counts["bin"].to_numpy()] = counts["n"]
    logs = np.log((sums + 0.1) / (sums.sum(axis=1, keepdims=True) + 0.1 * BINS))
    return TextModel(languages, logs)


def _read_pages(model: TextModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = batch.column("html").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"), batch.column("host"),
                    pa.array([declared_language(page) for page in pages], pa.string()),
                    pa.array(
                        [model.likelihood(visible_text(page)) for page in pages],
                        pa.list_(pa.float64()),
                    ),
                ],
                names=["page_id", "host", "declared", "text_log"],
            )

    return run


def host_of(url: Column) -> Column:
    """Host of an address in lower case, empty where there is none."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    host = F.regexp_replace(F.lower(host), r"^.*@|:\d*$|\.$", "")
    return host


def _normalised(logs: Column) -> Column:
    top = F.array_max(logs)
    parts = F.transform(logs, lambda x: F.exp(x - top))
    total = F.aggregate(parts, F.lit(0.0), lambda s, x: s + x)
    return F.transform(parts, lambda x: x / total)


def identify(pages: DataFrame, model: TextModel, id_column: str = "page_id",
             url_column: str = "url", html_column: str = "html") -> DataFrame:
    """Per row: id, host, declared, lang, probability and text_lang, by text alone.

    A page without letters is judged by what it declares and by its host, one without
    anything by all pages. Null markup and addresses count as empty; rows that repeat a
    page count as often as they occur; an empty table gives an empty result. Without any
    language in the model lang is null. A hot host is one partial sum per task, and its
    pages are split in the joins by adaptive execution.
    """
    spark = pages.sparkSession
    rows = named(pages, {"page_id": id_column, "url": url_column, "html": html_column})
    rows = rows.select(F.col("page_id").cast("long"), host_of(F.col("url")).alias("host"), "html")
    if not model.languages:
        none = F.lit(None).cast("string")
        return rows.select(
            F.col("page_id").alias(id_column), "host", none.alias("declared"), none.alias("lang"),
            F.lit(None).cast("double").alias("probability"), none.alias("text_lang"),
        )
    size = len(model.languages)
    scanned = rows.mapInArrow(
        _read_pages(model), "page_id long, host string, declared string, text_log array<double>"
    )
    parts = F.split("host", r"\.")
    scanned = written(
        scanned.withColumn("p", _normalised(F.col("text_log")))
        .withColumn("suffix", F.element_at(parts, -1))
        .withColumn("domain", F.array_join(F.slice(parts, -F.least(F.size(parts), F.lit(2)), 2), ".")),
        "pages",
    )

    sums = [F.sum(F.get("p", k)).alias(f"s{k}") for k in range(size)]
    again = [F.sum(f"s{k}").alias(f"s{k}") for k in range(size)]
    gathered = F.array(*[F.col(f"s{k}") for k in range(size)])
    hosts = written(scanned.groupBy("host", "domain", "suffix").agg(*sums), "hosts")
    domains = hosts.groupBy("domain", "suffix").agg(*again)
    suffixes = domains.groupBy("suffix").agg(*again)
    marks = scanned.groupBy("declared").agg(*sums)
    whole = scanned.agg(*sums).first()
    total = F.array(*[F.lit(float(whole[f"s{k}"] or 0.0)) for k in range(size)])

    def looked_up(table: DataFrame, key: str, name: str) -> DataFrame:
        side = table.select(F.col(key), gathered.alias(name))
        return F.broadcast(side) if side.count() <= BROADCAST_ROWS // 4 else side

    joined = (
        scanned.join(looked_up(hosts, "host", "by_host"), "host")
        .join(looked_up(domains, "domain", "by_domain"), "domain")
        .join(looked_up(suffixes, "suffix", "by_suffix"), "suffix")
        .join(looked_up(marks, "declared", "by_mark"), "declared")
    )

    def others(counts: Column) -> Column:
        """Sums without the page's own share."""
        return F.zip_with(counts, "p", lambda n, own: F.greatest(n - own, F.lit(0.0)))

    def smoothed(counts: Column, prior: Column) -> Column:
        n = F.aggregate(counts, F.lit(0.0), lambda s, x: s + x)
        return F.zip_with(counts, prior, lambda x, q: (x + SMOOTHING * q) / (n + SMOOTHING))

    even = F.array(*[F.lit(1.0 / size)] * size)
    joined = joined.withColumn("prior", smoothed(others(total), even))
    for level in ("by_suffix", "by_domain", "by_host"):
        joined = joined.withColumn("prior", smoothed(others(F.col(level)), F.col("prior")))
    # How often pages of each language carry this declaration, towards an even share of it.
    share = F.zip_with(
        others(F.col("by_mark")), others(total), lambda x, n: (x + 0.5) / (n + 0.5 * (size + 1))
    )
    joined = joined.withColumn("mark", F.when(F.col("declared") == NO_MARK, even).otherwise(share))
    logs = F.transform(
        F.sequence(F.lit(0), F.lit(size - 1)),
        lambda k: F.get("text_log", k) + F.log(F.get("prior", k)) + F.log(F.get("mark", k)),
    )
    joined = joined.withColumn("posterior", _normalised(logs))
    names = F.array(*[F.lit(lang) for lang in model.languages])

    def best(values: str) -> Column:
        return F.get(names, (F.array_position(values, F.array_max(values)) - 1).cast("int"))

    result = written(
        joined.select(
            F.col("page_id").alias(id_column), "host", F.nullif("declared", F.lit("")).alias("declared"),
            best("posterior").alias("lang"), F.array_max("posterior").alias("probability"),
            best("p").alias("text_lang"),
        ),
        "languages",
    )
    delete(spark, scanned, hosts)
    return result
