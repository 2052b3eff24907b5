"""Small invented tables for the tests of the corpus operators."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SYLLABLES = "the and on ti er es ra mo lu ke sa vin dor pel gra sto".split()
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def word(rng: random.Random) -> str:
    return "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4)))


def prose(rng: random.Random, words: int) -> str:
    return " ".join(word(rng) for _ in range(words))


def changed(rng: random.Random, text: str, share: float) -> str:
    return " ".join(word(rng) if rng.random() < share else w for w in text.split(" "))


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows of (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCUMENTS)


def edge_rows() -> list[tuple]:
    """Null and empty texts and ids, blanks only, repeats, a very long text, odd characters."""
    rng = random.Random(3)
    long_text = prose(rng, 30_000)
    same = prose(rng, 60)
    return [
        (1, None, "a"), (2, "", "b"), (3, " \t\n ", None), (4, same, "a"), (5, same, "a"),
        (5, same, "a"), (6, "two words", "b"), (7, "two words", None), (8, long_text, "a"),
        (9, "é😀 ñandú\x00  wide  double  spaces\r\n", "b"), (None, prose(rng, 40), "a"),
        (None, None, None), (10, "word " * 50, "a"), (11, long_text + " end", "b"),
    ]


def with_clashes(df: DataFrame) -> DataFrame:
    """The same table with further columns named like those that operators use inside."""
    from pyspark.sql import functions as F

    taken = {c.lower() for c in df.columns}
    names = "id size key number words cluster component row score label times at seed base vector".split()
    return df.select("*", *[F.lit(7).alias(n) for n in names if n not in taken])
