"""Token ids as length-delimited binary records with checksums and an offset index.

A data file is a run of frames:

    length of the payload      8 bytes
    masked checksum of these   4 bytes
    payload                    id of the document 8 bytes, bytes per token 1 byte, tokens
    masked checksum of it      4 bytes

all little-endian. Checksums are CRC-32, rotated and shifted by a constant, so that a
checksum over data that itself holds checksums stays meaningful. Next to each data file
lies its index: for every frame its place in the file and the number of tokens before
it, 8 bytes each, so that frames can be read in any order and from any place.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfrank.llm import store
from shelfrank.llm.spark_io import named

# Fixed value: the constant of the checksum mask.
MASK_DELTA = 0xA282EAD8
NO_ID = -(1 << 63)
# Words a worker keeps while it writes a shard; forgotten when they are more, and at its end.
CACHED_WORDS = 600_000
# Unknown words that are encoded as one text.
JOINED_WORDS = 1000
READ_BYTES = 8 << 20

_MANIFEST = "shard int, data string, index string, records long, tokens long, bytes long"
_RECORD = "id long, first_token long, n_tokens long, ids binary"
_LENGTH, _SUM, _OWN = "<Q", "<I", "<qB"
_OWN_BYTES = struct.calcsize(_OWN)


def _byte_signs() -> dict[int, str]:
    """Fixed values of byte-level tokenizer files: the printable sign that byte-level tokenizers write for every byte: its own if it has
    one, else the next from 256 on."""
    own = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 173 or 174 <= b]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


BYTE_SIGNS = _byte_signs()
BLANK_SIGN = BYTE_SIGNS[32]


def masked_checksum(data: bytes) -> int:
    value = zlib.crc32(data)
    return ((value >> 15 | value << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = struct.pack(_LENGTH, len(payload))
    sums = (struct.pack(_SUM, masked_checksum(part)) for part in (head, payload))
    return b"".join((head, next(sums), payload, next(sums)))


def unframe(data: bytes, at: int) -> tuple[bytes, int]:
    """Payload of the frame at a place, and the place behind it; raises on damage."""
    head = data[at : at + 8]
    if len(head) < 8 or struct.unpack_from(_SUM, data, at + 8)[0] != masked_checksum(head):
        raise ValueError(f"damaged length at byte {at}")
    end = at + 12 + struct.unpack(_LENGTH, head)[0]
    payload = data[at + 12 : end]
    if len(data) < end + 4 or struct.unpack_from(_SUM, data, end)[0] != masked_checksum(payload):
        raise ValueError(f"damaged record at byte {at}")
    return payload, end + 4


class Encoder:
    """Token ids of whole texts with a tokenizer file.

    A byte-level tokenizer always cuts before a single space between two other
    characters, so the words of a text can be encoded on their own, each distinct one
    once. Texts with other blanks next to a space, and other kinds of tokenizers, are
    encoded as a whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        parts = json.loads(self.tokenizer.to_str())
        cutter = parts.get("pre_tokenizer") or {}
        added = parts.get("added_tokens") or []
        self.by_word = (
            cutter.get("type") == "ByteLevel"
            and not cutter.get("add_prefix_space")
            and cutter.get("use_regex", True)
            and (parts.get("model") or {}).get("type") == "BPE"
            and not parts.get("normalizer")
            and not any(t["lstrip"] or t["rstrip"] or re.search(r"\s", t["content"]) for t in added)
        )
        # By token: whether it opens with a blank.
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.opens = np.zeros(max(self.tokenizer.get_vocab().values(), default=0) + 1, dtype=bool)
        self.opens[[k for word, k in vocabulary.items() if word[:1] == BLANK_SIGN]] = True
        self.forget()

    def forget(self) -> None:
        # A word is known by itself, the first word of a text by a blank before it. Its
        # tokens are those from one of the ends to the next.
        self.known: dict[str, int] = {}
        self.ends = np.zeros(1 << 10, dtype=np.int64)
        self.tokens = np.empty(1 << 12, dtype=np.uint32)

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _behind_blanks(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of words with a blank before each, and how many each has.

        Many words make one text, as the tokenizer cuts before each blank: a token that opens
        with a blank is the first of its word, and there is no other.
        """
        texts = [" " + " ".join(words[k : k + JOINED_WORDS]) for k in range(0, len(words), JOINED_WORDS)]
        tokens, sizes = self._flat(self._whole(texts))
        firsts = np.flatnonzero(self.opens[tokens])
        # A vocabulary without a blank gives others: each word by itself.
        if len(firsts) != len(words) or firsts[:1].any():
            return self._flat(self._whole([" " + word for word in words]))
        return tokens, np.diff(firsts, append=len(tokens))

    @staticmethod
    def _flat(runs: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, runs), dtype=np.int64, count=len(runs))
        return np.fromiter(chain.from_iterable(runs), dtype=np.uint32, count=int(sizes.sum())), sizes

    def _learn(self, keys: list[str]) -> None:
        behind = [key for key in keys if key[0] != " "]
        first = [key for key in keys if key[0] == " "]
        for some, (new, sizes) in (
            (behind, self._behind_blanks(behind)),
            (first, self._flat(self._whole([key[1:] for key in first]))),
        ):
            count = len(self.known)
            ends = self.ends[count] + np.cumsum(sizes)
            while len(self.ends) <= count + len(some):
                self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
            while len(self.tokens) < self.ends[count] + len(new):
                self.tokens = np.concatenate([self.tokens, np.empty_like(self.tokens)])
            self.tokens[self.ends[count] : self.ends[count] + len(new)] = new
            self.ends[count + 1 : count + 1 + len(some)] = ends
            self.known.update(zip(some, range(count, count + len(some)), strict=True))

    @staticmethod
    def _cut_apart(key: str) -> bool:
        """Whether the tokenizer cuts before and behind a word wherever it stands."""
        word = key[1:] if key[:1] == " " else key
        return bool(word) and not word[-1].isspace() and (key[0] == " " or not word[0].isspace())

    def _places(self, keys: list[str]) -> np.ndarray:
        return np.fromiter(map(self.known.get, keys, repeat(-1)), dtype=np.int64, count=len(keys))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not self.by_word:
            return [np.array(ids, dtype=np.uint32) for ids in self._whole(texts)]
        if len(self.known) > CACHED_WORDS:
            self.forget()
        if not texts:
            return []
        # Arrow finds the distinct words; only those are looked up one by one.
        lists = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        coded = lists.flatten().dictionary_encode()
        listed = pa.ListArray.from_arrays([0, len(coded.dictionary)], coded.dictionary)
        words = pc.binary_join(listed, pa.scalar(" ", pa.large_string()))[0].as_py().split(" ")
        firsts = [" " + text.partition(" ")[0] for text in texts]
        known = self.known
        new = [key for key in words if key not in known and key and key.strip() == key]
        new += [key for key in dict.fromkeys(firsts) if key not in known and self._cut_apart(key)]
        if new:
            self._learn(new)
        starts = lists.offsets.to_numpy().astype(np.int64)
        places = self._places(words)[coded.indices.to_numpy()]
        places[starts[:-1]] = self._places(firsts)
        odd = np.flatnonzero(places < 0)
        whole = np.unique(np.searchsorted(starts, odd, side="right") - 1).tolist()
        places[odd] = 0
        low = self.ends[places]
        sizes = self.ends[places + 1] - low if len(self.known) else np.zeros_like(places)
        total = np.cumsum(sizes)
        taken = np.repeat(low - total + sizes, sizes) + np.arange(total[-1] if len(total) else 0)
        joined = self.tokens[taken]
        ends = np.concatenate([[0], total])[starts]
        found = [joined[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        for k, ids in zip(whole, self._whole([texts[k] for k in whole]), strict=True):
            found[k] = np.array(ids, dtype=np.uint32)
        return found


@cache
def encoder(path: str) -> Encoder:
    """One per Python worker, as a tokenizer file is slow to load."""
    return Encoder(path)


def _write_shard(folder: str, tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        # Every attempt writes files of its own; only those of the manifest count.
        name = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}"
        coder = data = index = None
        place = records = tokens = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if data is None:
                coder = encoder(tokenizer)
                data, index = store.create(f"{name}.rec"), store.create(f"{name}.idx")
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                texts = [text or "" for text in part.column("text").to_pylist()]
                for own, ids in zip(part.column("id").to_pylist(), coder.encode(texts), strict=True):
                    ids = np.append(ids, np.uint32(end_id))
                    width = 2 if ids.max() < 1 << 16 else 4
                    head = struct.pack(_OWN, NO_ID if own is None else own, width)
                    framed = frame(head + ids.astype(f"<u{width}").tobytes())
                    index.write(struct.pack("<QQ", place, tokens))
                    data.write(framed)
                    place, records, tokens = place + len(framed), records + 1, tokens + len(ids)
        if data is not None:
            data.close()
            index.close()
            # Workers live on, and other stages need the memory.
            coder.forget()
            row = {
                "shard": [shard], "data": [f"{name}.rec"], "index": [f"{name}.idx"],
                "records": [records], "tokens": [tokens], "bytes": [place],
            }
            batch = pa.RecordBatch.from_pydict(row)
            yield batch.set_column(0, "shard", pa.array([shard], pa.int32()))

    return run


def write_token_records(
    docs: DataFrame, folder: str, tokenizer: str, id_column: str = "doc_id",
    text_column: str = "text", end_id: int = 0,
) -> DataFrame:
    """Write whole texts as records in ascending id order; returns the manifest.

    Null texts count as empty; every document ends with `end_id`. A null id comes first
    and is kept as such; rows that repeat an id are all written. An empty table writes no
    file. The manifest, one row per shard in order, lies as Parquet under `folder`; files of
    attempts that failed are not in it and are never read.
    """
    spark = docs.sparkSession
    rows = named(docs, {"id": id_column, "text": text_column})
    rows = rows.withColumn("id", F.col("id").cast("long"))
    # The place divides rows without an id and rows that repeat one.
    placed = rows.withColumn("place", F.monotonically_increasing_id())
    ordered = placed.repartitionByRange("id", "place").sortWithinPartitions("id")
    ordered.mapInArrow(_write_shard(folder, tokenizer, end_id), _MANIFEST).write.parquet(
        f"{folder}/manifest"
    )
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")


def _read_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            low, high = row["low"], row["high"]
            index = np.frombuffer(
                store.read_range(row["index"], 16 * low, 16 * (high - low + 1)), dtype="<u8"
            ).reshape(-1, 2)
            start = int(index[0, 0])
            stop = int(index[-1, 0]) if high < row["records"] else row["bytes"]
            data = store.read_range(row["data"], start, stop - start)
            ids, firsts, sizes, values = [], [], [], []
            for place, before in index[: high - low].tolist():
                payload, _ = unframe(data, place - start)
                own, width = struct.unpack_from(_OWN, payload)
                tokens = np.frombuffer(payload, dtype=f"<u{width}", offset=_OWN_BYTES)
                ids.append(None if own == NO_ID else own)
                firsts.append(row["first_token"] + before)
                sizes.append(len(tokens))
                values.append(tokens.astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()), pa.array(firsts, pa.int64()),
                    pa.array(sizes, pa.int64()), pa.array(values, pa.binary()),
                ],
                names=["id", "first_token", "n_tokens", "ids"],
            )


def read_token_records(
    spark: SparkSession, folder: str, id_column: str = "doc_id"
) -> DataFrame:
    """Per record: id, first_token (tokens of all records before it), n_tokens and ids.

    `ids` holds unsigned little-endian 32-bit integers. Tasks read runs of frames of
    about READ_BYTES by the index, so a large file is read by many tasks. Damage raises.
    """
    manifest = read_manifest(spark, folder)
    # One row per file.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("first_token", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    parts = F.ceil(F.col("bytes") / READ_BYTES).alias("parts")
    runs = (
        files.where("records > 0")
        .withColumn("parts", parts)
        .withColumn("part", F.explode(F.expr("sequence(0L, parts - 1)")))
        .withColumn("low", F.expr("part * records div parts"))
        .withColumn("high", F.expr("(part + 1) * records div parts"))
        .where("high > low")
    )
    # One run per task at least where there are tasks enough.
    spread = runs.repartition(F.xxhash64("shard", "part"))
    return spread.mapInArrow(_read_part, _RECORD).withColumnRenamed("id", id_column)
