"""Tokens of two tokenizers laid over each other, and how often each pair of them overlaps.

Both tokenizers cut the same bytes. Where tokens of both end, a group ends; two tokens are
linked where their bytes overlap. How often a pair is linked in the whole corpus is counted
externally:

1. A task collects (pair, document) records. When its buffer is full they are sorted, equal
   ones are counted, and they are spilled as one run, cut by a radix of the second side's
   id into blocks of zstd-compressed differences. Next to the records a block holds only its
   pairs with their sums.
2. The pair sums of all runs of a radix are merged by a heap of runs, at most FAN_IN at a
   time. The order is by second side, then first side, so all partners of a token come
   together and its greatest count is known when the next token begins.
3. The records of each run are read again, radix by radix, next to the merged counts, and
   what they contribute to a document is summed. Records never leave their run: no token
   and no pair, however frequent, is gathered in a task.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import re
import struct
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.llm import store
from shelfrank.llm.spark_io import delete, named, written
from shelfrank.llm.token_records import BYTE_SIGNS
from shelfrank.session import delete_scratch, scratch_path

RADIXES = 64
SPILL_RECORDS = 2_000_000
FAN_IN = 256
CACHED_CELLS = 250_000
CACHED_CHARACTERS = 1 << 24
BATCH_DOCUMENTS = 256

# A record in one number: second side's id by radix, first side's id, place of the document.
ID_BITS, PLACE_BITS = 20, 24
_U = np.uint64
_PLACES = _U((1 << PLACE_BITS) - 1)
_IDS = (1 << ID_BITS) - 1

# Fixed value: the sign that piece tokenizers write for a blank.
PIECE_BLANK = "▁"
# Both kinds of tokenizers cut before a single blank that follows one of these.
_CELL_END = r"[\w!-~]"
_CUT = re.compile(rf"(?<={_CELL_END}) ")
_ODD_BLANK = re.compile(r"(?:^|[^\w!-~]) ")

_OUT = (
    "id long, run string, place int, n_a long, n_b long, n_groups long, n_links long, "
    "groups_sha256 string, radix int, sums binary, records binary"
)
_ARROW_OUT = pa.schema(
    [("id", pa.int64()), ("run", pa.string()), ("place", pa.int32())]
    + [(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")]
    + [("groups_sha256", pa.string()), ("radix", pa.int32()), ("sums", pa.binary()), ("records", pa.binary())]
)
_SUMS = "run string, radix int, sums binary"
_SHARE = "run string, place int, n_best long, count_sum long"


def _packed(values: np.ndarray) -> bytes:
    """Numbers of eight bytes, compressed with bytes of the same weight side by side."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<u8").ravel()


def pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending keys as differences, and a count of each."""
    first = _packed(np.diff(keys, prepend=_U(0)))
    return struct.pack("<Q", len(first)) + first + _packed(counts)


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    end = 8 + struct.unpack_from("<Q", data)[0]
    return np.cumsum(_unpacked(data[8:end]), dtype=_U), _unpacked(data[end:])


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ascending keys with the sums of their counts."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[starts], np.add.reduceat(counts, starts)


class Tokenizers:
    """Both tokenizers, with the bytes of all their tokens.

    The first is a byte-level file of the tokenizers library and is given a blank and the
    text; the second is a sentencepiece model, which adds the blank itself.
    """

    def __init__(self, first: str, second: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_file(first)
        self.first.encode_special_tokens = True
        self.second = SentencePieceProcessor(model_file=second)
        signs = {sign: byte for byte, sign in BYTE_SIGNS.items()}
        self.bytes_a = [b""] * self.first.get_vocab_size()
        for token, own in self.first.get_vocab().items():
            known = all(c in signs for c in token)
            self.bytes_a[own] = bytes(signs[c] for c in token) if known else token.encode()
        pieces = [self.second.id_to_piece(k) for k in range(self.second.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.second.is_byte(k) else p.replace(PIECE_BLANK, " ").encode()
            for k, p in enumerate(pieces)
        ]
        if max(len(self.bytes_a), len(self.bytes_b)) > _IDS - RADIXES:
            raise ValueError(f"a vocabulary has more than {_IDS - RADIXES} entries")
        self.trailing = [self.second.piece_to_id(PIECE_BLANK)]
        # Pieces that go on over a blank would need texts whole.
        self.by_cell = not any(re.search(rf"[^{PIECE_BLANK}]{PIECE_BLANK}", p) for p in pieces)

    def cells(self, text: str) -> list[str]:
        """The text cut where both tokenizers cut whatever stands around; each cell has lost
        the blank before it."""
        if not self.by_cell:
            return [text]
        return _CUT.split(text) if _ODD_BLANK.search(text) else text.split(" ")

    def encoded(self, cells: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        a = self.first.encode_batch_fast([" " + cell for cell in cells], add_special_tokens=False)
        b = self.second.encode(cells, num_threads=1)
        return [one.ids for one in a], [ids if cell else self.trailing for cell, ids in zip(cells, b, strict=True)]

    def lossy(self, cells: list[str], a: list[list[int]], b: list[list[int]]) -> list[int]:
        """Places of cells that the tokens of either side do not give back byte for byte."""

        def joined(of: list[bytes], ids: Iterable[int]) -> bytes:
            return b"".join(map(of.__getitem__, ids))

        want = [(" " + cell).encode() for cell in cells]
        sides = ((self.bytes_a, a), (self.bytes_b, b))
        if all(joined(of, chain.from_iterable(ids)) == b"".join(want) for of, ids in sides):
            return []
        return [k for k, own in enumerate(want) if any(joined(of, ids[k]) != own for of, ids in sides)]


@cache
def tokenizers(first: str, second: str) -> Tokenizers:
    return Tokenizers(first, second)


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All numbers in a row, and how many each list holds."""
    sizes = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
    return np.fromiter(chain.from_iterable(lists), dtype=np.int64, count=int(sizes.sum())), sizes


def _per_cell(ends: np.ndarray, cell_ends: np.ndarray) -> np.ndarray:
    """How many of the ascending ends lie in each cell."""
    return np.diff(np.searchsorted(ends, cell_ends, side="right"), prepend=0)


class Aligner:
    """Aligns texts cell by cell; each distinct cell is encoded once until the cache is full."""

    def __init__(self, both: Tokenizers):
        self.both = both
        self.length_a, self.length_b = (np.array(list(map(len, x))) for x in (both.bytes_a, both.bytes_b))
        self.rows = -(-len(both.bytes_b) // RADIXES)
        self.b_end = 2 * len(both.bytes_a)
        # Every token as text: within or at the end of its side of a group, of a cell.
        kinds = ((both.bytes_a, ",|"), (both.bytes_b, ",;\n"))
        self.written = [f"{k}{end}" for of, ends in kinds for end in ends for k in range(len(of))]
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.characters = 0
        self.listed: list[str] = []
        # Per cell: tokens of either side, groups, links, whether the bytes are not the text's.
        self.sizes = np.zeros((1 << 10, 5), dtype=np.int64)
        self.ends = np.zeros(1 << 10, dtype=np.int64)
        self.links = np.empty(1 << 12, dtype=_U)

    def _laid_over(self, a: list[list[int]], b: list[list[int]]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """(tokens of either side, groups and links of each cell; keys of all links; groups as text).

        All cells lie end to end, so that an end of a token is a place in their bytes. Every
        stretch between neighbouring ends of either side belongs to one token of each: a link.
        """
        (flat_a, size_a), (flat_b, size_b) = _flat(a), _flat(b)
        ends_a, ends_b = np.cumsum(self.length_a[flat_a]), np.cumsum(self.length_b[flat_b])
        cell_ends = ends_a[np.cumsum(size_a) - 1]
        both, group_ends = np.union1d(ends_a, ends_b), np.intersect1d(ends_a, ends_b, assume_unique=True)
        own_a, own_b = flat_a[np.searchsorted(ends_a, both)], flat_b[np.searchsorted(ends_b, both)]
        order = own_b % RADIXES * self.rows + own_b // RADIXES
        keys = (order << ID_BITS | own_a).astype(_U) << _U(PLACE_BITS)
        groups, links = _per_cell(group_ends, cell_ends), _per_cell(both, cell_ends)
        # A group is written as its tokens of one side, then those of the other.
        group_a, group_b = np.searchsorted(group_ends, ends_a), np.searchsorted(group_ends, ends_b)
        last_a, last_b = ends_a == group_ends[group_a], ends_b == group_ends[group_b]
        codes = np.empty(len(flat_a) + len(flat_b), dtype=np.int64)
        before_b = np.searchsorted(group_b, group_a, side="left")
        before_a = np.searchsorted(group_a, group_b, side="right")
        codes[np.arange(len(flat_a)) + before_b] = flat_a + last_a * len(self.length_a)
        in_cell = np.isin(ends_b, cell_ends, assume_unique=True)
        codes[np.arange(len(flat_b)) + before_a] = (
            self.b_end + flat_b + (last_b.astype(np.int64) + in_cell) * len(self.length_b)
        )
        text = "".join(map(self.written.__getitem__, codes.tolist()))
        return np.stack([size_a, size_b, groups, links], axis=1), keys, text.split("\n")[:-1]

    def _learn(self, cells: list[str]) -> None:
        count, place = len(self.listed), int(self.ends[len(self.listed)])
        a, b = self.both.encoded(cells)
        sizes, listed = np.zeros((len(cells), 5), dtype=np.int64), np.full(len(cells), "", dtype=object)
        lossy = self.both.lossy(cells, a, b)
        sizes[lossy, 4] = 1
        good = np.flatnonzero(sizes[:, 4] == 0)
        keys = np.empty(0, dtype=_U)
        if len(good):
            laid = self._laid_over([a[k] for k in good], [b[k] for k in good])
            sizes[good, :4], keys, listed[good] = laid
        self.listed += listed.tolist()
        ends = place + np.cumsum(sizes[:, 3])
        while len(self.ends) <= len(self.listed):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
            self.sizes = np.concatenate([self.sizes, np.zeros_like(self.sizes)])
        while len(self.links) < place + len(keys):
            self.links = np.concatenate([self.links, np.empty_like(self.links)])
        self.links[place : place + len(keys)] = keys
        self.ends[count + 1 : count + 1 + len(cells)] = ends
        self.sizes[count : count + len(cells)] = sizes
        self.known.update(zip(cells, range(count, count + len(cells)), strict=True))
        self.characters += sum(map(len, cells))

    def align(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """(sizes of each text, its groups as text, links of all texts, links of each text)"""
        if len(self.listed) > CACHED_CELLS or self.characters > CACHED_CHARACTERS:
            self._forget()
        cells = [self.both.cells(text) if text else [] for text in texts]
        flat = list(chain.from_iterable(cells))
        unknown = [cell for cell in dict.fromkeys(flat) if cell not in self.known]
        if unknown:
            self._learn(unknown)
        places = np.fromiter(map(self.known.__getitem__, flat), dtype=np.int64, count=len(flat))
        bounds = np.concatenate([[0], np.cumsum(np.fromiter(map(len, cells), dtype=np.int64, count=len(cells)))])
        running = np.zeros((len(flat) + 1, 5), dtype=np.int64)
        np.cumsum(self.sizes[places], axis=0, out=running[1:])
        sizes = running[bounds[1:]] - running[bounds[:-1]]
        bad = sizes[:, 4] > 0
        sizes[bad] = 0
        order = places.tolist()
        groups = [
            "" if skip else ";".join(map(self.listed.__getitem__, order[low:high]))
            for skip, low, high in zip(bad.tolist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
        ]
        places = places[np.repeat(~bad, np.diff(bounds))]
        low, count = self.ends[places], self.ends[places + 1] - self.ends[places]
        total = np.cumsum(count)
        taken = np.repeat(low - total + count, count) + np.arange(total[-1] if len(total) else 0)
        return sizes[:, :4], groups, self.links[taken], sizes[:, 3]


def _blocks(run: str, records: np.ndarray, rows: int) -> Iterator[dict]:
    """The records of a full buffer as one sorted run: a row for every radix that occurs."""
    records.sort()
    keys, counts = _summed(records, np.ones(len(records), dtype=_U))
    pairs, sums = _summed(keys >> _U(PLACE_BITS), counts)
    edges = np.arange(RADIXES + 1, dtype=_U) * _U(rows << ID_BITS)
    at_pair, at_key = np.searchsorted(pairs, edges), np.searchsorted(keys, edges << _U(PLACE_BITS))
    for radix in np.flatnonzero(np.diff(at_pair)).tolist():
        own, wide = slice(*at_pair[radix : radix + 2]), slice(*at_key[radix : radix + 2])
        yield {
            "run": run,
            "radix": radix,
            "sums": pack(pairs[own], sums[own]),
            "records": pack(keys[wide], counts[wide]),
        }


def _encode(first: str, second: str, spill: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(tokenizers(first, second))
        name, place, held, size = uuid.uuid4().hex, 0, [], 0

        def spilled() -> Iterator[pa.RecordBatch]:
            if size:
                for block in _blocks(name, np.concatenate(held), aligner.rows):
                    yield pa.RecordBatch.from_pylist([block], schema=_ARROW_OUT)

        for batch in batches:
            for low in range(0, batch.num_rows, BATCH_DOCUMENTS):
                part = batch.slice(low, BATCH_DOCUMENTS)
                texts = [text or "" for text in part.column("text").to_pylist()]
                sizes, groups, links, per_text = aligner.align(texts)
                places = np.arange(place, place + len(texts))
                held.append(links | np.repeat(places, per_text).astype(_U))
                size += len(links)
                own = dict(zip(("n_a", "n_b", "n_groups", "n_links"), map(pa.array, sizes.T), strict=True))
                digests = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
                own |= {
                    "id": part.column("id"),
                    "run": pa.array([name] * len(texts)),
                    "place": pa.array(places, pa.int32()),
                    "groups_sha256": pa.array(digests, pa.string()),
                }
                yield pa.RecordBatch.from_arrays(
                    [own.get(f.name, pa.nulls(len(texts), f.type)) for f in _ARROW_OUT], schema=_ARROW_OUT
                )
                place += len(texts)
                if size >= spill or place > int(_PLACES) - BATCH_DOCUMENTS:
                    yield from spilled()
                    name, place, held, size = uuid.uuid4().hex, 0, [], 0
        yield from spilled()

    return run


def _opened(data: bytes) -> Iterator[tuple[int, int]]:
    keys, counts = unpack(data)
    for low in range(0, len(keys), 1024):
        yield from zip(keys[low : low + 1024].tolist(), counts[low : low + 1024].tolist(), strict=True)


def _merged(runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One run of the pair sums of several, from a heap of their first pairs."""
    keys, counts = [], []
    last = None
    for key, count in heapq.merge(*map(_opened, runs)):
        if key == last:
            counts[-1] += count
        else:
            keys.append(key)
            counts.append(count)
            last = key
    return np.array(keys, dtype=_U), np.array(counts, dtype=_U)


def _merge(table: pa.Table) -> pa.Table:
    row = {
        "run": [uuid.uuid4().hex],
        "radix": table.column("radix").slice(0, 1).combine_chunks(),
        "sums": [pack(*_merged(table.column("sums").to_pylist()))],
    }
    return pa.table(row, schema=pa.schema([("run", pa.string()), ("radix", pa.int32()), ("sums", pa.binary())]))


def _best(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For every pair whether no other pair of its second side is linked more often."""
    side = keys >> _U(ID_BITS)
    starts = np.flatnonzero(np.concatenate([[True], side[1:] != side[:-1]]))
    top = np.maximum.reduceat(counts, starts)
    return counts == np.repeat(top, np.diff(np.append(starts, len(side))))


def _finish(folder: str):
    """Merge the last runs of a radix into a file of pairs, counts and best marks."""

    def run(table: pa.Table) -> pa.Table:
        keys, counts = _merged(table.column("sums").to_pylist())
        path = f"{folder}/pairs-{uuid.uuid4().hex}"
        packed = pack(keys, counts)
        with store.create(path) as file:
            file.write(struct.pack("<Q", len(packed)) + packed + _packed(_best(keys, counts).astype(_U)))
        radix = table.column("radix").slice(0, 1).combine_chunks()
        return pa.table({"radix": radix, "path": pa.array([path], pa.string())})

    return run


def _counted(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    system, name = store.located(path)
    with system.open_input_stream(name, compression=None) as file:
        data = file.read()
    end = 8 + struct.unpack_from("<Q", data)[0]
    return *unpack(data[8:end]), _unpacked(data[end:]).astype(bool)


def _contribute(paths: dict[int, str]):
    """What the counted pairs add to each document, from blocks in the order of radixes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        at = -1
        for batch in batches:
            for name, radix, records in zip(*(batch.column(c) for c in ("run", "radix", "records")), strict=True):
                if radix.as_py() != at:
                    at = radix.as_py()
                    pairs, counts, best = _counted(paths[at])
                keys, times = unpack(records.as_py())
                places, times = (keys & _PLACES).astype(np.int64), times.astype(np.int64)
                found = np.searchsorted(pairs, keys >> _U(PLACE_BITS))
                own = sums.setdefault(name.as_py(), np.zeros((0, 2), dtype=np.int64))
                if len(own) <= places.max():
                    more = np.zeros((int(places.max()) + 1 - len(own), 2), dtype=np.int64)
                    own = sums[name.as_py()] = np.concatenate([own, more])
                np.add.at(own[:, 0], places, np.where(best[found], times, 0))
                np.add.at(own[:, 1], places, counts[found].astype(np.int64) * times)
        for name, own in sums.items():
            place = np.flatnonzero(own[:, 1])
            yield pa.RecordBatch.from_pydict(
                {
                    "run": pa.array([name] * len(place), pa.string()),
                    "place": pa.array(place, pa.int32()),
                    "n_best": pa.array(own[place, 0]),
                    "count_sum": pa.array(own[place, 1]),
                }
            )

    return run


def _listed(rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                keys, counts, best = _counted(path)
                order = (keys >> _U(ID_BITS)).astype(np.int64)
                columns = {
                    "a": (keys & _U(_IDS)).astype(np.int64),
                    "b": order % rows * RADIXES + order // rows,
                    "links": counts.astype(np.int64),
                    "best": best,
                }
                yield pa.RecordBatch.from_pydict(columns)

    return run


@dataclass(frozen=True)
class Alignment:
    """`documents`: counts and groups of each; `pairs`: a, b, links in the corpus and whether
    no other first side is linked more often to that second side."""

    documents: DataFrame
    pairs: DataFrame


def align(
    docs: DataFrame,
    first: str,
    second: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    spill_records: int = SPILL_RECORDS,
    fan_in: int = FAN_IN,
) -> Alignment:
    """Align the tokens of two tokenizers in every whole text and count their pairs.

    `first` is the file of a byte-level tokenizer, `second` a sentencepiece model; both must
    lie at these paths on all machines. Per document: doc_id, n_a, n_b, n_groups, n_links,
    n_best (links whose pair is linked more often than, or as often as, any other pair of
    its second side), count_sum (counts of the pairs of all links) and groups_sha256. Texts
    that are null or empty, or whose tokens do not give back the text's bytes, have no tokens:
    zeros and an empty digest. Every row is aligned on its own, also where ids are null or
    repeated; an empty table gives empty results; other columns are not read.

    A task holds one buffer of `spill_records` links, or the links of BATCH_DOCUMENTS texts
    if these are more, and the pairs of one radix.
    """
    spark = docs.sparkSession
    texts = named(docs, {"id": id_column, "text": text_column})
    texts = texts.select(F.col("id").cast("long").alias("id"), "text")
    encoded = written(texts.mapInArrow(_encode(first, second, spill_records), _OUT), "aligned")
    rows = -(-len(tokenizers(first, second).bytes_b) // RADIXES)

    blocks = encoded.where("radix is not null")
    sums, scratch = blocks.select("run", "radix", "sums"), [encoded]
    runs = blocks.select("run").distinct().count()
    while runs > fan_in:
        runs = -(-runs // fan_in)
        part = F.pmod(F.xxhash64("run"), F.lit(runs)).alias("part")
        sums = written(sums.groupBy("radix", part).applyInArrow(_merge, _SUMS), "sums")
        scratch.append(sums)
    folder = scratch_path(spark, "pairs")
    files = written(sums.groupBy("radix").applyInArrow(_finish(folder), "radix int, path string"), "pair_files")
    # A row per radix: at most RADIXES.
    paths = {row["radix"]: row["path"] for row in files.collect()}

    ordered = blocks.select("run", "radix", "records").sortWithinPartitions("radix", "run")
    shares = ordered.mapInArrow(_contribute(paths), _SHARE)
    shares = shares.groupBy("run", "place").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    documents = encoded.where("radix is null").join(shares, ["run", "place"], "left")
    result = written(
        documents.select(
            F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links",
            *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")],
            "groups_sha256",
        ),
        "alignment",
    )
    pairs = written(files.mapInArrow(_listed(rows), "a long, b long, links long, best boolean"), "pairs")
    delete(spark, *scratch, files)
    delete_scratch(spark, folder)
    return Alignment(result, pairs)
