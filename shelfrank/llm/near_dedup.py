"""MinHash near-duplicates with an LSH forest.

Every distinct shingle set gets a long MinHash signature. A tree is an order of some of
its values, the label, and sorts the sets by it. Sets with a longest common prefix
of at least the least depth stand next to each other in that order and form a
region. The sets of a region that holds too many are read again at a greater depth, in
so many more trees that a similar pair is missed there no more often than before: dense
regions are parted finely and sparse ones are not. What is still dense at the greatest
depth is one cluster as it is. Within every other region a walk joins sets whose
signatures agree, which yields one link less than sets and never all pairs. Dense regions of
the least depth are walked too, in parts. Every set is then owned by the smallest one that the
walks join it with, and deeper regions are only kept if they hold several owners, which is
all that their walks link.

These links make clusters: whatever shares a region and looks similar.
Inside a cluster the full shingle sets decide, block against block, again as
walks: two sets end up in the same component exactly if a chain of links of the
cluster joins them. Copies of a set are represented by one document throughout.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.llm.components import components
from shelfrank.llm.hashing import flat, mixed, shingle_sets
from shelfrank.llm.spark_io import delete, free_name, named, narrow_side, sorted_groups, without, written

# Ids that rows without one get; greater than any id in use.
FIRST_NUMBER = 1 << 62
SHINGLE_WORDS = 5
PERCENT = 75
VALUES = 160
LABEL = 8
# Depth and trees of each level; a set pair of similarity 0.75 misses all trees of a level
# with a chance of at most 2e-5.
LEVELS = ((3, 20), (5, 60), (8, 240))
REGION_ROWS = 1024
# Similarity 0.75 falls below this share of the values with chance 1e-5.
LOOKS_SIMILAR = 0.60
BLOCK_ROWS = 512
BLOCK_SHINGLES = 500_000

_SKETCH = "id long, digest binary, n_shingles long, signature binary"


def _signatures(values: np.ndarray, offsets: np.ndarray, count: int) -> np.ndarray:
    """`count` MinHash values of 16 bits for each non-empty set."""
    seeds = mixed(np.arange(1, 2 * count + 1, dtype=np.uint64))
    out = np.empty((len(offsets) - 1, count), dtype="<u2")
    for k in range(count):
        hashed = (values * (seeds[2 * k] | np.uint64(1)) + seeds[2 * k + 1]) >> np.uint64(32)
        out[:, k] = np.minimum.reduceat(hashed, offsets[:-1]) & np.uint64(0xFFFF)
    return out


def _sketches(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id")
            for first, sets in shingle_sets(batch.column("text"), width):
                full = [k for k, s in enumerate(sets) if len(s)]
                signatures: list = [None] * len(sets)
                if full:
                    values, offsets = flat([sets[k] for k in full])
                    rows = _signatures(values, offsets, VALUES)
                    for k, row in zip(full, rows, strict=True):
                        signatures[k] = row.tobytes()
                digests = [
                    hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None
                    for s in sets
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, len(sets)),
                        pa.array(digests, pa.binary()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(signatures, pa.binary()),
                    ],
                    names=["id", "digest", "n_shingles", "signature"],
                )

    return run


def _labels(trees: int) -> np.ndarray:
    """The places of a signature that each tree's label takes, in order, a row per tree.

    The first trees share no value; further ones take the values in other orders.
    """
    places = np.arange(VALUES, dtype=np.uint64)
    orders = [places.astype(np.int64)]
    while len(orders) * VALUES < trees * LABEL:
        orders.append(np.argsort(mixed(places + np.uint64(len(orders) * VALUES)), kind="stable"))
    return np.concatenate(orders).reshape(-1, LABEL)[:trees]


def _prefixes(depth: int, trees: int):
    """(region, id, owner): every set once per tree, the region named by tree and label prefix."""
    labels = _labels(trees)[:, :depth]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = mixed(np.arange(1, trees + 1, dtype=np.uint64) * np.uint64(LABEL + 1) + np.uint64(depth))
        for batch in batches:
            joined = b"".join(batch.column("signature").to_pylist())
            matrix = np.frombuffer(joined, dtype="<u2").reshape(-1, VALUES)
            region = np.tile(start, (len(matrix), 1))
            for k in range(depth):
                region = mixed(region ^ (matrix[:, labels[:, k]].astype(np.uint64) + np.uint64(1)))
            ids, owners = (np.repeat(batch.column(c).to_numpy(), trees) for c in ("id", "owner"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(region.ravel().view(np.int64)), pa.array(ids), pa.array(owners)],
                names=["region", "id", "owner"],
            )

    return run


def _regions(level: DataFrame, depth: int, trees: int) -> DataFrame:
    """(region, id, owner, size), stored: the regions that hold sets of several owners."""
    rows = level.mapInArrow(_prefixes(depth, trees), "region long, id long, owner long")
    # The order of a tree puts equal prefixes together; only their number is needed here.
    sizes = rows.groupBy("region").agg(
        F.count(F.lit(1)).alias("size"), F.min("owner").alias("low"), F.max("owner").alias("high")
    )
    several = sizes.where("low != high").select("region", "size")
    return written(rows.join(several, "region"), "regions")


def _walk(size: int, near) -> list[tuple[int, int]]:
    """Links of a spanning forest: near(k, rest) tells which of `rest` are linked with k."""
    links = []
    rest = np.arange(size)
    while len(rest):
        frontier, rest = [int(rest[0])], rest[1:]
        while frontier and len(rest):
            k = frontier.pop()
            found = near(k, rest)
            reached = rest[found]
            rest = rest[~found]
            frontier.extend(reached.tolist())
            links.extend((k, other) for other in reached.tolist())
    return links


def _links(ids: np.ndarray, links: list[tuple[int, int]]) -> pa.RecordBatch:
    pairs = np.array(links, dtype=np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[pairs[:, 0]]), pa.array(ids[pairs[:, 1]])], names=["a", "b"]
    )


def _owner_links(owners: list[int], links: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(smallest owner, other owner) for all owners that links between their sets join."""
    over: dict[int, int] = {}

    def top(owner: int) -> int:
        while (above := over.get(owner, owner)) != owner:
            over[owner] = owner = over.get(above, above)
        return owner

    for a, b in links:
        low, high = sorted((top(owners[a]), top(owners[b])))
        if low != high:
            over[high] = low
    return [(top(owner), owner) for owner in over if top(owner) != owner]


def _look_alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Walk every region in the order of its label; links of owners where signatures agree."""
    needed = LOOKS_SIMILAR * VALUES
    for group in sorted_groups(batches, ["region"]):
        owners = group.column("owner").to_pylist()
        if len(owners) < 2:
            continue
        joined = b"".join(group.column("signature").to_pylist())
        matrix = np.frombuffer(joined, dtype="<u2").reshape(len(owners), -1)

        def near(k, rest, matrix=matrix):
            return np.count_nonzero(matrix[rest] == matrix[k], axis=1) >= needed

        links = _owner_links(owners, _walk(len(owners), near))
        if links:
            low, high = zip(*links, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(low, pa.int64()), pa.array(high, pa.int64())], names=["a", "b"]
            )


def _walked(regions: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b), a < b, of the walks of all regions, (region, id, owner)."""
    rows = regions.join(sets.select("id", "signature"), "id").select("region", "id", "owner", "signature")
    ordered = rows.repartition("region").sortWithinPartitions("region", "signature", "id")
    return written(ordered.mapInArrow(_look_alike, "a long, b long"), "alike")


def _in_parts(sized: DataFrame) -> DataFrame:
    """Dense regions as parts of about REGION_ROWS sets, which every tree draws anew."""
    part = F.pmod(F.xxhash64("id", "region"), F.ceil(F.col("size") / REGION_ROWS))
    return sized.withColumn("region", F.when(F.col("size") > REGION_ROWS, F.xxhash64("region", part)).otherwise(F.col("region")))


def _clusters(sets: DataFrame) -> DataFrame:
    """(node, component), stored: the clusters that the full sets decide.

    Every set is owned by the least set that the levels so far join it with, and regions of one owner
    need no walk: links between owners stand for all links of their sets. A pair of several owners
    that shares only dense regions has both its sets among those that the next level reads, so no pair is
    lost by parting. What the parts of dense regions join at the least depth is left out there.
    """
    spark = sets.sparkSession
    level = sets.select("id", "signature", F.col("id").alias("owner"))
    found, scratch = None, []
    for depth, trees in LEVELS:
        sized = _regions(level, depth, trees)
        dense = sized.where(F.col("size") > REGION_ROWS)
        walked = _in_parts(sized) if found is None else sized.where(F.col("size") <= REGION_ROWS)
        links = _walked(walked, sets)
        scratch += [sized, links]
        crowded = not dense.isEmpty()
        if crowded and depth == LEVELS[-1][0]:
            least = dense.groupBy("region").agg(F.min("owner").alias("a"))
            joined = dense.join(least, "region").select("a", F.col("owner").alias("b"))
            links = links.unionByName(joined.distinct())
        if found is None:
            found = written(components(links), "clusters")
        elif not links.isEmpty():
            scratch.append(found)
            known = found.select(F.col("component").alias("a"), F.col("node").alias("b"))
            found = written(components(known.unionByName(links)), "clusters")
        if not crowded:
            break
        rest = level.drop("owner").join(dense.select("id").distinct(), "id", "left_semi")
        owned = rest.join(found, F.col("id") == F.col("node"), "left")
        level = written(owned.select("id", "signature", F.coalesce("component", "id").alias("owner")), "level")
        scratch.append(level)
    delete(spark, *scratch)
    return found


def _shingles(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, sets in shingle_sets(batch.column("text"), width):
                own = batch.slice(first, len(sets))
                binary = pa.array([s.tobytes() for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [own.column("id"), own.column("cluster"), own.column("blocks"), binary],
                    names=["id", "cluster", "blocks", "shingles"],
                )

    return run


def _confirmed(percent: int):
    """Walk every pair of blocks; links where the full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["cluster", "low", "high"]):
            ids = group.column("id").to_numpy()
            if len(ids) < 2:
                continue
            sets = [np.frombuffer(b, np.uint64) for b in group.column("shingles").to_pylist()]
            values, offsets = flat(sets)
            vocabulary, places = np.unique(values, return_inverse=True)
            sizes = np.diff(offsets)
            mark = np.zeros(len(vocabulary), dtype=np.uint8)

            def near(k, rest, places=places, offsets=offsets, sizes=sizes, mark=mark):
                own = places[offsets[k] : offsets[k + 1]]
                mark[own] = 1
                shared = np.add.reduceat(mark[places], offsets[:-1], dtype=np.int64)[rest]
                mark[own] = 0
                return 100 * shared >= percent * (sizes[rest] + sizes[k] - shared)

            links = _walk(len(ids), near)
            if links:
                yield _links(ids, links)

    return run


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = SHINGLE_WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """Per row: id, size of its shingle set, its component and whether it stands for it.

    Words are runs of non-blank characters with A-Z as a-z; a set holds the distinct
    `width`-word shingles of the whole text, or the whole sequence of fewer words. Two
    documents are linked if 100 * intersection >= percent * union. A component is named
    by its smallest id, and only the row of that id has `kept`.

    A null or empty text has an empty set and is linked with nothing. A row without an
    id is kept, with a null component, unless its set equals that of a row with an id; then it
    has that row's component and is not kept. Rows
    that repeat an id count as one document; an empty table gives an empty result. Further columns are
    ignored. Sets are compared by 64-bit hashes of their shingles.
    """
    spark = docs.sparkSession
    texts = named(docs, {"id": id_column, "text": text_column})
    texts = texts.withColumn("id", F.col("id").cast("long"))
    sketches = written(texts.mapInArrow(_sketches(width), _SKETCH), "sketches")

    usable = F.col("digest").isNotNull() & F.col("id").isNotNull()
    # Rows of one digest have one signature: the least id brings it along.
    one = F.min(F.struct("id", "signature", "n_shingles")).alias("one")
    sets = written(sketches.where(usable).groupBy("digest").agg(one).select("digest", "one.*"), "sets")

    clusters = _clusters(sets).withColumnRenamed("component", "cluster")

    counted = clusters.join(sets.select(F.col("id").alias("node"), "n_shingles"), "node")
    sizes = counted.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("size"), F.sum("n_shingles").alias("total")
    )
    parts = F.greatest(F.col("size") / BLOCK_ROWS, F.col("total") / BLOCK_SHINGLES)
    blocks = F.ceil(parts).cast("long").alias("blocks")
    members = written(
        clusters.join(sizes, "cluster").select(F.col("node").alias("id"), "cluster", blocks), "members"
    )
    shingles = texts.join(narrow_side(members), "id").mapInArrow(
        _shingles(width), "id long, cluster long, blocks long, shingles binary"
    )
    # Every block of a cluster meets every block of it, itself included.
    own, other = F.pmod(F.xxhash64("id"), F.col("blocks")), F.col("other")
    paired = (
        shingles.withColumn("own", own)
        .withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
        .select(
            "cluster", F.least("own", other).alias("low"), F.greatest("own", other).alias("high"),
            "id", "shingles",
        )
    )
    keys = ["cluster", "low", "high"]
    links = (
        paired.repartition(*keys).sortWithinPartitions(*keys, "id")
        .mapInArrow(_confirmed(percent), "a long, b long")
    )
    found = components(links)

    stands = sets.select("digest", F.col("id").alias("class"))
    named_class = sketches.select("id", "digest", "n_shingles").join(stands, "digest", "left")
    joined = named_class.join(found, F.col("class") == F.col("node"), "left")
    component = F.coalesce("component", "class", "id")
    result = written(
        joined.select(
            F.col("id").alias(id_column),
            "n_shingles",
            component.alias("component_id"),
            F.when(F.col("id").isNull(), component.isNull()).otherwise(component == F.col("id")).alias("kept"),
        ),
        "near_duplicates",
    )
    delete(spark, sketches, sets, clusters, members)
    return result


def distinct_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One document of every group of near-duplicates, that with the smallest id, with all columns.

    Rows without an id take part too: they are numbered above all ids first, in a stored copy
    that all steps read, so that of copies without an id one stays. Rows that repeat an id count
    as one document and stay or go together.
    """
    name = free_name(docs, "near_dedup_id")
    own = F.col(f"`{id_column}`").cast("long")
    keyed = docs.withColumn(name, own)
    if not docs.where(own.isNull()).isEmpty():
        number = F.lit(FIRST_NUMBER) + F.monotonically_increasing_id()
        keyed = written(docs.withColumn(name, F.coalesce(own, number)), "numbered")
    judged = near_duplicates(keyed, name, text_column)
    return without(keyed, judged.where("not kept").select(name), name).drop(name)
