"""Near-duplicate documents: universal hash minima, banding, confirmed links, star components."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.stars import components
from millrace.llm.text import Filter, WordHashes, batch, filter_of_ids, id_hash, rolling, stored

SHINGLE, PERCENT = 5, 75
BANDS, ROWS = 32, 4  # a pair at 75 percent shares no band with a chance of 5e-6
DOUBTFUL = 70  # of 128 equal minima; a pair at 75 percent has fewer with a chance of 2e-7
FINE = 1024  # further minima, of documents that leaders have not settled
AGREEING = 769  # of those, two lowest bits equal; a pair at 75 percent has fewer with a chance of 4e-7
CHUNK = 4096
BLOCK = 4096  # members of a bucket, about, on each side of the comparisons that one key of a join holds

SKETCH = pa.schema([
    ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_a", pa.int64()), ("set_b", pa.int64()), ("minima", pa.binary()),
])
SKETCH_DDL = "doc_id long, n_shingles long, set_a long, set_b long, minima binary"
SETS_DDL = "doc_id long, shingles array<long>"


def _multipliers(size: int = BANDS * ROWS, seed: int = 20240229) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and addends of the multiply-shift family; a universal family of hashes to 32 bits."""
    draw = np.random.default_rng(seed)
    a = draw.integers(1, 2**63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a[:, None], draw.integers(0, 2**63, size, dtype=np.uint64)[:, None]


def shingle_set(text: bytes | None, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles: words after lower-casing A-Z, five at a time, or all if fewer."""
    items = (text or b"").lower().split()
    if not items:
        return np.empty(0, np.uint64)
    return np.unique(rolling(hashes(items), min(SHINGLE, len(items))) + np.uint64(min(SHINGLE, len(items))))


def minima(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    least = np.full(len(a), 2**32 - 1, np.uint32)
    for at in range(0, len(shingles), CHUNK):
        values = (a * shingles[None, at : at + CHUNK] + b) >> np.uint64(32)
        np.minimum(least, values.min(axis=1).astype(np.uint32), out=least)
    return least


def low_bits(least: np.ndarray) -> list[int]:
    """The two lowest bits of each minimum, 32 to a number: a digest that pairs are sifted by."""
    fields = (least.astype(np.uint64) & np.uint64(3)).reshape(-1, 32) << (np.arange(32, dtype=np.uint64) * np.uint64(2))
    return np.bitwise_or.reduce(fields, axis=1).view(np.int64).tolist()


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes, (a, b) = WordHashes(), _multipliers()
    for rows in batches:
        ids, sizes, first, second, least = rows.column(0).to_pylist(), [], [], [], []
        for text in rows.column(1).to_pylist():
            s = shingle_set(text, hashes)
            sizes.append(len(s))
            with np.errstate(over="ignore"):
                first.append(int(s.sum(dtype=np.uint64).view(np.int64)) if len(s) else None)
                second.append(int((s * s * np.uint64(0x9E3779B97F4A7C15) ^ (s >> np.uint64(7))).sum(dtype=np.uint64).view(np.int64)) if len(s) else None)
            least.append(minima(s, a, b).tobytes() if len(s) else None)
        yield batch(SKETCH, doc_id=ids, n_shingles=sizes, set_a=first, set_b=second, minima=least)


def _sets(needed):
    """Sets of the documents that the filter ``needed`` holds; a false hit is a set that no pair asks for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held = WordHashes(), Filter(needed.value)
        schema = pa.schema([("doc_id", pa.int64()), ("shingles", pa.list_(pa.int64()))])
        for rows in batches:
            rows = rows.filter(pa.array(held(id_hash(rows.column(0).to_numpy(zero_copy_only=False)))))
            found = [shingle_set(t, hashes).view(np.int64) for t in rows.column(1).to_pylist()]
            yield batch(schema, doc_id=rows.column(0).to_pylist(), shingles=found)

    return run


def _fine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a, b = _multipliers(FINE, 20240301)
    schema = pa.schema([("node", pa.int64()), ("bits", pa.list_(pa.int64()))])
    for rows in batches:
        with np.errstate(over="ignore"):
            found = [low_bits(minima(np.asarray(s, np.int64).view(np.uint64), a, b)) for s in rows.column(1).to_pylist()]
        yield batch(schema, node=rows.column(0).to_pylist(), bits=found)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))


def sketches(docs: DataFrame) -> DataFrame:
    """Set size, two sums that name the set, and the minima of every document."""
    return _texts(docs).mapInArrow(_sketches, SKETCH_DDL)


def _band_keys(least: Column) -> Column:
    width = 4 * ROWS
    return F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(i, F.substring(least, i * width + 1, F.lit(width)))
    )


def _close(left: Column, right: Column) -> Column:
    """At least ``DOUBTFUL`` equal minima."""
    same = F.aggregate(
        F.sequence(F.lit(0), F.lit(BANDS * ROWS - 1)), F.lit(0),
        lambda n, i: n + (F.substring(left, i * 4 + 1, F.lit(4)) == F.substring(right, i * 4 + 1, F.lit(4))).cast("int"),
    )
    return same >= DOUBTFUL


def _side(table: DataFrame, key: str, value: str, name: str) -> DataFrame:
    return table.select(F.col("doc_id").alias(key), F.col(value).alias(name))


def _likely(pairs: DataFrame, least: DataFrame) -> DataFrame:
    """The pairs (u, v) that the minima leave in doubt or better."""
    both = pairs.join(_side(least, "u", "minima", "m1"), "u").join(_side(least, "v", "minima", "m2"), "v")
    return both.where(_close(F.col("m1"), F.col("m2"))).select("u", "v")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) that the full sets confirm."""
    whole = pairs.join(_side(sets, "u", "shingles", "s1"), "u").join(_side(sets, "v", "shingles", "s2"), "v")
    shared = F.size(F.array_intersect("s1", "s2"))
    return whole.where(100 * shared >= PERCENT * (F.size("s1") + F.size("s2") - shared)).select("u", "v")


def _star_pairs(bands: DataFrame, leader: Column) -> DataFrame:
    """Each member of a bucket with the bucket's leader: as many pairs as members."""
    leaders = stored(bands.groupBy("key").agg(leader.alias("leader")), "leaders")
    pairs = bands.join(leaders, "key").where("node <> leader")
    return pairs.select(F.least("node", "leader").alias("u"), F.greatest("node", "leader").alias("v")).distinct()


def _central(bands: DataFrame) -> DataFrame:
    """``bands`` with ``weight``: the members of all buckets of a node, most for what others were copied from."""
    weights = bands.groupBy("node").agg(F.sum("n").alias("weight"))
    return stored(bands.join(weights, "node"), "bands")


def _agreeing() -> Column:
    """How many of the fine minima of sides u and v agree in their two lowest bits; long columns keep the generated code short."""
    def differing(k: int) -> Column:
        x = F.col(f"bits{k}_u").bitwiseXOR(F.col(f"bits{k}_v"))
        return F.bit_count(x.bitwiseOR(F.shiftright(x, 1)).bitwiseAND(F.lit(0x5555555555555555)))

    return F.lit(FINE) - reduce(lambda n, k: n + differing(k), range(1, FINE // 32), differing(0))


def _blocks(count: str) -> Column:
    return F.ceil(F.col(count) / BLOCK)


def _block_keys(mine: Column, theirs: Column, placed: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """One key per block of the other side: a node's block, by a hash of its id, meets each of ``theirs``."""
    block = F.pmod(F.xxhash64("node"), mine)
    return F.explode(F.transform(F.sequence(F.lit(0).cast("long"), theirs - 1), lambda each: F.xxhash64("key", *placed(block, each))))


def _open_pairs(bands: DataFrame, of: DataFrame, tested: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """Untested pairs in a bucket whose members still lie in different components.

    One of such a pair lies outside the bucket's main component, so only those members are compared
    with the rest, whatever their number; a crowded bucket is compared block by block. Only pairs whose
    sizes and digests agree leave the join, each from the first band that it shares.
    """
    rows = bands.select("key", "node", "band").join(of, "node", "left").withColumn("root", F.coalesce("root", "node"))
    roots = rows.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    mixed = roots.groupBy("key").agg(F.count(F.lit(1)).alias("roots"), F.max(F.struct("n", "root")).alias("main"), F.sum("n").alias("n"))
    mixed = mixed.where("roots > 1").select("key", F.col("main.root").alias("main"), (F.col("n") - F.col("main.n")).alias("others"), "n")
    rows = stored(rows.join(stored(mixed, "mixed"), "key"), "open")
    tags = F.transform(_band_keys(F.col("minima")), lambda k: F.hash(k))
    nodes = rows.select(F.col("node").alias("doc_id")).distinct()
    fine = stored(sets.join(nodes, "doc_id", "left_semi").dropDuplicates(["doc_id"]).mapInArrow(_fine, "node long, bits array<long>"), "fine")
    members = rows.join(classes.select("node", "n_shingles", tags.alias("tags")).join(fine, "node"), "node")
    own, other = _blocks("others"), _blocks("n")
    outside = members.where("root <> main").withColumn("key", _block_keys(own, other, lambda mine, each: (mine, each)))
    members = members.withColumn("key", _block_keys(other, own, lambda mine, each: (each, mine)))
    digest = [F.coalesce(F.get("bits", F.lit(k)), F.lit(0).cast("long")).alias(f"bits{k}") for k in range(FINE // 32)]
    plain = [F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in ("node", "root", "main", "n_shingles")]
    sides = [
        table.select("key", "band", "tags", *plain, *digest).toDF(*[f"{c}_{x}" for c in ("key", "band", "tags", "node", "root", "main", "n_shingles", *[f"bits{k}" for k in range(FINE // 32)])])
        for x, table in (("u", outside), ("v", members))
    ]
    near = (
        (F.col("root_u") != F.col("root_v")) & ((F.col("root_v") == F.col("main_v")) | (F.col("node_u") < F.col("node_v")))
        & (100 * F.least("n_shingles_u", "n_shingles_v") >= PERCENT * F.greatest("n_shingles_u", "n_shingles_v"))
        & (_agreeing() >= AGREEING)
        & (F.col("band_u") == F.col("band_v"))
        & ~F.arrays_overlap(F.slice("tags_u", F.lit(1), F.col("band_u")), F.slice("tags_v", F.lit(1), F.col("band_v")))
    )
    pairs = sides[0].join(sides[1], (F.col("key_u") == F.col("key_v")) & near)
    pairs = pairs.select(F.least("node_u", "node_v").alias("u"), F.greatest("node_u", "node_v").alias("v")).distinct()
    return pairs.join(tested, ["u", "v"], "left_anti")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs``.

    Equal sets form one class, whose least id stands for it. Classes that share a band are paired
    with the least member of the bucket and with its most central one; after the components of those
    links, only pairs that lie in different components are left, and all of them are tested.
    Links are confirmed on the full sets, as 64-bit hashes of their shingles.

    A text without words has no shingles and is its own component; so is a row without id, whose
    component is null and which is kept. Rows that share an id are one document: what one of them
    links, links the other. An empty table gives no rows.
    """
    sketch = stored(sketches(docs), "sketches")
    classes = stored(
        sketch.where("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("node"), F.first("minima").alias("minima")),
        "classes",
    )
    least = classes.select(F.col("node").alias("doc_id"), "minima").dropDuplicates(["doc_id"])
    bands = classes.select("node", F.posexplode(_band_keys(F.col("minima"))).alias("band", "key"))
    shared = bands.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("b"), F.count(F.lit(1)).alias("n")).where("a < b")
    shared = stored(shared.select("key", "n"), "shared")  # as files, so that a crowded bucket can be split in the join
    bands = _central(stored(bands.join(shared, "key").select("key", "node", "band", "n"), "bands"))
    needed = filter_of_ids(bands.select("node"))
    sets = stored(_texts(docs).where("doc_id IS NOT NULL").mapInArrow(_sets(needed), SETS_DDL), "sets")
    central = F.max(F.struct("weight", "node"))["node"]
    tested = stored(_star_pairs(bands, F.min("node")).union(_star_pairs(bands, central)).distinct(), "pairs")
    links = stored(_confirmed(_likely(tested, least), sets), "links")
    key = ["set_a", "set_b", "n_shingles"]
    several = sketch.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min("set_a").alias("low"), F.max("set_a").alias("high")
    ).where("low < high")
    shared_ids = sketch.join(several.select("doc_id"), "doc_id", "left_semi").join(classes.select(*key, "node"), key)
    links = links.union(shared_ids.where("doc_id <> node").select(F.col("doc_id").alias("u"), F.col("node").alias("v")).distinct())
    of = stored(components(links), "components")
    more = stored(_open_pairs(bands, of, tested, classes.dropDuplicates(["node"]), sets), "pairs")
    rest = stored(_confirmed(more, sets), "links")
    roots = components(links.union(rest)).select("node", "root")
    of_class = stored(
        classes.select(*key, "node").join(roots, "node", "left").select(*key, F.coalesce("root", "node").alias("root")), "roots"
    )
    root = F.coalesce("root", "doc_id")
    return sketch.select("doc_id", *key).join(of_class, key, "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), root).alias("component_id"),
        F.coalesce(root == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, columns unchanged, whose document is the first of its component."""
    dropped = near_duplicates(docs).where("NOT kept").select(F.col("doc_id").alias("_dropped")).distinct()
    return docs.join(dropped, docs["doc_id"] == dropped["_dropped"], "left_anti")
