"""What the text operators share: words, working tables, batches in tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import fresh_path

SPACES = " \t\n\u000b\f\r"  # \x20 and \x09 to \x0D
SPACE_RUN = "[ \\t-\\r]+"


def documents(spark: SparkSession, folder: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def words(text: Column) -> Column:
    """Array of the maximal runs of characters other than \\x20 and \\x09-\\x0D; null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), "")


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves ``part``; a row without id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


_WORKING: dict[str, list[str]] = {}  # application: folders of its working tables


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back, so that later steps start from files."""
    path = fresh_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    _WORKING.setdefault(df.sparkSession.sparkContext.applicationId, []).append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(docs: DataFrame) -> None:
    """Delete the working tables of steps before ``docs``, which has been written; what ``docs`` itself reads stays."""
    spark = docs.sparkSession
    tables = _WORKING.get(spark.sparkContext.applicationId, [])
    read, kept = docs.inputFiles(), []
    for path in tables:
        name = path.rsplit("/", 1)[-1]
        if any(f"/{name}/" in f for f in read):
            kept.append(path)
            continue
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    tables[:] = kept


def small_batches(spark: SparkSession) -> None:
    """Arrow batches for whole texts: some hundred rows and some megabytes at a time, however long the texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    arrays = [pa.array(columns[f.name], type=f.type) for f in schema]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


class WordHashes:
    """64-bit hashes of words; remembers a bounded number of them."""

    def __init__(self, seed: int = 0, limit: int = 1_000_000):
        self.seed, self.limit, self.known = seed, limit, {}

    def __call__(self, items: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > self.limit:
            known.clear()
        seed, digest = self.seed, xxhash.xxh64_intdigest
        for w in set(items).difference(known):
            known[w] = digest(w, seed)
        return np.fromiter(map(known.__getitem__, items), np.uint64, len(items))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (finaliser of xxhash)."""
    h = h.copy()
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x165667B19E3779F9)
    h ^= h >> np.uint64(32)
    return h


def rolling(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive word hashes, in O(log size) passes."""
    out, have = None, 0
    power, width = h, 1
    rest = size
    while rest:
        if rest & 1:
            if out is None:
                out, have = power, width
            else:
                n = len(h) - have - width + 1
                out = mixed(out[:n] * np.uint64(0x9E3779B185EBCA87) + power[have : have + n] + np.uint64(have))
                have += width
        rest >>= 1
        if rest:
            n = len(power) - width
            if n <= 0:
                return np.empty(0, np.uint64)
            power = mixed(power[:n] * np.uint64(0x9E3779B185EBCA87) + power[width:] + np.uint64(width))
            width *= 2
    return out if len(h) >= size else np.empty(0, np.uint64)


FILTER_BITS = 1 << 27  # of a filter, whatever the number of keys
CHUNK_BITS = 1 << 15  # of one row of Spark's bitmaps


class Filter:
    """A Bloom filter of fixed size over 64-bit hashes: what it lacks is surely not a key."""

    def __init__(self, bits: bytes):
        self.plain, self.bits = bits, np.frombuffer(bits, np.uint8)

    @staticmethod
    def places(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = np.uint64(FILTER_BITS - 1)
        return h & size, (h >> np.uint64(32)) & size

    def __call__(self, h: np.ndarray) -> np.ndarray:
        found = np.ones(len(h), bool)
        for place in self.places(h):
            found &= (self.bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found

    def holds(self, h: int) -> bool:
        """The same for one hash."""
        first, second = h & (FILTER_BITS - 1), h >> 32 & (FILTER_BITS - 1)
        return bool(self.plain[first >> 3] >> (first & 7) & self.plain[second >> 3] >> (second & 7) & 1)


def filter_of_places(places: DataFrame):
    """Broadcast bits of the filter whose ``place`` rows are given: its size, and what reaches the driver, is fixed."""
    chunks = places.groupBy(F.expr(f"place div {CHUNK_BITS}").alias("chunk")).agg(
        F.bitmap_construct_agg(F.col("place") % CHUNK_BITS).alias("bits")
    )
    bits, width = bytearray(FILTER_BITS // 8), CHUNK_BITS // 8
    for r in chunks.collect():
        bits[r["chunk"] * width : (r["chunk"] + 1) * width] = r["bits"]
    return places.sparkSession.sparkContext.broadcast(bytes(bits))


def id_hash(ids: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(ids.astype(np.int64).view(np.uint64))


def _id_places(batches):
    for rows in batches:
        h = id_hash(rows.column(0).to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(Filter.places(h)).astype(np.int64))], names=["place"])


def filter_of_ids(ids: DataFrame):
    """Broadcast filter of the one long column of ``ids`` (without nulls)."""
    return filter_of_places(ids.mapInArrow(_id_places, "place long"))


def held_by(bits):
    """A column function: whether a filter holds a long; null is not held."""
    @F.arrow_udf("boolean")
    def held(ids: pa.Array) -> pa.Array:
        known = np.asarray(ids.is_valid())
        return pa.array(known & Filter(bits.value)(id_hash(ids.fill_null(0).to_numpy(zero_copy_only=False))))

    return held
