"""Quality by compression: a dictionary of good text and one of bad text, whichever shortens a text more."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.text import held_out, stored

PARTS, HELD_OUT = 3, 1  # rows whose crc32 of the id leaves 1 of 3 are never learned from
SAMPLE_BYTES = 6_000_000  # of labelled text per class for the dictionaries
PIECE = 4096  # characters; long texts count by their pieces, so that none fills the sample
LABEL_ROWS = 4000  # labelled ids per class for the dictionaries, and as many for the curve
DICTIONARY_BYTES = 262_144
LEVEL = 3
FEATURES = ("by_sum", "by_size", "repeated")


@dataclass(frozen=True)
class Model:
    """Dictionaries and the logistic curve over the normalised differences."""

    good: bytes
    bad: bytes
    weights: tuple[float, ...]

    def score(self, values: np.ndarray) -> np.ndarray:
        z = values @ np.array(self.weights[1:]) + self.weights[0]
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


class Sizes:
    """Compressed sizes of a text with each dictionary."""

    def __init__(self, good: bytes, bad: bytes):
        kind = zstandard.DICT_TYPE_AUTO
        dictionaries = [zstandard.ZstdCompressionDict(d, dict_type=kind) if d else None for d in (good, bad)]
        self.both = [
            zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False)
            for d in dictionaries
        ]
        self.nothing = [len(c.compress(b"")) for c in self.both]

    def features(self, text: bytes | None) -> tuple[float, float, float]:
        """From the sizes without the frame of an empty text: difference over sum, over the raw size, and whether little is left.

        The last says how far a text repeats itself: both sizes are then small and their difference
        says nothing. No text: 0 throughout.
        """
        raw = text or b""
        good, bad = (max(0, len(c.compress(raw)) - n) for c, n in zip(self.both, self.nothing))
        repeated = 1 / (1 + 400 * ((good + bad) / 2 / len(raw)) ** 2) if raw else 0.0
        return (bad - good) / max(1, bad + good), (bad - good) / max(1, len(raw)), repeated


def sample(labels: DataFrame) -> DataFrame:
    """(id, quality, draw): labelled ids that may be learned from, by hash; at most ``LABEL_ROWS`` per class and use.

    An even draw is for the dictionaries, an odd one for the curve. An id with both labels counts for each.
    """
    known = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("int").alias("quality")
    ).where(~held_out(F.col("id"), PARTS, HELD_OUT)).distinct().withColumn("draw", F.xxhash64("id"))
    parts = [
        known.where((F.col("quality") == q) & (F.pmod("draw", F.lit(2)) == use)).orderBy("draw", "id").limit(LABEL_ROWS)
        for q in (0, 1) for use in (0, 1)
    ]
    return stored(parts[0].union(parts[1]).union(parts[2]).union(parts[3]), "sample")


def labelled(docs: DataFrame, drawn: DataFrame) -> DataFrame:
    """(text, quality, draw) of the sampled rows. The sample has at most 4 times ``LABEL_ROWS`` ids, so it is broadcast."""
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), "text").where("text IS NOT NULL")
    return rows.join(F.broadcast(drawn), "id").select("text", "quality", F.xxhash64("draw", "text").alias("draw"))


def _pieces(rows: DataFrame) -> DataFrame:
    """Whole texts, cut into pieces, so that a long one does not fill the sample."""
    at = F.sequence(F.lit(0), F.greatest(F.lit(0), (F.length("text") - 1) / PIECE).cast("int"))
    pieces = rows.select("quality", "draw", "text", F.explode(at).alias("k"))
    return pieces.select("quality", F.substring("text", F.col("k") * PIECE + 1, F.lit(PIECE)).alias("piece"), F.xxhash64("draw", "k").alias("draw"))


def _drawn(pieces: DataFrame, quality: int, total: int) -> list[bytes]:
    """A sample of a class's pieces of about ``SAMPLE_BYTES``, by hash; all if there are no more."""
    share = min(1.0, SAMPLE_BYTES / max(1, total))
    cut = int(share * 2**62)
    rows = pieces.where((F.col("quality") == quality) & (F.shiftrightunsigned(F.col("draw"), 2) < cut))
    return [r["piece"].encode() for r in rows.orderBy("draw").select("piece").collect()]


def dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or the samples themselves where there are too few to train one."""
    if sum(map(len, samples)) < 20 * 1024 or len(samples) < 20:
        return b"".join(samples)[:DICTIONARY_BYTES]
    size = min(DICTIONARY_BYTES, sum(map(len, samples)) // 4)
    try:
        return zstandard.train_dictionary(size, samples, level=LEVEL, k=256, d=6).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


def _features(good: bytes, bad: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(good, bad)
        for rows in batches:
            found = [sizes.features(t) for t in rows.column(1).to_pylist()]
            values = [pa.array([f[k] for f in found], pa.float64()) for k in range(len(FEATURES))]
            yield pa.RecordBatch.from_arrays([rows.column(0), *values], names=["key", *FEATURES])

    return run


def features(rows: DataFrame, key: Column, good: bytes, bad: bytes) -> DataFrame:
    return rows.select(key.cast("long").alias("key"), F.col("text").cast("binary").alias("text")).mapInArrow(
        _features(good, bad), ", ".join(["key long", *(f"{f} double" for f in FEATURES)])
    )


def logistic(values: np.ndarray, targets: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> tuple[float, ...]:
    """Newton's method; targets are pulled in a little, so that separable rows keep finite weights."""
    if not len(values):
        return (0.0, *[0.0] * values.shape[1])
    x = np.column_stack([np.ones(len(values)), values])
    good, bad = targets.sum(), len(targets) - targets.sum()
    t = np.where(targets == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - t) + ridge * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in w)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Dictionaries from one half of the labelled rows, the curve from the other.

    What comes to the driver is bounded: about ``SAMPLE_BYTES`` per class and three numbers for at
    most ``CALIBRATION_ROWS`` rows or so, all drawn by hash. Without labels of both classes the
    score is 0.5 or the one class's share.
    """
    drawn = sample(labels)
    even = F.pmod("draw", F.lit(2)) == 0
    pieces = stored(_pieces(labelled(docs, drawn.where(even))), "pieces")
    totals = {
        r["quality"]: r["bytes"]
        for r in pieces.groupBy("quality").agg(F.sum(F.octet_length("piece")).alias("bytes")).collect()
    }
    bad, good = (dictionary(_drawn(pieces, q, totals.get(q, 0))) for q in (0, 1))
    rest = labelled(docs, drawn.where(~even))
    found = features(rest, F.col("quality"), good, bad).collect()  # the key of a row is its class here
    found = sorted((r["key"], *(r[f] for f in FEATURES)) for r in found)
    values = np.array([f[1:] for f in found]).reshape(-1, len(FEATURES))
    return Model(good, bad, logistic(values, np.array([f[0] for f in found], float)))


def _scores(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted: Model = model.value
        sizes = Sizes(fitted.good, fitted.bad)
        for rows in batches:
            found = np.array([sizes.features(t) for t in rows.column(1).to_pylist()]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(fitted.score(found))], names=["doc_id", "score"])

    return run


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``, from its whole text alone.

    Null and empty texts get the score of no difference. Rows with equal texts get equal scores.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    scored = rows.mapInArrow(_scores(model), "doc_id long, score double")
    return scored.select(
        "doc_id", held_out(F.col("doc_id"), PARTS, HELD_OUT).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
