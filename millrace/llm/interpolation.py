"""Deleted interpolation: word bigrams, words and the uniform chance, mixed by how often the context was seen."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.text import WordHashes, held_out, mixed, partitions, stored

PARTS, HELD_OUT = 10, 0
ADDED = 0.1  # of the base model
BLOCK_BYTES = 4_000_000  # of text that is counted together before the shuffle
BUCKET_KEYS = 1_000_000  # keys whose counts one step merges, about
KNOWN = 250_000  # words whose hash a task remembers
CONTEXTS = 48  # buckets of contexts: unseen, then by the binary logarithm of their count
STEP = 0.25  # of the binary logarithms of the chances in a cell

START, END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
BLOCKS_DDL = "block long, doc_ids array<long>, train array<boolean>, lengths array<long>, bytes long, texts binary"
ASKED = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("n", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
TOLD = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("n", pa.int64()), ("counts", pa.binary()), ("tokens", pa.int64()), ("types", pa.int64())])


def _packed(values: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane, as planes of small numbers shrink to nothing."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T.tobytes())


def _unpacked(data: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(kind).ravel()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, number = TaskContext.get().partitionId(), 0
    ids, train, texts, size = [], [], [], 0

    def block():
        nonlocal number
        data = zstandard.ZstdCompressor(level=3).compress(b"".join(texts))
        row = pa.RecordBatch.from_arrays([
            pa.array([(task << 32) + number], pa.int64()), pa.array([list(ids)], pa.list_(pa.int64())),
            pa.array([list(train)], pa.list_(pa.bool_())), pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
            pa.array([size], pa.int64()), pa.array([data], pa.binary()),
        ], names=["block", "doc_ids", "train", "lengths", "bytes", "texts"])
        number += 1
        return row

    for rows in batches:
        for doc, learned, text in zip(*(c.to_pylist() for c in rows.columns)):
            ids.append(doc)
            train.append(learned)
            texts.append(text or b"")
            size += len(texts[-1])
            if size >= BLOCK_BYTES or len(ids) >= 100_000:
                yield block()
                ids, train, texts, size = [], [], [], 0
    if ids:
        yield block()


class Block:
    """The tokens of a block: for each its word's key and its bigram's, as positions in the sorted distinct keys."""

    def __init__(self, hashes: WordHashes, train: list[bool], lengths: list[int], texts: bytes):
        raw = zstandard.ZstdDecompressor().decompress(texts) if texts else b""
        tokens, before, at = [], [], 0
        for length in lengths:
            h = np.append(hashes(raw[at : at + length].lower().split()), END)
            tokens.append(h)
            before.append(np.append(START, h[:-1]))
            at += length
        self.sizes = np.array([len(t) for t in tokens])
        self.train = np.repeat(np.array(train, bool), self.sizes)
        w, h = np.concatenate(tokens), np.concatenate(before)
        self.start = h == START
        with np.errstate(over="ignore"):
            words = mixed(w) & ~np.uint64(1)
            pairs = mixed(mixed(h) * np.uint64(0x9E3779B185EBCA87) + w) | np.uint64(1)
        self.keys, where = np.unique(np.concatenate([words, pairs]), return_inverse=True)
        self.word, self.pair = where[: len(w)], where[len(w) :]
        self.context = np.append(0, self.word[:-1])  # of the token before; not used where ``start``

    def own_counts(self) -> np.ndarray:
        n = len(self.keys)
        return np.bincount(self.word[self.train], minlength=n) + np.bincount(self.pair[self.train], minlength=n)


def _ask(shift: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes(limit=KNOWN)
        for rows in batches:
            for number, train, lengths, texts in zip(*(c.to_pylist() for c in rows.columns)):
                block = Block(hashes, train, lengths, texts)
                counts = block.own_counts().astype(np.uint32)
                bucket = (block.keys >> np.uint64(shift)).astype(np.int64)
                cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
                out = [[], [], [], [], []]
                for low, high in zip(cuts, [*cuts[1:], len(bucket)]):
                    keys = np.diff(block.keys[low:high], prepend=np.uint64(0))
                    for column, value in zip(out, (int(bucket[low]), number, int(high - low), _packed(keys), _packed(counts[low:high]))):
                        column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, ASKED)], schema=ASKED)

    return run


def _tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by bucket: its counts are merged, and each block gets those that it asked for."""
    now, asked = None, []

    def answer():
        keys = [np.cumsum(_unpacked(k, np.uint64), dtype=np.uint64) for _, k, _ in asked]
        every, where = np.unique(np.concatenate(keys), return_inverse=True)
        counts = np.bincount(where, np.concatenate([_unpacked(c, np.uint32) for _, _, c in asked])).astype(np.int64)
        ends = np.cumsum([0, *map(len, keys)])
        told = [_packed(counts[where[a:b]].astype(np.uint64)) for a, b in zip(ends, ends[1:])]
        words = counts[(every & np.uint64(1)) == 0]
        rows = [*zip(asked, keys, told)]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((
            [now] * (len(rows) + 1), [*(a[0] for a, _, _ in rows), None], [*(len(k) for _, k, _ in rows), 0],
            [*(t for _, _, t in rows), None], [*[0] * len(rows), int(words.sum())], [*[0] * len(rows), int((words > 0).sum())],
        ), TOLD)], schema=TOLD)

    for rows in batches:
        for bucket, block, keys, counts in zip(*(rows.column(c).to_pylist() for c in ("bucket", "block", "keys", "counts"))):
            if bucket != now and asked:
                yield from answer()
                asked = []
            now = bucket
            asked.append((block, keys, counts))
    if asked:
        yield from answer()


def contexts(counts: np.ndarray) -> np.ndarray:
    return np.where(counts > 0, np.minimum(1 + np.log2(np.maximum(counts, 1)).astype(np.int64), CONTEXTS - 1), 0)


def _counted(rows: pa.RecordBatch, starts: int, hashes: WordHashes):
    """Each block with the counts of its tokens' words, bigrams and contexts over all training texts."""
    for ids, train, lengths, texts, told in zip(*(rows.column(c).to_pylist() for c in ("doc_ids", "train", "lengths", "texts", "told"))):
        block = Block(hashes, train, lengths, texts)
        counts = np.concatenate([_unpacked(x["counts"], np.uint64) for x in told]).astype(np.int64)
        yield ids, block, counts[block.word], counts[block.pair], np.where(block.start, starts, counts[block.context])


def _cells(tokens: int, types: int, starts: int):
    """Training tokens by context bucket and by their chances when the token itself is left out of the counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes(limit=KNOWN)
        for rows in batches:
            for _, block, word, pair, context in _counted(rows, starts, hashes):
                word, pair, context = (c[block.train] - 1 for c in (word, pair, context))
                uniform = 1 / (types + 1)
                two = np.where(context > 0, pair / np.maximum(context, 1), 0) / uniform
                one = word / max(1, tokens - 1) / uniform
                a, b = (np.where(x > 0, np.round(np.log2(np.maximum(x, 1e-300)) / STEP).astype(np.int64) + 2048, 0) for x in (two, one))
                cell, n = np.unique((contexts(context) * 4096 + a) * 4096 + b, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(n)], names=["cell", "n"])

    return run


def weights(cells: np.ndarray, n: np.ndarray, rounds: int = 500) -> np.ndarray:
    """Per context bucket the weights of bigram, word and uniform chance, by expectation-maximisation on the cells.

    Unseen contexts give the bigram no weight; buckets without tokens take those of the nearest
    bucket below. Each weight keeps a little, so that no text is impossible.
    """
    out = np.zeros((CONTEXTS, 3))
    bucket, a, b = cells // 4096**2, cells // 4096 % 4096, cells % 4096
    last = np.array([0.0, 0.5, 0.5])
    for k in range(CONTEXTS):
        mine = bucket == k
        if mine.any():
            two, one = (np.where(x[mine] > 0, 2.0 ** ((x[mine] - 2048) * STEP), 0) for x in (a, b))
            chances = np.column_stack([two if k else 0 * two, one, np.ones(len(one))])
            w = np.array([0.4, 0.3, 0.3]) if k else np.array([0.0, 0.5, 0.5])
            for _ in range(rounds):
                share = chances * w
                share /= share.sum(axis=1, keepdims=True)
                new = (share * n[mine][:, None]).sum(axis=0) / n[mine].sum()
                done = np.abs(new - w).max() < 1e-9
                w = new
                if done:
                    break
            w = np.maximum(w, [1e-6 if k else 0.0, 1e-6, 1e-6])
            last = w / w.sum()
        out[k] = last
    return out


def _scores(tokens: int, types: int, starts: int, mix: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes(limit=KNOWN)
        for rows in batches:
            for ids, block, word, pair, context in _counted(rows, starts, hashes):
                w = mix[contexts(context)]
                chance = w[:, 0] * pair / np.maximum(context, 1) + w[:, 1] * word / max(1, tokens) + w[:, 2] / (types + 1)
                base = np.log10((word + ADDED) / (tokens + ADDED * (types + 1)))
                at = np.cumsum([0, *block.sizes[:-1]])
                learned = block.train[at]
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.int64()), pa.array(~learned), pa.array(block.sizes.astype(np.int64)),
                    pa.array(np.add.reduceat((word > 0).astype(np.int64), at)), pa.array(np.full(len(ids), tokens, np.int64)),
                    pa.array(np.add.reduceat(base, at)), pa.array(np.add.reduceat(np.log10(chance), at)),
                ], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def score_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs``.

    Texts are gathered into blocks. A block asks for the counts of its distinct words and bigrams,
    sorted and packed by ranges of their 64-bit hash; a range's owner adds up what all blocks found
    in training texts and answers each block in the order it asked. So what is shuffled are distinct
    keys of blocks, not tokens, and no common word or long text weighs on one task. The mixture
    weights come from all training tokens with the token itself deleted from the counts, gathered
    into cells of equal chances (``STEP``), of which there are at most some hundred thousand.

    Null and empty texts have one token, the end. A row without id is a training row. Rows that
    repeat count as often. An empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (~held_out(F.col("doc_id"), PARTS, HELD_OUT)).alias("train"),
        F.col("text").cast("binary").alias("text"),
    )
    blocks = stored(rows.mapInArrow(_blocks, BLOCKS_DDL), "blocks")
    size, starts = blocks.agg(F.sum("bytes"), F.sum(F.size(F.filter("train", lambda t: t)).cast("long"))).first()
    bits = max(1, int(np.ceil(np.log2(max(1, (size or 0) / 5 / BUCKET_KEYS)))))
    asked = blocks.select("block", "train", "lengths", "texts").mapInArrow(_ask(64 - bits), "bucket int, block long, n long, keys binary, counts binary")
    dealt = asked.repartition(max(partitions(spark), min(2**bits, 4000)), "bucket").sortWithinPartitions("bucket")
    told = stored(dealt.mapInArrow(_tell, "bucket int, block long, n long, counts binary, tokens long, types long"), "told")
    tokens, types = (int(x or 0) for x in told.agg(F.sum("tokens"), F.sum("types")).first())
    answers = told.where("block IS NOT NULL").groupBy("block").agg(F.sort_array(F.collect_list(F.struct("bucket", "counts"))).alias("told"))
    counted = stored(blocks.join(answers, "block").select("doc_ids", "train", "lengths", "texts", "told"), "counted")
    cells = counted.mapInArrow(_cells(tokens, types, starts or 0), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).orderBy("cell").collect()
    mix = weights(np.array([r["cell"] for r in cells], np.int64), np.array([r["n"] for r in cells], np.int64))
    return counted.mapInArrow(
        _scores(tokens, types, starts or 0, mix),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
