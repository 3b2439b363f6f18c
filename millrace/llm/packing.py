"""Best-fit packing of tokenised documents: bin completion on sizes, then every piece is placed."""

from __future__ import annotations

import functools
import json
import re
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import binfill
from millrace.llm.text import batch, stored

CAPACITY, END = 2048, 0
KNOWN = 1_000_000  # chunks a task remembers
# Fixed value: how the byte-level tokenizer splits a text before its merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")

PIECES = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("task", pa.int32()), ("rank", pa.int64()),
])
PIECES_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, rank long"
PLACED_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def tokenizer_definition(path: str | None = None) -> str:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as file:
        return file.read()


def _byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def ranked_encoding(definition: str) -> tiktoken.Encoding | None:
    """The same byte-level BPE in the faster library, if the file's merges stand in the order of its ids."""
    model, alphabet = json.loads(definition)["model"], _byte_alphabet()
    specials = {t["id"] for t in json.loads(definition).get("added_tokens", ())}
    if model.get("type") != "BPE" or any(c not in alphabet for t, k in model["vocab"].items() if k not in specials for c in t):
        return None
    vocabulary = {bytes(alphabet[c] for c in t): k for t, k in model["vocab"].items() if k not in specials}
    merges = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
    order = [model["vocab"].get(m.replace(" ", "")) for m in merges]
    if order != list(range(256, 256 + len(merges))) or len(vocabulary) != 256 + len(merges):
        return None
    return tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks=vocabulary, special_tokens={})


class Unsafe(Exception):
    """A chunk that does not stand alone: empty, or with space at an end."""


class Encoder(dict):
    """Ids of texts as little-endian 32-bit bytes; also the table of the chunks that it knows.

    The tokenizer splits a text before every single space between two other characters, whatever
    stands around, so the ids of a text are those of its chunks, and each chunk is encoded once.
    A text that holds an added token of the file goes to the tokenizer as a whole.
    """

    def __init__(self, definition: str, known: int = KNOWN):
        super().__init__()
        self.ranked, self.limit = ranked_encoding(definition), known
        self.tokenizer = Tokenizer.from_str(definition)
        self.added = [t["content"] for t in json.loads(definition).get("added_tokens", ())]

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str) -> bytes:
        return array("I", self.ranked.encode_ordinary(text)).tobytes() if self.ranked else self.whole(text)

    def __missing__(self, chunk: str) -> bytes:
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            raise Unsafe
        return self.setdefault(chunk, self.encode(" " + chunk))

    def __call__(self, text: str) -> bytes:
        if any(token in text for token in self.added):
            return self.whole(text)
        if len(self) > self.limit:
            self.clear()
        chunks = text.split(" ")
        if len(chunks) > 1 and (not chunks[0] or chunks[0][-1].isspace()):
            chunks = SAFE_SPACE.split(text)
        try:
            return self.encode(chunks[0]) + b"".join(map(self.__getitem__, chunks[1:]))
        except Unsafe:
            head, *rest = SAFE_SPACE.split(text)
            return self.encode(head) + b"".join(self[c] if c[-1:].strip() else self.encode(" " + c) for c in rest)


@functools.lru_cache(maxsize=1)
def encoder(definition: str) -> Encoder:
    """One per Python worker; what it knows serves the worker's later tasks."""
    return Encoder(definition)


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: whole pieces, of which the first may be shorter."""
    first = n % capacity or capacity
    return [(0, first), *((at, capacity) for at in range(first, n, capacity))]


def _pieces(definition: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen, task = encoder(definition), defaultdict(int), TaskContext.get().partitionId()
        for rows in batches:
            out = [[] for _ in PIECES]
            for doc, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                ids = encode(text or "") + END.to_bytes(4, "little")
                for number, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                    for column, value in zip(out, (doc, number, start, length, crc, task, seen[length])):
                        column.append(value)
                    seen[length] += 1
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(out, PIECES)], schema=PIECES)

    return run


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """The pieces of every document, each with its rank among the pieces of its length in its task."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_pieces(tokenizer_definition(tokenizer), capacity), PIECES_DDL)


class Places:
    """Where the items of each size go: items are numbered, and runs of numbers belong to one filling."""

    def __init__(self, plan: binfill.Plan):
        runs, taken, base = [], defaultdict(int), 0
        for filling, times in plan.bins:
            offsets, at = defaultdict(list), 0
            for size in filling:
                offsets[size].append(at)
                at += size
            for size, places in offsets.items():
                runs.append((size, taken[size], base, times, places))
                taken[size] += times * len(places)
            base += times
        runs.sort(key=lambda r: r[:2])
        self.size = np.array([r[0] for r in runs], np.int64)
        self.first = np.array([r[1] for r in runs], np.int64)
        self.base = np.array([r[2] for r in runs], np.int64)
        self.times = np.array([r[3] for r in runs], np.int64)
        self.at = np.cumsum([0, *(len(r[4]) for r in runs)])[:-1]
        self.offsets = np.array([x for r in runs for x in r[4]], np.int64)
        self.sizes = {int(s): (int(np.searchsorted(self.size, s)), int(np.searchsorted(self.size, s, "right"))) for s in set(self.size)}

    def __call__(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        run = np.empty(len(lengths), np.int64)
        for size in np.unique(lengths):
            low, high = self.sizes[int(size)]
            mine = lengths == size
            run[mine] = low + np.searchsorted(self.first[low:high], ranks[mine], "right") - 1
        k = ranks - self.first[run]
        return self.base[run] + k % self.times[run], self.offsets[self.at[run] + k // self.times[run]]


def _placed(places: Places):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            lengths, ranks = rows.column("length").to_numpy(), rows.column("rank").to_numpy()
            sequence, offset = places(lengths, ranks)
            columns = [rows.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return run


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """One row per piece with its sequence and its place there.

    Sizes are counted over all pieces: at most ``capacity`` counts, from which the plan is made.
    Pieces of a size are numbered by task (rank within the task plus the sizes of the tasks
    before), so a size that a third of all pieces have is spread like any other. Numbers are any,
    gapless from 0. A null text is empty; a document without words still has its end id. Rows are
    packed as often as they come; a null id stays null. An empty table gives no rows.
    """
    rows = stored(pieces(docs, capacity, tokenizer), "pieces")
    by_task = rows.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    by_task = stored(by_task.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "tasks")
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = Places(binfill.plan(counts, capacity))
    ranked = rows.join(by_task.select("length", "task", "before"), ["length", "task"]).withColumn("rank", F.col("rank") + F.col("before"))
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(_placed(places), PLACED_DDL)
