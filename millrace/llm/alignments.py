"""Cross-tokenizer alignment: inverted pair bitmaps give document counts, postings bring the counts back to documents."""

from __future__ import annotations

import functools
import hashlib
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm.packing import SAFE_SPACE, _byte_alphabet, ranked_encoding, tokenizer_definition
from millrace.llm.text import partitions, stored

BLOCK_BYTES = 8_000_000  # of text that share an index
BLOCK_DOCS = 1 << 16
KNOWN = 400_000  # chunks that a worker remembers
KNOWN_CHARS = 20_000_000  # and their characters
BUCKETS = 64  # of A ids: fixed, as the vocabulary is
BLOCKS_A_SALT = 4096  # blocks that one task answers for a bucket
SPACE = "▁"  # of the second tokenizer
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")

BLOCKS_DDL = (
    "block long, doc_ids binary, no_ids binary, sizes binary, digests array<string>, pairs binary, documents binary, "
    "rows binary, words binary, bits binary, planes array<struct<rows: binary, bits: binary>>"
)
RESULT_DDL = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def packed(values: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane, as planes of small numbers shrink to nothing."""
    values = np.ascontiguousarray(values)
    return zstandard.ZstdCompressor(level=1).compress(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes())


def unpacked(data: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


class Tokenizers:
    """Both tokenizers, the bytes of their tokens, and the alignments of the chunks seen so far.

    Before a single space between two other characters the first tokenizer always splits, and so
    does the second if no piece of it holds a space mark after another character (checked). There
    both have a token end, so a text's groups are those of its chunks, and a chunk is aligned once.
    Without that property the whole text is one chunk.
    """

    def __init__(self, definition: str, model: bytes, known: int = KNOWN):
        self.first = Tokenizer.from_str(definition)
        self.first.encode_special_tokens = True
        self.ranked = ranked_encoding(definition)
        self.second = sentencepiece.SentencePieceProcessor(model_proto=model)
        alphabet = _byte_alphabet()
        self.a_bytes: dict[int, bytes] = {
            k: bytes(alphabet[c] for c in t) if all(c in alphabet for c in t) else t.encode() for t, k in json.loads(definition)["model"]["vocab"].items()
        }
        pieces = [self.second.id_to_piece(k) for k in range(self.second.get_piece_size())]
        self.b_bytes = [
            bytes([int(BYTE_PIECE.fullmatch(p)[1], 16)]) if self.second.is_byte(k) else p.replace(SPACE, " ").encode() for k, p in enumerate(pieces)
        ]
        self.chunked = self.ranked is not None and not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces)
        self.limit = known
        self.forget()

    def forget(self) -> None:
        """Chunk numbers start anew; pairs keep theirs only within a block."""
        self.numbers: dict[str, int] = {}
        self.groups: list[str | None] = []
        self.pairs, self.ends, self.sizes, self.chars = array("Q"), array("q", [0]), array("q"), 0

    def chunks(self, text: str) -> list[str]:
        return SAFE_SPACE.split(text) if self.chunked else [text]

    def a_ids(self, text: str) -> list[int]:
        return self.ranked.encode_ordinary(text) if self.ranked else self.first.encode(text, add_special_tokens=False).ids

    def learn(self, chunks: list[str]) -> None:
        """Aligns chunks without the space that stands before each of them."""
        for chunk, b in zip(chunks, self.second.encode(chunks, num_threads=1)):
            self.numbers[chunk] = len(self.groups)
            self.chars += len(chunk)
            plain, a = b" " + chunk.encode("utf-8", "surrogatepass"), self.a_ids(" " + chunk)
            a_parts, b_parts = [self.a_bytes[i] for i in a], [self.b_bytes[i] for i in b]
            if b"".join(a_parts) == plain and b"".join(b_parts) == plain:
                pairs, groups = aligned(a, [len(x) for x in a_parts], b, [len(x) for x in b_parts])
                self.pairs.extend(pairs)
                self.groups.append(";".join([f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups]))
                self.sizes.extend((len(a), len(b), len(groups)))
            else:
                self.groups.append(None)
                self.sizes.extend((0, 0, 0))
            self.ends.append(len(self.pairs))

    def totals(self, numbers: np.ndarray) -> list[int]:
        """A tokens, B tokens and groups of some chunks."""
        return np.frombuffer(self.sizes, np.int64).reshape(-1, 3)[numbers].sum(axis=0).tolist()

    def links(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The links of some chunks, one after another, and how many each has."""
        ends = np.frombuffer(self.ends, np.int64)
        starts, each = ends[numbers], ends[numbers + 1] - ends[numbers]
        before = np.cumsum(each) - each
        return np.frombuffer(self.pairs, np.uint64)[np.repeat(starts - before, each) + np.arange(each.sum())], each


def aligned(a: list[int], a_sizes: list[int], b: list[int], b_sizes: list[int]) -> tuple[list[int], list[tuple[list[int], list[int]]]]:
    """(links, groups) of two tokenisations of the same bytes.

    Each stretch between neighbouring ends of either side lies in one token of each, and two tokens
    share at most one stretch: so the stretches are the links, each packed as A id, B id. A group
    ends where both sides end.
    """
    links, groups, i, j, left, right = [], [], 0, 0, 0, 0
    at = (0, 0)
    while i < len(a):
        links.append(a[i] << 32 | b[j])
        x, y = left + a_sizes[i], right + b_sizes[j]
        if x <= y:
            left, i = x, i + 1
        if y <= x:
            right, j = y, j + 1
        if x == y:
            groups.append((a[at[0] : i], b[at[1] : j]))
            at = (i, j)
    return links, groups


@functools.lru_cache(maxsize=1)
def tokenizers(definition: str, model: bytes) -> Tokenizers:
    """One per Python worker; what it knows serves the worker's later tasks."""
    return Tokenizers(definition, model)


class Index:
    """Postings of a block: for every pair a compressed bitmap of documents and planes of its multiplicities.

    A bitmap is its words of 64 documents that are not zero: row k is word ``words[k]`` of pair
    ``rows[k]``. Plane j has the bits of the documents whose multiplicity has bit j; rows without a
    bit are left out of a plane.
    """

    def __init__(self, pairs: np.ndarray, rows: np.ndarray, words: np.ndarray, bits: np.ndarray, planes: list[tuple[np.ndarray, np.ndarray]]):
        self.pairs, self.rows, self.words, self.bits, self.planes = pairs, rows, words, bits, planes

    @classmethod
    def of(cls, pairs: np.ndarray, documents: np.ndarray, times: np.ndarray) -> Index:
        """From links with repeats: the same (pair, document) may come several times."""
        names, pair = np.unique(pairs, return_inverse=True)
        key, where = np.unique((pair.astype(np.uint64) << np.uint64(32)) | documents.astype(np.uint64), return_inverse=True)
        times = np.bincount(where, times, minlength=len(key)).astype(np.int64)
        pair, document = (key >> np.uint64(32)).astype(np.int64), (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
        bit = np.uint64(1) << (document & 63).astype(np.uint64)
        row = (pair << 32) | (document >> 6)
        starts = np.flatnonzero(np.diff(row, prepend=-1))

        def ored(values: np.ndarray) -> np.ndarray:
            return np.bitwise_or.reduceat(values, starts) if len(starts) else np.zeros(0, np.uint64)

        planes = []
        for j in range(int(times.max(initial=0)).bit_length()):
            plane = ored(np.where((times >> j) & 1 == 1, bit, np.uint64(0)))
            at = np.flatnonzero(plane)
            planes.append((at, plane[at]))
        return cls(names, pair[starts], document[starts] >> 6, ored(bit), planes)

    def documents(self) -> np.ndarray:
        """Documents of each pair: its bitmap's bits."""
        return np.bincount(self.rows, np.bitwise_count(self.bits), minlength=len(self.pairs)).astype(np.int64)

    def merged(self, other: Index) -> Index:
        """The index of both: bitmaps of a pair are ORed. No document may be in both."""
        names = np.union1d(self.pairs, other.pairs)
        keys = [(np.searchsorted(names, x.pairs)[x.rows] << 32) | x.words for x in (self, other)]
        every = np.union1d(*keys)
        to = [np.searchsorted(every, k) for k in keys]

        def ored(parts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
            out = np.zeros(len(every), np.uint64)
            for at, values in parts:
                out[at] |= values
            return out

        planes = []
        for j in range(max(len(self.planes), len(other.planes))):
            plane = ored([(t[x.planes[j][0]], x.planes[j][1]) for t, x in zip(to, (self, other)) if j < len(x.planes)])
            at = np.flatnonzero(plane)
            planes.append((at, plane[at]))
        return Index(names, every >> 32, every & 0xFFFFFFFF, ored([(t, x.bits) for t, x in zip(to, (self, other))]), planes)

    def sums(self, values: np.ndarray, size: int) -> np.ndarray:
        """For each document the sum over its links of the pair's value, by the planes."""
        out = np.zeros(size, np.int64)
        for j, (at, bits) in enumerate(self.planes):
            worth, word = values[self.rows[at]] << j, self.words[at] * 64
            for bit in range(64):
                here = np.flatnonzero((bits >> np.uint64(bit)) & np.uint64(1))
                np.add.at(out, word[here] + bit, worth[here])
        return out


def _block(number: int, ids: list, sizes: list, digests: list, index: Index | None) -> pa.RecordBatch:
    index = index or Index.of(*(np.zeros(0, np.int64),) * 3)
    row = [
        number, packed(np.array([d or 0 for d in ids], np.int64)), packed(np.array([d is None for d in ids])),
        packed(np.array(sizes, np.int64).ravel()), digests, packed(np.diff(index.pairs.astype(np.uint64), prepend=np.uint64(0))), packed(index.documents()),
        packed(np.diff(index.rows, prepend=0)), packed(index.words.astype(np.uint32)), packed(index.bits),
        [{"rows": packed(np.diff(at, prepend=0)), "bits": packed(bits)} for at, bits in index.planes],
    ]
    kinds = [pa.int64(), *[pa.binary()] * 3, pa.list_(pa.string()), *[pa.binary()] * 5, pa.list_(pa.struct([("rows", pa.binary()), ("bits", pa.binary())]))]
    names = ["block", "doc_ids", "no_ids", "sizes", "digests", "pairs", "documents", "rows", "words", "bits", "planes"]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=names)


def _indexed(definition: str, model: bytes, block_bytes: int):
    """Blocks of documents with their index; that of a batch of rows is merged into its block's."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools, number = tokenizers(definition, model), TaskContext.get().partitionId() << 32
        ids, sizes, digests, index, size = [], [], [], None, 0
        for rows in batches:
            documents = [tools.chunks(t) if t else [] for t in rows.column(1).to_pylist()]
            if len(tools.groups) > tools.limit or tools.chars > KNOWN_CHARS:
                tools.forget()
            known = tools.numbers
            new = {c for d in documents for c in d if c not in known}
            tools.learn(list(new))
            told, of, times = [], [], []
            for doc, chunks in zip(rows.column(0).to_pylist(), documents):
                numbers = [known[c] for c in chunks]
                groups = [tools.groups[k] for k in numbers]
                ids.append(doc)
                if not numbers or None in groups:
                    sizes.append((0, 0, 0, 0))
                    digests.append("")
                    continue
                numbers = np.array(numbers)
                a, b, g = tools.totals(numbers)
                sizes.append((a, b, g, a + b - g))
                digests.append(hashlib.sha256(";".join(groups).encode()).hexdigest())
                size += sum(map(len, chunks))
                distinct, n = np.unique(numbers, return_counts=True)
                told.append(distinct)
                times.append(n)
                of.append(np.full(len(distinct), len(ids) - 1))
            if told:
                links, each = tools.links(np.concatenate(told))
                found = Index.of(links, np.repeat(np.concatenate(of), each), np.repeat(np.concatenate(times), each))
                index = found if index is None else index.merged(found)
            if size >= block_bytes or len(ids) >= BLOCK_DOCS:
                yield _block(number, ids, sizes, digests, index)
                number, ids, sizes, digests, index, size = number + 1, [], [], [], None, 0
        if ids:
            yield _block(number, ids, sizes, digests, index)

    return run


def bucket(pairs: np.ndarray) -> np.ndarray:
    """Of the A id, so that all pairs of an id meet."""
    return ((pairs >> np.uint64(32)) * np.uint64(0x9E3779B1) >> np.uint64(16)).astype(np.int64) % BUCKETS


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Document counts of a task's blocks, added up; at most as many rows as there are pairs of the vocabularies in use."""
    pairs, n, schema = np.zeros(0, np.uint64), np.zeros(0, np.int64), pa.schema([("pair", pa.int64()), ("n", pa.int64())])
    for rows in batches:
        for more, counts in zip(*(c.to_pylist() for c in rows.columns)):
            names, where = np.unique(np.concatenate([pairs, np.cumsum(unpacked(more, np.uint64), dtype=np.uint64)]), return_inverse=True)
            pairs, n = names, np.bincount(where, np.concatenate([n, unpacked(counts, np.int64)]), minlength=len(names)).astype(np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(pairs.astype(np.int64)), pa.array(n)], schema=schema)


def _asked(salts: int):
    """A block's pairs, bucket by bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for block, pairs in zip(*(c.to_pylist() for c in rows.columns)):
                pairs = np.cumsum(unpacked(pairs, np.uint64), dtype=np.uint64)
                of = bucket(pairs)
                present = np.unique(of)
                columns = [
                    pa.array(present.astype(np.int32)), pa.array(np.full(len(present), block % salts, np.int32)), pa.array(np.full(len(present), block)),
                    pa.array([packed(np.diff(pairs[of == k], prepend=np.uint64(0))) for k in present], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["bucket", "salt", "block", "pairs"])

    return run


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by (bucket, salt): first the corpus-wide counts, then the blocks' questions, which only stream by."""
    key, told, names = None, None, None
    for rows in batches:
        out = [[], [], [], []]
        for number, salt, block, pairs, counts, best in zip(*(c.to_pylist() for c in rows.columns)):
            if (number, salt) != key:
                key, told, names = (number, salt), [], None
            if block is None:
                told.append((unpacked(pairs, np.uint64), unpacked(counts, np.int64), unpacked(best, np.bool_)))
                continue
            if names is None:
                names, n, highest = (np.concatenate(x) for x in zip(*told))
                order = np.argsort(names)
                names, n, highest = names[order], n[order], highest[order]
            at = np.searchsorted(names, np.cumsum(unpacked(pairs, np.uint64), dtype=np.uint64))
            for column, value in zip(out, (block, number, packed(n[at]), packed(highest[at]))):
                column.append(value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.binary()), pa.array(out[3], pa.binary())],
            names=["block", "bucket", "counts", "best"],
        )


def _packed_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        pairs, n, best = (c.to_numpy(zero_copy_only=False) for c in rows.columns)
        pairs = pairs.astype(np.uint64)
        of = bucket(pairs)
        present = np.unique(of)
        columns = [[packed(x[of == k]) for k in present] for x in (pairs, n, best.astype(bool))]
        yield pa.RecordBatch.from_arrays([pa.array(present.astype(np.int32)), *(pa.array(c, pa.binary()) for c in columns)], names=["bucket", "pairs", "counts", "best"])


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        for r in rows.to_pylist():
            ids, none = unpacked(r["doc_ids"], np.int64), unpacked(r["no_ids"], np.bool_)
            pairs = np.cumsum(unpacked(r["pairs"], np.uint64), dtype=np.uint64)
            planes = [(np.cumsum(unpacked(p["rows"], np.int64)), unpacked(p["bits"], np.uint64)) for p in r["planes"]]
            index = Index(
                pairs, np.cumsum(unpacked(r["rows"], np.int64)), unpacked(r["words"], np.uint32).astype(np.int64), unpacked(r["bits"], np.uint64), planes
            )
            counts, best, of = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64), bucket(pairs)
            for told in r["told"] or ():
                mine = of == told["bucket"]
                counts[mine], best[mine] = unpacked(told["counts"], np.int64), unpacked(told["best"], np.bool_)
            sizes = unpacked(r["sizes"], np.int64).reshape(-1, 4)
            columns = [pa.array(ids, mask=none), *(pa.array(np.ascontiguousarray(c)) for c in sizes.T)]
            columns += [pa.array(index.sums(best, len(ids))), pa.array(index.sums(counts, len(ids))), pa.array(r["digests"], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])


def second_model(path: str | None = None) -> bytes:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    with open(path, "rb") as file:
        return file.read()


def indexed(docs: DataFrame, first: str | None = None, second: str | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The inverted index: one row per block of documents (see ``Index``), its documents' sizes and digests beside it."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stored(rows.mapInArrow(_indexed(tokenizer_definition(first), second_model(second), block_bytes), BLOCKS_DDL), "postings")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, n, best) corpus-wide: documents that hold the pair linked, and whether no pair of its A id has more."""
    counts = blocks.select("pairs", "documents").mapInArrow(_totals, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    of_id = Window.partitionBy(F.shiftright("pair", 32))  # at most as many rows as the second vocabulary
    return counts.select("pair", "n", (F.col("n") == F.max("n").over(of_id)).alias("best"))


def align_documents(docs: DataFrame, first: str | None = None, second: str | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of ``docs``.

    Every row is a document of its own, also where ids repeat. Texts that are null, empty or not
    spelt by the tokens of either side have zeros and an empty digest. An empty table gives no rows.

    Texts are read once, into an index by blocks. Document counts are the bits of a pair's bitmaps,
    added up by task and then by pair. A block asks for the counts of its distinct pairs by buckets
    of A ids, and its postings turn the answers into sums per document. What is shuffled are
    distinct pairs of tasks and blocks, never links or texts; blocks are salted over a bucket.
    """
    spark = docs.sparkSession
    blocks = indexed(docs, first, second, block_bytes)
    number = blocks.count()
    salts = 1 + number // BLOCKS_A_SALT
    counts = stored(pair_counts(blocks), "pairs")
    told = counts.mapInArrow(_packed_counts, "bucket int, pairs binary, counts binary, best binary").select(
        "bucket", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(None).cast("long").alias("block"), "pairs", "counts", "best"
    )
    asked = blocks.select("block", "pairs").mapInArrow(_asked(salts), "bucket int, salt int, block long, pairs binary").select(
        "*", F.lit(None).cast("binary").alias("counts"), F.lit(None).cast("binary").alias("best")
    )
    dealt = told.unionByName(asked).repartition(max(partitions(spark), min(BUCKETS * salts, 20_000)), "bucket", "salt")
    answers = dealt.sortWithinPartitions("bucket", "salt", F.col("block").asc_nulls_first()).mapInArrow(
        _answered, "block long, bucket int, counts binary, best binary"
    )
    answers = stored(answers, "answers").groupBy("block").agg(F.collect_list(F.struct("bucket", "counts", "best")).alias("told"))
    return blocks.drop("documents").join(answers, "block", "left").select(
        "doc_ids", "no_ids", "sizes", "digests", "pairs", "rows", "words", "bits", "planes", "told"
    ).mapInArrow(_scored, RESULT_DDL)
