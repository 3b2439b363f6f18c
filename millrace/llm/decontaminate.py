"""Benchmark decontamination: BM25 index of test items, block-max WAND, overlap of question and answer."""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.text import stored

K1, B = 1.2, 0.75
THRESHOLD = 0.6  # of the score that an item has against itself
OVERLAP = 0.75
SHINGLE = 5
BLOCK = 4  # items of a block of postings
ROWS = 1024  # passages bounded at once
SHARD_ITEMS = 512  # items of one index
SLICE_ITEMS = 8192  # items that one pass over the documents is asked for; bounds what is broadcast
LONGEST = 512  # words of a passage's half at most; longer items are retrieved by parts of so many at most

# ASCII letters in lower case, other ASCII signs as spaces; what is not ASCII stays.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b >= 128 else 32 for b in range(256)
)


def terms(text: bytes | str | None) -> list[bytes]:
    raw = text.encode("utf-8", "surrogateescape") if isinstance(text, str) else (text or b"")
    return raw.translate(FOLD).split()


def question_and_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """The answer is the last sentence, or the last third of the words where there is but one."""
    body = text.rstrip()
    cut = max((body.rfind(mark, 0, -1) for mark in (". ", "? ", "! ", ".\n", "?\n", "!\n", "\n")), default=-1)
    question, answer = terms(body[: cut + 1]), terms(body[cut + 1 :])
    if cut < 0 or not question or not answer:
        everything = terms(body)
        at = len(everything) - len(everything) // 3
        question, answer = everything[:at], everything[at:]
    return question, answer


def shingles(items: list[bytes]) -> set[tuple[bytes, ...]]:
    size = min(SHINGLE, len(items))
    return {tuple(items[i : i + size]) for i in range(len(items) - size + 1)} if items else set()


def overlap(part: list[bytes], passage: list[bytes]) -> float:
    """Share of a part's shingles that stand in the passage; a part without words is covered."""
    wanted = shingles(part)
    if not wanted:
        return 1.0
    size = min(SHINGLE, len(part))
    have = {tuple(passage[i : i + size]) for i in range(len(passage) - size + 1)}
    return len(wanted & have) / len(wanted)


@dataclass
class Item:
    """Question and answer of an item, and what each term adds to its score as a share of its score against itself."""

    question: list[bytes]
    answer: list[bytes]
    shares: dict[bytes, float]

    @property
    def size(self) -> int:
        return len(self.question) + len(self.answer)


@dataclass
class Index:
    """Postings of some items, or of parts of long items, by term; impacts are shares of the score against itself.

    Items are numbered from 0 and blocks hold ``BLOCK`` numbers. ``cells`` has a row for each term
    and, per block, the greatest impact in it.
    """

    items: list[int]
    parts: list[Item]  # the whole item, also where a part of it is indexed
    span: int
    vocabulary: dict[bytes, int]
    postings: list[tuple[list[int], list[float]]]
    cells: np.ndarray = field(init=False)

    def __post_init__(self):
        blocks = -(-len(self.items) // BLOCK)
        self.cells = np.zeros((len(self.postings), blocks), np.float32)
        for term, (numbers, impacts) in enumerate(self.postings):
            np.maximum.at(self.cells[term], np.asarray(numbers) // BLOCK, np.asarray(impacts, np.float32))

    def search(self, query: list[int], threshold: float) -> list[tuple[int, float]]:
        """All items that score at least ``threshold`` against the distinct terms of ``query``, by block-max WAND.

        Lists stand in the order of their next item. The pivot is the first item that the lists up
        to it could bring to the threshold by their greatest impacts; if the blocks that hold it
        can't, the lists skip to the end of the nearest block.
        """
        lists = [[0, t, float(self.cells[t].max())] for t in set(query)]
        found, end = [], len(self.items)

        def item(entry) -> int:
            numbers = self.postings[entry[1]][0]
            return numbers[entry[0]] if entry[0] < len(numbers) else end

        while True:
            lists = sorted((x for x in lists if item(x) < end), key=item)
            bound, pivot = 0.0, None
            for k, entry in enumerate(lists):
                bound += entry[2]
                if bound >= threshold:
                    pivot = k
                    break
            if pivot is None:
                return found
            target = item(lists[pivot])
            while pivot + 1 < len(lists) and item(lists[pivot + 1]) == target:
                pivot += 1
            block = target // BLOCK
            if sum(float(self.cells[x[1], block]) for x in lists[: pivot + 1]) < threshold:
                after = (block + 1) * BLOCK
                if pivot + 1 < len(lists):
                    after = min(after, max(item(lists[pivot + 1]), target + 1))
                for x in lists[: pivot + 1]:
                    x[0] = bisect_left(self.postings[x[1]][0], after, x[0])
                continue
            if item(lists[0]) == target:
                score = 0.0
                for x in lists[: pivot + 1]:
                    score += self.postings[x[1]][1][x[0]]
                    x[0] += 1
                if score >= threshold:
                    found.append((target, score))
            else:
                for x in lists[:pivot]:
                    if item(x) < target:
                        x[0] = bisect_left(self.postings[x[1]][0], target, x[0])


def statistics(items: DataFrame) -> tuple[int, float, DataFrame]:
    """Number and mean length of the items that have words, and the items that hold each word, over the whole benchmark."""
    signs = "".join(chr(b) for b in range(1, 128))
    clean = F.translate(F.replace("text", F.lit("\0"), F.lit(" ")), signs, "".join(chr(FOLD[b]) for b in range(1, 128)))
    words = items.select(F.filter(F.split(clean, " +"), lambda w: w != "").alias("words")).where("size(words) > 0")
    n, mean = words.agg(F.count(F.lit(1)), F.avg(F.size("words"))).first()
    return n or 0, mean or 0.0, words


def build(rows: list[tuple[int, str]], n: int, mean: float, holders: dict[bytes, int]) -> list[Index]:
    """Indexes of ``SHARD_ITEMS`` items each. Terms weigh by the ``holders`` among all ``n`` items."""
    out, parts = [], []
    for k, text in rows:
        question, answer = question_and_answer(text)
        words = question + answer
        if not words:
            continue
        counts = Counter(words)
        weights = {}
        for t, tf in counts.items():
            df = holders.get(t, 1)
            weight = math.log1p((n - df + 0.5) / (df + 0.5))
            weights[t] = weight * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words) / max(mean, 1e-9)))
        own = sum(weights.values())
        whole = Item(question, answer, {t: w / own for t, w in weights.items()})
        parts += [(k, whole, impacts, size) for impacts, size in _parts(words, whole.shares)]
    for at in range(0, len(parts), SHARD_ITEMS):
        some = parts[at : at + SHARD_ITEMS]
        by_term: dict[bytes, list[tuple[int, float]]] = defaultdict(list)
        for number, (_, _, impacts, _) in enumerate(some):
            for t, w in impacts.items():
                by_term[t].append((number, w))
        vocabulary = {t: k for k, t in enumerate(by_term)}
        postings = [([i for i, _ in p], [w for _, w in p]) for p in by_term.values()]
        out.append(Index([k for k, *_ in some], [x for _, x, _, _ in some], max(x[3] for x in some), vocabulary, postings))
    return out


def _parts(words: list[bytes], shares: dict[bytes, float]) -> list[tuple[dict[bytes, float], int]]:
    """(impacts, words) of the parts by which an item is retrieved: itself, or even runs of ``LONGEST`` words at most.

    A part has its terms' shares of the item's score as far as they occur in it, so where the item
    reaches a threshold, some part does.
    """
    if len(words) <= LONGEST:
        return [(shares, len(words))]
    many, counts, out = -(-len(words) // LONGEST), Counter(words), []
    for k in range(many):
        run = words[k * len(words) // many : (k + 1) * len(words) // many]
        impacts = {t: shares[t] * tf / counts[t] for t, tf in Counter(run).items()}
        own = sum(impacts.values())
        out.append(({t: w / own for t, w in impacts.items()}, len(run)))
    return out


def passages_to_search(index: Index, ids: np.ndarray, starts: np.ndarray, until: np.ndarray, threshold: float) -> np.ndarray:
    """Numbers of the passages that may score ``threshold`` against an item of some block.

    ``ids`` are term numbers or -1; passage ``k`` has the words from ``starts[k]`` to ``until[k]``.
    The bound of a passage and a block is the sum of the greatest impacts of its distinct terms.
    """
    sizes = until - starts
    places = np.repeat(starts - np.cumsum([0, *sizes[:-1]]), sizes) + np.arange(sizes.sum())
    term = ids[places]
    which = np.repeat(np.arange(len(starts)), sizes)[term >= 0]
    pairs = np.unique(which * len(index.postings) + term[term >= 0])
    which, term = pairs // len(index.postings), pairs % len(index.postings)
    first = np.flatnonzero(np.diff(which, prepend=-1))
    ends = np.append(first[1:], len(term))
    out = []
    for low in range(0, len(first), ROWS):
        high = min(low + ROWS, len(first))
        begin = first[low]
        bounds = np.add.reduceat(index.cells[term[begin : ends[high - 1]]], first[low:high] - begin, axis=0)
        out.append(which[first[low:high]][bounds.max(axis=1) >= threshold - 1e-4])
    return np.concatenate(out) if out else np.empty(0, np.int64)


def _search(indexes: list[Index], threshold: float, wanted: float):
    schema = pa.schema([("doc_id", pa.int64()), ("h1", pa.int64()), ("n_passages", pa.int64()), ("items", pa.list_(pa.int64())), ("leaks", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            docs, hashes, texts = (c.to_pylist() for c in rows.columns)
            words = [terms(t) for t in texts]
            found, leaks, passages = [set() for _ in docs], [set() for _ in docs], [0] * len(docs)
            for index in indexes:
                flat = np.fromiter((k for w in words for k in map(index.vocabulary.get, w, repeat(-1))), np.int64, sum(map(len, words)))
                starts, until, owner, at = [], [], [], 0
                begins = np.cumsum([0, *map(len, words)])
                for number, w in enumerate(words):
                    halves = range(at, at + max(len(w) - index.span, min(len(w), 1)), index.span)
                    at += len(w)
                    starts += halves
                    until += [min(x + 2 * index.span, at) for x in halves]
                    owner += [number] * len(halves)
                    passages[number] = max(passages[number], len(halves))
                if not starts:
                    continue
                for k in passages_to_search(index, flat, np.array(starts, np.int64), np.array(until, np.int64), threshold):
                    number, first, last = owner[k], starts[k], until[k]
                    query = flat[first:last]
                    hits = index.search(query[query >= 0].tolist(), threshold)
                    if not hits:
                        continue
                    offset = int(begins[number])
                    passage = words[number][first - offset : last - offset]
                    for hit, _ in hits:
                        if index.items[hit] in leaks[number]:
                            continue
                        item, around = index.parts[hit], passage
                        if item.size > LONGEST:
                            # passages put together: wherever the part stands in the item, the item lies in these words
                            around = words[number][max(0, first - offset - item.size) : last - offset + item.size]
                            if sum(item.shares[t] for t in item.shares.keys() & set(around)) < threshold:
                                continue
                        found[number].add(index.items[hit])
                        if overlap(item.question, around) >= wanted and overlap(item.answer, around) >= wanted:
                            leaks[number].add(index.items[hit])
            columns = (docs, hashes, passages, [sorted(x) for x in found], [sorted(x) for x in leaks])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def decontaminate(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, wanted: float = OVERLAP, slice_items: int = SLICE_ITEMS,
) -> DataFrame:
    """(doc_id, h1, n_passages, items, leaks) of every row of ``docs``; ``items`` has (item_id, text).

    Every document is cut into passages of two halves, each as long as the longest item, one half
    apart, so that any item lies whole in a passage. Every passage queries the index: all items of
    at least ``threshold`` are retrieved, and those whose question and answer both overlap the
    passage by ``wanted`` are leaks. Items over ``LONGEST`` words are retrieved by parts; score and
    overlap of the whole item are then taken on the words around, an item's length to both sides.

    The documents are never shuffled. The index goes to the tasks in slices of ``SLICE_ITEMS``
    items; a larger benchmark takes more passes, whose results are put together by id and text. Items
    without words or without id match nothing, nor do null or empty texts; equal items are all reported.
    """
    spark = docs.sparkSession
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id IS NOT NULL AND text IS NOT NULL")
    n, mean, words = statistics(items)
    holders = words.select(F.explode(F.array_distinct("words")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    numbered = stored(items, "items")
    most = max(1, -(-n // slice_items))
    sliced = numbered.withColumn("slice", F.pmod(F.xxhash64("item_id", "text"), F.lit(most)))
    holders = stored(holders, "holders")
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("h1"),
        F.col("text").cast("binary").alias("text"),
    )
    results = None
    for k in range(most):
        mine = sliced.where(F.col("slice") == k)
        rows = sorted((r["item_id"], r["text"]) for r in mine.select("item_id", "text").collect())
        clean = statistics(mine)[2].select(F.explode(F.array_distinct("words")).alias("word")).distinct()
        counts = {r["word"].encode(): r["n"] for r in holders.join(clean, "word", "left_semi").collect()}
        indexes = spark.sparkContext.broadcast(build(rows, n, mean, counts))
        found = texts.mapInArrow(_broadcast_search(indexes, threshold, wanted), "doc_id long, h1 long, n_passages long, items array<long>, leaks array<long>")
        results = found if results is None else results.union(found)
    if most == 1:
        return results
    # Rows of the same id and text have the same result in every slice, and come out as often as they went in.
    return results.groupBy("doc_id", "h1").agg(
        F.count(F.lit(1)).alias("n"), F.max("n_passages").alias("n_passages"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("leaks")))).alias("leaks"),
    ).select("*", F.explode(F.sequence(F.lit(1), F.expr(f"n div {most}")))).select("doc_id", "h1", "n_passages", "items", "leaks")


def _broadcast_search(indexes, threshold: float, wanted: float):
    def run(batches):
        yield from _search(indexes.value, threshold, wanted)(batches)

    return run


def leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    return decontaminate(docs, items).select(
        "doc_id", "n_passages", F.size("items").cast("long").alias("n_retrieved"), F.col("leaks").alias("item_ids"),
        (F.size("leaks") > 0).alias("contaminated"),
    )


def drop_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs``, columns unchanged, that hold no item."""
    found = stored(decontaminate(docs, items).where("size(leaks) > 0").select(F.col("doc_id").alias("_id"), F.col("h1").alias("_h1")).distinct(), "leaks")
    hashed = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    return docs.join(found, docs["doc_id"].eqNullSafe(found["_id"]) & (hashed == found["_h1"]), "left_anti")
