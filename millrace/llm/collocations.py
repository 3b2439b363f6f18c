"""Phrase collocations: phrases are counted in HAT-tries whose subtrees spill as sorted runs; prefix partitions merge them."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.text import Filter, filter_of_places, mixed, partitions, stored

LONGEST = 4  # words of a phrase
LEAST = 30  # occurrences of a candidate
SHARE = 80  # percent of a phrase's occurrences that lie in one longer phrase: it is dropped
TOP = 2000
SCALE = 2_000_000
ENTRIES = 1_000_000  # that a task's trie holds before its largest subtrees are spilled
BURST = 8192  # entries of a container before it becomes a node
KNOWN = 600_000  # words that a task remembers before it starts anew
HASHED = 4  # times ``entries`` hashes of phrases that a task holds before it writes them as runs
WAITING = 1 << 18  # phrases of one length that wait to be added to the trie
PREFIX = 3  # words that decide a phrase's partition
SLOT_BYTES = 16_000_000  # of text for each prefix partition
RANKERS = 64  # tasks that rank a language's phrases before the last one does
MOST_PARTITIONS = 20_000  # several prefix partitions share one beyond it

# Fixed value: the characters that end a piece.
SEPARATORS = b".,;:!?\n\x0b\x0c\r"
BREAK = SEPARATORS[:1]
TO_BREAK = bytes.maketrans(SEPARATORS, BREAK * len(SEPARATORS))
LETTER = ~np.isin(np.arange(256, dtype=np.uint8), np.frombuffer(SEPARATORS + b" \t", np.uint8))
POWERS = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64))  # by place in a word: its first 64 bytes and its length make its hash
AT_ONCE = 1 << 16  # words that are hashed in one step

RUNS = pa.schema([("slot", pa.int32()), ("lang", pa.string()), ("phrases", pa.binary()), ("counts", pa.binary())])
RUNS_DDL = "slot int, lang string, phrases binary, counts binary"
HASH_RUNS = pa.schema([("slot", pa.int32()), ("hashes", pa.binary()), ("counts", pa.binary())])
HASH_RUNS_DDL = "slot int, hashes binary, counts binary"
COUNTS = pa.schema([("lang", pa.string()), ("phrase", pa.binary()), ("n", pa.int64())])
COUNTS_DDL = "lang string, phrase binary, n long"


def spoken(texts: list[bytes | None]) -> bytes:
    """Texts as one, in lower case; ``BREAK`` stands between pieces."""
    return BREAK.join(t or b"" for t in texts).lower().translate(TO_BREAK)


def words_of(said: bytes) -> list[bytes]:
    return said.replace(BREAK, b" ").split()


def by_language(rows: pa.RecordBatch) -> dict[str, bytes]:
    texts = defaultdict(list)
    for lang, text in zip(*(c.to_pylist() for c in rows.columns)):
        texts[lang].append(text)
    return {lang: spoken(mine) for lang, mine in texts.items()}


def hashed(lang: str, said: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word, and the number of the piece that it lies in. Equal words have equal hashes; others may have."""
    a = np.frombuffer(said, np.uint8)
    inside = LETTER[a]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    if not len(starts):
        return np.empty(0, np.uint64), np.empty(0, np.int32)
    sums = []
    for k in range(0, len(starts), AT_ONCE):
        n = np.minimum(sizes[k : k + AT_ONCE], len(POWERS))
        first = np.cumsum(n) - n
        place = np.arange(first[-1] + n[-1]) - np.repeat(first, n)
        letters = a[np.repeat(starts[k : k + AT_ONCE], n) + place]
        sums.append(np.add.reduceat(POWERS[place] * letters, first))
    marks = sizes.astype(np.uint64) + np.uint64(zlib.crc32(lang.encode()) << 32)
    return pair_hash(np.concatenate(sums), marks), np.cumsum(a == BREAK[0], dtype=np.int32)[starts]


def word_hash(lang: str, word: bytes) -> int:
    return int(hashed(lang, word)[0][0])


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(mixed(first) * np.uint64(0x9E3779B185EBCA87) + second)


def longer(at: np.ndarray) -> np.ndarray:
    """Places where a phrase of one more word starts, from those of its two parts."""
    return at[:-1][np.diff(at) == 1]


def long_hash(h: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the phrases of three or four words at these places."""
    return pair_hash(pair_hash(h[at], h[at + 1]), h[at + 2] if size == 3 else pair_hash(h[at + 2], h[at + 3]))


def frequent_pairs(h: np.ndarray, piece: np.ndarray, frequent: Filter) -> np.ndarray:
    """Places of the words that are frequent and followed by a frequent word of the same piece."""
    if not len(h):
        return np.empty(0, np.int64)
    often = frequent(h)
    return np.flatnonzero(often[:-1] & often[1:] & (piece[:-1] == piece[1:]))


class Numbers(dict):
    """A task's numbers of the words of one language."""

    def __init__(self, lang: str, words: Words):
        self.lang, self.words = lang, words

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.words.names)
        self.words.names.append(word)
        self.words.langs.append(self.lang)
        return number


class Words:
    """Numbers of all words that a task has to tell apart, from 1."""

    def __init__(self):
        self.by_lang, self.names, self.langs = {}, [b""], [""]

    def __call__(self, lang: str, items: Iterator[bytes], n: int) -> np.ndarray:
        numbers = self.by_lang.get(lang)
        if numbers is None:
            numbers = self.by_lang[lang] = Numbers(lang, self)
        return np.fromiter(map(numbers.__getitem__, items), np.uint64, n)


def distinct(words: list[np.ndarray]) -> tuple[list[int], list[int], list[int]]:
    """Phrases of 2 to 4 numbers, a column for each place, as first words, packed rests and how often; equal ones as one."""
    head = (words[0] << np.uint64(32)) | words[1]
    tail = None if len(words) == 2 else words[2] if len(words) == 3 else (words[2] << np.uint64(32)) | words[3]
    order = np.argsort(head if tail is None else pair_hash(head, tail))
    head, tail = head[order], None if tail is None else tail[order]
    new = np.ones(len(order), bool)
    new[1:] = head[1:] != head[:-1]
    if tail is not None:
        new[1:] |= tail[1:] != tail[:-1]
    starts = np.flatnonzero(new)
    head, n = head[starts], np.diff(starts, append=len(order)).tolist()
    firsts, seconds = (head >> np.uint64(32)).tolist(), head & np.uint64(0xFFFFFFFF)
    if tail is None:
        return firsts, seconds.tolist(), n
    tail = tail[starts]
    if len(words) == 3:
        return firsts, ((seconds << np.uint64(32)) | tail).tolist(), n
    return firsts, [(b << 64) | cd for b, cd in zip(seconds.tolist(), tail.tolist())], n


class Node(dict):
    """A container that burst: the next word's number leads to the container of what follows."""


class HatTrie:
    """Counts of phrases as word numbers: nodes by first word, containers (hash tables) of the packed rest.

    The rest of a phrase is one integer of 32 bits a word. A container with more than ``burst``
    entries becomes a node by the next word, so the trie is as deep only where it is crowded.
    """

    def __init__(self, burst: int = BURST):
        self.root: dict[int, dict] = {}
        self.burst, self.entries = burst, 0

    def add(self, firsts, rests, counts) -> None:
        root = self.root
        for first, rest, n in zip(firsts, rests, counts):
            node = root.get(first)
            if node is None:
                node = root[first] = {}
            if node.__class__ is Node:
                shift = (rest.bit_length() - 1) // 32 * 32
                top, rest = rest >> shift, rest & ((1 << shift) - 1)
                first_node, node = node, node.get(top)
                if node is None:
                    node = first_node[top] = {}
            have = node.get(rest)
            if have is None:
                node[rest] = n
                self.entries += 1
                if len(node) > self.burst and node is root[first] and rest >> 32:
                    root[first] = self.burst_open(node)
            else:
                node[rest] = have + n

    @staticmethod
    def burst_open(container: dict[int, int]) -> Node:
        node = Node()
        for rest, n in container.items():
            shift = (rest.bit_length() - 1) // 32 * 32
            node.setdefault(rest >> shift, {})[rest & ((1 << shift) - 1)] = n
        return node

    @staticmethod
    def size(node: dict) -> int:
        return sum(map(len, node.values())) if node.__class__ is Node else len(node)

    def taken(self, keep: int) -> Iterator[tuple[tuple[int, ...], int]]:
        """Removes whole subtrees, the largest first, until ``keep`` entries are left; yields their phrases."""
        for first in sorted(self.root, key=lambda f: self.size(self.root[f]), reverse=True):
            if self.entries <= keep:
                break
            node = self.root.pop(first)
            self.entries -= self.size(node)
            if node.__class__ is Node:
                for second, container in node.items():
                    for rest, n in container.items():
                        yield (first, second, *unpacked(rest)), n
            else:
                for rest, n in node.items():
                    yield (first, *unpacked(rest)), n


def unpacked(rest: int) -> tuple[int, ...]:
    if rest >> 64:
        return rest >> 64, rest >> 32 & 0xFFFFFFFF, rest & 0xFFFFFFFF
    if rest >> 32:
        return rest >> 32, rest & 0xFFFFFFFF
    return (rest,) if rest else ()


def run_rows(counts: Iterator[tuple[str, bytes, bytes, int]], slots: int) -> Iterator[pa.RecordBatch]:
    """(language, prefix, phrase, count) as one sorted run per language and prefix partition."""
    runs = defaultdict(list)
    for lang, prefix, phrase, n in counts:
        runs[lang, zlib.crc32(prefix) % slots].append((phrase, n))
    pack = zstandard.ZstdCompressor(level=1).compress
    for (lang, slot), run in runs.items():
        run.sort()
        phrases, n = zip(*run)
        values = (slot, lang, pack(b"\n".join(phrases)), pack(np.array(n, np.uint64).tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, RUNS)], schema=RUNS)


def _words(slots: int, entries: int):
    """Runs of single words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[str, Counter] = defaultdict(Counter)

        def spilled():
            yield from run_rows(((lang, word, word, n) for lang, table in tables.items() for word, n in table.items()), slots)
            tables.clear()

        for rows in batches:
            for lang, text in zip(*(c.to_pylist() for c in rows.columns)):
                tables[lang].update(words_of(spoken([text])))
                if sum(map(len, tables.values())) > entries:
                    yield from spilled()
        yield from spilled()

    return run


def _hashes(slots: int, entries: int, words_filter, pairs_filter=None):
    """Runs of the hashes of pairs of frequent words, or, with ``pairs_filter``, of the longer phrases made of frequent pairs.

    A hash's first bits decide its slot.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, found, held = Filter(words_filter.value), [], 0
        pairs = None if pairs_filter is None else Filter(pairs_filter.value)
        pack = zstandard.ZstdCompressor(level=1).compress

        def spilled():
            keys, n = np.unique(np.concatenate(found), return_counts=True)
            n = n.astype(np.uint32)
            slot = ((keys >> np.uint64(32)) * np.uint64(slots) >> np.uint64(32)).astype(np.int32)
            starts = np.flatnonzero(np.diff(slot, prepend=-1))
            for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(keys)]):
                values = (int(slot[start]), keys[start:end].tobytes(), pack(n[start:end].tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, HASH_RUNS)], schema=HASH_RUNS)

        for rows in batches:
            for lang, said in by_language(rows).items():
                h, piece = hashed(lang, said)
                at = frequent_pairs(h, piece, frequent)
                heard = [pair_hash(h[at], h[at + 1])]
                if pairs is not None:
                    three = longer(at[pairs(heard.pop())])
                    heard = [long_hash(h, three, 3), long_hash(h, longer(three), 4)]
                found += heard
                held += sum(map(len, heard))
                if held > HASHED * entries:
                    yield from spilled()
                    found, held = [], 0
        if held:
            yield from spilled()

    return run


def _frequent_hashes(least: int):
    """Rows come by slot; yields the filter's places of the hashes found ``least`` times or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, runs = None, []
        unpack = zstandard.ZstdDecompressor().decompress

        def done():
            keys, n = (np.concatenate(c) for c in zip(*runs))
            order = np.argsort(keys)
            keys = keys[order]
            starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            often = keys[starts[np.add.reduceat(n[order], starts, dtype=np.int64) >= least]]
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(Filter.places(often)).astype(np.int64))], names=["place"])

        for rows in batches:
            for slot, hashes, counts in zip(*(c.to_pylist() for c in rows.columns)):
                if slot != now and runs:
                    yield done()
                    runs = []
                now = slot
                runs.append((np.frombuffer(hashes, np.uint64), np.frombuffer(unpack(counts), np.uint32)))
        if runs:
            yield done()

    return run


def _phrases(slots: int, entries: int, burst: int, words_filter, pairs_filter, longer_filter):
    """Runs of the phrases of two to four words whose hashes and whose parts' hashes the filters hold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, pairs, long = Filter(words_filter.value), Filter(pairs_filter.value), Filter(longer_filter.value)
        words, trie = Words(), HatTrie(burst)
        waiting = {size: [] for size in range(2, LONGEST + 1)}

        def added():
            for found in waiting.values():
                if found:
                    trie.add(*distinct([np.concatenate(c) for c in zip(*found)]))
                    found.clear()

        def spilled(keep):
            names, langs = words.names, words.langs

            def named():
                for phrase, n in trie.taken(keep):
                    said = b" ".join([names[w] for w in phrase])
                    yield langs[phrase[0]], said if len(phrase) <= PREFIX else b" ".join([names[w] for w in phrase[:PREFIX]]), said, n

            yield from run_rows(named(), slots)

        def listen(lang, said):
            h, piece = hashed(lang, said)
            at = frequent_pairs(h, piece, frequent)
            at = at[pairs(pair_hash(h[at], h[at + 1]))]
            used = np.zeros(len(h), bool)
            used[at] = used[at + 1] = True
            numbers = np.zeros(len(h), np.uint64)
            numbers[used] = words(lang, compress(words_of(said), used.tobytes()), int(used.sum()))
            for size, found in waiting.items():
                if size > 2:
                    at = longer(at)
                    at = at[long(long_hash(h, at, size))]
                found.append([numbers[at + k] for k in range(size)])

        held = 0
        for rows in batches:
            for lang, said in by_language(rows).items():
                listen(lang, said)
                held += len(waiting[2][-1][0])
                if held <= min(WAITING, entries):
                    continue
                added()
                held = 0
                if len(words.names) > KNOWN:
                    yield from spilled(0)
                    words, trie = Words(), HatTrie(burst)
                elif trie.entries > entries:
                    yield from spilled(entries // 2)
        added()
        yield from spilled(0)

    return run


def merged(runs: list[tuple[list[bytes], np.ndarray]]) -> tuple[list[bytes], np.ndarray]:
    """Sorted runs as one, equal phrases added up; the sort is a merge, as it finds the runs."""
    keys = [p for phrases, _ in runs for p in phrases]
    n = np.concatenate([c for _, c in runs])
    order = sorted(range(len(keys)), key=keys.__getitem__)
    keys = [keys[k] for k in order]
    starts = [0, *(k for k in range(1, len(keys)) if keys[k] != keys[k - 1])]
    return [keys[k] for k in starts], np.add.reduceat(n[order], starts)


def _merge(least: int, totals: bool):
    """Rows come by prefix partition and language; yields counts of ``least`` or more, and of all words as one row without phrase."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, runs = None, []

        def done():
            phrases, n = merged(runs)
            often = np.flatnonzero(n >= least)
            names, counts = [phrases[k] for k in often], n[often].tolist()
            if totals:
                names.append(None)
                counts.append(int(n.sum()))
            columns = ([now[1]] * len(names), names, counts)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, COUNTS)], schema=COUNTS)

        unpack = zstandard.ZstdDecompressor().decompress
        for rows in batches:
            for slot, lang, phrases, counts in zip(*(c.to_pylist() for c in rows.columns)):
                if (slot, lang) != now and runs:
                    yield done()
                    runs = []
                now = slot, lang
                runs.append((unpack(phrases).split(b"\n"), np.frombuffer(unpack(counts), np.uint64).astype(np.int64)))
        if runs:
            yield done()

    return run


def _filter_places(pairs: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for lang, said in by_language(rows).items():
                h = hashed(lang, said)[0]
                h = pair_hash(h[::2], h[1::2]) if pairs else h
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(Filter.places(h)).astype(np.int64))], names=["place"])

    return run


def filter_of(frequent: DataFrame, pairs: bool):
    """Broadcast filter of (lang, phrase)."""
    return filter_of_places(frequent.select("lang", "phrase").mapInArrow(_filter_places(pairs), "place long"))


def frequent_phrases(docs: DataFrame, least: int = LEAST, entries: int = ENTRIES, burst: int = BURST) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, words, n) of all phrases of up to four words found ``least`` times or more, (lang, n) of all words).

    Four passes, each cutting what the next has to count, as no part of a frequent phrase is rarer
    than the phrase: words, hashes of pairs of frequent words, hashes of longer phrases made of
    frequent pairs, then in tries the phrases that are left. Tasks know what is frequent by filters
    of fixed size; a false hit or an equal hash costs a count, no phrase is lost and counts are of
    words, not of hashes. What is shuffled are sorted runs of distinct hashes or phrases. A prefix
    partition holds few phrases of each common word, as three words decide it.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text")
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slots = max(partitions(spark), 1 + size // SLOT_BYTES)

    def dealt(task, ddl, *order):
        return rows.mapInArrow(task, ddl).repartition(min(slots, MOST_PARTITIONS), "slot").sortWithinPartitions(*order)

    def counted(task, name, totals=False):
        return stored(dealt(task, RUNS_DDL, "slot", "lang").mapInArrow(_merge(least, totals), COUNTS_DDL), name)

    def hashes_filter(task):
        return filter_of_places(dealt(task, HASH_RUNS_DDL, "slot").mapInArrow(_frequent_hashes(least), "place long"))

    words = counted(_words(slots, entries), "words", totals=True)
    often = words.where("phrase IS NOT NULL")
    words_filter = filter_of(often, pairs=False)
    pairs_filter = hashes_filter(_hashes(slots, entries, words_filter))
    longer_filter = hashes_filter(_hashes(slots, entries, words_filter, pairs_filter))
    phrases = counted(_phrases(slots, entries, burst, words_filter, pairs_filter, longer_filter), "phrases")
    found = often.unionByName(phrases).select("lang", F.col("phrase").cast("string").alias("phrase"), "n")
    return found.withColumn("words", F.split("phrase", " ")), words.where("phrase IS NULL").groupBy("lang").agg(F.sum("n").alias("n"))


def collocations(docs: DataFrame, least: int = LEAST, share: int = SHARE, top: int = TOP, entries: int = ENTRIES, burst: int = BURST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of every language.

    ``score`` is that of the lowest-scoring cut (ties: the earliest cut), l and r are the counts of
    its parts. Phrases of which a longer one holds ``share`` percent of the occurrences are left
    out. A null language is ``und``, a null text empty; an empty table gives no rows. Rows that
    repeat count as often.
    """
    found, totals = frequent_phrases(docs, least, entries, burst)
    found = stored(found, "frequent")
    candidates = found.where(F.size("words") > 1)
    cuts = candidates.select(
        "lang", "phrase", F.col("n").alias("a"), "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k")
    ).select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("words", F.col("k") + 1, F.size("words")), " ").alias("rest"),
    )
    part = lambda name, count: found.select("lang", F.col("phrase").alias(name), F.col("n").alias(count))
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    cuts = cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"])
    cuts = cuts.withColumn("product", F.lit(SCALE).cast("decimal(8,0)") * wide("a")).withColumn("parts", wide("l") + wide("r"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(F.expr("product div parts").alias("score"), "k", "l", "r")).alias("cut"))
    inner = candidates.where(F.size("words") > 2).select(
        "lang", "words", "n", F.explode(F.sequence(F.lit(2), F.size("words") - 1)).alias("size")
    ).select("lang", "words", "n", "size", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("size") + 1)).alias("at"))
    inner = inner.groupBy("lang", F.array_join(F.slice("words", F.col("at"), F.col("size")), " ").alias("phrase")).agg(F.max("n").alias("longer"))
    hidden = F.coalesce(wide("longer") * F.lit(100) >= wide("a") * F.lit(share), F.lit(False))
    kept = scored.join(inner, ["lang", "phrase"], "left").where(~hidden)
    order = F.desc("score"), F.desc("a"), "phrase"
    ranked = kept.select("lang", "phrase", "a", "cut.l", "cut.r", F.col("cut.score").cast("long").alias("score"))
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(RANKERS))).orderBy(*order)  # few rows are left for a language's own task
    ranked = ranked.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= top)
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
