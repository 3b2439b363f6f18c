"""Substring dedup: recurring passages, sharded phrase automata, every occurrence in every document."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.text import WordHashes, batch, filter_of_ids, held_by, mixed, partitions, rolling, stored, words

WINDOW = 50  # words
ANCHOR = 16  # words of an anchor; one of the WINDOW - ANCHOR + 1 in a window is its least
PHRASE = 8  # words of a phrase of the automaton
STRIDE = WINDOW - PHRASE + 1  # phrases of a passage start so far apart: any window holds one
SHARD_BYTES = 6_000_000  # passages of one automaton
TASK_DOCS = 4000  # documents that one task streams through an automaton, about
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def anchors(h: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors: the leftmost least run of ``ANCHOR`` words in each window."""
    grams = rolling(h, ANCHOR)
    width = window - ANCHOR + 1
    if len(grams) < width:
        return np.empty(0, np.int64), grams[:0]
    least, have = mixed(grams), 1
    values = least
    at = np.arange(len(grams))
    while have < width:  # positions of the least of ``have`` grams, doubled
        step = min(have, width - have)
        left, right = at[: len(at) - step], at[step:]
        at = np.where(values[right] < values[left], right, left)
        have += step
    at = np.unique(at)
    return at, grams[at]


def windows(h: np.ndarray) -> np.ndarray:
    return rolling(h, WINDOW)


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    schema = pa.schema([("anchor", pa.int64()), ("ord", pa.int64()), ("h1", pa.int64()), ("position", pa.int32())])
    for rows in batches:
        out = [[], [], [], []]
        for order, h1, text in zip(*(c.to_pylist() for c in rows.columns)):
            items = (text or b"").split()
            if len(items) >= WINDOW:
                at, found = anchors(hashes(items))
                out[0].append(found.view(np.int64))
                out[1].append(np.full(len(at), order))
                out[2].append(np.full(len(at), h1))
                out[3].append(at.astype(np.int32))
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), f.type) for x, f in zip(out, schema)], schema=schema)


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of the windows that hold a recurring anchor."""
    hashes = WordHashes()
    schema = pa.schema([("window", pa.int64()), ("ord", pa.int64())])
    width = WINDOW - ANCHOR + 1
    for rows in batches:
        for order, text, positions in zip(*(c.to_pylist() for c in rows.columns)):
            found = windows(hashes(text.split()))
            near = np.zeros(len(found) + 1, np.int32)
            at = np.asarray(positions, np.int64)
            np.add.at(near, np.maximum(at - width + 1, 0), 1)
            np.add.at(near, np.minimum(at + 1, len(found)), -1)
            found = np.unique(found[np.cumsum(near)[:-1] > 0]).view(np.int64)
            yield batch(schema, window=found, ord=np.full(len(found), order))


def _passage_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Longest runs of the windows that a document is the first to have."""
    hashes = WordHashes()
    schema = pa.schema([("owner", pa.int64()), ("passage", pa.binary())])
    for rows in batches:
        owners, texts = [], []
        for order, text, own in zip(*(c.to_pylist() for c in rows.columns)):
            items = text.split()
            h = hashes(items)
            mine = np.flatnonzero(np.isin(windows(h), np.asarray(own, np.int64).view(np.uint64)))
            if not len(mine):
                continue
            for run in np.split(mine, np.flatnonzero(np.diff(mine) > 1) + 1):
                owners.append(order)
                texts.append(b" ".join(items[run[0] : run[-1] + WINDOW]))
        yield batch(schema, owner=owners, passage=texts)


class Phrases:
    """The passages of a shard and an automaton over phrases that lie ``STRIDE`` words apart in them."""

    def __init__(self):
        self.hashes, self.owners, self.passages = WordHashes(), [], []
        self.places: dict[str, dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
        self.automaton = None

    def add(self, owner: int, passage: bytes) -> None:
        items = passage.split()
        number = len(self.owners)
        self.owners.append(owner)
        self.passages.append(self.hashes(items))
        for at in range(0, len(items) - PHRASE + 1, STRIDE):
            self.places[_spaced(items[at : at + PHRASE])][owner].append((number, at))

    def compile(self) -> None:
        self.automaton = ahocorasick.Automaton()
        for phrase, places in self.places.items():
            self.automaton.add_word(phrase, places)
        self.automaton.make_automaton()

    def spans(self, owners: list[int], text: bytes) -> list[tuple[int, int]]:
        """Runs of at least ``WINDOW`` words of a text that also stand in a passage of ``owners``."""
        if not self.owners:
            return []
        wanted = set(owners)
        items = text.split()
        h, flat = self.hashes(items), _spaced(items)
        starts = np.cumsum([0, *(len(w.decode("utf-8", "surrogateescape")) + 1 for w in items)])
        found, done = [], {}
        for end, places in self.automaton.iter(flat):
            if wanted.isdisjoint(places):
                continue
            last = int(np.searchsorted(starts, end))  # the phrase ends before word ``last``
            here = last - PHRASE
            for number, at in (x for owner in wanted.intersection(places) for x in places[owner]):
                if done.get((number, here - at), -1) >= last:
                    continue
                passage = self.passages[number]
                back, on = min(here, at), min(len(h) - here, len(passage) - at)
                wrong = np.flatnonzero(h[here - back : here] != passage[at - back : at])
                first = here - back + (int(wrong[-1]) + 1 if len(wrong) else 0)
                wrong = np.flatnonzero(h[here : here + on] != passage[at : at + on])
                until = here + (int(wrong[0]) if len(wrong) else on)
                done[number, here - at] = until
                if until - first >= WINDOW:
                    found.append((first, until))
        return joined(found)


def _spaced(items: list[bytes]) -> str:
    return (b" " + b" ".join(items) + b" ").decode("utf-8", "surrogateescape")


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for first, until in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], until)
        else:
            out.append([first, until])
    return [tuple(x) for x in out]


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by (shard, salt): first the passages, then the documents, which only stream by."""
    schema = pa.schema([("ord", pa.int64()), ("h1", pa.int64()), ("firsts", pa.list_(pa.int32())), ("untils", pa.list_(pa.int32()))])
    key, phrases = None, None
    for rows in batches:
        out = [[], [], [], []]
        for shard, salt, kind, order, h1, owners, text in zip(*(c.to_pylist() for c in rows.columns)):
            if (shard, salt) != key:
                key, phrases = (shard, salt), Phrases()
            if kind == 0:
                phrases.add(order, text)
                continue
            if phrases.automaton is None:
                phrases.compile()
            spans = phrases.spans(owners, text)
            if spans:
                for column, value in zip(out, (order, h1, [s[0] for s in spans], [s[1] for s in spans])):
                    column.append(value)
        yield batch(schema, ord=out[0], h1=out[1], firsts=out[2], untils=out[3])


def _keyed(docs: DataFrame) -> DataFrame:
    """Adds the order of documents (no id: after all others) and two hashes of the text."""
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)).alias("ord"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    ).select("*", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"))


def marked(docs: DataFrame, whole: bool) -> DataFrame:
    """Every row with what is known after the first pass, written once.

    ``copy``: an equal text has a smaller id; ``positions``: of anchors that another text has too,
    else null. The text stays with rows that have positions, or within all rows if ``whole``. Only rows
    that a filter of fixed size takes for marked are shuffled to their marks; the others stay in place.
    """
    keyed = _keyed(docs)
    texts = keyed.select("ord", "h1", F.col("text").cast("binary").alias("text"))
    found = stored(texts.mapInArrow(_anchor_rows, "anchor long, ord long, h1 long, position int"), "anchors")
    shared = found.groupBy("anchor").agg(F.min("h1").alias("a"), F.max("h1").alias("b")).where("a <> b")
    shared = stored(shared.select("anchor"), "shared")  # as files, so that a common anchor's rows can be split in the join
    marks = stored(found.join(shared, "anchor"), "marks")
    ids = keyed.select("ord", "h1", "h2")
    first = ids.groupBy("h1", "h2").agg(F.min("ord").alias("first"), F.max("ord").alias("last")).where("first < last")
    copies = ids.join(first, ["h1", "h2"]).where("ord > first").select("ord", "h1").distinct()
    positions = marks.join(copies, ["ord", "h1"], "left_anti").groupBy("ord", "h1").agg(F.collect_set("position").alias("positions"))
    known = positions.withColumn("copy", F.lit(False)).unionByName(
        copies.select("ord", "h1", F.lit(None).cast("array<int>").alias("positions"), F.lit(True).alias("copy"))
    )
    known = stored(known, "known")
    held = held_by(filter_of_ids(known.select("h1")))(F.col("h1"))
    lean = keyed.select("row", "ord", "h1")  # the text goes along once, within the row
    rows = lean.where(held).join(known, ["ord", "h1"], "left").unionByName(lean.where(~held), allowMissingColumns=True)
    rows = rows.withColumn("text", F.coalesce(F.col("row.text"), F.lit("")))
    found = words(F.col("text"))
    rows = rows.select(
        (F.col("row") if whole else F.struct(F.col("row.doc_id").alias("doc_id"))).alias("row"), "ord", "h1", "positions",
        F.coalesce("copy", F.lit(False)).alias("copy"), *([] if whole else [F.when(F.col("positions").isNotNull(), F.col("text")).alias("text")]),
        F.size(found).cast("long").alias("n_words"), *([] if whole else [F.sha2(F.array_join(found, " "), 256).alias("sha")]),
    )
    rows = stored(rows, "marked")
    return rows.withColumn("text", F.coalesce(F.col("row.text"), F.lit(""))) if whole else rows


def occurrences(candidates: DataFrame) -> DataFrame:
    """(ord, h1, firsts, untils): word spans of the candidates that a document before them has too.

    Windows that hold a shared anchor are counted by hash; those in two documents are recurring,
    and the first document with one owns it. Runs of owned windows are the passages, dealt to
    shards by owner. A document is sent to the shards of the owners that it meets in some window,
    and a shard with many documents is salted, its passages going along.
    """
    spark = candidates.sparkSession
    texts = candidates.select("ord", "h1", F.col("text").cast("binary").alias("text"), "positions")
    found = texts.select("ord", "text", "positions").mapInArrow(_window_rows, "window long, ord long")
    recurring = found.groupBy("window").agg(F.min("ord").alias("owner"), F.max("ord").alias("last")).where("owner < last")
    recurring = stored(recurring.select("window", "owner"), "recurring")
    owned = recurring.groupBy(F.col("owner").alias("ord")).agg(F.collect_list("window").alias("windows"))
    passages = stored(
        texts.select("ord", "text").join(owned, "ord").mapInArrow(_passage_rows, "owner long, passage binary"), "passages"
    )
    total = passages.agg(F.sum(F.octet_length("passage"))).first()[0] or 0
    shards = 1 + total // SHARD_BYTES
    shard = F.pmod(F.xxhash64("owner"), F.lit(shards)).cast("int")
    passages = passages.withColumn("shard", shard)
    pairs = found.join(recurring, "window").where("owner < ord").select("ord", "owner").distinct()
    routes = stored(pairs.groupBy("ord", shard.alias("shard")).agg(F.collect_list("owner").alias("owners")), "routes")
    salts = routes.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / TASK_DOCS).cast("int").alias("salts"))
    streamed = routes.join(salts, "shard").join(texts.drop("positions"), "ord").select(
        "shard", F.pmod(F.xxhash64("ord"), F.col("salts")).cast("int").alias("salt"), F.lit(1).alias("kind"), "ord", "h1", "owners", "text"
    )
    patterns = passages.join(salts, "shard").select(
        "shard", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("kind"),
        F.col("owner").alias("ord"), F.lit(0).cast("long").alias("h1"),
        F.array().cast("array<long>").alias("owners"), F.col("passage").alias("text"),
    )
    dealt = patterns.union(streamed).repartition(partitions(spark), "shard", "salt").sortWithinPartitions("shard", "salt", "kind")
    spans = dealt.mapInArrow(_occurrences, "ord long, h1 long, firsts array<int>, untils array<int>")
    return stored(spans, "spans").groupBy("ord", "h1").agg(
        F.flatten(F.collect_list("firsts")).alias("firsts"), F.flatten(F.collect_list("untils")).alias("untils")
    )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])
    for rows in batches:
        out = [[], [], [], []]
        for doc, text, firsts, untils in zip(*(c.to_pylist() for c in rows.columns)):
            items, kept, at = text.split(), [], 0
            for first, until in joined(list(zip(firsts or (), untils or ()))):
                kept += items[at:first]
                at = until
            kept += items[at:]
            for column, value in zip(out, (doc, len(items), len(items) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest())):
                column.append(value)
        yield batch(schema, doc_id=out[0], n_words=out[1], n_removed=out[2], kept_sha256=out[3])


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of ``spans`` and the space after them; other space stays as it is."""
    at = [m.span() for m in WORD.finditer(text)]
    out, last = [], 0
    for first, until in spans:
        out.append(text[last : at[first][0]])
        last = at[until][0] if until < len(at) else len(text)
    return b"".join([*out, text[last:]])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("ord", pa.int64()), ("h1", pa.int64()), ("cut", pa.binary())])
    for rows in batches:
        orders, hashes, texts, firsts, untils = (c.to_pylist() for c in rows.columns)
        cut = [without(t, joined(list(zip(f, u)))) for t, f, u in zip(texts, firsts, untils)]
        yield batch(schema, ord=orders, h1=hashes, cut=cut)


def dedup_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row of ``docs``.

    Null and empty texts have no words. An equal text with a smaller id takes away all words of a
    text of ``WINDOW`` words or more. Rows with the same id never take words from each other; a row
    without id comes after all others. An empty table gives no rows.
    """
    rows = marked(docs, whole=False)
    gone = F.col("copy") & (F.col("n_words") >= WINDOW)
    plain = rows.where("positions IS NULL").select(
        "row.doc_id", "n_words", F.when(gone, F.col("n_words")).otherwise(0).alias("n_removed"),
        F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.col("sha")).alias("kept_sha256"),
    )
    candidates = rows.where("positions IS NOT NULL")
    spans = occurrences(candidates)
    cut = candidates.join(spans, ["ord", "h1"], "left").select(
        F.col("row.doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary"), "firsts", "untils"
    )
    return plain.unionByName(cut.mapInArrow(_digests, "doc_id long, n_words long, n_removed long, kept_sha256 string"))


def cut_repeats(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, columns unchanged, with repeated passages taken out of their texts.

    ``n_chars``, if there, follows the new text. Texts that lose all words go; texts that had none stay.
    """
    rows = marked(docs, whole=True)
    candidates = rows.where("positions IS NOT NULL")
    spans = occurrences(candidates)
    touched = candidates.select("ord", "h1", F.col("text").cast("binary").alias("text")).dropDuplicates(["ord", "h1"])
    cut = touched.join(spans, ["ord", "h1"]).mapInArrow(_cut, "ord long, h1 long, cut binary")
    rows = rows.where(~(F.col("copy") & (F.col("n_words") >= WINDOW))).join(cut, ["ord", "h1"], "left")
    rows = rows.where("cut IS NULL OR octet_length(cut) > 0")
    changed = F.col("cut").isNotNull()
    out = []
    for c in docs.columns:
        value = F.col("row")[c]
        if c == "text":
            value = F.when(changed, F.col("cut").cast("string")).otherwise(value)
        elif c == "n_chars":
            value = F.when(changed, F.length(F.col("cut").cast("string")).cast(docs.schema[c].dataType)).otherwise(value)
        out.append(value.alias(c))
    return rows.select(*out)
