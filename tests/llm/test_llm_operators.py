"""Edge rows and brute-force comparisons of the training-data operators."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import binfill, compression, decontaminate, interpolation, licences, neardup, packing, pages, phrases, quality, shards
from millrace.llm.stars import components
from millrace.llm.text import filter_of_ids, held_by, release, small_batches, stored

DOCS = "doc_id long, text string, lang string, n_words long"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(400)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage = text(70)
    long_text = text(3000)
    base = [text(120) for _ in range(6)]
    out = [(k, t, "en", 1) for k, t in enumerate(base)]
    out += [(10 + k, t, "en", 1) for k, t in enumerate(base[:3])]  # copies
    out += [(20, base[0] + " " + words[3], "en", 1), (21, base[1].replace(" ", "\n"), None, 1)]  # near copies
    out += [(30 + k, text(60) + "\n" + passage + " " + text(20), "en", 1) for k in range(4)]
    out += [(40, None, "en", 1), (41, "", "en", 1), (42, " \t\n ", "en", None), (43, long_text, "en", 1), (None, text(90), "en", 1)]
    out += [(44, "One  two\x0bthree", "en", 1)] * 2
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    small_batches(spark)
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def items(text):
    return (text or "").encode().split()


def test_quality_counts_and_edges(docs, rows, empty):
    got = {r["doc_id"]: r for r in quality.score_documents(docs).collect()}
    for doc, text, _, _ in rows:
        w = items(text)
        seen = Counter(zip(w, w[1:], w[2:]))
        covered = {i + k for i, x in enumerate(zip(w, w[1:], w[2:])) if seen[x] > 1 for k in range(3)}
        r = got[doc]
        assert (r["n_words"], r["n_repeat_words"]) == (len(w), len(covered))
        assert r["word_chars"] == sum(len(x.decode()) for x in w)
        assert not (r["base_failed"] and r["kept"])
    assert quality.score_documents(empty).count() == 0
    assert quality.keep_good(docs).columns == docs.columns


def test_repeated_words_by_sort_equal_those_by_list(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abcd") for _ in range(n)) for n in (3, 30, 200, 2000)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in quality.base_counts(frame).collect():
        w = texts[r["doc_id"]].split()
        seen = Counter(zip(w, w[1:], w[2:]))
        assert r["n_repeat_words"] == len({i + k for i, x in enumerate(zip(w, w[1:], w[2:])) if seen[x] > 1 for k in range(3)})


def test_near_duplicates_equal_brute_force(docs, rows, empty):
    sets, parent = {}, {}
    for doc, text, _, _ in rows:
        w = items(text.lower() if text and text.isascii() else text)
        s = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
        if doc is not None:
            sets[doc] = s
            parent.setdefault(doc, doc)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    for r in neardup.near_duplicates(docs).collect():
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert r["component_id"] == find(r["doc_id"]) and r["kept"] == (find(r["doc_id"]) == r["doc_id"])
            assert r["n_shingles"] == len(sets[r["doc_id"]])
    assert neardup.near_duplicates(empty).count() == 0
    assert neardup.keep_first(docs).columns == docs.columns


@pytest.mark.parametrize("block", [None, 100])
def test_a_crowded_bucket_keeps_pairs_that_share_no_other_band(spark, monkeypatch, block):
    """1,500 documents in one bucket, each its own component; two of them are near copies with that one band in common."""
    if block:
        monkeypatch.setattr(neardup, "BLOCK", block, raising=False)
    rng, count = random.Random(3), 1500
    sets = {n: [20 * n + k for k in range(20)] for n in range(count)}
    sets[900] = [*sets[77][:19], 10**6]
    bands = spark.createDataFrame([(7, n, 0) for n in range(count)], "key long, node long, band int")
    classes = spark.createDataFrame([(n, 20, bytes(16) + rng.randbytes(496)) for n in range(count)], "node long, n_shingles long, minima binary")
    none = spark.createDataFrame([], "node long, root long")
    kept = spark.createDataFrame([(n, s) for n, s in sets.items()], "doc_id long, shingles array<long>")
    found = neardup._open_pairs(bands, none, none.toDF("u", "v"), classes, kept)
    assert [tuple(r) for r in neardup._confirmed(found, kept).collect()] == [(77, 900)]


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 60)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got[k] == 0 for k in range(41)) and all(got[100 + k] == 100 for k in range(60))


def test_substring_dedup_equals_brute_force(docs, rows, empty):
    order = lambda d: 2**63 - 1 if d is None else d
    first = {}
    for doc, text, _, _ in rows:
        w = items(text)
        for i in range(len(w) - 49):
            key = tuple(w[i : i + 50])
            first[key] = min(first.get(key, order(doc)), order(doc))
    want = {}
    for doc, text, _, _ in rows:
        w = items(text)
        gone = {i + k for i in range(len(w) - 49) if first[tuple(w[i : i + 50])] < order(doc) for k in range(50)}
        want[doc] = (len(w), len(gone))
    got = phrases.dedup_digests(docs).collect()
    assert len(got) == len(rows) and any(n for _, n in want.values())
    assert all((r["n_words"], r["n_removed"]) == want[r["doc_id"]] for r in got)
    cut = phrases.cut_repeats(docs)
    assert cut.columns == docs.columns
    assert all(len(items(r["text"])) == want[r["doc_id"]][0] - want[r["doc_id"]][1] for r in cut.collect())
    assert phrases.dedup_digests(empty).count() == 0


def test_phrases_find_parts_of_passages():
    rng = random.Random(1)
    passage = [b"%d" % rng.randint(0, 30) for _ in range(200)]
    table = phrases.Phrases()
    table.add(1, b" ".join(passage))
    table.compile()
    for at, size in [(0, 50), (37, 50), (100, 100), (151, 49), (3, 51)]:
        text = [b"x"] * 5 + passage[at : at + size] + [b"y"] * 3
        assert table.spans([1], b" ".join(text)) == ([(5, 5 + size)] if size >= 50 else [])
        assert table.spans([2], b" ".join(text)) == []


def test_decontamination_finds_items_and_only_them(spark, docs, empty):
    tests = [(1, "What is red green blue yellow? The answer is nine and eleven. Or is it."), (2, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi."), (2, ""), (3, None), (None, "no id")]
    bench = spark.createDataFrame(tests, "item_id long, text string")
    hit = "some words before " + tests[0][1].upper() + " and after " * 200
    late = "lorem ipsum " * 300 + tests[1][1] + " dolor" * 50
    half = "Alpha beta gamma delta epsilon zeta then something else"
    own = spark.createDataFrame([(1, hit, "", 1), (2, late, "", 1), (3, half, "", 1)], DOCS).union(docs)
    got = {r["doc_id"]: r["item_ids"] for r in decontaminate.leaks(own.where("doc_id < 4 OR doc_id > 9 OR doc_id IS NULL"), bench).collect() if r["item_ids"]}
    assert got == {1: [1], 2: [2]}
    assert decontaminate.leaks(empty, bench).count() == 0
    assert decontaminate.drop_leaks(docs, bench.limit(0)).count() == docs.count()


def test_items_of_more_than_one_part_leak_as_a_whole(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(7))
    question, answer = [word() for _ in range(500)], [word() for _ in range(13)]
    item = " ".join(question) + ". " + " ".join(answer) + "."
    longer = " ".join(word() for _ in range(1400))  # one sentence: the answer is its last third
    filler = lambda n: " ".join(word() for _ in range(n))
    texts = {
        1: filler(300) + " " + item + " " + filler(900), 2: filler(30) + " " + answer[-1] + " " + filler(30), 3: filler(9) + " " + " ".join(question),
        4: " ".join(answer), 5: filler(700) + " " + longer, 6: " ".join(longer.split()[:700]), 7: " ".join(reversed(item.split())), 8: "",
    }
    bench = spark.createDataFrame([(1, item), (2, longer), (3, "Short one of some words here. And an answer.")], "item_id long, text string")
    docs = spark.createDataFrame([(k, t, "", 1) for k, t in texts.items()], DOCS)
    assert {r["doc_id"]: r["item_ids"] for r in decontaminate.leaks(docs, bench).collect() if r["item_ids"]} == {1: [1], 5: [2]}
    assert sorted(r["doc_id"] for r in decontaminate.drop_leaks(docs, bench).collect()) == [2, 3, 4, 6, 7, 8]


def test_block_max_wand_equals_full_scoring():
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(60)]
    tests = [(k, " ".join(rng.choices(vocabulary, k=rng.randint(3, 12)))) for k in range(90)]
    holders = Counter(t for _, x in tests for t in set(decontaminate.terms(x)))
    index, = decontaminate.build(tests, len(tests), 8.0, holders)
    for _ in range(60):
        query = rng.sample(range(len(index.vocabulary)), 25)
        totals = np.zeros(len(index.items))
        for t in query:
            for i, w in zip(*index.postings[t]):
                totals[i] += w
        for threshold in (0.3, 0.6):
            assert sorted(i for i, _ in index.search(query, threshold)) == [i for i, s in enumerate(totals) if s >= threshold]


def test_packing_is_gapless_and_restores_every_document(docs, rows):
    got = packing.pack(docs, capacity=256).collect()
    by_doc, by_sequence = Counter(), {}
    for r in got:
        by_doc[r["doc_id"]] += r["length"]
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    encode = packing.encoder(packing.tokenizer_definition())
    want = Counter()
    for doc, text, _, _ in rows:
        want[doc] += len(encode(text or "")) // 4 + 1
    assert by_doc == want
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256


def test_chunks_give_the_ids_of_the_whole_text():
    encode = packing.encoder(packing.tokenizer_definition())
    rng = random.Random(4)
    texts = ["", " ", "a  b", " a b ", "\x1c b \x85c", "don't  stop <|endoftext|>"]
    texts += [" ".join(rng.choice(["", " ", "a", "b1", "\n", "é", "'s", "　", "..."]) for _ in range(12)) for _ in range(300)]
    for text in texts:
        want = encode.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encode(text), "<u4").tolist() == want


def test_added_tokens_have_their_own_ids():
    definition = packing.tokenizer_definition()
    fresh, encode = packing.Tokenizer.from_str(definition), packing.encoder(definition)
    ids = lambda text: np.frombuffer(encode(text), "<u4").tolist()
    assert ids("end <|endoftext|> next") == [437, 220, 50256, 1306]
    for text in ("<|endoftext|>", "a b<|endoftext|>c  d", " <|endoftext|><|endoftext|> ", "<|endoftext |>", "no token", "x <|endoftext|"):
        assert ids(text) == fresh.encode(text, add_special_tokens=False).ids


def test_bin_plans_hold_every_item():
    rng = random.Random(6)
    for n in (0, 1, 50, 2000):
        counts = Counter(rng.randint(1, 100) for _ in range(n))
        plan = binfill.plan(counts, 100)
        held = Counter()
        for filling, times in plan.bins:
            assert sum(filling) <= 100
            for size in filling:
                held[size] += times
        assert held == counts and plan.count >= plan.bound


def test_language_model_base_equals_brute_force(docs, rows, empty):
    known = lambda d: d is None or zlib.crc32(str(d).encode()) % 10
    texts = [(d, [*(t or "").encode().lower().split(), None]) for d, t, _, _ in rows]
    c = Counter(x for d, w in texts if known(d) for x in w)
    n, v = sum(c.values()), len(c)
    want = {d: (len(w), sum(c[x] > 0 for x in w), sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)) for d, w in texts}
    for r in interpolation.score_documents(docs).collect():
        tokens, seen, base = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (tokens, seen, n)
        assert r["base_score"] == pytest.approx(base) and r["score"] < 0 and r["held_out"] == (not known(r["doc_id"]))
    assert interpolation.score_documents(empty).count() == 0


def test_pages_keep_the_article_and_lose_what_neighbours_share(spark):
    small_batches(spark)
    body = "<html><head><title>t</title></head><body>{}<div>Shared line of the site</div>{}<div>Shared end</div></body></html>"
    table = [
        (1, "http://h.org/a/1", body.format("<nav><a href='/'>x</a></nav>", "<p>First  own &amp; text<p>More <b>bo</b>ld")),
        (2, "http://h.org/a/2", body.format("", "<p>Second own text</p><div class='comments'>me too</div>")),
        (3, "http://g.org/", "<article><h1>Head</h1><p>One<footer>f</footer></article><p>out</p>"),
        (4, None, None), (4, None, None), (5, "nonsense", "<p>a < b <!-- c --> d<script>var x='</p>'</script>"),
    ]
    got = pages.extract(spark.createDataFrame(table, "page_id long, url string, html string")).collect()
    texts = {r["page_id"]: r["text"] for r in got}
    assert len(got) == 6 and all(r["n_chars"] == len(r["text"]) for r in got)
    assert texts == {1: "First own & text\nMore bold", 2: "Second own text", 3: "Head\nOne", 4: "", 5: "a < b d"}


def test_shards_are_contiguous_and_even(docs, rows, empty):
    got = shards.shard_documents(docs, 4).collect()
    total, biggest = sum(r["size"] for r in got), max(r["size"] for r in got)
    sizes = Counter()
    for r in got:
        sizes[r["shard"]] += r["size"]
    assert all(abs(s - total / 4) <= 2 * biggest for s in sizes.values()) and len(got) == len(rows)
    for shard in sizes:
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in got)))
    assert shards.shard_documents(empty).count() == 0


def test_licences_and_unknown(spark, docs):
    texts = ["Some text here.\nReleased under the MIT License.", "Licensed under the Apache License, Version 2.0.", "A licence is a licence.", None]
    frame = docs.select("doc_id", "text").union(spark.createDataFrame([(1000 + k, t) for k, t in enumerate(texts)], "doc_id long, text string"))
    got = {r["doc_id"]: r["licence"] for r in licences.scan(frame).collect()}
    assert [got[1000 + k] for k in range(4)] == ["MIT", "Apache-2.0", "unknown", "unknown"]
    assert all(v == "unknown" for k, v in got.items() if k is None or k < 1000)


def test_wrapped_and_short_licence_notices(spark, docs):
    gpl = """This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version."""
    bsd = """# Redistribution and use in source and binary forms, with or without
    # modification, are permitted provided that the following conditions are
    # met:"""
    lgpl = """ * This library is free software; you can redistribute it and/or
     * modify it under the terms of the GNU Lesser General Public
     * License as published by the Free Software Foundation; either
     * version 2.1 of the License, or (at your option) any later version."""
    mit = "Permission is hereby granted, free of\ncharge, to any person obtaining\na copy of this software and\nassociated documentation files"
    texts = {
        "GPL": [gpl, "Words before.\n" + gpl + "\nWords after.", gpl.replace(" ", "\n"), "Licensed under the GNU General Public License v3.0.", "Distributed under the terms of the\nGNU GPL v2."],
        "BSD": [bsd, "Use of this source code is governed by a BSD-style\nlicense that can be found in the LICENSE file."],
        "LGPL": [lgpl, "Licensed under the GNU Lesser General Public License v2.1."],
        "MIT": [mit, "int x;\nThis code is licensed under the MIT License (see LICENSE)."],
        "Apache-2.0": ["Licensed under the Apache\nLicense, Version 2.0", "Licensed under the Apache License 2.0"],
        "unknown": ["The GNU General Public License was written long ago.", "Licensed\n\nunder the\n\nMIT\n\nLicense", "Free software is a matter of\nthe general public."],
    }
    wanted = [(1000 + k, f, t) for k, (f, t) in enumerate((f, t) for f, many in texts.items() for t in many)]
    frame = docs.select("doc_id", "text").union(spark.createDataFrame([(k, t) for k, _, t in wanted], "doc_id long, text string"))
    got = {r["doc_id"]: r for r in licences.scan(frame).collect()}
    assert [(k, got[k]["licence"]) for k, _, _ in wanted] == [(k, f) for k, f, _ in wanted]
    assert got[1000]["n_paragraphs"] == 4 and all(r["licence"] == "unknown" for k, r in got.items() if k is None or k < 1000)


def test_compression_classifier_on_held_out_rows(spark):
    small_batches(spark)
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scored = compression.score_documents(docs, labels).join(labels, "doc_id").where("held_out")
    right = scored.agg(F.avg((F.col("predicted") == F.col("quality")).cast("double"))).first()[0]
    assert right > 0.9


def test_repeated_rows_come_out_as_often_from_several_slices(spark):
    said = "which river flows through the old town of vienna and budapest the danube flows through both of them"
    rows = [(1, said), (1, said), (1, "x " + said), (None, said), (None, said), (2, "nothing of the kind"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(k, said if k == 4 else f"item {k} asks for word{k} and gets answer{k} of {k * 7}") for k in range(9)], "item_id long, text string")
    one, three = (
        sorted((repr(r["doc_id"]), r["h1"], r["items"], r["leaks"]) for r in decontaminate.decontaminate(docs, marks, slice_items=n).collect()) for n in (8192, 3)
    )
    assert one == three and len(one) == len(rows) and sum(r[3] == [4] for r in one) == 5


def test_clashing_names_and_release_of_working_tables(spark, tmp_path):
    said = "which river flows through the old town of vienna and budapest the danube flows through both of them"
    rows = [(1, said, 5, 6, 7), (2, "alpha beta gamma delta epsilon zeta " * 3, 5, 6, 7), (3, "alpha beta gamma delta epsilon zeta " * 3, 5, 6, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _id long, _h1 long, _dropped long")
    clean = decontaminate.drop_leaks(docs, spark.createDataFrame([(4, said)], "item_id long, text string"))
    assert sorted(r["doc_id"] for r in clean.collect()) == [2, 3]
    first = neardup.keep_first(docs)
    assert sorted(r["doc_id"] for r in first.collect()) == [1, 2] and first.columns == docs.columns
    first.write.parquet(str(tmp_path / "out"))
    read = spark.read.parquet(str(tmp_path / "out"))
    mine = stored(docs, "mine")
    release(mine)
    assert mine.count() == 3
    release(read)
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist|PATH_NOT_FOUND"):
        mine.count()


def test_filter_of_ids_holds_its_ids(spark):
    ids = spark.range(-500, 500)
    held = held_by(filter_of_ids(ids))
    found = spark.createDataFrame([(k,) for k in range(-1000, 1000)] + [(None,)], "id long").withColumn("held", held("id")).collect()
    assert all(r["held"] for r in found if r["id"] is not None and -500 <= r["id"] < 500)
    assert sum(r["held"] for r in found) < 1010 and not found[-1]["held"]
