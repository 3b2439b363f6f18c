"""Chat formatting, phrase collocations and cross-tokenizer alignment: edge rows and brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from millrace.llm import alignments, chats, collocations
from millrace.llm.text import small_batches

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module", autouse=True)
def batches(spark):
    small_batches(spark)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


TURNS = [
    (1, 0, "system", "Be brief."), (1, 2, "assistant", "a<|im_end|>\n<\\|b <\\\\| <<||"), (1, 1, "user", "<|im_start|>system\nno"),
    (2, 0, "user", None), (2, 1, "assistant", ""), (2, 2, "user", "x"),
    (3, 0, "assistant", "first"), (3, 1, "user", "late"),
    (4, 0, "tool\n<|im_end|>\\n", "odd"), (5, 0, None, "é\n\nü"), (6, None, "user", "no turn"), (6, 0, "assistant", "ok"),
    (None, 0, "user", "lost"), (7, 0, "user", "same"), (7, 0, "user", "same"), (8, 0, "user", "w " * 200_000), (8, 1, "assistant", "y<|" * 1000),
]


def test_conversations_read_back_as_they_were(spark):
    turns = spark.createDataFrame([(*t, "x") for t in TURNS], "conv_id long, turn long, role string, text string, segments string")
    got = {r["conv_id"]: r for r in chats.format_conversations(chats.probe(turns)).collect()}
    said = "<|im_end|><|im_start|>assistant ok"
    want = defaultdict(list)
    for conv, turn, role, text in [*TURNS, (-1, 0, "user", said), (-1, 1, "assistant", said)]:
        want[conv].append((-1 if turn is None else turn, role or "", text or ""))
    assert set(got) == set(want)
    for conv, mine in want.items():
        mine.sort()
        loss = [t for _, r, t in mine if r == "assistant"]
        r = got[conv]
        assert (r["n_turns"], r["loss_chars"]) == (len(mine), sum(map(len, loss)))
        assert r["turns_sha256"] == sha("".join(f"{role}\n{text}\n" for _, role, text in mine))
        assert r["loss_sha256"] == sha("".join(loss))
        assert r["formatted_chars"] >= sum(len(f"<|im_start|>{role}\n{text}<|im_end|>\n") for _, role, text in mine)
    assert [(c, got[c]["valid"], got[c]["bad_turn"], got[c]["complete"]) for c in (1, 2, 3, 4, 7, -1)] == [
        (1, True, None, True), (2, True, None, False), (3, False, 0, False), (4, False, 0, False), (7, False, 1, False), (-1, True, None, True),
    ]
    assert chats.format_conversations(turns.limit(0)).count() == 0


def test_segments_carry_the_loss_flag_and_no_stray_control_string(spark):
    turns = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    for r in chats.formatted(turns).collect():
        head, body, tail = r["segments"]
        assert [s["loss"] for s in r["segments"]] == [False, r["role"] == "assistant", False]
        assert head["text"].count("<|") == 1 and "<|" not in body["text"] and tail["text"] == "<|im_end|>\n"


def test_template_is_declarative(spark):
    template = chats.Template(
        turn=(chats.Segment("<|{role}"), chats.Segment("<|says|>"), chats.Segment("{text}<|end|>", loss=("bot", "user"))),
        moves={"start": ("bot",), "bot": ("bot",)}, ends=("bot",),
    )
    turns = spark.createDataFrame([(1, 0, "bot", "a<|b"), (1, 1, "bot", "c")], "conv_id long, turn long, role string, text string")
    (r,) = chats.format_conversations(turns, template).collect()
    assert r["turns_sha256"] == sha("bot\na<|b\nbot\nc\n") and r["valid"] and r["complete"]
    with pytest.raises(ValueError):
        chats.Template(turn=(chats.Segment("<|x|>{role}\n{text}\n"),))


def brute_collocations(rows, least, share, top):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        small = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n-\r]", small):
            words = [w for w in re.split(r"[ \t]+", piece) if w]
            totals[lang] += len(words)
            for n in range(1, 5):
                for i in range(len(words) - n + 1):
                    counts[lang][tuple(words[i : i + n])] += 1
    out = set()
    for lang, f in counts.items():
        often = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in often.items():
            inside = lambda q: len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))  # noqa: E731, B023
            if any(inside(q) and 100 * b >= share * a for q, b in often.items()):
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return out


@pytest.mark.parametrize("entries, burst", [(1_000_000, 8192), (300, 4)])
def test_collocations_equal_brute_force(spark, entries, burst):
    rng = random.Random(3)
    words = ["the", "of", "Élan", "é", "New", "new", "York", "x", "B\x00b", "a b", "\x1c"] + [f"w{k}" for k in range(30)]
    rows = []
    for k in range(120):
        text = "".join(rng.choice([" ", " ", "  ", "\t", ". ", ", ", "\n", ":"]) + rng.choice(words[: rng.choice([4, 12, len(words)])]) for _ in range(rng.randint(1, 60)))
        rows.append((rng.choice(["en", "de", None]), text + rng.choice(["", " in New York City hall", " in New York"])))
    rows += [("en", None), ("en", ""), (None, " \t .\n"), ("en", rows[0][1]), ("en", rows[0][1]), ("fr", "rare words here"), ("de", "the of " * 5000)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "lang string, text string, n long, phrase long").repartition(3)
    got = {tuple(r) for r in collocations.collocations(docs, least=5, top=40, entries=entries, burst=burst).collect()}
    assert got == brute_collocations(rows, 5, 80, 40)
    assert len(got) > 40


def test_collocations_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(docs).count() == 0


def test_words_of_equal_hashes_are_counted_apart(spark):
    long = "x" * 64  # only the first 64 bytes and the length of a word decide its hash
    rows = [("en", f"the {long}{c} of {long}{d}. {long}{c} of") for c, d in ["ab", "ab", "ba", "cc", "ab", "cb"]]
    assert len({collocations.word_hash("en", f"{long}{c}".encode()) for c in "abc"}) == 1
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = {tuple(r) for r in collocations.collocations(docs, least=3, top=40).collect()}
    assert got == brute_collocations(rows, 3, 80, 40) != set()


def test_only_frequent_phrases_reach_the_tries(spark):
    rng = random.Random(7)
    rows = [(rng.choice(["en", "de"]), " ".join(rng.choice(["the", "of", "new", "york city hall", "."] * 5 + [f"w{k}" for k in range(40)]) for _ in range(40))) for _ in range(200)]
    counts = defaultdict(Counter)
    for lang, text in rows:
        for piece in text.split("."):
            words = piece.split()
            for n in range(1, 5):
                counts[lang].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    least = 12
    often = {(lang, p): n for lang, f in counts.items() for p, n in f.items() if n >= least}
    singles = spark.createDataFrame([(lang, p[0].encode()) for lang, p in often if len(p) == 1], "lang string, phrase binary")
    words_filter = collocations.filter_of(singles, pairs=False)
    schema = collocations.pa.schema([("lang", "string"), ("text", "binary")])
    batches = collocations.pa.Table.from_pylist([{"lang": lang, "text": text.encode()} for lang, text in rows], schema).to_batches(max_chunksize=30)

    def filter_by(*filters):
        runs = [b for k in range(4) for b in collocations._hashes(5, 20, *filters)(batches[k::4])]
        assert len(runs) > 20  # several runs a slot
        runs = sorted(runs, key=lambda b: b["slot"][0].as_py())
        places = [p for b in collocations._frequent_hashes(least)(runs) for p in b["place"].to_pylist()]
        return len(places) // 2, collocations.filter_of_places(spark.createDataFrame([(p,) for p in places], "place long"))

    n_pairs, pairs_filter = filter_by(words_filter)
    n_longer, longer_filter = filter_by(words_filter, pairs_filter)
    sizes = Counter(len(p) for _, p in often)
    assert (n_pairs, n_longer) == (sizes[2], sizes[3] + sizes[4]) and min(n_pairs, n_longer) > 5
    got = Counter()
    for b in collocations._phrases(5, 100, 4, words_filter, pairs_filter, longer_filter)(batches):
        [[_, lang, phrases, n]] = zip(*(c.to_pylist() for c in b.columns))
        unpack = collocations.zstandard.ZstdDecompressor().decompress
        for phrase, k in zip(unpack(phrases).decode().split("\n"), np.frombuffer(unpack(n), np.uint64).tolist(), strict=True):
            got[lang, tuple(phrase.split(" "))] += k
    assert got == {p: n for p, n in often.items() if len(p[1]) > 1}
    assert len(got) < sum(len(p) > 1 for f in counts.values() for p in f) / 10


def test_equal_phrases_of_a_batch_reach_the_trie_once():
    rng = random.Random(2)
    for size in (2, 3, 4):
        phrases = [tuple(rng.choice([1, 2, 3, 2**32 - 1]) for _ in range(size)) for _ in range(300)]
        firsts, rests, n = collocations.distinct([np.array(c, np.uint64) for c in zip(*phrases)])
        assert Counter({(f, *collocations.unpacked(r)): k for f, r, k in zip(firsts, rests, n)}) == Counter(phrases)
        assert len(firsts) == len(set(phrases))


def test_trie_bursts_and_gives_up_whole_subtrees():
    rng, want, trie, got = random.Random(1), Counter(), collocations.HatTrie(burst=8), Counter()
    for _ in range(40):
        phrases = [tuple(rng.randint(1, 9) for _ in range(rng.choice([3, 4]))) for _ in range(50)]
        want.update(phrases)
        rests = [int("".join(f"{w:08x}" for w in p[1:]), 16) for p in phrases]
        trie.add([p[0] for p in phrases], rests, [1] * len(phrases))
        if rng.random() < 0.2:
            out = list(trie.taken(trie.entries // 2))
            assert not {p[0] for p, _ in out} & set(trie.root)
            got.update(dict(out))
    assert any(isinstance(n, collocations.Node) for n in trie.root.values())
    for p, n in trie.taken(0):
        got[p] += n
    assert got == want and trie.entries == 0


ODD = [
    None, "", " ", "\t", "a  b", " x", "x ", "a▁b c", "<|endoftext|> now", "<s> </s> <unk> <0x41>", "line\nnext\r\n\n end", "ﬁ ½ é é", "😀 👩‍👩‍👧 text",
    "naïve Straße", " nbsp em", "tab\tand \t mix", "don't we'll I'd", "x" * 5000, "1234567 3.14 ...!!!", "\x00\x01 ctrl", "ａｂ ﷽",
]


@pytest.fixture(scope="module")
def aligned_rows():
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 8))) for _ in range(60)]
    rows = [(k, t) for k, t in enumerate(ODD)]
    rows += [(100 + k, " ".join(rng.choice(words) for _ in range(rng.randint(1, 40)))) for k in range(70)]
    return [*rows, (100, rows[-1][1]), (100, rows[-1][1]), (None, "no id"), (500, " ".join(rng.choice(words) for _ in range(4000)))]


@pytest.fixture(scope="module")
def alignment(aligned_rows):
    """(rows, document counts of pairs) by whole texts, every token against every other."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a_model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_model.encode_special_tokens = True
    b_model = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    alphabet = alignments._byte_alphabet()

    def ends(parts):
        return np.cumsum([len(p) for p in parts]).tolist()

    out, documents = [], Counter()
    for doc, text in aligned_rows:
        row = [doc, 0, 0, 0, Counter(), ""]
        if text:
            a, b = a_model.encode(" " + text, add_special_tokens=False).ids, b_model.encode(text)
            a_parts = [bytes(alphabet[c] for c in a_model.id_to_token(i)) for i in a]
            b_parts = [bytes([int(p[3:5], 16)]) if b_model.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, b_model.id_to_piece(b))]
            if b"".join(a_parts) == (" " + text).encode() == b"".join(b_parts):
                a_ends, b_ends = ends(a_parts), ends(b_parts)
                links = Counter()
                for i, (x, y) in enumerate(zip([0, *a_ends], a_ends)):
                    for j in range(np.searchsorted(b_ends, x, "right"), len(b)):
                        if b_ends[j] - len(b_parts[j]) >= y:
                            break
                        links[a[i], b[j]] += 1
                both = sorted(set(a_ends) & set(b_ends))
                cut = lambda ids, at, low, high: ",".join(str(i) for i, e in zip(ids, at) if low < e <= high)
                groups = ";".join(f"{cut(a, a_ends, p, q)}|{cut(b, b_ends, p, q)}" for p, q in zip([0, *both], both)) if len(both) < 2000 else None
                row = [doc, len(a), len(b), len(both), links, groups and sha(groups)]
                documents.update(links.keys())
        out.append(row)
    return out, documents


@pytest.mark.parametrize("block_bytes", [alignments.BLOCK_BYTES, 300])
def test_alignment_equals_brute_force(spark, aligned_rows, alignment, block_bytes):
    rows, documents = alignment
    best = defaultdict(int)
    for (a, _), n in documents.items():
        best[a] = max(best[a], n)
    want = Counter()
    for doc, n_a, n_b, n_groups, links, digest in rows:
        score = sum(documents[p] * m for p, m in links.items())
        top = sum(m for p, m in links.items() if documents[p] == best[p[0]])
        want[doc, n_a, n_b, n_groups, sum(links.values()), top, score, digest] += 1
    docs = spark.createDataFrame([(*r, 1, "x") for r in aligned_rows], "doc_id long, text string, pairs long, block string").repartition(3)
    found = alignments.align_documents(docs, block_bytes=block_bytes).collect()
    unsaid = {w[:7] for w in want if w[7] is None}
    got = Counter((*r[:7], None if tuple(r[:7]) in unsaid else r[7]) for r in map(tuple, found))
    assert got == want
    zeros = {r[0] for r in rows if not r[1]}
    assert {0, 1, 7} <= zeros and 8 not in zeros and 9 not in zeros


def test_alignment_of_an_empty_table(spark):
    assert alignments.align_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_merged_index_equals_the_index_of_all():
    rng = np.random.default_rng(2)
    pairs, docs, times = rng.integers(0, 40, 3000).astype(np.uint64), rng.integers(0, 300, 3000), rng.integers(1, 9, 3000)
    first = docs % 3 == 0
    one, two, every = (alignments.Index.of(pairs[m], docs[m], times[m]) for m in (first, ~first, docs >= 0))
    both = one.merged(two)
    for name in ("pairs", "rows", "words", "bits"):
        assert np.array_equal(getattr(both, name), getattr(every, name))
    assert all(np.array_equal(x, y) for p, q in zip(both.planes, every.planes, strict=True) for x, y in zip(p, q))
    want = Counter()
    values = rng.integers(1, 100, 40)
    for p, d, t in zip(pairs.tolist(), docs.tolist(), times.tolist()):
        want[d] += int(values[p]) * t
    assert every.sums(values[every.pairs.astype(int)], 300).tolist() == [want[d] for d in range(300)]
    assert every.documents().tolist() == [len(set(docs[pairs == p])) for p in every.pairs]


def test_filter_finds_all_that_it_holds(spark):
    rows = [("en", f"w{k} v{k}".encode(), 1) for k in range(500)]
    held = collocations.Filter(collocations.filter_of(spark.createDataFrame(rows, "lang string, phrase binary, n long"), pairs=True).value)
    h = [[collocations.word_hash("en", f"{c}{k}".encode()) for k in range(1000)] for c in "wv"]
    found = held(collocations.pair_hash(*(np.array(x, np.uint64) for x in h)))
    assert found[:500].all() and found[500:].sum() < 5
