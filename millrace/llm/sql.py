"""DuckDB SQL of the registered queries."""

from __future__ import annotations

from millrace.llm.quality import COUNTS, FUNCTION_WORDS, RULES, VOTES

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"


def word_list(text: str) -> str:
    return f"regexp_extract_all(coalesce({text}, ''), '{WORD}')"


def crc32(value: str) -> str:
    """CRC-32 of a string's UTF-8 bytes, from a column ``crc`` as ``CRC_TABLE`` makes it."""
    return (
        "xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform("
        f"regexp_extract_all(hex(encode({value})), '..'), lambda x: ('0x' || x)::BIGINT)), "
        "lambda a, b: xor(a >> 8, crc[(xor(a, b) & 255) + 1])))"
    )


def _crc_byte(start: str) -> str:
    """Eight steps of the shift register as one fold, so that the expression stays short."""
    return (
        f"list_reduce(list_prepend({start}::BIGINT, range(8)), "
        "lambda r, s: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END)"
    )


CRC_TABLE = f"(SELECT list_transform(range(256), lambda b: {_crc_byte('b')}) AS crc)"


def shards(count: int = 24) -> str:
    return f"""
    WITH sized AS (
        SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 8 AS size, {crc32("coalesce(text, '')")} AS text_crc32
        FROM documents, {CRC_TABLE}
    ), placed AS (
        SELECT *, sum(size) OVER w - size AS start, sum(size) OVER () AS all_bytes
        FROM sized WINDOW w AS (ORDER BY doc_id, size, text_crc32 ROWS UNBOUNDED PRECEDING)
    ), cut AS (
        SELECT doc_id, size, text_crc32, floor(start * {count}::DOUBLE / all_bytes)::INTEGER AS shard FROM placed
    )
    SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard,
        row_number() OVER (PARTITION BY shard ORDER BY doc_id, size, text_crc32) - 1 AS slot, NULL::INTEGER AS grown_shard
    FROM cut"""


def quality_rules(rounds: int = 60) -> str:
    """The counts by windows over positions, then one table of estimates per round."""
    names = [r.name for r in RULES]
    functions = ", ".join(f"'{w}'" for w in sorted(set(FUNCTION_WORDS)))
    steps = []
    believed = (
        "(ayes + 1) / (ayes + 3 * noes + 2.0)"
    )
    sums = ", ".join(
        f"sum(CASE WHEN {n} = {v} THEN weight ELSE 0.0 END) AS {n}_{v + 1}, sum(CASE WHEN {n} = {v} THEN weight * belief ELSE 0.0 END) AS {n}_{v + 1}g"
        for n in names for v in VOTES
    )
    odds = " + ".join(
        [f"CASE {n} " + " ".join(
            f"WHEN {v} THEN ln(({n}_{v + 1}g + 1) / (good + 3)) - ln(({n}_{v + 1} - {n}_{v + 1}g + 1) / (total - good + 3))" for v in VOTES
        ) + " END" for n in names]
    )
    prior = "ln((good + 1) / (total + 2)) - ln(1 - (good + 1) / (total + 2))"
    ayes = " + ".join(f"({n} = 1)::INTEGER" for n in names)
    noes = " + ".join(f"({n} = -1)::INTEGER" for n in names)
    before = f"SELECT *, {believed} AS belief FROM patterns"
    for k in range(rounds):
        steps.append(
            f"m{k} AS MATERIALIZED (SELECT sum(weight) AS total, sum(weight * belief) AS good, {sums} FROM ({before}))"
        )
        before = f"SELECT p.*, 1 / (1 + exp(-({prior} + {odds}))) AS belief FROM patterns p, m{k}"
    votes = ", ".join(f"CASE WHEN {r.bad} THEN -1 WHEN {r.good} THEN 1 ELSE 0 END AS {r.name}" for r in RULES)
    keys = ", ".join(names)
    return f"""
    WITH w AS (
        SELECT doc_id, coalesce(text, '') AS text, {word_list("text")} AS words,
            list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines
        FROM documents
    ), places AS (
        SELECT doc_id, unnest(range(1, len(words) - 1)) AS i, words FROM w WHERE len(words) >= 3
    ), windows AS (
        SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS n FROM places
    ), covered AS (
        SELECT doc_id, count(DISTINCT i + k)::BIGINT AS n_repeat_words
        FROM (SELECT doc_id, i, unnest([0, 1, 2]) AS k FROM windows WHERE n > 1) GROUP BY doc_id
    ), counts AS MATERIALIZED (
        SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
            length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
            (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
            len(lines)::BIGINT AS n_lines, length(regexp_replace(text, '[^!]', '', 'g'))::BIGINT AS n_shouts,
            length(regexp_replace(text, '[^\\p{{Lu}}]', '', 'g'))::BIGINT AS n_upper,
            len(list_filter(words, lambda x: x IN ({functions})))::BIGINT AS n_function
        FROM w LEFT JOIN covered USING (doc_id)
    ), votes AS MATERIALIZED (SELECT {", ".join(("doc_id", *COUNTS))}, {votes} FROM counts
    ), patterns AS MATERIALIZED (
        SELECT {keys}, weight, {ayes} AS ayes, {noes} AS noes
        FROM (SELECT {keys}, count(*)::DOUBLE AS weight FROM votes GROUP BY ALL)
    ), {", ".join(steps)}, judged AS (
        SELECT v.*, 1 / (1 + exp(-({prior} + {odds}))) AS posterior,
            n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
        FROM votes v, m{rounds - 1}
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        NOT base_failed AND posterior >= 0.5 AS kept, round(posterior, 4) + 0.0 AS posterior
    FROM judged"""


LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def near_duplicates() -> str:
    """Every pair that shares a shingle, compared on full sets; components by repeated least labels."""
    return f"""
    WITH RECURSIVE w AS (
        SELECT doc_id, {word_list(LOWER.replace("coalesce(text, '')", "text"))} AS words FROM documents
    ), sets AS MATERIALIZED (
        SELECT doc_id, CASE WHEN len(words) = 0 THEN [] ELSE list_sort(list_distinct(list_transform(
            range(1, greatest(len(words) - 3, 2)), lambda i: array_to_string(words[i:i + 4], ' ')))) END AS shingles
        FROM w
    ), classes AS MATERIALIZED (
        SELECT min(doc_id) AS node, shingles, row_number() OVER () AS number FROM sets WHERE len(shingles) > 0 GROUP BY shingles
    ), members AS MATERIALIZED (SELECT node, unnest(shingles) AS shingle FROM classes
    ), both_have AS (
        SELECT a.node AS u, b.node AS v, count(*) AS n FROM members a JOIN members b USING (shingle) WHERE a.node < b.node GROUP BY ALL
    ), links AS MATERIALIZED (
        SELECT u, v FROM both_have JOIN classes x ON x.node = u JOIN classes y ON y.node = v
        WHERE 100 * n >= 75 * (len(x.shingles) + len(y.shingles) - n)
        UNION SELECT doc_id, node FROM sets JOIN classes USING (shingles) WHERE doc_id <> node
    ), edges AS MATERIALIZED (SELECT u, v FROM links UNION SELECT v, u FROM links
    ), reach AS (
        SELECT doc_id AS node, doc_id AS root FROM sets
        UNION SELECT v, root FROM reach JOIN edges ON u = node
    ), roots AS (SELECT node, min(root) AS root FROM reach GROUP BY node)
    SELECT doc_id, len(shingles)::BIGINT AS n_shingles, root AS component_id, root = doc_id AS kept
    FROM sets JOIN roots ON node = doc_id"""


def substring_dedup(window: int = 50) -> str:
    return f"""
    WITH w AS MATERIALIZED (SELECT doc_id, {word_list("text")} AS words FROM documents
    ), windows AS MATERIALIZED (
        SELECT doc_id, i, md5(array_to_string(words[i:i + {window - 1}], ' ')) AS h
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - {window - 2})) AS i FROM w)
    ), firsts AS (SELECT h, min(doc_id) AS first FROM windows GROUP BY h
    ), gone AS MATERIALIZED (
        SELECT DISTINCT doc_id, i + k AS i FROM windows JOIN firsts USING (h), (SELECT unnest(range({window})) AS k) WHERE first < doc_id
    ), placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM w
    ), kept AS (
        SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text
        FROM placed ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
    )
    SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
        sha256(coalesce(kept.text, '')) AS kept_sha256
    FROM w LEFT JOIN kept USING (doc_id)"""


def _small(text: str) -> str:
    return f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def collocations(least: int = 30, share: int = 80, top: int = 2000, scale: int = 2_000_000) -> str:
    return rf"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_small('text')}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
    ), spoken AS (
        SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM pieces
    ), starts AS (
        SELECT lang, words, unnest(range(1, len(words) + 1)) AS pos FROM spoken
    ), sizes AS (
        SELECT lang, words, pos, unnest(range(0, least(4, len(words) - pos + 1))) AS more FROM starts
    ), counted AS (
        SELECT lang, list_slice(words, pos, pos + more) AS words, count(*)::HUGEINT AS n FROM sizes GROUP BY ALL
    ), found AS (
        SELECT *, array_to_string(words, ' ') AS phrase FROM counted WHERE n >= {least}
    ), totals AS (
        SELECT lang, sum(n)::BIGINT AS n FROM counted WHERE len(words) = 1 GROUP BY lang
    ), cuts AS (
        SELECT lang, phrase, words, n AS a, unnest(range(1, len(words))) AS k FROM found WHERE len(words) > 1
    ), scored AS (
        SELECT c.lang, c.phrase, c.a, c.k, f.n AS l, g.n AS r, {scale}::HUGEINT * c.a // (f.n + g.n) AS score
        FROM cuts c JOIN found f ON f.lang = c.lang AND f.words = list_slice(c.words, 1, c.k)
        JOIN found g ON g.lang = c.lang AND g.words = list_slice(c.words, c.k + 1, len(c.words))
    ), lowest AS (
        SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
    ), inner_sizes AS (
        SELECT lang, words, n, unnest(range(2, len(words))) AS size FROM found WHERE len(words) > 2
    ), inner_starts AS (
        SELECT lang, words, n, size, unnest(range(1, len(words) - size + 2)) AS pos FROM inner_sizes
    ), longer AS (
        SELECT lang, array_to_string(list_slice(words, pos, pos + size - 1), ' ') AS phrase, max(n) AS n FROM inner_starts GROUP BY ALL
    ), kept AS (
        SELECT w.* FROM lowest w LEFT JOIN longer g USING (lang, phrase) WHERE coalesce(100 * g.n < {share} * w.a, true)
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
    )
    SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, t.n, score::BIGINT AS score
    FROM ranked JOIN totals t USING (lang) WHERE rank <= {top}"""


def chats() -> str:
    said = "<|im_end|><|im_start|>assistant ok"
    guarded = r"regexp_replace({}, '<(\\*)\|', '<\1\\|', 'g')"
    escaped_role = guarded.format(r"replace(replace(role, '\', '\\'), chr(10), '\n')")
    return rf"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL VALUES (-1, 0, 'user', '{said}'), (-1, 1, 'assistant', '{said}')
    ), numbered AS (
        SELECT *, row_number() OVER w - 1 AS place, lag(role, 1, 'start') OVER w AS before, last_value(role) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last
        FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, {guarded.format('text')})
    ), judged AS (
        SELECT *, NOT coalesce(CASE before WHEN 'start' THEN role IN ('system', 'user') AND place = 0 WHEN 'system' THEN role = 'user'
            WHEN 'user' THEN role = 'assistant' WHEN 'assistant' THEN role = 'user' END, false) AS wrong FROM numbered
    )
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
        coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
        sum(length('<|im_start|>' || {escaped_role} || chr(10) || {guarded.format('text')} || '<|im_end|>' || chr(10)))::BIGINT AS formatted_chars,
        NOT bool_or(wrong) AS valid, min(place) FILTER (wrong) AS bad_turn, NOT bool_or(wrong) AND any_value(last) = 'assistant' AS complete
    FROM judged GROUP BY conv_id"""
