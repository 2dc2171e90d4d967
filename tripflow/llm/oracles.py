"""DuckDB SQL of the queries that SQL can express. The others have brute-force tests."""

_SPACE_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = r"list_filter(string_split_regex(" + _ASCII_LOWER.format("coalesce(text, '')") + r", '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

OP1 = f"""
WITH RECURSIVE words AS (
    SELECT doc_id, {_SPACE_WORDS.replace("coalesce(text, '')", _ASCII_LOWER.format("coalesce(text, '')"))} AS w FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
    SELECT a, b FROM shared o JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * o.n >= 80 * (x.n + y.n - o.n)
), both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(doc_id, r) AS (
    SELECT doc_id, doc_id FROM words
    UNION
    SELECT reached.doc_id, l.b FROM reached JOIN both_ways l ON l.a = reached.r
)
SELECT r.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(r.r) AS component_id
FROM reached r LEFT JOIN sizes s USING (doc_id) GROUP BY r.doc_id
"""



def _op2() -> str:
    from tripflow.llm import quality_rules as q

    forms = ", ".join(f"'{w}'" for w in q._forms(q.STOP_WORDS))
    tests = {
        "mean_word_length": ("word_chars", "n_words"),
        "symbols_per_word": ("n_symbols", "n_words"),
        "capital_share": ("n_capitals", "word_chars"),
        "stop_word_share": ("n_stop_words", "n_words"),
        "dup_line_share": ("n_dup_lines", "n_lines"),
    }
    good = []
    for rule in q.RULES:
        a, b = tests[rule.measure]
        share = f"(CASE WHEN {b} > 0 THEN {a}::DOUBLE / {b} ELSE 0 END)"
        sides = [f"{share} >= {rule.least}"] * (rule.least is not None) + [f"{share} <= {rule.most}"] * (rule.most is not None)
        good.append(f"({' AND '.join(sides)} OR n_words < {rule.min_words})")
    return rf"""
WITH base AS (
    SELECT doc_id, coalesce(text, '') AS text, {_SPACE_WORDS} AS w,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
    FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM base WHERE len(w) >= 5)
), again AS (
    SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1
), repeats AS (
    SELECT doc_id, count(DISTINCT i + j) AS n FROM again, (SELECT unnest(range(5)) AS j) GROUP BY doc_id
), measures AS (
    SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
        len(regexp_extract_all(text, '\p{{Lu}}')) AS n_capitals,
        len(list_filter(w, lambda x: x IN ({forms}))) AS n_stop_words,
        len(l) AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
        coalesce(r.n, 0)::BIGINT AS n_repeat_words
    FROM base LEFT JOIN repeats r USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND {' AND '.join(good)} AS kept
FROM measures
"""


OP3 = f"""
WITH docs AS (
    SELECT doc_id, {_ITEM_WORDS} AS w FROM documents
), items AS (
    SELECT item_id::VARCHAR AS item, {_ITEM_WORDS} AS w FROM benchmark
), windows AS (
    SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
    FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM items WHERE len(w) > 0)
), places AS (
    SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
), found AS (
    SELECT p.doc_id, p.i, p.n, x.item FROM places p JOIN windows x ON x.s = p.s AND x.n = p.n
), hits AS (
    SELECT doc_id, count(DISTINCT pos) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM (SELECT DISTINCT doc_id, i, n FROM found)) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP4 = """
WITH payloads AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), digests AS (
    SELECT page_id, payload_bytes::BIGINT AS payload_bytes, h, array_to_string([
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(h, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1)::BIGINT, 1)
        for i in range(32)], '') AS payload_digest,
        max(page_id) OVER (PARTITION BY h) AS original
    FROM payloads
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id < original THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page_id < original THEN original END AS refers_to
FROM digests
"""

OP7 = f"""
WITH words AS (
    SELECT doc_id, {_SPACE_WORDS} AS w FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM words WHERE len(w) >= 35)
), again AS (
    SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY s) > 1
), gone AS (
    SELECT DISTINCT doc_id, i + j AS i FROM again, (SELECT unnest(range(35)) AS j)
), gone_lists AS (
    SELECT doc_id, list(i) AS g FROM gone GROUP BY doc_id
), flat AS (
    SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM words
), kept AS (
    SELECT f.doc_id, string_agg(x, ' ' ORDER BY i) AS t FROM flat f ANTI JOIN gone USING (doc_id, i) GROUP BY f.doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(g), 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN gone_lists USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

# Markers of 7 + 3 and 8 characters a turn; an escape adds two characters.
OP8 = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, t, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)
), long AS (
    SELECT *, length(replace(replace(text, '%', '%25'), '<|', '%3C|')) AS n, length(replace(replace(role, '%', '%25'), '|', '%7C')) AS m FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(7 + m + 3 + n + 8)::BIGINT AS formatted_chars
FROM long GROUP BY conv_id
"""

OP10 = rf"""
WITH sized AS (
    SELECT doc_id, source, len({_SPACE_WORDS})::BIGINT AS size,
        md5('mix/' || md5(coalesce(doc_id::VARCHAR, '') || '/' || coalesce(md5(text), ''))) AS o FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS no FROM sized GROUP BY source
), caps AS (
    SELECT *, ([5, 2, 1])[no % 3 + 1] AS weight, 3 * source_size AS cap FROM sources
), levels AS (
    SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0))::BIGINT AS rest,
        (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::BIGINT AS free
    FROM caps WINDOW before AS (ORDER BY cap::DOUBLE / weight, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
    SELECT cap::DOUBLE / weight AS o, no, rest, free FROM levels WHERE rest * weight <= cap * free ORDER BY 1, 2 LIMIT 1
), targets AS (
    SELECT c.source, c.source_size,
        CASE WHEN l.no IS NULL OR (c.cap::DOUBLE / c.weight, c.no) < (l.o, l.no) THEN c.cap::DOUBLE ELSE (l.rest * c.weight)::DOUBLE / l.free END AS target
    FROM caps c LEFT JOIN level l ON true
), sums AS (
    SELECT sum(source_size)::BIGINT AS total, greatest((sum(source_size)::BIGINT + 1048575) // 1048576, 1) AS block, sum(target) AS whole FROM targets
), arcs AS (
    SELECT s.no, t.*, floor(sum(target) OVER (ORDER BY s.no) / whole * 4294967296)::BIGINT AS high
    FROM targets t JOIN sources s ON s.source IS NOT DISTINCT FROM t.source, sums
), bounds AS (
    SELECT *, coalesce(lag(high) OVER (ORDER BY no), 0) AS low FROM arcs
), slots AS (
    SELECT slot, no, row_number() OVER (PARTITION BY no ORDER BY slot) - 1 AS rank
    FROM (SELECT unnest(range((total + block - 1) // block)) AS slot FROM sums) JOIN bounds ON slot * 2654435769 % 4294967296 >= low AND slot * 2654435769 % 4294967296 < high
), given AS (
    SELECT b.*, least(coalesce(g, 0) * block, 3 * source_size) AS words FROM bounds b LEFT JOIN (SELECT no, count(*) AS g FROM slots GROUP BY no) USING (no), sums
), placed AS (
    SELECT s.*, g.no, g.source_size, g.target, g.words,
        (sum(size) OVER (PARTITION BY s.source ORDER BY o, doc_id ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS start
    FROM sized s JOIN given g ON s.source IS NOT DISTINCT FROM g.source
), readings AS (
    SELECT doc_id, no, start + e * source_size AS f, least(start + e * source_size + size, words) AS t FROM placed, range(3) r(e) WHERE size > 0 AND start + e * source_size < words
), pieces AS (
    SELECT doc_id, no, f, t, unnest(range(f // block, (t - 1) // block + 1)) AS rank FROM readings, sums
), used AS (
    SELECT doc_id, sum(least(t, (rank + 1) * block) - greatest(f, rank * block))::BIGINT AS taken, min(slot) AS first_slot, count(*) AS n_pieces
    FROM pieces JOIN slots USING (no, rank), sums GROUP BY doc_id
)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken, first_slot, coalesce(n_pieces, 0) AS n_pieces
FROM placed LEFT JOIN used USING (doc_id)
"""



def _op11(parts: int = 8, width: int = 8, entries: int = 16, rounds: int = 6) -> str:
    places = range(width)
    xs, cs = (", ".join(f"{a}{i}" for i in places) for a in "xc")
    cut = ", ".join(f"v[part * {width} + {i + 1}] AS x{i}" for i in places)
    distance = " + ".join(f"(x{i} - c{i}) * (x{i} - c{i})" for i in places)

    def nearest(r: int) -> str:
        return f"near{r} AS MATERIALIZED (SELECT vec_id, p.part, min(({distance}) * {entries} + entry) AS k, {', '.join(f'any_value(x{i}) AS x{i}' for i in places)} FROM parts p JOIN book{r} b ON b.part = p.part GROUP BY vec_id, p.part)"

    def moved(r: int) -> str:
        means = ", ".join(f"sum(x{i})::BIGINT AS s{i}" for i in places)
        new = ", ".join(f"CASE WHEN n IS NULL THEN c{i} ELSE (s{i} - ((s{i} % n) + n) % n) // n END AS c{i}" for i in places)
        return f"book{r + 1} AS MATERIALIZED (SELECT b.part, b.entry, {new} FROM book{r} b LEFT JOIN (SELECT part, k % {entries} AS entry, count(*) AS n, {means} FROM near{r} GROUP BY ALL) m ON m.part = b.part AND m.entry = b.entry)"

    steps = ", ".join(x for r in range(rounds) for x in (nearest(r), moved(r)))
    return f"""
WITH kept AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
    SELECT vec_id, part, {cut} FROM kept, (SELECT unnest(range({parts})) AS part)
), book0 AS MATERIALIZED (
    SELECT part, dense_rank() OVER (ORDER BY vec_id) - 1 AS entry, {', '.join(f'x{i} AS c{i}' for i in places)} FROM parts QUALIFY dense_rank() OVER (ORDER BY vec_id) <= {entries}
), {steps}, {nearest(rounds)}, codes AS (
    SELECT vec_id, string_agg(printf('%02x', (k % {entries})::INTEGER), '' ORDER BY part) AS code, sum(k // {entries})::BIGINT AS error FROM near{rounds} GROUP BY vec_id
), books AS (
    SELECT sha256(string_agg(concat_ws(',', {cs}), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{rounds}
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM codes JOIN kept USING (vec_id), books
"""


OP12 = OP1.replace("w[i:i + 4]", "w[i:i + 1]").replace("greatest(len(w) - 4, 1)", "greatest(len(w) - 1, 1)")
OP12 = f"SELECT *, doc_id = component_id AS kept FROM ({OP12})"


def _op13(levels: int = 16) -> str:
    """Windows of 2**k words are named by hashing the names of their halves. In a run of period q the
    next place of a window of q to 2 * q - 1 words is q further on, and only there, so stretches of
    such places are the runs."""
    names = ["name0 AS (SELECT doc_id, i, hash(x) AS h FROM flat)"]
    for k in range(1, levels):
        half = 1 << (k - 1)
        names.append(
            f"name{k} AS MATERIALIZED (SELECT doc_id, i, hash(h, g) AS h FROM (SELECT *, lead(h, {half}) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM name{k - 1}) WHERE g IS NOT NULL)"
        )
    met = " UNION ALL ".join(
        f"SELECT doc_id, i, d, {1 << k} AS k FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id, h ORDER BY i) - i AS d FROM name{k}) WHERE 2 * d > {1 << k} AND d <= {1 << k}"
        for k in range(levels)
    )
    return rf"""
WITH RECURSIVE crc_steps(i, k, v) AS (
    SELECT i, 0, i FROM range(256) r(i)
    UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM crc_steps WHERE k < 8
), crc_table AS (
    SELECT list(v ORDER BY i) AS t FROM crc_steps WHERE k = 8
), plain AS (
    SELECT doc_id, {_SPACE_WORDS} AS w,
        xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
    FROM documents, crc_table
), shaped AS (
    SELECT doc_id, w, h, (h // 10) % len(w) AS a, 1 + (len(w) - (h // 10) % len(w)) // (3 + (h // 10) % 8) AS p FROM plain WHERE len(w) > 0
), flat AS MATERIALIZED (
    SELECT doc_id, i, w[(CASE WHEN h % 10 = 0 AND i >= a THEN a + (i - a) % p ELSE i END) + 1] AS x FROM (SELECT *, unnest(range(len(w))) AS i FROM shaped)
), {', '.join(names)}, met AS MATERIALIZED ({met}), islands AS (
    SELECT doc_id, d, k, i, i - row_number() OVER (PARTITION BY doc_id, d ORDER BY i) AS island FROM met
), found AS MATERIALIZED (
    SELECT doc_id, min(i) AS start, max(i) - min(i) + any_value(k) + d AS length, d AS period FROM islands GROUP BY doc_id, d, island
    HAVING max(i) - min(i) + any_value(k) + d >= greatest(6, 4 * d)
), listed AS (
    SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS t FROM found GROUP BY doc_id
), longest AS (
    SELECT * FROM found QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) = 1
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM found
), collapsed AS (
    SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t FROM flat f ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length, period::BIGINT AS period,
    (1000 * length // period)::BIGINT AS exponent_milli, sha256(coalesce(l.t, '')) AS runs_sha256, sha256(coalesce(c.t, '')) AS collapsed_sha256
FROM plain LEFT JOIN listed l USING (doc_id) LEFT JOIN longest USING (doc_id) LEFT JOIN collapsed c USING (doc_id)
"""


ORACLES = {
    "op1_ngram_join": OP1,
    "op2_quality_rules": _op2(),
    "op3_decontaminate": OP3,
    "op4_warc": OP4,
    "op7_substring_dedup": OP7,
    "op8_chat_format": OP8,
    "op10_mixing": OP10,
    "op11_vector_codes": _op11(),
    "op12_minhash": OP12,
    "op13_periodic_runs": _op13(),
}
