"""SQL counterparts of the text queries, for DuckDB.

Each function writes the SQL of one operator over a relation of documents, so that the pipeline can nest them.
HTML extraction, repeated strings and toxicity have none: the first and the last are not relational, and
the comparison of all 200-byte strings is too slow in SQL. They are tested against brute force.
"""

from __future__ import annotations

from .backoff import Backoff
from .decontamination import WINDOW
from .line_dedup import ENDING, MIN_WORDS
from .mixing import DIMENSIONS, ROUNDS, SEED, TEMPER, TOTAL

WORD = r"[^\x20\x09-\x0D]+"
NOT_WHITE = r"[^\x20\x09-\x0D]"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def quality_rows(docs: str) -> str:
    """All columns of the documents and the measures, with a row number ``r``."""
    return f"""
WITH base AS (
  SELECT *, row_number() OVER () AS r, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{WORD}') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{NOT_WHITE}')) AS lines
  FROM {docs}),
grams AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS n
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM base)),
repeats AS (
  SELECT r, count(DISTINCT i + k) AS n FROM (SELECT r, i, unnest([0, 1, 2]) AS k FROM grams WHERE n > 1) GROUP BY r),
measured AS (
  SELECT base.*, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (length(t) - length(replace(t, '!', '')))::BIGINT AS n_exclamations,
         len(lines) AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(repeats.n, 0)::BIGINT AS n_repeat_words
  FROM base LEFT JOIN repeats USING (r)),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         100 * n_symbols > 30 * n_words OR 100 * n_exclamations > 30 * n_words
         OR 100 * n_dup_lines > 50 * n_lines OR word_chars > 14 * n_words AS rejected
  FROM measured)
SELECT *, NOT (base_failed OR rejected) AS passes FROM judged"""


def quality(docs: str) -> str:
    return f"""
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, passes AS kept
FROM ({quality_rows(docs)})"""


def overlap_rows(docs: str) -> str:
    letters = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return f"""
WITH items AS (
  SELECT DISTINCT item_id::VARCHAR AS item, regexp_extract_all({LOWER}, '{letters}') AS w FROM benchmark),
windows AS (
  SELECT item, least(len(w), {WINDOW}) AS size,
         unnest(list_transform(range(1, len(w) - least(len(w), {WINDOW}) + 2),
                lambda s: array_to_string(w[s:s + least(len(w), {WINDOW}) - 1], ' '))) AS words
  FROM items WHERE len(w) > 0),
base AS (SELECT *, row_number() OVER () AS r, regexp_extract_all({LOWER}, '{letters}') AS w FROM {docs}),
spans AS (
  SELECT r, size, s, array_to_string(w[s:s + size - 1], ' ') AS words
  FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS s
        FROM base, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)),
hits AS (SELECT r, s, spans.size, item FROM spans JOIN windows USING (words)),
covered AS (
  SELECT r, count(DISTINCT s + k) AS n_hit
  FROM (SELECT r, s, unnest(range(0, size)) AS k FROM (SELECT DISTINCT r, s, size FROM hits)) GROUP BY r),
found AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT base.*, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, coalesce(items, '') AS items
FROM base LEFT JOIN covered USING (r) LEFT JOIN found USING (r)"""


def overlaps(docs: str) -> str:
    return f"""
SELECT doc_id, n_words, n_hit, n_items, sha256(items) AS items_sha256, n_hit > 0 AS contaminated
FROM ({overlap_rows(docs)})"""


def backoff(docs: str) -> str:
    """For the order two that the query uses."""
    how = Backoff()
    return f"""
WITH base AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM {docs}),
words AS (SELECT r, i, w[i] AS word, CASE WHEN i > 1 THEN w[i - 1] END AS prev
          FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM base)),
single AS (SELECT word, count(*) AS n FROM words GROUP BY word),
pair AS (SELECT prev, word, count(*) AS n FROM words WHERE prev IS NOT NULL GROUP BY prev, word),
logs AS (
  SELECT r, CASE WHEN p.n >= {how.min_count} THEN ln(p.n) - ln(c.n)
                 ELSE ln(s.n) - ln((SELECT count(*) FROM words))
                      + CASE WHEN words.prev IS NULL THEN 0 ELSE ln({how.factor}) END END AS x
  FROM words JOIN single s USING (word)
  LEFT JOIN pair p ON p.prev = words.prev AND p.word = words.word LEFT JOIN single c ON c.word = words.prev),
sums AS (SELECT r, sum(x) AS x FROM logs GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, round(coalesce(x, 0), 4) AS log_score, round(x / len(w), 4) AS mean_log_score
FROM base LEFT JOIN sums USING (r)"""


def near_rows(docs: str, percent: int) -> str:
    return f"""
WITH RECURSIVE base AS (
  SELECT *, row_number() OVER () AS r, regexp_extract_all({LOWER}, '{WORD}') AS w FROM {docs}),
shingles AS (
  SELECT DISTINCT r, unnest(CASE WHEN len(w) BETWEEN 1 AND 4 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM base),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
common AS (
  SELECT a.r AS a, b.r AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.r <> b.r GROUP BY a.r, b.r),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.r = a JOIN sizes y ON y.r = b
  WHERE 100 * common.n >= {percent} * (x.n + y.n - common.n)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
smallest AS (SELECT a AS r, min(doc_id) AS low FROM reach JOIN base ON base.r = reach.b GROUP BY a)
SELECT base.*, coalesce(sizes.n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id
FROM base LEFT JOIN sizes USING (r) LEFT JOIN smallest USING (r)"""


def near(docs: str, percent: int) -> str:
    return f"SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM ({near_rows(docs, percent)})"


def mixed(docs: str) -> str:
    """Documents with their cell, probability and whether they are drawn; raking is unrolled."""
    steps = []
    state = "start"
    for i in range(ROUNDS):
        for d in DIMENSIONS:
            name = f"rake_{i}_{d}"
            steps.append(
                f"""{name} AS (SELECT * REPLACE (CASE WHEN tokens > 0 THEN
  weight * want_{d} / (sum(weight) OVER (PARTITION BY {d}) / sum(weight) OVER ()) ELSE weight END AS weight) FROM {state})"""
            )
            state = name
    steps.append(f"uncut AS (SELECT *, false AS whole FROM {state})")
    state = "uncut"

    def scaled(name: str) -> None:
        """Weights times one number, cut at the cells' tokens, so that they add up to the total."""
        nonlocal state
        order = f"ORDER BY whole DESC, weight / nullif(tokens, 0) DESC NULLS LAST, {', '.join(DIMENSIONS)}"
        steps.append(f"""{name}_a AS (
  SELECT *, CASE WHEN NOT whole AND tokens > 0 AND weight > 0 THEN
    ({TOTAL}::DOUBLE * sum(tokens) OVER () - coalesce(sum(tokens) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / nullif(sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) END AS times FROM {state}),
{name}_b AS (SELECT * REPLACE (max(CASE WHEN times * weight <= tokens * (1 + 1e-12::DOUBLE) THEN times END) OVER () AS times) FROM {name}_a),
{name}_c AS (
  SELECT * REPLACE (CASE WHEN whole THEN tokens ELSE least(tokens, coalesce(weight * times, tokens)) END AS weight) FROM {name}_b),
{name} AS (SELECT * EXCLUDE (times) REPLACE (weight >= tokens * (1 - 1e-12::DOUBLE) AS whole) FROM {name}_c)""")
        state = name

    scaled("cut")
    for i in range(ROUNDS):
        for d in DIMENSIONS:
            name = f"again_{i}_{d}"
            steps.append(f"""{name} AS (
  SELECT * EXCLUDE (taken, others, total) REPLACE (CASE WHEN NOT whole AND others > 0
    THEN weight * greatest(greatest(want_{d} * total - taken, 0) / others, 0.01::DOUBLE) ELSE weight END AS weight)
  FROM (SELECT *, coalesce(sum(weight) FILTER (whole) OVER (PARTITION BY {d}), 0) AS taken,
               sum(weight) FILTER (NOT whole) OVER (PARTITION BY {d}) AS others,
               {TOTAL}::DOUBLE * sum(tokens) OVER () AS total FROM {state}))""")
            state = name
        scaled(f"cut_{i}")
    wants = ",\n".join(
        f"""want_{d} AS (SELECT {d}, p / sum(p) OVER () AS want_{d}
  FROM (SELECT {d}, pow(sum(tokens), {TEMPER[d]}) AS p FROM cells GROUP BY {d}))"""
        for d in DIMENSIONS
    )
    joins = " ".join(f"JOIN want_{d} USING ({d})" for d in DIMENSIONS)
    return f"""
WITH base AS (
  SELECT *, coalesce(source, '') AS c_source, coalesce(lang, '') AS c_lang,
         CASE WHEN contains(t, ' | ') THEN 'table' WHEN contains(t, 'http') THEN 'links'
              WHEN contains(t, '@') THEN 'contacts' WHEN length(t) >= 2000 THEN 'long prose' ELSE 'prose' END AS topic,
         len(regexp_extract_all(t, '{WORD}'))::BIGINT AS n_tokens
  FROM (SELECT *, coalesce(text, '') AS t FROM {docs})),
cells AS (SELECT c_source AS source, c_lang AS lang, topic, sum(n_tokens)::DOUBLE AS tokens FROM base GROUP BY ALL),
{wants},
start AS (SELECT cells.*, tokens AS weight, want_source, want_lang, want_topic FROM cells {joins}),
{", ".join(steps)},
chances AS (
  SELECT source AS c_source, lang AS c_lang, topic,
         CASE WHEN tokens > 0 THEN greatest(1e-6::DOUBLE, least(1::DOUBLE, round(weight / tokens, 6))) ELSE 1::DOUBLE END AS probability
  FROM {state})
SELECT base.*, probability,
       ('0x' || substr(md5(concat('{SEED}:', coalesce(doc_id::VARCHAR, ''))), 1, 8))::BIGINT < probability * 4294967296 AS kept
FROM base JOIN chances USING (c_source, c_lang, topic)"""


def mixing(docs: str) -> str:
    return f"""
SELECT doc_id, c_source AS source, c_lang AS lang, topic, n_tokens, probability, kept FROM ({mixed(docs)})"""


def line_rows(docs: str) -> str:
    """Documents with ``rest``, the text that is left, and counts of what was cut."""
    return f"""
WITH base AS (
  SELECT *, row_number() OVER () AS r, string_split(text, chr(10)) AS lines FROM {docs}),
hashed AS (SELECT r, doc_id, lines, list_transform(lines, lambda x: md5(x)) AS h FROM base WHERE text IS NOT NULL),
ended AS (
  SELECT r, doc_id, lines, list_filter(range(1, len(h) + 1),
         lambda i: substr(md5(concat(coalesce(h[i - 1], ''), h[i])), 1, 1) <= '{ENDING}' OR i = len(h)) AS ends FROM hashed),
chunks AS (
  SELECT r, doc_id, lines, coalesce(ends[no - 1], 0) + 1 AS first, ends[no] AS last
  FROM (SELECT r, doc_id, lines, ends, unnest(range(1, len(ends) + 1)) AS no FROM ended)),
spans AS (
  SELECT r, doc_id, first, last, bool_or(is_chunk) AS is_chunk, any_value(array_to_string(lines[first:last], chr(10))) AS body
  FROM (SELECT *, TRUE AS is_chunk FROM chunks WHERE last > first UNION ALL
        SELECT r, doc_id, lines, i, i + 1, FALSE FROM (SELECT *, unnest(range(1, len(lines))) AS i FROM hashed))
  GROUP BY r, doc_id, first, last),
repeated AS (
  SELECT body, min({{'d': doc_id, 'n': first}}) AS earliest FROM spans WHERE regexp_matches(body, '{NOT_WHITE}') GROUP BY body),
later AS (
  SELECT spans.*, earliest IS NULL AS blank FROM spans LEFT JOIN repeated USING (body)
  WHERE earliest IS DISTINCT FROM {{'d': doc_id, 'n': first}} AND (earliest IS NOT NULL OR last = first + 1)),
pairs AS (
  SELECT *, first - row_number() OVER (PARTITION BY r ORDER BY first) AS run FROM later WHERE last = first + 1),
runs AS (SELECT r, min(first) AS first, max(last) AS last FROM pairs GROUP BY r, run),
gone AS (
  SELECT DISTINCT r, unnest(range(first, last + 1)) AS line FROM (
    SELECT r, first, last FROM later WHERE is_chunk AND NOT blank UNION ALL
    SELECT r, first, last FROM runs JOIN hashed USING (r)
    WHERE len(regexp_extract_all(array_to_string(lines[first:last], chr(10)), '{WORD}')) > {MIN_WORDS})),
cuts AS (
  SELECT r, list(line) AS cut, count(*) AS gone_lines, count(*) FILTER (before IS DISTINCT FROM line - 1) AS n_gone
  FROM (SELECT r, line, lag(line) OVER (PARTITION BY r ORDER BY line) AS before FROM gone) GROUP BY r)
SELECT base.*, coalesce(n_gone, 0)::BIGINT AS n_gone, coalesce(gone_lines, 0)::BIGINT AS gone_lines,
       CASE WHEN cut IS NULL THEN text
            ELSE array_to_string(list_filter(lines, lambda x, i: NOT list_contains(cut, i)), chr(10)) END AS rest
FROM base LEFT JOIN cuts USING (r)"""


def lines(docs: str) -> str:
    return f"""
SELECT doc_id, coalesce(len(lines), 0)::BIGINT AS n_lines, n_gone AS n_removed_runs, gone_lines AS n_removed_lines,
       sha256(coalesce(rest, '')) AS kept_sha256
FROM ({line_rows(docs)})"""


def chat(rows: str) -> str:
    """For the default template: the same turns, and the lengths of headers, escapes and end marks."""

    def escapes(x: str) -> str:
        runs = f"list_sum(list_transform(regexp_extract_all({x}, '#{{3,}}'), lambda m: length(m) - 2))"
        marks = "".join(
            f" + (length({x}) - length(replace({x}, '{m}', ''))) // {len(m)}" for m in ("</turn>", ">: ")
        )
        return f"(coalesce({runs}, 0) + length({x}) - length(replace({x}, '\\', '')){marks})"

    return f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM {rows}
  UNION ALL SELECT -7, n, who, '\\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS x(n, who)),
sized AS (
  SELECT *, length(text) + {escapes("text")} + length('</turn>') + 1
         + CASE WHEN role IN ('system', 'user', 'assistant') THEN length('### : ') + length(role)
                ELSE length('### Role <>: ') + length(role) + {escapes("role")} END AS size
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(size)::BIGINT AS formatted_chars,
       regexp_full_match(string_agg(CASE role WHEN 'system' THEN 's' WHEN 'user' THEN 'u' WHEN 'assistant' THEN 'a' ELSE 'x' END,
                                    '' ORDER BY turn, role, text), 's?u(au)*a?') AS in_order
FROM sized GROUP BY conv_id"""


def pipeline() -> str:
    columns = "doc_id, text, lang, source, n_chars"
    blank = f"NOT regexp_matches(rest, '{NOT_WHITE}')"
    return f"""
WITH kept_1 AS MATERIALIZED (SELECT {columns} FROM ({quality_rows("documents")}) WHERE passes),
kept_2 AS MATERIALIZED (
  SELECT doc_id, rest AS text, lang, source, CASE WHEN n_gone > 0 THEN length(rest) ELSE n_chars END AS n_chars
  FROM ({line_rows("kept_1")}) WHERE NOT (n_gone > 0 AND {blank})),
kept_3 AS MATERIALIZED (SELECT {columns} FROM ({near_rows("kept_2", 80)}) WHERE doc_id = component_id),
kept_4 AS MATERIALIZED (SELECT {columns} FROM ({overlap_rows("kept_3")}) WHERE n_hit = 0)
SELECT {columns}, topic, probability FROM ({mixed("kept_4")}) WHERE kept"""


def sharding(docs: str, shards: int, whole_percent: int) -> str:
    return f"""
WITH crc AS (
  SELECT list(list_reduce([i::UBIGINT] || [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[],
                          lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)),
texts AS (SELECT DISTINCT coalesce(text, '') AS body, hex(encode(coalesce(text, ''))) AS digits FROM {docs}),
sums AS (
  SELECT body, md5(body) AS digest,
         xor(list_reduce([4294967295::UBIGINT] ||
                         list_transform(range(0, length(digits), 2), lambda k: ('0x' || substr(digits, k + 1, 2))::UBIGINT),
                         lambda c, b: xor(c >> 8, t[((xor(c, b) & 255) + 1)::BIGINT])), 4294967295::UBIGINT)::BIGINT AS text_crc32
  FROM texts, crc),
records AS (
  SELECT doc_id, strlen(body) + 1 AS size, text_crc32, digest, coalesce(doc_id::VARCHAR, '') AS name
  FROM {docs} JOIN sums ON coalesce(text, '') = body),
running AS (
  SELECT *, coalesce(sum(size) OVER (ORDER BY digest, name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
         row_number() OVER (ORDER BY digest, name) AS place, sum(size) OVER () AS total,
         sum(size) OVER (PARTITION BY digest) AS group_size
  FROM records),
grouped AS (
  SELECT *, min(start) OVER (PARTITION BY digest) AS group_start, group_size * 100 * {shards} <= {whole_percent} * total AS together
  FROM running),
sharded AS (
  SELECT *, (((CASE WHEN together THEN 2 * group_start + group_size ELSE 2 * start + size END) * {shards}) // (2 * total))::INT AS shard
  FROM grouped)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY place) - 1 AS slot, NULL::INT AS grown_shard
FROM sharded"""


def collocations(docs: str, least: int, top: int) -> str:
    return rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?
-
]')) AS piece
  FROM {docs}),
split AS (SELECT lang, list_filter(string_split_regex(piece, '[ 	]+'), lambda w: w <> '') AS ws FROM pieces),
grams AS (
  SELECT lang, unnest(list_transform(range(1, len(ws) - n + 2), lambda i: ws[i : i + n - 1])) AS gram
  FROM split, range(1, 4) r(n) WHERE len(ws) >= n),
counts AS MATERIALIZED (SELECT lang, gram, count(*) AS f FROM grams GROUP BY ALL),
sizes AS (SELECT lang, sum(f) AS n FROM counts WHERE len(gram) = 1 GROUP BY lang),
phrases AS MATERIALIZED (SELECT lang, gram, f AS a FROM counts WHERE len(gram) > 1 AND f >= {least}),
cuts AS (
  SELECT p.lang, p.gram, a, k, one.f AS l, two.f AS r, (1000000::HUGEINT * a * a) // (one.f::HUGEINT * two.f) AS score
  FROM phrases p, range(1, 3) r(k)
  JOIN counts one ON one.lang = p.lang AND one.gram = p.gram[1 : k]
  JOIN counts two ON two.lang = p.lang AND two.gram = p.gram[k + 1 : ]
  WHERE k < len(p.gram)),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, k) = 1),
inside AS (
  SELECT lang, gram, max(f) AS longer FROM (
    SELECT lang, gram[1 : 2] AS gram, a AS f FROM phrases WHERE len(gram) = 3
    UNION ALL SELECT lang, gram[2 : 3], a FROM phrases WHERE len(gram) = 3) GROUP BY ALL),
free AS (
  SELECT lang, array_to_string(gram, ' ') AS phrase, a, l, r, score
  FROM lowest LEFT JOIN inside USING (lang, gram) WHERE len(gram) = 3 OR longer IS NULL OR 100 * longer < 50 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
       n::BIGINT AS n, score::BIGINT AS score
FROM free JOIN sizes USING (lang) QUALIFY rank <= {top}"""


ORACLE: dict[str, str] = {
    "op1_quality_rules": quality("documents"),
    "op2_decontamination": overlaps("documents"),
    "op4_lm_scoring": backoff("documents"),
    "op6_near_dedup": near("documents", 85),
    "op7_mixing": mixing("documents"),
    "op9_line_dedup": lines("documents"),
    "op10_chat_formatting": chat("conversations"),
    "op12_sharding": sharding("documents", 16, 1),
    "op13_phrase_collocations": collocations("documents", 10, 2000),
}

#: of the whole pipeline
PIPELINE: str | None = pipeline()
