"""The registered queries restated in SQL for DuckDB, to check results against another engine.

The statements are written for clarity, not scale: plain windows and self-joins stand where the Spark
operators use buckets, chunks and pre-aggregation.
"""

from __future__ import annotations

from textpack.constants import (
    ASSISTANT_TOKEN,
    CHAT_TOKENS,
    COMMON_WORDS,
    DEFAULT_USER_TURN,
    END_TOKEN,
    EOS_TOKEN,
    INIT_STD,
    INSTRUCTION_PREFIXES,
    MAX_CHAT_TOKENS,
    MIN_ASCII_RATIO,
    MIN_COMMON_WORDS,
    MIN_DISTINCT_WORDS,
    SEED,
    USER_TOKEN,
    VAL_FRACTION,
    WS,
)
from textpack.operators.pack import SWAP_ROUNDS
from textpack.plans import catalog as C
from textpack.plans.inputs import LINES_PER_TURN

# The pre-tokenizer's own whitespace class lacks the four information separators.
SPACE = WS.replace(r"\x1c-\x20", r"\x20")
GAP = ""
NEWLINE = "chr(10)"
UNIT = "chr(31)"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(t: str) -> str:
    return f"regexp_replace({t}, {q(rf'\A[{WS}]+|[{WS}]+\z')}, '', 'g')"


def collapse(t: str) -> str:
    return f"trim(regexp_replace({t}, {q(f'[{WS}]+')}, ' ', 'g'), ' ')"


def words(t: str) -> str:
    low = f"lower(replace({t}, chr(304), 'i' || chr(775)))"
    return f"list_distinct(regexp_extract_all({low}, '[a-z'']+'))"


def common(t: str) -> str:
    return f"list_intersect({words(t)}, [{', '.join(q(w) for w in COMMON_WORDS)}])"


def ascii_ratio(t: str) -> str:
    return (f"(length(regexp_replace({t}, {q('[^\\x00-\\x7f]')}, '', 'g'))::DOUBLE"
            f" / nullif(length({t}), 0))")


def english(t: str) -> str:
    return (f"(length({t}) > 0 AND coalesce({ascii_ratio(t)}, 0) >= {MIN_ASCII_RATIO}"
            f" AND (len({common(t)}) >= {MIN_COMMON_WORDS}"
            f" OR len({words(t)}) >= {MIN_DISTINCT_WORDS}))")


def chat_line(u: str, a: str) -> str:
    return f"({q(USER_TOKEN)} || {u} || {q(ASSISTANT_TOKEN)} || {a} || {q(END_TOKEN)})"


def pieces(t: str) -> str:
    marked = (f"regexp_replace({t}, {q(f'([{SPACE}]+)([{SPACE}][^{SPACE}])')},"
              f" {q(r'\1' + GAP + r'\2')}, 'g')")
    pattern = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
               rf"| ?[^{SPACE}\x{{E000}}\p{{L}}\p{{N}}]+|[{SPACE}]+")
    return f"regexp_extract_all({marked}, {q(pattern)})"


def byte_id(b: str) -> str:
    return (f"(CASE WHEN {b} BETWEEN 33 AND 126 THEN {b} - 32"
            f" WHEN {b} BETWEEN 161 AND 172 THEN {b} - 66 WHEN {b} >= 174 THEN {b} - 67"
            f" WHEN {b} <= 32 THEN {b} + 189 WHEN {b} = 173 THEN 256 ELSE {b} + 95 END)")


def byte_char(b: str) -> str:
    return (f"chr(CASE WHEN {b} BETWEEN 33 AND 126 OR {b} BETWEEN 161 AND 172 OR {b} >= 174"
            f" THEN {b} WHEN {b} <= 32 THEN {b} + 256 WHEN {b} = 173 THEN 323"
            f" ELSE {b} + 162 END)")


def byte_list(t: str, item) -> str:
    """``item`` of each byte of the UTF-8 text, as a list."""
    byte = "('0x' || h)::INTEGER"
    return (f"list_transform(regexp_extract_all(hex(encode({t})), '..'),"
            f" lambda h: {item(byte)})")


def byte_ids(t: str) -> str:
    return byte_list(t, byte_id)


def spell(ids: str) -> str:
    return f"({ids})::VARCHAR"


# --- shared tables -------------------------------------------------------------------------

STORIES = (f"stories AS (SELECT doc_id, text FROM (SELECT doc_id, {strip('''coalesce(text, '')''')}"
           f" AS text FROM documents) WHERE text <> '')")

PAIRS = """pairs AS (
  SELECT conv_id, turn, text AS "user", next_text AS assistant FROM (
    SELECT conv_id, turn, role, text,
           lead(role) OVER w AS next_role, lead(text) OVER w AS next_text
    FROM conversations WHERE role IN ('user', 'assistant')
    WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
  WHERE role = 'user' AND next_role = 'assistant')"""

CLEANED = f"""{PAIRS}, cleaned AS (
  SELECT conv_id, turn, {collapse('''coalesce("user", '')''')} AS "user",
         {collapse("coalesce(assistant, '')")} AS assistant FROM pairs),
rendered AS (SELECT *, {chat_line('"user"', 'assistant')} AS line FROM cleaned)"""

# Control tokens count one piece each, and separate the pieces of the two turns.
PIECES_IN_PAIR = f"""(len({pieces('"user"')}) + len({pieces('assistant')}) + 3)"""

LABELLED = f"""{CLEANED}, labelled AS (
  SELECT conv_id, turn, line, {PIECES_IN_PAIR} AS n_tokens,
    CASE WHEN "user" = '' OR assistant = '' THEN 'empty'
         WHEN NOT {english('line')} THEN 'non_english'
         WHEN {PIECES_IN_PAIR} > {MAX_CHAT_TOKENS} THEN 'too_long' ELSE 'kept' END AS drop_reason
  FROM rendered),
kept AS (SELECT conv_id, turn, line, n_tokens FROM labelled WHERE drop_reason = 'kept')"""

_USER, _ASSISTANT, _END = (C.CHAT_BYTES.specials[t] for t in CHAT_TOKENS)

SPLIT = f"""placed AS (
  SELECT *, row_number() OVER (ORDER BY md5('{SEED}:' || conv_id || ':' || turn), conv_id, turn) - 1
    AS position FROM chat),
split AS (
  SELECT *, len(ids) AS n_tokens,
    CASE WHEN position < round_even((SELECT count(*) FROM chat) * {VAL_FRACTION}::DOUBLE, 0)
    THEN 'val' ELSE 'train' END AS split FROM placed)"""

CHAT = f"""{CLEANED}, chat AS (
  SELECT conv_id, turn, [{_USER}] || {byte_ids('"user"')} || [{_ASSISTANT}]
    || {byte_ids('assistant')} || [{_END}] AS ids
  FROM rendered WHERE "user" <> '' AND assistant <> '' AND {english('line')}
    AND strlen("user") + strlen(assistant) + 3 <= {C.BYTE_LIMIT}),
{SPLIT}"""


def packed(rows: str, part: str, order: str) -> str:
    """CTEs stream(part, idx, id) and blocks(part, block_id, tokens, ids) over rows with ids."""
    c = C.CONTEXT
    return f"""laid AS (
  SELECT {part} AS part, ids,
    coalesce(sum(len(ids)) OVER (PARTITION BY {part} ORDER BY {order}
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM {rows}),
stream AS (
  SELECT part, start + pos - 1 AS idx, id FROM (
    SELECT part, start, unnest(ids) AS id, generate_subscripts(ids, 1) AS pos FROM laid)),
cells AS (
  SELECT part, idx // {c} AS block_id, idx, id FROM stream
  UNION ALL
  SELECT part, idx // {c} - 1, idx, id FROM stream WHERE idx % {c} = 0 AND idx > 0),
blocks AS (
  SELECT part, block_id::BIGINT AS block_id, list(id ORDER BY idx) AS ids
  FROM cells GROUP BY part, block_id HAVING count(*) = {c + 1})"""


STORY_BLOCKS = f"""{STORIES},
encoded AS (SELECT doc_id, list_append({byte_ids('text')}, 0) AS ids FROM stories),
{packed('encoded', "'all'", 'doc_id')}"""

CHAT_BLOCKS = f"""{CHAT}, {packed('split', 'split', 'position')}"""

BIGRAMS = f"""{STORY_BLOCKS}, bigrams AS (
  SELECT x, y, count(*) AS n FROM (
    SELECT unnest(ids[1:{C.CONTEXT}]) AS x, unnest(ids[2:{C.CONTEXT + 1}]) AS y FROM blocks)
  GROUP BY x, y)"""

LINES = f"""numbered AS (
  SELECT conv_id, turn, unnest(parts) AS line, generate_subscripts(parts, 1) - 1 AS pos FROM (
    SELECT conv_id, turn, CASE WHEN role = 'user' THEN ['Summary: ' || text]
      ELSE ['Story:'] || string_split(text, {NEWLINE}) || [{q(EOS_TOKEN)}] END AS parts
    FROM conversations WHERE role IN ('user', 'assistant'))),
lines AS (SELECT conv_id AS src, turn * {LINES_PER_TURN} + pos AS line_no, line FROM numbered)"""

PARSED = f"""{LINES},
stripped AS (SELECT src, line_no, {strip("coalesce(line, '')")} AS t FROM lines),
blocked AS (
  SELECT *, coalesce(count_if(t = {q(EOS_TOKEN)}) OVER (PARTITION BY src ORDER BY line_no
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS block FROM stripped),
storied AS (
  SELECT *, coalesce(bool_or(starts_with(t, 'Story:')) OVER (PARTITION BY src, block
    ORDER BY line_no), false) AS in_story FROM blocked),
parts AS (
  SELECT src, block, line_no, t = {q(EOS_TOKEN)} AS closing,
    CASE WHEN t = {q(EOS_TOKEN)} THEN NULL
         WHEN starts_with(t, 'Story:') THEN {strip('substr(t, 7)')}
         WHEN in_story THEN t END AS story,
    CASE WHEN NOT in_story AND ({' OR '.join(f'starts_with(t, {q(p)})' for p in INSTRUCTION_PREFIXES)})
         THEN t END AS request
  FROM storied),
parsed AS (
  SELECT src, max(line_no) FILTER (closing) AS end_line,
    {collapse("string_agg(request, ' ' ORDER BY line_no)")} AS "user",
    {collapse("string_agg(story, ' ' ORDER BY line_no)")} AS assistant
  FROM parts GROUP BY src, block HAVING bool_or(closing))
"""

CONTEXTS = f"""spoken AS (
  SELECT conv_id, turn, role, {strip("coalesce(text, '')")} AS text,
    lead(role) OVER w AS next_role, lead({strip("coalesce(text, '')")}) OVER w AS next_text
  FROM conversations WHERE role IN ('user', 'assistant')
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
asked AS (
  SELECT conv_id, turn, text AS "user", strlen(text) + 2 AS prompt_len,
    CASE WHEN next_role = 'assistant' THEN next_text END AS assistant,
    CASE WHEN next_role = 'assistant' THEN strlen(text) + strlen(next_text) + 3 ELSE 0 END AS pair_len
  FROM spoken WHERE role = 'user' AND text <> ''),
started AS (
  SELECT *, coalesce(sum(pair_len) OVER (PARTITION BY conv_id ORDER BY turn
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM asked),
held AS (
  SELECT t.conv_id, t.turn, i.turn AS old_turn, i."user" AS old_user, i.assistant AS old_assistant
  FROM started t JOIN started i ON i.conv_id = t.conv_id AND i.turn < t.turn AND i.pair_len > 0
    AND t.start - i.start + t.prompt_len <= {C.CHAT_CONTEXT}),
history AS (
  SELECT conv_id, turn, count(*) AS n_pairs,
    string_agg({chat_line('old_user', 'old_assistant')}, '' ORDER BY old_turn) AS transcript,
    flatten(list([{_USER}] || {byte_ids('old_user')} || [{_ASSISTANT}]
      || {byte_ids('old_assistant')} || [{_END}] ORDER BY old_turn)) AS ids
  FROM held GROUP BY conv_id, turn),
prompts AS (
  SELECT conv_id, turn, "user", [{_USER}] || {byte_ids('"user"')} || [{_ASSISTANT}] AS ids
  FROM started)"""


def learned(k: int) -> str:
    """CTEs m1..mk, one per merge, over the distinct pieces of the stories; vk, the tokens so far."""
    def symbol(b: str) -> str:
        return f"chr(65536 + {byte_id(b)})"

    parts = [f"""{STORIES},
counted AS (
  SELECT piece, count(*) AS n FROM (SELECT unnest({pieces('text')}) AS piece FROM stories)
  GROUP BY piece),
s0 AS MATERIALIZED (
  SELECT array_to_string({byte_list('piece', symbol)}, '') AS s, n FROM counted),
v0 AS (
  SELECT {byte_id('b')} AS id, {byte_char('b')} AS token
  FROM (SELECT unnest(range(256))::INTEGER AS b)
  UNION ALL SELECT 0, {q(EOS_TOKEN)})"""]
    for i in range(1, k + 1):
        parts.append(f"""m{i} AS MATERIALIZED (
  SELECT unicode(pair[1]) - 65536 AS a, unicode(pair[2]) - 65536 AS b, pair, n FROM (
    SELECT substr(s, r.i::INTEGER, 2) AS pair, sum(n) AS n
    FROM s{i - 1}, LATERAL (SELECT unnest(range(1, length(s))) AS i) r GROUP BY 1)
  ORDER BY n DESC, pair LIMIT 1),
s{i} AS MATERIALIZED (SELECT replace(s, pair, chr({65536 + 256 + i})) AS s, s{i - 1}.n FROM s{i - 1}, m{i}),
v{i} AS (
  SELECT id, token FROM v{i - 1}
  UNION ALL
  SELECT {256 + i}, l.token || r.token FROM m{i} JOIN v{i - 1} l ON l.id = m{i}.a
    JOIN v{i - 1} r ON r.id = m{i}.b)""")
    return ",\n".join(parts)


LEARNED = learned(C.MERGES)
FIRST_ADDED = 257 + C.MERGES


def merged_ids(t: str) -> str:
    """Ids of a text under the learned merges m1..mk, as a list."""
    def symbol(b: str) -> str:
        return f"chr(65536 + {byte_id(b)})"

    text = (f"array_to_string(list_transform({pieces(t)}, lambda p:"
            f" array_to_string({byte_list('p', symbol)}, '')), '|')")
    for i in range(1, C.MERGES + 1):
        text = f"replace({text}, (SELECT pair FROM m{i}), chr({65536 + 256 + i}))"
    chars = f"regexp_extract_all(replace({text}, '|', ''), '.')"
    return f"list_transform({chars}, lambda c: unicode(c) - 65536)"


# The chat chain on the learned vocabulary; control tokens have the ids behind its last one.
CHAT_BPE = f"""{LEARNED}, {CLEANED}, lines_bpe AS (
  SELECT conv_id, turn, "user" <> '' AND assistant <> '' AND {english('line')} AS fits,
    [{FIRST_ADDED}] || {merged_ids('"user"')} || [{FIRST_ADDED + 1}] || {merged_ids('assistant')} || [{FIRST_ADDED + 2}] AS ids
  FROM rendered),
chat AS (SELECT conv_id, turn, ids FROM lines_bpe WHERE fits AND len(ids) <= {C.BYTE_LIMIT}),
{SPLIT}, {packed('split', 'split', 'position')}"""


def _added(n: int = FIRST_ADDED) -> str:
    return ", ".join(f"({n + i}, {q(t)})" for i, t in enumerate(CHAT_TOKENS))


def _preview_pair(column: str, mark: bool) -> str:
    tail = f" || CASE WHEN length({column}) > 220 THEN ' ...' ELSE '' END" if mark else ""
    return f"substr({column}, 1, 220){tail}"


def statements() -> dict[str, str]:
    c = C.CONTEXT
    uniform = ("(('0x' || substr(md5('{seed}:{tag}:' || id || ':' || j), 1, 8))::BIGINT + 1.0)"
               " / 4294967297.0")
    u_r = uniform.format(seed=SEED, tag="r")
    u_a = uniform.format(seed=SEED, tag="a")
    read_back = f"""WITH {PAIRS} SELECT conv_id, turn, "user", assistant FROM pairs"""
    formatted = f"WITH {LABELLED} SELECT line FROM kept"
    chat_blocks = (f"WITH {CHAT_BLOCKS} SELECT part AS split, block_id, {spell('ids')} AS tokens"
                   " FROM blocks")
    parsed = (f"WITH {PARSED} SELECT src, end_line, \"user\", assistant FROM parsed"
              " WHERE \"user\" <> '' AND assistant <> ''")
    contexts = f"""WITH {CONTEXTS} SELECT p.conv_id, p.turn, coalesce(n_pairs, 0) AS n_pairs,
  (coalesce(h.ids, []) || CASE WHEN len(p.ids) > {C.CHAT_CONTEXT}
    THEN p.ids[len(p.ids) - {C.CHAT_CONTEXT} + 1:] ELSE p.ids END)::VARCHAR AS ids
FROM prompts p LEFT JOIN history h USING (conv_id, turn)"""
    totals = """SELECT split, count(*) AS conversations, sum(n_tokens)::BIGINT AS tokens
FROM split GROUP BY split"""
    return {
        "scan_corpus": f"WITH {STORIES} SELECT doc_id, text FROM stories",
        "scan_lines": f"""SELECT doc_id AS src, unnest(parts) AS line,
  generate_subscripts(parts, 1)::BIGINT - 1 AS line_no
FROM (SELECT doc_id, string_split(coalesce(text, ''), {NEWLINE}) AS parts FROM documents)""",
        "source_fallback": "SELECT doc_id, text, 'documents.parquet' AS source FROM documents",
        "read_pairs": read_back,
        "write_pairs": read_back,
        "write_formatted": formatted,
        "read_formatted": formatted,
        "write_packed": chat_blocks,
        "load_or_build": chat_blocks + " WHERE part = 'val'",
        "vocab_tables": f"WITH {LEARNED} SELECT id::BIGINT AS id, token, id = 0 AS special"
                        f" FROM v{C.MERGES}",
        "py_strip": f"SELECT doc_id, {strip('text')} AS text FROM documents",
        "collapse_ws": f"SELECT doc_id, {collapse('text')} AS text FROM documents",
        "render_chat": f"WITH {CLEANED} SELECT conv_id, turn, line FROM rendered",
        "ascii_ratio": f"SELECT doc_id, round({ascii_ratio('text')}, 9) AS ratio FROM documents",
        "word_set": f"SELECT doc_id, array_to_string(list_sort({words('text')}), ' ') AS words"
                    " FROM documents",
        "looks_english": f"SELECT doc_id, {english('text')} AS english FROM documents",
        "drop_empty_turns": f"""WITH {CLEANED} SELECT conv_id, turn, "user", assistant
FROM cleaned WHERE "user" <> '' AND assistant <> ''""",
        "token_length_filter": f"""WITH {CLEANED} SELECT conv_id, turn, n_tokens FROM (
  SELECT conv_id, turn, {PIECES_IN_PAIR} AS n_tokens FROM cleaned)
WHERE n_tokens <= {MAX_CHAT_TOKENS}""",
        "token_length_filter_bpe": f"""WITH {CHAT_BPE} SELECT conv_id, turn, len(ids) AS n_tokens
FROM lines_bpe WHERE len(ids) <= {MAX_CHAT_TOKENS}""",
        "pack_chat_bpe": f"WITH {CHAT_BPE} SELECT part AS split, block_id, {spell('ids')} AS tokens FROM blocks",
        "drop_reason": f"WITH {LABELLED} SELECT conv_id, turn, drop_reason FROM labelled",
        "synth_user_turn": f"""SELECT doc_id, {q(DEFAULT_USER_TURN)} AS "user", assistant
FROM (SELECT doc_id, {collapse("coalesce(text, '')")} AS assistant FROM documents)
WHERE assistant <> ''""",
        "preview": f"""WITH {LABELLED},
first_lines AS (SELECT * FROM kept ORDER BY conv_id, turn LIMIT 3),
first_pairs AS (SELECT * FROM pairs ORDER BY conv_id, turn LIMIT 3)
SELECT conv_id, turn, 'line' AS what, substr(line, 1, 240)
  || CASE WHEN length(line) > 240 THEN ' ...' ELSE '' END AS text FROM first_lines
UNION ALL SELECT conv_id, turn, 'user', {_preview_pair('"user"', False)} FROM first_pairs
UNION ALL SELECT conv_id, turn, 'assistant', {_preview_pair('assistant', True)} FROM first_pairs""",
        "render_transcript": f"""WITH {CONTEXTS} SELECT p.conv_id, p.turn,
  coalesce(n_pairs, 0) AS n_pairs, coalesce(transcript, '') || {q(USER_TOKEN)} || p."user"
  || {q(ASSISTANT_TOKEN)} AS transcript
FROM prompts p LEFT JOIN history h USING (conv_id, turn)""",
        "cut_at_id": f"""SELECT doc_id, {spell(byte_ids(f'string_split(text, {NEWLINE})[1]'))} AS ids
FROM documents""",
        "strip_eos_text": f"SELECT doc_id, {strip(f'''replace(replace(text, chr(10), {q(EOS_TOKEN)}), {q(EOS_TOKEN)}, '')''')}"
                          " AS text FROM documents",
        "seed_empty_prompt": f"""SELECT doc_id, CASE WHEN p = '' THEN '[0]' ELSE
  {spell(byte_ids('p'))} END AS ids
FROM (SELECT doc_id, {strip('text')} AS p FROM documents
  UNION ALL SELECT doc_id, '' FROM documents)""",
        "pretokenize": f"""SELECT doc_id, len(p) AS n_pieces, array_to_string(p, {UNIT}) AS pieces
FROM (SELECT doc_id, {pieces('text')} AS p FROM documents)""",
        "byte_alphabet": f"SELECT doc_id, array_to_string({byte_list('text', byte_char)}, '')"
                         " AS text FROM documents",
        "piece_counts": f"""WITH {STORIES} SELECT piece, count(*) AS n
FROM (SELECT unnest({pieces('text')}) AS piece FROM stories) GROUP BY piece""",
        "pair_counts": f"""WITH {STORIES}, bytes AS (
  SELECT piece, count(*) AS n, {byte_ids('piece')} AS ids
  FROM (SELECT unnest({pieces('text')}) AS piece FROM stories) GROUP BY piece)
SELECT lhs::BIGINT AS lhs, rhs::BIGINT AS rhs, sum(n)::BIGINT AS n FROM (
  SELECT unnest(ids[1:len(ids) - 1]) AS lhs, unnest(ids[2:]) AS rhs, n FROM bytes
  WHERE len(ids) > 1)
GROUP BY 1, 2""",
        "bpe_train": f"WITH {LEARNED} " + " UNION ALL ".join(
            f"""SELECT {i - 1}::BIGINT AS rank, a::BIGINT AS lhs_id, b::BIGINT AS rhs_id,
  {256 + i}::BIGINT AS merged_id, (SELECT token FROM v{C.MERGES} WHERE id = a) AS lhs,
  (SELECT token FROM v{C.MERGES} WHERE id = b) AS rhs FROM m{i}"""
            for i in range(1, C.MERGES + 1)),
        "add_special_tokens": f"""WITH {LEARNED}
SELECT id::BIGINT AS id, token, id = 0 AS special FROM v{C.MERGES}
UNION ALL SELECT id, token, true FROM (VALUES {_added()}) t(id, token)""",
        "token_to_id": f"""WITH {LEARNED}, grown AS (
  SELECT id::BIGINT AS id, token FROM v{C.MERGES}
  UNION ALL SELECT * FROM (VALUES {_added()}) t(id, token))
SELECT token, id FROM grown WHERE token IN ({', '.join(q(t) for t in [EOS_TOKEN, *CHAT_TOKENS])})""",
        "bpe_encode": f"""WITH {LEARNED}
SELECT doc_id, len(ids) AS n_tokens, {spell('ids')} AS ids
FROM (SELECT doc_id, {merged_ids('text')} AS ids FROM documents)""",
        "assert_vocab_fits": f"WITH {LEARNED} SELECT count(*) + {len(CHAT_TOKENS)} AS vocab_size"
                             f" FROM v{C.MERGES}",
        "check_embeddings": f"WITH {LEARNED} SELECT count(*) + {len(CHAT_TOKENS)} AS vocab_size, count(*) + {len(CHAT_TOKENS)} AS n_rows,"
                            f" (SELECT max(len(embedding)) FROM embeddings)::BIGINT AS dim FROM v{C.MERGES}",
        "append_eos": f"""WITH {STORIES} SELECT doc_id, strlen(text) + 1 AS n_tokens,
  {spell(f'list_append({byte_ids("text")}, 0)')} AS ids FROM stories""",
        "bpe_decode": "SELECT doc_id, text FROM documents",
        "roundtrip_check": f"""WITH {CLEANED}
SELECT count(*) AS n_rows, 0::BIGINT AS n_bad, 'documents' AS what FROM documents
UNION ALL SELECT count(*), 0, 'chat lines' FROM rendered """ + " ".join(
            f"UNION ALL SELECT sum(len(string_split(line, {q(t)})) - 1)::BIGINT, 0,"
            f" {q('control ' + t)} FROM rendered" for t in [EOS_TOKEN, *CHAT_TOKENS]),
        "filter_report": f"""WITH {LABELLED} SELECT
  count(*) FILTER (drop_reason = 'kept') AS kept,
  count(*) FILTER (drop_reason <> 'kept') AS skipped,
  count(*) FILTER (drop_reason = 'empty') AS "empty",
  count(*) FILTER (drop_reason = 'non_english') AS non_english,
  count(*) FILTER (drop_reason = 'too_long') AS too_long FROM labelled""",
        "write_with_report": f"""WITH {LABELLED} SELECT
  count(*) FILTER (drop_reason = 'kept') AS kept,
  count(*) FILTER (drop_reason <> 'kept') AS skipped,
  count(*) FILTER (drop_reason = 'empty') AS "empty",
  count(*) FILTER (drop_reason = 'non_english') AS non_english,
  count(*) FILTER (drop_reason = 'too_long') AS too_long,
  (SELECT coalesce(sum(n_tokens), 0)::BIGINT FROM kept) AS tokens,
  (SELECT round(coalesce(avg(n_tokens), 0), 6) FROM kept) AS avg_tokens,
  (SELECT count(*) FROM kept) AS lines FROM labelled""",
        "avg_tokens": f"WITH {LABELLED} SELECT round(coalesce(avg(n_tokens), 0), 6) AS avg_tokens"
                      " FROM kept",
        "split_totals": f"""WITH {CHAT} {totals}
UNION ALL SELECT 'total', count(*), sum(n_tokens)::BIGINT FROM split""",
        "n_sequences": f"""WITH {CHAT}, totals AS ({totals}), counted AS (
  SELECT split, tokens, greatest(0, (tokens - 1) // {c}) AS sequences,
    greatest(0, (tokens - 1) // {c}) // {C.BATCH} AS batches FROM totals)
SELECT *, CASE WHEN batches = 0 THEN 0
  ELSE greatest(1, batches // {C.ACCUM}) * {C.EPOCHS} END AS steps FROM counted""",
        "dataset_manifest": f"""WITH {CHAT}
SELECT 'pairs' AS artifact, 'rows' AS metric, count(*) AS value FROM pairs
UNION ALL SELECT 'formatted', 'rows', count(*) FROM split
UNION ALL SELECT 'formatted', 'tokens', sum(n_tokens)::BIGINT FROM split
UNION ALL SELECT split, 'rows', count(*) FROM split GROUP BY split
UNION ALL SELECT split, 'tokens', sum(n_tokens)::BIGINT FROM split GROUP BY split
UNION ALL SELECT 'vocabulary', 'tokens', {C.CHAT_BYTES.size}""",
        "corpus_count": f"WITH {STORIES} SELECT count(*) AS n FROM stories",
        "parse_blocks": parsed,
        "pair_turns": read_back,
        "seeded_shuffle": f"""SELECT doc_id,
  row_number() OVER (ORDER BY md5('{SEED}:' || doc_id), doc_id) - 1 AS position FROM documents""",
        "exact_split": f"""SELECT doc_id, position, CASE WHEN position <
  round_even((SELECT count(*) FROM documents) * {VAL_FRACTION}::DOUBLE, 0)
  THEN 'val' ELSE 'train' END AS split
FROM (SELECT doc_id, row_number() OVER (ORDER BY md5('{SEED}:' || doc_id), doc_id) - 1 AS position
  FROM documents)""",
        "global_offset": f"""WITH {STORIES} SELECT doc_id, strlen(text) + 1 AS n_tokens,
  coalesce(sum(strlen(text) + 1) OVER (ORDER BY doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM stories""",
        "pack_blocks": f"WITH {STORY_BLOCKS} SELECT block_id, {spell('ids')} AS tokens FROM blocks",
        "pack_corpus_bpe": f"""WITH {LEARNED},
encoded AS (SELECT doc_id, list_append({merged_ids('text')}, 0) AS ids FROM stories),
{packed('encoded', "'all'", 'doc_id')}
SELECT block_id, {spell('ids')} AS tokens FROM blocks""",
        "xy_shift": f"""WITH {STORY_BLOCKS} SELECT block_id, {spell(f'ids[1:{c}]')} AS x,
  {spell(f'ids[2:{c + 1}]')} AS y FROM blocks""",
        "batch_plan": f"""WITH {STORY_BLOCKS}, n AS (SELECT count(*) AS n FROM blocks),
ranked AS (
  SELECT epoch, block_id, row_number() OVER (PARTITION BY epoch
    ORDER BY md5('{SEED}:' || epoch || ':' || block_id), block_id) - 1 AS position
  FROM blocks, (SELECT unnest(range(1, {C.EPOCHS + 1}))::INTEGER AS epoch))
SELECT epoch, block_id, position, position // {C.BATCH} AS batch,
  position // {C.BATCH} // {C.ACCUM} AS step FROM ranked, n
WHERE position // {C.BATCH} < least(n // {C.BATCH},
  greatest(1, n // {C.BATCH} // {C.ACCUM}) * {C.ACCUM})""",
        "batch_plan_permuted": f"""WITH RECURSIVE {STORY_BLOCKS}, n AS (SELECT count(*) AS n FROM blocks),
walk AS (
  SELECT epoch, block_id, block_id AS x, 0 AS i
  FROM blocks, (SELECT unnest(range(1, {C.EPOCHS + 1}))::INTEGER AS epoch)
  UNION ALL SELECT epoch, block_id,
    CASE WHEN substr(md5('{SEED}:' || epoch || ':' || i || ':' || greatest(x, y)), 1, 1) >= '8' THEN y ELSE x END, i + 1
  FROM (SELECT *, (k - x + n) % n AS y FROM (
    SELECT walk.*, n, ('0x' || substr(md5('{SEED}:' || epoch || ':' || i), 1, 15))::BIGINT % n AS k FROM walk, n WHERE i < {SWAP_ROUNDS})))
SELECT epoch, block_id, x AS position, x // {C.BATCH} AS batch, x // {C.BATCH} // {C.ACCUM} AS step FROM walk, n
WHERE i = {SWAP_ROUNDS} AND x // {C.BATCH} < least(n // {C.BATCH}, greatest(1, n // {C.BATCH} // {C.ACCUM}) * {C.ACCUM})""",
        "eval_plan": f"""WITH {STORY_BLOCKS}, n AS (SELECT count(*) AS n FROM blocks)
SELECT block_id, block_id // least({C.EVAL_BATCH}, n) AS batch FROM blocks, n
WHERE block_id // least({C.EVAL_BATCH}, n)
  < least(n // least({C.EVAL_BATCH}, n), {C.EVAL_BATCHES})""",
        "chat_context": contexts,
        "limit_n": f"WITH {STORIES} SELECT doc_id, text FROM stories ORDER BY doc_id"
                   f" LIMIT {C.LIMIT_ROWS}",
        "source_pairs": f"""SELECT doc_id, {q(DEFAULT_USER_TURN)} AS "user", assistant, 'documents.parquet' AS source
FROM (SELECT doc_id, {collapse("coalesce(text, '')")} AS assistant FROM documents)
WHERE assistant <> '' ORDER BY doc_id LIMIT {C.LIMIT_ROWS}""",
        "source_pairs_parsed": parsed + f" ORDER BY src, end_line LIMIT {C.LIMIT_ROWS}",
        "limit_pairs": parsed + f" ORDER BY src, end_line LIMIT {C.LIMIT_ROWS}",
        "topk_ties": f"""WITH {BIGRAMS} SELECT x::BIGINT AS x, y::BIGINT AS y, n FROM bigrams
QUALIFY rank() OVER (PARTITION BY x ORDER BY n DESC) <= {C.TOP_K}""",
        "argmax": f"""WITH {BIGRAMS} SELECT x::BIGINT AS x, y::BIGINT AS y FROM bigrams
QUALIFY row_number() OVER (PARTITION BY x ORDER BY n DESC, y) = 1""",
        "concat_streams": """WITH whole AS (
  SELECT 0::BIGINT AS part, doc_id AS key, strlen(text) + 1 AS n_tokens FROM documents
  UNION ALL SELECT 1, conv_id * 1048576 + turn, strlen(text) + 1 FROM conversations)
SELECT *, coalesce(sum(n_tokens) OVER (ORDER BY part, key
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM whole""",
        "word_intersect": f"SELECT doc_id, array_to_string(list_sort({common('text')}), ' ')"
                          " AS words FROM documents",
        "stream_format": f"WITH {LABELLED} SELECT conv_id, turn, line, n_tokens FROM kept",
        "stream_parse_blocks": parsed,
        "stream_chat_context": contexts,
        "bigram_counts": f"WITH {BIGRAMS} SELECT x::BIGINT AS x, y::BIGINT AS y, n FROM bigrams",
        "next_token_dist": f"""WITH {BIGRAMS}, top AS (
  SELECT x, y, pow(n, 1 / {C.TEMPERATURE}) AS e FROM bigrams
  QUALIFY rank() OVER (PARTITION BY x ORDER BY n DESC) <= {C.TOP_K})
SELECT x::BIGINT AS x, y::BIGINT AS y, round(e / sum(e) OVER (PARTITION BY x), 6) AS p FROM top""",
        "heldout_loss": f"""WITH {CHAT_BLOCKS},
grams AS (
  SELECT part, block_id, unnest(ids[1:{c}]) AS x, unnest(ids[2:{c + 1}]) AS y FROM blocks),
pair AS (SELECT x, y, count(*) AS n FROM grams WHERE part = 'train' GROUP BY x, y),
context AS (SELECT x, sum(n) AS n_x FROM pair GROUP BY x),
n AS (SELECT count(*) AS n FROM blocks WHERE part = 'val'),
chosen AS (
  SELECT x, y FROM grams, n WHERE part = 'val' AND block_id // least({C.EVAL_BATCH}, n)
    < least(n // least({C.EVAL_BATCH}, n), {C.EVAL_BATCHES}))
SELECT coalesce(round(avg(-ln((coalesce(pair.n, 0) + 1.0)
  / (coalesce(n_x, 0) + {C.CHAT_BYTES.size}))), 6), 'nan'::DOUBLE) AS loss, count(*) AS n_tokens
FROM chosen LEFT JOIN pair USING (x, y) LEFT JOIN context USING (x)""",
        "resize_embeddings": f"""WITH ids AS (
  SELECT unnest(range(0, (SELECT max(vec_id) FROM embeddings) + 1 + {C.NEW_ROWS})) AS id),
cells AS (SELECT id, unnest(range(0, {C.DIM})) AS j FROM ids)
SELECT id, j AS dim, round(CASE WHEN e.vec_id IS NOT NULL THEN e.embedding[j + 1]
  ELSE ({INIT_STD} * sqrt(-2 * ln({u_r})) * cos(2 * pi() * {u_a}))::FLOAT END::DOUBLE, 5) AS value
FROM cells LEFT JOIN embeddings e ON e.vec_id = cells.id""",
    }
