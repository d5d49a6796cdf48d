"""DuckDB SQL for the queries of this subpackage that SQL can express.

URL templates, HTML labels, pseudonyms, packing, quality rules, SimHash, token
alignment and periodic runs have none: they need a grown tree, a network, a cipher,
a tokenizer, hashes that DuckDB lacks or an automaton.  Tests hold these against
brute force, round trips or held-out pages instead.
"""

from __future__ import annotations

from .chat_format import ESCAPE, Template
from .source_mixing import Mixing

GAP = r"[\x20\x09-\x0D]+"
HAS_WORD = r"[^\x20\x09-\x0D]"


def _chr(text: str) -> str:
    """A string literal that may hold control characters."""
    return " || ".join(f"chr({ord(c)})" if ord(c) < 32 else f"'{c}'" for c in text).replace("' || '", "")


def chat_format(how: Template = Template()) -> str:
    escaped = f"replace(text, {_chr(ESCAPE)}, {_chr(ESCAPE + '0')})"
    for c in how.controls:
        escaped = f"replace({escaped}, '{c}', {_chr(c[0] + ESCAPE + '1' + c[1:])})"
    marks = len(how.turn_start) + len(how.role_end) + len(how.turn_end)
    return f"""
WITH said AS (
  SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
  UNION ALL SELECT -1, n, who, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(n, who)),
chats AS (
  SELECT conv_id, COUNT(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
         COALESCE(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
         string_agg(role, ',' ORDER BY turn, role, text) AS roles,
         CAST(SUM({marks} + length(role) + length({escaped})) AS BIGINT) AS formatted_chars
  FROM said GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars,
       sha256(loss) AS loss_sha256, formatted_chars,
       regexp_full_match(roles, '(system,)?user(,tool)*,assistant(,user(,tool)*,assistant)*') AS valid
FROM chats"""


def line_dedup(threshold: int = 80) -> str:
    return f"""
WITH lines AS (
  SELECT doc_id, line_no - 1 AS line_no, list_sort(list_distinct(list_filter(
           string_split_regex(lower(line), '{GAP}'), lambda x: x <> ''))) AS ws
  FROM (SELECT doc_id, UNNEST(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents)
  WHERE regexp_matches(line, '{HAS_WORD}')),
sets AS (
  SELECT ws, len(ws) AS n, MIN((doc_id, line_no)) AS place, row_number() OVER () AS id FROM lines GROUP BY ws),
words AS (SELECT id, n, place, UNNEST(ws) AS w FROM sets),
ranked AS (
  SELECT id, n, place, w, row_number() OVER (PARTITION BY id ORDER BY df, w) AS pos
  FROM words JOIN (SELECT w, COUNT(*) AS df FROM words GROUP BY w) USING (w)),
prefixes AS (SELECT * FROM ranked WHERE pos <= n - ({threshold} * n + 99) // 100 + 1),
pairs AS (
  SELECT DISTINCT a.id AS later, b.id AS earlier
  FROM prefixes a JOIN prefixes b ON a.w = b.w AND a.place > b.place
  WHERE 100 * LEAST(a.n, b.n) >= {threshold} * GREATEST(a.n, b.n)),
matched AS (
  SELECT DISTINCT later AS id
  FROM (SELECT later, a.n AS na, b.n AS nb, len(list_intersect(a.ws, b.ws)) AS common
        FROM pairs JOIN sets a ON a.id = later JOIN sets b ON b.id = earlier)
  WHERE 100 * common >= {threshold} * (na + nb - common)),
judged AS (
  SELECT doc_id, line_no, matched.id IS NOT NULL OR (doc_id, line_no) <> place AS removed
  FROM lines JOIN sets USING (ws) LEFT JOIN matched USING (id))
SELECT doc_id, COUNT(*) AS n_lines,
       COALESCE(string_agg(CAST(line_no AS VARCHAR), ',' ORDER BY line_no) FILTER (removed), '') AS removed_lines
FROM judged GROUP BY doc_id"""


def decontamination(size: int = 5, threshold: int = 80) -> str:
    def grams(table: str, key: str) -> str:
        return f"""
  SELECT DISTINCT {key}, array_to_string(list_slice(ws, i, i + {size - 1}), ' ') AS gram
  FROM (SELECT {key}, ws, UNNEST(range(1, len(ws) - {size - 2})) AS i
        FROM (SELECT {key}, list_filter(string_split_regex(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS ws
              FROM {table}))"""
    return f"""
WITH held AS ({grams("documents", "doc_id")}),
asked AS ({grams("benchmark", "item_id")}),
sizes AS (SELECT item_id, COUNT(*) AS n_shingles FROM asked GROUP BY item_id)
SELECT doc_id, item_id, n_shingles, COUNT(*) AS n_found
FROM held JOIN asked USING (gram) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id, n_shingles HAVING 100 * COUNT(*) >= {threshold} * n_shingles"""


def warc_fixity(per_file: int = 1024) -> str:
    head = len("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: \r\nContent-Length: \r\n\r\n\r\n\r\n")
    return f"""
WITH sized AS (
  SELECT page_id, {head} + strlen(COALESCE(url, '')) + strlen(COALESCE(html, ''))
                  + strlen(CAST(strlen(COALESCE(html, '')) AS VARCHAR)) AS length
  FROM pages),
placed AS (
  SELECT page_id, length, page_id % (SELECT (COUNT(*) + {per_file - 1}) // {per_file} FROM pages) AS file
  FROM sized),
files AS (
  SELECT page_id, file, length, CAST(COALESCE(SUM(length) OVER (
           PARTITION BY file ORDER BY page_id, length
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset"
  FROM placed)
SELECT page_id, file, "offset", length,
       CASE WHEN page_id % 89 = 7 THEN 'missing' ELSE 'changed' END AS status
FROM files WHERE page_id % 89 = 7 OR page_id % 97 = 5"""


def _hash60(*parts: str) -> str:
    return "CAST('0x' || substr(md5(" + " || ':' || ".join(parts) + "), 1, 15) AS BIGINT)"


def source_mixing(how: Mixing = Mixing()) -> str:
    """The words a mix takes of each document.  Which shard draws a slot does not
    matter here: of every source the numbers 0 .. slots - 1 are used, each once."""
    weight = " ".join(f"WHEN {k} THEN {w}" for k, w in enumerate(how.weights))
    tweak = f"'{how.seed}:' || rank || ':' || epoch"
    key = _hash60(tweak, "'key'", "r") + " % (blocks - 1)"
    mirror = f"({key} - x + blocks - 1) % (blocks - 1)"
    swap = _hash60(tweak, "r", f"GREATEST(x, {mirror})") + " & 1 = 1"
    return f"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(COALESCE(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         md5(COALESCE(CAST(doc_id AS VARCHAR), '') || ':' || COALESCE(text, '')) AS mark
  FROM documents),
placed AS (
  SELECT *, CASE WHEN nth = 1 THEN mark ELSE md5(mark || ':' || nth) END AS place
  FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, source, size, mark) AS nth FROM sized)),
ranked AS (
  SELECT source, CAST(SUM(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM placed GROUP BY source),
weighted AS (
  SELECT *, CASE rank % {len(how.weights)} {weight} END AS weight FROM ranked),
levels AS (
  SELECT *, row_number() OVER by_need AS n,
         CAST(SUM(source_size) OVER () - COALESCE(SUM({how.most} * source_size) OVER earlier, 0) AS DOUBLE)
         / (SUM(weight) OVER () - COALESCE(SUM(weight) OVER earlier, 0)) AS level
  FROM weighted
  WINDOW by_need AS (ORDER BY source_size / weight, rank),
         earlier AS (ORDER BY source_size / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
chosen AS (SELECT arg_min(level, n) AS level FROM levels WHERE weight * level <= {how.most} * source_size),
aimed AS (
  SELECT rank, source, source_size, LEAST(CAST({how.most} * source_size AS DOUBLE), weight * chosen.level) AS target,
         (source_size + {how.block - 1}) // {how.block} AS blocks
  FROM weighted, chosen),
sources AS (
  SELECT *, epochs * blocks + (words - epochs * source_size + {how.block - 1}) // {how.block} AS slots
  FROM (SELECT *, words // GREATEST(source_size, 1) AS epochs
        FROM (SELECT *, CAST(FLOOR(target + 0.5) AS BIGINT) AS words FROM aimed))),
numbers AS (
  SELECT *, number // blocks AS epoch, number % blocks AS spot
  FROM (SELECT *, UNNEST(range(slots)) AS number FROM sources)),
slots AS (
  SELECT rank, CASE WHEN spot = blocks - 1 OR blocks < 3 THEN spot
                    ELSE list_reduce(list_prepend(spot, range({how.rounds})), lambda x, r:
                           CASE WHEN {swap} THEN {mirror} ELSE x END) END AS block,
         CASE WHEN epoch < epochs THEN {how.block}
              ELSE LEAST({how.block}, words - epochs * source_size - spot * {how.block}) END AS words
  FROM numbers),
laid AS (
  SELECT rank, place, size, CAST(SUM(size) OVER (PARTITION BY rank ORDER BY place) AS BIGINT) - size AS start
  FROM placed JOIN sources ON placed.source IS NOT DISTINCT FROM sources.source WHERE size > 0),
pieces AS (
  SELECT rank, place, block, GREATEST(start, block * {how.block}) - block * {how.block} AS first,
         LEAST(start + size, (block + 1) * {how.block}) - block * {how.block} AS past
  FROM (SELECT *, UNNEST(range(start // {how.block}, (start + size - 1) // {how.block} + 1)) AS block FROM laid)),
used AS (
  SELECT rank, place, CAST(SUM(LEAST(past, words) - first) AS BIGINT) AS taken
  FROM pieces JOIN slots USING (rank, block) WHERE words > first GROUP BY rank, place)
SELECT doc_id, size, source_size, target, COALESCE(taken, 0) AS taken
FROM placed JOIN sources ON placed.source IS NOT DISTINCT FROM sources.source
LEFT JOIN used USING (rank, place)"""


def oracle_queries() -> dict[str, str]:
    return {"op1_chat_format": chat_format(), "op2_line_dedup": line_dedup(),
            "op5_decontamination": decontamination(), "op7_warc_fixity": warc_fixity(),
            "op11_source_mixing": source_mixing()}
