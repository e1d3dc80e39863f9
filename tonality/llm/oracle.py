"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP9 = rf"""
WITH base AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t, {_WORDS} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), windows AS (
  SELECT k, i, array_to_string(w[i:i + 7], ' ') AS v
  FROM base, unnest(range(1, len(w) - 6)) AS r(i)
), repeated AS (
  SELECT k, i FROM windows QUALIFY count(*) OVER (PARTITION BY k, v) > 1
), gaps AS (
  SELECT k, least(8, coalesce(lead(i) OVER (PARTITION BY k ORDER BY i) - i, 8)) AS n FROM repeated
), covered AS (
  SELECT k, sum(n) AS n_repeat_words FROM gaps GROUP BY k
), m AS (
  SELECT doc_id, len(w) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_upper,
         len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM base LEFT JOIN covered USING (k)
), judged AS (
  SELECT *, n_words < 20 AS r0, 100 * n_repeat_words > 30 * n_words AS r1, 5 * n_symbols > n_words AS r2,
         10 * n_upper > 3 * word_chars AS r3, n_lines >= 4 AND 2 * n_dup_lines > n_lines AS r4,
         2 * word_chars < 5 * n_words OR word_chars > 15 * n_words AS r5
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_upper, n_lines, n_dup_lines, n_repeat_words,
       CAST(r0 AS BIGINT) + 2 * CAST(r1 AS BIGINT) + 4 * CAST(r2 AS BIGINT) + 8 * CAST(r3 AS BIGINT)
         + 16 * CAST(r4 AS BIGINT) + 32 * CAST(r5 AS BIGINT) AS failure_bits,
       r0 OR r1 AS base_failed, NOT (r0 OR r1 OR r2 OR r3 OR r4 OR r5) AS kept
FROM judged
"""

OP4 = rf"""
WITH base AS (
  SELECT row_number() OVER () AS k, doc_id, {_WORDS} AS w FROM documents
), windows AS (
  SELECT k, doc_id, i, array_to_string(w[i:i + 49], ' ') AS v FROM base, unnest(range(1, len(w) - 48)) AS r(i)
), repeated AS (
  SELECT k, i FROM windows QUALIFY doc_id > min(doc_id) OVER (PARTITION BY v)
), covered AS (
  SELECT DISTINCT k, i + j AS i FROM repeated, unnest(range(50)) AS r(j)
), gone AS (
  SELECT k, list(i) AS g FROM covered GROUP BY k
), kept AS (
  SELECT doc_id, len(w) AS n_words, coalesce(len(g), 0) AS n_removed,
         list_filter(w, lambda x, i: g IS NULL OR NOT list_contains(g, i)) AS rest
  FROM base LEFT JOIN gone USING (k)
)
SELECT doc_id, n_words, n_removed, sha256(array_to_string(rest, ' ')) AS kept_sha256 FROM kept
"""

OP10 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e,
         sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS n
  FROM embeddings WHERE label IS NOT NULL
), links AS MATERIALIZED (
  SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE a.n > 0 AND b.n > 0 AND list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.93
), reach AS (
  SELECT u AS node, u AS root FROM links
  UNION
  SELECT l.v, r.root FROM reach r JOIN links l ON l.u = r.node
), part AS (
  SELECT node, min(root) AS component_id FROM reach GROUP BY node
), degree AS (
  SELECT u AS node, count(*) AS n_links FROM links GROUP BY u
)
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, vec_id) AS component_id,
       coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN part ON part.node = vec_id LEFT JOIN degree ON degree.node = vec_id
"""

#: crc32 of UTF-8 strings: a table of 256 steps, and a reduction over the bytes.
_CRC_TABLE = """crc AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) AS r(i)
)"""


def _crc32(text: str) -> str:
    """The unsigned crc32 of ``text``, beside a row of ``crc``."""
    byte = f"CAST('0x' || substr(hex({text}), 2 * CAST(b AS INTEGER) + 1, 2) AS BIGINT)"
    count = f"CAST(length(hex({text})) / 2 AS BIGINT)"
    listed = f"list_transform(range({count}), lambda b: {byte})"
    return f"xor(list_reduce(list_prepend(4294967295, {listed}), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295)"


_LEAST = "list_min(list_filter([{}], lambda x: x.cost < 1000000))"
_NEVER = "{{'cost': 1000000, 'audit': '', 'text': ''}}"


def _edit(state: str, cost: str, added: str, lines: list[str], when: str = "true") -> str:
    """A state after an edit; ``lines`` are appended, joined by newlines."""
    text = f"{state}.text"
    for line in lines:
        text += (" || " if state == "s0" and text == "s0.text" else " || chr(10) || ") + line
    never = _NEVER.format()
    return (
        f"CASE WHEN {when} AND {state}.cost < 1000000 THEN {{'cost': {state}.cost + {cost}, 'audit': {state}.audit || '{added}', "
        f"'text': {text}}} ELSE {never} END"
    )


def _repair_sql() -> str:
    keep, user, assistant = "role || ':' || text", "'user:' || text", "'assistant:' || text"
    stays = "NOT gone"
    states = {0: [], 1: [], 2: [], 3: []}
    for s in range(4):
        states[s].append(_edit(f"s{s}", "3", "D", []))
    states[1].append(_edit("s0", "late", "K", [keep], f"{stays} AND letter = 's'"))
    for s in range(4):
        for to, letter, rerole, before in ((2, "u", user, "'assistant:'"), (3, "a", assistant, "'user:'")):
            fits = (s == 2) == (to == 3)
            extra, mark, first = ("", "", []) if fits else (" + 2", "I", [before])
            states[to].append(_edit(f"s{s}", f"late{extra}", f"{mark}K", [*first, keep], f"{stays} AND letter = '{letter}'"))
            states[to].append(_edit(f"s{s}", f"late + 2{extra}", f"{mark}R", [*first, rerole], stays))
    steps = ",\n    ".join(f"coalesce({_LEAST.format(', '.join(found))}, {_NEVER.format()}) AS s{s}" for s, found in states.items())
    last = ", ".join(
        [
            _edit("s0", "0", "", []),
            _edit("s1", "4", "II", ["'user:'", "'assistant:'"]),
            _edit("s2", "2", "I", ["'assistant:'"]),
            _edit("s3", "0", "", []),
        ]
    )
    never = _NEVER.format()
    white = r"[^\x20\x09-\x0D]"
    return rf"""
WITH RECURSIVE {_CRC_TABLE}, raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS place
  FROM conversations
), hashed AS (
  SELECT conv_id, turn, role, text, {_crc32("place")} % 20 AS h FROM raw, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
         CASE h WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM hashed, range(CASE WHEN h = 3 THEN 2 ELSE 1 END) WHERE h <> 0
), convs AS (
  SELECT conv_id, row_number() OVER () AS k FROM (SELECT DISTINCT conv_id FROM conversations)
), numbered AS (
  SELECT k, turn, role, text, row_number() OVER w AS i, left(role, 1) AS letter,
         NOT regexp_matches(text, '{white}') AS blank,
         regexp_extract(text, '({white})[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?') AS open
  FROM damaged JOIN convs ON damaged.conv_id IS NOT DISTINCT FROM convs.conv_id
  WINDOW w AS (PARTITION BY k ORDER BY turn NULLS FIRST, role, md5(text))
), seen AS (
  SELECT *, i > min(i) OVER (PARTITION BY k, role, text) AS again FROM numbered
), judged AS (
  SELECT *, blank OR again AS gone, CASE WHEN NOT blank AND open THEN 1 ELSE 0 END AS late,
         lag(letter) OVER (PARTITION BY k ORDER BY i) || letter AS pair
  FROM seen
), dp AS (
  SELECT k, CAST(0 AS BIGINT) AS i, {{'cost': 0, 'audit': '', 'text': ''}} AS s0, {never} AS s1, {never} AS s2, {never} AS s3 FROM convs
  UNION ALL
  SELECT dp.k, judged.i, {steps.replace("' || text", "' || judged.text")}
  FROM dp JOIN judged ON judged.k = dp.k AND judged.i = dp.i + 1
), done AS (
  SELECT k, {_LEAST.format(last)} AS best FROM dp QUALIFY i = max(i) OVER (PARTITION BY k)
), counted AS (
  SELECT k, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (again AND NOT blank) AS duplicate, count(*) FILTER (open AND NOT blank AND NOT again) AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n_rows
  FROM judged GROUP BY k
)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(best.cost AS BIGINT) AS cost,
       best.audit AS audit, sha256(best.text) AS repaired_sha256, coalesce(n_rows, 0) AS n_rows
FROM convs JOIN done USING (k) LEFT JOIN counted USING (k)
"""


OP11 = _repair_sql()

OP12 = rf"""
WITH RECURSIVE {_CRC_TABLE}, run AS (
  SELECT doc_id, r, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS r FROM documents) GROUP BY ALL
), hashed AS (
  SELECT r, n, {_crc32("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || r")} AS h FROM run, crc
), typed AS (
  SELECT CASE WHEN h % 199 = 0 THEN substring(r, 1, h % length(r)) || substring(r, h % length(r) + 2) ELSE r END AS word, n FROM hashed
), words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM typed WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), holes AS (
  SELECT word, i, substring(word, 1, i) AS a, substring(word, i + 2) AS b FROM words, unnest(range(length(word))) AS r(i)
), links AS MATERIALIZED (
  SELECT x.word AS word, y.word AS other FROM holes x JOIN holes y USING (i, a, b) WHERE x.word <> y.word
  UNION SELECT words.word, holes.word FROM words JOIN holes ON words.word = holes.a || holes.b
  UNION SELECT holes.word, words.word FROM words JOIN holes ON words.word = holes.a || holes.b
), near AS (
  SELECT links.word, count(*) AS n_near, first(other ORDER BY o.n DESC, other) AS best, max(o.n) AS best_n
  FROM links JOIN words o ON o.word = other GROUP BY links.word
), formed AS MATERIALIZED (
  SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 5 * n THEN best END AS form,
         CASE WHEN best_n >= 5 * n THEN best_n END AS form_n
  FROM words LEFT JOIN near USING (word)
), chain AS (
  SELECT word, word AS root, form AS next FROM formed
  UNION ALL
  SELECT chain.word, formed.word, formed.form FROM chain JOIN formed ON formed.word = chain.next
)
SELECT formed.word, formed.form, root, n, n_near, form_n FROM formed JOIN chain ON chain.word = formed.word AND chain.next IS NULL
"""

ORACLE_SQL: dict[str, str] = {
    "op4_substring_dedup": OP4,
    "op9_quality_ledger": OP9,
    "op10_nn_descent": OP10,
    "op11_conversation_repair": OP11,
    "op12_spelling_variants": OP12,
}
