"""SQL of the registered queries that SQL can express, for DuckDB."""

from __future__ import annotations

_MIX = r"""
WITH docs AS (
    SELECT doc_id, source, coalesce(text, '') AS body,
           CAST(CASE WHEN text IS NULL THEN 0
                     ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS BIGINT) AS size
    FROM documents
),
keyed AS (
    SELECT doc_id, source, size,
           -ln((CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || body), 1, 13)
                          AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0)
           / CASE WHEN length(body) = 0 THEN 0.1
                  ELSE greatest(0.1, 1 - CAST(length(body) - length(translate(body, '#*$%&|<>', '')) AS DOUBLE)
                                         / length(body)) END AS key
    FROM docs
),
sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
    FROM docs GROUP BY source
),
levels AS (
    SELECT *, CAST(source_size * 3 AS DOUBLE) / weight AS stop_level,
           CAST(sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER (
                    ORDER BY CAST(source_size * 3 AS DOUBLE) / weight, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
           / sum(weight) OVER (ORDER BY CAST(source_size * 3 AS DOUBLE) / weight, source NULLS LAST
                               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM sources
),
goals AS (
    SELECT source, source_size,
           CASE WHEN stop_level <= level THEN CAST(source_size * 3 AS DOUBLE)
                ELSE weight * (SELECT level FROM levels WHERE stop_level > level
                               ORDER BY stop_level, source NULLS LAST LIMIT 1) END AS target
    FROM levels
),
budgets AS (
    SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs,
           target - CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END * source_size AS budget
    FROM goals
),
placed AS (
    SELECT k.doc_id, k.size, b.source_size, b.target, b.epochs, b.budget,
           coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
    FROM keyed k JOIN budgets b ON k.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, size, source_size, target,
       CAST(size * (epochs + CASE WHEN start + size / 2.0 <= budget THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM placed
"""

# The formatted length follows from the escapes: one backslash more per backslash or control string.
_CHAT = r"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS said FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || said || chr(10), '' ORDER BY turn, role, said)) AS turns_sha256,
       CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(said) END), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN said END, '' ORDER BY turn, role, said), ''))
           AS loss_sha256,
       CAST(sum(length('<turn><text></turn>') + 1
                + length(regexp_replace(role, '(\\|<turn>|<text>|</turn>)', '\\\1', 'g'))
                + length(regexp_replace(said, '(\\|<turn>|<text>|</turn>)', '\\\1', 'g'))) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id
"""

def _edited(state: str, cost: str, letter: str, line: str | None = None) -> str:
    """SQL: the way on from ``state`` with one more edit before it; a way is its key (cost, audit) and its lines."""
    lines = f"{state}.t" if line is None else f"list_prepend({line}, {state}.t)"
    return (f"{{'k': printf('%010d', CAST(left({state}.k, 10) AS BIGINT) + {cost}) || '{letter}' || substr({state}.k, 11),"
            f" 't': {lines}}}")


def _best(*ways: str) -> str:
    return f"list_sort([{', '.join(ways)}])[1]"


def _repair_sql() -> str:
    """Costs and audits from the last row of each conversation back to its first, all four states at once."""
    nowhere = "{'k': '9999999999', 't': CAST([] AS VARCHAR[])}"
    here = "CAST([] AS VARCHAR[])"
    kept = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    due = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
    steps = []
    for s in range(4):
        stays = " ".join(f"WHEN initial = '{i}' THEN " + _edited(f"s{to}", "extra", "K", "role || ':' || text")
                         for i, to in kept[s].items())
        role, to = due[s]
        relabelled = _edited(f"s{to}", "1 + extra", "R", f"'{role}:' || text")
        steps.append(_best(_edited(f"s{s}", "2", "D"),
                           f"CASE WHEN must_go THEN {nowhere} {stays} ELSE {nowhere} END",
                           f"CASE WHEN must_go THEN {nowhere} ELSE {relabelled} END") + f" AS b{s}")
    ask, answer = "'user:'", "'assistant:'"
    asked = _best("b2", _edited("b3", "5", "I", answer))
    answered = _best("b3", _edited("b2", "5", "I", ask))
    return rf"""
WITH RECURSIVE said AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
    FROM conversations
),
marked AS (
    SELECT *, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
                                  list_transform(string_split(key, ''), lambda c: CAST(ascii(c) AS BIGINT))),
                  lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), CAST(range(8) AS BIGINT[])),
                      lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)),
              CAST(4294967295 AS BIGINT)) % 20 AS kind
    FROM said
),
damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM marked WHERE kind <> 0
),
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS pos,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
           CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'x' END AS initial
    FROM damaged
),
faulty AS (
    SELECT *, CASE WHEN NOT regexp_matches(text, '[^ 	-]') THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                   WHEN NOT regexp_matches(text, '[.!?][ 	-]*\z') THEN 'truncated' ELSE '' END AS fault,
           lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) || initial AS pair
    FROM numbered
),
priced AS (
    SELECT *, fault IN ('blank', 'duplicate') AS must_go, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS extra
    FROM faulty
),
counted AS (
    SELECT conv_id, max(pos) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM priced GROUP BY conv_id
),
ways AS (
    SELECT conv_id, n AS i, {{'k': '0000000000', 't': {here}}} AS s0,
           {{'k': '0000000010II', 't': [{ask}, {answer}]}} AS s1,
           {{'k': '0000000005I', 't': [{answer}]}} AS s2, {{'k': '0000000000', 't': {here}}} AS s3
    FROM counted
    UNION ALL
    SELECT conv_id, i - 1, {_best("b0", _edited("f2", "5", "I", ask))}, {_best("b1", _edited("f2", "5", "I", ask))}, f2, f3
    FROM (SELECT *, {asked} AS f2, {answered} AS f3
          FROM (SELECT w.conv_id, w.i, {", ".join(steps)}
                FROM ways w JOIN priced r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.pos = w.i))
)
SELECT o.conv_id, CAST(coalesce(c.gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(c.blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(c.duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(c.truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(c.illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(left(w.s0.k, 10), '0') AS BIGINT) AS cost,
       coalesce(substr(w.s0.k, 11), '') AS audit, sha256(coalesce(array_to_string(w.s0.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ways w ON w.conv_id IS NOT DISTINCT FROM o.conv_id AND w.i = 0
"""


_ARCHIVE = """
WITH held AS (
    SELECT page_id, coalesce(html, '') AS html, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
           min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
    FROM pages
),
typed AS (
    SELECT *, payload_bytes >= 100 AND first IS NOT NULL AND page_id IS DISTINCT FROM first AS repeats FROM held
)
SELECT page_id, payload_bytes, sha256(html) AS payload_digest,
       CASE WHEN repeats THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN repeats THEN first END AS refers_to
FROM typed
"""

_PHRASES = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                               'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
grams AS (
    SELECT lang, k, unnest(list_transform(generate_series(1, len(w) - k + 1),
                                          lambda i: array_to_string(list_slice(w, i, i + k - 1), ' '))) AS phrase
    FROM words, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k
),
found AS (SELECT lang, phrase, k, count(*) AS f FROM grams GROUP BY lang, phrase, k HAVING count(*) >= 30),
cuts AS (
    SELECT c.lang, c.phrase, c.k, c.f AS a, cut,
           array_to_string(list_slice(string_split(c.phrase, ' '), 1, cut), ' ') AS left_part,
           array_to_string(list_slice(string_split(c.phrase, ' '), cut + 1, c.k), ' ') AS right_part
    FROM found c, (SELECT unnest([1, 2, 3]) AS cut) WHERE c.k >= 2 AND cut < c.k
),
scored AS (
    SELECT c.lang, c.phrase, c.k, c.a, l.f AS l, r.f AS r,
           CAST((CAST(2000000 AS HUGEINT) * c.a) // (l.f + r.f) AS BIGINT) AS score,
           row_number() OVER (PARTITION BY c.lang, c.phrase
                              ORDER BY (CAST(2000000 AS HUGEINT) * c.a) // (l.f + r.f), c.cut) AS place
    FROM cuts c JOIN found l ON l.lang = c.lang AND l.phrase = c.left_part
                JOIN found r ON r.lang = c.lang AND r.phrase = c.right_part
),
covering AS (
    SELECT lang, sub, max(f) AS f FROM (
        SELECT lang, f, unnest([array_to_string(list_slice(string_split(phrase, ' '), s, s + m - 1), ' ')
                                FOR s IN range(1, k - m + 2)]) AS sub
        FROM found, (SELECT unnest([2, 3]) AS m) WHERE m < k)
    GROUP BY lang, sub
),
kept AS (
    SELECT s.* FROM scored s LEFT JOIN covering c ON c.lang = s.lang AND c.sub = s.phrase
    WHERE s.place = 1 AND (c.f IS NULL OR CAST(100 AS HUGEINT) * c.f < CAST(80 AS HUGEINT) * s.a)
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT r.lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l,
       CAST(r AS BIGINT) AS r, t.n, score
FROM ranked r JOIN totals t ON t.lang = r.lang WHERE rank <= 2000
"""

LLM_ORACLE_SQL: dict[str, str] = {
    "op3_chat": _CHAT,
    "op8_mixing": _MIX,
    "op11_repair": _repair_sql(),
    "op12_warc": _ARCHIVE,
    "op13_collocations": _PHRASES,
}
