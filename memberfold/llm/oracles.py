"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from memberfold.llm.common import LOWER, UPPER, WORD
from memberfold.llm.url_reputation import FLOOR, LEAST_PRIOR, MOST_PRIOR, TWO_LABEL_SUFFIXES, WIDTH

_WORDS = f"coalesce(regexp_extract_all(text, '{WORD}'), [])"
_LOWERED = f"coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{WORD}'), [])"
_SHINGLES = """CASE WHEN len(w) >= 5
        THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END"""

BENCHMARK_CONTAINMENT = f"""
    WITH dw AS (SELECT doc_id, coalesce(regexp_extract_all(lower(text), '{WORD}'), []) AS w FROM documents),
    bw AS (SELECT item_id, coalesce(regexp_extract_all(lower(text), '{WORD}'), []) AS w FROM benchmark),
    lengths AS (SELECT DISTINCT len(w) AS k FROM bw WHERE len(w) BETWEEN 1 AND 4),
    d AS (
        SELECT doc_id, unnest({_SHINGLES}) AS s FROM dw
        UNION
        SELECT doc_id, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS s
        FROM dw JOIN lengths ON len(w) >= k),
    b AS (SELECT DISTINCT item_id, unnest({_SHINGLES}) AS s FROM bw),
    sizes AS (SELECT item_id, count(*) AS n FROM b GROUP BY item_id)
    SELECT doc_id, item_id, CAST(any_value(n) AS INTEGER) AS item_size,
           CAST(count(*) AS BIGINT) AS n_found
    FROM d JOIN b USING (s) JOIN sizes USING (item_id)
    GROUP BY doc_id, item_id HAVING count(*) * 100 >= any_value(n) * 80"""

REPEATED_PASSAGES = f"""
    WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
    windows AS (
        SELECT doc_id, i, min(doc_id) OVER (PARTITION BY p) AS first_doc FROM (
            SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS p
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d))),
    words AS (
        SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
    marked AS (
        SELECT doc_id, i, word, coalesce(max(first_doc < doc_id) OVER (
            PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), false) AS gone
        FROM words LEFT JOIN windows USING (doc_id, i)),
    sums AS (
        SELECT doc_id, count(*) FILTER (gone) AS n_removed,
               string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept
        FROM marked GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
           CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
           sha256(coalesce(kept, '')) AS kept_sha256
    FROM d LEFT JOIN sums USING (doc_id)"""

NGRAM_JOIN = f"""
    WITH RECURSIVE s AS (
        SELECT DISTINCT doc_id, unnest({_SHINGLES}) AS s
        FROM (SELECT doc_id, {_LOWERED} AS w FROM documents)),
    sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    links AS (
        SELECT x.doc_id AS a, y.doc_id AS b
        FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id
        JOIN sizes m ON m.doc_id = x.doc_id JOIN sizes n ON n.doc_id = y.doc_id
        GROUP BY x.doc_id, y.doc_id, m.n, n.n HAVING count(*) * 100 >= (m.n + n.n - count(*)) * 80),
    reached AS (
        SELECT doc_id, doc_id AS other FROM documents
        UNION SELECT doc_id, b FROM reached JOIN links ON other = a)
    SELECT doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles,
           min(other) AS component_id
    FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id"""

_AFTER = "regexp_extract(url, '(?s)^.*?://(.*)$', 1)"
_TWO = ", ".join(f"'{s}'" for s in TWO_LABEL_SUFFIXES)


def _labels(n: int) -> str:
    return f"array_to_string(string_split(host, '.')[-{n}:], '.')"


def _rule(name: str) -> str:
    host, _, path = name.partition("/")
    fits = f"(host = '{host}' OR host LIKE '%.{host}') AND path LIKE '/{path}%'"
    return f"WHEN {fits} THEN '{name}'"


def _worth(level: str, mean: str) -> str:
    one = f"n * {mean} * (1 - {mean})"
    spread = f"(sum(pow(good - n * {mean}, 2)) - sum({one}))"
    return f"""(SELECT CASE WHEN coalesce(sum({one} * (n - 1)), 0) <= 0 OR {spread} <= 0 THEN {MOST_PRIOR}
        ELSE least({MOST_PRIOR}, greatest({LEAST_PRIOR}, sum({one} * (n - 1)) / {spread} - 1)) END
        FROM {level})"""


def url_reputation(block: tuple[str, ...], allow: tuple[str, ...]) -> str:
    rules = sorted({*block, *allow}, key=lambda r: (-len(r), r))
    blocked = ", ".join(f"'{r}'" for r in block)
    return f"""
    WITH p AS (
        SELECT page_id,
               coalesce(translate(regexp_extract({_AFTER}, '^[^/?#]*'), '{UPPER}', '{LOWER}'), '') AS host,
               coalesce(regexp_extract({_AFTER}, '^[^/?#]*([^?#]*)', 1), '') AS path
        FROM pages),
    l AS (SELECT doc_id, max(quality = 1) AS good FROM labels GROUP BY doc_id),
    h AS (
        SELECT host, count(good) AS n, coalesce(sum(CAST(good AS INTEGER)), 0) AS good,
               CASE WHEN {_labels(2)} IN ({_TWO}) THEN {_labels(3)} ELSE {_labels(2)} END AS domain,
               CASE WHEN {_labels(2)} IN ({_TWO}) THEN {_labels(2)} ELSE {_labels(1)} END AS suffix
        FROM p LEFT JOIN l ON doc_id = page_id GROUP BY host),
    s0 AS (
        SELECT suffix, sum(n) AS n, sum(good) AS good,
               (SELECT (sum(good) + 1) / (sum(n) + 2) FROM h) AS m FROM h GROUP BY suffix),
    s1 AS (SELECT suffix, (good + k * m) / (n + k) AS m FROM (SELECT *, {_worth("s0", "m")} AS k FROM s0)),
    d0 AS (
        SELECT suffix, domain, sum(n) AS n, sum(good) AS good, any_value(m) AS m
        FROM h JOIN s1 USING (suffix) GROUP BY suffix, domain),
    d1 AS (
        SELECT suffix, domain, (good + k * m) / (n + k) AS m
        FROM (SELECT *, {_worth("d0", "m")} AS k FROM d0)),
    h0 AS (SELECT host, n, good, m FROM h JOIN d1 USING (suffix, domain)),
    h1 AS (
        SELECT host, n, k, (good + k * m) / (n + k) AS m FROM (SELECT *, {_worth("h0", "m")} AS k FROM h0)),
    judged AS (
        SELECT page_id, host, path, CASE {" ".join(map(_rule, rules))} END AS rule,
               least(1.0, m + {WIDTH} * sqrt(m * (1 - m) / (n + k + 1))) AS upper
        FROM p JOIN h1 USING (host))
    SELECT page_id, host, path, rule, CASE WHEN rule IN ({blocked}) THEN 'block'
        WHEN rule IS NOT NULL THEN 'allow' WHEN upper < {FLOOR} THEN 'block' ELSE 'allow' END AS verdict
    FROM judged"""


def _state(cost: str, audit: str, text: str) -> str:
    return f"{{'c': {cost}, 'a': {audit}, 't': {text}}}"


def _edit(of: str, edit: str, cost: str, text: str = "''") -> str:
    return _state(f"{of}.c + {cost}", f"{of}.a || '{edit}'", f"{of}.t || {text}")


def _when(condition: str, value: str) -> str:
    return f"CASE WHEN {condition} THEN {value} END"


def _spoken(of: str, edit: str, cost: str, role: str, text: str = "''") -> str:
    line = f"chr(10) || '{role}:' || {text}"
    return _when(f"{of} IS NOT NULL", _edit(of, edit, cost, line))


def _inserted() -> str:
    """States, longest first, after insertions if any: nothing, system, user, assistant."""
    both = "chr(10) || 'user:' || chr(10) || 'assistant:'"
    twice = lambda q: _when(f"{q} IS NOT NULL", _edit(q, "II", "4", both))
    user = [_spoken(q, "I", "2", "user") for q in ("n", "s", "a")]
    assistant = [_spoken("u", "I", "2", "assistant"), *map(twice, ("n", "s"))]
    return (
        f"n, s, list_min([u, {', '.join(user)}]) AS u, list_min([a, {', '.join(assistant)}]) AS a"
    )


def _turned() -> str:
    """States after a turn of a role, a text, and the cost of leaving it truncated."""
    may = "NOT gone AND {0} IS NOT NULL AND starts_with(role, '{1}')"
    line = "chr(10) || role || ':' || text"
    keep = lambda q, r: _when(may.format(q, r), _edit(q, "K", "more", line))
    rerole = lambda q, role: f"CASE WHEN NOT gone THEN {_spoken(q, 'R', '2 + more', role, 'text')} END"
    drop = lambda q: _when(f"{q} IS NOT NULL", _edit(q, "D", "3"))
    user = [x for q in ("n", "s", "a") for x in (keep(q, "u"), rerole(q, "user"))]
    return f"""{drop("n")} AS n, list_min([{drop("s")}, {keep("n", "s")}]) AS s,
        list_min([{drop("u")}, {", ".join(user)}]) AS u,
        list_min([{drop("a")}, {keep("u", "a")}, {rerole("u", "assistant")}]) AS a"""


_STATE = "STRUCT(c BIGINT, a VARCHAR, t VARCHAR)"
# crc32 by its rule, bit by bit: eight steps a byte.
_CRC32 = """xor(4294967295::UBIGINT, list_reduce(
    list_prepend(4294967295::UBIGINT, list_transform(string_split({0}, ''), lambda x: ascii(x)::UBIGINT)),
    lambda p, q: list_reduce([xor(p, q), 0::UBIGINT, 0, 0, 0, 0, 0, 0, 0],
        lambda c, z: xor(c >> 1, (c & 1) * 3988292384::UBIGINT))))"""
_KEY = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"
_SPACE = r"[\x20\x09-\x0D]"

CONVERSATION_REPAIR = f"""
    WITH RECURSIVE kinds AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               {_CRC32.format(_KEY)} % 20 AS kind FROM conversations),
    live AS (
        SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
               CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
               unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
        FROM kinds WHERE kind <> 0),
    numbered AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
               regexp_replace(text, '{_SPACE}+\\z', '') AS bare FROM live),
    told AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth FROM numbered),
    faults AS (
        SELECT conv_id, turn, i, role, text, bare = '' AS blank, bare <> '' AND nth > 1 AS duplicate,
               bare <> '' AND nth = 1 AND right(bare, 1) NOT IN ('.', '!', '?') AS truncated,
               left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) || left(role, 1) AS pair
        FROM told),
    steps AS (
        SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i,
               CAST({_state("0", "''", "''")} AS {_STATE}) AS n,
               CAST(NULL AS {_STATE}) AS s, CAST(NULL AS {_STATE}) AS u, CAST(NULL AS {_STATE}) AS a
        FROM conversations
        UNION ALL
        SELECT conv_id, i, {_turned()} FROM (
            SELECT x.conv_id, f.i, f.role, f.text, f.blank OR f.duplicate AS gone,
                   CAST(f.truncated AS BIGINT) AS more, {_inserted()}
            FROM steps x JOIN faults f ON f.conv_id IS NOT DISTINCT FROM x.conv_id AND f.i = x.i + 1)),
    ends AS (
        SELECT conv_id, list_min([n, a]) AS best FROM (
            SELECT conv_id, {_inserted()} FROM steps x
            WHERE NOT EXISTS (SELECT 1 FROM faults f
                WHERE f.conv_id IS NOT DISTINCT FROM x.conv_id AND f.i = x.i + 1))),
    sums AS (
        SELECT conv_id, count(*) AS rows, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps,
               count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
               count(*) FILTER (truncated) AS truncated,
               count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
        FROM faults GROUP BY conv_id)
    SELECT e.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
           CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
           CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
           CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, best.c AS cost, best.a AS audit,
           sha256(substr(best.t, 2)) AS repaired_sha256
    FROM ends e LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM e.conv_id"""


def fill_in_middle(seed: int, plain_percent: int, spm_percent: int) -> str:
    draw = lambda k: f"CAST('0x' || substr(h, {8 * k - 7}, 8) AS UBIGINT)"
    marked = " OR ".join(f"contains(text, '{mark}')" for mark in ("<P>", "<S>", "<M>"))
    return f"""
    WITH d AS (
        SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
               sha256('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
    cuts AS (
        SELECT doc_id, text, n, CAST({draw(1)} % (n + 1) AS BIGINT) AS x,
               CAST({draw(2)} % (n + 1) AS BIGINT) AS y,
               CASE WHEN text = '' OR {marked} OR {draw(3)} % 100 >= {100 - plain_percent} THEN 'plain'
                    WHEN {draw(4)} % 100 < {spm_percent} THEN 'spm' ELSE 'psm' END AS form FROM d),
    parts AS (
        SELECT doc_id, text, n, form, least(x, y) AS p, greatest(x, y) - least(x, y) AS m,
               substr(text, 1, least(x, y)) AS prefix,
               substr(text, least(x, y) + 1, greatest(x, y) - least(x, y)) AS middle,
               substr(text, greatest(x, y) + 1) AS suffix FROM cuts)
    SELECT doc_id, CAST(n AS BIGINT) AS n, form,
           CASE WHEN form <> 'plain' THEN p END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN m END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text
               WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
               ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
           sha256(text) AS restored_sha256
    FROM parts"""


def largest_products(k: int, every: int, column: str) -> str:
    return f"""
    WITH v AS (
        SELECT row_number() OVER () AS row, vec_id,
               list_transform({column}, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND {column} IS NOT NULL
            AND len(list_filter({column}, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scores AS (
        SELECT q.row AS q, q.vec_id AS query_id, c.vec_id,
               coalesce(list_sum(list_transform(range(1, least(len(q.v), len(c.v)) + 1),
                   lambda i: q.v[i] * c.v[i])), 0) AS score
        FROM v q JOIN v c ON q.row <> c.row WHERE q.vec_id % {every} = 0),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id) AS rank FROM scores)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score
    FROM ranked WHERE rank <= {k}"""
