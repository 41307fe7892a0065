"""DuckDB SQL of the dealt operators that SQL can express."""

from __future__ import annotations

# Letters are A-Z, a-z and every character from U+00C0 on, as the rule counts lead bytes
# from 0xC0; U+0080 to U+00BF have the lead byte 0xC2 and so count as well.
_OP1 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (
    SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
        [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
    FROM d
),
i AS (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w),
g AS (SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g FROM i),
r AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n > 1),
c AS (
    SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
    FROM r, (SELECT unnest(range(0, 3)) AS k) GROUP BY doc_id
),
s AS (
    SELECT w.doc_id, len(words) AS n_words,
        length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words, len(lines) AS n_lines,
        length(regexp_replace(t, '[\x00-\x40\x5B-\x60\x7B-\x7F]', '', 'g')) AS n_letters
    FROM w LEFT JOIN c USING (doc_id)
),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT (base_failed OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines
        OR NOT (2 * n_words <= word_chars AND word_chars <= 20 * n_words)
        OR 2 * n_letters < word_chars) AS kept
FROM b
"""

# Words of documents and items, every window of the items, its occurrences.
_OP10 = r"""
WITH low AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
),
bench AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
),
starts AS (SELECT item_id, w, least(len(w), 10) AS k, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
    FROM bench WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM starts),
sizes AS (SELECT DISTINCT k FROM windows),
places AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM low, sizes WHERE len(w) >= k),
found AS (
    SELECT doc_id, i, p.k, item_id
    FROM (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM places) p
    JOIN windows USING (k, g)
),
hits AS (
    SELECT doc_id, count(DISTINCT pos) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + k)) AS pos FROM found) GROUP BY doc_id
),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
    coalesce(n_items, 0) AS n_items, sha256(coalesce(list, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM low LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

# Payloads are compared as texts.
_OP4 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS t, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY t) AS last FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(t) AS payload_digest,
    CASE WHEN n >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN n >= 1000 AND page_id < last THEN last END AS refers_to
FROM m
"""


def _op13(levels: int = 8) -> str:
    """Trees level by level: t holds the trees of the sources, u the one above them.
    `levels` of 16 allow for 16 ** levels leaves a source and as many sources."""

    def leaf(text: str) -> str:
        parts = [
            f"coalesce(CAST(octet_length(encode(CAST({c} AS VARCHAR))) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"
            for c in ("doc_id", "source", "lang", "n_chars", text)
        ]
        return f"sha256({' || '.join(parts)})"

    def up(name: str, k: int) -> str:
        below, key = f"{name}{k}", "s, i // 16"
        return f"""
{name}{k}_runs AS (
    SELECT s, i, h, n, CASE WHEN n > 1 THEN coalesce(string_agg(h, '') OVER (PARTITION BY {key} ORDER BY i
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') ELSE '' END AS l,
        CASE WHEN n > 1 THEN coalesce(string_agg(h, '') OVER (PARTITION BY {key} ORDER BY i
            ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') ELSE '' END AS r
    FROM {below}
),
{name}{k + 1} AS (
    SELECT s, i // 16 AS i, CASE WHEN n > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE any_value(h) END AS h,
        CAST((n + 15) // 16 AS BIGINT) AS n
    FROM {below} GROUP BY s, i // 16, n
),"""

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    sql = f"""
WITH d AS (
    SELECT doc_id, coalesce('s' || source, '') AS s, {leaf("text")} AS leaf, {leaf(lower)} AS other FROM documents
),
c AS (
    SELECT *, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
        count(*) OVER (PARTITION BY s) AS n
    FROM d
),
t0 AS (SELECT s, i, leaf AS h, n FROM c),"""
    sql += "".join(up("t", k) for k in range(levels))
    sql += f"""
roots AS (SELECT s, h AS subroot, row_number() OVER (ORDER BY encode(s)) - 1 AS j, count(*) OVER () AS m FROM t{levels}),
u0 AS (SELECT 0 AS s, j AS i, subroot AS h, m AS n FROM roots),"""
    sql += "".join(up("u", k) for k in range(levels))
    sql += f"""
crc AS ({_CRC32}),
f0 AS (
    SELECT doc_id, leaf, subroot, s, i, j, n, m, '' AS p, CASE WHEN crc % 5 = 0 THEN other ELSE leaf END AS f
    FROM c JOIN roots USING (s) LEFT JOIN crc USING (doc_id)
),"""
    for step, (name, at, key) in enumerate(
        [("t", k, f"x.s = f.s AND x.i = f.i // {16**k}") for k in range(levels)]
        + [("u", k, f"x.i = f.j // {16**k}") for k in range(levels)]
    ):
        sql += f"""
f{step + 1} AS (
    SELECT f.* REPLACE (p || l || r AS p, CASE WHEN x.n > 1 THEN sha256(l || f || r) ELSE f END AS f)
    FROM f{step} f JOIN {name}{at}_runs x ON {key}
),"""
    return sql[:-1] + f"""
SELECT doc_id, leaf, subroot, h AS root, sha256(p) AS proof_sha256, f AS folded_root, f = h AS verified
FROM f{2 * levels}, u{levels}
"""


# crc32 of the decimal ids, byte by byte and bit by bit.
_CRC32 = """
    WITH RECURSIVE ids AS (
        SELECT DISTINCT doc_id, CAST(doc_id AS VARCHAR) AS t FROM documents WHERE doc_id IS NOT NULL
    ),
    step AS (
        SELECT doc_id, t, 0 AS pos, CAST(4294967295 AS UBIGINT) AS c FROM ids
        UNION ALL
        SELECT doc_id, t, pos + 1,
            list_reduce(
                [xor(c, CAST(ascii(substring(t, pos + 1, 1)) AS UBIGINT))] || [CAST(0 AS UBIGINT) FOR x IN range(8)],
                lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a // 2, CAST(3988292384 AS UBIGINT)) ELSE a // 2 END
            )
        FROM step WHERE pos < length(t)
    )
    SELECT doc_id, xor(c, CAST(4294967295 AS UBIGINT)) AS crc FROM step WHERE pos = length(t)
"""

ORACLE: dict[str, str] = {
    "op1_quality": _OP1,
    "op4_warc": _OP4,
    "op10_decontaminate": _OP10,
    "op13_manifest": _op13(),
}
