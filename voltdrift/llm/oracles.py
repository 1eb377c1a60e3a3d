"""The queries that SQL can say, as DuckDB SQL. The others need a hash, a tokenizer or a model that SQL lacks."""

_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

#: One row with the table by which crc32 takes a byte, and an expression for crc32 of an ASCII text under it.
_CRC_TABLE = """
    bytes AS (
        SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS of
        FROM range(256) AS r(i)
    )"""


def _crc32(text: str) -> str:
    codes = f"list_transform(string_split({text}, ''), lambda x: CAST(ord(x) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda c, b: xor(c >> 8, bytes.of[(xor(c, b) & 255) + 1])), 4294967295)"


def _add(state: str, letter: str, cost: str | int) -> str:
    """A cost of eight digits and the edits after it, with one more edit before them."""
    return f"printf('%08d', CAST({state}[1:8] AS BIGINT) + {cost}) || '{letter}' || {state}[9:]"


def _best(state: str, onward: str, kept: dict[str, str]) -> str:
    """The cheapest, then ASCII-least, edits from a state that do not begin with an insertion."""
    keeps = "".join(f"WHEN '{role}' THEN {_add(to, 'K', 'cut')} " for role, to in kept.items())
    return f"least({_add(state, 'D', 3)}, CASE WHEN gone THEN NULL ELSE {_add(onward, 'R', '(2 + cut)')} END, CASE WHEN gone THEN NULL ELSE CASE initial {keeps} END END)"


_REPAIR = f"""
    WITH RECURSIVE {_CRC_TABLE},
    hit AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
            {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS hit
        FROM conversations, bytes
    ),
    turns AS (
        SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
            CASE hit WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE WHEN hit = 3 THEN 2 ELSE 1 END)) AS copy
        FROM hit WHERE hit <> 0
    ),
    placed AS (
        SELECT *, left(role, 1) AS initial, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS tail,
            row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i
        FROM turns
    ),
    marked AS (
        SELECT *, CASE WHEN tail = '' THEN 'blank' WHEN min(i) OVER (PARTITION BY conv_id, role, text) < i THEN 'duplicate' WHEN right(tail, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
            lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au') AS illegal
        FROM placed
    ),
    symbols AS (SELECT conv_id, i, initial, fault IN ('blank', 'duplicate') AS gone, CAST(fault = 'truncated' AS INTEGER) AS cut FROM marked),
    counted AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS n,
            count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
            count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal
        FROM marked GROUP BY conv_id
    ),
    least_edits AS (
        SELECT conv_id, n AS i, '00000000' AS e, '00000004II' AS s, '00000002I' AS u, '00000000' AS a FROM counted
        UNION ALL
        SELECT conv_id, i, least(e, {_add("u", "I", 2)}), least(s, {_add("u", "I", 2)}), u, a
        FROM (
            SELECT conv_id, i, e, s, least(u, {_add("a", "I", 2)}) AS u, least(a, {_add("u", "I", 2)}) AS a
            FROM (
                SELECT m.conv_id, m.i - 1 AS i, {_best("e", "u", {"s": "s", "u": "u"})} AS e, {_best("s", "u", {"u": "u"})} AS s,
                    {_best("u", "a", {"a": "a"})} AS u, {_best("a", "u", {"u": "u"})} AS a
                FROM least_edits AS l JOIN symbols AS m ON m.i = l.i AND m.conv_id IS NOT DISTINCT FROM l.conv_id
            )
        )
    ),
    audits AS (SELECT conv_id, CAST(e[1:8] AS BIGINT) AS cost, e[9:] AS audit FROM least_edits WHERE i = 0),
    letters AS (SELECT conv_id, unnest(string_split(audit, '')) AS letter, unnest(range(len(audit))) AS spot FROM audits WHERE audit <> ''),
    edits AS (SELECT *, count(*) FILTER (letter <> 'I') OVER (PARTITION BY conv_id ORDER BY spot) AS i FROM letters),
    left_over AS (
        SELECT e.conv_id, letter, CASE WHEN letter <> 'I' THEN text ELSE '' END AS text, CASE WHEN letter = 'K' THEN role END AS role,
            row_number() OVER (PARTITION BY e.conv_id ORDER BY spot) AS place
        FROM edits AS e LEFT JOIN marked AS m ON m.i = e.i AND m.conv_id IS NOT DISTINCT FROM e.conv_id WHERE letter <> 'D'
    ),
    spoken AS (
        SELECT *, coalesce(role, CASE WHEN (place % 2 = 1) <> coalesce(left(first(role) OVER (PARTITION BY conv_id ORDER BY place), 1) = 's', false)
            THEN 'user' ELSE 'assistant' END) AS speaker
        FROM left_over
    ),
    hashes AS (SELECT conv_id, sha256(string_agg(speaker || ':' || text, chr(10) ORDER BY place)) AS repaired_sha256 FROM spoken GROUP BY conv_id)
    SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
        coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) AS c
    LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM c.conv_id
    LEFT JOIN audits ON audits.conv_id IS NOT DISTINCT FROM c.conv_id
    LEFT JOIN hashes ON hashes.conv_id IS NOT DISTINCT FROM c.conv_id
"""

_TRIE = f"""
    WITH {_CRC_TABLE},
    own AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS n
        FROM conversations WHERE conv_id IS NOT NULL
    ),
    c AS (SELECT conv_id, conv_id - conv_id % 20 AS base, {_crc32("CAST(conv_id AS VARCHAR)")} % 4 AS h FROM (SELECT DISTINCT conv_id FROM own), bytes),
    rebuilt AS (
        SELECT c.conv_id, n, role, text FROM c JOIN own ON own.conv_id = base WHERE n <= h
        UNION ALL SELECT c.conv_id, n, role, text FROM c JOIN own ON own.conv_id = c.conv_id WHERE n > h
    ),
    placed AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY n) AS d, sha256(role) || sha256(text) AS turn, text FROM rebuilt),
    paths AS (
        SELECT conv_id, d, string_agg(turn, '') OVER (PARTITION BY conv_id ORDER BY d) AS prefix, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words FROM placed
        UNION ALL SELECT conv_id, 0, '', 0 FROM c
    ),
    keyed AS (SELECT *, lag(prefix) OVER (PARTITION BY conv_id ORDER BY d) AS above, d = max(d) OVER (PARTITION BY conv_id) AS ends FROM paths),
    nodes AS (
        SELECT prefix, min(conv_id) AS conv_id, min(d) AS depth, count(*) AS n_convs, min(words) AS words, min(above) AS above,
            sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
        FROM keyed GROUP BY prefix
    ),
    children AS (SELECT above AS prefix, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY above),
    subtrees AS (
        SELECT p.prefix, sum((n_convs - 1) * nodes.words) AS saved_tokens, count(*) FILTER (children.prefix IS NULL) AS n_leaves
        FROM nodes LEFT JOIN children USING (prefix) JOIN paths AS p ON p.conv_id = nodes.conv_id AND p.d <= nodes.depth GROUP BY p.prefix
    )
    SELECT nodes.conv_id, nodes.depth, up.conv_id AS parent_conv_id, nodes.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
        CAST(saved_tokens AS BIGINT) AS saved_tokens, nodes.ends_sha256
    FROM nodes JOIN subtrees USING (prefix) LEFT JOIN children USING (prefix) LEFT JOIN nodes AS up ON up.prefix = nodes.above
"""

ORACLES = {
    "op11_conversation_repair": _REPAIR,
    "op13_conversation_trie": _TRIE,
    "op5_decontamination": f"""
        WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w FROM documents),
        i AS (SELECT item_id, w, least(10, len(w)) AS size FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
        windows AS (
            SELECT DISTINCT item_id, size, w[p : p + size - 1] AS piece
            FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS p FROM i)
        ),
        sizes AS (SELECT DISTINCT size FROM windows),
        places AS (
            SELECT r, size, p, w[p : p + size - 1] AS piece
            FROM (SELECT r, size, w, unnest(range(1, len(w) - size + 2)) AS p FROM d, sizes)
        ),
        hits AS (SELECT r, p, size, item_id FROM places JOIN windows USING (size, piece)),
        inside AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest(range(p, p + size)) AS q FROM hits) GROUP BY r),
        items AS (
            SELECT r, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
            FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item_id FROM hits) GROUP BY r
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(inside.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
            sha256(coalesce(ids, '')) AS items_sha256, inside.n IS NOT NULL AS contaminated
        FROM d LEFT JOIN inside USING (r) LEFT JOIN items USING (r)
    """,
    "op7_mtree_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        s AS (
            SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
            FROM v AS a JOIN v AS b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0
        ),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
        SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM ranked WHERE n <= 5
    """,
}
