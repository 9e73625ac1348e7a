"""SQL of those queries of this package that SQL can express, written apart from the operators."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _low(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}')"


def _words(table: str, key: str, text: str, pattern: str) -> str:
    return f"(SELECT {key}, row_number() OVER () AS rid, regexp_extract_all({text}, '{pattern}') AS words FROM {table})"


_SPACED = r"[^\x20\x09-\x0D]+"
_PLAIN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_TURN_ORDER = "ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST"


def _escaped(text: str) -> str:
    return f"replace(replace({text}, '&', '&amp;'), '<', '&lt;')"

#: CRC-32 of a decimal id: a byte enters with each first of eight shifts.
_CRC32 = """(xor(list_reduce(list_prepend(cast(4294967295 AS bigint),
        flatten([[cast(ascii(x) AS bigint), 0, 0, 0, 0, 0, 0, 0] for x in string_split(cast(conv_id AS varchar), '')])),
        lambda c, b: CASE WHEN xor(c, b) & 1 = 1 THEN xor(xor(c, b) >> 1, 3988292384) ELSE xor(c, b) >> 1 END), 4294967295))"""

#: Digests of the 2, 4, ... 64 bytes from each place on, each from two of half the length; null where a text ends before.
_DOUBLED = "".join(
    f"      v{2 * n} AS (SELECT rid, p, md5({v} || lead({v}, {n}) OVER (PARTITION BY rid ORDER BY p)) AS v FROM {'b' if n == 1 else f'v{n}'}),\n"
    for n, v in ((1, "h"), (2, "v"), (4, "v"), (8, "v"), (16, "v"), (32, "v"))
)


SQL = {
    "op5_exact_top_k": """WITH v AS (
        SELECT vec_id, [cast(floor(256e0 * cast(x AS double)) AS bigint) for x in embedding] AS e FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND NOT list_contains([coalesce(NOT isfinite(x), true) for x in embedding], true)),
      s AS (SELECT a.vec_id AS query_id, b.vec_id, cast(list_inner_product(cast(a.e AS double[]), cast(b.e AS double[])) AS bigint) AS score
        FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0)
      SELECT query_id, cast(place AS integer) AS rank, vec_id, score
      FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM s) WHERE place <= 5""",
    "op6_chat_format": f"""WITH turns AS (
        SELECT conv_id, turn, role, text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
      full_turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM turns)
      SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' {_TURN_ORDER})) AS turns_sha256,
        cast(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS bigint) AS loss_chars,
        sha256(coalesce(string_agg(text, '' {_TURN_ORDER}) FILTER (role = 'assistant'), '')) AS loss_sha256,
        cast(sum(15 + length({_escaped('text')}) + length(replace({_escaped('role')}, chr(10), '&#10;'))) AS bigint) AS formatted_chars
      FROM full_turns GROUP BY conv_id""",
    "op7_substring_dedup": f"""WITH w AS {_words('documents', 'doc_id', "coalesce(text, '')", _SPACED)},
      win AS (SELECT rid, i, array_to_string(words[i:i + 34], ' ') AS k FROM (SELECT rid, words, unnest(range(1, len(words) - 33)) AS i FROM w)),
      rep AS (SELECT k FROM win GROUP BY k HAVING count(*) > 1),
      hit AS (SELECT DISTINCT rid, unnest(range(i, i + 35)) AS p FROM win WHERE k IN (SELECT k FROM rep)),
      each AS (SELECT rid, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM w),
      kept AS (SELECT rid, string_agg(word, ' ' ORDER BY p) AS text FROM each WHERE (rid, p) NOT IN (SELECT rid, p FROM hit) GROUP BY rid),
      gone AS (SELECT rid, count(*) AS n FROM hit GROUP BY rid)
      SELECT doc_id, cast(len(words) AS bigint) AS n_words, coalesce(gone.n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
      FROM w LEFT JOIN gone USING (rid) LEFT JOIN kept USING (rid)""",
    "op8_decontamination": f"""WITH d AS {_words('documents', 'doc_id', _low('text'), _PLAIN)},
      b AS {_words('benchmark', 'item_id', _low('text'), _PLAIN)},
      bw AS (SELECT item_id, n, array_to_string(words[i:i + n - 1], ' ') AS k
        FROM (SELECT item_id, words, least(10, len(words)) AS n, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM b WHERE len(words) > 0)),
      dw AS (SELECT rid, i, n, array_to_string(words[i:i + n - 1], ' ') AS k
        FROM (SELECT rid, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw))),
      met AS (SELECT dw.rid, dw.i, dw.n, bw.item_id FROM dw JOIN bw USING (k, n)),
      hit AS (SELECT rid, count(*) AS n FROM (SELECT DISTINCT rid, unnest(range(i, i + n)) AS p FROM met) GROUP BY rid),
      item AS (SELECT rid, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
        FROM (SELECT DISTINCT rid, cast(item_id AS varchar) AS id FROM met WHERE item_id IS NOT NULL) GROUP BY rid)
      SELECT doc_id, cast(len(words) AS bigint) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(item.n, 0) AS n_items,
        sha256(coalesce(item.ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
      FROM d LEFT JOIN hit USING (rid) LEFT JOIN item USING (rid)""",
    "op9_ngram_jaccard": f"""WITH RECURSIVE w AS {_words('documents', 'doc_id', _low('text'), _SPACED)},
      g AS (SELECT DISTINCT rid, array_to_string(words[i:i + 4], ' ') AS k
        FROM (SELECT rid, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM w WHERE len(words) > 0)),
      sizes AS (SELECT rid, count(*) AS n FROM g GROUP BY rid),
      shared AS (SELECT a.rid AS x, b.rid AS y, count(*) AS n FROM g a JOIN g b ON a.k = b.k AND a.rid <> b.rid GROUP BY 1, 2),
      link AS (SELECT x, y FROM shared JOIN sizes a ON a.rid = x JOIN sizes b ON b.rid = y WHERE 100 * shared.n >= 80 * (a.n + b.n - shared.n)),
      reach AS (SELECT rid AS x, rid AS y FROM w UNION SELECT reach.x, link.y FROM reach JOIN link ON link.x = reach.y)
      SELECT w.doc_id, coalesce(sizes.n, 0) AS n_shingles, min(o.doc_id) AS component_id
      FROM w LEFT JOIN sizes USING (rid) JOIN reach ON reach.x = w.rid JOIN w o ON o.rid = reach.y GROUP BY w.rid, w.doc_id, sizes.n""",
    "op12_suffix_dedup": """WITH d AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id NULLS LAST, text) AS rid, regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS x FROM documents),
      b AS (SELECT rid, unnest(x) AS h, generate_subscripts(x, 1) - 1 AS p FROM d),
"""
    + _DOUBLED
    + """
      s AS (SELECT rid, p AS i, k FROM (SELECT rid, p, v || lead(v, 36) OVER (PARTITION BY rid ORDER BY p) AS k FROM v64) WHERE k IS NOT NULL),
      head AS (SELECT k, min(rid) AS rid, arg_min(i, rid * 4294967296 + i) AS i FROM s GROUP BY k HAVING count(*) > 1),
      again AS (SELECT s.rid, s.i FROM s JOIN head USING (k) WHERE s.rid <> head.rid OR s.i <> head.i),
      near AS (SELECT b.rid, b.p, b.h, max(again.i) OVER (PARTITION BY b.rid ORDER BY b.p ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
        FROM b LEFT JOIN again ON again.rid = b.rid AND again.i = b.p),
      edge AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY rid ORDER BY p), false) AS opens FROM near),
      one AS (SELECT rid, count(*) AS n, count(*) FILTER (gone) AS removed, count(*) FILTER (opens) AS spans,
        coalesce(string_agg(h, '' ORDER BY p) FILTER (NOT gone), '') AS kept FROM edge GROUP BY rid)
      SELECT doc_id, coalesce(n, 0) AS n_bytes, coalesce(removed, 0) AS n_removed, coalesce(spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
      FROM d LEFT JOIN one USING (rid)""",
    "op13_prefix_trie": f"""WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS r FROM conversations WHERE conv_id IS NOT NULL),
      n AS (SELECT conv_id, count(*) AS n FROM t GROUP BY conv_id),
      c AS (SELECT conv_id, conv_id - conv_id % 5 AS base, {_CRC32} % 9 AS h FROM n),
      f AS (SELECT c.*, least(h, coalesce(b.n, 0)) AS head FROM c LEFT JOIN n b ON b.conv_id = c.base),
      turn AS (SELECT f.conv_id, t.r AS d, t.role, t.text FROM f JOIN t ON t.conv_id = f.base AND t.r <= f.head
        UNION ALL SELECT f.conv_id, t.r - f.h + f.head, t.role, t.text FROM f JOIN t ON t.conv_id = f.conv_id AND t.r > f.h),
      path AS (SELECT conv_id, 0 AS d, '' AS k, 0 AS bytes FROM c
        UNION ALL SELECT conv_id, d, md5(string_agg(length(role) || ':' || role || length(text) || ':' || text, '' ORDER BY d) OVER (PARTITION BY conv_id ORDER BY d)), strlen(text) FROM turn),
      node AS (SELECT d, k, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes FROM path GROUP BY d, k),
      up AS (SELECT DISTINCT a.k AS k, a.d AS d, b.k AS pk FROM path a JOIN path b ON a.conv_id = b.conv_id AND a.d = b.d + 1),
      kids AS (SELECT pk, d - 1 AS d, count(*) AS n FROM up GROUP BY 1, 2),
      below AS (SELECT DISTINCT a.d AS d, a.k AS k, b.d AS bd, b.k AS bk FROM path a JOIN path b ON a.conv_id = b.conv_id AND b.d >= a.d),
      sums AS (SELECT below.d, below.k, sum((u.n_convs - 1) * u.bytes) AS saved, count(*) FILTER (kids.n IS NULL) AS leaves
        FROM below JOIN node u ON u.d = bd AND u.k = bk LEFT JOIN kids ON kids.d = bd AND kids.pk = bk GROUP BY below.d, below.k),
      ends AS (SELECT d, k, string_agg(cast(conv_id AS varchar), ',' ORDER BY conv_id) AS ids
        FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY d DESC) AS last FROM path) WHERE last = 1 GROUP BY d, k)
      SELECT node.conv_id, cast(node.d AS bigint) AS depth, p.conv_id AS parent_conv_id, node.n_convs, coalesce(kids.n, 0) AS n_children,
        sums.leaves AS n_leaves, cast(sums.saved AS bigint) AS saved_tokens, sha256(coalesce(ends.ids, '')) AS ends_sha256
      FROM node JOIN sums ON sums.d = node.d AND sums.k = node.k LEFT JOIN kids ON kids.d = node.d AND kids.pk = node.k
        LEFT JOIN ends ON ends.d = node.d AND ends.k = node.k LEFT JOIN up ON up.d = node.d AND up.k = node.k LEFT JOIN node p ON p.d = node.d - 1 AND p.k = up.pk""",
}
