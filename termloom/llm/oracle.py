"""The queries of this subpackage in SQL, where SQL can state them."""

from __future__ import annotations

from .licenses import CUT, IGNORED, LOWER, NORMALISATION, OTHER, RULES, SENTENCE_CUTS, SENTENCES, UPPER

_HEX20 = "('0x' || substr(sha1(coalesce(html, '')), 5 * (k // 4) + 1, 5))::UBIGINT"
_OP1 = f"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
    list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (({_HEX20} >> (15 - 5 * (k % 4))) & 31)::INTEGER, 1)
                    FOR k IN range(32)], 'string_agg', '') AS payload_digest
  FROM pages
), k AS (
  SELECT payload_digest, payload_bytes, max(page_id) AS kept_id FROM p GROUP BY ALL
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM kept_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM kept_id THEN kept_id END AS refers_to
FROM p JOIN k USING (payload_digest, payload_bytes)
"""


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _replacing(text: str, steps: tuple[tuple[str, str], ...]) -> str:
    for pattern, by in steps:
        by = by.replace("$", "\\").replace(CUT, "@CUT@")
        text = f"regexp_replace({text}, {_literal(pattern)}, {_literal(by)}, 'g')".replace("'@CUT@", "chr(1) || '")
    return text


def _licences() -> str:
    known = "MAP {" + ", ".join(f"{_literal(s)}: {_literal(name)}" for name, s in SENTENCES) + "}"
    line = "array_to_string([concat('|', x, '|') FOR x IN ids], '')"
    for licence, sequence in RULES:
        line = f"replace({line}, {_literal(''.join(f'|{name}|' for name in sequence))}, {_literal('{' + licence + '}')})"
    plain = f"replace(trim({_replacing('s', NORMALISATION)}), '_', '.')"
    return f"""
WITH known AS MATERIALIZED (SELECT {known} AS m),
cut AS (
  SELECT doc_id, row_number() OVER () AS r,
    string_split({_replacing(f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')", SENTENCE_CUTS)}, chr(1)) AS parts
  FROM documents
), sentence AS (
  SELECT r, i, parts[i] AS s FROM (SELECT r, parts, unnest(range(1, len(parts) + 1)) AS i FROM cut)
), looked AS (
  SELECT r, i, s, CASE WHEN regexp_matches({plain}, '{IGNORED}') THEN '' ELSE coalesce(m[{plain}], '{OTHER}') END AS name
  FROM sentence, known
), line AS (
  SELECT r, i, 0 AS k, name FROM looked WHERE name <> '{OTHER}'
  UNION ALL
  SELECT r, i, k, CASE WHEN regexp_matches({plain}, '{IGNORED}') THEN '' ELSE coalesce(m[{plain}], '{OTHER}') END
  FROM (SELECT r, i, k, string_split(s, chr(10))[k] AS s
        FROM (SELECT r, i, s, unnest(range(1, len(string_split(s, chr(10))) + 1)) AS k FROM looked WHERE name = '{OTHER}')),
    known
), listed AS (
  SELECT r, list(name ORDER BY i, k) FILTER (name <> '') AS ids FROM line GROUP BY r
), matched AS (
  SELECT doc_id, coalesce(ids, []) AS ids, {line} AS l FROM cut LEFT JOIN listed USING (r)
), found AS (
  SELECT doc_id, ids, l, regexp_extract_all(l, '\\{{([^}}]*)\\}}', 1) AS names FROM matched
)
SELECT doc_id, coalesce(array_to_string([x FOR x IN ids IF x <> '{OTHER}'], ','), '') AS sentence_ids,
  coalesce(array_to_string([x FOR x, i IN names IF list_position(names, x) = i], ','), '') AS licences,
  coalesce(array_to_string(regexp_extract_all(l, '\\|([a-z0-9+.]*[a-z0-9+])\\|', 1), ','), '') AS unmatched
FROM found
"""


_OP11 = """
WITH h AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS l,
    sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS d
  FROM documents
), u AS (
  SELECT doc_id, t, l, len(l) AS n, [('0x' || substr(d, 8 * i + 1, 8))::UBIGINT FOR i IN range(4)] AS h FROM h
), c AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1))::BIGINT AS a, greatest(h[1] % (n + 1), h[2] % (n + 1))::BIGINT AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
         WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM u
), p AS (
  SELECT doc_id, t, n, form, coalesce(array_to_string(l[1:a], ''), '') AS p,
    coalesce(array_to_string(l[a + 1:b], ''), '') AS m, coalesce(array_to_string(l[b + 1:n], ''), '') AS s
  FROM c
), o AS (
  SELECT *, CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                      ELSE '<S>' || s || '<P>' || p || '<M>' || m END AS o
  FROM p
)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(o) AS output_sha256,
  sha256(CASE form
    WHEN 'plain' THEN o
    WHEN 'psm' THEN split_part(split_part(o, '<S>', 1), '<P>', 2) || split_part(o, '<M>', 2)
                    || split_part(split_part(o, '<S>', 2), '<M>', 1)
    ELSE split_part(split_part(o, '<P>', 2), '<M>', 1) || split_part(o, '<M>', 2)
         || split_part(split_part(o, '<P>', 1), '<S>', 2) END) AS restored_sha256
FROM o
"""

_OP12 = """
WITH v AS MATERIALIZED (
  SELECT vec_id, [floor(64 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), q AS MATERIALIZED (
  SELECT vec_id AS query_id, min(e) AS qe FROM v WHERE vec_id % 20 = 0 GROUP BY vec_id
), p AS (
  SELECT query_id, vec_id, list_dot_product(qe, e)::BIGINT AS score FROM q JOIN v ON vec_id <> query_id AND len(qe) = len(e)
), r AS (
  SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM p
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

# Levels that the SQL of a Merkle tree spells out: enough for 16 million rows a source and as many sources.
_LEVELS = 6


def _digest(text: str) -> str:
    """SQL for the digest of a row of ``documents`` with this expression as its text."""
    fields = ["d.doc_id", "source", "lang", "n_chars", text]
    parts = [f"coalesce(octet_length(encode({c}::VARCHAR))::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in fields]
    return f"sha256({' || '.join(parts)})"


def _levels(nodes: str, path: str) -> str:
    """CTEs that build trees from ``<nodes>0(tree, idx, node, n)`` and follow ``<path>0(tree, idx, proof, own, other)`` up."""
    side = "coalesce(string_agg(node, '') OVER (PARTITION BY tree, idx // 16 ORDER BY idx ROWS BETWEEN {} AND {}), '')"
    before = side.format("UNBOUNDED PRECEDING", "1 PRECEDING")
    after = side.format("1 FOLLOWING", "UNBOUNDED FOLLOWING")
    return "".join(
        f"""
{nodes}{k + 1} AS MATERIALIZED (
  SELECT tree, idx // 16 AS idx, CASE WHEN max(n) > 1 THEN sha256(string_agg(node, '' ORDER BY idx)) ELSE max(node) END AS node,
    (max(n) + 15) // 16 AS n
  FROM {nodes}{k} GROUP BY ALL
), {nodes}_side{k} AS MATERIALIZED (
  SELECT tree, idx, n, {before} AS b, {after} AS f FROM {nodes}{k}
), {path}{k + 1} AS MATERIALIZED (
  SELECT p.* REPLACE (p.idx // 16 AS idx, proof || b || f AS proof,
    CASE WHEN n > 1 THEN sha256(b || own || f) ELSE own END AS own,
    CASE WHEN n > 1 THEN sha256(b || other || f) ELSE other END AS other)
  FROM {path}{k} AS p JOIN {nodes}_side{k} AS s ON s.tree IS NOT DISTINCT FROM p.tree AND s.idx = p.idx
),"""
        for k in range(_LEVELS)
    )


_OP13 = f"""
WITH RECURSIVE bits AS (
  SELECT i, i AS c, 0 AS k FROM range(256) AS r(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), crc_table AS MATERIALIZED (
  SELECT list(c ORDER BY i) AS crcs FROM bits WHERE k = 8
), crc AS (
  SELECT doc_id, doc_id::VARCHAR AS s, 0 AS k, 4294967295 AS c
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
  UNION ALL
  SELECT doc_id, s, k + 1, xor(c >> 8, crcs[1 + xor(c & 255, ascii(s[k + 1]))]) FROM crc, crc_table WHERE k < length(s)
), tampered AS MATERIALIZED (
  SELECT doc_id FROM crc WHERE k = length(s) AND xor(c, 4294967295) % 5 = 0
), leaf AS MATERIALIZED (
  SELECT d.doc_id, source AS tree, {_digest("text")} AS leaf,
    CASE WHEN t.doc_id IS NOT NULL THEN {_digest(f"translate(text, '{UPPER}', '{LOWER}')")} END AS changed
  FROM documents AS d LEFT JOIN tampered AS t ON d.doc_id = t.doc_id
), path0 AS MATERIALIZED (
  SELECT doc_id, leaf, tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, changed) - 1 AS idx,
    '' AS proof, leaf AS own, coalesce(changed, leaf) AS other
  FROM leaf
), node0 AS MATERIALIZED (
  SELECT tree, idx, own AS node, count(*) OVER (PARTITION BY tree) AS n FROM path0
),{_levels("node", "path")} top AS MATERIALIZED (
  SELECT tree AS source, own AS node, row_number() OVER (ORDER BY encode(tree) NULLS FIRST) - 1 AS idx
  FROM (SELECT DISTINCT tree, own FROM path{_LEVELS})
), top_node0 AS MATERIALIZED (
  SELECT 0 AS tree, idx, node, count(*) OVER () AS n FROM top
), top_path0 AS MATERIALIZED (
  SELECT doc_id, leaf, own AS subroot, 0 AS tree, top.idx AS idx, proof, own, other
  FROM path{_LEVELS} AS p JOIN top ON top.source IS NOT DISTINCT FROM p.tree
),{_levels("top_node", "top_path")[:-1]}
SELECT doc_id, leaf, subroot, own AS root, sha256(proof) AS proof_sha256, other AS folded_root, own = other AS verified
FROM top_path{_LEVELS}
"""


ORACLE: dict[str, str] = {
    "op1_warc": _OP1, "op9_licences": _licences(), "op11_fill_in_middle": _OP11, "op12_exact_top_k": _OP12,
    "op13_merkle_manifest": _OP13,
}
