"""The registered queries restated in plain SQL (DuckDB dialect) over the same tables."""

from __future__ import annotations

from ..functions import fixed_values as V

STOP = ", ".join(f"'{w}'" for w in V.STOPWORDS)
WORD = r"[\p{L}\p{N}_-]+"


def words(text: str) -> str:
    return rf"regexp_extract_all(lower(regexp_replace({text}, 'https?\S+', ' ', 'g')), '{WORD}')"


def counts(source: str = "documents", key: str = "doc_id", text: str = "text") -> str:
    """CTEs docs, tokens, tc (doc_id, term, tf), norms (doc_id, l_d) and idf (term, n_t, idf)."""
    return f"""docs AS (SELECT {key} AS doc_id, {text} AS text FROM {source}),
tokens AS (SELECT doc_id, term FROM (SELECT doc_id, unnest({words('text')}) AS term FROM docs) WHERE term NOT IN ({STOP})),
tc AS (SELECT doc_id, term, count(*) AS tf FROM tokens GROUP BY ALL),
{NORMS}"""


NORMS = """norms AS (SELECT d.doc_id, coalesce(sqrt(sum(CASE WHEN tf > 1 THEN (1 + ln(tf)) ^ 2 WHEN tf = 1 THEN 1.0 END)), 0.0) AS l_d
  FROM docs d LEFT JOIN tc ON d.doc_id = tc.doc_id GROUP BY d.doc_id),
idf AS (SELECT term, n_t, ln(1 + (SELECT count(*) FROM docs) / n_t) AS idf FROM (SELECT term, count(*) AS n_t FROM tc GROUP BY term))"""

BASE = "WITH " + counts()
WEIGHT = "(CASE WHEN tf > 1 THEN 1 + ln(tf) ELSE 1.0 END)"
POSTINGS = "SELECT term, tc.doc_id, tf, round(l_d, 6) AS l_d FROM tc JOIN norms ON tc.doc_id = norms.doc_id"


def scored(qtf: dict[str, int], base: str = BASE) -> str:
    """CTE scores (doc_id, score_sum, score) of one query."""
    rows = ", ".join(f"('{t}', {n})" for t, n in qtf.items())
    return f"""{base},
q(term, qtf) AS (VALUES {rows}),
sums AS (SELECT doc_id, sum(qtf * {WEIGHT} * idf) AS score_sum FROM tc JOIN q USING (term) JOIN idf USING (term) GROUP BY doc_id),
scores AS (SELECT doc_id, score_sum, score_sum / l_d AS score FROM sums JOIN norms USING (doc_id))
"""


SEARCH = scored({"tion": 1, "retion": 1, "ther": 2, "and": 1})
ONE = "SELECT doc_id, round(score, 6) AS score FROM scores"


def bulk(queries: str, keys: str, keep: str) -> str:
    """Ranked results of a table of queries; ``keep`` are the conditions on the ranked rows."""
    return f"""{BASE},
qt AS (SELECT {keys}, term, count(*) AS qtf FROM (SELECT {keys}, unnest({words('text')}) AS term FROM ({queries}))
  WHERE term NOT IN ({STOP}) GROUP BY ALL),
hits AS (SELECT {keys}, doc_id, sum(qtf * {WEIGHT} * idf) AS s FROM tc JOIN qt USING (term) JOIN idf USING (term) GROUP BY ALL),
ranked AS (SELECT {keys}, doc_id, s / l_d AS score FROM hits JOIN norms USING (doc_id)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY round(score, 9) DESC, doc_id) AS rank FROM ranked)
SELECT {keys}, doc_id, round(score, 6) AS score, rank FROM numbered WHERE {keep}"""


def holders(condition: str, base: str = BASE, score: str = "") -> str:
    """Documents whose set of terms satisfies a condition over has('term')."""
    return f"""{base},
sets AS (SELECT d.doc_id, coalesce(list(term) FILTER (WHERE term IS NOT NULL), []) AS terms
  FROM docs d LEFT JOIN tc ON d.doc_id = tc.doc_id GROUP BY d.doc_id)
SELECT doc_id{score} FROM sets WHERE {condition}"""


def has(term: str) -> str:
    return f"list_contains(terms, '{term}')"


def boolean(condition: str, base: str = BASE) -> str:
    return holders(condition, base, ", CAST(1 AS BIGINT) AS score")


def doc_set(condition: str) -> str:
    return holders(condition)


# Stems


def cut(n: int, word: str = "w") -> str:
    return f"substr({word}, 1, length({word}) - {n})"


def ends(*suffixes: str, word: str = "w") -> str:
    return "(" + " OR ".join(f"ends_with({word}, '{x}')" for x in suffixes) + ")"


def longest(table: dict[str, str], condition) -> str:
    """CASE over suffixes, longest first: replaced if the condition holds, else the word stays."""
    cases = [
        f"WHEN ends_with(w, '{x}') THEN CASE WHEN {condition(x)} THEN {cut(len(x))} || '{table[x]}' ELSE w END"
        for x in sorted(table, key=len, reverse=True)
    ]
    return "CASE " + " ".join(cases) + " ELSE w END"


def inside(suffix: str, region: str) -> str:
    return f"length(w) - {len(suffix)} >= {region}"


def after_region(word: str) -> str:
    head = f"length(regexp_extract({word}, '^[^aeiouy]*[aeiouy]+[^aeiouy]'))"
    return f"CASE WHEN {head} = 0 THEN length({word}) ELSE {head} END"


SHORT = "(^[aeiouy][^aeiouy]|[^aeiouy][aeiouy][^aeiouywxY])$"
STEP_2_ALSO = {"ogi": ends("logi"), "li": ends(*[f"{c}li" for c in V.STEM_LI_ENDINGS])}


def stems(source: str) -> str:
    """CTEs ending in stems (term, stem) for the distinct terms of a source.

    Every step is materialized: merged into one another, their expressions would multiply.
    """
    listed = {k: ", ".join(f"'{x}'" for x in v) for k, v in {"early": V.STEM_STOP_AFTER_1A, "odd": V.STEM_EXCEPTIONS}.items()}
    odd = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in V.STEM_EXCEPTIONS.items())
    prefixes = " ".join(f"WHEN starts_with(w, '{x}') THEN {len(x)}" for x in V.STEM_R1_PREFIXES)
    step_2 = longest(V.STEM_STEP_2, lambda x: inside(x, "r1") + (f" AND {STEP_2_ALSO[x]}" if x in STEP_2_ALSO else ""))
    step_3 = longest(V.STEM_STEP_3, lambda x: inside(x, "r2" if x == "ative" else "r1"))
    step_4 = longest(
        dict.fromkeys(V.STEM_STEP_4, ""), lambda x: inside(x, "r2") + (f" AND {ends('sion', 'tion')}" if x == "ion" else "")
    )
    return rf"""s0 AS MATERIALIZED (SELECT term, regexp_replace(regexp_replace(term, '^y', 'Y'), '([aeiouy])y', '\1Y', 'g') AS w
  FROM (SELECT DISTINCT term FROM {source})),
s1 AS MATERIALIZED (SELECT *, CASE {prefixes} ELSE {after_region('w')} END AS r1 FROM s0),
s2 AS MATERIALIZED (SELECT *, r1 + {after_region('substr(w, r1 + 1)')} AS r2 FROM s1),
s3 AS MATERIALIZED (SELECT * REPLACE (CASE WHEN {ends('sses')} THEN {cut(2)}
  WHEN {ends('ied', 'ies')} THEN CASE WHEN length(w) > 4 THEN {cut(2)} ELSE {cut(1)} END
  WHEN {ends('us', 'ss')} THEN w WHEN regexp_matches(w, '[aeiouy].+s$') THEN {cut(1)} ELSE w END AS w) FROM s2),
s4 AS MATERIALIZED (SELECT *, w IN ({listed['early']}) AS early, CASE WHEN {ends('ed', 'ing', 'edly', 'ingly')} AND NOT {ends('eed', 'eedly')}
  AND regexp_matches(regexp_replace(w, '(ingly|edly|ing|ed)$', ''), '[aeiouy]') THEN regexp_replace(w, '(ingly|edly|ing|ed)$', '') END AS bare FROM s3),
s5 AS MATERIALIZED (SELECT * REPLACE (CASE WHEN early THEN w
  WHEN bare IS NOT NULL THEN CASE WHEN {ends('at', 'bl', 'iz', word='bare')} THEN bare || 'e'
    WHEN {ends(*V.STEM_DOUBLES, word='bare')} THEN {cut(1, 'bare')}
    WHEN length(bare) <= r1 AND regexp_matches(bare, '{SHORT}') THEN bare || 'e' ELSE bare END
  WHEN ends_with(w, 'eed') AND {inside('eed', 'r1')} THEN {cut(1)} WHEN ends_with(w, 'eedly') AND {inside('eedly', 'r1')} THEN {cut(3)}
  ELSE w END AS w) FROM s4),
s6 AS MATERIALIZED (SELECT * REPLACE (regexp_replace(w, '^(.+[^aeiouy])[yY]$', '\1i') AS w) FROM s5),
s7 AS MATERIALIZED (SELECT * REPLACE ({step_2} AS w) FROM s6), s8 AS MATERIALIZED (SELECT * REPLACE ({step_3} AS w) FROM s7), s9 AS MATERIALIZED (SELECT * REPLACE ({step_4} AS w) FROM s8),
s10 AS MATERIALIZED (SELECT * REPLACE (CASE WHEN {ends('e')} AND ({inside('e', 'r2')} OR ({inside('e', 'r1')} AND NOT regexp_matches({cut(1)}, '{SHORT}'))) THEN {cut(1)}
  WHEN {ends('ll')} AND {inside('l', 'r2')} THEN {cut(1)} ELSE w END AS w) FROM s9),
stems AS MATERIALIZED (SELECT s10.term, CASE WHEN length(s10.term) <= 2 THEN s10.term WHEN s10.term IN ({listed['odd']}) THEN CASE s10.term {odd} END
  WHEN early THEN s3.w ELSE replace(s10.w, 'Y', 'y') END AS stem FROM s10 JOIN s3 ON s3.term = s10.term)"""


STEM_TC = f"""WITH docs AS (SELECT doc_id, text FROM documents),
tokens AS (SELECT doc_id, term FROM (SELECT doc_id, unnest({words('text')}) AS term FROM docs) WHERE term NOT IN ({STOP})),
plain AS (SELECT doc_id, term, count(*) AS tf FROM tokens GROUP BY ALL),
{stems('plain')},
tc AS (SELECT doc_id, stem AS term, CAST(sum(tf) AS BIGINT) AS tf FROM plain JOIN stems USING (term) GROUP BY ALL)"""
STEM_BASE = f"{STEM_TC},\n{NORMS}"


# Pages and links

HIDDEN = r"<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>"


def unescaped(text: str) -> str:
    """The entities that occur in the table; the ampersand last."""
    for name, char in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        text = f"replace({text}, '&{name};', '{char}')"
    return text


PAGE_TEXT = unescaped(rf"regexp_replace(html, '{HIDDEN}|<[a-z/!?][^>]*>', ' ', 'gis')")

LINKED = """lp AS (SELECT p.page_id, p.url, p.html
  || '<a href="#top">top</a><a class=''m'' href=''mailto:info@example.org''>mail</a><a href="">none</a>'
  || '<!-- <a href="/hidden">hidden</a> --><a href=''../up/./' || p.page_id || '?x=1#f''>up</a><a href="?q=2">again</a>'
  || '<a href="//cdn.example.org/k">cdn</a><a href="' || a.url || '">a</a><A HREF="' || b.url || '">b</A>' AS html
  FROM pages p JOIN pages a ON a.page_id = (3 * p.page_id + 1) % (SELECT count(*) FROM pages)
  JOIN pages b ON b.page_id = (7 * p.page_id + 2) % (SELECT count(*) FROM pages))"""


def links(source: str) -> str:
    """CTEs hrefs, followable, resolved over a page source."""
    anchor = r"""<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+)"""
    href = unescaped("""regexp_replace(v, '^["'']|["'']$', '', 'g')""")
    return rf"""hrefs AS (SELECT page_id, url, {href} AS href FROM (
  SELECT page_id, url, unnest(regexp_extract_all(regexp_replace(html, '{HIDDEN}', ' ', 'gis'), '{anchor}', 1, 'is')) AS v FROM {source})),
followable AS (SELECT * FROM hrefs WHERE href <> '' AND NOT starts_with(href, '#') AND NOT starts_with(href, 'mailto')),
parts AS (SELECT *, regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*') AS origin, regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*:') AS scheme,
  regexp_replace(url, '[?#].*$', '', 's') AS page, regexp_extract(href, '^[^?#]*') AS path, regexp_extract(href, '[?#].*$', 0, 's') AS tail FROM followable),
paths AS (SELECT *, CASE WHEN starts_with(path, '/') THEN path
  ELSE regexp_replace(coalesce(nullif(substr(page, length(origin) + 1), ''), '/'), '[^/]*$', '') || path END AS joined FROM parts),
dots AS (SELECT *, list_reduce(list_prepend([], list_transform(string_split(joined, '/'), lambda s: [s])),
  lambda acc, s: CASE WHEN s[1] = '..' THEN acc[:-2] WHEN s[1] = '.' THEN acc ELSE list_concat(acc, s) END) AS kept FROM paths),
resolved AS (SELECT page_id, url, href, CASE
  WHEN starts_with(href, 'http') OR regexp_matches(href, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN href
  WHEN starts_with(href, '//') THEN scheme || href
  WHEN path = '' THEN page || tail
  ELSE origin || array_to_string(kept, '/') || CASE WHEN regexp_matches(joined, '/\.\.?$') THEN '/' ELSE '' END || tail END AS resolved FROM dots)"""


def edges(source: str) -> str:
    return f"""{links(source)},
edges AS (SELECT DISTINCT regexp_replace(url, '[?#].*$', '', 's') AS src, regexp_replace(resolved, '[?#].*$', '', 's') AS dst FROM resolved)"""


CUT_URL = "regexp_replace(url, '[?#].*$', '', 's')"
LP_EDGES = f"{LINKED},\n{edges('lp')}"


def walk(name: str, seeds: str, max_depth: int, known: str = "") -> str:
    """CTE (node, depth): breadth-first levels, found by repetition up to a depth no shortest path exceeds."""
    unless = f" AND e.dst NOT IN ({known})" if known else ""
    return f"""{name}_all AS (SELECT node, CAST(0 AS BIGINT) AS depth FROM ({seeds})
  UNION SELECT e.dst, w.depth + 1 FROM {name}_all w JOIN edges e ON e.src = w.node WHERE w.depth < {max_depth}{unless}),
{name} AS (SELECT node, min(depth) AS depth FROM {name}_all GROUP BY node)"""


def status(name: str, pending: str) -> str:
    return f"""SELECT node AS url, depth, CASE WHEN {pending} THEN 'pending'
  WHEN node IN (SELECT {CUT_URL} FROM pages) THEN 'visited' ELSE 'bad' END AS status FROM {name}"""


FIRST = f"SELECT {CUT_URL} AS node FROM pages WHERE page_id = 0"
CRAWL4 = f"WITH RECURSIVE {LP_EDGES},\n{walk('w', FIRST, 5)},\nstate AS ({status('w', 'depth > 4')})"
NO_LIMIT = 40

ORACLE: dict[str, str] = {
    # Sources and sinks
    "pages_source": "SELECT page_id, url, length(html) AS n_chars FROM pages WHERE lower(html) LIKE '<!doctype html%'",
    "new_documents": """SELECT doc_id, lang, source, n_chars FROM documents
  WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "first_documents": """SELECT conv_id AS doc_id, turn, role, text FROM conversations c
  WHERE turn = (SELECT min(turn) FROM conversations x WHERE x.conv_id = c.conv_id) AND conv_id NOT IN (SELECT doc_id FROM labels)""",
    "build_index": f"{BASE} {POSTINGS}",
    "index_append": f"{BASE} {POSTINGS}",
    "index_bucketed": f"{BASE} SELECT doc_id, count(*) AS n_terms, CAST(sum(tf) AS BIGINT) AS n_words FROM tc GROUP BY doc_id",
    "search_output": f"{SEARCH} SELECT doc_id || ',' || format('{{:.2f}}', score) AS line FROM scores WHERE score >= 0.2",
    "search_output_boolean": f"WITH found AS ({boolean(has('tion') + ' AND NOT ' + has('ther'))}) SELECT doc_id || ',' || score AS line FROM found",
    # Text preparation
    "strip_links": r"SELECT page_id, regexp_replace(url || ' ' || html, 'https?\S+', ' ', 'g') AS text FROM pages",
    "strip_punct": r"SELECT doc_id, regexp_replace(text, '[^ \p{L}\p{N}_-]+', ' ', 'g') AS text FROM documents",
    "split_words": r"""SELECT doc_id, word FROM (
  SELECT doc_id, unnest(string_split_regex(regexp_replace(text, '[^ \p{L}\p{N}_-]+', ' ', 'g'), ' +')) AS word FROM documents)
WHERE word <> ''""",
    "remove_stopwords": f"""SELECT term, count(*) AS n FROM (SELECT unnest({words('text')}) AS term FROM documents)
WHERE term NOT IN ({STOP}) GROUP BY term""",
    "preprocess_tokens": f"{BASE} SELECT doc_id, term FROM tokens",
    "preprocess_queries": f"""SELECT conv_id, turn, term FROM (SELECT conv_id, turn, unnest({words('text')}) AS term FROM conversations)
WHERE term NOT IN ({STOP})""",
    "stem_vocabulary": f"{STEM_TC} SELECT term, stem FROM stems",
    "stemmed_counts": f"{STEM_TC} SELECT doc_id, term, tf FROM tc",
    "pages_text": f"SELECT page_id, {PAGE_TEXT} AS text FROM pages",
    "pages_entities": f"SELECT page_id, {PAGE_TEXT} || '''x'' © y …' || chr(160) || '€A ¬it; &nosuch;  z ' AS text FROM pages",
    "text_folder": r"SELECT page_id, regexp_replace(html, '[\r\n]+', ' ', 'g') AS text FROM pages",
    "pages_documents": f"SELECT url AS doc_id, {PAGE_TEXT} AS text FROM pages",
    "page_links": f"WITH {links('pages')} SELECT page_id, href FROM hrefs",
    "followable_links": f"WITH {LINKED},\n{links('lp')} SELECT page_id, href FROM followable",
    "resolved_links": f"WITH {LINKED},\n{links('lp')} SELECT page_id, href, resolved FROM resolved",
    "canonical_links": f"WITH {LINKED},\n{links('lp')} SELECT page_id, regexp_replace(resolved, '[?#].*$', '', 's') AS link FROM resolved",
    # Counts
    "doc_term_counts": f"{BASE} SELECT doc_id, term, tf FROM tc",
    "doc_norms": f"{BASE} SELECT doc_id, round(l_d, 6) AS l_d FROM norms",
    "postings_lists": f"""{BASE} SELECT term, segment, string_agg(doc_id || ':' || tf, ',' ORDER BY doc_id) AS docs FROM (
  SELECT *, CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8)) AS BIGINT)
    % greatest(1, CAST(ceil((SELECT count(*) FROM docs) / 256) AS BIGINT)) AS segment FROM tc) GROUP BY term, segment""",
    "term_df": f"{BASE} SELECT term, n_t FROM idf",
    "term_idf": f"{BASE} SELECT term, n_t, round(idf, 6) AS idf FROM idf",
    "collection_counts": f"{BASE} SELECT (SELECT count(*) FROM docs) AS n_docs, (SELECT count(DISTINCT term) FROM tc) AS n_terms",
    "tf_weights": f"{BASE} SELECT term, doc_id, round({WEIGHT}, 6) AS weight FROM tc",
    "score_sums": f"{SEARCH} SELECT doc_id, round(score_sum, 6) AS score_sum FROM scores",
    # Lookups and boolean retrieval
    "term_postings": f"{BASE} SELECT term, doc_id, tf FROM tc WHERE term = 'retion'",
    "term_docs": f"{BASE} SELECT DISTINCT doc_id FROM tc WHERE term = 'ther'",
    "missing_terms": f"""{BASE} SELECT DISTINCT term FROM (SELECT unnest({words('text')}) AS term FROM benchmark)
WHERE term NOT IN ({STOP}) AND term NOT IN (SELECT term FROM tc)""",
    "document_norms": f"{BASE} SELECT doc_id, round(l_d, 6) AS l_d FROM norms JOIN labels USING (doc_id)",
    "bool_and": doc_set(f"{has('tion')} AND {has('and')} AND {has('ther')}"),
    "bool_or": doc_set(f"{has('tion')} OR {has('retion')}"),
    "bool_not": doc_set(f"NOT {has('and')}"),
    "bool_not_not": boolean(has("tion")),
    "bool_expr": boolean(f"({has('tion')} AND NOT {has('ther')}) OR ({has('retion')} AND {has('ther')})"),
    "bool_expr_paren": boolean(f"NOT {has('tion')} AND NOT {has('ther')} AND NOT {has('retion')}"),
    "bool_bulk": f"""{BASE},
qt AS (SELECT DISTINCT query_id, term FROM (SELECT item_id AS query_id, unnest({words('text')}) AS term FROM benchmark) WHERE term NOT IN ({STOP})),
held AS (SELECT query_id, doc_id, count(*) AS n FROM qt JOIN tc USING (term) GROUP BY ALL),
size AS (SELECT query_id, count(*) AS n FROM qt GROUP BY ALL)
SELECT query_id, doc_id FROM held JOIN size USING (query_id, n)
UNION SELECT query_id, doc_id FROM (SELECT query_id, min(term) AS term, max(term) AS last FROM qt GROUP BY query_id HAVING min(term) <> max(term)) e
JOIN tc USING (term) WHERE NOT EXISTS (FROM tc t WHERE t.doc_id = tc.doc_id AND t.term = last)""",
    "bool_dnf": f"""WITH one AS ({doc_set(f"({has('tion')} AND NOT {has('and')}) OR ({has('ther')} AND {has('retion')})")}),
two AS ({doc_set(f"NOT {has('and')}")}), three AS ({doc_set(f"NOT {has('and')} AND NOT {has('tion')}")})
SELECT CAST(1 AS BIGINT) AS query_id, doc_id FROM one UNION ALL SELECT CAST(2 AS BIGINT), doc_id FROM two UNION ALL SELECT CAST(3 AS BIGINT), doc_id FROM three""",
    # Ranked retrieval
    "vector_search": f"{SEARCH} {ONE} WHERE score >= 0.2",
    "vector_above": f"{SEARCH} {ONE} WHERE score >= 0.5",
    "vector_all": f"{SEARCH} {ONE}",
    "vector_ranked": f"{SEARCH} SELECT doc_id, round(score, 6) AS score, row_number() OVER (ORDER BY round(score, 9) DESC, doc_id) AS rank FROM scores",
    "vector_topk": f"{SEARCH} {ONE} ORDER BY round(scores.score, 9) DESC, doc_id LIMIT 10",
    "vector_repeat": f"{scored({'retion': 2})} {ONE}",
    "vector_skip": f"{scored({'retion': 1})} {ONE}",
    "vector_bulk": bulk("SELECT item_id AS query_id, text FROM benchmark", "query_id", "rank <= 3"),
    "vector_bulk_bucketed": bulk("SELECT item_id AS query_id, text FROM benchmark", "query_id", "rank <= 3"),
    "vector_bulk_ranked": bulk("SELECT item_id AS query_id, text FROM benchmark", "query_id", "score >= 0.2"),
    "vector_conversations": bulk("SELECT * FROM conversations WHERE role = 'user'", "conv_id, turn", "score >= 0.2 AND rank <= 5"),
    "vector_stemmed": f"{scored({'tion': 1, 'ere': 1, 'ther': 1, 'and': 1}, STEM_BASE)} {ONE}",
    "bool_stemmed": boolean(f"{has('tion')} AND NOT {has('ere')}", STEM_BASE),
    # Link graph and crawl
    "link_edges": f"WITH {LP_EDGES} SELECT src, dst FROM edges",
    "page_edges": f"WITH {edges('pages')} SELECT src, dst FROM edges",
    "crawl_reach": f"WITH RECURSIVE {LP_EDGES},\n{walk('w', FIRST, NO_LIMIT)} SELECT node, depth FROM w",
    "crawl_reach_recursive": f"WITH RECURSIVE {LP_EDGES},\n{walk('w', FIRST, 3)} SELECT node, depth FROM w",
    "crawl_status": f"{CRAWL4} SELECT url, depth, status FROM state",
    "crawl_all_pages": f"""WITH RECURSIVE {edges('pages')},\n{walk('w', f'SELECT {CUT_URL} AS node FROM pages', 2)} {status('w', 'depth > 1')}""",
    "crawl_budget": f"""WITH RECURSIVE {LP_EDGES},\n{walk('w', FIRST, NO_LIMIT)},
ranked AS (SELECT node, depth, row_number() OVER (ORDER BY depth, node) AS r FROM w),
last AS (SELECT max(depth) AS d FROM ranked WHERE r <= 50),
met AS (SELECT node, depth, r FROM ranked, last WHERE depth <= d OR (depth = d + 1 AND node IN (
  SELECT dst FROM edges JOIN ranked x ON x.node = edges.src WHERE x.r <= 50))) {status('met', 'r > 50')}""",
    "crawl_resume": f"""WITH RECURSIVE {LP_EDGES},\n{walk('w', FIRST, 2)},
state AS ({status('w', 'depth > 1')}), done AS (FROM state WHERE status <> 'pending'),
start AS (SELECT url AS node FROM state WHERE status = 'pending'
  UNION SELECT {CUT_URL} FROM pages WHERE page_id = 5 AND {CUT_URL} NOT IN (SELECT url FROM done)),
{walk('v', 'SELECT node FROM start', 3, 'SELECT url FROM done')}
SELECT url, depth, status FROM done UNION ALL {status('v', 'depth > 2')}""",
    "crawl_links": f"{CRAWL4} SELECT url FROM state WHERE status <> 'bad'",
    "crawl_index": f"""{CRAWL4},
{counts(f"(SELECT url AS u, html FROM lp WHERE {CUT_URL} IN (SELECT url FROM state WHERE status = 'visited'))", 'u', PAGE_TEXT)}
{POSTINGS}""",
    # Streaming
    "stream_index": f"""{BASE} SELECT doc_id, round(any_value(l_d), 6) AS l_d, count(term) AS n_terms
FROM norms LEFT JOIN tc USING (doc_id) GROUP BY doc_id""",
}
# Queries that reach the same rows another way.
ORACLE |= {
    "bitmap_expr": ORACLE["bool_expr"],
    "bitmap_expr_paren": ORACLE["bool_expr_paren"],
    "bitmap_not_not": ORACLE["bool_not_not"],
    "bitmap_bulk": ORACLE["bool_bulk"],
    "bitmap_dnf": ORACLE["bool_dnf"],
    "stream_levels": ORACLE["stream_index"],
}
