"""DuckDB SQL of the registered queries, by other forms: joins instead of arrays, recursion instead of folds, subqueries instead of windows."""

from __future__ import annotations

from quire.modes import CORRECTIONS, MAX_SPECIAL, SHORT_CORRECTIONS

_WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]+"

_LINES = """
raw AS (SELECT doc_id, unnest(xs) AS content, generate_subscripts(xs, 1) - 1 AS ln FROM (SELECT doc_id, string_split(text, chr(10)) AS xs FROM documents)),
lines AS (
  SELECT doc_id::VARCHAR AS item_id, (ln // 25)::INTEGER AS page, (ln % 25)::INTEGER AS ocr_seq, content, (80 + (doc_id * 31 + ln * 17) % 20)::DOUBLE / 100 AS ocr_confidence,
         (60 + 10 * (doc_id % 3))::INTEGER AS x1, (60 + 28 * ((ln % 25 * 7) % 25))::INTEGER AS y1,
         (60 + 10 * (doc_id % 3) + least(450, 6 * length(content)))::INTEGER AS x2, (60 + 28 * ((ln % 25 * 7) % 25) + CASE WHEN (ln % 25 * 7) % 25 % 5 = 0 THEN 26 ELSE 14 END)::INTEGER AS y2
  FROM raw)"""
_BLOCKS = """
five AS (SELECT * FROM (SELECT DISTINCT doc_id, (ln // 25)::INTEGER AS page FROM raw) CROSS JOIN (SELECT unnest([0, 1, 2, 3, 4]) AS b)),
blocks AS (
  SELECT doc_id::VARCHAR AS item_id, page, 2 * b AS block_idx, ['doc_title', 'title', 'header', 'paragraph_title', 'footer'][(7 * doc_id + 3 * page + b * b) % 5 + 1] AS label, 50 AS x1, 60 + 140 * b - 4 AS y1, 560 AS x2, 60 + 140 * b + 30 AS y2
  FROM five WHERE (doc_id + b) % 4 <> 0
  UNION ALL
  SELECT doc_id::VARCHAR, page, 2 * b + 1, ['text', 'figure', 'table', 'chart', 'text'][b + 1], 50, 60 + 140 * b + 24, 560, 60 + 140 * b + 130 FROM five)"""


def _cleaned(table: tuple[tuple[str, str], ...]) -> str:
    out = "content"
    for wrong, right in table:
        out = f"replace({out}, '{wrong}', '{right}')"
    return rf"trim(regexp_replace(regexp_replace({out}, '([a-z])([A-Z])', '\1 \2', 'g'), '{_WS}', ' ', 'g'))"


def _tokens(text: str = "content") -> str:
    return f"len(list_filter(regexp_split_to_array({text}, '{_WS}'), lambda x: x <> ''))::INTEGER"


_OVER = """
  least(l.x2, b.x2) > greatest(l.x1, b.x1) AND least(l.y2, b.y2) > greatest(l.y1, b.y1)
  AND (least(l.x2, b.x2) - greatest(l.x1, b.x1))::DOUBLE * (least(l.y2, b.y2) - greatest(l.y1, b.y1)) / least((l.x2 - l.x1)::DOUBLE * (l.y2 - l.y1), (b.x2 - b.x1)::DOUBLE * (b.y2 - b.y1)) > 0.5::DOUBLE"""


def _elements(table: tuple[tuple[str, str], ...] = CORRECTIONS, grid: bool = False) -> str:
    size = "grid AS (SELECT item_id, page, greatest(50, least(200, floor(greatest(max(x2), max(y2)) / 15)))::INTEGER AS g FROM blocks GROUP BY ALL),"
    seen, order = "", "b.block_idx"
    if grid:
        cells = "EXISTS (SELECT 1 FROM (SELECT unnest(generate_series(greatest(0, floor(l.{0}1 / g)::BIGINT), greatest(0, floor(l.{0}2 / g)::BIGINT))) AS c) WHERE c = floor(b.{0}1 / g))"
        seen = " AND " + cells.format("x") + " AND " + cells.format("y")
        order = "floor(b.x1 / g), floor(b.y1 / g), b.block_idx"
    return f"""
{size}
clean AS (SELECT * REPLACE ({_cleaned(table)} AS content) FROM lines),
found AS (SELECT l.item_id, l.page, l.ocr_seq, b.label, row_number() OVER (PARTITION BY l.item_id, l.page, l.ocr_seq ORDER BY {order}) AS nr
          FROM clean l JOIN blocks b ON l.item_id = b.item_id AND l.page = b.page JOIN grid ON grid.item_id = l.item_id AND grid.page = l.page WHERE {_OVER}{seen}),
el AS (SELECT c.*, coalesce(f.label, 'text') AS type, CASE WHEN f.label IS NULL THEN 0.0::DOUBLE ELSE 0.9::DOUBLE END AS structure_confidence, CASE WHEN f.label IS NULL THEN NULL ELSE '' END AS structure_content,
              CASE coalesce(f.label, '') WHEN 'doc_title' THEN 1 WHEN 'title' THEN 2 WHEN 'header' THEN 3 WHEN 'paragraph_title' THEN 4 ELSE 5 END AS level
       FROM clean c LEFT JOIN found f ON f.item_id = c.item_id AND f.page = c.page AND f.ocr_seq = c.ocr_seq AND f.nr = 1),
ord AS (SELECT *, (row_number() OVER (PARTITION BY item_id, page ORDER BY y1, x1, ocr_seq) - 1)::INTEGER AS id FROM el)"""


def _match(grid: bool) -> str:
    return f"WITH {_LINES}, {_BLOCKS}, {_elements((), grid)} SELECT item_id, page, ocr_seq, type AS structure_type, structure_confidence, structure_content, x1 AS x, y1 AS y, x2 - x1 AS width, y2 - y1 AS height FROM el"


def _tree(page_parent: bool) -> str:
    return f"""WITH {_LINES}, {_BLOCKS}, {_elements()},
h AS (SELECT item_id, page, id, level FROM ord WHERE level < 5)
SELECT o.item_id, o.page, o.id, o.level, coalesce(
  (SELECT max(h.id) FROM h WHERE h.item_id = o.item_id AND h.page = o.page AND h.id < o.id AND h.level < o.level),
  {"CASE WHEN o.level = 2 THEN (SELECT min(h.id) FROM h WHERE h.item_id = o.item_id AND h.page = o.page AND h.id < o.id AND h.level <= 2) END," if page_parent else ""} -1)::INTEGER AS parent_id
FROM ord o"""


_LETTERS = r"(length(content) - length(regexp_replace(content, '\p{L}', '', 'g')))::DOUBLE / length(content)"
_SPECIAL = r"length(regexp_replace(content, '[\p{L}\p{N}\s\x0b\x1c-\x1f\x{85}\p{Z}]', '', 'g'))::DOUBLE / length(content)"
_GOOD = rf"NOT (ocr_confidence < 0.85::DOUBLE) AND length(regexp_replace(content, '^{_WS}|{_WS}$', '', 'g')) >= 2 AND {_LETTERS} >= 0.5::DOUBLE"


def _fold(source: str, breaks: str) -> str:
    """``source`` has seq, the order on the page. Chunk numbers by recursion over the elements."""
    return f"""
seqd AS (SELECT *, (row_number() OVER (PARTITION BY item_id, page ORDER BY seq))::INTEGER AS nr, {_tokens()} AS tok, {breaks} AS brk FROM {source}),
walk AS (
  SELECT item_id, page, nr, tok AS cur, 0 AS chunk_no FROM seqd WHERE nr = 1
  UNION ALL
  SELECT s.item_id, s.page, s.nr, CASE WHEN w.cur >= 150 AND (w.cur + s.tok > 400 OR s.brk) THEN s.tok ELSE w.cur + s.tok END, CASE WHEN w.cur >= 150 AND (w.cur + s.tok > 400 OR s.brk) THEN w.chunk_no + 1 ELSE w.chunk_no END
  FROM walk w JOIN seqd s ON s.item_id = w.item_id AND s.page = w.page AND s.nr = w.nr + 1),
ch AS (SELECT s.*, w.chunk_no FROM seqd s JOIN walk w USING (item_id, page, nr))"""


_HEAD = "type IN ('doc_title', 'title', 'header', 'paragraph_title')"


def _semantic(table: tuple[tuple[str, str], ...], grid: bool = False, good: bool = False, item_ids: bool = False) -> str:
    item = "item_id || '_' || " if item_ids else ""
    return f"""WITH RECURSIVE {_LINES}, {_BLOCKS}, {_elements(table, grid)},
kept AS (SELECT *, id AS seq FROM ord{" WHERE " + _GOOD if good else ""}),
{_fold("kept", "type IN ('doc_title', 'title')")},
agg AS (
  SELECT item_id, page, chunk_no, string_agg(content, ' - ' ORDER BY nr) FILTER ({_HEAD}) AS heads, string_agg(content, ' ' ORDER BY nr) FILTER (NOT {_HEAD}) AS bodies, string_agg(content, '|' ORDER BY nr) FILTER ({_HEAD}) AS bars,
         string_agg(content, ' > ' ORDER BY nr) FILTER ({_HEAD}) AS path, arg_min(content, nr) FILTER ({_HEAD}) AS head, arg_min(content, nr) AS first, coalesce(arg_min([x1, y1, x2, y2], nr) FILTER (NOT {_HEAD}), arg_min([x1, y1, x2, y2], nr)) AS bbox,
         round(avg(ocr_confidence), 6) AS ocr_confidence, count(*)::INTEGER AS elements_count, sum(tok)::INTEGER AS token_count, array_to_string(list_sort(list(DISTINCT level)), ',') AS hierarchy_levels
  FROM ch GROUP BY item_id, page, chunk_no)
SELECT item_id, page, chunk_no, {item}'chunk_' || page || '_' || substring(md5({item}'page_' || page || '_bbox_[' || array_to_string(bbox, ', ') || ']_content_' || substring(first, 1, 50)), 1, 12) AS fragment_id,
  CASE WHEN heads IS NULL THEN bodies WHEN bodies IS NULL THEN heads ELSE heads || ': ' || bodies END AS content, {"item_id" if item_ids else "''"} AS meta_item_id, 'semantic_chunk' AS type, coalesce(bars, '') AS section_titles,
  coalesce(head, '-') AS primary_section, coalesce(path, '-') AS context_hierarchy, array_to_string(bbox, ',') AS bbox, ocr_confidence, elements_count, token_count, hierarchy_levels
FROM agg"""


_FLAT = f"""WITH RECURSIVE {_LINES},
clean AS (SELECT * REPLACE ({_cleaned(CORRECTIONS)} AS content), ocr_seq AS seq FROM lines),
{_fold("clean", "false")},
agg AS (SELECT item_id, page, chunk_no, string_agg(content, ' ' ORDER BY nr) AS content, arg_min(content, nr) AS first, arg_min([x1, y1, x2, y2], nr) AS bbox, round(avg(ocr_confidence), 6) AS ocr_confidence, count(*)::INTEGER AS elements_count, sum(tok)::INTEGER AS token_count
        FROM ch GROUP BY item_id, page, chunk_no)
SELECT item_id, page, chunk_no, 'flat_' || page || '_' || substring(md5('flat_' || page || '_bbox_[' || array_to_string(bbox, ', ') || ']_content_' || substring(first, 1, 50)), 1, 12) AS fragment_id, content, '' AS meta_item_id, 'flat_chunk' AS type,
  '' AS section_titles, '-' AS primary_section, '-' AS context_hierarchy, array_to_string(bbox, ',') AS bbox, ocr_confidence, elements_count, token_count, '' AS hierarchy_levels
FROM agg"""

_SEMANTIC_LAMBDA = _semantic(SHORT_CORRECTIONS, good=True, item_ids=True)

_ASKED = f"""{_LINES},
items AS (SELECT item_id, max(page) + 1 AS pages FROM lines GROUP BY item_id),
req AS (SELECT CASE WHEN doc_id % 11 = 0 THEN '' WHEN doc_id % 13 = 0 THEN 'none' || doc_id ELSE doc_id::VARCHAR END AS item_id, doc_id % 7 - 3 AS s, CASE WHEN doc_id % 4 = 0 THEN NULL ELSE doc_id % 5 - 1 END AS e FROM documents),
res AS (SELECT req.item_id, CASE WHEN req.item_id = '' THEN 400 WHEN pages IS NULL THEN 404 ELSE 200 END AS status, greatest(0, least(s, pages - 1)) AS a, greatest(greatest(0, least(s, pages - 1)), least(coalesce(e, pages - 1), pages - 1)) AS z
        FROM req LEFT JOIN items ON items.item_id = req.item_id)"""

_INDEX = """
ix AS (SELECT d.doc_id, 'doc_' || d.doc_id AS fragment_id, d.text AS content, (d.doc_id % 10)::INTEGER AS page, string_split(d.text, chr(10))[1] AS primary_section, (80 + (d.doc_id * 31) % 20)::DOUBLE / 100 AS ocr_confidence, e.embedding::DOUBLE[] AS v
       FROM documents d LEFT JOIN embeddings e ON e.vec_id = d.doc_id)"""
_COSINE = "list_cosine_similarity(v, (SELECT embedding::DOUBLE[] FROM embeddings WHERE vec_id = 0)) + 1"


#: A character that marks a point, colon, apostrophe or comma as one within a word or number.
_IN = "chr(57344)"
_CHAR = r"\p{L}\p{Nl}\p{Nd}_"


def _joined(text: str) -> str:
    """The text with :data:`_IN` before what stands between two letters or two digits; twice, as neighbours share a character."""
    for kind, between in (("[\\p{L}\\p{Nl}]", ".:·''’"), ("\\p{Nd}", ".,;''’")) * 2:
        text = f"regexp_replace({text}, '({kind})([{between}])({kind})', '\\1' || {_IN} || '\\2\\3', 'g')"
    return text


def _terms(text: str) -> str:
    return f"list_transform(regexp_extract_all({_joined(f'lower({text})')}, '(?:[{_CHAR}]|' || {_IN} || '.)*[\\p{{L}}\\p{{Nl}}\\p{{Nd}}]_*'), lambda x: replace(x, {_IN}, ''))"


def _marked(text: str, wanted: str) -> str:
    pieces = f"regexp_extract_all({_joined(text)}, '(?:[{_CHAR}]|' || {_IN} || '.)+|[^{_CHAR}' || {_IN} || ']+')"
    plain = f"replace(x, {_IN}, '')"
    return f"array_to_string(list_transform({pieces}, lambda x: CASE WHEN lower({plain}) IN ({wanted}) THEN '<em>' || {plain} || '</em>' ELSE {plain} END), '')"


def _bm25(name: str, field: str, words: list[str]) -> str:
    quoted = ", ".join(f"'{w}'" for w in words)
    return rf"""
{name}_t AS (SELECT fragment_id, unnest({_terms(field)}) AS t FROM ix),
{name}_l AS (SELECT fragment_id, count(*) AS n FROM {name}_t GROUP BY fragment_id),
{name}_f AS (SELECT fragment_id, t, count(*) AS tf FROM {name}_t WHERE t IN ({quoted}) GROUP BY ALL),
{name}_d AS (SELECT t, count(*) AS df FROM {name}_f GROUP BY t),
{name} AS (SELECT fragment_id, sum(ln(1 + ((SELECT count(*) FROM {name}_l) - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * n / (SELECT avg(n) FROM {name}_l)))) AS score
           FROM {name}_f JOIN {name}_l USING (fragment_id) JOIN {name}_d USING (t) GROUP BY fragment_id)"""


_STATE = "fragment_id, md5(content) AS content_md5, coalesce(len(v), -1)::INTEGER AS dims, page"

_CLASS = """CASE WHEN y2 - y1 > 25 AND length(content) < 100 THEN 'TITLE' WHEN y2 - y1 > 20 AND y1 < 200 THEN 'HEADER'
      WHEN left(trim(content), 1) IN ('•', '-', '◦', '▪') OR left(trim(content), 2) IN ('1.', '2.', '3.', '4.', '5.') THEN 'LIST_ITEM'
      WHEN position('chapter' IN lower(content)) > 0 OR position('section' IN lower(content)) > 0 OR position('figure' IN lower(content)) > 0 THEN 'SECTION' WHEN length(content) < 50 THEN 'CAPTION' ELSE 'PARAGRAPH' END"""

_CHANGED = _INDEX.replace("ix AS (", "ix0 AS (") + """,
ix AS (SELECT fragment_id, CASE WHEN v IS NULL THEN 'New text of the ' || fragment_id ELSE content END AS content, page, primary_section, v FROM ix0 WHERE page <> 3 AND fragment_id <> 'doc_7')"""

_FAILING = "CASE WHEN status = 200 AND EXISTS (SELECT 1 FROM lines l WHERE l.item_id = res.item_id AND l.page BETWEEN a AND z AND (l.item_id::BIGINT * 7 + l.page) % 13 = 5) THEN 500 ELSE status END"


def _answered(status: str) -> str:
    return f"""WITH r AS (SELECT row_number() OVER () AS nr, * FROM (WITH {_ASKED} SELECT item_id, {status} AS status, a, z FROM res)), c AS (SELECT * FROM ({_SEMANTIC_LAMBDA})),
      g AS (SELECT r.nr, count(c.item_id)::INTEGER AS n, coalesce(string_agg(c.fragment_id, ',' ORDER BY c.page, c.chunk_no), '') AS ids, md5(coalesce(string_agg(c.content, '|' ORDER BY c.page, c.chunk_no), '')) AS texts
            FROM r LEFT JOIN c ON c.item_id = r.item_id AND c.page BETWEEN r.a AND r.z WHERE r.status = 200 GROUP BY r.nr)
      SELECT r.item_id, r.status::INTEGER AS status, CASE WHEN r.status = 200 THEN a || '-' || z ELSE '-' END AS processed_pages, coalesce(g.n, -1) AS total_chunks, coalesce(ids, '-') AS fragments, coalesce(texts, '-') AS contents_md5,
        CASE r.status WHEN 200 THEN '-' WHEN 400 THEN 'item_id is required' WHEN 500 THEN 'unreadable page' ELSE 'Document ' || r.item_id || ' not found' END AS error
      FROM r LEFT JOIN g USING (nr)"""


def _json(text: str) -> str:
    """A string as JSON in ASCII, a character at a time."""
    one = "CASE WHEN unicode(x) < 127 THEN x WHEN unicode(x) < 65536 THEN printf('\\u%04x', unicode(x)) ELSE printf('\\u%04x', 55296 + (unicode(x) - 65536) // 1024) || printf('\\u%04x', 56320 + (unicode(x) - 65536) % 1024) END"
    return f"array_to_string(list_transform(string_split(to_json({text})::VARCHAR, ''), lambda x: {one}), '')"


#: Answers written by hand from the chunks' columns; numbers as the chunks have them before rounding.
_BODIES = f"""WITH r AS (SELECT row_number() OVER () AS nr, * FROM (WITH {_ASKED} SELECT item_id, status, a, z FROM res)), c AS (SELECT * FROM ({_SEMANTIC_LAMBDA.replace("round(avg(ocr_confidence), 6) AS ocr_confidence", "list_reduce(list_prepend(0::DOUBLE, list(ocr_confidence ORDER BY nr)), lambda p, q: p + q) / count(*) AS ocr_confidence").replace("'|' ORDER BY nr", "chr(1) ORDER BY nr")})),
  j AS (SELECT item_id, page, chunk_no, '{{"fragment_id": ' || {_json("fragment_id")} || ', "content": ' || {_json("content")} || ', "metadata": {{"item_id": ' || {_json("item_id")} || ', "page": ' || page || ', "type": "semantic_chunk", "section_titles": ['
          || CASE WHEN section_titles = '' AND primary_section = '-' THEN '' ELSE array_to_string(list_transform(string_split(section_titles, chr(1)), lambda t: {_json("t")}), ', ') END || '], "primary_section": '
          || CASE WHEN primary_section = '-' THEN 'null' ELSE {_json("primary_section")} END || ', "context_hierarchy": ' || CASE WHEN context_hierarchy = '-' THEN 'null' ELSE {_json("context_hierarchy")} END
          || ', "bbox": [' || replace(bbox, ',', ', ') || '], "ocr_confidence": ' || ocr_confidence::VARCHAR || ', "elements_count": ' || elements_count || ', "token_count": ' || token_count
          || ', "hierarchy_levels": [' || replace(hierarchy_levels, ',', ', ') || ']}}}}' AS t FROM c),
  g AS (SELECT r.nr, count(j.item_id) AS n, coalesce(string_agg(t, ', ' ORDER BY j.page, j.chunk_no), '') AS ts FROM r LEFT JOIN j ON j.item_id = r.item_id AND j.page BETWEEN r.a AND r.z WHERE r.status = 200 GROUP BY r.nr),
  b AS (SELECT r.item_id, r.status, CASE r.status WHEN 200 THEN '{{"item_id": ' || {_json("r.item_id")} || ', "processed_pages": "' || a || '-' || z || '", "total_chunks": ' || n || ', "chunks": [' || ts || ']}}'
          WHEN 400 THEN '{{"error": "item_id is required"}}' ELSE '{{"error": ' || {_json("'Document ' || r.item_id || ' not found'")} || '}}' END AS body FROM r LEFT JOIN g USING (nr))
SELECT item_id, status::INTEGER AS status, length(body)::INTEGER AS length, md5(body) AS body_md5 FROM b"""

ORACLES: dict[str, str] = {
    "clean_text": f"WITH {_LINES} SELECT item_id, page, ocr_seq, {_cleaned(CORRECTIONS)} AS content FROM lines",
    "clean_text_lambda": f"WITH {_LINES} SELECT item_id, page, ocr_seq, {_cleaned(SHORT_CORRECTIONS)} AS content FROM lines",
    "token_counts": f"WITH {_LINES} SELECT item_id, page, ocr_seq, {_tokens()} AS tokens FROM lines",
    "quality_filter": f"WITH {_LINES} SELECT item_id, page, ocr_seq, round({_LETTERS}, 6) AS letters, round({_SPECIAL}, 6) AS special FROM lines WHERE length(content) > 0 AND {_GOOD}",
    "classify_lines": f"""WITH {_LINES} SELECT item_id, page, ocr_seq, {_CLASS} AS line_class FROM lines""",
    "spatial_match": _match(False),
    "spatial_match_grid": _match(True),
    "reading_order": f"WITH {_LINES}, {_BLOCKS}, {_elements()} SELECT item_id, page, ocr_seq, id, level FROM ord",
    "heading_tree_enhanced": _tree(True),
    "heading_tree_lambda": _tree(False),
    "tree_children": f"""WITH t AS ({_tree(True)}) SELECT t.item_id, t.page, t.id, coalesce((SELECT string_agg(c.id::VARCHAR, ',' ORDER BY c.id) FROM t c WHERE c.item_id = t.item_id AND c.page = t.page AND c.parent_id = t.id), '') AS children FROM t""",
    "semantic_chunks_enhanced": _semantic(CORRECTIONS),
    "semantic_chunks_grid": _semantic(CORRECTIONS, grid=True),
    "semantic_chunks_lambda": _SEMANTIC_LAMBDA,
    "flat_chunks": _FLAT,
    "chunk_summary": f"SELECT type, count(*) AS total_chunks, sum(token_count)::BIGINT AS total_tokens, sum(elements_count)::BIGINT AS total_elements FROM (SELECT type, token_count, elements_count FROM ({_SEMANTIC_LAMBDA}) UNION ALL SELECT type, token_count, elements_count FROM ({_FLAT})) GROUP BY type",
    "page_range": f"WITH {_ASKED} SELECT l.item_id, l.page, l.ocr_seq FROM lines l JOIN res ON res.item_id = l.item_id AND status = 200 WHERE l.page >= a AND l.page <= z",
    "invocation_status": f"WITH {_ASKED} SELECT item_id, status::INTEGER AS status, CASE WHEN status = 200 THEN a ELSE -1 END::INTEGER AS first, CASE WHEN status = 200 THEN z ELSE -1 END::INTEGER AS last FROM res",
    "semantic_search": f"WITH {_INDEX} SELECT fragment_id, round({_COSINE}, 6) AS score FROM ix WHERE v IS NOT NULL ORDER BY {_COSINE} DESC, fragment_id LIMIT 5",
    "filtered_search": f"WITH {_INDEX} SELECT fragment_id, round({_COSINE}, 6) AS score FROM ix WHERE v IS NOT NULL AND page = 3 AND ocr_confidence >= 0.85::DOUBLE ORDER BY {_COSINE} DESC, fragment_id LIMIT 5",
    "text_search": rf"""WITH {_INDEX}, {_bm25("c", "content", ["the", "of", "and"])}, {_bm25("s", "primary_section", ["the"])}
      SELECT fragment_id, round(c.score + s.score, 6) AS score, (length(content) + 9 * len(list_filter({_terms("content")}, lambda x: x IN ('the', 'of', 'and'))))::INTEGER AS highlight_length
      FROM c JOIN s USING (fragment_id) JOIN ix USING (fragment_id) ORDER BY c.score + s.score DESC, fragment_id LIMIT 10""",
    "hybrid_search": f"""WITH {_INDEX}, {_bm25("c", "content", ["the", "of", "and"])}, both_ AS (SELECT ix.fragment_id, 0.7::DOUBLE * coalesce({_COSINE}, 0) + 0.3::DOUBLE * coalesce(score, 0) AS s FROM ix LEFT JOIN c USING (fragment_id) WHERE v IS NOT NULL OR score IS NOT NULL)
      SELECT fragment_id, round(s, 6) AS score FROM both_ ORDER BY s DESC, fragment_id LIMIT 10""",
    "fetch_one": f"WITH {_INDEX} SELECT fragment_id, content, page, {_tokens()} AS token_count FROM ix WHERE doc_id = 7",
    "fetch_content": "SELECT text AS content FROM documents WHERE doc_id = 7",
    "multi_get": "SELECT position::INTEGER AS position, 'doc_' || k AS fragment_id, coalesce(length(text), -1)::INTEGER AS length FROM (VALUES (0, '5'), (1, 'none'), (2, '3'), (3, '5')) q(position, k) LEFT JOIN documents ON doc_id::VARCHAR = k",
    "pending_vectors": "SELECT 'doc_' || doc_id AS fragment_id FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings) ORDER BY 1 LIMIT 1000",
    "pending_count": "SELECT count(*) FILTER (doc_id NOT IN (SELECT vec_id FROM embeddings)) AS pending, count(*) AS total FROM documents",
    "bulk_upsert": f"""WITH {_INDEX}, after_ AS (SELECT fragment_id, content, v, page FROM ix WHERE v IS NOT NULL UNION ALL SELECT fragment_id, 'new ' || fragment_id, NULL, page FROM ix WHERE v IS NULL UNION ALL SELECT 'doc_new', content, NULL, page FROM ix WHERE doc_id = 1) SELECT {_STATE} FROM after_""",
    "add_vectors": f"WITH {_INDEX} SELECT fragment_id, md5(content) AS content_md5, coalesce(len(v), 2)::INTEGER AS dims, page FROM ix",
    "update_content": f"WITH {_INDEX} SELECT fragment_id, md5('changed ' || fragment_id) AS content_md5, 1 AS dims, page FROM ix",
    "delete_by_id": f"WITH {_INDEX} SELECT {_STATE} FROM ix WHERE doc_id <> 7",
    "delete_by_page": f"WITH {_INDEX} SELECT {_STATE} FROM ix WHERE page <> 3",
    "delete_pending": f"WITH {_INDEX} SELECT {_STATE} FROM ix WHERE v IS NOT NULL",
    "markdown": f"""WITH {_LINES}, {_BLOCKS}, {_elements()} SELECT item_id, page, string_agg(CASE WHEN level < 5 THEN repeat('#', level) || ' ' || content ELSE content END, chr(10) || chr(10) ORDER BY id) AS markdown FROM ord GROUP BY item_id, page""",
    "stored_lines": """WITH p AS (SELECT doc_id, string_split(text, chr(10)) AS xs FROM documents WHERE text IS NOT NULL AND doc_id % 9 <> 0),
      l AS (SELECT doc_id, xs, unnest(generate_series(1, greatest(len(xs) - doc_id % 3, 0)))::INTEGER AS i FROM p)
      SELECT doc_id::VARCHAR AS item_id, (doc_id % 4)::INTEGER AS page, i - 1 AS ocr_seq, xs[i] AS content, (80 + i % 20)::DOUBLE / 100 AS ocr_confidence, 50 AS x1, 20 * i AS y1, 400 AS x2, 20 * i + 14 AS y2 FROM l""",
    "stored_blocks": f"""WITH {_LINES}, {_BLOCKS} SELECT item_id, page, block_idx, label, '' AS content, CASE WHEN (item_id::BIGINT + block_idx) % 3 = 0 THEN 0.0 ELSE 0.9 END::DOUBLE AS confidence, x1, y1, x2, y2
      FROM blocks WHERE (item_id::BIGINT + block_idx) % 7 <> 0 AND (item_id::BIGINT + block_idx) % 11 <> 0""",
    "filter_counts": f"""WITH {_LINES}, q AS (SELECT ocr_confidence < 0.85::DOUBLE AS c, length(regexp_replace(content, '^{_WS}|{_WS}$', '', 'g')) < 2 AS n,
        CASE WHEN content = '' THEN true ELSE {_LETTERS} < 0.5::DOUBLE END AS l, CASE WHEN content = '' THEN false ELSE {_SPECIAL} > {MAX_SPECIAL}::DOUBLE END AS s FROM lines)
      SELECT count(*) AS lines, count(*) FILTER (NOT (c OR n OR l OR s)) AS kept, count(*) FILTER (c) AS bad_confidence, count(*) FILTER (n) AS bad_length, count(*) FILTER (l) AS bad_letters, count(*) FILTER (s) AS bad_special FROM q""",
    "preview": f"SELECT * FROM ({_SEMANTIC_LAMBDA}) ORDER BY item_id, page, chunk_no LIMIT 3",
    "line_report": f"""WITH {_LINES}, r AS (SELECT *, {_CLASS} AS kind FROM lines)
      SELECT item_id, page, ocr_seq, lpad(ocr_seq::VARCHAR, 2, ' ') || '. [' || rpad(kind, 10, ' ') || '] ' || rpad(substring(content, 1, 50), 50, ' ') || ' (h:' || lpad((y2 - y1)::VARCHAR, 3, ' ') || ', y:' || lpad(y1::VARCHAR, 3, ' ')
        || ', conf:' || printf('%.2f', ocr_confidence) || ')' AS report FROM r""",
    "structure_boxes": f"""WITH {_LINES}, {_BLOCKS} SELECT item_id, page, block_idx, x1, y1, x2, y2, label || ' (0.90)' AS caption,
        CASE label WHEN 'title' THEN 255 WHEN 'text' THEN 0 WHEN 'header' THEN 0 WHEN 'figure' THEN 255 WHEN 'table' THEN 255 WHEN 'footer' THEN 128 ELSE 128 END AS red,
        CASE label WHEN 'title' THEN 0 WHEN 'text' THEN 255 WHEN 'header' THEN 0 WHEN 'figure' THEN 255 WHEN 'table' THEN 0 ELSE 128 END AS green,
        CASE label WHEN 'title' THEN 0 WHEN 'text' THEN 0 WHEN 'header' THEN 255 WHEN 'figure' THEN 0 WHEN 'table' THEN 255 ELSE 128 END AS blue FROM blocks""",
    "insert_with_vectors": f"WITH {_INDEX} SELECT {_STATE} FROM ix UNION ALL SELECT 'copy_' || fragment_id, md5(content), 3, page FROM ix",
    "bulk_add_vectors": f"WITH {_INDEX} SELECT fragment_id, md5(content) AS content_md5, coalesce(len(v), 3)::INTEGER AS dims, page FROM ix",
    "chunks_json_read": _SEMANTIC_LAMBDA,
    "envelopes_read": _answered("status"),
    "failed_items": _answered(_FAILING),
    "envelope_bodies": _BODIES,
    "subtree_totals": f"""WITH RECURSIVE {_LINES}, {_BLOCKS}, {_elements()}, t AS ({_tree(True)}),
      el2 AS (SELECT t.item_id, t.page, t.id, t.parent_id, {_tokens()} AS tokens FROM t JOIN ord o ON o.item_id = t.item_id AND o.page = t.page AND o.id = t.id),
      up AS (SELECT item_id, page, id, tokens, parent_id AS of_id FROM el2
             UNION ALL SELECT up.item_id, up.page, up.id, up.tokens, p.parent_id FROM up JOIN el2 p ON p.item_id = up.item_id AND p.page = up.page AND p.id = up.of_id),
      sums AS (SELECT item_id, page, of_id AS id, count(*) AS elements, sum(tokens) AS tokens FROM up WHERE of_id >= 0 GROUP BY ALL)
      SELECT t.item_id, t.page, t.id, t.level, coalesce(s.elements, 0)::INTEGER AS elements, coalesce(s.tokens, 0)::BIGINT AS tokens FROM t LEFT JOIN sums s ON s.item_id = t.item_id AND s.page = t.page AND s.id = t.id WHERE t.level < 5""",
    "batch_search": f"""WITH {_INDEX}, q AS (SELECT vec_id::VARCHAR AS query_id, embedding::DOUBLE[] AS u FROM embeddings WHERE vec_id % 50 = 0),
      s AS (SELECT query_id, fragment_id, round(list_cosine_similarity(u, v), 9) + 1 AS score FROM q, ix WHERE v IS NOT NULL)
      SELECT query_id, fragment_id, round(score, 6) AS score, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, fragment_id))::INTEGER AS rank FROM s QUALIFY rank <= 5""",
    "chunks_by_place": f"""WITH c AS (SELECT item_id, page, chunk_no, fragment_id, string_split(bbox, ',')::INTEGER[] AS b FROM ({_semantic(CORRECTIONS)})),
      asked(box, ax1, ay1, ax2, ay2) AS (VALUES ('top', 0, 0, 600, 100), ('left column', 0, 300, 75, 420), ('foot', 100, 700, 560, 760), ('beside', 565, 0, 700, 800))
      SELECT box, item_id, page, chunk_no, fragment_id, b[1] AS x1, b[2] AS y1, b[3] AS x2, b[4] AS y2 FROM c, asked WHERE least(b[3], ax2) > greatest(b[1], ax1) AND least(b[4], ay2) > greatest(b[2], ay1)""",
    "stored_changes": f"WITH {_CHANGED} SELECT {_STATE} FROM ix",
    "stored_hybrid_search": f"""WITH {_CHANGED}, {_bm25("c", "content", ["the", "of", "and"])}, both_ AS (SELECT ix.fragment_id, 0.7::DOUBLE * coalesce({_COSINE}, 0) + 0.3::DOUBLE * coalesce(score, 0) AS s FROM ix LEFT JOIN c USING (fragment_id) WHERE v IS NOT NULL OR score IS NOT NULL)
      SELECT fragment_id, round(s, 6) AS score FROM both_ ORDER BY round(s, 9) DESC, fragment_id LIMIT 10""",
    "highlights": rf"""WITH {_INDEX},
cut AS (SELECT fragment_id, unnest(ps) AS passage, generate_subscripts(ps, 1) AS place FROM (
          SELECT fragment_id, flatten(list_transform(string_split_regex(regexp_replace(content, '([.!?…。！？])\s+', '\1' || chr(10), 'g'), '\n+'), lambda s: list_transform(regexp_extract_all(s, '\S(?:.{{0,98}}\S)?(?:\s|$)|\S{{1,100}}'), lambda p: trim(p)))) AS ps FROM ix)),
rated AS (SELECT *, list_filter({_terms("passage")}, lambda x: x IN ('the', 'of', 'and')) AS found FROM cut),
best AS (SELECT * FROM rated WHERE len(found) > 0 QUALIFY row_number() OVER (PARTITION BY fragment_id ORDER BY len(list_distinct(found)) DESC, len(found) DESC, place) <= 5),
joined AS (SELECT fragment_id, string_agg({_marked("passage", "'the', 'of', 'and'")}, ' | ' ORDER BY place) AS fragments FROM best GROUP BY fragment_id)
      SELECT fragment_id, coalesce(fragments, '') AS fragments, md5({_marked("content", "'the', 'of', 'and'")}) AS highlight_md5 FROM ix LEFT JOIN joined USING (fragment_id) WHERE content IS NOT NULL""",
    "stored_text_search": rf"""WITH {_CHANGED}, {_bm25("c", "content", ["the", "of", "and"])}, {_bm25("s", "primary_section", ["the"])}
      SELECT fragment_id, round(c.score + s.score, 6) AS score, (length(content) + 9 * len(list_filter({_terms("content")}, lambda x: x IN ('the', 'of', 'and'))))::INTEGER AS highlight_length
      FROM c JOIN s USING (fragment_id) JOIN ix USING (fragment_id) ORDER BY round(c.score + s.score, 9) DESC, fragment_id LIMIT 10""",
}

# Page by page as above, then the pages of each item.
ORACLES["document_markdown"] = f"""SELECT item_id, string_agg(markdown, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY page) AS markdown FROM ({ORACLES["markdown"]}) GROUP BY item_id"""
