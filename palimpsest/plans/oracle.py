"""SQL (as DuckDB reads it) that gives the rows of the core queries on the same tables."""

from __future__ import annotations

from palimpsest.functions import patterns as P
from palimpsest.functions.text import LINE_KINDS


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def rx(col: str, pattern: str) -> str:
    return f"regexp_matches({col}, {q(pattern)})"


def sub(col: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({col}, {q(pattern)}, {q(to)}, 'g')"


def strip(col: str) -> str:
    return sub(col, rf"^[{P.SPACE}]+|[{P.SPACE}]+$")


def normalize_text(col: str) -> str:
    c = f"replace(replace(replace(replace(replace(replace({col}, chr(160), ' '), chr(9), ' '), chr(65279), ''), chr(8203), ''), chr(8232), chr(10)), chr(8233), chr(10))"
    return strip(sub(c, rf"[{P.SPACE_IN_LINE}]+", " "))


def normalize_line(col: str) -> str:
    return f"trim({sub(f'replace({col}, chr(0), chr(32))', rf'[{P.SPACE}]+', ' ')}, ' ')"


def letters(col: str) -> str:
    return f"length({sub(col, r'[^\p{L}]+')})"


def capitals(col: str) -> str:
    return f"length({sub(col, r'[^\p{Lu}]+')})"


def caps_ratio(col: str) -> str:
    return f"(CAST({capitals(col)} AS DOUBLE) / nullif({letters(col)}, 0))"


def caps_heading(col: str) -> str:
    element = " OR ".join(rx(col, p) for p in (P.FIGURE, P.TABLE, P.BODY_PARAGRAPH, P.APPENDIX_PARAGRAPH, P.ANNEX_PARAGRAPH))
    return f"(length({col}) >= 4 AND {letters(col)} >= 4 AND coalesce({caps_ratio(col)} > 0.82, false) AND NOT ({element}))"


def values(*items: str) -> str:
    return "(" + ", ".join(q(x) for x in items) + ")"


def preview(col: str, n: int = 220) -> str:
    c = normalize_line(col)
    return f"CASE WHEN length({c}) <= {n} THEN {c} ELSE substring({c}, 1, {n - 3}) || '...' END"


def remove_controls(col: str) -> str:
    return strip(sub(sub(sub(col, P.WIDE_CONTROL, " "), "[ \t]{2,}", " "), " *\n *", "\n"))


def slug(col: str) -> str:
    return f"coalesce(nullif(lower(trim({sub(col, '[^A-Za-z0-9]+', '-')}, '-')), ''), 'none')"


R = "r AS (SELECT * FROM records QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY extracted_at DESC) = 1)"
K = "k AS (SELECT DISTINCT * FROM knowledge)"
PG = "p AS (SELECT * FROM page_texts WHERE source_file IS NOT NULL AND pdf_page IS NOT NULL QUALIFY row_number() OVER (PARTITION BY source_file, pdf_page ORDER BY extracted_at DESC) = 1)"
CLEAN = f"list_filter(list_transform(lines, lambda x: {normalize_text('x')}), lambda x: x <> '')"
LINES = f"{PG}, c AS (SELECT source_file, pdf_page, {CLEAN} AS l FROM p), l AS (SELECT source_file, pdf_page, unnest(l) AS line, unnest(range(len(l))) AS line_no FROM c)"
SECTION = "coalesce(array_to_string(section_path, ' > '), '')"
PAGE = "CASE WHEN page_start_pdf = page_end_pdf THEN CAST(page_start_pdf AS VARCHAR) ELSE page_start_pdf || '-' || page_end_pdf END"
COMPACT = "CASE WHEN length(document_id) <= 48 THEN document_id ELSE regexp_replace(substring(document_id, 1, 48), '-+$', '') END"
LABEL = "CASE WHEN element_id IS NULL OR element_id = '' THEN element_type ELSE element_type || ' ' || element_id END"
CONTENT = (
    "concat_ws(chr(10), CASE WHEN caption <> '' AND NOT contains(coalesce(text, ''), caption) THEN 'Caption: ' || caption END, "
    "CASE WHEN element_type = 'table' AND title <> '' AND NOT contains(coalesce(text, ''), title) THEN 'Table title: ' || title END, coalesce(text, ''))"
)
SECTION_ONE = f"(starts_with(coalesce(element_id, ''), '1.') OR {rx('''coalesce(element_id, '')''', rf'^1{P.D}{{2}}(?:\.{P.D}+)?$')} OR starts_with(coalesce(section_path[1], ''), '1.'))"
_SUBSTANTIVE = ", ".join(f"'{x}'" for x in P.SUBSTANTIVE_TYPES)
REASON = (
    f"CASE WHEN element_type = 'footnote' THEN 'footnotes inform about the text they belong to' WHEN source_region = 'Body' AND {SECTION_ONE} THEN 'section 1 introduces the publication and should not contain requirements' "
    f"WHEN element_type IN ({_SUBSTANTIVE}) AND source_region = 'Body' THEN 'the body from section 2 on holds the primary technical content' WHEN element_type IN ({_SUBSTANTIVE}) AND source_region = 'Appendix' THEN 'an appendix has the same status as the main text' "
    f"WHEN element_type IN ({_SUBSTANTIVE}) AND source_region = 'Annex' THEN 'an annex is not integral to the publication' WHEN source_region IN ('Body', 'Appendix', 'Annex') THEN 'headings and references only lead through the text' "
    "WHEN source_region IN ('FrontMatter', 'References', 'Glossary', 'BackMatter') THEN 'front matter, references, glossary and back matter only inform' ELSE 'no rule of its own for this type and region' END"
)
SUBSTANTIVE = f"element_type IN {values(*P.SUBSTANTIVE_TYPES)}"
CLASSIFY = (
    f"CASE WHEN element_type = 'footnote' THEN 'Informative' WHEN source_region = 'Body' AND {SECTION_ONE} THEN 'Informational' "
    f"WHEN source_region IN ('Body', 'Appendix') AND {SUBSTANTIVE} THEN 'Normative' WHEN source_region = 'Annex' AND {SUBSTANTIVE} THEN 'Informative' ELSE 'Informational' END"
)


def expected(kind: str, region: str, section: str, label: str, layout: str) -> str:
    one = f"({rx(strip(section), rf'^1(?:\.|[{P.SPACE}])')} OR {rx(strip(label), rf'^1(?:\.{P.D}+)*$')} OR {rx(strip(label), rf'^1\.{P.D}+')})"
    return (
        f"CASE WHEN {layout} THEN 'Informational' WHEN {kind} = 'heading' THEN 'Informational' WHEN {kind} = 'footnote' THEN 'Informative' "
        f"WHEN {region} IN {values(*P.APPARATUS_REGIONS)} THEN 'Informational' WHEN {region} = 'Annex' THEN 'Informative' WHEN {region} = 'Appendix' THEN 'Normative' "
        f"WHEN {region} = 'Body' AND {one} THEN 'Informational' WHEN {region} = 'Body' AND {kind} IN ('paragraph', 'text_block', 'table', 'figure') THEN 'Normative' END"
    )


def finding(check: str, severity: str, reason: str, source: str, where: str = "true") -> str:
    return f"SELECT {q(check)} AS \"check\", {severity} AS severity, document_id AS doc_id, record_id, {PAGE} AS page, {SECTION} AS section, {reason} AS reason FROM {source} WHERE {where}"


FIRST = "f AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY document_id ORDER BY coalesce(seq, 4611686018427387904), coalesce(record_id, '')) = 1)"
PROSE = "element_type IN ('paragraph', 'requirement', 'text_block')"
CONTINUES = lambda c: f"(regexp_extract(upper({c}), '([A-Z]+)[^A-Z]*$', 1) IN {values(*P.CONTINUATION_WORDS)})"
MATCH_KIND = " ".join(f"WHEN {rx('line', p)} THEN {q(k)}" for k, p in LINE_KINDS)
TABLE_REASONS = " OR ".join([rx("text", P.TABLE_CONTAMINATION), "len(regexp_extract_all(text, '\\(cont\\.\\)')) > 1", rx("text", P.NEXT_SECTION), rx("text", P.NOTE_THEN_PROSE)])
NT = normalize_line("text")
FIGURE_LABEL = f"({NT} IN {values(*P.FIGURE_LABELS)} OR {rx(NT, P.FIGURE_LABEL)})"
VISIBLE = f"length({sub(strip('text'), rf'[{P.SPACE}]+')})"
MARKS = f"length({sub(strip('text'), rf'[\p{{L}}\p{{N}}{P.SPACE}]+')})"
ODD = lambda t: f"(length({sub(t, r'[^\x00-\x08\x0b-\x1f\x7f-\x{9f}]+')}) >= 2 OR length({sub(t, rf'[\x00-\x7f\p{{L}}{P.SPACE}]+')}) >= greatest(5, length({t}) // 20))"
GARBAGE = (
    f"(length({strip('text')}) >= 24 AND coalesce((CAST({letters(strip('text'))} AS DOUBLE) / nullif({VISIBLE}, 0) < 0.25 AND CAST({MARKS} AS DOUBLE) / nullif({VISIBLE}, 0) > 0.42) "
    f"OR ({ODD(strip('text'))} AND CAST({MARKS} AS DOUBLE) / nullif({VISIBLE}, 0) > 0.18), false))"
)
FIELDS = ("doc", "record", "status", "region", "pdf", "section", "text")
CAND = "stable_internal_id, {label} AS error_label, {severity} AS severity, CAST({conf} AS DOUBLE) AS confidence, {auto} AS auto_fixed"


def cand(label: str, severity: str, conf: float, auto: str, source: str, where: str) -> str:
    return f"SELECT {CAND.format(label=q(label), severity=q(severity), conf=conf, auto=auto)} FROM {source} WHERE {where}"


def fragment(c: str) -> str:
    v = normalize_line(c)
    return f"(length({v}) >= 4 AND coalesce({caps_ratio(v)} >= 0.80, false) AND NOT ends_with({v}, '.'))"


def tokens(c: str) -> str:
    return f"list_distinct(regexp_extract_all(lower({c}), '[a-z0-9]+'))"


def sql() -> dict[str, str]:
    furniture_name = rf"(?i)^(?:appendix|annex){P.S}+{P.ROMAN}$|^REFERENCES$"
    furniture_both = rf"(?i)^{P.D}{{1,3}}{P.S}+(?:appendix{P.S}+{P.ROMAN}|annex{P.S}+{P.ROMAN}|references)$"
    bad = lambda c, v: f"({c} IS NULL OR {c} NOT IN {values(*v)})"
    out = {
        "page_line_kinds": f"WITH {LINES} SELECT CASE WHEN line = '' THEN 'blank' {MATCH_KIND} WHEN {caps_heading('line')} THEN 'caps_heading' ELSE 'text' END AS kind, count(*) AS n FROM l GROUP BY 1",
        "printed_page_numbers": f"""WITH {PG}, c AS (SELECT source_file, pdf_page, {CLEAN} AS l FROM p),
a AS (SELECT *, CASE WHEN len(l) > 3 AND NOT coalesce(list_bool_or(list_transform(l[1:3], lambda x: {rx('x', P.CONTENTS_HEADING)})), false) AND {rx('l[-1]', P.PAGE_NUMBER)} THEN l[-1] END AS n1 FROM c),
b AS (SELECT *, CASE WHEN n1 IS NOT NULL THEN l[1:len(l) - 1] ELSE l END AS m FROM a),
e AS (SELECT *, CASE WHEN len(m) > 3 AND NOT coalesce(list_bool_or(list_transform(m[1:3], lambda x: {rx('x', P.CONTENTS_HEADING)})), false) AND {rx('m[1]', P.PAGE_NUMBER)} THEN m[1] END AS n2 FROM b)
SELECT source_file, pdf_page, coalesce(n1, n2) AS found_page, CAST(len(m) - CASE WHEN n2 IS NULL THEN 0 ELSE 1 END AS BIGINT) AS n_lines FROM e""",
        "furniture_lines": f"""WITH {LINES}, w AS (SELECT *, lag(line) OVER o AS before, lead(line) OVER o AS after FROM l WINDOW o AS (PARTITION BY source_file, pdf_page ORDER BY line_no))
SELECT source_file, pdf_page, CAST(line_no AS BIGINT) AS line_no, line FROM w WHERE {rx('line', furniture_both)} OR ({rx('line', P.PAGE_NUMBER)} AND coalesce({rx('after', furniture_name)}, false))
OR ({rx('line', furniture_name)} AND coalesce({rx('before', P.PAGE_NUMBER)}, false)) OR ({rx('line', rf'(?i)^no\.{P.S}+{P.D}+$')} AND coalesce({rx('after', P.BACK_MATTER_HEADING)}, false))""",
        "record_status_counts": f"WITH {R} SELECT element_type, text_status, count(*) AS n FROM r GROUP BY ALL",
        "record_dimension_counts": f"""WITH {R} SELECT 'type' AS dimension, element_type AS value, count(*) AS n FROM r GROUP BY 2 UNION ALL
SELECT 'status', text_status, count(*) FROM r GROUP BY 2 UNION ALL SELECT 'region', source_region, count(*) FROM r GROUP BY 2""",
        "rule_reasons": f"WITH {R} SELECT {REASON} AS reason, count(*) AS n FROM r GROUP BY 1",
        "rule_statuses": f"WITH {R} SELECT record_id, {CLASSIFY} AS rule_status FROM r",
        "status_rule_conflicts": f"""WITH {R}, s AS (SELECT element_type, source_region, {CLASSIFY} AS segmenter_status,
coalesce({expected('element_type', 'source_region', SECTION, "coalesce(element_id, '')", 'false')}, 'none') AS audit_status FROM r)
SELECT *, count(*) AS n FROM s WHERE segmenter_status <> audit_status GROUP BY ALL""",
        "section_paths": f"WITH {R} SELECT record_id, {SECTION} AS section, CAST(coalesce(len(section_path), 0) AS BIGINT) AS depth FROM r",
        "record_numbers": f"""WITH {R}, n AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY seq, record_id) AS number FROM r)
SELECT record_id, number, concat_ws(':', document_id, element_type, coalesce(element_id, element_type || '-' || lpad(CAST(number AS VARCHAR), 5, '0')), 'p' || page_start_pdf, 'r' || lpad(CAST(number AS VARCHAR), 5, '0')) AS made_id FROM n""",
        "region_carry_forward": f"""WITH {R} SELECT record_id, coalesce(last_value(CASE WHEN source_region <> 'Body' THEN source_region END IGNORE NULLS)
OVER (PARTITION BY document_id ORDER BY seq, record_id ROWS UNBOUNDED PRECEDING), 'none') AS last_other_region FROM r""",
        "heading_caps": f"WITH {R} SELECT record_id, round(coalesce({caps_ratio('text')}, 0), 6) AS caps_ratio, {caps_heading('text')} AS caps_heading FROM r WHERE element_type = 'heading'",
        "qa_schema": f"""WITH {R}, m AS (SELECT DISTINCT document_id FROM manifest WHERE document_id IS NOT NULL)
{finding('schema_validation', "'critical'", "'invalid status'", 'r', bad('text_status', P.STATUSES))} UNION ALL
{finding('schema_validation', "'critical'", "'invalid region'", 'r', bad('source_region', P.REGIONS))} UNION ALL
{finding('schema_validation', "'critical'", "'document without manifest row'", 'r', 'NOT EXISTS (SELECT 1 FROM m WHERE m.document_id = r.document_id)')} UNION ALL
{finding('schema_validation', "'medium'", "'blank text'", 'r', strip("coalesce(text, '')") + " = ''")}""",
        "qa_requirements": f"""WITH {R}, {FIRST}, g AS (SELECT document_id, count(*) AS n, count(*) FILTER (element_type = 'requirement') AS n_req FROM r GROUP BY 1)
{finding('requirement_boundary', f"CASE WHEN {rx('text', '^' + P.REQUIREMENT_MARKER.replace('(?i)', '(?i:', 1) + ')')} THEN 'medium' ELSE 'high' END", "'requirement marker inside other text'", 'r', "element_type IN ('paragraph', 'text_block') AND " + rx('text', P.REQUIREMENT_MARKER))} UNION ALL
{finding('requirement_boundary', "'high'", "'requirements document without requirements'", 'f JOIN g USING (document_id)', "contains(lower(document_type), 'requirements') AND n >= 30 AND n_req = 0")}""",
        "qa_footnotes": f"""WITH {R}, {FIRST}, h AS (SELECT * FROM r WHERE {PROSE} AND {rx('text', P.FOOTNOTE_BODY)}),
d AS (SELECT DISTINCT document_id FROM h EXCEPT SELECT document_id FROM r WHERE element_type = 'footnote')
{finding('footnote_contamination', "CASE WHEN text_status = 'Normative' THEN 'high' ELSE 'medium' END", "'footnote body inside other text'", 'h')} UNION ALL
{finding('footnote_contamination', "'medium'", "'document without footnotes'", 'f', 'document_id IN (SELECT document_id FROM d)')}""",
        "qa_furniture": f"WITH {R} {finding('header_footer_leakage', chr(39) + 'high' + chr(39), q('page furniture inside text'), 'r', PROSE + ' AND ' + rx('text', P.PAGE_FURNITURE))}",
        "qa_headings": f"""WITH {R}, w AS (SELECT *, lead(element_type) OVER o AS nk, lead(page_start_pdf) OVER o AS np FROM r WINDOW o AS (PARTITION BY document_id ORDER BY seq, record_id))
{finding('heading_split', "'medium'", "'wrapped heading'", 'w', "element_type = 'heading' AND nk = 'heading' AND np = page_start_pdf AND " + CONTINUES('text'))} UNION ALL
{finding('heading_split', "'medium'", "'section path ends with a continuation word'", 'r', f"coalesce(list_bool_or(list_transform(section_path, lambda x: {CONTINUES('x')})), false)")}""",
        "qa_contents": f"""WITH {R} {finding('toc_pollution', "'high'", "'dot leaders in the body'", 'r', "source_region = 'Body' AND " + rx('text', P.DOT_LEADER))} UNION ALL
{finding('toc_pollution', "'medium'", "'contents text in a section path'", 'r', f"coalesce(list_bool_or(list_transform(section_path, lambda x: {rx('x', P.DOT_LEADER)} OR {rx('x', P.CONTENTS_PATH)})), false)")}""",
        "qa_collisions": f"""WITH {R}, par AS (SELECT * FROM r WHERE element_type = 'paragraph'), g AS (SELECT document_id, element_id, count(*) AS n, count(*) FILTER (length(text) <= 90) AS s FROM par WHERE element_id <> '' GROUP BY ALL),
hot AS (SELECT * FROM g WHERE n > 3 AND s >= greatest(2, n // 2)),
a AS (SELECT par.* FROM par JOIN hot USING (document_id, element_id) WHERE length(text) <= 90 QUALIFY row_number() OVER (PARTITION BY document_id, element_id ORDER BY seq, record_id) <= 3),
t AS (SELECT r.*, (SELECT count(*) FROM par WHERE par.document_id = r.document_id AND par.page_start_pdf BETWEEN r.page_start_pdf AND r.page_end_pdf AND length(par.text) <= 90) AS n FROM r WHERE element_type = 'table')
{finding('table_paragraph_collision', "'medium'", "'repeated short paragraph'", 'a')} UNION ALL {finding('table_paragraph_collision', "'medium'", chr(39) + 'many short paragraphs on a table' + chr(39) * 2 + 's pages' + chr(39), 't', 'n > 3')}""",
        "qa_status": f"WITH {R} {finding('status_region_consistency', chr(39) + 'critical' + chr(39), f'{q(chr(114) + 'ule gives ')} || {CLASSIFY}', 'r', f'text_status IS DISTINCT FROM {CLASSIFY}')}",
        "qa_text": f"WITH {R} " + " UNION ALL ".join(finding("text_quality", q(s), q(t), "r", rx("text", p)) for p, s, t in ((P.CONTROL, "low", "control character"), (P.DAMAGE, "high", "encoding damage"), (P.HYPHEN_LEFT, "low", "hyphenation left"), (P.PAGE_ID_JOIN, "medium", "page number joined to an id"))),
        "qa_manifest": f"""WITH {R}, m AS (SELECT document_id, arg_max(record_count, (run_id, record_count)) AS expected FROM manifest WHERE status = 'ok' AND document_id IS NOT NULL GROUP BY 1),
c AS (SELECT document_id, count(DISTINCT record_id) AS n FROM r WHERE document_id IS NOT NULL GROUP BY 1)
SELECT 'manifest_consistency' AS "check", 'critical' AS severity, document_id AS doc_id, '' AS record_id, '' AS page, '' AS section,
CASE WHEN n IS NULL THEN 'manifest document has no records' WHEN expected IS NULL THEN 'document is absent from the manifest' ELSE 'record count differs' END AS reason
FROM m FULL JOIN c USING (document_id) WHERE n IS NULL OR expected IS NULL OR n <> expected""",
        "qa_record_ids": finding("record_id_collision_or_ambiguity", "'critical'", "'record id is repeated'", "(SELECT * FROM records QUALIFY count(*) OVER (PARTITION BY record_id) > 1)"),
        "qa_failures": "SELECT 'parse_failure' AS \"check\", 'critical' AS severity, coalesce(document_id, '') AS doc_id, '' AS record_id, '' AS page, '' AS section, concat_ws(': ', source_pdf, error) AS reason FROM manifest WHERE status <> 'ok' OR status IS NULL",
        "qa_top": f"""WITH {R}, f AS ({finding('status_region_consistency', "'critical'", f"'rule gives ' || {CLASSIFY}", 'r', f'text_status IS DISTINCT FROM {CLASSIFY}')})
SELECT severity, doc_id, page, record_id, reason FROM f ORDER BY doc_id, page, record_id, reason LIMIT 20""",
        "chunk_texts": f"""WITH {R} SELECT record_id, '[doc: ' || {COMPACT} || ' | record: ' || {LABEL} || ' | status: ' || text_status || ' | region: ' || source_region || ' | pdf: ' || {PAGE} || ']' || chr(10) || 'Section: ' || {SECTION} || chr(10) || chr(10) || {CONTENT} AS gpt_chunk_text FROM r""",
        "csv_preview": f"""WITH {R} SELECT record_id, document_id, document_type, document_category, element_type, coalesce(element_id, '') AS element_id, source_region, text_status, page_start_pdf, page_end_pdf,
coalesce(page_start_printed, '') AS page_start_printed, coalesce(page_end_printed, '') AS page_end_printed, {SECTION} AS section_path, coalesce(title, '') AS title, coalesce(caption, '') AS caption, confidence,
replace(substring(coalesce(text, ''), 1, 400), chr(10), ' ') AS text_preview FROM r""",
        "markdown_blocks": f"""WITH {R}, b AS (SELECT record_id, chr(10) || '---' || chr(10) || 'doc: ' || {COMPACT} || chr(10) || 'record: ' || {LABEL} || chr(10) || 'status: ' || text_status || chr(10) || 'region: ' || source_region || chr(10) ||
'pdf: ' || {PAGE} || chr(10) || 'section: ' || {SECTION} || chr(10) || chr(10) || {CONTENT} || chr(10) AS block FROM r) SELECT record_id, block, CAST(strlen(block) AS BIGINT) AS n_bytes FROM b""",
        "document_headers": f"""WITH {R} SELECT DISTINCT document_id, chr(10) || chr(10) || '# Document: ' || {COMPACT} || ' (continued) - ' || coalesce(document_title, 'null') || chr(10) || chr(10) || '- Full ID: ' || document_id || chr(10) || '- Category: ' || coalesce(document_category, 'null') || chr(10) ||
'- Type: ' || coalesce(document_type, 'null') || chr(10) || '- Series: ' || coalesce(series_name, 'null') || ' ' || coalesce(series_number, 'null') || chr(10) AS header FROM r""",
        "manifest_rows": f"""WITH {R}, c AS (SELECT document_id, count(*) AS record_count, count(*) FILTER (element_type = 'paragraph') AS paragraphs, count(*) FILTER (element_type = 'figure') AS figures, count(*) FILTER (element_type = 'table') AS tables,
count(*) FILTER (element_type = 'footnote') AS footnotes, count(*) FILTER (element_type = 'reference') AS references_count FROM r GROUP BY 1)
SELECT d.document_id, title, document_category, document_type, series_name, series_number, publication_year, coalesce(record_count, 0) AS record_count, coalesce(paragraphs, 0) AS paragraphs, coalesce(figures, 0) AS figures, coalesce(tables, 0) AS tables,
coalesce(footnotes, 0) AS footnotes, coalesce(references_count, 0) AS references_count FROM docs d LEFT JOIN c USING (document_id)""",
        "manifest_latest": "SELECT document_id, run_id, source_pdf, record_count FROM manifest WHERE status = 'ok' AND document_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY document_id ORDER BY run_id DESC, source_pdf DESC) = 1",
        "type_counts": f"""WITH {R}, c AS (SELECT document_id, element_type, count(*) AS n FROM r WHERE element_type IS NOT NULL GROUP BY ALL)
SELECT document_id, string_agg(element_type || '=' || n, ',' ORDER BY element_type) AS counts FROM c GROUP BY 1""",
        "document_changes": f"""WITH {K}, w AS (SELECT *, lag(doc) OVER o AS before, lag(original_record_index) OVER o AS bi FROM k WINDOW o AS (PARTITION BY part_file ORDER BY original_record_index))
SELECT part_file, doc, original_record_index FROM w WHERE bi IS NULL OR before IS DISTINCT FROM doc""",
        "document_ids": f"""SELECT document_id, coalesce(nullif(upper(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(series_number, '(?i)^no\\.\\s*', ''), '(?i)\\(\\s*rev\\.?\\s*([0-9]+)\\s*\\)', 'Rev\\1', 'g'),
'(?i)rev\\.?\\s*([0-9]+)', 'Rev\\1', 'g'), '[./]+', '-', 'g'), '[^A-Za-z0-9._-]+', '-', 'g'), '-+', '-', 'g'), '-')), ''), nullif(substring(upper(trim(regexp_replace(coalesce(title, ''), '[^A-Za-z0-9]+', '-', 'g'), '-')), 1, 80), ''), 'DOCUMENT') AS made_id,
{COMPACT} AS compact, {slug('title')} AS slug, coalesce(nullif(trim({sub(strip('series_number'), '[^A-Za-z0-9._-]+', '-')}, '-._'), ''), 'document') AS folder FROM docs""",
        "stable_ids": f"""WITH {K}, a AS (SELECT *, split_part(record, ' ', 1) AS kind, CASE WHEN contains(record, ' ') THEN substring(record, strpos(record, ' ') + 1) ELSE '' END AS label, substring(sha1(coalesce(section, '')), 1, 8) AS h,
regexp_extract({strip('pdf')}, '^([0-9]+)', 1) AS page FROM k), n AS (SELECT *, row_number() OVER (PARTITION BY doc, kind, label, h, page ORDER BY original_record_index) AS i FROM a)
SELECT original_record_index, concat_ws('__', {slug('doc')}, {slug('kind')}, {slug("coalesce(nullif(label, ''), 'none')")}, 'p' || coalesce(nullif(page, ''), 'unknown'), h, lpad(CAST(i AS VARCHAR), 4, '0')) AS stable_id FROM n""",
        "audit_controls": f"""WITH {K} {cand('control_or_garbage_chars', 'low', 0.96, 'true', 'k', ' OR '.join(rx(f, P.WIDE_CONTROL) for f in FIELDS))} UNION ALL
{cand('control_or_garbage_chars', 'medium', 0.72, 'false', 'k', f"contains(text, chr(65533)) OR {rx('text', P.PRIVATE_USE)} OR {GARBAGE}")}""",
        "audit_symbols": f"WITH {K} {cand('likely_ocr_symbol_error', 'high', 0.74, 'false', 'k', rx('text', P.POUND_NUMBER))}",
        "audit_tables": f"WITH {K} {cand('table_flattened_or_contaminated', 'medium', 0.80, 'false', 'k', f'record_type = {q(chr(116) + 'able')} AND ({TABLE_REASONS})')}",
        "audit_figures": f"""WITH {K}, w AS (SELECT *, last_value(CASE WHEN record_type = 'figure' THEN original_record_index END IGNORE NULLS) OVER (PARTITION BY doc, pdf ORDER BY original_record_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS fig FROM k)
{cand('figure_or_diagram_text_leakage', 'medium', 0.82, 'true', 'w', f"record_type <> 'figure' AND {FIGURE_LABEL} AND original_record_index - fig <= 4")}""",
        "audit_headings": f"""WITH {K}, w AS (SELECT *, lead(record_type) OVER o AS nk, lead(pdf) OVER o AS np, lead(region) OVER o AS nr, lead(text) OVER o AS nt, lead(section) OVER o AS ns FROM k WINDOW o AS (PARTITION BY doc ORDER BY original_record_index))
{cand('heading_fragmentation', 'medium', 0.70, 'false', 'w', f"record_type = 'heading' AND nk = 'heading' AND pdf = np AND region = nr AND {strip('text')} <> '' AND {strip('nt')} <> '' AND upper({strip('text')}) NOT IN {values(*P.STANDALONE_HEADINGS)} AND upper({strip('nt')}) NOT IN {values(*P.STANDALONE_HEADINGS)} AND length({strip('text')}) + length({strip('nt')}) + 1 <= 160 AND {fragment('text')} AND {fragment('nt')} AND NOT coalesce(section <> '' AND section = ns, false)")}""",
        "audit_statuses": f"""WITH {K}, w AS (SELECT *, {expected('record_type', 'region', 'section', 'official_record_label', 'coalesce(layout_text, false)')} AS want FROM k)
{cand('section_status_mismatch', 'medium', 0.93, 'true', 'w', 'want IS NOT NULL AND want <> status')}""",
        "audit_labels": f"""WITH {K}, w AS (SELECT * FROM k QUALIFY count(*) OVER (PARTITION BY doc, record) > 1 AND original_record_index = min(original_record_index) OVER (PARTITION BY doc, record))
{cand('record_id_collision_or_ambiguity', 'low', 0.95, 'true', 'w', 'true')}""",
        "audit_top": f"""WITH {K}, w AS (SELECT *, {expected('record_type', 'region', 'section', 'official_record_label', 'coalesce(layout_text, false)')} AS want FROM k)
SELECT stable_internal_id, 'medium' AS severity, CAST(0.93 AS DOUBLE) AS confidence, doc FROM w WHERE want <> status ORDER BY doc, coalesce(CAST(nullif(original_record_index, 0) AS VARCHAR), '') LIMIT 20""",
        "control_repair": f"WITH {K} SELECT stable_internal_id, {remove_controls('text')} AS text FROM k WHERE {rx('text', P.WIDE_CONTROL)}",
        "report_texts": f"WITH {K} SELECT stable_internal_id, {strip(sub('replace(' + sub(sub('text', P.WIDE_CONTROL, ' '), P.PRIVATE_USE, ' ') + ', chr(65533), chr(63))', '[ \t]{2,}', ' '))} AS sanitized, {preview('text')} AS preview FROM k",
        "garbage_texts": f"WITH {K} SELECT stable_internal_id, {ODD('text')} AS odd_symbols FROM k WHERE {GARBAGE}",
        "title_overlap": f"""WITH m AS (SELECT document_id, document_title FROM manifest WHERE status = 'ok' AND document_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY document_id ORDER BY run_id DESC, source_pdf DESC) = 1),
t AS (SELECT document_id, {tokens('document_title')} AS a, {tokens('title')} AS b FROM m JOIN docs USING (document_id) WHERE document_title IS NOT NULL AND title IS NOT NULL)
SELECT document_id, round(CASE WHEN len(a) = 0 OR len(b) = 0 THEN 0 ELSE CAST(len(list_intersect(a, b)) AS DOUBLE) / greatest(len(a), len(b)) END, 6) AS overlap FROM t""",
    }
    out["category_slugs"] = "SELECT trim(regexp_replace(lower(document_category), '[^a-z0-9]+', '_', 'g'), '_') AS slug, count(*) AS n FROM docs WHERE document_category IS NOT NULL GROUP BY 1"
    out["file_titles"] = f"""WITH a AS (SELECT document_id, {sub(f"replace(regexp_replace(source_file, '\\.[A-Za-z0-9]+$', ''), '_', ' ')", rf'[{P.SPACE}]+', ' ')} AS s FROM docs),
b AS (SELECT document_id, trim(regexp_replace(s, '(?i)^(?:mb[0-9]+)\\s+', ''), ' -') AS s FROM a)
SELECT document_id, array_to_string(list_transform(string_split(s, ' '), lambda w: upper(w[1]) || lower(substring(w, 2))), ' ') AS file_title FROM b"""
    # unions and counts of what stands above
    checks = [k for k in out if k.startswith("qa_") and k != "qa_top"]
    every = " UNION ALL ".join(f'SELECT "check", severity, doc_id FROM ({out[k]})' for k in checks)
    out["qa_summary"] = f"""WITH every AS ({every.replace(out['qa_record_ids'], out['qa_record_ids'].replace('FROM records QUALIFY', f'FROM (WITH {R} SELECT * FROM r) QUALIFY'))}), e AS (SELECT "check", severity, coalesce(nullif(doc_id, ''), '<series>') AS doc_id FROM every)
SELECT 'check' AS dimension, "check" AS value, count(*) AS n FROM e GROUP BY 2 UNION ALL SELECT 'severity', severity, count(*) FROM e GROUP BY 2
UNION ALL SELECT 'document', doc_id, count(*) FROM e GROUP BY 2 UNION ALL SELECT 'total', 'all', count(*) FROM e"""
    ranks = "CASE severity WHEN 'critical' THEN 0 WHEN 'high' THEN 1 WHEN 'medium' THEN 2 WHEN 'low' THEN 3 ELSE 9 END"
    whole = " UNION ALL ".join(f'SELECT "check", severity, doc_id, page, record_id, reason FROM ({out[k]})' for k in checks)
    out["qa_top"] = f"SELECT severity, doc_id, page, record_id, reason FROM ({whole}) ORDER BY {ranks}, doc_id NULLS FIRST, page NULLS FIRST, record_id NULLS FIRST, \"check\", reason LIMIT 20"
    labels = [k for k in out if k.startswith("audit_") and k != "audit_top"]
    out["audit_candidates"] = " UNION ALL ".join(f"SELECT stable_internal_id, error_label, severity, confidence, auto_fixed FROM ({out[k]})" for k in labels)
    c = out["audit_candidates"]
    out["audit_top"] = f"""WITH c AS ({c}), {K} SELECT stable_internal_id, severity, confidence, doc FROM c JOIN k USING (stable_internal_id)
ORDER BY {ranks}, confidence DESC, doc NULLS FIRST, CAST(original_record_index AS VARCHAR) NULLS FIRST, error_label LIMIT 20"""
    out["audit_summary"] = f"""WITH c AS ({c}) SELECT 'raw_record_count' AS metric, count(*) AS n FROM knowledge UNION ALL SELECT 'clean_record_count', count(DISTINCT stable_internal_id) FROM knowledge
UNION ALL SELECT 'label:' || error_label, count(*) FROM c GROUP BY 1 UNION ALL SELECT 'severity:' || severity, count(*) FROM c GROUP BY 1 UNION ALL SELECT 'manual_review_count', count(*) FROM c WHERE NOT auto_fixed"""
    out["audit_concentration"] = f"""WITH c AS ({c}), {K}, r AS (SELECT doc, count(*) AS n_records FROM k GROUP BY 1), d AS (SELECT doc, count(*) AS n_candidates FROM c JOIN k USING (stable_internal_id) GROUP BY 1)
SELECT doc, n_records, n_candidates, n_candidates / n_records AS rate FROM r JOIN d USING (doc) ORDER BY rate DESC, n_candidates DESC, doc LIMIT 20"""
    return out
