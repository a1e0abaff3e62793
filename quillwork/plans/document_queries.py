"""Segmentation of documents, chat records and row-local rewriting of answers."""

from __future__ import annotations

from quillwork.functions import text as X
from quillwork.functions import vocab as V
from quillwork.plans.base import current
from quillwork.plans.dialect import Dialect
from quillwork.plans.pack_queries import A, verse_valid
from quillwork.plans.relational_queries import EXAMPLES
from quillwork.plans.scalar_queries import scenario

DEVANAGARI = r"[\x{0900}-\x{097F}]"
MARKER = r"^\((\d+)\.(\d+)\)"


def texts(d: Dialect) -> str:
    """One text a document; replayed rows count once."""
    return f"(SELECT source_document_id AS doc, raw_text FROM {current(d, 'extracted_document_texts')} t WHERE raw_text IS NOT NULL) s"


def numbered_blocks(d: Dialect) -> str:
    source, at = d.numbered(f"(SELECT doc, {X.blocks(d, 'raw_text')} AS items FROM {texts(d)}) q", "items")
    return f"SELECT doc, {at} AS i, item AS block FROM {source}"


def chunk_documents(d):
    """Carry-forward chunker: chapter, section and verse are states, a chapter ends a section, both end a verse;
    neighbouring plain blocks of one state become one chunk."""
    heading = f"NOT contains(block, chr(10)) AND {X.is_heading(d, 'block', 8)}"
    by = "PARTITION BY doc ORDER BY i"
    return f"""WITH b AS ({numbered_blocks(d)}),
c AS (SELECT doc, i, block, CASE WHEN {d.rx('block', r'(?i)^chapter \d+')} THEN 'chapter' WHEN {heading} THEN 'section' WHEN {d.rx('block', MARKER)} THEN 'verse' ELSE 'text' END AS kind FROM b),
n AS (SELECT *, sum(CASE WHEN kind = 'chapter' THEN 1 ELSE 0 END) OVER ({by}) AS chapter_no, sum(CASE WHEN kind IN ('chapter', 'section') THEN 1 ELSE 0 END) OVER ({by}) AS part_no FROM c),
s AS (SELECT *, {d.last_known("CASE WHEN kind = 'chapter' THEN " + d.ext('block', r'(?i)^chapter (\d+)') + " END", by)} AS chapter,
 {d.last_known("CASE WHEN kind = 'section' THEN trim(block) END", 'PARTITION BY doc, chapter_no ORDER BY i')} AS section,
 {d.last_known("CASE WHEN kind = 'verse' THEN " + d.ext('block', r'^\((\d+\.\d+)\)') + " END", 'PARTITION BY doc, part_no ORDER BY i')} AS verse FROM n),
g AS (SELECT *, CASE WHEN kind = 'text' AND lag(kind) OVER ({by}) = 'text' THEN 0 ELSE 1 END AS starts FROM s),
h AS (SELECT *, sum(starts) OVER ({by}) AS grp FROM g WHERE kind IN ('text', 'verse')),
m AS (SELECT doc, grp, min(i) AS first_block, max(kind) AS kind, max(chapter) AS chapter, max(section) AS section, max(verse) AS verse, count(*) AS n_blocks, md5({d.ordered_join('block', 'i', chr(10) + chr(10))}) AS content_md5 FROM h GROUP BY doc, grp)
SELECT doc, row_number() OVER (PARTITION BY doc ORDER BY first_block) - 1 AS chunk_index, kind, chapter, section, verse, n_blocks, content_md5 FROM m""".replace("row_number() OVER (PARTITION BY doc ORDER BY first_block) - 1", d.big("row_number() OVER (PARTITION BY doc ORDER BY first_block) - 1"))


def active_range(d):
    """From two blocks before the first verse marker to the block before the first comment after it."""
    return f"""WITH b AS ({numbered_blocks(d)}), f AS (SELECT doc, min(CASE WHEN {d.rx('block', MARKER)} THEN i END) AS seen FROM b GROUP BY doc),
e AS (SELECT b.doc AS doc, min(i) AS ends FROM b JOIN f ON b.doc = f.doc WHERE i >= seen AND {d.rx('block', '^Comments:')} GROUP BY b.doc)
SELECT f.doc AS doc, {d.big('greatest(seen - 2, 1)')} AS first_block, {d.big('ends')} AS end_block FROM f LEFT JOIN e ON f.doc = e.doc WHERE seen IS NOT NULL"""


def passage_units(d):
    """Marker-delimited passages: a marker starts one, its blocks follow until the next; noise is dropped, a speaker is kept."""
    by = "PARTITION BY doc ORDER BY i"
    noise = d.rx("block", r"(?i)^(page \d+|[-–\[]? ?\d+ ?[-–\]]?|chapter \d+.*)$")
    return f"""WITH b AS (SELECT * FROM ({numbered_blocks(d)}) q WHERE NOT {noise}), n AS (SELECT *, sum(CASE WHEN {d.rx('block', MARKER)} THEN 1 ELSE 0 END) OVER ({by}) AS unit FROM b)
SELECT doc, {d.big('unit')} AS unit, max({d.ext('block', r'^\((\d+\.\d+)\)')}) AS marker, max({d.ext('block', r'([A-Z][a-z]+) (?:said|answered)')}) AS speaker, count(*) AS n_blocks, md5({d.ordered_join('block', 'i', ' ')}) AS text_md5 FROM n WHERE unit > 0 GROUP BY doc, unit"""


def verse_units(d):
    """Verse blocks with the nearest script block (looked for two and one before, then one and two after), and the run of
    comment blocks behind them."""
    by = "PARTITION BY doc ORDER BY i"
    script = lambda e: f"CASE WHEN {d.rx(e, DEVANAGARI)} THEN {e} END"
    return f"""WITH b AS ({numbered_blocks(d)}),
l AS (SELECT doc, i, block, {d.rx('block', MARKER)} AS is_verse, lag(block, 2) OVER ({by}) AS b2, lag(block, 1) OVER ({by}) AS b1, lead(block, 1) OVER ({by}) AS a1, lead(block, 2) OVER ({by}) AS a2 FROM b),
u AS (SELECT *, sum(CASE WHEN is_verse THEN 1 ELSE 0 END) OVER ({by}) AS unit FROM l),
stop AS (SELECT doc, unit, min(CASE WHEN NOT is_verse AND NOT {d.rx('block', '^Comments:')} THEN i END) AS stop_at FROM u WHERE unit > 0 GROUP BY doc, unit),
run AS (SELECT u.doc AS doc, u.unit AS unit, count(*) AS n_comments FROM u JOIN stop s ON u.doc = s.doc AND u.unit = s.unit WHERE NOT is_verse AND (stop_at IS NULL OR i < stop_at) GROUP BY u.doc, u.unit)
SELECT u.doc AS doc, {d.big('u.unit')} AS unit, {d.ext('block', r'^\((\d+\.\d+)\)')} AS verse, md5(coalesce({script('b2')}, {script('b1')}, {script('a1')}, {script('a2')})) AS script_md5, coalesce(n_comments, 0) AS n_comments
FROM u LEFT JOIN run r ON u.doc = r.doc AND u.unit = r.unit WHERE is_verse""".replace("coalesce(n_comments, 0)", d.big("coalesce(n_comments, 0)"))


def pages_of(d: Dialect) -> str:
    """The pages of raw_text: what lies between page-number lines, blank ones dropped."""
    return d.nonblank(d.split(d.sub(d.sub("raw_text", r"\r\n?", "\n"), r"(?i)\n[ \t]*(?:page |p\. ?|[-–\[] ?)?\d{1,4}(?: ?[-–\]])?[ \t]*\n", "\x01"), "\x01"))


def pages_extract_text(d):
    """Pages between page-number lines, stripped, blank ones dropped, joined by blank lines."""
    pages = pages_of(d)
    return f"SELECT doc, {d.size('pages')} AS n_pages, md5({d.join(d.trans('pages', 'g', d.sub('g', r'^\s+|\s+$', '')), chr(10) + chr(10))}) AS text_md5 FROM (SELECT doc, {pages} AS pages FROM {texts(d)}) q"


# chat records

ROLES = ["system", "user", "assistant"]


def chat_checked(d: Dialect) -> str:
    m = "m"
    known = d.exists(m, "x", f"x.role IS NULL OR NOT ({d.isin('x.role', ROLES)})")
    blank = d.exists(m, "x", "x.content IS NULL OR trim(x.content) = ''")
    missing = " OR ".join(f"NOT {d.exists(m, 'x', 'x.role = ' + d.lit(r))}" for r in ROLES)
    first = f"{d.el(m, 1)}.role" if d.name == "spark" else f"({d.el(m, 1)}).role"
    return f"""(SELECT line_id, file_name, CASE WHEN line_text IS NULL OR trim(line_text) = '' THEN 'blank' WHEN m IS NULL OR {d.size(m)} = 0 THEN 'no_messages' WHEN {known} THEN 'unknown_role' WHEN {blank} THEN 'blank_content' WHEN {missing} THEN 'missing_role' WHEN {first} <> 'system' THEN 'first_not_system' ELSE 'valid' END AS verdict
FROM (SELECT line_id, file_name, line_text, {d.messages('line_text')} AS m FROM {d.table('chat_lines')}) q)"""


def chat_validate_strict(d):
    return f"SELECT line_id, verdict FROM {chat_checked(d)} c"


def chat_validation_report(d):
    """By file: a blank line is invalid but not part of the total."""
    return f"SELECT file_name, {d.count_if('verdict <> ' + d.lit('blank'))} AS n_total, {d.count_if('verdict = ' + d.lit('valid'))} AS n_valid, {d.count_if('verdict <> ' + d.lit('valid'))} AS n_invalid FROM {chat_checked(d)} c GROUP BY file_name"


def role_content(d: Dialect, role: str) -> str:
    one = d.el(d.filt("messages", "m", f"m.role = {d.lit(role)}"), 1)
    return f"{one}.content" if d.name == "spark" else f"({one}).content"


def chat_roles_pivot(d):
    same = " AND ".join(d.exists("messages", "m", f"m.role = {d.lit(r)}") for r in ROLES)
    return f"SELECT record_id, {', '.join(f'md5({role_content(d, r)}) AS {r}_md5' for r in ROLES)} FROM {d.table('chat_records')} WHERE {d.size('messages')} >= 3 AND {same} AND NOT {d.exists('messages', 'm', 'NOT (' + d.isin('m.role', ROLES) + ')')}"


def export_chat_jsonl(d):
    """The examples that pass the export gate as lines of JSON: fixed system prompt, prompt and answer."""
    parts = [("system", d.lit(V.SYSTEM_PROMPT)), ("user", "coalesce(user_problem, '')"), ("assistant", f"coalesce({A}, '')")]
    if d.name == "spark":
        line = "to_json(named_struct('messages', array(" + ", ".join(f"named_struct('role', '{r}', 'content', {e})" for r, e in parts) + ")))"
    else:
        line = "CAST(to_json({'messages': [" + ", ".join(f"{{'role': '{r}', 'content': {e}}}" for r, e in parts) + "]}) AS VARCHAR)"
    gate = f"x.approved_for_finetune AND x.dataset_status = 'approved' AND EXISTS (SELECT 1 FROM {d.table('wisdom_entries')} e WHERE e.id = x.wisdom_entry_id AND e.principle_status = 'approved')"
    return f"SELECT x.id AS id, md5({line}) AS line_md5, {d.big(f'length({line})')} AS n_chars FROM {d.table(EXAMPLES)} x WHERE {gate}"


def chat_replace(d):
    new = d.trans("messages", "m", f"CASE WHEN m.role = 'system' THEN {d.lit(V.REPLACED_PROMPT)} ELSE m.content END")
    return f"SELECT record_id, md5({d.join(new, chr(1))}) AS replaced_md5 FROM {d.table('chat_records')}"


def numbered_pages(d: Dialect) -> str:
    source, at = d.numbered(f"(SELECT doc, {pages_of(d)} AS items FROM {texts(d)}) q", "items")
    return f"SELECT doc, {at} AS page_no, {d.sub('item', r'^[ \t\n]+|[ \t\n]+$', '')} AS page FROM {source}"


def page_scan(d):
    """Every page of every document with its number."""
    return f"SELECT doc, page_no, {d.big('length(page)')} AS n_chars, md5(page) AS page_md5 FROM ({numbered_pages(d)}) p"


def page_range(d):
    """The pages of each document from the first that begins with its title to the last before one that holds comments; the stop is looked for from the first page on."""
    first_line = f"lower(trim({d.el(d.split('page', chr(92) + 'n'), 1)}))"
    return f"""WITH t AS (SELECT id AS title_doc, lower(trim(max(title))) AS title FROM {d.table('source_documents')} GROUP BY id), p AS ({numbered_pages(d)}),
b AS (SELECT doc, min(page_no) AS first_page FROM p JOIN t ON doc = title_doc WHERE {first_line} = title GROUP BY doc),
e AS (SELECT p.doc AS doc, min(page_no) AS stop_page FROM p JOIN b ON p.doc = b.doc WHERE page_no >= first_page AND contains(lower(page), 'comments:') GROUP BY p.doc)
SELECT p.doc AS doc, page_no FROM p JOIN b ON p.doc = b.doc LEFT JOIN e ON p.doc = e.doc WHERE page_no >= first_page AND (stop_page IS NULL OR page_no < stop_page)"""


def locators(d):
    """Chapter and section of a verse number: two parts are chapter and section, three have a part between."""
    parts = d.split("verse_number", "[-.]")
    chapter = f"CASE WHEN {d.size('parts')} IN (2, 3) THEN {d.el('parts', 1)} END"
    section = f"CASE WHEN {d.size('parts')} = 2 THEN concat('Section ', {d.el('parts', 1)}) WHEN {d.size('parts')} = 3 THEN concat('Part ', {d.el('parts', 2)}) END"
    return f"SELECT id, {chapter} AS chapter, {section} AS section FROM (SELECT id, {parts} AS parts FROM {current(d, 'canonical_verses')} v WHERE verse_number IS NOT NULL) q"


def blocks_joined(d):
    """Blocks whose lines are joined by blanks."""
    lines = d.trans(X.blocks(d, "raw_text"), "v", X.clean_text(d, "v"))
    return f"SELECT doc, {d.size('b')} AS n_blocks, md5({d.join('b', '|')}) AS blocks_md5 FROM (SELECT doc, {lines} AS b FROM {texts(d)}) q"


def polish_response(d):
    inner = X.sentence_case(d, X.phrase_replace(d, A))
    return f"SELECT id, md5({X.clean_text(d, X.phrase_replace(d, inner))}) AS polished_md5 FROM {d.table(EXAMPLES)} WHERE {A} IS NOT NULL"


def rewrite_pool(d):
    """Rows whose prompt could be rewritten: answers in bounds without scaffold, ranked by theme, length and id."""
    tags = X.tags_of(d, "lower(user_problem)", V.EMOTIONAL)
    n = d.size(X.word_tokens(d, A))
    return f"SELECT id, theme, {d.big('row_number() OVER (PARTITION BY theme ORDER BY n_words DESC, id)')} AS place FROM (SELECT id, {scenario(d, '(' + tags + ')')} AS theme, {n} AS n_words FROM {d.table(EXAMPLES)} WHERE {A} IS NOT NULL AND user_problem IS NOT NULL AND {n} BETWEEN 60 AND 150 AND NOT {d.rx(A, V.LISTICLE)}) q"


def verse_quality_bands(d):
    """Share of valid and usable verses of each source."""
    t = "english_translation"
    return f"SELECT source_document_id, count(*) AS n, {d.count_if(verse_valid(d, t))} AS n_valid, {d.count_if('coalesce(is_valid, false)')} AS n_marked FROM {current(d, 'canonical_verses')} v WHERE {t} IS NOT NULL GROUP BY source_document_id"


QUERIES = {f.__name__: f for f in (chunk_documents, active_range, page_scan, page_range, locators, blocks_joined, passage_units, verse_units, pages_extract_text, chat_validate_strict, chat_validation_report, chat_roles_pivot, export_chat_jsonl, chat_replace, polish_response, rewrite_pool, verse_quality_bands)}
