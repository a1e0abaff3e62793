"""The relational core: lookups, gates, joins, aggregates, reports, ranking and de-duplication."""

from __future__ import annotations

from quillwork.functions import text as X
from quillwork.functions import vocab as V
from quillwork.plans.base import current
from quillwork.plans.dialect import Dialect
from quillwork.plans.pack_queries import A

ENTRIES, EXAMPLES = "wisdom_entries", "training_examples"


def entries(d: Dialect, where: str = "") -> str:
    return f"{current(d, ENTRIES, where)} e"


def source_of(d: Dialect) -> str:
    return f"(SELECT id AS source_id, max(title) AS title, max(source_name) AS source_name, max(status) AS source_status FROM {d.table('source_documents')} GROUP BY id) s"


def doc_lookup(d):
    return f"SELECT id, title, language, status FROM {d.table('source_documents')} WHERE id = 7 GROUP BY id, title, language, status"


def gate_entries(d):
    return f"SELECT id, confidence_score FROM {entries(d, "principle_status = 'approved' AND confidence_score >= 80")}"


def gate_source_pool(d):
    gate = f"distilled_wisdom IS NOT NULL AND trim(distilled_wisdom) <> '' AND principle_quality_score >= 70 AND {d.rx('book_title', '(?i)(river|garden|from|verses)')}"
    return f"SELECT id, book_title FROM {entries(d, gate)}"


def tag_search(d):
    all_tags = d.cat(d.cat(f"coalesce(emotional_tags, {d.array([])})", f"coalesce(philosophical_tags, {d.array([])})"), f"coalesce(use_cases, {d.array([])})")
    return f"SELECT id FROM {entries(d, d.exists(all_tags, 'g', 'contains(lower(g), ' + d.lit('con') + ')'))}"


def tag_buckets(d):
    em = lambda tags: d.overlap(f"coalesce(emotional_tags, {d.array([])})", d.strings(tags))
    ph = lambda tags: d.overlap(f"coalesce(philosophical_tags, {d.array([])})", d.strings(tags))
    buckets = {"anger_and_duty": f"{em(['anger', 'frustration'])} AND {ph(['duty', 'discipline'])}", "grief": em(["grief", "sorrow", "loss"]), "detachment": ph(["detachment", "renunciation"])}
    return " UNION ALL ".join(f"SELECT {d.lit(k)} AS bucket, id FROM {entries(d, c)}" for k, c in buckets.items())


def export_gate(d):
    return f"SELECT x.id AS id, e.id AS entry_id FROM {d.table(EXAMPLES)} x JOIN {entries(d)} ON x.wisdom_entry_id = e.id WHERE x.approved_for_finetune AND e.principle_status = 'approved' AND x.dataset_status = 'approved'"


def approval_gate(d):
    ok = f"coalesce(x.dataset_status = 'approved' AND e.principle_status = 'approved' AND x.dataset_quality_score >= 85 AND {d.size('x.dataset_audit_issues')} = 0, false)"
    return f"SELECT x.id AS id, {ok} OR coalesce(x.approved_for_finetune, false) AS approved, {ok} AS approved_two_way FROM {d.table(EXAMPLES)} x JOIN {entries(d)} ON x.wisdom_entry_id = e.id"


def join_examples_entries(d):
    return f"SELECT x.id AS id, e.book_title AS book_title, e.chapter AS chapter FROM {d.table(EXAMPLES)} x JOIN {entries(d)} ON x.wisdom_entry_id = e.id"


def anti_existing(d):
    return f"SELECT id FROM {entries(d)} WHERE NOT EXISTS (SELECT 1 FROM {d.table(EXAMPLES)} x WHERE x.wisdom_entry_id = e.id)"


def semi_reviewed(d):
    return f"SELECT id FROM {entries(d)} WHERE EXISTS (SELECT 1 FROM {d.table(EXAMPLES)} x WHERE x.wisdom_entry_id = e.id AND x.dataset_status = 'approved')"


def left_attach(d):
    return f"SELECT t.id AS id, s.title AS title, s.source_name AS source_name FROM (SELECT DISTINCT id, source_document_id FROM {d.table('extracted_document_texts')}) t LEFT JOIN {source_of(d)} ON t.source_document_id = s.source_id"


def review_upsert(d):
    """Old reviews (entries with an even id) and new ones (quality of the examples); the new one wins."""
    return f"""WITH old AS (SELECT id, coalesce(principle_quality_score, 0.0) AS score, 'old' AS origin FROM {entries(d)} WHERE principle_quality_score IS NOT NULL),
fresh AS (SELECT wisdom_entry_id AS id, max(dataset_quality_score) AS score, 'new' AS origin FROM {d.table(EXAMPLES)} WHERE wisdom_entry_id IS NOT NULL AND dataset_quality_score IS NOT NULL GROUP BY wisdom_entry_id)
SELECT coalesce(f.id, o.id) AS id, coalesce(f.score, o.score) AS score, coalesce(f.origin, o.origin) AS origin FROM old o FULL OUTER JOIN fresh f ON o.id = f.id"""


def count_by_source(d):
    return f"SELECT e.source_document_id AS source_document_id, count(*) AS n_examples FROM {d.table(EXAMPLES)} x JOIN {entries(d)} ON x.wisdom_entry_id = e.id GROUP BY e.source_document_id"


def per_source_counts(d):
    return f"SELECT source_document_id, chapter_number, count(*) AS n FROM {current(d, 'canonical_verses')} v GROUP BY source_document_id, chapter_number"


def quality_report(d):
    return f"SELECT count(*) AS n_total, {d.count_if('approved_for_finetune')} AS n_approved, count(*) - {d.count_if('approved_for_finetune')} AS n_rejected, round(avg(dataset_quality_score), 2) AS mean_score FROM {d.table(EXAMPLES)}"


def status_histogram(d):
    return f"SELECT coalesce(nullif(trim(dataset_status), ''), 'needs_review') AS status, count(*) AS n FROM {d.table(EXAMPLES)} GROUP BY 1"


def source_status_pivot(d):
    states = ["approved", "needs_review", "rejected"]
    cols = ", ".join(f"{d.count_if(f'principle_status = {d.lit(s)}')} AS n_{s}" for s in states)
    return f"SELECT book_title, {cols} FROM {entries(d)} GROUP BY book_title"


def issue_counts(d):
    return f"SELECT issue, count(*) AS n FROM (SELECT {d.explode('dataset_audit_issues')} AS issue FROM {d.table(EXAMPLES)} WHERE coalesce(dataset_status, '') <> 'approved') q GROUP BY issue"


def tag_distribution(d):
    return " UNION ALL ".join(f"SELECT '{c}' AS kind, tag, count(*) AS n FROM (SELECT {d.explode(c)} AS tag FROM {entries(d)}) q GROUP BY tag" for c in ("emotional_tags", "philosophical_tags", "use_cases"))


def top_openings(d):
    """The 25 openings seen most often; ties by first appearance."""
    return f"SELECT opening, n FROM (SELECT {X.opening(d, A)} AS opening, count(*) AS n, min(id) AS first_id FROM {d.table(EXAMPLES)} WHERE {A} IS NOT NULL GROUP BY 1) q ORDER BY n DESC, first_id LIMIT 25"


def dup_fingerprint_groups(d):
    return f"SELECT k, n, first_id, last_id FROM (SELECT md5({X.fingerprint(d, A)}) AS k, count(*) AS n, min(id) AS first_id, max(id) AS last_id FROM {d.table(EXAMPLES)} WHERE {A} IS NOT NULL GROUP BY 1) q WHERE n > 2"


def dup_fingerprint_members(d):
    """The members of every group of more than two, a row each, with the size of the group: a hot group is no list in one row."""
    return f"""WITH f AS (SELECT id, md5({X.fingerprint(d, A)}) AS k FROM {d.table(EXAMPLES)} WHERE {A} IS NOT NULL), g AS (SELECT k AS gk, count(*) AS n FROM f GROUP BY k HAVING count(*) > 2)
SELECT k, n, id FROM f JOIN g ON k = gk"""


def flag_counts(d):
    """How many entries of a book are distilled, and how many examples of them may be exported."""
    return f"""WITH e AS (SELECT id, book_title, CASE WHEN distilled_wisdom IS NOT NULL AND trim(distilled_wisdom) <> '' THEN 1 ELSE 0 END AS distilled, principle_status FROM {entries(d)}),
x AS (SELECT wisdom_entry_id AS entry, count(*) AS n, {d.count_if("approved_for_finetune AND dataset_status = 'approved'")} AS ready FROM {d.table(EXAMPLES)} GROUP BY wisdom_entry_id)
SELECT book_title, count(*) AS n_entries, {d.big('sum(distilled)')} AS n_distilled, {d.big('coalesce(sum(n), 0)')} AS n_examples, {d.big("coalesce(sum(CASE WHEN principle_status = 'approved' THEN ready ELSE 0 END), 0)")} AS n_exportable FROM e LEFT JOIN x ON id = entry GROUP BY book_title"""


def excess_duplicates(d):
    return f"SELECT {d.big('sum(n - 1)')} AS excess, count(*) AS n_groups FROM (SELECT count(*) AS n FROM {d.table(EXAMPLES)} WHERE {A} IS NOT NULL GROUP BY md5({X.norm_d(d, A)})) q"


def duplicate_group_counts(d):
    return " UNION ALL ".join(f"SELECT '{c}' AS field, count(*) AS n_distinct, {d.count_if('n > 1')} AS n_duplicate_groups FROM (SELECT count(*) AS n FROM {d.table(EXAMPLES)} WHERE {c} IS NOT NULL GROUP BY md5({X.norm_c(d, c)})) q" for c in ("user_problem", A))


def avg_length(d):
    return f"SELECT tone, avg({d.dbl(d.size(X.tokens(d, A)))}) AS mean_words, count(*) AS n FROM {d.table(EXAMPLES)} WHERE {A} IS NOT NULL GROUP BY tone"


def phrase_doc_freq(d):
    """Documents that hold each phrase: one pass, one row a phrase."""
    sums = ", ".join(f"{d.count_if(f'contains(low, {d.lit(p)})')} AS p{i}" for i, p in enumerate(V.SCAFFOLD))
    rows = " UNION ALL ".join(f"SELECT {d.lit(p)} AS phrase, p{i} AS n FROM s" for i, p in enumerate(V.SCAFFOLD))
    return f"WITH s AS (SELECT {sums} FROM (SELECT lower({A}) AS low FROM {d.table(EXAMPLES)} WHERE {A} IS NOT NULL) q) {rows}"


def page_entries(d):
    return f"SELECT id, book_title FROM {entries(d)} ORDER BY id LIMIT 50 OFFSET 100"


def lowest_scores(d):
    return f"SELECT id, confidence_score FROM {entries(d)} ORDER BY coalesce(confidence_score, 9999.0), id LIMIT 10"


def sample_k(d):
    return f"SELECT id, md5(concat(CAST(id AS {'STRING' if d.name == 'spark' else 'VARCHAR'}), '42')) AS k FROM {d.table(EXAMPLES)} ORDER BY k, id LIMIT 30"


def latest_source(d):
    return f"SELECT id, title FROM {d.table('source_documents')} WHERE created_at IS NOT NULL GROUP BY id, title, created_at ORDER BY created_at DESC, id DESC LIMIT 1"


def topk_per_source(d):
    return f"SELECT source_document_id, id, {d.big('place')} AS place FROM (SELECT source_document_id, id, row_number() OVER (PARTITION BY source_document_id ORDER BY confidence_score DESC NULLS LAST, id) AS place FROM {entries(d)}) q WHERE place <= 3"


# de-duplication

def dedup_exact(d):
    """First row of each equal prompt and answer, compared by hash and kept by id: an aggregate, not a sort."""
    return f"SELECT min(id) AS id, count(*) AS n_copies FROM {d.table(EXAMPLES)} GROUP BY md5(concat(coalesce(user_problem, ''), chr(1), coalesce({A}, '')))"


def best_per_key(d):
    """The best entry of each distilled sentence by (tags, quality, confidence), ties to the first."""
    n_tags = f"coalesce({d.size('emotional_tags')}, 0) + coalesce({d.size('philosophical_tags')}, 0)"
    return f"""SELECT source_document_id, id FROM (SELECT source_document_id, id, row_number() OVER (PARTITION BY md5({X.norm_d(d, 'distilled_wisdom')}) ORDER BY {n_tags} DESC, coalesce(principle_quality_score, 0.0) DESC, coalesce(confidence_score, 0.0) DESC, id) AS place
FROM {entries(d)} WHERE distilled_wisdom IS NOT NULL AND trim(distilled_wisdom) <> '') q WHERE place = 1"""


def merged(d: Dialect) -> str:
    role = lambda r: d.el(d.filt("messages", "m", f"m.role = '{r}'"), 1) + ".content" if d.name == "spark" else f"({d.el(d.filt('messages', 'm', f'm.role = ' + d.lit(r)), 1)}).content"
    return f"""SELECT 'training_examples' AS origin, id AS ordinal, user_problem AS prompt, {A} AS answer FROM {d.table(EXAMPLES)}
UNION ALL SELECT 'chat_records' AS origin, record_id AS ordinal, {role('user')} AS prompt, {role('assistant')} AS answer FROM {d.table('chat_records')}"""


def merge_union(d):
    return f"SELECT origin, ordinal, md5(concat(coalesce(prompt, ''), chr(1), coalesce(answer, ''))) AS k FROM ({merged(d)}) q"


def removed_records(d):
    """All rows of the merged sets but the first of each equal pair: what is not the smallest (origin, ordinal) of its key."""
    same = "md5(concat(coalesce(prompt, ''), chr(1), coalesce(answer, '')))"
    first = "min(struct(origin, ordinal))" if d.name == "spark" else "min(struct_pack(origin := origin, ordinal := ordinal))"
    return f"""WITH m AS (SELECT origin, ordinal, {same} AS k FROM ({merged(d)}) q), g AS (SELECT k AS gk, {first} AS w FROM m GROUP BY k HAVING count(*) > 1)
SELECT origin, ordinal FROM m JOIN g ON k = gk WHERE origin <> w.origin OR ordinal <> w.ordinal"""


QUERIES = {f.__name__: f for f in (doc_lookup, gate_entries, gate_source_pool, tag_search, tag_buckets, export_gate, approval_gate, join_examples_entries, anti_existing, semi_reviewed, left_attach, review_upsert, count_by_source, per_source_counts, quality_report, status_histogram, source_status_pivot, issue_counts, tag_distribution, top_openings, dup_fingerprint_groups, dup_fingerprint_members, flag_counts, excess_duplicates, duplicate_group_counts, avg_length, phrase_doc_freq, page_entries, lowest_scores, sample_k, latest_source, topk_per_source, dedup_exact, best_per_key, merge_union, removed_records)}
