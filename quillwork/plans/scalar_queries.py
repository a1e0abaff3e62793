"""Row-local text functions over whole tables."""

from __future__ import annotations

from quillwork.functions import text as X
from quillwork.functions import vocab as V
from quillwork.plans.base import current
from quillwork.plans.dialect import Dialect


def _docs(d: Dialect, columns: str, where: str = "text IS NOT NULL") -> str:
    return f"SELECT doc_id, {columns} FROM {d.table('documents')} WHERE {where}"


def _answers(d: Dialect, columns: str) -> str:
    return f"SELECT id, {columns} FROM {d.table('training_examples')} WHERE assistant_response IS NOT NULL"


def _entries(d: Dialect, columns: str) -> str:
    return f"SELECT id, {columns} FROM {current(d, 'wisdom_entries')} e"


def entry_text(d: Dialect) -> str:
    return "lower(concat_ws(' ', translation, commentary, extracted_principle))"


def clean_text(d):
    return _docs(d, f"md5({X.clean_text(d, 'text')}) AS cleaned_md5, {d.big(f'length({X.clean_text(d, "text")})')} AS cleaned_chars")


def blocks(d):
    return f"SELECT id, {d.size('b')} AS n_blocks, md5({d.join('b', '|')}) AS blocks_md5 FROM (SELECT id, {X.blocks(d, 'raw_text')} AS b FROM {d.table('extracted_document_texts')} WHERE raw_text IS NOT NULL GROUP BY id, raw_text) q"


def sentence_counts(d):
    return _docs(d, f"{d.size(X.sentence_list(d, 'text'))} AS n_sentences")


def normalize_variants(d):
    forms = {"a": X.norm_a, "b": X.norm_b, "c": X.norm_c, "d": X.norm_d, "e": X.norm_e, "f": X.norm_f}
    return _docs(d, ", ".join(f"md5({f(d, 'text')}) AS norm_{k}" for k, f in forms.items()))


def near_key(d):
    return _answers(d, f"{X.near_key(d, 'assistant_response')} AS near_key")


def word_counts(d):
    return _docs(d, f"{d.size(X.tokens(d, 'text'))} AS n_tokens, {d.size(X.word_tokens(d, 'text'))} AS n_words, {d.size(X.letter_tokens(d, 'text'))} AS n_letter_words")


def opening_phrase(d):
    return _answers(d, f"{X.opening(d, 'assistant_response')} AS opening_12, {X.opening(d, 'assistant_response', 10)} AS opening_10")


def fingerprint(d):
    return _answers(d, f"md5({X.fingerprint(d, 'assistant_response')}) AS fingerprint_40, md5({X.fingerprint(d, 'assistant_response', 45, X.norm_b)}) AS fingerprint_45")


def extract_refs(d):
    t = "content"
    return f"SELECT id, {d.ext(t, r'(?i)chapter\s+(\d+)')} AS chapter_ref, {d.ext(t, r'\((\d+\.\d+)\)')} AS verse_ref, {d.ext(t, r'(?i)page\s+(\d+)')} AS page_ref FROM {current(d, 'document_chunks')} c WHERE content IS NOT NULL"


def headings(d):
    first = d.el(d.split("content", r"\n"), 1)
    return f"SELECT id, {X.is_heading(d, first)} AS is_heading, {X.is_heading(d, first, 8)} AS is_short_heading FROM {current(d, 'document_chunks')} c WHERE content IS NOT NULL"


def first_sentence(d):
    return _entries(d, f"coalesce({X.first_sentence(d, 'translation')}, {X.first_sentence(d, 'commentary')}) AS first_sentence")


def first_clean_sentence(d):
    return _entries(d, f"coalesce({d.el(X.clean_sentences(d, 'translation'), 1)}, {d.el(X.clean_sentences(d, 'commentary'), 1)}) AS first_clean_sentence")


def clean_title(d):
    t = "title"
    return f"SELECT id, coalesce(nullif({X.clean_text(d, f'replace({d.sub(t, r'[0-9a-f]{12,}', '')}, {d.lit('_')}, {d.lit(' ')})')}, ''), 'Untitled') AS clean_title FROM {d.table('source_documents')} GROUP BY id, title"


def diacritics(d):
    return f"SELECT id, {d.rx('transliteration', V.DIACRITICS)} AS has_diacritics, {d.rx('sanskrit_text', r'[\x{0900}-\x{097F}]')} AS has_devanagari FROM {current(d, 'canonical_verses')} v"


def scenario(d: Dialect, tags: str) -> str:
    return "CASE " + " ".join(f"WHEN {d.overlap(tags, d.strings(group))} THEN {d.lit(name)}" for name, group in V.SCENARIOS) + " ELSE 'general' END"


def scenario_type(d):
    return f"SELECT id, {scenario(d, 't')} AS scenario_type FROM (SELECT id, {X.tags_of(d, entry_text(d), V.EMOTIONAL)} AS t FROM {current(d, 'wisdom_entries')} e) q"


def theme(d):
    tags = X.tags_of(d, "lower(user_problem)", V.EMOTIONAL)
    return f"SELECT id, {scenario(d, 't')} AS theme FROM (SELECT id, {tags} AS t FROM {d.table('training_examples')} WHERE user_problem IS NOT NULL) q"


#: Own wording: what is added to an answer of fewer than 80 words.
PADDING = "Keep to one small step, since calm comes after it and seldom before."


def length_fit(d):
    """Answers of 80 to 140 words: a short one gets a sentence more, a long one keeps whole sentences from the front, a first sentence that is too long is cut by words."""
    n = lambda e: d.size(X.tokens(d, e))
    padded = f"CASE WHEN {n('assistant_response')} < 80 THEN concat(assistant_response, ' ', {d.lit(PADDING)}) ELSE assistant_response END"
    s = f"SELECT id, {padded} AS t FROM {d.table('training_examples')} WHERE assistant_response IS NOT NULL"
    s = f"SELECT id, t, {n('t')} AS n, {X.sentence_list(d, 't')} AS ss FROM ({s}) q0"
    s = f"SELECT *, {d.trans('ss', 'v', n('v'))} AS ws FROM ({s}) q1"
    upto = d.reduce(d.slice("ws", "1", "j"), d.big("0"), "x", "y", "x + y")
    kept = d.join(d.trans(d.filti("ss", "v", "j", f"j = 1 OR {upto} <= 140"), "v", "trim(v)"), " ")
    cut_first = f"concat({d.sub(d.join(d.slice(X.tokens(d, d.el('ss', 1)), 1, 140), ' '), '[,;:]+$', '')}, '.')"
    fitted = f"CASE WHEN n <= 140 THEN t WHEN {d.el('ws', 1)} > 140 THEN {cut_first} ELSE {kept} END"
    return f"SELECT id, md5(fitted) AS fitted_md5, {n('fitted')} AS n_words FROM (SELECT id, {fitted} AS fitted FROM ({s}) q2) q3"


def dedup_sentences(d):
    """Sentences of which an earlier one has no equal normal form; and, beside it, those that do not repeat the one before."""
    s = f"SELECT id, {X.sentence_list(d, X.clean_text(d, 'assistant_response'))} AS ss FROM {d.table('training_examples')} WHERE assistant_response IS NOT NULL"
    s = f"SELECT *, {d.trans('ss', 'v', X.norm_c(d, 'v'))} AS ks FROM ({s}) q"
    distinct = d.join(d.filti("ss", "v", "j", f"{d.position('ks', d.el('ks', 'j'))} = j"), " ")
    adjacent = d.join(d.filti("ss", "v", "j", f"j = 1 OR v <> {d.el('ss', 'j - 1')}"), " ")
    return f"SELECT id, md5({distinct}) AS distinct_md5, md5({adjacent}) AS adjacent_md5, {d.size('ss')} AS n_sentences FROM ({s}) r"


def stable_bucket(d):
    return _answers(d, f"{d.hash8('assistant_response')} % 7 AS bucket")


def char_seed(d):
    return f"SELECT id, {X.char_seed(d, 'title', False)} AS plain_seed, {X.char_seed(d, 'title')} AS weighted_seed FROM {d.table('source_documents')} WHERE title IS NOT NULL GROUP BY id, title"


def rotate_pick(d):
    return f"SELECT id, {X.rotate(d, X.char_seed(d, 'title'), V.CLOSERS)} AS closer FROM {d.table('source_documents')} WHERE title IS NOT NULL GROUP BY id, title"


def ngram_repetition(d):
    return f"SELECT id, {d.big(X.trigram_repetition(d, 'w'))} AS repeated FROM (SELECT id, {X.letter_tokens(d, 'assistant_response')} AS w FROM {d.table('training_examples')} WHERE assistant_response IS NOT NULL) q"


def listicle(d):
    return _answers(d, f"{d.rx('assistant_response', V.LISTICLE)} AS is_list, {d.rx('assistant_response', r'(?m)^\s*\d+\.\s')} OR contains(assistant_response, '**') AS is_numbered, {d.rx('assistant_response', r'(^|\n)\s*(\d+\.|- )')} AS is_dashed")


def sentence_case(d):
    return _answers(d, f"md5({X.sentence_case(d, 'lower(assistant_response)')}) AS cased_md5")


def phrase_replace(d):
    return _answers(d, f"md5({X.phrase_replace(d, 'assistant_response')}) AS replaced_md5")


def lookup_word(d):
    look = lambda tags, table, other: "CASE " + " ".join(f"WHEN {d.has(tags, d.lit(k))} THEN {d.lit(v)}" for k, v in table.items()) + f" ELSE {d.lit(other)} END"
    first = f"coalesce({d.el('emotional_tags', 1)}, 'uncertainty')"
    return _entries(d, f"{look('emotional_tags', V.EMOTION_WORDS, 'strain')} AS emotion_word, {first} AS main_emotion, {look('philosophical_tags', V.FOCUS_WORDS, 'attention')} AS focus_word, {look('philosophical_tags', V.ACTION_FAMILIES, 'pause')} AS action_family")


def prompt_candidates(d):
    """Twelve candidates a wisdom entry from template, context and tail with different strides, distinct in order by normal form."""
    pick = lambda bank, stride: d.el(d.strings(bank), f"{d.pmod(f's + k * {stride}', len(bank))} + 1")
    subject = "coalesce(nullif(lower(trim(section)), ''), 'this')"
    text = f"concat(replace({pick(V.TEMPLATES, 1)}, '{{x}}', {subject}), ' ', {pick(V.CONTEXTS, 3)}, ' ', {pick(V.TAILS, 7)})"
    return f"""
WITH g AS (SELECT id, section, {d.hash8('concat(id, coalesce(book_title, ' + d.lit('') + '))')} % 1000 AS s, {d.explode(d.seq('0', '11'))} AS k FROM {current(d, 'wisdom_entries')} e),
c AS (SELECT id, k, {text} AS prompt FROM g),
n AS (SELECT id, k, prompt, row_number() OVER (PARTITION BY id, {X.norm_d(d, 'prompt')} ORDER BY k) AS copy FROM c)
SELECT id, {d.big('k')} AS k, prompt FROM n WHERE copy = 1"""


def tag_normalised(d):
    norm = d.trans("emotional_tags", "g", "replace(lower(trim(g)), '-', '_')")
    return _entries(d, f"{d.join(norm, '|')} AS tags")


QUERIES = {f.__name__: f for f in (clean_text, blocks, sentence_counts, normalize_variants, near_key, word_counts, opening_phrase, fingerprint, extract_refs, headings, first_sentence, first_clean_sentence, clean_title, diacritics, scenario_type, theme, length_fit, dedup_sentences, stable_bucket, char_seed, rotate_pick, ngram_repetition, listicle, sentence_case, phrase_replace, lookup_word, prompt_candidates, tag_normalised)}
