"""Corpus statistics and rule packs.

A corpus count is an aggregate by a normalised key. Only keys above their threshold are joined back, so what is
joined stays small; a key that a third of the rows share is merged before the shuffle and is one row afterwards.
"""

from __future__ import annotations

from quillwork.functions import text as X
from quillwork.functions import vocab as V
from quillwork.plans.base import current
from quillwork.plans.dialect import Dialect
from quillwork.plans.scalar_queries import entry_text

A = "assistant_response"


def audited(d: Dialect) -> str:
    """CTEs of the corpus counts: all keys of an answer go through one count."""
    patterns = d.trans(d.filt(d.trans(d.sentences(A), "v", X.norm_a(d, "v")), "v", f"{d.size(X.tokens(d, 'v'))} >= 6"), "v", "concat('s', md5(v))")
    first_words = d.join(d.slice(X.tokens(d, "norm"), 1, 40), " ")
    single = d.compact(["CASE WHEN opening <> '' THEN concat('o', md5(opening)) END", "concat('n', md5(norm))", f"CASE WHEN norm <> '' THEN concat('p', md5({first_words})) END"])
    return f"""
answers AS (SELECT id, {A} FROM {d.table('training_examples')} WHERE {A} IS NOT NULL),
forms AS (SELECT id, {A}, {X.norm_a(d, A)} AS norm, {X.opening(d, A)} AS opening FROM answers),
keys AS (SELECT id, {d.explode(d.cat(single, patterns))} AS k FROM forms),
counted AS (SELECT k, count(*) AS n FROM keys GROUP BY k)"""


def corpus_stats(d):
    kind = "CASE substr(k, 1, 1) WHEN 'o' THEN 'opening' WHEN 'n' THEN 'response' WHEN 'p' THEN 'fingerprint' ELSE 'sentence' END"
    return f"WITH {audited(d)} SELECT {kind} AS kind, substr(k, 2) AS key, n FROM counted"


def corpus_stats_b(d):
    """Counts of prompts, openings of ten words and fingerprints of 45 words."""
    p = X.norm_b(d, "user_problem")
    return f"""SELECT 'prompt' AS kind, md5({p}) AS key, count(*) AS n FROM {d.table('training_examples')} WHERE user_problem IS NOT NULL GROUP BY md5({p})
UNION ALL SELECT 'opening', md5({X.opening(d, A, 10)}), count(*) FROM {d.table('training_examples')} WHERE {A} IS NOT NULL GROUP BY md5({X.opening(d, A, 10)})
UNION ALL SELECT 'fingerprint', md5({X.fingerprint(d, A, 45, X.norm_b)}), count(*) FROM {d.table('training_examples')} WHERE {A} IS NOT NULL GROUP BY md5({X.fingerprint(d, A, 45, X.norm_b)})"""


def verse_valid(d: Dialect, t: str) -> str:
    return f"length({X.clean_text(d, t)}) >= 20 AND NOT {d.rx(t, V.CORRUPTION)} AND NOT {d.rx(t, V.HEADER)}"


def verse_validity(d):
    return f"SELECT id, {verse_valid(d, 'english_translation')} AS valid FROM {current(d, 'canonical_verses')} v WHERE english_translation IS NOT NULL"


# What a valid passage must not be, and what it must hold.
TITLE_ONLY = r"(?i)^((kena|katha|mundaka)(\s+upanishad)?|section\s+[ivx0-9]+|part\s+[ivx0-9]+|khanda\s+[ivx0-9]+)$"
SPEAKER_ONLY = r"(?i)^(death|nachiketas|teacher|student|disciple|indra|agni|vayu|brahma|the teacher|the pupil)\s+said:?\s*$"
FOOTNOTE = r"(?i)(translator'?s note|published by|cf\.|see also|sbe|vol\.|footnote)"
BIBLIOGRAPHY = r"(?i)(bibliography|index|table of contents|compiled by|copyright|printed by)"
RITUAL_ONLY = r"(?i)^(om ! peace ! peace ! peace !|here ends the .+upanishad.*)$"
PASSAGE_CORRUPTION = "[{}@ïÌœ]|H¥|�|Translaetd"
TEACHING_MARKERS = "self brahman know wisdom immortal mind truth desire death teach knowledge wise realize attain".split()


def passage_validity(d):
    """Whether translation and commentary of a passage can be taught from."""
    text = "trim(concat_ws(' ', nullif(english_translation, ''), nullif(commentary, '')))"
    bad = " OR ".join(d.rx("t", p) for p in (TITLE_ONLY, SPEAKER_ONLY, FOOTNOTE, BIBLIOGRAPHY, RITUAL_ONLY, PASSAGE_CORRUPTION))
    words = d.size(d.all("t", "[A-Za-z][A-Za-z'-]+"))
    return f"SELECT id, length(t) >= 60 AND NOT ({bad}) AND {words} >= 10 AND {d.any_of('lower(t)', TEACHING_MARKERS)} AS valid FROM (SELECT id, {text} AS t FROM {current(d, 'canonical_verses')} v WHERE english_translation IS NOT NULL) q"


def usable(d: Dialect) -> str:
    t = "english_translation"
    return f"is_valid AND length({X.clean_text(d, t)}) >= 30 AND NOT {d.rx(t, V.SPEAKER)} AND NOT {d.rx(t, V.CORRUPTION)}"


def usable_units(d):
    return f"SELECT id, {d.big('length(english_translation)')} AS n_chars FROM {current(d, 'canonical_verses')} v WHERE {usable(d)}"


def response_valid(d):
    n = d.size(X.word_tokens(d, A))
    first = f"coalesce({X.first_sentence(d, A)}, '')"
    ok = f"NOT {d.rx(A, V.LISTICLE)} AND NOT {d.any_of(f'lower({A})', V.FORBIDDEN)} AND NOT {d.rx(A, r'[\x{0900}-\x{097F}]')} AND NOT contains({A}, ';') AND {n} BETWEEN 70 AND 140 AND {d.size(d.all(f'lower({first})', 'calm'))} <= 1"
    return f"SELECT id, {ok} AS valid FROM {d.table('training_examples')} WHERE {A} IS NOT NULL"


def suspicious_text(d):
    """Entries whose texts are corrupt or generic, that lack tags, or whose principle has an odd length."""
    t = "concat_ws(' ', translation, commentary, extracted_principle)"
    n = f"coalesce({d.size(X.tokens(d, 'extracted_principle'))}, 0)"
    return f"SELECT id, {d.rx(t, V.CORRUPTION)} AS corrupted, {d.rx(t, V.GENERIC)} AS generic, coalesce({d.size('emotional_tags')}, 0) = 0 OR coalesce({d.size('philosophical_tags')}, 0) = 0 AS missing_tags, {n} NOT BETWEEN 8 AND 60 AS odd_length FROM {current(d, 'wisdom_entries')} e"


def entry_corruption(d):
    return f"SELECT id, {d.rx(entry_text(d), V.CORRUPTION)} AS corrupted FROM {current(d, 'wisdom_entries')} e"


QUERIES = {f.__name__: f for f in (corpus_stats, corpus_stats_b, verse_validity, passage_validity, usable_units, response_valid, suspicious_text, entry_corruption)}
