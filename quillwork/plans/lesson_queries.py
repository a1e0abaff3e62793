"""From verses to lessons: tags by three vocabularies, entries, teaching texts, scenario families; and the cleanup of answers.

All of it is row-local: one projection over one scan, in steps that each bind what the next one reads.
"""

from __future__ import annotations

from quillwork.functions import packs as P
from quillwork.functions import text as X
from quillwork.functions import vocabularies as W
from quillwork.plans.base import current
from quillwork.plans.dialect import Dialect
from quillwork.plans.pack_queries import usable

A = "assistant_response"

# Own wording: banks and replacements of the cleanup.
BRIDGES = ["Seen from there, the next step needs less force.", "This leaves room for a quieter answer.", "From here the matter asks for less haste.", "It is easier to stay honest with that in mind.", "With this the pressure loses its hurry.", "That leaves the hands free for one plain step.", "So the day can be met one thing at a time.", "That makes a slower answer possible."]
CLOSERS = ["Keep the step small enough to repeat.", "Let the step count more than how it feels.", "Nothing about it needs to be dramatic.", "Do it once today and leave the rest.", "A plain try is worth more than a perfect plan.", "Let it be practice and not a test."]
GENERIC_CLOSERS = ["you only need enough honesty for the next step.", "small sincere steps restore clarity.", "steadiness returns through practice."]
REPLACED = {"it turns reflection into something you can live today": "Let the thought become something you do.", "it helps action grow cleaner": "It gives the next step a clearer direction.", "that is often the turning point": "There the steadier steps begin."}


def word(d: Dialect, e: str, alternatives: str) -> str:
    return d.rx(e, P.words(alternatives))


def joined(d: Dialect, *parts: str) -> str:
    return "lower(concat_ws(' ', " + ", ".join(f"nullif({X.clean_text(d, p)}, '')" for p in parts) + "))"


def uses(d: Dialect, pack: W.Tags, emotional: str, philosophical: str) -> str:
    named = [f"CASE WHEN {d.has(emotional, d.lit(t))} THEN {d.lit(u)} END" for t, u in pack.uses.items()]
    more = [f"CASE WHEN {d.has(philosophical, d.lit(t))} THEN {d.lit(u)} END" for t, u in pack.extra_uses.items()]
    found = d.compact(named + more)  # the uses of a pack are distinct
    return f"CASE WHEN {d.size(found)} = 0 THEN {d.strings([pack.default_use])} ELSE {found} END"


def tagged(d: Dialect, pack: W.Tags, source: str) -> str:
    """id, low and more of source with emotional and philosophical tags, then use cases."""
    inner = f"SELECT *, {X.tags_of(d, 'low', pack.emotional)} AS emotional, {X.tags_of(d, 'low', pack.philosophical)} AS philosophical FROM ({source}) s0"
    return f"SELECT *, {uses(d, pack, 'emotional', 'philosophical')} AS uses FROM ({inner}) s1"


def _tag_columns(d: Dialect) -> str:
    return f"{d.join('emotional', '|')} AS emotional, {d.join('philosophical', '|')} AS philosophical, {d.join('uses', '|')} AS use_cases"


def _keyword_tags(pack: W.Tags):
    def query(d):
        source = f"SELECT id, {joined(d, 'translation', 'commentary', 'extracted_principle')} AS low FROM {current(d, 'wisdom_entries')} e"
        return f"SELECT id, {_tag_columns(d)} FROM ({tagged(d, pack, source)}) t"

    return query


def use_cases(d):
    source = f"SELECT id, {joined(d, 'translation', 'commentary', 'extracted_principle')} AS low FROM {current(d, 'wisdom_entries')} e"
    return f"SELECT id, {d.join('uses', '|')} AS use_cases FROM ({tagged(d, W.VERSES, source)}) t"


def extract_entries(d):
    """Usable verses as entries: first sentence of the first text that is not blank, tags and uses."""
    first = f"coalesce({X.first_sentence(d, 'english_translation')}, {X.first_sentence(d, 'commentary')})"
    source = f"SELECT id, p, {joined(d, 'english_translation', 'commentary', 'p')} AS low FROM (SELECT id, english_translation, commentary, {first} AS p FROM {current(d, 'canonical_verses')} v WHERE {usable(d)}) q"
    return f"SELECT id, p AS principle, {_tag_columns(d)}, {d.dbl('70')} AS confidence FROM ({tagged(d, W.VERSES, source)}) t"


def extract_passages(d):
    """Valid passages as entries: first sentence that is neither corrupt nor boilerplate, tags of the second vocabulary."""
    suspicious = d.rx("s", r"(?i)^(om($|[^\p{L}\p{N}_])|here ends($|[^\p{L}\p{N}_])|translated by($|[^\p{L}\p{N}_])|published by($|[^\p{L}\p{N}_]))")
    clean = d.el(d.filt(X.sentence_list(d, X.clean_text(d, "english_translation")), "s", f"NOT {d.rx('s', '[{}@ïÌœ]|H¥|�')} AND NOT {suspicious}"), 1)
    source = f"SELECT id, p, {joined(d, 'english_translation', 'commentary', 'p')} AS low FROM (SELECT id, english_translation, commentary, {d.trim(clean)} AS p FROM {current(d, 'canonical_verses')} v WHERE is_valid) q"
    return f"SELECT id, p AS principle, {_tag_columns(d)}, {d.dbl('70')} AS confidence FROM ({tagged(d, W.PASSAGES, source)}) t"


def selected(d: Dialect) -> str:
    """id, texts and p: the first of the distinct sentences of translation and commentary, vocative off, that has ten words and is no narration, not corrupt and no announcement."""
    of = lambda t: f"coalesce({d.sentences(t)}, {d.array([])})"
    bare = d.trans(d.cat(of("translation"), of("commentary")), "s", d.trim(d.sub(X.clean_text(d, "s"), r"(?i)^o [a-z-]+[!,]?\s+", "")))
    reject = " OR ".join([f"{d.size(X.tokens(d, 's'))} < 10", d.rx("s", r"(?i)^(arjuna said|sanjaya said|krishna said|dhrutarashtra said|the lord said)($|[^\p{L}\p{N}_])"), d.rx("lower(s)", P.AUDIT_CORRUPTION), d.rx("s", "(?i)said[:.]$")])
    inner = f"SELECT *, {bare} AS candidates FROM {current(d, 'wisdom_entries')} e"
    return f"SELECT *, {d.el(d.filt('candidates', 's', f'NOT ({reject})'), 1)} AS p FROM ({inner}) c"


def select_principle(d):
    return f"SELECT id, p AS principle FROM ({selected(d)}) q"


def refined(d: Dialect) -> str:
    source = f"SELECT *, {joined(d, 'translation', 'commentary', 'p')} AS low FROM ({selected(d)}) q"
    score = f"60.0 + CASE WHEN p IS NOT NULL THEN 10.0 ELSE 0.0 END + CASE WHEN {X.clean_or_null(d, 'commentary')} IS NOT NULL THEN 5.0 ELSE 0.0 END + CASE WHEN {d.size('emotional')} > 0 THEN 7.5 ELSE 0.0 END + CASE WHEN {d.size('philosophical')} > 0 THEN 7.5 ELSE 0.0 END"
    return f"SELECT *, {d.dbl(f'least(95.0, {score})')} AS c FROM ({tagged(d, W.PRINCIPLES, source)}) t"


def confidence(d):
    return f"SELECT id, c AS confidence FROM ({refined(d)}) r"


def refine_entries(d):
    """A found principle renews principle, tags, uses and confidence; without one the row stays as it is."""
    keep = lambda new, old: f"CASE WHEN p IS NULL THEN {old} ELSE {new} END"
    tags = ", ".join(f"{keep(d.join(new, '|'), d.join(old, '|'))} AS {old}" for new, old in (("emotional", "emotional_tags"), ("philosophical", "philosophical_tags"), ("uses", "use_cases")))
    return f"SELECT id, coalesce(p, extracted_principle) AS principle, {tags}, {keep('c', 'confidence_score')} AS confidence FROM ({refined(d)}) r"


def taught(d: Dialect, t: str) -> str:
    """A teaching text without set phrases and with one full stop; null if it is blank, too short, or bound to a scripture."""
    bad = lambda e: f"{word(d, e, W.TEACHING_FORBIDDEN)} OR {word(d, e, W.TEACHING_FALLBACK)}"
    clean = X.clean_text(d, t)
    bare = clean
    for phrase in W.TEACHING_PHRASES:
        bare = f"replace({bare}, {d.lit(phrase)}, '')"
    bare = f"coalesce(nullif({d.sub(X.clean_text(d, bare), r'^[ ,.]+|[ ,.]+$', '')}, ''), {clean})"
    return f"CASE WHEN {clean} IS NULL OR {clean} = '' OR {bad(clean)} OR {d.rx(clean, r'[\x{0900}-\x{097F}]')} OR {d.size(X.tokens(d, clean))} < 5 OR {bad(bare)} THEN NULL ELSE concat({d.sub(bare, '[.]+$', '')}, '.') END"


def teaching_text(d):
    """The distilled sentence, or the principle of an approved entry, made fit to teach from; and whether examples may be made of it."""
    text = f"coalesce({taught(d, 'distilled_wisdom')}, CASE WHEN principle_status = 'approved' THEN {taught(d, 'extracted_principle')} END)"
    return f"SELECT id, teaching, coalesce(principle_status = 'approved' AND confidence_score >= 80 AND teaching IS NOT NULL, false) AS eligible FROM (SELECT id, principle_status, confidence_score, {text} AS teaching FROM {current(d, 'wisdom_entries')} e) q"


def example_eligibility(d):
    return f"SELECT id, eligible FROM ({teaching_text(d)}) t"


def scenario_families(d):
    """Four families of each entry: 3 x shared ideas + 2 x shared feelings + bonuses, by (score, name) downwards, filled up with fallbacks."""
    norm = lambda c: d.trans(f"coalesce({c}, {d.array([])})", "g", "replace(lower(trim(g)), '-', '_')")
    title = "lower(coalesce(book_title, ''))"
    bonus = {"career": f"CASE WHEN contains({title}, 'gita') THEN 2 ELSE 0 END", "purpose": f"CASE WHEN {d.isin(title, ['kena', 'katha', 'mundaka'])} THEN 2 ELSE 0 END", "inner_conflict": "1"}
    distinct = "array_distinct" if d.name == "spark" else "list_distinct"
    score = lambda f, ph, em: f"3 * {d.size(d.filt('tags', 'x', d.isin('x', ph)))} + 2 * {d.size(d.filt('tags', 'x', d.isin('x', em)))} + {bonus.get(f, '0')}"
    # a family sorts by its score, then by its name downwards: one array of (score, name) sorted downwards
    cells = [f"concat(CAST(100 + {score(f, ph, em)} AS {'STRING' if d.name == 'spark' else 'VARCHAR'}), {d.lit(f)})" for f, (ph, em) in W.FAMILIES.items()]
    ordered = f"sort_array({d.array(cells)}, false)" if d.name == "spark" else f"list_reverse_sort({d.array(cells)})"
    named = d.trans(d.filt(ordered, "c", "substr(c, 1, 3) <> '100'"), "c", "substr(c, 4)")
    both = d.cat(d.slice(named, 1, 4), d.strings(W.FALLBACK_FAMILIES))
    chosen = d.slice(f"array_distinct({both})", 1, 4) if d.name == "spark" else d.slice(d.ordered_distinct("both_lists"), 1, 4)
    tags = f"SELECT id, book_title, {distinct}({d.cat(norm('emotional_tags'), norm('philosophical_tags'))}) AS tags FROM {current(d, 'wisdom_entries')} e"
    if d.name != "spark":
        tags = f"SELECT *, {both} AS both_lists FROM ({tags}) t0"
    return f"SELECT id, {d.join('four', '|')} AS families FROM (SELECT id, {chosen} AS four FROM ({tags}) t) q"


# answers

def turned_sentences(d: Dialect, t: str) -> str:
    """Sentences of a text whose semicolons are full stops."""
    return d.nonblank(d.sentences(d.sub(d.sub(X.clean_text(d, t), "; ", ". "), ";", ".")))


def cleanup_steps(d: Dialect, source: str) -> str:
    """id, text: the cleaned answer of each row of source (id, u, a)."""
    n = lambda s: d.size(X.word_tokens(d, s))
    pick = lambda bank, salt: d.el(d.strings(bank), f"({d.hash8('concat(seed, ' + d.lit(salt) + ')')} % {len(bank)}) + 1")
    once = lambda e, old, new: d.sub(e, rf"(?s)^(.*?)(^|[^\p{{L}}\p{{N}}_]){old}($|[^\p{{L}}\p{{N}}_])", "{1}{2}" + new + "{3}")
    low = "lower(s)"
    cases = [
        f"WHEN {word(d, low, W.CLEANUP_SCRIPTURE)} THEN NULL",
        f"WHEN contains({low}, 'that matters because') OR {' OR '.join(f'{low} LIKE {d.lit(x + chr(37))}' for x in W.CLEANUP_STARTS)} THEN bridge",
        *[f"WHEN contains({low}, {d.lit(old)}) THEN {d.lit(new)}" for old, new in REPLACED.items()],
    ]
    rewritten = f"CASE {' '.join(cases)} ELSE {once(once('s', 'That is', 'This is'), 'It helps', 'This helps')} END"
    plain = lambda v: X.clean_text(d, d.sub(f"lower({v})", r"[^\p{L}\p{N}_\s]", ""))
    generic = lambda v: d.isin(f"lower({v})", GENERIC_CLOSERS)
    s = f"SELECT id, concat(u, '::', a) AS seed, {turned_sentences(d, 'a')} AS s0 FROM ({source}) q0"
    s = f"SELECT *, {pick(BRIDGES, '::bridge')} AS bridge, {pick(CLOSERS, '::closer')} AS closer FROM ({s}) q1"
    s = f"SELECT id, closer, {d.filt(d.trans('s0', 's', rewritten), 'v', 'v IS NOT NULL')} AS s1 FROM ({s}) q2"
    s = f"SELECT *, {d.trans('s1', 'v', plain('v'))} AS k1, {d.trans('s1', 'v', f'CASE WHEN {generic("v")} THEN 1 ELSE 0 END')} AS g1 FROM ({s}) q3"
    first = f"{d.position('k1', d.el('k1', 'j'))} = j AND {d.el('k1', 'j')} <> '' AND ({d.el('g1', 'j')} = 0 OR {d.position('g1', '1')} = j)"
    s = f"SELECT id, closer, {d.filti('s1', 'v', 'j', first)} AS s2 FROM ({s}) q4"
    hinted = d.filt("s2", "v", d.any_of("lower(v)", W.CLEANUP_HINTS))
    s = f"SELECT *, {d.el(hinted, d.size(hinted))} AS act FROM ({s}) q5"
    s = f"SELECT id, closer, CASE WHEN act IS NULL THEN s2 ELSE {d.cat(d.filt('s2', 'v', 'v <> act'), d.array(['act']))} END AS s3 FROM ({s}) q6"
    s = f"SELECT *, {X.clean_text(d, d.join('s3', ' '))} AS t3 FROM ({s}) q7"
    known = d.exists("s3", "v", f"{plain('v')} = {plain('closer')}")
    s = f"SELECT id, CASE WHEN {n('t3')} < 80 AND NOT {known} THEN trim(concat(t3, ' ', closer)) ELSE t3 END AS t4 FROM ({s}) q8"
    # too long: closing commonplaces beyond 140 words go, then sentences before the last one until 150 words are left, three at least
    s = f"SELECT *, {n('t4')} AS n4, {turned_sentences(d, 't4')} AS s5 FROM ({s}) q9"
    s = f"SELECT *, {d.trans('s5', 'v', n('v'))} AS w5 FROM ({s}) q10"
    upto = lambda w, j: d.reduce(d.slice(w, "1", j), d.big("0"), "x", "y", "x + y")
    s = f"SELECT id, n4, t4, {d.filti('s5', 'v', 'j', f'NOT ({generic("v")} AND {upto("w5", "j")} > 140)')} AS s6 FROM ({s}) q11"
    s = f"SELECT *, {d.trans('s6', 'v', n('v'))} AS w6, {d.size('s6')} AS m FROM ({s}) q12"
    s = f"SELECT *, {upto('w6', 'm')} AS n6, {d.el('w6', 'm')} AS n_last FROM ({s}) q13"
    fits = f"j = m OR j <= 2 OR {upto('w6', 'j')} + n_last <= 150"
    s = f"SELECT id, n4, t4, s6, CASE WHEN n6 > 150 AND m > 3 THEN {d.filti('s6', 'v', 'j', fits)} ELSE s6 END AS s7 FROM ({s}) q14"
    return f"SELECT id, CASE WHEN n4 > 150 THEN {d.join('s7', ' ')} ELSE t4 END AS text FROM ({s}) q15"


def answers_of(d: Dialect) -> str:
    return f"SELECT id, coalesce(user_problem, '') AS u, {A} AS a FROM {d.table('training_examples')} WHERE {A} IS NOT NULL"


def cleanup_response(d):
    return f"SELECT id, md5(text) AS cleaned_md5, {d.size(X.word_tokens(d, 'text'))} AS n_words FROM ({cleanup_steps(d, answers_of(d))}) c"


def tidied(d: Dialect, t: str) -> str:
    """Blanks collapsed, double full stops single, none before a closing mark."""
    return d.sub(f"replace({X.clean_text(d, t)}, '..', '.')", r"\s+([,.!?])", "{1}")


def punctuation_tidy(d):
    return f"SELECT id, md5({tidied(d, A)}) AS tidy_md5 FROM {d.table('training_examples')} WHERE {A} IS NOT NULL"


# Own wording: (words of the prompt, sentence) in order, the last one for all others.
CHOICES = {
    "question": [(["relationship", "person"], "Which answer will still seem fair when the heat is gone?"), (["work", "career"], "Which step stays right whatever comes of it?"), ([], "What can be done before all is certain?")],
    "metaphor": [(["change", "fear"], "A needle near iron still knows its north."), (["discipline", "habit"], "A path is made by the feet that return to it."), ([], "Stirred water clears when it is left alone.")],
    "dialogue": [(["comfort"], "One voice asks for rest, another for what is right."), (["fear"], "One voice guards you, another knows the way."), ([], "Two voices speak; the slower one is worth hearing.")],
    "filter": [(["work", "career"], "Ask which choice is honest even if it soothes nothing."), ([], "Ask what stays true when the hurry is over.")],
    "habit": [(["discipline", "habit"], "Look for the place where the old way begins."), ([], "A pattern yields early or not at all.")],
    "letting_go": [(["relationship"], "The other's answer is not yours to hold."), ([], "The outcome was never wholly yours.")],
}
OPENING_FRAGMENTS = [(["fear", "grief", "death"], "Fear is not the whole of it."), (["attachment", "desire", "detachment"], "A closed hand tires first."), (["discipline", "self_control", "restlessness"], "The steadier way is still open."), (["purpose", "self_knowledge", "non_duality", "atman", "brahman"], "There is a quieter centre below."), (["trust", "inner_steadiness"], "Certainty may come later.")]


def prompt_sentences(d):
    """Six sentences that the words of the prompt choose, and the opening fragments that the tags of its entry choose."""
    low = "lower(user_problem)"
    chosen = {k: "CASE " + " ".join(f"WHEN {d.any_of(low, words)} THEN {d.lit(s)}" for words, s in rules if words) + f" ELSE {d.lit(rules[-1][1])} END" for k, rules in CHOICES.items()}
    return f"SELECT id, {', '.join(f'{e} AS {k}' for k, e in chosen.items())} FROM {d.table('training_examples')} WHERE user_problem IS NOT NULL"


def opening_fragments(d):
    tags = d.trans(d.cat(f"coalesce(emotional_tags, {d.array([])})", f"coalesce(philosophical_tags, {d.array([])})"), "g", "replace(lower(trim(g)), '-', '_')")
    parts = d.compact([d.lit("Stay with the human side of it."), *[f"CASE WHEN {d.overlap('tags', d.strings(names))} THEN {d.lit(s)} END" for names, s in OPENING_FRAGMENTS]])
    return f"SELECT id, {d.join(parts, '|')} AS fragments FROM (SELECT id, {tags} AS tags FROM {current(d, 'wisdom_entries')} e) q"


#: Documents that may hold one scaffold phrase.
SAFE_SCAFFOLD = 50


def dataset_violations(d):
    """Every rule of the finished data set that a row breaks; a scaffold phrase in more than SAFE_SCAFFOLD rows is one for each of them."""
    n = d.size(X.word_tokens(d, A))
    low = f"lower({A})"
    rules = {
        "duplicate_user_prompt": "np > 1",
        "duplicate_assistant_response": "na > 1",
        "length_outside_target": f"{n} < 80 OR {n} > 150",
        "listicle_format": f"contains({A}, '1.') OR contains({A}, '**')",
        "semicolon_heavy": f"{d.size(d.all(A, ';'))} >= 2",
        "scaffold": d.any_of(low, P.SCAFFOLDS),
        "scripture_leakage": word(d, low, W.CLEANUP_SCRIPTURE),
        "loop_phrase": d.any_of(low, ["again again", "cold and cold"]),
        "scaffold_above_threshold": " OR ".join(f"(contains({low}, {d.lit(s)}) AND s{i} > {SAFE_SCAFFOLD})" for i, s in enumerate(P.SCAFFOLDS)),
    }
    sums = ", ".join(f"{d.count_if(f'contains(lower({A}), {d.lit(s)})')} AS s{i}" for i, s in enumerate(P.SCAFFOLDS))
    totals = ", ".join(f"(SELECT s{i} FROM df) AS s{i}" for i in range(len(P.SCAFFOLDS)))
    return f"""WITH k AS (SELECT id, {A}, md5({X.norm_c(d, 'user_problem')}) AS pk, md5({X.norm_c(d, A)}) AS ak FROM {d.table('training_examples')} WHERE {A} IS NOT NULL AND user_problem IS NOT NULL),
df AS (SELECT {sums} FROM {d.table('training_examples')} WHERE {A} IS NOT NULL AND user_problem IS NOT NULL),
p AS (SELECT pk AS p_key, count(*) AS np FROM k GROUP BY pk HAVING count(*) > 1), a AS (SELECT ak AS a_key, count(*) AS na FROM k GROUP BY ak HAVING count(*) > 1),
j AS (SELECT k.*, np, na, {totals} FROM k LEFT JOIN p ON pk = p_key LEFT JOIN a ON ak = a_key)
SELECT id, violation FROM (SELECT id, {d.explode(d.compact([f"CASE WHEN {c} THEN {d.lit(r)} END" for r, c in rules.items()]))} AS violation FROM j) q"""


QUERIES = {f.__name__: f for f in (use_cases, extract_entries, extract_passages, select_principle, confidence, refine_entries, teaching_text, example_eligibility, scenario_families, cleanup_response, punctuation_tidy, prompt_sentences, opening_fragments, dataset_violations)}
QUERIES |= {"keyword_tags": _keyword_tags(W.VERSES), "keyword_tags_passages": _keyword_tags(W.PASSAGES), "keyword_tags_principles": _keyword_tags(W.PRINCIPLES)}
