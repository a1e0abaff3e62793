"""SQL for DuckDB that checks the curation queries; written by hand from the rules, not from the Spark expressions."""

from __future__ import annotations

# Shared beginnings. W is what parts words: anything but letters, digits and the low line.
_PAIRS = r"""
pairs AS (SELECT id, user_problem AS u, assistant_response AS a, lower(user_problem) AS ul, lower(assistant_response) AS al FROM training_examples WHERE user_problem IS NOT NULL AND assistant_response IS NOT NULL),
prompts AS (
  SELECT id, u,
    greatest(0, least(100, 100
      - 15 * (len(uw) < 8)::INT
      - 10 * (len(uw) > 26)::INT
      - 8 * (contains(ul, ' and ') AND len(string_split(u, ',')) > 2)::INT
      - 8 * (len(list_distinct(list_filter(string_split(uk, ' '), lambda x: x <> ''))) < greatest(4, len(uw) // 3))::INT
      + 5 * regexp_matches(ul, '(^|[^\p{L}\p{N}_])(confused|fear|afraid|restless|discipline|trust|grief|uncertain|angry|jealous|overwhelmed|career|purpose|change|clarity|action)($|[^\p{L}\p{N}_])')::INT))::BIGINT AS prompt
  FROM (SELECT id, u, ul, regexp_extract_all(u, '[\p{L}\p{N}_][\p{L}\p{N}_'']*') AS uw, trim(regexp_replace(regexp_replace(lower(trim(regexp_replace(u, '\s+', ' ', 'g'))), '[^\p{L}\p{N}_\s]', '', 'g'), '\s+', ' ', 'g')) AS uk FROM pairs) q),
parts AS (
  SELECT id, a, al, len(regexp_extract_all(a, '[\p{L}\p{N}_][\p{L}\p{N}_'']*')) AS n, len(string_split(a, ';')) - 1 AS semis,
    list_filter(string_split(regexp_replace(trim(regexp_replace(a, '\s+', ' ', 'g')), '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda s: trim(s) <> '') AS ss
  FROM pairs),
sentence_counts AS (
  SELECT id, count(*) - count(DISTINCT k) AS same_sentence, count(*) - count(DISTINCT stem) AS same_stem FROM (
    SELECT id, trim(regexp_replace(regexp_replace(lower(s), '[^\p{L}\p{N}_\s]', '', 'g'), '\s+', ' ', 'g')) AS k, array_to_string(regexp_extract_all(lower(s), '[\p{L}\p{N}_][\p{L}\p{N}_'']*')[1:6], ' ') AS stem
    FROM (SELECT id, unnest(ss) AS s FROM parts) q) r GROUP BY id),
facts AS (
  SELECT p.id, a, al, n, semis, coalesce(same_sentence, 0) AS same_sentence, coalesce(same_stem, 0) AS same_stem,
    len(string_split(al, 'a calmer response is often')) - 1 AS k1, len(string_split(al, 'that matters because')) - 1 AS k2, len(string_split(al, 'it turns reflection into something you can live today')) - 1 AS k3,
    len(string_split(al, 'that is often the turning point')) - 1 AS k4, len(string_split(al, 'it helps action grow cleaner')) - 1 AS k5,
    len(regexp_extract_all(regexp_replace(al, '[^\p{L}\p{N}_ ]', ' . ', 'g'), '\bthat is\b')) AS that_is, len(regexp_extract_all(regexp_replace(al, '[^\p{L}\p{N}_ ]', ' . ', 'g'), '\bit helps\b')) AS it_helps,
    regexp_matches(a, '(?m)^\s*\d+\.\s') OR contains(a, '**') AS listed,
    len(list_filter(['gita', 'upanishad', 'chapter ', 'passage ', 'verse ', 'krishna', 'arjuna', 'kena', 'katha', 'mundaka'], lambda x: contains(al, x))) > 0 AS leak,
    len(list_filter(['you are not alone', 'personal growth is a journey', 'small steps', 'stay true to yourself', 'the bigger picture'], lambda x: contains(al, x))) > 0 AS generic,
    len(list_filter(['write down', 'choose one', 'set a short timer', 'pause and ask', 'take ten quiet minutes', 'pick one small', 'name one', 'breathe slowly', 'reverse that pattern', 'meet it with one calm deliberate action', 'remove one obstacle', 'practice one act', 'choose one task', 'interrupt it early', 'take one step', 'do the next task wholeheartedly', 'complete one gentle grounding act', 'name the fear plainly', 'practice letting go', 'take one step that expresses trust', 'pick one impulse to delay', 'choose one modest discipline', 'let go of your preferred ending', 'do it at a fixed time', 'reverse that pattern today', 'return to one honest grounding statement', 'face the fact'], lambda x: contains(al, x))) AS concrete,
    regexp_matches(al, '(^|[^\p{L}\p{N}_])(pause|write|choose|set|take|name|pick|practice|remove|interrupt|breathe|return)($|[^\p{L}\p{N}_])') AS acts,
    regexp_matches(al, '(^|[^\p{L}\p{N}_])(depression|counselor|therapist|medication|diagnosis)($|[^\p{L}\p{N}_])') AS medical,
    contains(a, '??') OR contains(al, 'again again') OR contains(al, 'cold and cold') AS unstable,
    len(regexp_extract_all(al, 'stop letting [a-z]+ decide what is right for you')) >= 2 AS looped
  FROM parts p LEFT JOIN sentence_counts c ON p.id = c.id),
responses AS (
  SELECT *,
    greatest(0, least(100, 100 - 12 * (n < 80)::INT - 12 * (n > 150)::INT - CASE WHEN semis >= 4 THEN 10 WHEN semis = 3 THEN 6 ELSE 0 END - 5 * (k1 + k2 + k3 + k4 + k5) - 10 * (that_is >= 3)::INT - 8 * (it_helps >= 3)::INT
      - 18 * (same_sentence > 0)::INT - 8 * (same_stem > 0)::INT - 18 * listed::INT - 25 * leak::INT - 8 * generic::INT - 10 * (concrete = 0)::INT - 8 * (NOT acts)::INT - 20 * medical::INT - 20 * unstable::INT - 25 * looped::INT))::BIGINT AS quality,
    greatest(0, least(100, 100 - CASE WHEN semis >= 4 THEN 14 WHEN semis = 3 THEN 8 ELSE 0 END - 6 * (k1 + k2 + k3 + k4 + k5) - 12 * (that_is >= 3)::INT - 10 * (it_helps >= 3)::INT
      - 25 * (same_sentence > 0)::INT - 12 * (same_stem > 0)::INT - 25 * unstable::INT - 30 * looped::INT))::BIGINT AS repetition,
    greatest(0, least(100, 100 - CASE concrete WHEN 0 THEN 18 WHEN 1 THEN 5 ELSE -5 END - 12 * (NOT acts)::INT))::BIGINT AS actionability
  FROM facts),
finals AS (
  SELECT r.id, prompt, quality, repetition, actionability, CAST(round(0.2 * prompt + 0.4 * quality + 0.2 * repetition + 0.2 * actionability) AS BIGINT) AS final_score, u, a
  FROM responses r JOIN prompts p ON r.id = p.id),
grouped AS (
  SELECT *, trim(regexp_replace(regexp_replace(lower(trim(regexp_replace(u, '\s+', ' ', 'g'))), '[^\p{L}\p{N}_\s]', '', 'g'), '\s+', ' ', 'g')) AS uk, trim(regexp_replace(regexp_replace(lower(trim(regexp_replace(a, '\s+', ' ', 'g'))), '[^\p{L}\p{N}_\s]', '', 'g'), '\s+', ' ', 'g')) AS ak FROM finals),
nearly AS (
  SELECT *, array_to_string(list_filter(string_split(regexp_replace(regexp_replace(replace(uk, ' ', '  '), '(^| )(i  feel|i  am|i  keep|i  know|part  of  me|my  mind|how  do  i|what  should  i  do|i  want  to)( |$)', '\1\3', 'g'), '(^| )(really|very|just|still|right  now|today)( |$)', '\1\3', 'g'), ' '), lambda w: w <> '')[1:10], ' ') AS nk FROM grouped)
"""

RANK = "ORDER BY final_score DESC, quality DESC, actionability DESC, repetition DESC, id"

_PHASES = rf"""
, exact AS (SELECT *, row_number() OVER (PARTITION BY uk {RANK}) AS r1, count(*) OVER (PARTITION BY uk) AS n1 FROM nearly),
near AS (SELECT id, row_number() OVER (PARTITION BY nk {RANK}) AS r2, count(*) OVER (PARTITION BY nk) AS n2 FROM exact WHERE n1 = 1),
decided AS (SELECT e.id, final_score, CASE WHEN n1 > 1 THEN 'exact' WHEN n2 > 1 THEN 'near' ELSE 'single' END AS phase, CASE WHEN n1 > 1 THEN r1 ELSE r2 END AS place FROM exact e LEFT JOIN near n ON e.id = n.id),
verdicts AS (SELECT id, final_score, phase, CASE WHEN place > 1 THEN 'duplicate_' || phase WHEN final_score < 80 THEN 'below_final_score_threshold' ELSE 'kept' END AS verdict FROM decided)
"""

_PROMPTS_ONLY = _PAIRS.replace(" WHERE user_problem IS NOT NULL AND assistant_response IS NOT NULL", " WHERE user_problem IS NOT NULL")
_ANSWERS_ONLY = _PAIRS.replace(" WHERE user_problem IS NOT NULL AND assistant_response IS NOT NULL", " WHERE assistant_response IS NOT NULL")

PROMPT_SCORE = r"""
WITH q AS (SELECT id, user_problem AS u, lower(user_problem) AS ul, regexp_extract_all(user_problem, '[\p{L}\p{N}_][\p{L}\p{N}_'']*') AS uw, trim(regexp_replace(regexp_replace(lower(trim(regexp_replace(user_problem, '\s+', ' ', 'g'))), '[^\p{L}\p{N}_\s]', '', 'g'), '\s+', ' ', 'g')) AS uk FROM training_examples WHERE user_problem IS NOT NULL),
f AS (SELECT id, len(uw) < 8 AS short, len(uw) > 26 AS long, contains(ul, ' and ') AND len(string_split(u, ',')) > 2 AS loaded, len(list_distinct(list_filter(string_split(uk, ' '), lambda x: x <> ''))) < greatest(4, len(uw) // 3) AS same,
  regexp_matches(ul, '(^|[^\p{L}\p{N}_])(confused|fear|afraid|restless|discipline|trust|grief|uncertain|angry|jealous|overwhelmed|career|purpose|change|clarity|action)($|[^\p{L}\p{N}_])') AS themed FROM q)
SELECT id, greatest(0, least(100, 100 - 15 * short::INT - 10 * long::INT - 8 * loaded::INT - 8 * same::INT + 5 * themed::INT))::BIGINT AS score,
  concat_ws('|', CASE WHEN short THEN 'prompt_too_short' END, CASE WHEN long THEN 'prompt_too_long' END, CASE WHEN loaded THEN 'prompt_overloaded' END, CASE WHEN same THEN 'prompt_low_variety' END) AS issues FROM f
"""

RESPONSE_SCORE = f"""
WITH {_ANSWERS_ONLY}
SELECT id, quality, repetition, actionability, concat_ws('|',
  CASE WHEN n < 80 THEN 'response_too_short' END, CASE WHEN n > 150 THEN 'response_too_long' END, CASE WHEN semis >= 4 THEN 'too_many_semicolons' WHEN semis = 3 THEN 'semicolon_heavy' END,
  CASE WHEN k1 > 0 THEN 'repeated_scaffold:a calmer response is often' END, CASE WHEN k2 > 0 THEN 'repeated_scaffold:that matters because' END, CASE WHEN k3 > 0 THEN 'repeated_scaffold:it turns reflection into something you can live today' END,
  CASE WHEN k4 > 0 THEN 'repeated_scaffold:that is often the turning point' END, CASE WHEN k5 > 0 THEN 'repeated_scaffold:it helps action grow cleaner' END, CASE WHEN that_is >= 3 THEN 'repeated_that_is' END, CASE WHEN it_helps >= 3 THEN 'repeated_it_helps' END,
  CASE WHEN same_sentence > 0 THEN 'repeated_sentence_fragments' END, CASE WHEN same_stem > 0 THEN 'repeated_sentence_stem' END, CASE WHEN listed THEN 'listicle_style' END, CASE WHEN leak THEN 'scripture_metadata_leakage' END,
  CASE WHEN generic THEN 'generic_motivational_advice' END, CASE WHEN concrete = 0 THEN 'no_concrete_next_step' END, CASE WHEN NOT acts THEN 'weak_practical_action' END, CASE WHEN medical THEN 'medical_or_therapy_language' END,
  CASE WHEN unstable THEN 'looping_or_unstable_phrase' END, CASE WHEN looped THEN 'looping_template' END) AS reasons FROM responses
"""

FINAL_SCORE = f"WITH {_PAIRS} SELECT id, final_score, final_score >= 80 AS kept FROM finals"

DEDUP_RANK = f"WITH {_PAIRS}, x AS (SELECT id, final_score, row_number() OVER (PARTITION BY uk {RANK}) AS place, count(*) OVER (PARTITION BY uk) AS n_group FROM nearly) SELECT id, place, n_group, place = 1 AND final_score >= 80 AS kept FROM x WHERE n_group > 1"

DEDUP_TWO_PHASE = f"WITH {_PAIRS} {_PHASES} SELECT id, phase, verdict FROM verdicts"

UNIQUENESS_SWEEP = f"""WITH {_PAIRS}, one AS (SELECT *, row_number() OVER (PARTITION BY ak ORDER BY final_score DESC, id) AS ra FROM nearly WHERE final_score >= 80),
two AS (SELECT *, row_number() OVER (PARTITION BY uk ORDER BY final_score DESC, id) AS rb FROM one WHERE ra = 1) SELECT id, final_score FROM two WHERE rb = 1"""

TOP_KEPT = f"""WITH {_PAIRS} SELECT id, final_score, side FROM (SELECT id, final_score, 'top' AS side, row_number() OVER (ORDER BY final_score DESC, id) AS r FROM finals
UNION ALL SELECT id, final_score, 'bottom', row_number() OVER (ORDER BY final_score, id) FROM finals) q WHERE r <= 20"""

CLEANUP_REPORT = f"""WITH {_PAIRS} {_PHASES} SELECT 'verdict' AS section, verdict AS item, count(*)::BIGINT AS n FROM verdicts GROUP BY verdict UNION ALL SELECT 'phase', phase, count(*) FROM verdicts GROUP BY phase
UNION ALL SELECT 'score_band', CASE WHEN final_score >= 90 THEN '90' WHEN final_score >= 80 THEN '80' WHEN final_score >= 60 THEN '60' ELSE '0' END, count(*) FROM verdicts GROUP BY 2"""

RUBRIC_SCORE = r"""
WITH q AS (SELECT id, assistant_response AS t, lower(assistant_response) AS low, regexp_extract_all(lower(assistant_response), '[a-z'']+') AS w FROM training_examples WHERE assistant_response IS NOT NULL),
g AS (SELECT id, coalesce(sum(c - 1), 0) AS again FROM (SELECT id, gram, count(*) AS c FROM (SELECT id, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS gram FROM q) z GROUP BY id, gram) y GROUP BY id),
f AS (SELECT q.id, t, len(string_split(t, ';')) - 1 AS semis, coalesce(again, 0) AS again,
  len(list_intersect(['calm', 'steady', 'gently', 'gentle', 'soften', 'patience', 'patient', 'grounded', 'breathe', 'breathing', 'quietly'], w)) AS n_calm,
  len(list_intersect(['clarity', 'wisdom', 'truth', 'attachment', 'discipline', 'fear', 'duty', 'action', 'choice', 'steadiness', 'awareness', 'inner', 'ego', 'desire', 'trust', 'surrender', 'purpose'], w)) AS n_phil,
  len(list_intersect(['write', 'choose', 'pause', 'notice', 'name', 'act', 'take', 'complete', 'return', 'release', 'remove', 'schedule', 'ground', 'soften'], w)) AS n_act,
  regexp_matches(low, '(^|[^\p{L}\p{N}_])(arjuna|krishna|sanjaya|gandeeva|o king|bhagavad gita|chapter \d+)($|[^\p{L}\p{N}_])') AS scripture,
  regexp_matches(low, '(^|[^\p{L}\p{N}_])(must obey|god commands|worship|sinful|punishment|you should surrender to god|only god)($|[^\p{L}\p{N}_])') AS preachy,
  regexp_matches(low, '(^|[^\p{L}\p{N}_])(today|next step|for the next hour|one action|one step)($|[^\p{L}\p{N}_])') AS timed, regexp_matches(low, '(^|[^\p{L}\p{N}_])you must($|[^\p{L}\p{N}_])') AS must,
  regexp_matches(low, '(^|[^\p{L}\p{N}_])(it makes sense|understandable|you are not weak|human|it is natural|anyone would)($|[^\p{L}\p{N}_])') AS kind, regexp_matches(low, '(^|[^\p{L}\p{N}_])(feel|feeling|fear|grief|anger|confusion|restless|uncertain)($|[^\p{L}\p{N}_])') AS feels
  FROM q LEFT JOIN g ON q.id = g.id),
s AS (SELECT id, greatest(1, least(5, 2 + least(3, n_calm) - contains(t, '!')::INT))::BIGINT AS calm, greatest(1, least(5, 2 + least(3, n_phil // 2 + 1) - scripture::INT))::BIGINT AS clarity,
  greatest(1, least(5, CASE WHEN n_act >= 3 THEN 5 WHEN n_act = 2 THEN 4 WHEN n_act = 1 THEN 3 ELSE 1 END + timed::INT))::BIGINT AS action, greatest(1, least(5, CASE WHEN preachy THEN 1 WHEN scripture THEN 3 ELSE 5 END - must::INT))::BIGINT AS humility,
  greatest(1, least(5, 2 + 2 * kind::INT + feels::INT))::BIGINT AS empathy, greatest(1, least(5, 5 - (again >= 2)::INT - (again >= 4)::INT - (semis >= 1)::INT - (semis >= 3)::INT))::BIGINT AS repetition FROM f)
SELECT *, calm + clarity + action + humility + empathy + repetition AS total FROM s
"""

QUALITY_REVIEW = r"""
WITH e AS (SELECT DISTINCT id, trim(concat_ws(' ', nullif(original_text, ''), nullif(translation, ''), nullif(commentary, ''))) AS t, trim(coalesce(extracted_principle, '')) AS p FROM wisdom_entries),
x AS (SELECT wisdom_entry_id AS entry, assistant_response AS a, count(*) OVER (PARTITION BY assistant_response) AS same FROM training_examples WHERE assistant_response IS NOT NULL),
k AS (SELECT entry, count(*) AS n, bool_or(same > 6) AS often, bool_or(regexp_matches(a, '�|(?i)(^|[^\p{L}\p{N}_])[jkvx]{3,}hh($|[^\p{L}\p{N}_])|[{}|~`^]')) AS corrupted,
  bool_or(regexp_matches(a, '(?i)(^|[^\p{L}\p{N}_])[i1l]{3,}[a-z]{2,}($|[^\p{L}\p{N}_])|[A-Za-z0-9]{20,}')) AS ocr, bool_or(regexp_matches(a, '(?i)(^|[^\p{L}\p{N}_])(chapter\s+\d+|page\s+\d+|\d+\.\d+)($|[^\p{L}\p{N}_])')) AS meta FROM x WHERE entry IS NOT NULL GROUP BY entry),
f AS (SELECT id, coalesce(n, 0)::BIGINT AS n_examples, coalesce(often, false) AS often, coalesce(corrupted, false) AS corrupted, coalesce(ocr, false) AS ocr, coalesce(meta, false) AS meta,
  regexp_matches(t, '�|(?i)(^|[^\p{L}\p{N}_])[jkvx]{3,}hh($|[^\p{L}\p{N}_])|[{}|~`^]') AS bad, length(t) < 20 AS short,
  regexp_matches(t, '(?i)(^|[^\p{L}\p{N}_])page\s+\d+($|[^\p{L}\p{N}_])|^\s*\d+\s+(the bhagavad gita|chapter)($|[^\p{L}\p{N}_])|(^|[^\p{L}\p{N}_])\d{1,3}\s*$') AS page,
  regexp_matches(t, '(?i)(^|[^\p{L}\p{N}_])(the bhagavad gita|chapter\s+\d+\s+\d+|contents)($|[^\p{L}\p{N}_])') AS header,
  len(list_filter(regexp_split_to_array(p, '\s+'), lambda w: w <> '')) < 10 AS p_short, rtrim(lower(p), ':.') IN ('o king', 'arjuna said', 'sanjaya said', 'krishna said') AS p_speaker, regexp_matches(lower(p), '^(o king|arjuna said|sanjaya said|krishna said)') AS p_starts
  FROM e LEFT JOIN k ON id = entry),
s AS (SELECT *, greatest(0, least(100, 100 - 40 * bad::INT - 30 * short::INT - 20 * page::INT - 20 * header::INT - 35 * p_short::INT - 40 * p_speaker::INT - 40 * p_starts::INT - 25 * often::INT - 35 * corrupted::INT - 30 * ocr::INT - 25 * meta::INT))::BIGINT AS score FROM f)
SELECT id, n_examples, score, concat_ws('|', CASE WHEN bad THEN 'entry_contains_encoding_corruption' END, CASE WHEN short THEN 'entry_text_too_short' END, CASE WHEN page THEN 'entry_contains_page_number_artifacts' END, CASE WHEN header THEN 'entry_contains_header_footer_artifacts' END,
  CASE WHEN p_short THEN 'principle_too_short' END, CASE WHEN p_speaker THEN 'principle_is_only_speaker_text' END, CASE WHEN p_starts THEN 'principle_starts_with_speaker_text' END, CASE WHEN often THEN 'training_response_repeated_too_many_times' END,
  CASE WHEN corrupted THEN 'training_response_contains_corruption' END, CASE WHEN ocr THEN 'training_response_contains_raw_ocr_output' END, CASE WHEN meta THEN 'training_response_contains_metadata_artifacts' END) AS issues,
  CASE WHEN score >= 80 AND NOT (bad OR short OR page OR header OR p_short OR p_speaker OR p_starts OR corrupted OR ocr OR meta) THEN 'approved' ELSE 'rejected' END AS status FROM s
"""

DISTILLED_QUALITY = r"""
WITH e AS (SELECT DISTINCT id, coalesce(trim(regexp_replace(distilled_wisdom, '\s+', ' ', 'g')), '') AS s, coalesce(len(emotional_tags), 0) AS n_e, coalesce(len(philosophical_tags), 0) AS n_p, coalesce(len(use_cases), 0) AS n_u FROM wisdom_entries),
f AS (SELECT id, s = '' AS blank, n_e, n_p, n_u, len(list_filter(string_split(s, ' '), lambda w: w <> '')) AS n, regexp_matches(s, '[{}@ïÌœ]|H¥|�|\.\.\.') AS bad,
  regexp_matches(lower(s), '(^|[^\p{L}\p{N}_])(these gods|thus he said|taking hold of the bow|therefore these|death told him|he then said|o death|o brahmana)($|[^\p{L}\p{N}_])') AS told,
  regexp_matches(lower(s), '^(death said|teacher said|disciple said|student said)($|[^\p{L}\p{N}_])') AS speaker,
  regexp_matches(lower(s), '(^|[^\p{L}\p{N}_])(sacrifice|oblations|altar|agnihotra|ritual|rites?|vow of holding fire|bricks|guest enters the houses)($|[^\p{L}\p{N}_])') AS ritual,
  regexp_matches(lower(s), '(^|[^\p{L}\p{N}_])(choose|attention|practice|mind|heart|control|clarity|desire|fear|pride|attachment|learning|discipline|truth)($|[^\p{L}\p{N}_])') AS applies,
  regexp_matches(lower(s), '(^|[^\p{L}\p{N}_])(fear|desire|grief|restless|ego|pride|clarity|discipline|control|attachment|choice|humility|confusion|steadiness)($|[^\p{L}\p{N}_])') AS conflict,
  regexp_matches(lower(s), '(^|[^\p{L}\p{N}_])(self-knowledge|awareness|truth|understanding|humility|attention|witness|clarity)($|[^\p{L}\p{N}_])') AS knows,
  regexp_matches(lower(s), '(^|[^\p{L}\p{N}_])(choose|practice|pause|train|guide|loosen|remember|live|deepens|grows)($|[^\p{L}\p{N}_])') AS practical,
  regexp_matches(lower(s), '(^|[^\p{L}\p{N}_])(absolute|imperishable|all-pervasive|indivisible|immortal|truth alone|deepest awareness|what is deepest in you)($|[^\p{L}\p{N}_])') AS meta,
  regexp_matches(lower(s), '^(truth becomes transformative|real learning matures|peace grows|freedom deepens|fear softens|a restless mind becomes clearer)($|[^\p{L}\p{N}_])') AS generic FROM e),
g AS (SELECT *, CASE WHEN blank THEN 0.0 ELSE greatest(0, least(100, 50 - 40 * bad::INT - 30 * told::INT - 30 * speaker::INT - 30 * ritual::INT - 25 * (n < 8)::INT - 25 * (n > 30)::INT + 20 * applies::INT + 15 * conflict::INT + 15 * knows::INT + 10 * (n_e > 0)::INT + 10 * practical::INT - 20 * (meta AND NOT conflict)::INT - 20 * generic::INT)) END::DOUBLE AS score,
  CASE WHEN blank THEN 'blank_distilled_wisdom' ELSE concat_ws('|', CASE WHEN bad THEN 'contamination_or_ocr' END, CASE WHEN told THEN 'scripture_narration' END, CASE WHEN speaker THEN 'speaker_only' END, CASE WHEN ritual THEN 'ritual_only' END, CASE WHEN n < 8 THEN 'too_short' END, CASE WHEN n > 30 THEN 'too_long' END,
    CASE WHEN NOT applies THEN 'weak_human_applicability' END, CASE WHEN NOT conflict THEN 'weak_inner_conflict_relevance' END, CASE WHEN NOT knows THEN 'weak_self_knowledge_signal' END, CASE WHEN n_e = 0 THEN 'missing_emotional_tags' END, CASE WHEN NOT practical THEN 'weak_practical_training_potential' END,
    CASE WHEN meta AND NOT conflict THEN 'too_metaphysical' END, CASE WHEN generic THEN 'too_generic' END, CASE WHEN n_p = 0 THEN 'missing_philosophical_tags' END, CASE WHEN n_u = 0 THEN 'weak_human_problem_mapping' END) END AS issues FROM f),
h AS (SELECT id, score, issues, CASE WHEN blank OR bad OR told OR speaker OR ritual OR score < 60 THEN 'rejected' WHEN score >= 85 AND n_e > 0 AND n_p > 0 AND n_u > 0 AND NOT (meta AND NOT conflict) AND NOT generic THEN 'approved' ELSE 'needs_review' END AS status FROM g)
SELECT *, CASE status WHEN 'approved' THEN greatest(85.0, score) WHEN 'needs_review' THEN least(84.0, greatest(60.0, score)) ELSE least(59.0, score) END::DOUBLE AS confidence FROM h
"""


CORPUS_AUDIT = r"""
WITH q AS (SELECT id, assistant_response AS t, trim(regexp_replace(regexp_replace(regexp_replace(lower(assistant_response), '\b(the bhagavad gita|chapter\s+\d+|page\s+\d+|\d+\.\d+)\b', ' ', 'g'), '[^a-z0-9\s]', ' ', 'g'), '\s+', ' ', 'g')) AS norm,
  list_filter(regexp_split_to_array(assistant_response, '\s+'), lambda w: w <> '') AS w FROM training_examples WHERE assistant_response IS NOT NULL),
s AS (SELECT id, trim(regexp_replace(regexp_replace(regexp_replace(lower(v), '\b(the bhagavad gita|chapter\s+\d+|page\s+\d+|\d+\.\d+)\b', ' ', 'g'), '[^a-z0-9\s]', ' ', 'g'), '\s+', ' ', 'g')) AS pattern
  FROM (SELECT id, unnest(string_split(regexp_replace(t, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1))) AS v FROM q) z),
often AS (SELECT DISTINCT id FROM (SELECT id, count(*) OVER (PARTITION BY pattern) AS n FROM s WHERE len(string_split(pattern, ' ')) >= 6) z WHERE n > 15),
k AS (SELECT id, t, len(w) AS n, count(*) OVER (PARTITION BY lower(rtrim(array_to_string(w[1:12], ' '), '.,;:!?'))) AS n_opening, count(*) OVER (PARTITION BY norm) AS n_same, CASE WHEN norm <> '' THEN count(*) OVER (PARTITION BY array_to_string(string_split(norm, ' ')[1:40], ' ')) ELSE 0 END AS n_print FROM q),
f AS (SELECT k.id, n_opening > 5 AS i1, n_same > 1 AS i2, n_same = 1 AND n_print > 2 AS i3, often.id IS NOT NULL AS i4, regexp_matches(t, '[{}@ïÌœ]|H¥|�|jkhh|vijkhh|iijkhh|viiijkhh') AS i5,
  regexp_matches(t, '(?i)(^|[^\p{L}\p{N}_])(the bhagavad gita|chapter\s+\d+|page\s+\d+|\d+\.\d+)($|[^\p{L}\p{N}_])') AS i6, n < 60 AS i7, n > 180 AS i8,
  regexp_matches(t, '(?i)(^|[^\p{L}\p{N}_])(stop medication|ignore your doctor|do not seek help|you do not need help|cure depression|cure anxiety|replace therapy)($|[^\p{L}\p{N}_])') AS i9,
  regexp_matches(t, '(?i)(^|[^\p{L}\p{N}_])(only god can save|must worship|blindly obey|surrender completely to god|your suffering is punishment)($|[^\p{L}\p{N}_])') AS i10,
  regexp_matches(t, '(?i)(^|[^\p{L}\p{N}_])(the central lesson is|my bow|gandeeva|arjuna|krishna said|sanjaya)($|[^\p{L}\p{N}_])') AS i11,
  NOT regexp_matches(t, '(?i)(^|[^\p{L}\p{N}_])(begin|notice|choose|act|return|pause|write|breathe|practice|take|start|speak|rest)($|[^\p{L}\p{N}_])') AS i12 FROM k LEFT JOIN often ON k.id = often.id),
g AS (SELECT *, greatest(0, 100 - 18 * i1::INT - 35 * i2::INT - 18 * i3::INT - 15 * i4::INT - 40 * i5::INT - 30 * i6::INT - 20 * i7::INT - 15 * i8::INT - 45 * i9::INT - 25 * i10::INT - 40 * i11::INT - 20 * i12::INT)::DOUBLE AS score FROM f)
SELECT id, score, concat_ws('|', CASE WHEN i1 THEN 'repeated_opening_phrase' END, CASE WHEN i2 THEN 'duplicate_response' END, CASE WHEN i3 THEN 'near_duplicate_response' END, CASE WHEN i4 THEN 'repeated_sentence_pattern' END, CASE WHEN i5 THEN 'corrupted_characters' END,
  CASE WHEN i6 THEN 'source_metadata_leakage' END, CASE WHEN i7 THEN 'response_too_short' END, CASE WHEN i8 THEN 'response_too_long' END, CASE WHEN i9 THEN 'unsafe_mental_health_advice' END, CASE WHEN i10 THEN 'overly_preachy_tone' END, CASE WHEN i11 THEN 'scripture_narration_leakage' END,
  CASE WHEN i12 THEN 'missing_practical_action' END) AS issues,
  CASE WHEN score < 60 OR i2 OR i5 OR i9 OR i11 THEN 'rejected' WHEN score >= 85 AND NOT (i1 OR i3 OR i4 OR i6) THEN 'approved' ELSE 'needs_review' END AS status FROM g
"""

PAIR_AUDIT = r"""
WITH q AS (SELECT id, assistant_response AS t, trim(regexp_replace(regexp_replace(lower(assistant_response), '[^a-z0-9\s]', ' ', 'g'), '\s+', ' ', 'g')) AS norm, trim(regexp_replace(regexp_replace(lower(user_problem), '[^a-z0-9\s]', ' ', 'g'), '\s+', ' ', 'g')) AS asked,
  list_filter(regexp_split_to_array(assistant_response, '\s+'), lambda w: w <> '') AS w FROM training_examples WHERE assistant_response IS NOT NULL AND user_problem IS NOT NULL),
k AS (SELECT id, t, len(w) AS n, count(*) OVER (PARTITION BY norm) AS n_same, CASE WHEN norm <> '' THEN count(*) OVER (PARTITION BY array_to_string(string_split(norm, ' ')[1:45], ' ')) ELSE 0 END AS n_print, count(*) OVER (PARTITION BY asked) AS n_asked,
  count(*) OVER (PARTITION BY lower(rtrim(array_to_string(w[1:10], ' '), '.,;:!?'))) AS n_opening FROM q),
f AS (SELECT id, n < 80 AS i1, n > 170 AS i2, regexp_matches(t, '(?i)(^|[^\p{L}\p{N}_])(kena|katha|mundaka|upanishad|chapter|passage|verse|these gods|taking hold of the bow|brahman said)($|[^\p{L}\p{N}_])') AS i3, regexp_matches(t, '[{}@ïÌœ]|H¥|�|jkhh|vijkhh|iijkhh|viiijkhh') AS i4,
  n_same > 1 AS i5, n_same = 1 AND n_print > 1 AS i6, n_asked > 1 AS i7, n_opening > 2 AS i8, NOT regexp_matches(t, '(?i)(^|[^\p{L}\p{N}_])(write|choose|pause|return|take|name|set|practice|notice|pick|ask|breathe|complete|spend)($|[^\p{L}\p{N}_])') AS i9,
  regexp_matches(t, '(?i)(^|[^\p{L}\p{N}_])(only god can save|must worship|blindly obey|your suffering is punishment|submit completely)($|[^\p{L}\p{N}_])') AS i10, regexp_matches(t, '(^|\n)\s*(\d+\.|- )') AS i11,
  regexp_matches(t, '(?i)(^|[^\p{L}\p{N}_])(cure anxiety|cure depression|replace therapy|you do not need therapy|stop medication|ignore your doctor)($|[^\p{L}\p{N}_])') AS i12, contains(t, '!') AS i13 FROM k),
g AS (SELECT *, greatest(0, 100 - 20 * i1::INT - 15 * i2::INT - 40 * i3::INT - 40 * i4::INT - 40 * i5::INT - 20 * i6::INT - 12 * i7::INT - 18 * i8::INT - 20 * i9::INT - 25 * i10::INT - 20 * i11::INT - 45 * i12::INT - 8 * i13::INT)::DOUBLE AS score FROM f)
SELECT id, score, concat_ws('|', CASE WHEN i1 THEN 'response_too_short' END, CASE WHEN i2 THEN 'response_too_long' END, CASE WHEN i3 THEN 'scripture_metadata_leakage' END, CASE WHEN i4 THEN 'corrupted_characters' END, CASE WHEN i5 THEN 'duplicate_response' END, CASE WHEN i6 THEN 'near_duplicate_response' END,
  CASE WHEN i7 THEN 'duplicate_user_problem' END, CASE WHEN i8 THEN 'repeated_opening_phrase' END, CASE WHEN i9 THEN 'missing_practical_action' END, CASE WHEN i10 THEN 'preachy_tone' END, CASE WHEN i11 THEN 'listicle_format' END, CASE WHEN i12 THEN 'medical_or_therapy_claim' END, CASE WHEN i13 THEN 'tone_too_emphatic' END) AS issues,
  CASE WHEN score < 60 OR i3 OR i4 OR i5 OR i12 THEN 'rejected' WHEN score >= 85 AND NOT (i1 OR i2 OR i6 OR i7 OR i8 OR i9 OR i10 OR i11 OR i13) THEN 'approved' ELSE 'needs_review' END AS status FROM g
"""

PRINCIPLE_QUALITY = r"""
WITH e AS (SELECT DISTINCT id, coalesce(trim(regexp_replace(extracted_principle, '\s+', ' ', 'g')), '') AS p, translation, commentary FROM wisdom_entries),
m AS (SELECT *, ' ' || regexp_replace(lower(p), '[^\p{L}\p{N}_]', ' . ', 'g') || ' ' AS x FROM e),
f AS (SELECT id, p = '' AS i1, p <> '' AND len(string_split(p, ' ')) < 10 AS i2, regexp_matches(lower(p), '^(o king|o partha|arjuna said|sanjaya said|krishna said)($|[^\p{L}\p{N}_])') AS i3, regexp_matches(p, '[{}@ïÌœ]|H¥|�|jkhh|vijkhh|iijkhh|viiijkhh') AS i4,
  regexp_matches(lower(p), 'chapter\s+\d+|page\s+\d+|the bhagavad gita|introduction\s+\d+') AS i5, regexp_matches(lower(p), '^(pause, observe your inner state|listen to some more|i am the|now i will|thus, i heard)($|[^\p{L}\p{N}_])') AS i6,
  p <> '' AND len(regexp_extract_all(x, ' (said|asked|look   \.   at|look \. at|sounded|heard|saw|narrated|replied|rushed) ')) >= 2 AS told, p <> '' AND NOT regexp_matches(lower(p), '(^|[^\p{L}\p{N}_])(should|must|let go|perform|surrender|focus|control|discipline|duty|detachment|wisdom|fear|desire|clarity|devotion|self-control|action)($|[^\p{L}\p{N}_])') AS i8,
  p <> '' AND NOT regexp_matches(lower(p), '(^|[^\p{L}\p{N}_])(inner|mind|fear|desire|attachment|anger|confusion|discipline|devotion|self-control|duty|detachment|clarity|wisdom|surrender)($|[^\p{L}\p{N}_])') AS i9,
  coalesce(regexp_matches(translation, '[{}@ïÌœ]|H¥|�|jkhh|vijkhh|iijkhh|viiijkhh'), false) AS i10, coalesce(regexp_matches(commentary, '[{}@ïÌœ]|H¥|�|jkhh|vijkhh|iijkhh|viiijkhh'), false) AS i11 FROM m),
g AS (SELECT *, told AND i8 AS i7, greatest(0, 100 - 60 * i1::INT - 35 * i2::INT - 35 * i3::INT - 40 * i4::INT - 30 * i5::INT - 30 * i6::INT - 25 * (told AND i8)::INT - 10 * i8::INT - 10 * i9::INT - 20 * i10::INT - 20 * i11::INT)::DOUBLE AS score FROM f)
SELECT id, score, concat_ws('|', CASE WHEN i1 THEN 'missing_principle' END, CASE WHEN i2 THEN 'principle_too_short' END, CASE WHEN i3 THEN 'speaker_text_opening' END, CASE WHEN i4 THEN 'corrupted_characters' END, CASE WHEN i5 THEN 'header_footer_artifact' END, CASE WHEN i6 THEN 'too_generic' END,
  CASE WHEN i7 THEN 'mostly_narration' END, CASE WHEN i8 THEN 'weak_lesson_signal' END, CASE WHEN i9 THEN 'weak_inner_conflict_signal' END, CASE WHEN i10 THEN 'translation_corruption' END, CASE WHEN i11 THEN 'commentary_corruption' END) AS issues,
  CASE WHEN score < 60 OR i1 OR i4 OR i5 THEN 'rejected' WHEN score >= 85 THEN 'approved' ELSE 'needs_review' END AS status, CASE WHEN score >= 85 THEN score WHEN score >= 60 THEN least(84.0, score) ELSE least(59.0, score) END::DOUBLE AS confidence FROM g
"""

MODEL_COMPARE = f"""WITH r AS ({RUBRIC_SCORE}), b AS (SELECT r.id, total, coalesce(tone, '') >= 'm' AS second FROM r JOIN training_examples x ON r.id = x.id),
t AS (SELECT coalesce(sum(total) FILTER (NOT second), 0)::BIGINT AS total_a, coalesce(sum(total) FILTER (second), 0)::BIGINT AS total_b, count(*) FILTER (NOT second) AS n_a, count(*) FILTER (second) AS n_b FROM b)
SELECT total_a, total_b, round(total_a / nullif(n_a, 0), 2) AS mean_a, round(total_b / nullif(n_b, 0), 2) AS mean_b, CASE WHEN total_a / nullif(n_a, 0) > total_b / nullif(n_b, 0) THEN 'a' WHEN total_a / nullif(n_a, 0) < total_b / nullif(n_b, 0) THEN 'b' ELSE 'tie' END AS verdict FROM t"""

APPROVAL = "SELECT x.id FROM training_examples x WHERE x.dataset_status = 'approved' AND x.dataset_quality_score >= 85 AND len(x.dataset_audit_issues) = 0 AND x.wisdom_entry_id IN (SELECT id FROM wisdom_entries WHERE principle_status = 'approved')"

SQL = {
    "stream_approval_available_now": APPROVAL,
    "corpus_audit": CORPUS_AUDIT,
    "pair_audit": PAIR_AUDIT,
    "principle_quality": PRINCIPLE_QUALITY,
    "stream_audit_available_now": CORPUS_AUDIT,
    "prompt_score": PROMPT_SCORE,
    "response_score": RESPONSE_SCORE,
    "final_score": FINAL_SCORE,
    "dedup_rank": DEDUP_RANK,
    "dedup_two_phase": DEDUP_TWO_PHASE,
    "uniqueness_sweep": UNIQUENESS_SWEEP,
    "top_kept": TOP_KEPT,
    "cleanup_report": CLEANUP_REPORT,
    "rubric_score": RUBRIC_SCORE,
    "model_compare": MODEL_COMPARE,
    "quality_review": QUALITY_REVIEW,
    "distilled_quality": DISTILLED_QUALITY,
}
