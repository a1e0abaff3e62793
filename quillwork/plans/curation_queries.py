"""Scores, ranking and de-duplication of examples, and reviews of entries.

Each query reads its table once. Scores and the three keys of a row are one projection; what follows works on that
light table (an id, four scores, three 64-bit keys), which is cut once where it is read twice. Winners and counts of a
group are aggregates with map-side combine, so a key that a third of the rows share is no single task's work. The SQL
that checks these queries is written on its own in `quillwork.plans.oracles`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwork.functions import packs as P
from quillwork.functions import text as X
from quillwork.operators.ranking import ranked_in_groups, winners
from quillwork.operators.rules import Rule, issues_sql, score_sql
from quillwork.plans.dialect import Spark
from quillwork.plans.lineage import cut
from quillwork.sources.tables import first_arrival, table

D = Spark()
A = "assistant_response"
KEEP = 80


def examples(spark: SparkSession, data_dir: str, *columns: str) -> DataFrame:
    return table(spark, data_dir, "training_examples").select("id", *columns)


# scores

PROMPT_RULES = [
    Rule("prompt_too_short", "p_words < 8", -15),
    Rule("prompt_too_long", "p_words > 26", -10),
    Rule("prompt_overloaded", "contains(p_low, ' and ') AND p_commas >= 2", -8),
    Rule("prompt_low_variety", "p_distinct < greatest(4, floor(p_words / 3))", -8),
    Rule("themed", P.holds("p_low", "p_tokens", P.PROMPT_THEMES), 5, False),
]

# (name, condition, change of quality, of repetition, of actionability, times the column)
RESPONSE_RULES = [
    ("response_too_short", "n_words < 80", -12, 0, 0, None),
    ("response_too_long", "n_words > 150", -12, 0, 0, None),
    ("too_many_semicolons", "semis >= 4", -10, -14, 0, None),
    ("semicolon_heavy", "semis = 3", -6, -8, 0, None),
    *[(f"repeated_scaffold:{s}", f"scaffold_{i} > 0", -5, -6, 0, f"scaffold_{i}") for i, s in enumerate(P.SCAFFOLDS)],
    ("repeated_that_is", "that_is >= 3", -10, -12, 0, None),
    ("repeated_it_helps", "it_helps >= 3", -8, -10, 0, None),
    ("repeated_sentence_fragments", "same_sentence", -18, -25, 0, None),
    ("repeated_sentence_stem", "same_stem", -8, -12, 0, None),
    ("listicle_style", "listicle", -18, 0, 0, None),
    ("scripture_metadata_leakage", D.any_of("low", P.LEAKS), -25, 0, 0, None),
    ("generic_motivational_advice", D.any_of("low", P.GENERIC), -8, 0, 0, None),
    ("no_concrete_next_step", "concrete = 0", -10, 0, -18, None),
    (None, "concrete = 1", 0, 0, -5, None),
    (None, "concrete >= 2", 0, 0, 5, None),
    ("weak_practical_action", f"NOT {P.holds('low', 'words', P.ACTION_VERBS)}", -8, 0, -12, None),
    ("medical_or_therapy_language", P.holds("low", "words", P.MEDICAL), -20, 0, 0, None),
    ("looping_or_unstable_phrase", D.any_of("low", P.LOOPING), -20, -25, 0, None),
    ("looping_template", "loops >= 2", -25, -30, 0, None),
]


def _count(text: str, phrase: str) -> str:
    """Occurrences of whole words; every sign between words is doubled before, so that neighbours share none."""
    doubled = D.sub(text, r"([^\p{L}\p{N}_])", "{1}{1}")
    return f"CASE WHEN contains({text}, {D.lit(phrase)}) THEN " + D.size(D.all(doubled, r"(?:^|[^\p{L}\p{N}_])" + phrase.replace(" ", "  ") + r"(?:$|[^\p{L}\p{N}_])")) + " ELSE 0 END"


def measured(df: DataFrame) -> DataFrame:
    """df (id, user_problem, assistant_response) with what the rules look at."""
    key = X.norm_c(D, "user_problem")
    df = df.selectExpr("*", "lower(user_problem) AS p_low", f"{D.size(X.word_tokens(D, 'user_problem'))} AS p_words", f"{D.size(f'array_distinct({X.tokens(D, key)})')} AS p_distinct", f"lower({A}) AS low", f"{X.sentence_list(D, X.clean_text(D, A))} AS ss")
    plain = X.clean_text(D, D.sub("lower(v)", r"[^\p{L}\p{N}_\s]", ""))
    df = df.selectExpr("*", f"{D.all('p_low', P.WORD)} AS p_tokens", f"{D.all('low', P.WORD)} AS words", f"{D.trans('ss', 'v', plain)} AS sentence_keys", f"{D.trans('ss', 'v', D.join(D.slice(X.word_tokens(D, 'lower(v)'), 1, 6), ' '))} AS stems")
    hits = [f"CAST((length(low) - length(replace(low, {D.lit(s)}, ''))) / {len(s)} AS BIGINT) AS scaffold_{i}" for i, s in enumerate(P.SCAFFOLDS)]
    return df.selectExpr(
        "*",
        "length(p_low) - length(replace(p_low, ',', '')) AS p_commas",
        f"{D.size(X.word_tokens(D, A))} AS n_words",
        f"length({A}) - length(replace({A}, ';', '')) AS semis",
        *hits,
        f"{_count('low', 'that is')} AS that_is",
        f"{_count('low', 'it helps')} AS it_helps",
        f"CASE WHEN contains(low, 'stop letting') THEN {D.size(D.all('low', P.LOOP_TEMPLATE))} ELSE 0 END AS loops",
        "size(sentence_keys) > size(array_distinct(sentence_keys)) AS same_sentence",
        "size(stems) > size(array_distinct(stems)) AS same_stem",
        f"{D.rx(A, r'(?m)^\s*\d+\.\s')} OR contains({A}, '**') AS listicle",
        " + ".join(f"CASE WHEN contains(low, {D.lit(w)}) THEN 1 ELSE 0 END" for w in P.CONCRETE) + " AS concrete",
    )


def _accumulated(at: int) -> str:
    parts = [f"CASE WHEN {r[1]} THEN {r[at]}{' * ' + r[5] if r[5] else ''} ELSE 0 END" for r in RESPONSE_RULES if r[at]]
    return f"CAST(greatest(0, least(100, 100 + {' + '.join(parts)})) AS BIGINT)"


def scored(spark: SparkSession, data_dir: str, *more: str) -> DataFrame:
    """id, prompt, quality, repetition, actionability, final_score of every pair of prompt and answer, and further expressions."""
    rows = measured(examples(spark, data_dir, "user_problem", A).where(f"user_problem IS NOT NULL AND {A} IS NOT NULL"))
    df = rows.selectExpr("id", f"CAST({score_sql(D, PROMPT_RULES)} AS BIGINT) AS prompt", f"{_accumulated(2)} AS quality", f"{_accumulated(3)} AS repetition", f"{_accumulated(4)} AS actionability", *more)
    # a fifth of prompt, repetition and actionability and two of quality: a multiple of 0.2, so rounding meets no tie
    return df.withColumn("final_score", F.expr("CAST((2 * (prompt + 2 * quality + repetition + actionability) + 5) DIV 10 AS BIGINT)"))


def prompt_score(spark: SparkSession, data_dir: str) -> DataFrame:
    rows = measured(examples(spark, data_dir, "user_problem").where("user_problem IS NOT NULL").withColumn(A, F.lit("")))
    return rows.selectExpr("id", f"CAST({score_sql(D, PROMPT_RULES)} AS BIGINT) AS score", f"{D.join(issues_sql(D, PROMPT_RULES), '|')} AS issues")


def response_score(spark: SparkSession, data_dir: str) -> DataFrame:
    """Quality, repetition and actionability of every answer, with the reasons in the order of the rules."""
    rows = measured(examples(spark, data_dir, A).where(f"{A} IS NOT NULL").withColumn("user_problem", F.lit("")))
    named = D.compact([f"CASE WHEN {r[1]} THEN {D.lit(r[0])} END" for r in RESPONSE_RULES if r[0]])
    return rows.selectExpr("id", f"{_accumulated(2)} AS quality", f"{_accumulated(3)} AS repetition", f"{_accumulated(4)} AS actionability", f"{D.join(named, '|')} AS reasons")


def final_score(spark: SparkSession, data_dir: str) -> DataFrame:
    return scored(spark, data_dir).select("id", "final_score", (F.col("final_score") >= KEEP).alias("kept"))


# ranking and de-duplication

def near_prompt(t: str) -> str:
    """First ten words of a prompt without its stop phrases."""
    e = D.sub(X.norm_c(D, t), " ", "  ")
    for phrases in P.NEAR_DROPPED:
        e = D.sub(e, f"(^| )(?:{phrases.replace(' ', '  ')})( |$)", "{1}{2}")
    return D.join(D.slice(X.tokens(D, e), 1, 10), " ")


def keyed(spark: SparkSession, data_dir: str) -> DataFrame:
    """The light table: scores and the keys of prompt, near prompt and answer."""
    keys = [f"xxhash64({X.norm_c(D, 'user_problem')}) AS exact_key", f"xxhash64({near_prompt('user_problem')}) AS near_key", f"xxhash64({X.norm_c(D, A)}) AS answer_key"]
    return scored(spark, data_dir, *keys)


def order() -> list:
    """Best first: final score, quality, actionability, repetition, then the earlier row."""
    return [F.col(c) for c in ("final_score", "quality", "actionability", "repetition")] + [-F.col("id")]


def dedup_rank(spark: SparkSession, data_dir: str) -> DataFrame:
    """Rows of prompts that occur more than once, with their place; the first stays from a score of KEEP on."""
    rows = cut(keyed(spark, data_dir).select("id", "exact_key", "final_score", "quality", "actionability", "repetition"))
    several = rows.groupBy("exact_key").agg(F.count("*").alias("n_group")).where("n_group > 1")
    places = ranked_in_groups(rows, "exact_key", [F.desc(c) for c in ("final_score", "quality", "actionability", "repetition")] + [F.asc("id")])
    return places.join(several, "exact_key").select("id", "place", "n_group", ((F.col("place") == 1) & (F.col("final_score") >= KEEP)).alias("kept"))


def verdicts(spark: SparkSession, data_dir: str) -> DataFrame:
    """id, final_score, phase, verdict: groups of equal prompts first; rows without an equal go on to groups of near prompts; single rows stay from a score of KEEP on."""
    rows = cut(keyed(spark, data_dir).select("id", "exact_key", "near_key", "final_score", "quality", "actionability", "repetition"))
    exact = winners(rows, "exact_key", order()).select("exact_key", F.col("n").alias("n_exact"), F.col("winner.id").alias("exact_id"), "winner")
    alone = exact.where("n_exact = 1").select("winner.*")
    near = winners(alone, "near_key", order()).select("near_key", F.col("n").alias("n_near"), F.col("winner.id").alias("near_id"))
    joined = rows.join(exact.drop("winner"), "exact_key").join(near, "near_key", "left")
    phase = F.when(F.col("n_exact") > 1, "exact").when(F.col("n_near") > 1, "near").otherwise("single")
    winner = F.when(F.col("n_exact") > 1, F.col("exact_id")).otherwise(F.col("near_id"))
    verdict = F.when(F.col("id") != winner, F.concat(F.lit("duplicate_"), phase)).when(F.col("final_score") < KEEP, "below_final_score_threshold").otherwise("kept")
    return joined.select("id", "final_score", phase.alias("phase"), verdict.alias("verdict"))


def dedup_two_phase(spark: SparkSession, data_dir: str) -> DataFrame:
    return verdicts(spark, data_dir).select("id", "phase", "verdict")


def uniqueness_sweep(spark: SparkSession, data_dir: str) -> DataFrame:
    """Of the rows the score keeps, by final score and then arrival: the first of each answer, and of these the first of each prompt."""
    # cut before the filter, which would else be computed from the texts a second time below the projection
    rows = cut(keyed(spark, data_dir).select("id", "final_score", "exact_key", "answer_key")).where(F.col("final_score") >= KEEP)
    by = [F.col("final_score"), -F.col("id")]
    of_answer = winners(rows, "answer_key", by).select("winner.*")
    return winners(of_answer, "exact_key", by).select("winner.id", "winner.final_score")


def top_kept(spark: SparkSession, data_dir: str) -> DataFrame:
    """The twenty best and the twenty worst rows by final score."""
    rows = scored(spark, data_dir).select("id", "final_score")
    best = rows.orderBy(F.desc("final_score"), "id").limit(20).withColumn("side", F.lit("top"))
    worst = rows.orderBy("final_score", "id").limit(20).withColumn("side", F.lit("bottom"))
    return best.unionByName(worst)


def cleanup_report(spark: SparkSession, data_dir: str) -> DataFrame:
    """Counts of verdicts, phases and score bands: one aggregate over one read."""
    band = F.expr("CASE WHEN final_score >= 90 THEN '90' WHEN final_score >= 80 THEN '80' WHEN final_score >= 60 THEN '60' ELSE '0' END")
    cells = verdicts(spark, data_dir).groupBy("verdict", "phase", band.alias("band")).agg(F.count("*").alias("n"))
    items = F.explode(F.array(*[F.struct(F.lit(s).alias("section"), F.col(c).alias("item")) for s, c in (("verdict", "verdict"), ("phase", "phase"), ("score_band", "band"))]))
    return cells.select(items.alias("x"), "n").groupBy("x.section", "x.item").agg(F.sum("n").alias("n"))


# the rubric of an evaluation

def rubric_score(spark: SparkSession, data_dir: str) -> DataFrame:
    """Six sub-scores of 1 to 5 and their sum; words count once however often they stand in the answer."""
    rows = examples(spark, data_dir, A).where(f"{A} IS NOT NULL").selectExpr("id", f"{A} AS t", f"lower({A}) AS low").selectExpr("*", f"{D.all('low', "[a-z']+")} AS w", f"{D.all('low', P.WORD)} AS words")
    rx = lambda p: P.holds("low", "words", p)
    known = lambda bank: f"size(array_intersect(array_distinct(w), {D.strings(bank)}))"
    one = lambda c: f"CASE WHEN {c} THEN 1 ELSE 0 END"
    scripture, repeats, semis = rx(P.RUBRIC_SCRIPTURE), X.trigram_repetition(D, "w"), "(length(t) - length(replace(t, ';', '')))"
    parts = {
        "calm": f"2 + least(3, {known(P.CALM)}) - {one("contains(t, '!')")}",
        "clarity": f"2 + least(3, {known(P.PHILOSOPHICAL)} DIV 2 + 1) - {one(scripture)}",
        "action": f"element_at(array(1, 3, 4, 5), CAST(least(3, {known(P.ACTIONS)}) + 1 AS INT)) + {one(rx(P.RUBRIC_TIME))}",
        "humility": f"CASE WHEN {rx(P.RUBRIC_PREACHY)} THEN 1 WHEN {scripture} THEN 3 ELSE 5 END - {one(rx('you must'))}",
        "empathy": f"2 + 2 * {one(rx(P.RUBRIC_EMPATHY))} + {one(rx(P.RUBRIC_FEELING))}",
        "repetition": f"5 - {one('again >= 2')} - {one('again >= 4')} - {one(f'{semis} >= 1')} - {one(f'{semis} >= 3')}",
    }
    rows = rows.withColumn("again", F.expr(repeats))
    return rows.selectExpr("id", *[f"CAST(greatest(1, least(5, {e})) AS BIGINT) AS {k}" for k, e in parts.items()]).withColumn("total", F.expr(" + ".join(parts)))


def model_compare(spark: SparkSession, data_dir: str) -> DataFrame:
    """Two systems (answers by tone) by the rubric: totals, means and a verdict by strict difference; one aggregate."""
    b = F.coalesce(F.col("tone"), F.lit("")) >= "m"
    tones = examples(spark, data_dir, "tone").select("id", b.alias("second"))
    rows = rubric_score(spark, data_dir).select("id", "total").join(tones, "id")
    side = lambda c, x: F.sum(F.when(c, x))
    s = rows.agg(*[e.alias(n) for n, e in (("total_a", F.coalesce(side(~F.col("second"), F.col("total")), F.lit(0))), ("total_b", F.coalesce(side(F.col("second"), F.col("total")), F.lit(0))), ("n_a", F.count_if(~F.col("second"))), ("n_b", F.count_if("second")))])
    mean = lambda t, n: f"round({t} / nullif({n}, 0), 2)"
    verdict = "CASE WHEN total_a / nullif(n_a, 0) > total_b / nullif(n_b, 0) THEN 'a' WHEN total_a / nullif(n_a, 0) < total_b / nullif(n_b, 0) THEN 'b' ELSE 'tie' END AS verdict"
    return s.selectExpr("total_a", "total_b", f"{mean('total_a', 'n_a')} AS mean_a", f"{mean('total_b', 'n_b')} AS mean_b", verdict)


# reviews of entries

def any_rx(t: str, patterns: list[str]) -> str:
    return "(" + " OR ".join(D.rx(t, p) for p in patterns) + ")"


def quality_review(spark: SparkSession, data_dir: str) -> DataFrame:
    """id, n_examples, score, issues, status of each entry: its own text and principle, and what its examples show; each kind counts once."""
    answers = examples(spark, data_dir, "wisdom_entry_id", A).where(f"{A} IS NOT NULL")
    often = answers.groupBy(F.xxhash64(A).alias("k"), F.length(A).alias("n_chars")).agg(F.count("*").alias("n_same")).where("n_same > 6").select("k", "n_chars", F.lit(True).alias("often"))
    flags = answers.selectExpr("wisdom_entry_id AS entry", f"xxhash64({A}) AS k", f"length({A}) AS n_chars", f"{any_rx(A, P.REVIEW_CORRUPTION)} AS corrupted", f"{any_rx(A, P.REVIEW_OCR)} AS ocr", f"{any_rx(A, P.REVIEW_METADATA)} AS meta")
    kids = flags.join(often, ["k", "n_chars"], "left").groupBy("entry").agg(F.count("*").alias("n"), *[F.max(F.coalesce(F.col(c), F.lit(False))).alias(c) for c in ("often", "corrupted", "ocr", "meta")])
    own = first_arrival(table(spark, data_dir, "wisdom_entries").select("id", "ingest_seq", "original_text", "translation", "commentary", "extracted_principle"))
    own = own.selectExpr("id", "trim(concat_ws(' ', nullif(original_text, ''), nullif(translation, ''), nullif(commentary, ''))) AS t", "trim(coalesce(extracted_principle, '')) AS p")
    low = "lower(p)"
    rules = [
        Rule("entry_contains_encoding_corruption", any_rx("t", P.REVIEW_CORRUPTION), -40),
        Rule("entry_text_too_short", "length(t) < 20", -30),
        Rule("entry_contains_page_number_artifacts", any_rx("t", P.REVIEW_PAGE), -20),
        Rule("entry_contains_header_footer_artifacts", any_rx("t", P.REVIEW_HEADER), -20),
        Rule("principle_too_short", f"{D.size(X.tokens(D, 'p'))} < 10", -35),
        Rule("principle_is_only_speaker_text", D.isin(D.sub(low, "[:.]+$"), P.SPEAKERS), -40),
        Rule("principle_starts_with_speaker_text", "(" + " OR ".join(f"startswith({low}, {D.lit(s)})" for s in P.SPEAKERS) + ")", -40),
        Rule("training_response_repeated_too_many_times", "often", -25),
        Rule("training_response_contains_corruption", "corrupted", -35),
        Rule("training_response_contains_raw_ocr_output", "ocr", -30),
        Rule("training_response_contains_metadata_artifacts", "meta", -25),
    ]
    judged = own.join(kids, F.col("id") == F.col("entry"), "left").selectExpr("id", "coalesce(n, 0) AS n_examples", f"CAST({score_sql(D, rules)} AS BIGINT) AS score", f"{issues_sql(D, rules)} AS found")
    ok = f"score >= 80 AND NOT {D.overlap('found', D.strings(P.REVIEW_HARD))}"
    return judged.selectExpr("id", "n_examples", "score", f"{D.join('found', '|')} AS issues", f"CASE WHEN {ok} THEN 'approved' ELSE 'rejected' END AS status")


def distilled_quality(spark: SparkSession, data_dir: str) -> DataFrame:
    """id, score, issues, status, confidence of each distilled sentence; a blank one scores 0 and is tested no further."""
    own = first_arrival(table(spark, data_dir, "wisdom_entries").select("id", "ingest_seq", "distilled_wisdom", "emotional_tags", "philosophical_tags", "use_cases"))
    own = own.selectExpr("*", f"coalesce({X.clean_text(D, 'distilled_wisdom')}, '') AS s")
    n, has, none = D.size(X.tokens(D, "s")), "s <> ''", lambda c: f"coalesce(size({c}), 0) <= 0"
    rx = lambda p: D.rx("s", P.words(p))
    rules = [
        Rule("blank_distilled_wisdom", f"NOT {has}", -100),
        *[
            Rule(name, f"{has} AND ({when})", change, named)
            for name, when, change, named in [
                ("contamination_or_ocr", D.rx("s", P.DISTILLED_CORRUPTION), -40, True),
                ("scripture_narration", rx(P.DISTILLED_NARRATION), -30, True),
                ("speaker_only", D.rx("s", P.DISTILLED_SPEAKER), -30, True),
                ("ritual_only", rx(P.DISTILLED_RITUAL), -30, True),
                ("too_short", f"{n} < 8", -25, True),
                ("too_long", f"{n} > 30", -25, True),
                ("applicable", rx(P.DISTILLED_APPLICABLE), 20, False),
                ("weak_human_applicability", f"NOT {rx(P.DISTILLED_APPLICABLE)}", 0, True),
                ("conflict", rx(P.DISTILLED_CONFLICT), 15, False),
                ("weak_inner_conflict_relevance", f"NOT {rx(P.DISTILLED_CONFLICT)}", 0, True),
                ("knowledge", rx(P.DISTILLED_KNOWLEDGE), 15, False),
                ("weak_self_knowledge_signal", f"NOT {rx(P.DISTILLED_KNOWLEDGE)}", 0, True),
                ("emotional", f"NOT {none('emotional_tags')}", 10, False),
                ("missing_emotional_tags", none("emotional_tags"), 0, True),
                ("practical", rx(P.DISTILLED_PRACTICAL), 10, False),
                ("weak_practical_training_potential", f"NOT {rx(P.DISTILLED_PRACTICAL)}", 0, True),
                ("too_metaphysical", f"{rx(P.DISTILLED_METAPHYSICAL)} AND NOT {rx(P.DISTILLED_CONFLICT)}", -20, True),
                ("too_generic", D.rx("s", P.DISTILLED_GENERIC), -20, True),
                ("missing_philosophical_tags", none("philosophical_tags"), 0, True),
                ("weak_human_problem_mapping", none("use_cases"), 0, True),
            ]
        ],
    ]
    judged = own.selectExpr("id", f"{score_sql(D, rules, 50)} AS score", f"{issues_sql(D, rules)} AS found")
    hard = D.strings(["blank_distilled_wisdom", "contamination_or_ocr", "scripture_narration", "speaker_only", "ritual_only"])
    soft = D.strings(["missing_emotional_tags", "missing_philosophical_tags", "weak_human_problem_mapping", "too_metaphysical", "too_generic"])
    status = f"CASE WHEN {D.overlap('found', hard)} OR score < 60 THEN 'rejected' WHEN score >= 85 AND NOT {D.overlap('found', soft)} THEN 'approved' ELSE 'needs_review' END"
    done = judged.selectExpr("id", "score", f"{D.join('found', '|')} AS issues", f"{status} AS status")
    return done.selectExpr("*", "CASE status WHEN 'approved' THEN greatest(85.0D, score) WHEN 'needs_review' THEN least(84.0D, greatest(60.0D, score)) ELSE least(59.0D, score) END AS confidence")


QUERIES = {f.__name__: f for f in (prompt_score, response_score, final_score, dedup_rank, dedup_two_phase, uniqueness_sweep, top_kept, cleanup_report, rubric_score, model_compare, quality_review, distilled_quality)}
