"""Audits of all answers against corpus counts: the flagship and its variant for pairs.

A table is read once: rules and keys of a row are one projection, and what is kept of it is light (flags and 64-bit
keys, no text). Keys are counted with map-side combine, so a key that a third of the rows share is one row afterwards,
and only keys above their threshold are joined back to the ids that hold them. No text takes part in a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwork.functions import packs as P
from quillwork.functions import text as X
from quillwork.operators.rules import Rule, issues_sql, score_sql, status_sql
from quillwork.plans.dialect import Spark
from quillwork.plans.lineage import cut
from quillwork.sources.tables import first_arrival, table

D = Spark()
A = "assistant_response"
#: A key is hot above this many rows: openings, normalised answers, fingerprints, sentences; prompts in the variant.
HOT = {"opening": 5, "answer": 1, "print": 2, "sentence": 15}
PAIR_HOT = {"opening": 2, "answer": 1, "print": 1, "prompt": 1}


def normal(t: str) -> str:
    """Lower case without metadata, other signs as blanks, collapsed."""
    return X.clean_text(D, D.sub(D.sub(f"lower({t})", rf"\b(?:{P.AUDIT_METADATA})\b", " "), r"[^a-z0-9\s]", " "))


def _first(t: str, n: int) -> str:
    return D.join(D.slice(X.tokens(D, t), 1, n), " ")


def facts(answers: DataFrame) -> DataFrame:
    """What the audit needs of id and assistant_response: measures, flags and keys."""
    rows = answers.where(f"{A} IS NOT NULL").selectExpr("id", f"{A} AS t", f"lower({A}) AS low", f"{normal(A)} AS norm").withColumn("words", F.expr(D.all("low", P.WORD)))
    patterns = D.trans(D.filt(D.trans(D.sentences("t"), "v", normal("v")), "p", f"{D.size(X.tokens(D, 'p'))} >= 6"), "k", "xxhash64(k)")
    rx = lambda p: P.holds("low", "words", p)
    return rows.selectExpr(
        "id",
        f"{D.size(X.tokens(D, 't'))} AS n_words",
        f"{D.rx('t', P.AUDIT_CORRUPTION)} AS corrupted",
        f"{rx(P.AUDIT_METADATA)} AS metadata",
        f"{rx(P.AUDIT_UNSAFE)} AS unsafe",
        f"{rx(P.AUDIT_PREACHY)} AS preachy",
        f"{rx(P.AUDIT_NARRATION)} AS narration",
        f"{rx(P.AUDIT_ACTION)} AS acts",
        f"xxhash64({X.opening(D, 't')}) AS opening",
        "xxhash64(norm) AS answer",
        f"CASE WHEN norm <> '' THEN xxhash64({_first('norm', 40)}) END AS print",
        f"{patterns} AS sentence",
    )


def keys_of(rows: DataFrame, kinds: dict[str, int]) -> DataFrame:
    """id, kind, k: every key of every row; a list gives one row for each of its keys."""
    single = [F.struct(F.lit(c).alias("kind"), F.col(c).alias("k")) for c in kinds if c != "sentence"]
    every = F.array(*single)
    if "sentence" in kinds:
        every = F.concat(every, F.transform("sentence", lambda k: F.struct(F.lit("sentence").alias("kind"), k.alias("k"))))
    return rows.select("id", F.explode(every).alias("x")).select("id", "x.kind", "x.k").where("k IS NOT NULL")


def hot_keys(keys: DataFrame, kinds: dict[str, int]) -> DataFrame:
    limit = F.expr("CASE kind " + " ".join(f"WHEN '{k}' THEN {n}" for k, n in kinds.items()) + " END")
    return keys.groupBy("kind", "k").agg(F.count("*").alias("n")).where(F.col("n") > limit).select("kind", "k")


def flagged(rows: DataFrame, keys: DataFrame, hot: DataFrame, kinds: dict[str, int]) -> DataFrame:
    """rows with hot_<kind>: true where a key of the row is hot, else null."""
    flags = keys.join(hot, ["kind", "k"]).groupBy("id").agg(*[F.max(F.when(F.col("kind") == c, True)).alias(f"hot_{c}") for c in kinds])
    return rows.join(flags, "id", "left")


RULES = [
    Rule("repeated_opening_phrase", "hot_opening", -18),
    Rule("duplicate_response", "hot_answer", -35),
    Rule("near_duplicate_response", "hot_answer IS NULL AND hot_print", -18),
    Rule("repeated_sentence_pattern", "hot_sentence", -15),
    Rule("corrupted_characters", "corrupted", -40),
    Rule("source_metadata_leakage", "metadata", -30),
    Rule("response_too_short", "n_words < 60", -20),
    Rule("response_too_long", "n_words > 180", -15),
    Rule("unsafe_mental_health_advice", "unsafe", -45),
    Rule("overly_preachy_tone", "preachy", -25),
    Rule("scripture_narration_leakage", "narration", -40),
    Rule("missing_practical_action", "NOT acts", -20),
]
HARD = ["duplicate_response", "corrupted_characters", "unsafe_mental_health_advice", "scripture_narration_leakage"]
SOFT = ["repeated_opening_phrase", "near_duplicate_response", "repeated_sentence_pattern", "source_metadata_leakage"]


def judged(rows: DataFrame, rules: list[Rule], hard: list[str], soft: list[str] | None) -> DataFrame:
    found = rows.selectExpr("id", f"{score_sql(D, rules)} AS score", f"{issues_sql(D, rules)} AS found")
    return found.selectExpr("id", "score", f"{D.join('found', '|')} AS issues", f"{status_sql(D, 'score', 'found', hard, soft)} AS status")


def audit(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """id, score, issues, status of rows of facts() against hot keys."""
    return judged(flagged(rows, keys_of(rows, HOT), hot, HOT), RULES, HARD, SOFT)


def corpus_audit(spark: SparkSession, data_dir: str) -> DataFrame:
    """The flagship: score, issues and class of every answer against the whole corpus. Null answers take no part."""
    rows = cut(facts(table(spark, data_dir, "training_examples").select("id", A)))
    return audit(rows, hot_keys(keys_of(rows, HOT), HOT))


PAIR_RULES = [
    Rule("response_too_short", "n_words < 80", -20),
    Rule("response_too_long", "n_words > 170", -15),
    Rule("scripture_metadata_leakage", "forbidden", -40),
    Rule("corrupted_characters", "corrupted", -40),
    Rule("duplicate_response", "hot_answer", -40),
    Rule("near_duplicate_response", "hot_answer IS NULL AND hot_print", -20),
    Rule("duplicate_user_problem", "hot_prompt", -12),
    Rule("repeated_opening_phrase", "hot_opening", -18),
    Rule("missing_practical_action", "NOT acts", -20),
    Rule("preachy_tone", "preachy", -25),
    Rule("listicle_format", "listed", -20),
    Rule("medical_or_therapy_claim", "medical", -45),
    Rule("tone_too_emphatic", "emphatic", -8),
]
PAIR_HARD = ["scripture_metadata_leakage", "corrupted_characters", "duplicate_response", "medical_or_therapy_claim"]


def pair_audit(spark: SparkSession, data_dir: str) -> DataFrame:
    """The audit of prompt and answer pairs: counts of prompts too, and stricter status. Pairs with a null side take no part."""
    rows = table(spark, data_dir, "training_examples").where(f"{A} IS NOT NULL AND user_problem IS NOT NULL").selectExpr("id", f"{A} AS t", f"{X.norm_b(D, A)} AS norm", f"{X.norm_b(D, 'user_problem')} AS prompt_norm", f"lower({A}) AS low").withColumn("words", F.expr(D.all("low", P.WORD)))
    rx = lambda p: P.holds("low", "words", p)
    rows = cut(
        rows.selectExpr(
            "id",
            f"{D.size(X.tokens(D, 't'))} AS n_words",
            f"{rx(P.PAIR_FORBIDDEN)} AS forbidden",
            f"{D.rx('t', P.AUDIT_CORRUPTION)} AS corrupted",
            f"{rx(P.PAIR_ACTION)} AS acts",
            f"{rx(P.PAIR_PREACHY)} AS preachy",
            f"{D.rx('t', P.PAIR_LIST)} AS listed",
            f"{rx(P.PAIR_MEDICAL)} AS medical",
            "contains(t, '!') AS emphatic",
            f"xxhash64({X.opening(D, 't', 10)}) AS opening",
            "xxhash64(norm) AS answer",
            f"CASE WHEN norm <> '' THEN xxhash64({_first('norm', 45)}) END AS print",
            "xxhash64(prompt_norm) AS prompt",
        )
    )
    keys = keys_of(rows, PAIR_HOT)
    return judged(flagged(rows, keys, hot_keys(keys, PAIR_HOT), PAIR_HOT), PAIR_RULES, PAIR_HARD, None)


def principle_quality(spark: SparkSession, data_dir: str) -> DataFrame:
    """Quality of the extracted principle of each entry; without one only its texts are tested."""
    own = first_arrival(table(spark, data_dir, "wisdom_entries").select("id", "ingest_seq", "extracted_principle", "translation", "commentary"))
    own = own.selectExpr("id", "translation", "commentary", f"coalesce({X.clean_text(D, 'extracted_principle')}, '') AS p")
    count = lambda p: D.size(D.all(D.sub("p", r"([^\p{L}\p{N}_])", "{1}{1}"), P.words(p.replace(" ", "  ").replace("-", "--"))))
    own = own.selectExpr("*", f"{count(P.PRINCIPLE_NARRATION)} AS told", f"{count(P.PRINCIPLE_LESSON)} AS lessons")
    has = "p <> ''"
    rules = [
        Rule("missing_principle", f"NOT {has}", -60),
        Rule("principle_too_short", f"{has} AND {D.size(X.tokens(D, 'p'))} < 10", -35),
        Rule("speaker_text_opening", D.rx("p", P.PRINCIPLE_SPEAKER), -35),
        Rule("corrupted_characters", D.rx("p", P.AUDIT_CORRUPTION), -40),
        Rule("header_footer_artifact", D.rx("p", P.PRINCIPLE_HEADER), -30),
        Rule("too_generic", D.rx("p", P.PRINCIPLE_GENERIC), -30),
        Rule("mostly_narration", f"{has} AND told >= 2 AND lessons = 0", -25),
        Rule("weak_lesson_signal", f"{has} AND lessons = 0", -10),
        Rule("weak_inner_conflict_signal", f"{has} AND NOT {D.rx('p', P.words(P.PRINCIPLE_CONFLICT))}", -10),
        Rule("translation_corruption", D.rx("translation", P.AUDIT_CORRUPTION), -20),
        Rule("commentary_corruption", D.rx("commentary", P.AUDIT_CORRUPTION), -20),
    ]
    found = own.selectExpr("id", f"{score_sql(D, rules)} AS score", f"{issues_sql(D, rules)} AS found")
    hard = D.strings(["missing_principle", "corrupted_characters", "header_footer_artifact"])
    status = f"CASE WHEN score < 60 OR {D.overlap('found', hard)} THEN 'rejected' WHEN score >= 85 THEN 'approved' ELSE 'needs_review' END"
    confidence = "CASE WHEN score >= 85 THEN greatest(85.0D, score) WHEN score >= 60 THEN least(84.0D, greatest(60.0D, score)) ELSE least(59.0D, score) END"
    return found.selectExpr("id", "score", f"{D.join('found', '|')} AS issues", f"{status} AS status", f"{confidence} AS confidence")


QUERIES = {f.__name__: f for f in (corpus_audit, pair_audit, principle_quality)}
