"""Boundaries of the rule packs on hand-written rows."""

from pyspark.sql import functions as F

EXAMPLE = "id long, wisdom_entry_id long, user_problem string, assistant_response string, tone string, approved_for_finetune boolean, dataset_quality_score double, dataset_status string, dataset_audit_issues array<string>"


def rows_of(texts):
    return [(i, 1, f"question {i}", t, "plain", False, 90.0, "approved", []) for i, t in enumerate(texts)]


def audit(spark, tables, texts):
    from quillwork.plans.registry import queries

    d = tables(training_examples=(rows_of(texts), EXAMPLE))
    return {r.id: (r.score, r.issues.split("|") if r.issues else [], r.status) for r in queries()["corpus_audit"](spark, d).collect()}


def unique(i, n):
    return "write " + " ".join(f"w{i}x{k}" for k in range(n - 1))


def test_length_limits(spark, tables):
    got = audit(spark, tables, [unique(0, 59), unique(1, 60), unique(2, 180), unique(3, 181)])
    assert "response_too_short" in got[0][1] and "response_too_short" not in got[1][1]
    assert "response_too_long" not in got[2][1] and "response_too_long" in got[3][1]
    assert got[1] == (100.0, [], "approved")


def test_duplicates_and_openings(spark, tables):
    same = unique(9, 70)
    opened = ["write " + " ".join(f"a{k}" for k in range(11)) + " " + " ".join(f"t{i}x{k}" for k in range(60)) for i in range(6)]
    got = audit(spark, tables, [same, same, *opened])
    assert got[0][1] == ["duplicate_response"] and got[0][2] == "rejected"
    assert all("repeated_opening_phrase" in got[i][1] for i in range(2, 8))
    got = audit(spark, tables, opened[:5])
    assert all("repeated_opening_phrase" not in v[1] for v in got.values())


def test_empty_and_null_texts(spark, tables):
    got = audit(spark, tables, ["", None, "é" * 50_000])
    assert set(got) == {0, 2} and "response_too_short" in got[0][1]
    assert audit(spark, tables, []) == {}


def test_scored_dataframe(spark):
    from quillwork.operators.rules import Rule, scored

    df = spark.createDataFrame([(1, 5), (2, None)], "id int, n int")
    got = {r.id: (r.score, list(r.issues)) for r in scored(df, [Rule("small", "n < 10", -30.0)]).collect()}
    assert got == {1: (70.0, ["small"]), 2: (100.0, [])}


def test_column_functions(spark):
    from quillwork.functions import text as X

    df = spark.createDataFrame([("  A  b.\n C d? ",)], "t string")
    r = df.select(X.column(X.clean_text, "t").alias("c"), X.column(X.opening, "t", 2).alias("o"), F.size(X.column(X.sentence_list, "t")).alias("n")).first()
    assert (r.c, r.o, r.n) == ("A b. C d?", "a b", 2)


def scores(spark, tables, answers, prompts=None):
    from quillwork.plans.registry import queries

    rows = [(i, 1, (prompts or {}).get(i, f"question {i}"), t, "plain", False, 90.0, "approved", []) for i, t in enumerate(answers)]
    d = tables(training_examples=(rows, EXAMPLE))
    return d, {r.id: r for r in queries()["response_score"](spark, d).collect()}


GOOD = "Write down one line and choose one task today. " + " ".join(f"word{k}" for k in range(75)) + "."


def test_response_score_by_hand(spark, tables):
    texts = [
        GOOD,
        GOOD + " That matters because x. That matters because y.",  # each hit counts
        GOOD + " a; b; c; d.",
        GOOD + " a; b; c; d; e.",
        GOOD + " That is so that is so that is so.",
        GOOD + " Yes it helps, it helps (it helps).",
        "stop letting fear decide what is right for you and stop letting fear decide what is right for you " + GOOD,
        "1. " + GOOD,
        "- " + GOOD,
        GOOD + " ok?? no",
        "short",
    ]
    _, got = scores(spark, tables, texts)
    of = lambda i: (got[i].quality, got[i].repetition, got[i].actionability)
    assert of(0) == (100, 100, 100)
    assert of(1) == (90, 88, 100)
    assert of(2) == (94, 92, 100) and of(3) == (90, 86, 100)
    assert of(4) == (90, 88, 100) and of(5) == (92, 90, 100)
    assert of(6) == (75, 70, 100)
    assert of(7) == (82, 100, 100) and of(8) == (100, 100, 100)  # a dash is no numbered list
    assert of(9) == (80, 75, 100)
    assert of(10) == (70, 100, 70) and got[10].reasons == "response_too_short|no_concrete_next_step|weak_practical_action"


def test_rubric_counts_a_word_once(spark, tables):
    from quillwork.plans.registry import queries

    d, _ = scores(spark, tables, ["calm calm calm", "Calm and steady. You must write, choose and pause today; it makes sense to feel this."])
    got = {r.id: r for r in queries()["rubric_score"](spark, d).collect()}
    assert (got[0].calm, got[0].clarity, got[0].action, got[0].humility, got[0].empathy, got[0].repetition) == (3, 3, 1, 5, 2, 5)
    assert (got[1].calm, got[1].action, got[1].humility, got[1].empathy, got[1].repetition) == (4, 5, 4, 5, 4)


def test_duplicates_by_score_then_quality(spark, tables):
    from quillwork.plans.registry import queries

    prompt = "How do I meet this long week of work with a steady mind?"
    d, _ = scores(spark, tables, [GOOD + " a; b; c; d; e.", GOOD, GOOD, "short ?? text"], {0: prompt, 1: prompt, 2: prompt.upper(), 3: "Another long question about the same week of work here?"})
    assert sorted((r.id, r.place, r.n_group, r.kept) for r in queries()["dedup_rank"](spark, d).collect()) == [(0, 3, 3, False), (1, 1, 3, True), (2, 2, 3, False)]
    got = {r.id: (r.phase, r.verdict) for r in queries()["dedup_two_phase"](spark, d).collect()}
    assert got == {0: ("exact", "duplicate_exact"), 1: ("exact", "kept"), 2: ("exact", "duplicate_exact"), 3: ("single", "below_final_score_threshold")}


def test_ranks_split_a_hot_group(spark):
    from quillwork.operators.ranking import ranked_in_groups

    df = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i % 7}", i * 7919 % 1000) for i in range(3000)], "id long, k string, s long")
    got = ranked_in_groups(df, "k", [F.desc("s"), F.asc("id")]).collect()
    want = {}
    for r in sorted(got, key=lambda r: (r.k, -r.s, r.id)):
        want.setdefault(r.k, []).append(r.id)
    assert all(want[r.k][r.place - 1] == r.id for r in got) and len(got) == 3000


def test_cleanup_against_plain_python(spark, tables):
    """The cleanup of answers in plain Python, on texts that meet every step."""
    import hashlib
    import re

    from quillwork.functions import vocabularies as W
    from quillwork.plans import lesson_queries as L
    from quillwork.plans.registry import queries

    key = lambda t: " ".join(re.sub(r"[^\w\s]", "", " ".join(t.split()).lower()).split())
    count = lambda t: len(re.findall(r"\b[\w']+\b", t))

    def split(t):
        return [x.strip() for x in re.split(r"(?<=[.!?])\s+", " ".join(t.split()).replace("; ", ". ").replace(";", ".")) if x.strip()]

    def clean(u, a):
        seed = f"{u}::{a}"
        pick = lambda bank, salt: bank[int(hashlib.md5((seed + salt).encode()).hexdigest()[:8], 16) % len(bank)]
        out, seen, generic = [], set(), False
        for s in split(a):
            low = s.lower()
            if re.search(rf"\b({W.CLEANUP_SCRIPTURE})\b", low):
                continue
            if "that matters because" in low or low.startswith(tuple(W.CLEANUP_STARTS)):
                s = pick(L.BRIDGES, "::bridge")
            elif any(x in low for x in L.REPLACED):
                s = next(v for x, v in L.REPLACED.items() if x in low)
            else:
                s = re.sub(r"\bIt helps\b", "This helps", re.sub(r"\bThat is\b", "This is", s, count=1), count=1)
            if not key(s) or key(s) in seen:
                continue
            seen.add(key(s))
            if s.lower() in L.GENERIC_CLOSERS:
                if generic:
                    continue
                generic = True
            out.append(s)
        act = next((s for s in reversed(out) if any(h in s.lower() for h in W.CLEANUP_HINTS)), None)
        if act:
            out = [s for s in out if s != act] + [act]
        text = " ".join(out)
        closer = pick(L.CLOSERS, "::closer")
        if count(text) < 80 and key(closer) not in {key(s) for s in out}:
            text = f"{text} {closer}".strip()
        if count(text) > 150:
            kept = []
            for s in split(text):
                if not (s.lower() in L.GENERIC_CLOSERS and count(" ".join([*kept, s])) > 140):
                    kept.append(s)
            while count(" ".join(kept)) > 150 and len(kept) > 3:
                kept.pop(-2)
            text = " ".join(kept)
        return text

    long = " ".join(f"Sentence {i} has six words here." for i in range(30))
    answers = [
        GOOD, long, long + " Steadiness returns through practice.", "That is it. That is it. It helps; a lot. The verse ends.", "That matters because x. Choose one step. It helps action grow cleaner. Then rest.",
        "Small sincere steps restore clarity. Go. Small sincere steps restore clarity. You only need enough honesty for the next step.", "", "!!!", "That becomes real when you go. Write down a line. Write down a line! End.", " ".join(["word"] * 200) + ".",
    ]
    d, _ = scores(spark, tables, answers)
    got = {r.id: r.cleaned_md5 for r in queries()["cleanup_response"](spark, d).collect()}
    assert got == {i: hashlib.md5(clean(f"question {i}", a).encode()).hexdigest() for i, a in enumerate(answers)}
