"""Properties of the order-sensitive operators."""

import random
from collections import Counter

import pandas as pd

from quillwork.operators import greedy
from quillwork.plans import greedy_queries as Q


def rows(n=80):
    return pd.DataFrame({"source": [1] * n, "ordinal": range(n), "lesson": [f"Lesson {i} stands here." for i in range(n)], "topic": [f"topic {i}" for i in range(n)]})


def made(frame, **kw):
    args = {"opening_cap": 5, "sentence_cap": 30, "attempts": 40, "per_lesson": 2} | kw
    return greedy.generate(frame, [Q.OPENINGS, Q.MIDDLES, Q.ENDS], Q.PROMPTS, **args)


def test_caps_and_uniqueness():
    got = made(rows())
    assert len(got) and max(Counter(got["opening"]).values()) <= 5
    assert got["prompt"].is_unique and got["answer"].is_unique
    assert max(Counter(got["ordinal"]).values()) <= 2


def test_order_of_rows_does_not_matter():
    frame = rows()
    shuffled = frame.sample(frac=1, random_state=3)
    pd.testing.assert_frame_equal(made(frame).reset_index(drop=True), made(shuffled).reset_index(drop=True))


def test_fallback_marks_forced_rows_and_blank_lessons_are_skipped():
    frame = rows(60)
    frame.loc[0, "lesson"] = None
    frame.loc[1, "lesson"] = "  "
    got = made(frame, per_lesson=1, fallback=True)
    assert set(got["ordinal"]) == set(range(2, 60)) and got["forced"].any()
    assert made(frame.iloc[:0]).empty


def test_capped_assignment():
    frame = pd.DataFrame({"source": [1] * 5, "ordinal": range(5), "candidates": [["a", "b"]] * 5})
    assert list(greedy.capped(frame, 2)["chosen"]) == ["a", "a", "b", "b", None]


def test_rewrites_keep_target_and_theme_cap():
    n = 200
    frame = pd.DataFrame({"id": range(n), "theme": [random.Random(i).choice("xyz") for i in range(n)], "place": range(n)})
    got = greedy.accept_rewrites(frame.itertuples(index=False), 50, {"x": 25}, 20, Q.PROMPTS)
    themes = Counter(t for _, t, _ in got)
    assert len(got) == 50 and len({p for _, _, p in got}) == 50 and themes["x"] <= 25 and max(themes["y"], themes["z"]) <= 20
    # a refused prompt does not use up its theme: rows behind it are still taken
    clash = pd.DataFrame({"id": [0, 97, 1, 2], "theme": ["x"] * 4, "place": range(4)})
    assert len(greedy.accept_rewrites(clash.itertuples(index=False), 4, {}, 4, Q.PROMPTS[:1])) == 3


def test_fingerprint_generator():
    got = greedy.generate_by_fingerprint(rows(), Q.BANKS, Q.PROMPTS, 2)
    assert max(Counter(got["opening"]).values()) <= 2 and got["answer"].map(greedy.fingerprint).is_unique
    frame = rows(4)
    frame["topic"] = "same"
    assert len(set(greedy.generate_by_fingerprint(frame, Q.BANKS, Q.PROMPTS[:4], 2)["prompt"])) == 4  # unused prompts first


def test_family_generator_keeps_caps_in_any_order():
    frame = rows(30).assign(families=[["career", "purpose"]] * 30)
    got = greedy.generate_by_family(frame, Q.BANKS, Q.FAMILY_PROMPTS)
    assert max(Counter(got["opening"][got["opening"] != ""]).values()) <= 3 and max(Counter(got["ordinal"]).values()) <= 5
    assert max(sum(m in a for a in got["answer"]) for m in Q.MIDDLES) <= 3 and got["prompt"].is_unique and got["answer"].is_unique
    again = greedy.generate_by_family(frame.sample(frac=1, random_state=5), Q.BANKS, Q.FAMILY_PROMPTS)
    pd.testing.assert_frame_equal(got.reset_index(drop=True), again.reset_index(drop=True))


def test_earlier_examples_count_for_caps():
    first = made(rows(20), per_lesson=1, sentence_cap=3)
    more = rows(40).iloc[20:]
    both = pd.concat([first, greedy.generate(more, Q.BANKS, Q.PROMPTS, 5, 3, 40, 1, False, first)])
    assert max(Counter(both["opening"]).values()) <= 5 and both["prompt"].is_unique


def test_similar_pairs_equal_brute_force(spark):
    import difflib

    from quillwork.operators.similarity import similar_pairs

    rnd = random.Random(1)
    base = ["the quiet lamp keeps a small flame near the old well", "a patient road leads the pupil home before the rains"]
    texts = [t if rnd.random() < 0.3 else t[: (k := rnd.randrange(len(t)))] + rnd.choice("abc ") + t[k + rnd.randrange(2) :] for t in base for _ in range(12)] + ["", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    got = {(r.key_a, r.key_b) for r in similar_pairs(df, "id", "t").collect()}
    first = {}
    for i, t in enumerate(texts):
        if t:
            first.setdefault(" ".join(t.lower().split()), i)
    want = {(min(i, j), max(i, j)) for a, i in first.items() for b, j in first.items() if i < j and difflib.SequenceMatcher(None, a, b).ratio() >= 0.92}
    assert got == want


def test_stream_equals_batch(spark):
    import os

    import pytest

    data = "/root/testdata/sf0.001"
    if not os.path.isdir(data):
        pytest.skip("no test tables")
    from quillwork.plans.registry import queries

    q = queries()
    a = sorted(map(tuple, q["stream_audit_available_now"](spark, data).select("id", "score", "issues", "status").collect()))
    b = sorted(map(tuple, q["corpus_audit"](spark, data).select("id", "score", "issues", "status").collect()))
    assert a == b
