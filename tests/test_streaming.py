"""Streaming jobs on small tables in several files: equal to their batch forms, each row once."""

ENTRY = "id long, source_document_id long, book_title string, chapter string, section string, verse_number string, original_text string, transliteration string, translation string, commentary string, extracted_principle string, distilled_wisdom string, emotional_tags array<string>, philosophical_tags array<string>, use_cases array<string>, confidence_score double, principle_quality_score double, principle_status string, ingest_seq long"
EXAMPLE = "id long, wisdom_entry_id long, user_problem string, assistant_response string, dataset_status string, dataset_quality_score double, dataset_audit_issues array<string>"


def entries(n=60):
    return [(i, 1 + i % 2, "River", None, None, None, None, None, "A text.", None, None, f"Lesson {i} stands here.", ["fear"], ["duty"], [], 90.0, 90.0, "approved", i) for i in range(n)]


def test_generation_equals_batch_and_keeps_caps(spark, tmp_path):
    from collections import Counter

    from quillwork.plans.registry import queries

    spark.createDataFrame(entries(), ENTRY).repartition(3).write.parquet(f"{tmp_path}/wisdom_entries.parquet")
    streamed = queries()["stream_generate_available_now"](spark, str(tmp_path)).collect()
    batch = queries()["generate_examples"](spark, str(tmp_path)).collect()
    assert sorted(r.ordinal for r in streamed) == sorted(r.ordinal for r in batch) == list(range(60))
    assert max(Counter((r.source, r.opening) for r in streamed if not r.forced).values()) <= 5


def test_audit_and_approval_of_several_files(spark, tmp_path):
    from quillwork.plans.registry import queries

    rows = [(i, i % 5, f"question {i}", "write " + " ".join(f"w{i % 20}x{k}" for k in range(70)), "approved", 80.0 + i % 10, [] if i % 3 else ["x"]) for i in range(40)] + [(99, None, None, None, None, None, None)]
    spark.createDataFrame(rows, EXAMPLE).repartition(3).write.parquet(f"{tmp_path}/training_examples.parquet")
    spark.createDataFrame(entries(4), ENTRY).write.parquet(f"{tmp_path}/wisdom_entries.parquet")
    q = queries()
    audited = {tuple(r) for r in q["stream_audit_available_now"](spark, str(tmp_path)).collect()}
    assert audited == {tuple(r) for r in q["corpus_audit"](spark, str(tmp_path)).collect()} and len(audited) == 40
    assert {r.id for r in q["stream_approval_available_now"](spark, str(tmp_path)).collect()} == {r[0] for r in rows[:40] if r[1] < 4 and r[5] >= 85 and not r[6]}
