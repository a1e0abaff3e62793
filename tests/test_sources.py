import json

import pytest

from quillwork.sources import chat


def test_chat_lines_strict_and_tolerant(spark, tmp_path):
    ok = {"messages": [{"role": r, "content": r} for r in ("system", "user", "assistant")]}
    lines = [json.dumps(ok), "", "not json", "[]", '{"messages": []}', json.dumps({"messages": [{"role": "robot", "content": "x"}]}), json.dumps({"messages": ok["messages"][1:]}), json.dumps({"messages": ok["messages"][::-1]})]
    (tmp_path / "a.jsonl").write_text("\n".join(lines))
    got = sorted((r.error or "valid") for r in chat.read_chat_lines(spark, str(tmp_path)).collect())
    assert got == sorted(["valid", "malformed", "malformed", "no_messages", "unknown_role", "missing_role", "first_not_system"])
    with pytest.raises(Exception, match="invalid line"):
        chat.read_chat_lines(spark, str(tmp_path), strict=True).collect()


def test_export_round_trip_and_versions(spark, tmp_path):
    df = spark.createDataFrame([("q é", 'a "b"\n'), ("q2", None)], "q string, a string")
    path = chat.write_version(chat.chat_lines(df, "q", "a", "sys"), str(tmp_path), "v1")
    back = {tuple(m.content for m in r.messages) for r in chat.read_chat_lines(spark, path).collect()}
    assert ("sys", "q é", 'a "b"\n') in back
    with pytest.raises(Exception):
        chat.write_version(chat.chat_lines(df, "q", "a", "sys"), str(tmp_path), "v1")


def test_replace_by_source(spark, tmp_path):
    path = str(tmp_path / "t")
    chat.replace_by_source(spark.createDataFrame([(1, "a"), (2, "b")], "source_document_id long, x string"), path)
    chat.replace_by_source(spark.createDataFrame([(2, "c")], "source_document_id long, x string"), path)
    assert {(r.source_document_id, r.x) for r in spark.read.parquet(path).collect()} == {(1, "a"), (2, "c")}


def test_pdf_filter_and_status(spark, tmp_path):
    from pyspark.sql import functions as F

    from quillwork.sources.documents import is_pdf, read_pdfs

    df = spark.createDataFrame([("a.PDF", None), ("b", "application/pdf"), ("c.txt", "text/plain")], "n string, c string")
    assert [r[0] for r in df.select(is_pdf(F.col("n"), F.col("c"))).collect()] == [True, True, False]
    (tmp_path / "x.pdf").write_bytes(b"no pdf")
    assert [r.extraction_status for r in read_pdfs(spark, str(tmp_path)).collect()] in (["failed"], ["unavailable"])


def test_write_back_and_delete(spark, tmp_path):
    import pytest

    from quillwork.sources.chat import replace_by_source
    from quillwork.sources.store import delete_source, format_size, upload_name, write_back

    rows = spark.createDataFrame([(1, 10, 50.0), (2, 10, 60.0), (3, 20, None)], "id long, source_document_id long, score double")
    renewed = spark.createDataFrame([(2, 99.0), (3, None), (7, 1.0)], "id long, score double")
    path = write_back(rows, renewed, "id", str(tmp_path / "snap"), "v2")
    assert sorted((r.id, r.score) for r in spark.read.parquet(path).collect()) == [(1, 50.0), (2, 99.0), (3, None)]
    with pytest.raises(Exception):
        write_back(rows, renewed, "id", str(tmp_path / "snap"), "v2")
    table = str(tmp_path / "t")
    replace_by_source(rows, table)
    gone, before, after = delete_source(spark, table, 10)
    assert gone and [r.id for r in spark.read.parquet(table).collect()] == [3] and before != after
    assert not delete_source(spark, table, 10)[0]
    replace_by_source(rows.where("id = 1"), table, emptied=[20])
    assert [r.id for r in spark.read.parquet(table).collect()] == [1]
    assert format_size(2048) == "2.0 KB" and format_size(10) == "10.0 B"
    a, b = upload_name("My Book.PDF"), upload_name("My Book.PDF")
    assert a != b and a.startswith("my_book_") and a.endswith(".pdf") and upload_name("").startswith("document_")


def test_strict_reading_fails_whatever_is_selected(spark, tmp_path):
    import pytest

    from quillwork.sources.chat import read_chat_lines

    p = tmp_path / "x.jsonl"
    p.write_text('{"messages": []}\n')
    with pytest.raises(Exception, match="invalid line"):
        read_chat_lines(spark, str(p), strict=True).select("line").collect()


def test_markdown_report():
    from quillwork.sources.store import markdown_report

    assert markdown_report("Kept", [{"item": "a|b", "n": 2}, {"item": None, "n": 1}], ["item", "n"]) == "# Kept\n\n| item | n |\n| --- | ---: |\n| a\\|b | 2 |\n|  | 1 |\n"
