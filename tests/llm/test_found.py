"""Every found query on small tables: hand-written cases, nulls, empty and long texts, ties, replays, empty tables, clashing columns."""

import random
from collections import Counter

import pytest

from quillwork.llm import encoding, format_copies, leakage, lookalike, mixing, near_copies, pair_defects, scan_noise, sentences, split

SCHEMAS = {
    "source_documents": "id long, source_name string, source string, title string, text string",
    "extracted_document_texts": "id long, source_document_id long, raw_text string, ingest_seq long, text string",
    "document_chunks": "id long, content string, ingest_seq long, pieces string",
    "canonical_verses": "id long, source_document_id long, sanskrit_text string, transliteration string, english_translation string, commentary string, ingest_seq long, form string, bag string",
    "training_examples": "id long, user_problem string, assistant_response string, key string, tokens string",
    "chat_records": "record_id long, messages array<struct<role string, content string>>, key string",
    "chat_lines": "line_id long, line_text string, id long",
    "documents": "doc_id long, text string, source string, tokens string, position long",
    "eval_items": "item_id long, text string, h long",
    "mix_targets": "mix_name string, source string, target_share double, max_repeats int",
    "split_limits": "item_table string, item_field string, max_chars int, overlap_chars int",
}
FOUND = {"p1": scan_noise.p1_found, "p2": split.p2_found, "p3": lookalike.p3_found, "p4": near_copies.p4_found, "p5": encoding.p5_found, "p6": format_copies.p6_found, "p7": pair_defects.p7_found, "p8": leakage.p8_found, "p9": mixing.p9_shares, "p10": sentences.p10_found}


def filled(tables, **rows):
    return tables(**{name: (rows.get(name, []), schema) for name, schema in SCHEMAS.items()})


def got(query, spark, d):
    return sorted(map(tuple, query(spark, d).collect()), key=str)


@pytest.mark.parametrize("name", sorted(FOUND))
def test_empty_tables(spark, tables, name):
    assert got(FOUND[name], spark, filled(tables)) == []


@pytest.mark.parametrize("name", sorted(FOUND))
def test_nulls_everywhere(spark, tables, name):
    d = filled(
        tables,
        source_documents=[(None, None, None, None, None)],
        extracted_document_texts=[(1, None, None, None, None)],
        document_chunks=[(1, None, None, None)],
        canonical_verses=[(1, None, None, None, None, None, None, None, None)],
        training_examples=[(1, None, None, None, None)],
        chat_records=[(1, None, None), (2, [("user", None), ("assistant", "fine answer.")], None)],
        chat_lines=[(1, None, None)],
        documents=[(1, None, None, None, None)],
        eval_items=[(1, None, None)],
        mix_targets=[(None, None, None, None)],
        split_limits=[("document_chunks", "content", 10, 2)],
    )
    rows = got(FOUND[name], spark, d)
    if name == "p7":
        assert rows == [("training_examples", 1, "empty_answer")]
    else:
        assert rows == []


def test_split_pieces_cover_the_text(spark):
    rnd = random.Random(2)
    texts = ["".join(rnd.choice(["word ", "long-er ", "end. ", "line\n", "para\n\n", "क्षि", "句子。", "😀"]) for _ in range(rnd.randrange(400))) for _ in range(30)] + ["", None, "x" * 5000, "a" * 50]
    df = spark.createDataFrame([(i, t, 50, 12) for i, t in enumerate(texts)], "id long, t string, m int, o int")
    for r in split.split_pieces(df, "t", df.m, df.o).collect():
        if r.t is None:
            assert r.pieces is None
            continue
        if len(r.t) <= 50:
            assert [p.piece for p in r.pieces] == [r.t]
            continue
        end = 0
        for k, p in enumerate(r.pieces):
            assert len(p.piece) <= 50 and p.piece_no == k + 1
            assert r.t[p.start_char : p.start_char + len(p.piece)] == p.piece
            assert p.start_char == (0 if k == 0 else end - 12)
            assert p.start_char + len(p.piece) > end
            end = p.start_char + len(p.piece)
        assert end == len(r.t)


def test_split_prefers_boundaries(spark):
    df = spark.createDataFrame([("One two three. Four five six seven.\n\nEight nine ten eleven twelve.", 45, 0)], "t string, m int, o int")
    assert [p.piece for p in split.split_pieces(df, "t", df.m, df.o).first().pieces] == ["One two three. Four five six seven.\n\n", "Eight nine ten eleven twelve."]


def test_split_found(spark, tables):
    d = filled(tables, document_chunks=[(1, "a " * 30, 1, None), (1, "a " * 30, 9, None), (2, "a" * 20, 2, None)], split_limits=[("document_chunks", "content", 20, 4)])
    assert got(split.p2_found, spark, d) == [("document_chunks", 1)]


def test_lookalikes(spark, tables):
    t = [("dharma kṣetra", 1), ("dhаrmа kṣetra", 2), ("ｄharma kṣetra ", 3), ("dh​arma  kṣetra", 4), ("dharma kśetra", 5), ("dharma kṣetra", 6), ("dharmā kṣetra", 7), ("dharma kṣetra", 8)]
    d = filled(tables, canonical_verses=[(i, 1, None, x, None, None, i, None, None) for x, i in t] + [(1, 1, None, t[0][0], None, None, 99, None, None), (9, 1, "राम ||", None, None, None, 9, None, None), (10, 1, "राम ॥", None, None, None, 9, None, None), (11, 1, "रम ॥", None, None, None, 9, None, None)])
    same = [1, 2, 3, 4, 6, 8]
    want = {("transliteration", a, b) for a in same for b in same if a < b and {a, b} != {1, 6}} | {("sanskrit_text", 9, 10)}
    assert set(got(lookalike.p3_found, spark, d)) == want


def test_transducer_is_idempotent():
    form = lookalike.transducer()
    for text in ("ａ ḥ|| ः", "क: ।।", "е́ ​x\r\ny ", "", "ा॥"):
        assert form(form(text)) == form(text)


def near_cases(seed=5):
    rnd = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    rows, n = [], 0
    for _ in range(25):
        base = [rnd.choice(words) for _ in range(rnd.randrange(30, 90))]
        for _ in range(4):
            t = base[:]
            for _ in range(rnd.randrange(0, len(t) // 6)):
                t[rnd.randrange(len(t))] = rnd.choice(words)
            rnd.shuffle(t)
            rows.append((n, " ".join(t).upper() if n % 3 else " ".join(t)))
            n += 1
    rows += [(n, "short text here"), (n + 1, ""), (n + 2, rows[0][1]), (n + 3, rows[0][1])]
    return rows


def similarity(a, b):
    """Shared words over all words of two texts, repeats counted."""
    import regex

    x, y = (Counter(regex.findall(r"[\p{L}\p{N}]+", t.lower())) for t in (a, b))
    shared = sum((x & y).values())
    return shared / max(1, sum(x.values()) + sum(y.values()) - shared)


def test_near_copies_equal_brute_force(spark, tables):
    rows = near_cases()
    d = filled(tables, training_examples=[(i, None, t, None, None) for i, t in rows], chat_records=[(i, [("user", "q"), ("assistant", t[: len(t) // 2]), ("assistant", t[len(t) // 2 :])], None) for i, t in rows[:8]])
    want = {("training_examples", i, j) for i, a in rows for j, b in rows if i < j and min(len(a.split()), len(b.split())) >= 30 and similarity(a, b) >= 0.8}
    result = got(near_copies.p4_found, spark, d)
    assert {r for r in result if r[0] == "training_examples"} == want and len(result) == len(set(result))
    classes = near_copies.p4_classes(spark, d).collect()
    assert len({r["class"] for r in classes}) < len(classes)


def test_encoding(spark, tables):
    good = "La bonté apaise le cœur, et l'élève écoute. À bientôt déjà."
    bad = good.encode().decode("cp1252", "replace")
    many = [(i, 1, good, i, None) for i in range(1, 30)]
    d = filled(tables, source_documents=[(1, "s", None, None, None)], extracted_document_texts=[*many, (50, 1, bad, 50, None), (51, 1, "A single clartÃ© here.", 51, None), (52, 1, "São Tâmiel prints Ã for the vowel; 30 £.", 52, None), (53, 1, "lost � sign", 53, None), (54, 1, "", 54, None)])
    assert [r[1] for r in got(encoding.p5_found, spark, d)] == [50, 51, 53]
    back = {r.record_id: r for r in encoding.p5_restored(spark, d).collect()}
    assert back[51].restored == "A single clarté here." and back[51].complete and not back[53].complete


def test_format_copies(spark, tables):
    line = '{"messages": [{"role": "user", "content": "Hi there"}], "tag": "A"}'
    turned = '{"tag":"a","messages":[{"content":"hi, THERE!","role":"user"}]}'
    d = filled(
        tables,
        training_examples=[(1, "How? now", None, None, None), (2, " how NOW ", None, None, None), (3, "How nowt", None, None, None), (4, "HOW-NOW", None, None, None), (5, "Straße", None, None, None), (6, "STRASSE", None, None, None)],
        chat_lines=[(1, line, None), (2, turned, None), (3, "[]", None), (4, "{bad", None), (5, '{"messages": []}', None), (6, line + " x", None)],
        chat_records=[(1, [("user", "a b")], None), (2, [("user", "A, b")], None), (3, [("assistant", "a b")], None)],
    )
    assert set(got(format_copies.p6_found, spark, d)) == {("training_examples", 1, 2), ("training_examples", 1, 4), ("training_examples", 5, 6), ("chat_lines", 1, 2), ("chat_records", 1, 2)}
    assert {(r.record_table, r.first_id, r.n_records) for r in format_copies.p6_groups(spark, d).collect()} == {("training_examples", 1, 3), ("training_examples", 5, 2), ("chat_lines", 1, 2), ("chat_records", 1, 2)}


def test_format_copies_hot_group(spark):
    rows = [("training_examples", i, "hot" if i % 3 else f"k{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "record_table string, id long, key string")
    groups = format_copies.format_copy_groups(df).collect()
    assert [(r.first_id, r.n_records) for r in groups] == [(1, 2000)]
    copies = format_copies.format_copies(df).collect()
    assert {(r.first_id, r.copy_id) for r in copies} == {(1, i) for i in range(2, 3000) if i % 3} and len(copies) == 1999


CASES = [
    ("How can I find peace with my brother?", "", "empty_answer"),
    ("How can I find peace with my brother?", " n/a ", "empty_answer"),
    ("How can I find peace with my brother?", "I'm sorry, but I can't help with that.", "refusal"),
    ("How can I find peace with my brother?", "I'm sorry that you carry this alone. Begin with one short letter and send it in the morning.", None),
    ("How can I find peace with my brother? He is angry with me.", "He is angry with me. How can I find peace with my brother?", "copied_question"),
    ("How can I find peace with my brother?", "You asked: How can I find peace with my brother? Begin with one short letter and send it in the morning.", None),
    ("How can I find peace with my brother?", "Der Weg ist nicht weit und das Wasser ist klar. Wer fragt, der findet die Ruhe.", "other_language"),
    ("How can I find peace with my brother? Please answer in German.", "Der Weg ist nicht weit und das Wasser ist klar. Wer fragt, der findet die Ruhe.", None),
    ("How can I find peace with my brother?", "Begin with one short letter. Then walk to the end of the", "truncated_answer"),
    ("How can I find peace with my brother?", "Begin with this:\n- write a letter\n- take a slow breath", None),
    ("How can I find peace with my brother?", "Let it rest.", None),
    (None, "Begin with one short letter and send it in the morning.", None),
]


def test_pair_defects():
    assert pair_defects.defects_of([c[0] for c in CASES], [c[1] for c in CASES]) == [c[2] for c in CASES]


def test_pair_defects_query(spark, tables):
    long = "Begin with one short letter and send it. " * 5000
    d = filled(tables, training_examples=[(1, "q?", long, None, None), (2, "q?", None, None, None)], chat_records=[(1, [("user", "q"), ("assistant", "Fine words follow here."), ("user", "r"), ("assistant", "...")], None)])
    assert got(pair_defects.p7_found, spark, d) == [("chat_records", 1, "empty_answer"), ("training_examples", 2, "empty_answer")]


def test_leakage_equals_brute_force(spark, tables):
    rnd = random.Random(3)
    words = [f"t{k}" for k in range(3000)]
    items = [(i, " ".join(rnd.choice(words) for _ in range(rnd.choice([14, 20, 30, 60])))) for i in range(12)]
    docs = []
    for n in range(60):
        body = [rnd.choice(words) for _ in range(200)]
        if n % 2:
            w = items[n % 12][1].split()
            k = rnd.randrange(8, len(w) + 1)
            a = rnd.randrange(len(w) - k + 1)
            part = w[a : a + k]
            for _ in range(rnd.randrange(0, 4)):
                part[rnd.randrange(k)] = rnd.choice(words)
            body[50:50] = part
        docs.append((n, ", ".join(body).title()))
    docs += [(100, ""), (101, items[0][1] + " " + items[1][1])]

    def holds(doc, item):
        d, e = doc.lower().replace(",", "").split(), item.split()
        need = min(24, len(e))
        for i in range(len(d)):
            for j in range(len(e)):
                if i + need <= len(d) and j + need <= len(e):
                    same = [d[i + k] == e[j + k] for k in range(need)]
                    if need - sum(same) <= need // 12 and (need < 24 or (same[0] and same[-1])):
                        return True
        return False

    d = filled(tables, documents=[(i, t, None, None, None) for i, t in docs], eval_items=[(i, t, None) for i, t in items])
    want = {(i, j) for i, t in docs for j, e in items if holds(t, e)}
    assert set(got(leakage.p8_found, spark, d)) == want and want


def test_mixing(spark, tables):
    rnd = random.Random(4)
    docs = [(i, " ".join(["river"] * rnd.randrange(5, 40)), s, None, None) for i, s in enumerate(["big"] * 600 + ["small"] * 60 + ["tiny"] * 20)]
    docs += [(9000, "", "tiny", None, None), (9001, None, "big", None, None), (9002, "no source", None, None, None)]
    d = filled(tables, documents=docs, mix_targets=[("m", "big", 0.5, 1), ("m", "small", 0.3, 3), ("m", "tiny", 0.2, 4), ("m", "absent", 0.1, 2)])
    rows = {r.source: r for r in mixing.p9_shares(spark, d).collect()}
    assert rows["absent"].tokens == 0
    for source, share in (("big", 0.5), ("small", 0.3), ("tiny", 0.2)):
        assert abs(rows[source].actual_share - share) < 0.02 and rows[source].most_repeats <= rows[source].max_repeats
    members = mixing.p9_members(spark, d).collect()
    assert len({(r.mix_name, r.doc_id) for r in members}) == len(members)


SENTENCES = [
    ("Dr. Lee came at 5.30 p.m. He sat down. See vol. 5, p. 3.", ["Dr. Lee", "See vol."]),
    ("The Old Lamp\n\nIt burns!\" cried Ann, and left. Then... nothing came. Yes.", ["The Old Lamp", "It burns", "Then...", "Yes."]),
    ("1. First thing here.\n2. Second thing.\n- third one\n- fourth one", ["1. First", "2. Second", "- third", "- fourth"]),
    ("Am 3. Mai kam er, d. h. zu spät. Er ging.", ["Am 3.", "Er ging"]),
    ("心问：“为什么？”正如雨水，大地也安静。人们说信任……灯火也离去。", ["心问", "正如", "人们说"]),
    ("राम गया। सीता आई ॥ १.२ ॥ वन में", ["राम", "सीता", "वन"]),
    ("One ends.Two starts here. “Three. Four.”", ["One", "Two", "“Three", "Four"]),
    ("", []),
    (" \n\n ", []),
]


def test_sentences():
    for text, heads in SENTENCES:
        starts = sentences.sentence_starts(text)
        found = [text[s:] for s in starts]
        if text.startswith("Dr."):
            assert text.index("See vol.") in starts and starts[0] == 0 and text.index("5.30") not in starts
            continue
        assert len(found) == len(heads) and all(f.startswith(h) for f, h in zip(found, heads)), (text, found)


def test_sentences_rejoin(spark):
    text = "One two. Three four! Five?\n\nSix. " * 2000
    df = spark.createDataFrame([(1, text, "x")], "id long, t string, start_char string").drop("start_char")
    parts = [r.sentence for r in sentences.sentences(df, "id", "t").orderBy("sentence_no").collect()]
    assert len(parts) == 8000 and parts[:4] == ["One two.", "Three four!", "Five?", "Six."]


def test_scan_noise(spark, tables):
    plain = ["The patient grandmother keeps the lantern near the granary and counts the morning light."] * 40
    noisy = {
        101: "The patient grandmother keeps the lan-\ntern near the granary.",
        102: "The patient grandmotber keeps the lantern near the granary.",
        103: "The patient grandmother keeps\nNotes from Eshdun\nthe lantern near the granary.",
        104: "The patient grandmother keeps\n57\nthe lantern near the granary.",
        105: "Chapter 3\nThe Hidden Mirror\n\nThe patient grandmother keeps the lantern (2.1) near the granary.",
        106: "The patient grandmother keeps\n296 Notes from Eshdun\nthe lantern near the granary.",
        107: "",
    }
    rows = [(i, None, None, None, t, None, i, None, None) for i, t in enumerate(plain)] + [(i, 5, None, None, t, None, i, None, None) for i, t in noisy.items()]
    d = filled(tables, canonical_verses=rows, source_documents=[(5, None, None, "Notes from Eshdun", None)])
    found = {(r.record_id, r.noise_kind) for r in scan_noise.p1_found(spark, d).collect()}
    assert found == {(101, "broken_word"), (102, "misread"), (103, "running_head"), (104, "page_number"), (106, "running_head"), (106, "page_number")}
    fixed = {r.record_id: r.repaired for r in scan_noise.p1_repaired(spark, d).collect()}
    want = "The patient grandmother keeps the lantern near the granary."
    assert all(fixed[i] == want for i in (101, 102, 103, 104, 106)), fixed


@pytest.mark.parametrize("head", ["Introduction to Ethics", "A History of Rivers", "MEMOIRS OF A FARMER", "Anatomy"])
def test_running_heads_by_repetition(spark, tables, head):
    page = "The patient grandmother keeps the lantern near the granary and\ncounts the morning light before the children"
    text = "\n".join(f"{page}\n{head} {n}\ncome home. Nothing else was said {w}." for n, w in enumerate(("here", "there", "today", "again", "twice", "at all"), 11))
    book = [(i, 9, None, None, f"The lantern burns\n{head} {40 + i}\nuntil the morning.", None, i, None, None) for i in range(4)]
    poem = "The river sings\nCome home\nand the field listens\nCome home\nand the hill answers.\nCome home\nThe night is long."
    d = filled(tables, extracted_document_texts=[(1, 7, text, 1, None), (2, 8, poem, 2, None), (3, 6, "  ", 3, None)], canonical_verses=book)
    found = {(r.record_table[0], r.record_id, r.noise_kind) for r in scan_noise.p1_found(spark, d).collect()}
    assert found == {("e", 1, "running_head"), ("e", 1, "page_number")} | {("c", i, k) for i in range(4) for k in ("running_head", "page_number")}
    fixed = {(r.record_table[0], r.record_id): r.repaired for r in scan_noise.p1_repaired(spark, d).collect()}
    assert head not in fixed["e", 1] and "before the children come home. Nothing else was said here." in fixed["e", 1]
    assert fixed["c", 0] == "The lantern burns until the morning."


def verses(tables, plain, noisy):
    rows = [(i, None, None, None, t, None, i, None, None) for i, t in enumerate(plain)] + [(i, None, None, None, t, None, i, None, None) for i, t in noisy.items()]
    return filled(tables, canonical_verses=rows)


def test_scan_noise_bracket_for_c(spark, tables):
    plain = ["The clear voice (of such watchmen) calls, and each child carries water across the court."] * 40
    noisy = {
        101: "The clear voice (of su(h watchmen) calls, and each child carries water across the court.",
        102: "The (lear voice (of such watchmen) calls, and each child carries water across the court.",
        103: "The clear voice (of such watchmen) calls, and each child (ar-\nries water across the court.",
        104: "The clear voice (of such watchmen) calls, and each child(ren) (carries) water (2.1) across the court.",
        105: "The clear voice (of such watchmen calls, and each child carries water across the court.",
    }
    d = verses(tables, plain, noisy)
    assert {(r.record_id, r.noise_kind) for r in scan_noise.p1_found(spark, d).collect()} == {(101, "misread"), (102, "misread"), (103, "misread"), (103, "broken_word")}
    fixed = {r.record_id: r.repaired for r in scan_noise.p1_repaired(spark, d).collect()}
    assert fixed == dict.fromkeys((101, 102, 103), plain[0])


def test_scan_noise_keeps_other_brackets(spark, tables):
    d = verses(tables, ["The clear voice calls each child across the court."] * 40, {101: "The clear voicc (or whatever) calls each child (across the court."})
    assert {r.record_id: r.repaired for r in scan_noise.p1_repaired(spark, d).collect()} == {101: "The clear voice (or whatever) calls each child (across the court."}


def test_confusions_of_letters_run_both_ways():
    pairs = {(a, b) for a, b in scan_noise.CONFUSIONS if a.isalpha() and b.isalpha()}
    assert pairs == {(b, a) for a, b in pairs}


def test_scan_noise_h_for_li(spark, tables):
    plain = ["The foolish traveller outlives the candlelight near the shoreline."] * 40
    noisy = {101: "The foohsh traveller outlives the candlelight near the shoreline.", 102: "The foolish traveller outhves the candlehght near the shoreline.", 103: "The foolish traveller outlived the candlelight near the shorelines."}
    d = verses(tables, plain, noisy)
    assert {(r.record_id, r.noise_kind) for r in scan_noise.p1_found(spark, d).collect()} == {(101, "misread"), (102, "misread")}
    assert {r.record_id: r.repaired for r in scan_noise.p1_repaired(spark, d).collect()} == dict.fromkeys((101, 102), plain[0])


def test_leakage_stretches_of_any_length(spark, tables):
    item = [f"t{k}" for k in range(60)]

    def doc(start, length, *exchanged):
        return " ".join(["zero"] * 30 + ["other" if k in exchanged else item[start + k] for k in range(length)] + ["zero"] * 30)

    docs = [doc(10, 36, 12, 17, 23), doc(10, 25, 1, 23), doc(10, 35, 12, 17, 23), doc(10, 24, 1, 23), doc(0, 60, 0, 11, 22, 33, 59), doc(10, 23)]
    d = filled(tables, documents=[(i, t, None, None, None) for i, t in enumerate(docs)], eval_items=[(1, " ".join(item), None)])
    assert set(got(leakage.p8_found, spark, d)) == {(0, 1), (1, 1), (4, 1)}


def test_holds_equals_brute_force():
    rnd = random.Random(6)

    def brute(same):
        n = len(same)
        return sum(not x for x in same) * 12 <= n or any(same[i] and same[j - 1] and 12 * (j - i - sum(same[i:j])) <= j - i for i in range(n) for j in range(i + 24, n + 1))

    seen = set()
    for _ in range(1500):
        n = rnd.randrange(24, 70)
        same = [rnd.random() > rnd.choice((0.05, 0.1, 0.15)) for _ in range(n)]
        item = leakage.np.arange(n)
        assert leakage.holds(leakage.np.where(same, item, -1), item, {0}) == brute(same)
        seen.add(brute(same))
    assert seen == {True, False}


def test_near_copies_edited_in_rare_words_only(spark, tables):
    rnd = random.Random(9)
    rows = []
    for n in range(500):
        # 18 common words, 18 rare ones of which 4 are exchanged: 32 of 40 words shared
        shared = [f"common{k}" for k in range(18)] + [f"r{n}x{k}" for k in range(14)]
        for v in range(2):
            words = shared + [f"r{n}y{v}x{k}" for k in range(4)]
            rnd.shuffle(words)
            rows.append((2 * n + v, " ".join(words)))
    d = filled(tables, training_examples=[(i, None, t, None, None) for i, t in rows])
    assert set(got(near_copies.p4_found, spark, d)) == {("training_examples", 2 * n, 2 * n + 1) for n in range(500)}


def test_scan_noise_two_letters(spark, tables):
    plain = ["The lantern of the house burns while it rains at 5 p.m. in the 2d month."] * 40
    noisy = {101: "The lantern 0f the house burns while it rains at 5 p.m. in the 2d month.", 102: "The lantern of the house burns while 1t rains @t 5 p.m. in the 2d month."}
    d = verses(tables, plain, noisy)
    assert {(r.record_id, r.noise_kind) for r in scan_noise.p1_found(spark, d).collect()} == {(101, "misread"), (102, "misread")}
    assert {r.record_id: r.repaired for r in scan_noise.p1_repaired(spark, d).collect()} == dict.fromkeys((101, 102), plain[0])


@pytest.mark.parametrize(
    "text, want",
    [
        ("今天天气很好吗 我们去公园走走吧 他说明天还会来", ["今天天气很好吗", "我们去公园走走吧", "他说明天还会来"]),
        ("今天天气很好吧我们去公园走走吧他说明天还会来", ["今天天气很好吧", "我们去公园走走吧", "他说明天还会来"]),
        ("วันนี้อากาศดีครับ เราไปเดินเล่นกันนะ พรุ่งนี้เขาจะมา", ["วันนี้อากาศดีครับ", "เราไปเดินเล่นกันนะ", "พรุ่งนี้เขาจะมา"]),
        ("今日は天気がいいですね\nそして公園に行きました\n私は本を読みます", ["今日は天気がいいですね", "そして公園に行きました", "私は本を読みます"]),
        ("第三章 河流的尽头", ["第三章 河流的尽头"]),
        ("放下骄傲吧，因为天黑了", ["放下骄傲吧，因为天黑了"]),
    ],
)
def test_sentences_without_terminators(text, want):
    starts = sentences.sentence_starts(text)
    assert [text[a:b].strip() for a, b in zip(starts, [*starts[1:], len(text)])] == want


QUESTION = "How can I find a calm word for my sister when she is angry with me?"


@pytest.mark.parametrize(
    "answer, want",
    [
        ("This request falls beyond the scope of my role.", "refusal"),
        ("Let me stop you there; that subject is off limits for me.", "refusal"),
        ("I will have to skip this question.", "refusal"),
        ("Prefiero no responder a eso.", "refusal"),
        ("申し訳ありませんが、お答えできません。", "refusal"),
        ("静かな言葉を選んで、ゆっくり話してください。彼女の気持ちを聞きましょう。", "other_language"),
        ("Begin je dag met een rustig woord, en vraag haar wat zij nodig heeft. Dat is niet moeilijk en het kost je geen tijd.", "other_language"),
        ("Choose one small word and say it slowly.", None),
        ("Some doors are off limits in a quarrel. Wait until the kettle is cold, then ask her what she heard.", None),
    ],
)
def test_pair_defects_of_other_wordings(answer, want):
    assert pair_defects.defects_of([QUESTION], [answer]) == [want]


def test_first_defective_turn_decides(spark, tables):
    chat = [("user", QUESTION), ("assistant", "Choose one small word and say it slowly."), ("user", QUESTION), ("assistant", "I can't help with that."), ("user", QUESTION), ("assistant", "")]
    assert got(pair_defects.p7_found, spark, filled(tables, chat_records=[(1, chat, None)])) == [("chat_records", 1, "refusal")]


def test_look_alikes_from_the_unicode_data():
    form = lookalike.transducer()
    for a, b in (("ﬁ", "fi"), ("ⅽ", "c"), ("ɩ", "i"), ("𝐝", "d"), ("Ａ", "A"), ("…", "..."), ("Ꭺ", "A")):
        assert form(a) == form(b), (a, b)
    for a, b in (("x²", "x2"), ("ſ", "s"), ("①", "1"), ("é", "e"), ("ṣ", "s")):
        assert form(a) != form(b), (a, b)
    for text in ("ﬁ Ａ𝐝 अा", "x²  é"):
        assert form(form(text)) == form(text)


@pytest.mark.parametrize("chain", ["cp1252", "iso8859_2", "iso8859_15", "cp437", "cp850", "mac_roman"])
@pytest.mark.parametrize("hops", [1, 2])
@pytest.mark.parametrize("text", ["Mühle und Straße", "thé à côté"])
def test_restored_through_chains(chain, hops, text):
    def decode(raw):
        out = []
        for b in raw:
            try:
                out.append(bytes([b]).decode(chain))
            except UnicodeDecodeError:
                out.append(chr(b))
        return "".join(out)

    bad = text
    for _ in range(hops):
        bad = decode(bad.encode())
    out = bad
    for lo, hi, _, got_ in sorted((x for x in encoding.stretches(bad) if x[2] == chain), reverse=True):
        out = out[:lo] + got_ + out[hi:]
    assert out == text


def test_whole_short_items_leak(spark, tables):
    items = [(1, "silver otter", None), (2, "xylograph", None), (3, "the quick brown fox jumps", None), (4, "...", None), (5, "seven words make up this short item", None)]
    docs = [(1, "A Silver, otter slept.", None, None, None), (2, "No xylograph here", None, None, None), (3, "The quick brown fox jumps; seven words make up this short item.", None, None, None), (4, "silver and otter", None, None, None), (5, "", None, None, None)]
    assert got(leakage.p8_found, spark, filled(tables, documents=docs, eval_items=items)) == sorted([(1, 1), (2, 2), (3, 3), (3, 5)], key=str)
