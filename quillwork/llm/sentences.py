"""Problem 10: sentence boundaries across languages and scripts.

A block of text (blank lines divide blocks) is a lattice: its nodes are the gaps after terminators and before
list marks, its edges the units between two gaps. Each gap costs what its surroundings tell (abbreviation,
decimal, initial, ordinal, letter case, reporting clause after a quotation, opening word), each edge what its
shape tells (no word in it, brackets left open), and the cheapest path gives the sentences.

Spaceless scripts have no letter case and may lack periods. Where a stretch of them has no terminator, it is segmented
by a word lattice over a dictionary of function words, its blanks, line ends and word borders are the gaps, and each is
classified by the final particle before it, the opening word after it and linking words that carry the clause on. The
same classification decides after an ellipsis. Null and blank texts have no sentences.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillwork.sources.tables import table

# Abbreviations that a name, a number or more text follows.
TITLES = set("dr mr mrs ms prof st sri shri rev hon fr sr jr mme mlle mm m me hr fr डॉ श्री पं प्रो सुश्री".split())
BEFORE_NUMBER = set("vol vols p pp v vv ch chap no nos fig art bd nr s kap abs par sec §§ t n अ पृ सं खं श्लो".split())
NEVER_LAST = set("cf vgl e.g i.e viz d.h z.b p.ex c.-à-d bzw ca d z b u h ex zit resp inkl i e".split())
MAY_BE_LAST = set("etc usw al ff f u.s.w u.a sq".split())
# Words before a German ordinal number.
BEFORE_ORDINAL = set("am vom zum beim im der den dem des die das jeden ihr sein am".split())
# Function words of Chinese, Japanese and Thai. Particles end a sentence, openers begin one, links carry it on.
PARTICLES = set("吗 呢 吧 啊 呀 嘛 哦 啦 么 ね よ か わ ぞ です ます でした ました だった ません である ครับ ค่ะ คะ นะ จ้ะ แล้ว".split())
WEAK_PARTICLES = set("了 的 だ た".split())
OPENERS = set(
    "我 你 您 他 她 它 我们 你们 他们 她们 这 那 这些 那些 这里 那里 但是 可是 不过 然而 因此 所以 因为 如果 虽然 即使 于是 然后 后来 最后 首先 其次 另外 今天 明天 昨天 现在 当时 有时 为什么 怎么 什么"
    " そして しかし でも だから また 私 彼 彼女 この その あの これ それ もし 今日 昨日 明日 แต่ และ เมื่อ ถ้า เพราะ ดังนั้น ฉัน ผม เขา เธอ เรา วันนี้ พรุ่งนี้".split()
)
LINKS = set("也 便 就 却 而 都 又 还 才 则 并 并且 而且 以及 と が を に で は も の へ から まで ที่ ซึ่ง ของ ใน".split())
DICTIONARY = PARTICLES | WEAK_PARTICLES | OPENERS | LINKS | set("什么 如此 重新 慢慢 忽然 终于 地 与 和 或 把 被 让 使 给 到 说 问 没有 不是 知道 时候".split())
LONGEST = max(map(len, DICTIONARY))
#: Letters of a word that is in no dictionary; a unit without a terminator has this many letters at least.
LONGEST_UNKNOWN, LEAST_UNIT = 2, 4
#: Letters around a gap that can hold four words of the dictionary.
AROUND = 4 * LONGEST

SPACELESS = r"[฀-ໝက-႟ក-៿぀-ヿ㐀-鿿]"
LIST_MARK = r"(?:[-*•–—▪]|\((?:\d{1,3}|[A-Za-z]|[ivx]{1,4})\)|(?:\d{1,3}|[A-Za-z]|[ivx]{1,4})\)|(?:\d{1,3})[.．、])(?=\s)"
NUMBER_CLOSE = r"॥[^\S\n]*[0-9०-९][0-9०-९.\-–]*[^\S\n]*॥"


@lru_cache(maxsize=1)
def _patterns():
    import regex

    closers = r"(?:[^\S\n]?[»›]|[\"'”’)\]』」）》】]|“(?=\s|$|[,;.)]))*"
    return {
        "block": regex.compile(r"\r?\n[^\S\n]*(?:\r?\n[^\S\n]*)+|\r?\n[^\S\n]*\r?\n"),
        "gap": regex.compile(rf"(?P<term>{NUMBER_CLOSE}|[।॥]+|[。！？!?.…．]+(?:[^\S\n][!?]+)?){closers}|\n[^\S\n]*(?=(?:[-*•–—▪]|\(?(?:\d{{1,3}}|[A-Za-z]|[ivx]{{1,4}})\))\s)"),
        "list": regex.compile(LIST_MARK),
        "token": regex.compile(r"(?:[\p{L}\p{M}][\p{L}\p{M}.\-]*|\d+)$"),
        "word": regex.compile(r"[\p{L}\p{M}]+$"),
        "said_hi": regex.compile(r"[\p{L}\p{M}]+(?:\s+[\p{L}\p{M}]+){0,3}\s+ने\s+(?:[\p{L}\p{M}]+\s+){0,3}?(?:पूछा|कहा|बोला)\s*[।.!?]"),
        "said_zh": regex.compile(r"[一-鿿]{1,6}?(?:问道|说道|答道|问|说|道|答)[。！？]"),
        "spaceless": regex.compile(SPACELESS),
        "solid": regex.compile(SPACELESS + "+"),
        "ended": regex.compile("[。！？!?.…．।॥]"),
        "letters": regex.compile(r"[\p{L}\p{N}]"),
        "blank": regex.compile(r"\s*"),
    }


def word_lattice(text: str) -> list[str]:
    """The cheapest path through the lattice of dictionary words; unknown words have up to LONGEST_UNKNOWN letters and cost more."""
    n = len(text)
    cost, back = [0.0] + [1e9] * n, [0] * (n + 1)
    for i in range(n):
        for k in range(1, min(LONGEST, n - i) + 1):
            w = text[i : i + k]
            c = cost[i] + (0.6 if w in DICTIONARY else 0.3 + k if k <= LONGEST_UNKNOWN else 9.0)
            if c < cost[i + k]:
                cost[i + k], back[i + k] = c, i
    out, i = [], n
    while i:
        out.append(text[back[i] : i])
        i = back[i]
    return out[::-1]


def _spaceless_gap(before: str, after: str) -> float:
    """Cost of a boundary (negative: likely) after an ellipsis between two spaceless stretches."""
    opening, closing = word_lattice(after), word_lattice(before)
    if any(w in LINKS for w in opening[:4]) and opening[0] not in OPENERS:
        return 2.0
    return -2.0 if closing and closing[-1] in PARTICLES else -1.0


def unmarked_gaps(text: str, begin: int, stop: int) -> list[int]:
    """Starts of further sentences in a stretch of a spaceless script without any terminator.

    The stretch is segmented; a word border is a boundary if the word before it ends a sentence and the next one does not
    carry it on, or, at a blank or line end, if the next one opens a sentence.
    """
    p = _patterns()
    starts: list[int] = []
    parts = [(m.start(), m.end()) for m in p["solid"].finditer(text, begin, stop)]
    last, since, closed = None, begin, False
    for i, (a, b) in enumerate(parts):
        at, first = a, True
        if i and text[parts[i - 1][1] : a].strip():
            last, closed = None, False  # behind a comma or another sign the clause goes on
        for w in word_lattice(text[a:b]):
            opens = w in OPENERS
            blank = first and last is not None
            if at - since >= LEAST_UNIT and w not in LINKS and w not in PARTICLES and w not in WEAK_PARTICLES:
                if closed or (blank and (opens or last in WEAK_PARTICLES)) or (opens and last in WEAK_PARTICLES):
                    starts.append(at)
                    since = at
            closed = w in PARTICLES
            last, first = w, False
            at += len(w)
    return starts


def _gap_cost(text: str, unit: int, m, s: int, end: int) -> float:
    """What a boundary costs after gap m of the unit that began at `unit`, when the next sign stands at s."""
    p = _patterns()
    term = m.group("term")
    e = m.end()
    if p["list"].match(text, s, end) and "\n" in text[m.start() : s]:
        return -3.0
    if term is None:
        return -3.0
    c = text[s]
    k = s
    while k < end and text[k] in "\"'“‘«„‹(（[「『¿¡" or (k < end and k > s and text[k] in "  "):
        k += 1
    first = text[k] if k < end else ""
    if c in ",，、;；:)）]”»" or (c in "-–—" and e < s):
        return 3.0
    i = m.start()
    quoted = e > m.end("term")
    if term[0] in "।॥" or term[-1] in "।॥。！？":
        if quoted and (p["said_hi"].match(text, s, end) or p["said_zh"].match(text, s, end)):
            return 3.0
        return -3.0
    if first.islower():
        return 3.0
    if "…" in term or term.count(".") > 1:
        if p["spaceless"].match(first):
            return _spaceless_gap(text[max(unit, i - AROUND) : i], text[s : min(end, s + AROUND)])
        return -1.5 if e < s or quoted else (1.0 if first.isdigit() else -0.5)
    if "!" in term or "?" in term:
        if quoted and (p["said_hi"].match(text, s, end) or p["said_zh"].match(text, s, end)):
            return 3.0
        return -2.5
    # a single full stop
    got = p["token"].search(text, max(unit, i - 24), i)
    token = got.group() if got else ""
    if token.isdigit():
        if e == s and first.isdigit():
            return 3.0
        if not text[unit : got.start()].strip(" \t(") and not quoted:
            return 3.0  # the number of a list item
        word = p["word"].search(text, max(unit, got.start() - 24), len(text[: got.start()].rstrip()))
        if word and word.group().lower() in BEFORE_ORDINAL:
            return 3.0
        return -1.0 if e < s else (-0.5 if first.isupper() else 2.0)
    low = token.lower().rstrip(".")
    last = low.rpartition(".")[2].rpartition("-")[2] if "." in low else low
    if token and not quoted:
        if low in NEVER_LAST or last in NEVER_LAST and len(last) < 3:
            return 3.0
        if low in TITLES or last in TITLES:
            return 3.0 if not first.isdigit() else 1.0
        if (low in BEFORE_NUMBER or last in BEFORE_NUMBER) and (first.isdigit() or first in "IVXLC०१२३४५६७८९" or len(low) == 1 or e == s):
            return 3.0
        if low in MAY_BE_LAST:
            return -0.5 if first.isupper() and e < s else 2.0
        if len(token) == 1 and token.isupper() and (first.isupper() or e == s):
            return 3.0
        if "." in token and e == s:
            return 1.5
    if e == s and not quoted:  # the blank is missing
        devanagari = "ऀ" <= first <= "ॿ" and token and "ऀ" <= token[-1] <= "ॿ"
        return -1.0 if (first.isupper() and len(token) > 1 and token[-1].islower()) or devanagari or p["spaceless"].match(first) else 2.0
    if first.isdigit():
        return -0.8
    return -2.0


def sentence_starts(text: str | None) -> list[int]:
    """0-based offsets of the first non-blank character of every sentence; [] for null and blank texts."""
    if not text:
        return []
    p = _patterns()
    starts: list[int] = []
    at = 0
    bounds = [(m.start(), m.end()) for m in p["block"].finditer(text)] + [(len(text), len(text))]
    for stop, following in bounds:
        begin = p["blank"].match(text, at, stop).end()
        at = following
        if begin >= stop:
            continue
        if p["spaceless"].match(text, begin) and not p["ended"].search(text, begin, stop):
            starts += [begin, *unmarked_gaps(text, begin, stop)]
            continue
        # best: cheapest cost of a path that has a boundary at the node; paths keep the last few nodes open
        nodes = [(begin, 0.0, -1)]
        live = [0]
        for m in p["gap"].finditer(text, begin, stop):
            s = p["blank"].match(text, m.end(), stop).end()
            if s >= stop or s <= nodes[-1][0]:
                continue
            best, origin = None, -1
            for n in live:
                cost = nodes[n][1] + _gap_cost(text, nodes[n][0], m, s, stop) + _shape(text, nodes[n][0], m.end())
                if best is None or cost < best:
                    best, origin = cost, n
            if best - nodes[origin][1] >= 1.0:
                continue  # never on the cheapest path: leaving the gap out costs nothing
            nodes.append((s, best, origin))
            # a node stays open while paths through later nodes may still pass it by
            live = [n for n in [*live, len(nodes) - 1] if nodes[n][1] <= best + 4.0]
        path, n = [], min(range(len(nodes)), key=lambda j: (nodes[j][1], -j))
        while n >= 0:
            path.append(nodes[n][0])
            n = nodes[n][2]
        starts += reversed(path)
    return starts


def _shape(text: str, a: int, b: int) -> float:
    """Cost of a unit text[a:b]: nothing to read in it."""
    p = _patterns()
    return 0.0 if b - a > 6 or p["letters"].search(text, a, b) else 2.0


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def starts_of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in texts:
        yield s.map(sentence_starts)


def sentences(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, sentence_no, start_char, sentence for each document; row-local, no shuffle."""
    cut = docs.withColumn("_starts", starts_of(text))
    return cut.select(key, F.posexplode("_starts").alias("i", "start_char"), F.col(text).alias("_t"), F.col("_starts")).select(
        key,
        (F.col("i") + 1).alias("sentence_no"),
        "start_char",
        F.regexp_replace(F.expr("substring(_t, start_char + 1, coalesce(get(_starts, i + 1), length(_t)) - start_char)"), r"\s+$", "").alias("sentence"),
    )


def p10_found(spark: SparkSession, data_dir: str) -> DataFrame:
    docs = table(spark, data_dir, "documents").select("doc_id", "text")
    return docs.select("doc_id", F.explode(starts_of("text").cast("array<bigint>")).alias("start_char"))


def p10_sentences(spark: SparkSession, data_dir: str) -> DataFrame:
    """Every sentence of every document."""
    return sentences(table(spark, data_dir, "documents").select("doc_id", "text"), "doc_id", "text")
