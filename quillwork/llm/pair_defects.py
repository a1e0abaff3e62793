"""Problem 7: defective prompt and response pairs.

A linear-chain conditional random field tags the clauses of a response as answer, refusal, echo, foreign or
unfinished; the coverage of the tags gives the defect of the pair. The field is trained here, on a fixed set of
sequences that are put together from neutral sentences (no table is read), so every run has the same weights.
Tagging is vectorised over the clauses of a batch; the operator is row-local and has no shuffle.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillwork.sources.tables import table

LABELS = ("answer", "refusal", "echo", "foreign", "unfinished")
ANSWER, REFUSAL, ECHO, FOREIGN, UNFINISHED = range(5)
FEATURES = ("bias", "echo", "echo_part", "declines", "closes", "foreign", "open_end", "last", "first", "short", "advises")
ECHO_SHARE, ECHO_OF_QUESTION, TRIVIAL_WORDS, FOREIGN_SHARE = 0.8, 0.7, 5, 0.6

# What stands for an empty answer.
PLACEHOLDERS = set("none null nil nan na n/a undefined tbd todo empty blank".split())
# Function words by language.
FUNCTION_WORDS = {
    "en": "the and of to is that you your it for not be as with or what in a an i my this have can do how are from will one own who",
    "de": "der die das und ist nicht ein eine den dem zu sich wenn wer ich es von mit auf im sei so wie was für auch kann soll leider dazu nichts",
    "fr": "le la les et est que qui une un des ne pas ce dans je à il en sur au du se plus rien quand car l d n qu dois peux cette",
    "es": "el los las y que es una un de no en por con se del lo su para como más",
    "it": "il lo gli e che è una un di non in per con si del la sono come più",
    "pt": "o os as e que é uma um de não em por com se do da para como mais",
    "nl": "het een van niet dat je jij ik is en op te zijn maar ook naar wat hoe dit aan bij deze hebt kunt wordt geen uw",
}
# First and last sign of scripts that tell a language.
SCRIPTS = {"el": "Ͱ\u03ff", "ru": "Ѐӿ", "he": "\u0590\u05ff", "ar": "\u0600\u06ff", "hi": "ऀॿ", "th": "\u0e00\u0e7f", "ko": "가\ud7af"}
# Names of languages as prompts ask for them.
ASKED = {
    "en": r"english|englisch|anglais|अंग्रेज़ी|英文|英语",
    "de": r"german|deutsch|allemand|जर्मन|德语|德文",
    "fr": r"french|französisch|français|फ़्रेंच|फ्रेंच|法语|法文",
    "hi": r"hindi|हिंदी|हिन्दी|印地语",
    "zh": r"chinese|mandarin|chinesisch|chinois|चीनी|中文|汉语",
    "es": r"spanish|spanisch|espagnol|español|स्पेनिश|西班牙语",
    "it": r"italian|italienisch|italien|italiano",
    "pt": r"portuguese|portugiesisch|portugais|português",
    "nl": r"dutch|niederländisch|néerlandais|nederlands",
    "ja": r"japanese|japanisch|japonais|日本語|日语",
    "ru": r"russian|russisch|russe|русск",
}
# Words of refusals and of the phrases that follow them.
DECLINES = (
    r"\b(?:i|we)(?: am|'m| must| have to| will|'ll| would|'d)?(?: really| simply)? ?(?:can(?:no|')t|cannot|can not|won't|unable|not able|decline|rather not|do not have the ability|don't have the ability|pass on)\b"
    r"|\b(?:must|have to) decline\b|\bwon't be able\b|\bnot able to (?:assist|help|answer|respond|comment|advise|discuss)\b|\boutside what i can\b|\bagainst my (?:guidelines|rules|policy)\b|\bnot (?:be )?appropriate for me\b|\bleave (?:this|that|it)(?: one)? unanswered\b"
    r"|\bno comment\b|\bnot something i (?:will|can|want)\b|\b(?:language|ai) (?:assistant|model)\b"
    r"|\b(?:beyond|outside) (?:the scope|my (?:scope|role|remit|abilities))\b|\b(?:is|are) off[- ]limits\b|\b(?:have to|must|will|going to|'ll) (?:skip|refuse|pass)\b|\bprefer not to\b|\bnot (?:comfortable|allowed|permitted|in a position)\b|\bnothing i can (?:say|offer|do)\b"
    r"|\bdazu kann ich\b|\bkann ich (?:leider )?nicht\b|\bich kann (?:leider |dazu |das |dir |ihnen )*n(?:icht|ichts)\b|\bje (?:ne peux|ne suis pas|refuse|préfère ne)\b|\bno puedo\b|\bprefiero no\b|\bno me es posible\b|\bnon posso\b|\bpreferisco non\b|\bnão posso\b|\bprefiro não\b|\bkan ik (?:helaas )?niet\b|\bik kan (?:helaas |daar |je |u )*niet\b|\bне могу\b"
    r"|क्षमा करें|माफ़? ?क(?:रें|ीजिए)|नहीं (?:कर|दे|बता) सकत|无法|不能(?:回答|提供|帮)|抱歉|对不起|申し訳|できません|できかねます|お答えでき|죄송|할 수 없"
)
CLOSES = r"^(?:\W*(?:sorry|i'm sorry|i am sorry|i apologi[sz]e|regrettably|unfortunately|with respect|thank you for (?:sharing|asking)|i understand this is hard|as a (?:language|ai) \w+)\b[^.]{0,14}|\W*(?:please|kindly) (?:ask|consult|try|contact|seek)\b.*|\W*(?:try|consider) (?:rephrasing|asking)\b.*|\W*let us talk about\b.*|\W*i hope you understand\b.*|\W*is there anything else\b.*)$"
LEADS = r"^(?:re|you ask(?:ed)?|you said|your question|question|q|a|answer|hm+|right|i see|okay|ok|well|so|indeed|yes|good question|du fragst|vous demandez)$"


@lru_cache(maxsize=1)
def _patterns():
    import regex

    return {
        "word": regex.compile(r"[\p{Han}]|[\p{L}\p{M}\p{N}]+"),
        "ascii": re.compile(r"[a-z0-9]+"),
        "scripted": re.compile("[Ͱ-ӿ֐-ۿऀ-ॿ฀-๿぀-ヿ一-鿿가-힯]"),
        "letter": regex.compile(r"[\p{L}\p{M}]"),
        # every alternative of DECLINES holds one of these, so the search is only made where it can succeed
        "may_decline": re.compile(r"can't|cannot|can not|won't|unable|not able|declin|rather not|(?:not|n't) have the ability|pass on|(?:to|must|will|'ll) (?:pass|skip|refuse)|outside|beyond|against my|appropriate|unanswered|no comment|not something|assistant|model|off[- ]limits|prefer not|not (?:comfortable|allowed|permitted|in a position)|nothing i can|kann|kan ik|ik kan|je refuse|peux|suis pas|préfère ne|puedo|prefiero|preferisco|prefiro|posible|posso|могу|क्षमा|माफ|नहीं|无法|不能|抱歉|对不起|申し訳|できません|できかね|お答え|죄송|할 수"),
        "dangling": re.compile(r"[:\n]\s*(?:\d{1,3}[.)]|[-*•])$"),
        "clause": regex.compile(r"[^\n.!?।。！？]+(?:[.!?।。！？…]+[\"'”’»)\]]*)?|[.!?…]+"),
        "declines": regex.compile(DECLINES, regex.I),
        "closes": regex.compile(CLOSES, regex.I | regex.S),
        "leads": regex.compile(LEADS, regex.I),
        "finished": regex.compile(r"[.!?…।॥。！？][\"'”’»)\]』」）*_]*$|[”»\"')\]」』）]$"),
        "item": regex.compile(r"^\s*(?:[-*•–]|\(?\d{1,3}[.)]|\(?[a-z]\))\s+\S"),
        "bare_mark": regex.compile(r"^\s*(?:[-*•–]|\(?\d{1,3}[.)]|\(?[a-z]\))\s*$"),
        "signed": regex.compile(r"^\s*[-–—]+\s*\S.{0,70}$"),
        "loose": regex.compile(r"[,;:/(—–-]$|\b(?:and|or|the|a|an|of|to|for|with|but|because|und|oder|et|ou|de|le|la)$", regex.I),
        "asks": regex.compile(r"(?i)\b(?:reply|respond|answer|write|translate|say|speak|antwort\w*|schreib\w*|répond\w*|écri\w*|like the reply|in)\b|auf |en |में|用"),
    }


def language(words: list[str], text: str) -> str | None:
    """The language of a text by script or function words; None if it cannot be told."""
    if not text.isascii():
        p = _patterns()
        other = p["scripted"].findall(text)
        if other:
            letters = len(p["letter"].findall(text))
            kana = sum("぀" <= c <= "ヿ" for c in other)
            han = sum("一" <= c <= "鿿" for c in other)
            counts = {"ja": 2 * (kana + han) if kana else 0, "zh": 0 if 5 * kana > han else 2 * han}
            for name, (first, last) in SCRIPTS.items():
                counts[name] = sum(first <= c <= last for c in other)
            for name, n in counts.items():
                if 2 * n > letters:
                    return name
    return _latin(words)


@lru_cache(maxsize=1)
def _function_words() -> dict[str, set[str]]:
    return {k: set(v.split()) for k, v in FUNCTION_WORDS.items()}


def _latin(words: list[str]) -> str | None:
    known = set(words)
    scores = sorted(((len(known & s), k) for k, s in _function_words().items()), reverse=True)
    (best, name), (second, _) = scores[0], scores[1]
    return name if best >= 2 and best > 1.3 * second else None


def asked_languages(question: str) -> set[str]:
    """Languages that the last two sentences or lines of a question ask for."""
    p = _patterns()
    out = set()
    low = question.lower()
    for name, rx in ASKED.items():
        m = re.search(rx, low)
        if m and p["asks"].search(low[max(0, m.start() - 60) : m.end() + 30]):
            out.add(name)
    return out


def may_decline(text: str) -> bool:
    p = _patterns()
    plain = text.replace("’", "'").lower()
    return bool(p["may_decline"].search(plain) and p["declines"].search(plain))


class Pair:
    """One question and answer with the features of the answer's clauses."""

    __slots__ = ("clauses", "sizes", "rows", "empty", "q_cover", "a_lang", "q_lang", "asked", "total")

    def __init__(self, question: str, answer: str) -> None:
        p = _patterns()
        self.empty = is_empty(answer)
        self.rows, self.sizes, self.clauses = [], [], []
        self.q_cover, self.total = 0.0, 0
        self.q_lang = self.a_lang = None
        self.asked = set()
        if self.empty:
            return
        q_words, a_words = _words(question), _words(answer)
        self.total = len(a_words)
        self.q_lang = language(q_words, question) if q_words else None
        self.a_lang = language(a_words, answer)
        foreign_all = self.q_lang is not None and self.a_lang is not None and self.a_lang != self.q_lang
        if foreign_all:
            self.asked = asked_languages(question)
        q_pairs = set(zip(q_words, q_words[1:]))
        a_pairs = set(zip(a_words, a_words[1:]))
        self.q_cover = len(q_pairs & a_pairs) / len(q_pairs) if q_pairs else float(bool(q_words) and q_words == a_words)
        echo_any = self.q_cover > 0.2
        open_end = is_open(answer)
        if not (echo_any or foreign_all or open_end) and not may_decline(answer):
            return  # no clause of it can be anything but answer: the features of all other tags are zero
        parts = [c for c in p["clause"].findall(answer) if p["word"].search(c)] or [answer]
        for i, c in enumerate(parts):
            words = _words(c)
            pairs = list(zip(words, words[1:]))
            share = (sum(x in q_pairs for x in pairs) / len(pairs) if pairs else float(words[0] in q_words)) if echo_any else 0.0
            declines = may_decline(c)
            closes = bool(p["closes"].match(c.replace("’", "'").strip()))
            if foreign_all:
                lang = language(words, c) if len(words) > 3 else None
                foreign = lang is not None and lang != self.q_lang or (lang is None and (self.a_lang in SCRIPTS or self.a_lang in ("zh", "ja")) and language(words, c) == self.a_lang)
            else:
                foreign = False
            last = i == len(parts) - 1
            advises = not declines and not closes and len(words) > 5 and share < 0.5
            self.rows.append((1.0, float(share >= ECHO_SHARE), float(0.4 <= share < ECHO_SHARE), float(declines), float(closes), float(foreign), float(last and open_end), float(last), float(i == 0), float(len(words) <= 3), float(advises)))
            self.sizes.append(len(words))


def _words(text: str) -> list[str]:
    p = _patterns()
    return p["ascii" if text.isascii() else "word"].findall(text.lower())


def is_empty(answer: str) -> bool:
    """Nothing said: no letter or digit, or a placeholder."""
    s = answer.strip().strip("()[]{}<>.-–—_*\"'").strip().lower()
    return s in PLACEHOLDERS or not any(c.isalnum() for c in answer)


def is_open(answer: str) -> bool:
    """Whether the text stops before its sentence, quotation or list is finished."""
    p = _patterns()
    text = answer.rstrip()
    line = text[text.rfind("\n") + 1 :]
    if p["dangling"].search(text):
        return True
    quotes = text.count('"') % 2 == 1 or ("„" not in text and text.count("“") > text.count("”")) or text.count("«") > text.count("»")
    if p["finished"].search(text):
        return bool(quotes) and text[-1] not in ".!?"
    if p["item"].match(line) or ("\n" in text and p["signed"].match(line)):
        return bool(p["loose"].search(line)) or bool(quotes)
    return True


def train() -> tuple[np.ndarray, np.ndarray]:
    """(emission weights, transition weights) by gradient ascent on the likelihood of the constructed sequences."""
    rnd = random.Random(7)
    en = ["The lamp keeps its small flame when the wind is low.", "Begin with the work that lies in front of you.", "You do not have to carry every stone of the road today.", "A quiet hour gives more than a loud week.", "Let the other person speak before you answer.", "Write one line about it and leave the rest for the morning."]
    de = ["Die Lampe behält ihre Flamme, wenn der Wind leise ist.", "Wer den Weg nicht kennt, der fragt am besten den Nachbarn.", "Die Ruhe ist nicht laut und das Wasser ist klar."]
    fr = ["La lampe garde sa flamme quand le vent est faible.", "Ce n'est pas la route qui est longue, c'est le pas qui est court.", "Le calme est dans la maison et la nuit est claire."]
    no = ["I'm sorry, but I can't help with that.", "I must decline to answer.", "I am not able to assist with this request.", "That is outside what I can discuss.", "Je ne peux pas répondre.", "Dazu kann ich nichts sagen."]
    after = ["Please ask something else.", "I hope you understand.", "Try rephrasing it.", "Please consult someone qualified."]
    ends = ["Go gently.", "Nothing more is asked.", "\n- read one page", "\n- keep the door open", "This is enough.", "\n— from the old book", "How can I find a calm word today?"]
    ask = ["My neighbour has been angry with me since the spring.", "I have waited for a letter for three weeks.", "How can I find a calm word for my sister?", "What should I do when the house is empty?"]
    xs, ys = [], []
    for _ in range(240):
        q = rnd.sample(ask, 3)
        kind = rnd.randrange(7)
        if kind in (0, 1):
            a, y = rnd.sample(en, rnd.randint(2, 5)), None
            y = [ANSWER] * len(a)
            if rnd.random() < 0.5:
                a, y = a + [rnd.choice(ends)], y + [ANSWER]
        elif kind == 2:
            a, y = [rnd.choice(no)], [REFUSAL]
            if rnd.random() < 0.6:
                a, y = a + [rnd.choice(after)], y + [REFUSAL]
        elif kind == 3:
            a, y = rnd.sample(q, 3), [ECHO] * 3
            if rnd.random() < 0.4:
                a, y = a + ["I see."], y + [ECHO]
        elif kind == 4:
            a = rnd.sample(rnd.choice([de, fr]), rnd.randint(2, 3))
            y = [FOREIGN] * len(a)
        elif kind == 5:
            a = rnd.sample(en, rnd.randint(2, 4))
            y = [ANSWER] * (len(a) - 1) + [UNFINISHED]
            a[-1] = a[-1][: rnd.randint(8, len(a[-1]) - 8)].rstrip(" .,")
        else:
            a = [rnd.choice(q), *rnd.sample(en, 2)]
            y = [ECHO, ANSWER, ANSWER]
        pair = Pair(" ".join(q), " ".join(a))
        if len(pair.rows) == len(y):
            xs.append(np.array(pair.rows))
            ys.append(y)
    w, t = np.zeros((len(FEATURES), len(LABELS))), np.zeros((len(LABELS), len(LABELS)))
    for epoch in range(30):
        gw, gt = -0.02 * w, -0.02 * t
        for x, y in zip(xs, ys):
            e = x @ w
            n = len(y)
            alpha, beta = np.zeros_like(e), np.zeros_like(e)
            alpha[0] = e[0]
            for i in range(1, n):
                alpha[i] = e[i] + _lse(alpha[i - 1][:, None] + t, 0)
            for i in range(n - 2, -1, -1):
                beta[i] = _lse(t + (e[i + 1] + beta[i + 1])[None, :], 1)
            z = _lse(alpha[-1], 0)
            gamma = np.exp(alpha + beta - z)
            gold = np.zeros_like(e)
            gold[np.arange(n), y] = 1
            gw += x.T @ (gold - gamma)
            for i in range(1, n):
                gt -= np.exp(alpha[i - 1][:, None] + t + (e[i] + beta[i])[None, :] - z)
                gt[y[i - 1], y[i]] += 1
        w += gw * (2.0 / len(xs))
        t += gt * (2.0 / len(xs))
    return w, t


def _lse(a: np.ndarray, axis: int) -> np.ndarray:
    m = a.max(axis=axis, keepdims=True)
    return np.squeeze(m, axis) + np.log(np.exp(a - m).sum(axis=axis))


@lru_cache(maxsize=1)
def model() -> tuple[np.ndarray, np.ndarray]:
    return train()


def viterbi(pairs: list[Pair]) -> list[np.ndarray]:
    """The likeliest tags of each pair's clauses; all pairs advance together, so the loop runs over clause positions."""
    w, t = model()
    order = sorted((i for i, x in enumerate(pairs) if x.rows), key=lambda i: -len(pairs[i].rows))
    out: list[np.ndarray] = [np.empty(0, np.int8)] * len(pairs)
    if not order:
        return out
    lengths = np.array([len(pairs[i].rows) for i in order])
    offsets = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    e = np.array([r for i in order for r in pairs[i].rows]) @ w
    score = e[offsets].copy()
    back = []
    for k in range(1, lengths[0]):
        n = int((lengths > k).sum())
        total = score[:n, :, None] + t[None]
        back.append(total.argmax(axis=1))
        score[:n] = total.max(axis=1) + e[offsets[:n] + k]
    for row, i in enumerate(order):
        tags = np.empty(lengths[row], np.int8)
        tags[-1] = score[row].argmax()
        for k in range(lengths[row] - 1, 0, -1):
            tags[k - 1] = back[k - 1][row][tags[k]]
        out[i] = tags
    return out


def defect_of(pair: Pair, tags: np.ndarray) -> str | None:
    """The defect that the tags' coverage shows; at most one, in the order of the tests."""
    if pair.empty:
        return "empty_answer"
    if not pair.rows:
        return None
    sizes = np.array(pair.sizes)
    cover = {k: int(sizes[tags == k].sum()) for k in range(len(LABELS))}
    rows = np.array(pair.rows)
    soft = rows[:, FEATURES.index("closes")] + rows[:, FEATURES.index("declines")] > 0
    declined = bool(rows[tags == REFUSAL, FEATURES.index("declines")].any())  # closing phrases alone decline nothing
    if declined and int(sizes[(tags != REFUSAL) & ~soft].sum()) == 0:
        return "refusal"
    if cover[ECHO] and pair.q_cover >= ECHO_OF_QUESTION and pair.total - cover[ECHO] <= max(TRIVIAL_WORDS, 0.08 * pair.total):
        return "copied_question"
    if pair.a_lang and pair.q_lang and pair.a_lang != pair.q_lang and pair.a_lang not in pair.asked and cover[FOREIGN] >= FOREIGN_SHARE * (pair.total - cover[UNFINISHED]):
        return "other_language"
    if tags[-1] == UNFINISHED and rows[-1, FEATURES.index("open_end")]:
        return "truncated_answer"
    return None


def defects_of(questions: list[str | None], answers: list[str | None]) -> list[str | None]:
    """A null answer is an empty one; a null question copies and contradicts nothing."""
    pairs = [Pair(q or "", a or "") for q, a in zip(questions, answers)]
    return [defect_of(x, tags) for x, tags in zip(pairs, viterbi(pairs))]


@F.pandas_udf(T.StringType())
def pair_defect(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for q, a in batches:
        yield pd.Series(defects_of(q.tolist(), a.tolist()), dtype=object)


def prompt_pairs(spark: SparkSession, data_dir: str) -> DataFrame:
    """record_table, record_id, turn, question, answer. Every assistant turn of a chat is paired with the last user turn before it."""
    examples = table(spark, data_dir, "training_examples").select(F.lit("training_examples").alias("record_table"), F.col("id").alias("record_id"), F.lit(0).alias("turn"), F.col("user_problem").alias("question"), F.col("assistant_response").alias("answer"))
    chats = table(spark, data_dir, "chat_records").select("record_id", "messages")
    turns = chats.select(
        F.lit("chat_records").alias("record_table"),
        "record_id",
        F.posexplode(
            F.filter(
                F.transform(
                    "messages",
                    lambda m, i: F.when(
                        m.role == "assistant",
                        F.struct(F.element_at(F.filter(F.concat(F.array(F.lit(None).cast("struct<role:string,content:string>")), F.slice("messages", 1, i)), lambda x: x.isNull() | (x.role == "user")), -1).content.alias("question"), m.content.alias("answer")),
                    ),
                ),
                lambda x: x.isNotNull(),
            )
        ).alias("turn", "p"),
    ).select("record_table", "record_id", "turn", "p.question", "p.answer")
    return examples.unionByName(turns)


def p7_found(spark: SparkSession, data_dir: str) -> DataFrame:
    found = prompt_pairs(spark, data_dir).withColumn("defect", pair_defect("question", "answer")).where("defect is not null")
    # a record has one defect: that of its first defective turn
    return found.groupBy("record_table", "record_id").agg(F.min_by("defect", "turn").alias("defect"))


def p7_counts(spark: SparkSession, data_dir: str) -> DataFrame:
    """Defective records by table and kind."""
    return p7_found(spark, data_dir).groupBy("record_table", "defect").agg(F.count("*").alias("n_records"))
