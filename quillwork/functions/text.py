"""Text functions as SQL expressions for either dialect, and as Column functions for Spark.

Every function takes the dialect and the SQL of its text; `column(f, ...)` turns one into a Column.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillwork.functions import vocab
from quillwork.plans.dialect import Dialect, Spark


def column(function, text: str, *args, **kwargs) -> Column:
    """The Column of a text function, e.g. column(clean_text, "raw_text")."""
    return F.expr(function(Spark(), text, *args, **kwargs))


def clean_text(d: Dialect, t: str) -> str:
    """White space collapsed and trimmed."""
    return d.trim(d.sub(t, r"[\s]+", " "))


def clean_or_null(d: Dialect, t: str) -> str:
    """Collapsed text; null for null, empty and blank texts."""
    return f"nullif({clean_text(d, t)}, '')"


def tokens(d: Dialect, t: str) -> str:
    """White-space tokens; [] for a blank text."""
    return d.filt(d.split(t, r"\s+"), "w", "w <> ''")


def word_tokens(d: Dialect, t: str) -> str:
    return d.all(t, r"[\p{L}\p{N}_][\p{L}\p{N}_']*")


def letter_tokens(d: Dialect, t: str) -> str:
    return d.all(f"lower({t})", r"[a-z']+")


def without_metadata(d: Dialect, t: str) -> str:
    return d.sub(t, vocab.METADATA, "")


def norm_a(d: Dialect, t: str) -> str:
    """Lower case without metadata, other signs as blanks, collapsed."""
    return norm_b(d, without_metadata(d, f"lower({t})"), lowered=True)


def norm_b(d: Dialect, t: str, lowered: bool = False) -> str:
    return clean_text(d, d.sub(t if lowered else f"lower({t})", r"[^a-z0-9\s]", " "))


def norm_c(d: Dialect, t: str) -> str:
    """Lower case, signs deleted in any script, collapsed."""
    return clean_text(d, d.sub(f"lower({clean_text(d, t)})", r"[^\p{L}\p{N}_\s]", ""))


def norm_d(d: Dialect, t: str) -> str:
    """As norm_c, but double blanks survive."""
    return d.sub(f"lower({clean_text(d, t)})", r"[^\p{L}\p{N}_\s]", "")


def norm_e(d: Dialect, t: str) -> str:
    return d.join(tokens(d, d.sub(f"lower({t})", r"[^a-z0-9\s]", "")), " ")


def norm_f(d: Dialect, t: str) -> str:
    return f"lower({clean_text(d, t)})"


def opening(d: Dialect, t: str, k: int = 12) -> str:
    """The first k tokens without closing punctuation, in lower case."""
    return f"lower({d.sub(d.join(d.slice(tokens(d, t), 1, k), ' '), r'[.,;:!?]+$', '')})"


def fingerprint(d: Dialect, t: str, k: int = 40, norm=norm_a) -> str:
    """The first k normalised words."""
    return d.join(d.slice(tokens(d, norm(d, t)), 1, k), " ")


def near_key(d: Dialect, t: str, k: int = 10) -> str:
    """Normalised text without stop phrases, its first k words."""
    e = norm_c(d, t)
    for phrase in vocab.STOP_PHRASES:
        e = f"replace({e}, {d.lit(phrase)}, '')"
    return d.join(d.slice(tokens(d, e), 1, k), " ")


def sentence_list(d: Dialect, t: str) -> str:
    return d.nonblank(d.sentences(t))


def first_sentence(d: Dialect, t: str) -> str:
    return f"nullif({d.trim(d.el(sentence_list(d, clean_text(d, t)), 1))}, '')"


def clean_sentences(d: Dialect, t: str) -> str:
    """Sentences without corruption and boilerplate."""
    return d.filt(sentence_list(d, clean_text(d, t)), "s", f"NOT {d.rx('s', vocab.CORRUPTION)} AND NOT {d.rx('s', vocab.BOILERPLATE)}")


def trigram_repetition(d: Dialect, words: str) -> str:
    """Repeated trigrams: all less distinct ones."""
    grams = d.trans(d.seq("1", f"{d.size(words)} - 2"), "g", f"concat_ws(' ', {d.el(words, 'g')}, {d.el(words, 'g + 1')}, {d.el(words, 'g + 2')})")
    distinct = f"array_distinct({grams})" if d.name == "spark" else f"list_distinct({grams})"
    return f"({d.size(grams)} - {d.size(distinct)})"


def is_heading(d: Dialect, t: str, most: int = 12) -> str:
    """At most `most` words, no closing punctuation, all words but one in capitals or more."""
    w = tokens(d, t)
    capital = d.size(d.filt(w, "c", d.rx("c", "^[A-Z]")))
    return f"({d.size(w)} BETWEEN 1 AND {most} AND NOT {d.rx(f'trim({t})', r'[.!?,;:]$')} AND {capital} >= greatest(1, {d.size(w)} - 1))"


def blocks(d: Dialect, t: str) -> str:
    """Non-blank blocks between blank lines."""
    return d.nonblank(d.split(d.sub(d.sub(t, r"\r\n?", "\n"), r"\n[ \t]*\n\s*", "\x01"), "\x01"))


def tags_of(d: Dialect, low: str, table: dict[str, list[str]]) -> str:
    """Tags in the table's order whose keywords stand anywhere in the lower-case text."""
    return d.compact([f"CASE WHEN {d.any_of(low, words)} THEN {d.lit(tag)} END" for tag, words in table.items()])


def char_seed(d: Dialect, t: str, weighted: bool = True) -> str:
    """Sum of character codes, each times its position if weighted. ASCII characters count, others are dropped."""
    chars = d.filt(d.split(d.sub(t, r"[^\x20-\x7e]", ""), ""), "c", "c <> ''") if d.name == "spark" else f"string_split({d.sub(t, r'[^\x20-\x7e]', '')}, '')"
    n = f"length({d.sub(t, r'[^\x20-\x7e]', '')})"
    if not weighted:
        return d.reduce(d.trans(d.seq("1", n), "p", d.big(d.code(f"substr({d.sub(t, r'[^\x20-\x7e]', '')}, p, 1)"))), d.big("0"), "a", "x", "a + x")
    del chars
    return d.reduce(d.trans(d.seq("1", n), "p", d.big(f"p * {d.code(f'substr({d.sub(t, r"[^\x20-\x7e]", "")}, p, 1)')}")), d.big("0"), "a", "x", "a + x")


def rotate(d: Dialect, seed: str, bank: list[str]) -> str:
    return d.el(d.strings(bank), f"{d.pmod(seed, len(bank))} + 1")


def distinct_sentences(d: Dialect, t: str) -> str:
    """Sentences of which an earlier one has no equal normal form, joined by blanks."""
    s = sentence_list(d, clean_text(d, t))
    keys = d.trans(s, "v", norm_c(d, "v"))
    return d.join(d.filti(s, "v", "j", f"{d.position(keys, norm_c(d, 'v'))} = j"), " ")


def sentence_case(d: Dialect, t: str) -> str:
    """Every sentence begins with a capital letter."""
    return d.join(d.trans(sentence_list(d, t), "v", "upper(substr(v, 1, 1)) || substr(v, 2)"), " ")


def phrase_replace(d: Dialect, t: str) -> str:
    e = t
    for old, new in vocab.PHRASE_MAP.items():
        e = d.sub(e, "(?i)" + old, new)
    return e


def fit_length(d: Dialect, t: str, most: int = 140) -> str:
    """Whole sentences from the front while their words stay within the limit; the first always stays."""
    s = sentence_list(d, clean_text(d, t))
    step = f"CASE WHEN a = '' THEN x WHEN {d.size(tokens(d, 'a'))} + {d.size(tokens(d, 'x'))} <= {most} AND substr(a, 1, 1) <> chr(2) THEN concat(a, ' ', x) WHEN substr(a, 1, 1) = chr(2) THEN a ELSE concat(chr(2), a) END"
    return f"replace({d.reduce(s, d.lit(''), 'a', 'x', step)}, chr(2), '')"
