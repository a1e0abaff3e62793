"""Problem 3: one consistent form for text that looks the same in different characters.

A longest-match transducer is compiled from rules and the Unicode data of the interpreter: its keys are single
characters and short sequences (forms of width, font and typesetting, composed letters, look-alike letters and marks),
its input units are grapheme clusters, and the output of a cluster is made once and looked up from then on. The table is
checked for conflicts when it is compiled: no key has two outputs, no output holds a key, and no key is a letter that
the target alphabets use themselves. A null stays null, '' stays ''; a replayed row is one value.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillwork.plans.lineage import cut
from quillwork.sources.tables import table

# Letters of other scripts that look like Latin ones.
LATIN_LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S",
    "ο": "o", "ρ": "p", "ν": "v", "Α": "A", "Β": "B", "Ε": "E", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Χ": "X", "Ζ": "Z",
    "ɑ": "a", "ɡ": "g", "ɩ": "i", "ո": "n", "ս": "u", "օ": "o", "զ": "q", "հ": "h", "ց": "g", "յ": "j", "Ս": "U", "Տ": "S", "Լ": "L", "ӏ": "l", "Ӏ": "I", "ϲ": "c", "Ϲ": "C", "ϳ": "j",
    "ᴄ": "c", "ᴏ": "o", "ᴠ": "v", "ᴡ": "w", "ᴢ": "z", "ꜱ": "s",
    "Ꭺ": "A", "Ᏼ": "B", "Ꮯ": "C", "Ꭰ": "D", "Ꭼ": "E", "Ꮐ": "G", "Ꮋ": "H", "Ꭻ": "J", "Ꮶ": "K", "Ꮮ": "L", "Ꮇ": "M", "Ꮲ": "P", "Ꮢ": "R", "Ꮪ": "S", "Ꭲ": "T", "Ꮩ": "V", "Ꮃ": "W", "Ꮓ": "Z",
}
# Marks that look alike, and Devanagari sequences that look like one sign.
MARK_LOOKALIKES = {
    "‐": "-", "‑": "-", "ʼ": "’", "'": "’", "‘": "’", "ʹ": "’", "′": "’", "＇": "’", "“": '"', "”": '"', "″": '"', "ǃ": "!", "‚": ",", "ː": ":", "꞉": ":", "∶": ":",
    "|": "।", "ǀ": "।", "∣": "।", "│": "।", "।।": "॥", "||": "॥",
    "अा": "आ", "अो": "ओ", "अौ": "औ", "आे": "ओ", "आै": "औ", "एे": "ऐ", "ाे": "ो", "ाै": "ौ", "अॉ": "ऑ", "अॅ": "ॲ",
}
#: Kinds of compatibility forms that differ in width, font or typesetting only; raised, lowered, circled and squared ones look different.
SAME_LOOK = ("<wide>", "<narrow>", "<font>", "<compat>", "<noBreak>")
#: Forms of these kinds that a reader tells from their plain letters: long s, Greek letter variants, spacing accents.
OTHER_LOOK = {0x017F, *range(0x03D0, 0x03F6), 0x1FBD, 0x1FBF, 0x1FC0, 0x1FFE, *range(0x2E80, 0x3000), *range(0xFDF0, 0xFE00)}
#: Where the Unicode data have such forms.
FORMS = [*range(0x0132, 0x0150), *range(0x01C4, 0x01F4), *range(0x2010, 0x2190), *range(0x2474, 0x24B6), *range(0xA700, 0xAB70), *range(0xFB00, 0xFB07), *range(0xFF01, 0xFFEF), *range(0x1D400, 0x1D800)]
#: Signs after which a colon is a visarga: Devanagari letters and vowel signs.
DEVANAGARI = ("ऀ", "ॣ")
VIRAMA = "्"


def is_blank(ch: str) -> bool:
    return ch == "\t" or unicodedata.category(ch) == "Zs"


def is_invisible(ch: str) -> bool:
    """Format characters, variation selectors and fillers show nothing."""
    return unicodedata.category(ch) == "Cf" or "︀" <= ch <= "️" or ch in "͏ᅟᅠㅤﾠ᠎"


class Transducer:
    """Longest match over the compiled table; one pass over the grapheme clusters of a text."""

    def __init__(self) -> None:
        import regex

        table_: dict[str, str] = {}

        def rule(key: str, value: str) -> None:
            if key == value:
                return
            if table_.get(key, value) != value:
                raise ValueError(f"two outputs for {key!r}")
            table_[key] = value

        for code in FORMS:  # forms of width, font and typesetting, by rule
            kind = unicodedata.decomposition(chr(code)).partition(" ")[0]
            if kind in SAME_LOOK and code not in OTHER_LOOK and chr(code) not in MARK_LOOKALIKES and chr(code) not in LATIN_LOOKALIKES:
                plain = unicodedata.normalize("NFKC", chr(code))
                if plain.strip() == plain and not is_invisible(plain[0]):
                    rule(chr(code), "".join(MARK_LOOKALIKES.get(c, LATIN_LOOKALIKES.get(c, c)) for c in plain))
        for code in [*range(0x250), *range(0x1E00, 0x1F00), *range(0x0900, 0x0980)]:  # one form for composed letters, by rule
            ch = chr(code)
            parts = unicodedata.normalize("NFD", ch)
            if len(parts) > 1:
                rule(parts, ch)
        for source in (LATIN_LOOKALIKES, MARK_LOOKALIKES):
            for key, value in source.items():
                rule(key, value)
        alphabet = set("abcdefghijklmnopqrstuvwxyz0123456789") | {chr(c) for c in range(0x0904, 0x0964)}
        for key, value in table_.items():
            if value in table_ or key in alphabet:
                raise ValueError(f"conflict at {key!r}")
        self.table = table_
        self.longest = max(map(len, table_))
        self.units = regex.compile(r"\r\n|[\u0085  \r\n]|[|｜।ǀ∣│]{2}|\X")
        self.cluster = lru_cache(maxsize=200_000)(self._cluster)

    def _cluster(self, unit: str) -> str:
        """The output for one unit; marks are first put into canonical order."""
        if unit in ("\r\n", "\r", "\n", "\u0085", " ", " "):
            return "\n"
        text = "".join(c for i, c in enumerate(unicodedata.normalize("NFD", unit)) if not is_invisible(c))
        if text and all(map(is_blank, text)):
            return " "
        text = "".join(self.table.get(c, c) for c in text)
        out, i = [], 0
        while i < len(text):
            for n in range(min(self.longest, len(text) - i), 0, -1):
                if (got := self.table.get(text[i : i + n])) is not None:
                    out.append(got)
                    i += n
                    break
            else:
                out.append(text[i])
                i += 1
        return unicodedata.normalize("NFC", "".join(out))

    def __call__(self, text: str | None) -> str | None:
        if text is None:
            return None
        out: list[str] = []
        last = ""
        cluster = self.cluster
        for unit in self.units.findall(text):
            got = cluster(unit)
            if not got:
                continue
            if got == ":" and DEVANAGARI[0] <= last <= DEVANAGARI[1]:
                got = "ः"
            if got == " " and last == " ":
                continue
            if got == "\n":
                while out and out[-1] == " ":
                    out.pop()
            first = self.table.get((last + got)[-2:]) if out and len(got) == 1 else None
            if first is not None and len(first) == 1:  # a match across clusters
                out[-1] = out[-1][: -len(last)] + first
            else:
                out.append(got)
            last = out[-1][-1]
        while out and out[-1] in (" ", "\n"):
            out.pop()
        return "".join(out)


@lru_cache(maxsize=1)
def transducer() -> Transducer:
    return Transducer()


@F.pandas_udf(T.StringType())
def canonical_form(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The consistent form of each text; null stays null, '' stays ''."""
    form = transducer()
    for s in texts:
        yield s.map(form, na_action="ignore")


def consistent_verses(spark: SparkSession, data_dir: str) -> DataFrame:
    """field_name, verse_id, raw, form for each non-null value of the two fields; replays come out once."""
    verses = table(spark, data_dir, "canonical_verses").select("id", "sanskrit_text", "transliteration")
    values = verses.select(
        F.col("id").alias("verse_id"),
        F.explode(
            F.array(
                F.struct(F.lit("sanskrit_text").alias("field_name"), F.col("sanskrit_text").alias("raw")),
                F.struct(F.lit("transliteration").alias("field_name"), F.col("transliteration").alias("raw")),
            )
        ).alias("v"),
    ).select("verse_id", "v.field_name", "v.raw")
    return values.where(F.col("raw").isNotNull()).withColumn("form", canonical_form("raw"))


def p3_found(spark: SparkSession, data_dir: str) -> DataFrame:
    """Pairs of verses whose values have one form but different characters.

    Equal values are first merged into one spelling; only the spellings of a form are paired, and the
    pairs are then joined to their verses, so a form of which there are many equal copies costs nothing.
    """
    # the transducer runs once: what follows reads a table of hashes
    values = cut(consistent_verses(spark, data_dir).select("field_name", "verse_id", F.md5("raw").alias("spelling"), F.md5("form").alias("form")).distinct())
    spellings = values.select("field_name", "form", "spelling").distinct()
    several = spellings.groupBy("field_name", "form").agg(F.count("*").alias("n")).where("n > 1").select("field_name", "form")
    spellings = spellings.join(several, ["field_name", "form"], "left_semi")
    left, right = spellings.withColumnRenamed("spelling", "s1"), spellings.withColumnRenamed("spelling", "s2")
    pairs = left.join(right, ["field_name", "form"]).where("s1 < s2").select("field_name", "s1", "s2")
    one = values.select(F.col("field_name"), F.col("spelling").alias("s1"), F.col("verse_id").alias("v1"))
    two = values.select(F.col("field_name"), F.col("spelling").alias("s2"), F.col("verse_id").alias("v2"))
    return (
        pairs.join(one, ["field_name", "s1"])
        .join(two, ["field_name", "s2"])
        .where("v1 <> v2")
        .select("field_name", F.least("v1", "v2").alias("verse_a"), F.greatest("v1", "v2").alias("verse_b"))
    )


def p3_forms(spark: SparkSession, data_dir: str) -> DataFrame:
    """Every value in its consistent form, with a flag for those that changed."""
    return consistent_verses(spark, data_dir).select("field_name", "verse_id", "form", (F.col("raw") != F.col("form")).alias("changed")).distinct()
