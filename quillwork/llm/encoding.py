"""Problem 5: text decoded with the wrong character encoding.

A chain is a wrong decoder that UTF-8 bytes went through, possibly with further hops through the same or another one. For each chain the places of a text that
read as UTF-8 sequences in it are found; the evidence of a record for a chain is the log-likelihood of the restored
characters against the standing ones under the characters of all clean text. Expectation-maximization then
estimates, for each source and field, how common each chain is: weak evidence (a single short sequence) counts
where the source has strong records of the same chain, and each record is judged and repaired by its posterior.
Replacement characters show a loss that cannot be undone; such a record is affected though not restorable.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwork.plans.lineage import cut
from quillwork.sources.tables import first_arrival, table

SINGLE_BYTE = ("cp1252", "iso8859_15", "iso8859_2", "cp1250", "cp1251", "cp1253", "cp1254", "koi8_r", "cp437", "cp850", "cp866", "mac_roman")
MULTI_BYTE = ("gbk", "shift_jis", "big5")
LOST = "lost"
CHAINS = (*SINGLE_BYTE, *MULTI_BYTE, LOST)
LLR_BOUND = 20
EM_ROUNDS, PRIOR, PRIOR_WEIGHT = 12, 0.01, 2.0
FLOOR = 0.2  # count of a character that no clean text has


@lru_cache(maxsize=1)
def _chains() -> dict[str, tuple[re.Pattern, dict[str, int]]]:
    """For each single-byte chain the pattern of its UTF-8 sequences and its bytes; undefined bytes stand as C1 controls."""
    out = {}
    for name in SINGLE_BYTE:
        of = {}
        for b in range(0x80, 0x100):
            try:
                ch = bytes([b]).decode(name)
            except UnicodeDecodeError:
                ch = chr(b)
            of[ch] = b
            if b < 0xA0:
                of.setdefault(chr(b), b)
        cls = lambda lo, hi: "[" + re.escape("".join(c for c, b in of.items() if lo <= b <= hi)) + "]"  # noqa: B023, E731
        rest = cls(0x80, 0xBF)
        out[name] = re.compile(f"(?:{cls(0xC2, 0xDF)}{rest}|{cls(0xE0, 0xEF)}{rest}{{2}}|{cls(0xF0, 0xF4)}{rest}{{3}})+"), of
    return out


WIDE_RUN = re.compile("[⺀-鿿가-힣豈-﫿︰-﹏＀-￯぀-ヿ㄀-ㄯ㈀-㏿�]+")


@lru_cache(maxsize=1)
def _leads() -> frozenset[str]:
    """Signs that begin a sequence in some chain."""
    return frozenset(c for _, of in _chains().values() for c, b in of.items() if 0xC2 <= b <= 0xF4)


@lru_cache(maxsize=1)
def _suspect() -> re.Pattern:
    """Two neighbours that could be the first bytes of a sequence in any chain, or a wide or lost character."""
    leads, rest = set(), set()
    for _, of in _chains().values():
        leads |= {c for c, b in of.items() if 0xC2 <= b <= 0xF4}
        rest |= {c for c, b in of.items() if 0x80 <= b <= 0xBF}
    either = lambda x: "[" + re.escape("".join(sorted(x))) + "]"
    return re.compile(f"{either(leads)}{either(rest)}|{WIDE_RUN.pattern[:-1]}")


#: Code points that a text restored from a second hop may hold: those of scripts in common use.
HOME = re.compile("[\x00-\u024f\u0300-\u058f\u0900-\u0d7f\u0e00-\u0eff\u1e00-\u22ff\u3000-\u9fff\uac00-\ud7af]*")
FOREIGN_RUN = re.compile(r"[^\x00-\x7f]+")


def _again(text: str, first: str) -> str:
    """Undo further hops: through the same chain, the commonest one, or any other.

    A hop is undone where every run of foreign signs of the text reads as UTF-8 in the chain and gives at most half as
    many signs, of scripts in common use; a chain other than the first two needs four foreign signs.
    """
    for _ in range(2):
        runs = FOREIGN_RUN.findall(text)
        n = sum(map(len, runs))
        if n < 2 or any(r[0] not in _leads() for r in runs):
            break
        for name in dict.fromkeys((first, "cp1252", *SINGLE_BYTE)):
            rx, of = _chains()[name]
            if n < (2 if name in (first, "cp1252") else 4) or not all(rx.fullmatch(r) for r in runs):
                continue
            got = [_bytes(r, of) for r in runs]
            if all(g is not None and HOME.fullmatch(g) for g in got) and 2 * sum(map(len, got)) <= n:
                parts = iter(got)
                text = FOREIGN_RUN.sub(lambda m: next(parts), text)  # noqa: B023
                break
        else:
            break
    return text


def _bytes(s: str, of: dict[str, int]) -> str | None:
    try:
        return bytes(of[c] for c in s).decode("utf-8")
    except UnicodeDecodeError:
        return None


def stretches(text: str) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, chain, restored text) of every place that reads as UTF-8 in a chain."""
    if text.isascii() or not _suspect().search(text):
        return
    for name, (rx, of) in _chains().items():
        for m in rx.finditer(text):
            got = _bytes(m.group(), of)
            if got is not None:
                yield m.start(), m.end(), name, _again(got, name)
    for m in WIDE_RUN.finditer(text):
        for name in MULTI_BYTE:
            raw = b"".join(c.encode(name, "ignore") if c != "�" else b"\xff" for c in m.group())
            got = raw.decode("utf-8", "replace")
            good = "".join(c for c in got if c > "\x7f" and c != "�")
            if good and len(good) >= 0.5 * got.count("�") and not WIDE_RUN.search(good):
                yield m.start(), m.end(), name, got


def character_counts(values: DataFrame) -> dict[str, int]:
    """Counts of the characters of all text outside candidate places. The result is bounded by the number of code points."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(0x110000, np.int64)
        suspect = _suspect()
        for b in batches:
            clean: list[str] = []
            for t in b["text"]:
                if t.isascii() or not suspect.search(t):
                    clean.append(t)
                    continue
                at = 0
                for lo, hi in sorted({(lo, hi) for lo, hi, _, _ in stretches(t)}):
                    if lo > at:
                        clean.append(t[at:lo])
                    at = max(at, hi)
                clean.append(t[at:])
            codes = np.frombuffer("".join(clean).encode("utf-32-le", "surrogatepass"), np.uint32)
            counts = np.bincount(codes)
            total[: len(counts)] += counts
        held = np.flatnonzero(total)
        held = held[(held < 0xD800) | (held > 0xDFFF)]
        if len(held):
            yield pd.DataFrame({"c": [chr(i) for i in held], "n": total[held]})

    rows = values.select("text").mapInPandas(count, "c string, n long").groupBy("c").agg(F.sum("n").alias("n"))
    return {r.c: r.n for r in rows.toLocalIterator()}


def evidence(values: DataFrame, counts: dict[str, int]) -> DataFrame:
    """record_table, record_id, field_name, source_document_id, chain, llr: the bounded evidence of each record."""
    logs = {c: math.log(n + FLOOR) for c, n in counts.items()}
    floor = math.log(FLOOR)

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        all_ = math.log(sum(counts.values()) + 1.0)
        suspect = _suspect()
        for b in batches:
            out = []
            for row in b.itertuples(index=False):
                if row.text.isascii() or not suspect.search(row.text):
                    continue
                by: dict[str, float] = {}
                for lo, hi, chain, got in stretches(row.text):
                    standing = sum(logs.get(c, floor) - all_ for c in row.text[lo:hi])
                    restored = sum(logs.get(c, floor) - all_ for c in got if c != "�")
                    # a stretch must not win by its length alone: the restored characters must be at home in the corpus
                    foreign = sum(c not in logs for c in got if c != "�")
                    by[chain] = by.get(chain, 0.0) + restored - standing - 6.0 * foreign
                lost = row.text.count("�")
                if lost:
                    by[LOST] = 5.0 * lost
                out += [(row.record_table, row.record_id, row.field_name, row.source_document_id, k, float(np.clip(round(v), -LLR_BOUND, LLR_BOUND))) for k, v in by.items()]
            if out:
                yield pd.DataFrame(out, columns=["record_table", "record_id", "field_name", "source_document_id", "chain", "llr"])

    return values.mapInPandas(weigh, "record_table string, record_id long, field_name string, source_document_id long, chain string, llr double")


def em_priors(hist: pd.DataFrame) -> pd.DataFrame:
    """Chain shares of one source and field from its histogram of evidence: at most chains x (2 x bound + 1) rows."""
    out = []
    for chain, h in hist.groupby("chain"):
        n, total, llr = h["n"].to_numpy(float), float(h["records"].iloc[0]), h["llr"].to_numpy(float)
        pi = PRIOR
        for _ in range(EM_ROUNDS):
            odds = pi / (1 - pi) * np.exp(llr)
            pi = (PRIOR_WEIGHT * PRIOR + (n * odds / (1 + odds)).sum()) / (PRIOR_WEIGHT + total)
            pi = min(max(pi, 1e-4), 0.98)
        out.append((hist["source"].iloc[0], hist["field_name"].iloc[0], chain, pi))
    return pd.DataFrame(out, columns=["source", "field_name", "chain", "pi"])


def encoded_values(spark: SparkSession, data_dir: str) -> DataFrame:
    """The two fields as rows; null texts take no part, replays come once."""
    out = None
    for name, field in (("extracted_document_texts", "raw_text"), ("canonical_verses", "sanskrit_text")):
        v = first_arrival(table(spark, data_dir, name).select("id", "source_document_id", "ingest_seq", field)).select(
            F.lit(name).alias("record_table"), F.col("id").alias("record_id"), F.lit(field).alias("field_name"), "source_document_id", F.col(field).alias("text")
        )
        out = v if out is None else out.unionByName(v)
    return out.where("text is not null")


def judged(spark: SparkSession, data_dir: str, counts: dict[str, int] | None = None) -> DataFrame:
    """record_table, record_id, field_name, chain, posterior for each record and chain with any evidence."""
    values = encoded_values(spark, data_dir)
    counts = character_counts(values) if counts is None else counts
    sources = table(spark, data_dir, "source_documents").select(F.col("id").alias("source_document_id"), F.coalesce("source_name", F.lit("")).alias("source")).dropDuplicates(["source_document_id"])
    found = cut(evidence(values, counts)).join(sources, "source_document_id", "left").fillna("", ["source"])
    records = (
        values.select("field_name", "source_document_id").join(sources, "source_document_id", "left").fillna("", ["source"]).groupBy("source", "field_name").agg(F.count("*").alias("records"))
    )
    hist = found.groupBy("source", "field_name", "chain", "llr").agg(F.count("*").alias("n")).join(records, ["source", "field_name"])
    pis = hist.groupBy("source", "field_name").applyInPandas(em_priors, "source string, field_name string, chain string, pi double")
    odds = F.col("pi") / (1 - F.col("pi")) * F.exp("llr")
    return found.join(pis, ["source", "field_name", "chain"]).select("record_table", "record_id", "field_name", "chain", (odds / (1 + odds)).alias("posterior"))


def p5_found(spark: SparkSession, data_dir: str) -> DataFrame:
    return judged(spark, data_dir).where("posterior > 0.5").select("record_table", "record_id").distinct()


def restored_text(text: str, chains: list[str], logs: dict[str, float]) -> str:
    """The text with the stretches of the accepted chains restored; of overlapping ones the likeliest, then the longest."""
    floor = math.log(FLOOR)
    options = []
    for lo, hi, chain, got in stretches(text):
        if chain in chains:
            foreign = sum(c not in logs for c in got if c != "�")
            gain = sum(logs.get(c, floor) for c in got) - sum(logs.get(c, floor) for c in text[lo:hi]) + 12.0 * (hi - lo - len(got)) - 6.0 * foreign
            options.append((-gain, lo - hi, lo, hi, got))
    taken: list[tuple[int, int, str]] = []
    for _, _, lo, hi, got in sorted(options):
        if all(hi <= a or lo >= b for a, b, _ in taken):
            taken.append((lo, hi, got))
    out, at = [], 0
    for lo, hi, got in sorted(taken):
        out += [text[at:lo], got]
        at = hi
    return "".join(out) + text[at:]


def p5_restored(spark: SparkSession, data_dir: str) -> DataFrame:
    """record_table, record_id, restored (text), complete (no sign of a loss is left) for the affected records."""
    values = encoded_values(spark, data_dir)
    counts = character_counts(values)
    logs = {c: math.log(n + FLOOR) for c, n in counts.items()}
    chains = judged(spark, data_dir, counts).where("posterior > 0.5").groupBy("record_table", "record_id").agg(F.collect_set("chain").alias("chains"))  # at most len(CHAINS)

    def repair(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b["restored"] = [restored_text(t, list(c), logs) for t, c in zip(b["text"], b["chains"])]
            b["complete"] = [not re.search("[�\x80-\x9f]", t) for t in b["restored"]]
            yield b[["record_table", "record_id", "restored", "complete"]]

    return values.join(chains, ["record_table", "record_id"]).select("record_table", "record_id", "text", "chains").mapInPandas(
        repair, "record_table string, record_id long, restored string, complete boolean"
    )
