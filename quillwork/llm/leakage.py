"""Problem 8: passages of evaluation items that stand in training documents.

Winnowing: of the hashes of all k-grams of words the smallest in every window of w neighbours is kept, so two
texts that share w + k - 1 words in a row share a kept hash. The fingerprints of documents and items are joined,
each hit gives a diagonal (document word minus item word), and the diagonal is extended word by word.

A stretch of 24 or more words with at most one in twelve exchanged has at least eight equal words in a row: k = 6 and
w = 3 guarantee eight. A whole item of 12 to 23 words has at least six: such short items are looked for with k = 4. An
item of fewer words than that window takes is looked for as one k-gram of all its words. Documents leave only those
kept k-grams that a filter of fixed size, made of the fingerprints of the items, lets through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillwork.plans.bloom import bloom_of
from quillwork.sources.tables import table

K_LONG, K_SHORT, WINDOW = 6, 4, 3
STRETCH, PER_EXCHANGED = 24, 12
MIX = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(texts: list[str | None], cache: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, lengths): 64-bit hashes of the words (runs of letters, digits and marks) in lower case, concatenated."""
    import re

    import regex
    import xxhash

    ascii_word, any_word = re.compile("[a-z0-9]+"), regex.compile(r"[\p{L}\p{M}\p{N}]+")
    flat: list[int] = []
    lengths = np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        if not t:
            continue
        low = t.lower()
        words = (ascii_word if low.isascii() else any_word).findall(low)
        if len(cache) > 1_000_000:
            cache.clear()
        for w in words:
            h = cache.get(w)
            if h is None:
                h = cache[w] = xxhash.xxh64_intdigest(w)
            flat.append(h)
        lengths[i] = len(words)
    return np.array(flat, np.uint64), lengths


def winnow(words: np.ndarray, lengths: np.ndarray, k: int, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, text numbers, positions) kept: the smallest k-gram of every window of neighbours.

    Windows run over all texts at once; a window over the border of two texts keeps one more k-gram, which does no
    harm. A text shorter than a window keeps its smallest.
    """
    n = len(words) - k + 1
    if n < 1:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    grams = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            grams = (grams ^ words[j : j + n]) * MIX
            grams ^= grams >> np.uint64(29)
    inside = owner[:n] == owner[k - 1 :]
    grams[~inside] = np.uint64(2**64 - 1)
    padded = np.concatenate([np.full(window - 1, 2**64 - 1, np.uint64), grams, np.full(window - 1, 2**64 - 1, np.uint64)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, window)
    at = np.unique(np.arange(len(windows)) - np.argmin(windows[:, ::-1], axis=1))
    at = at[(at >= 0) & (at < n)]
    at = at[inside[at]]
    starts = np.cumsum(lengths) - lengths
    return grams[at].view(np.int64), owner[at], (at - starts[owner[at]]).astype(np.int32)


def fingerprints(texts: DataFrame, key: str, k: int, window: int = WINDOW, wanted=None) -> DataFrame:
    """key, h, at of every kept k-gram; only those that the broadcast filter lets through if one is given."""

    def kept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict[str, int] = {}
        for b in batches:
            h, owner, at = winnow(*word_hashes(b["text"].tolist(), cache), k, window)
            if wanted is not None:
                same = wanted.value.holds(h)
                h, owner, at = h[same], owner[same], at[same]
            if len(h):
                yield pd.DataFrame({key: b[key].to_numpy()[owner], "h": h, "at": at})

    return texts.select(key, "text").where(F.col(key).isNotNull()).mapInPandas(kept, f"{key} long, h long, at int")


def holds(doc: np.ndarray, item: np.ndarray, offsets: set[int]) -> bool:
    """Whether a diagonal holds the whole item, or STRETCH or more words of it, with at most one in twelve exchanged.

    A stretch begins and ends with an equal word, else any 22 words would count for 24.
    """
    n = len(item)
    least = min(STRETCH, n)
    for o in offsets:
        lo, hi = max(0, -o), min(n, len(doc) - o)
        if hi - lo < least:
            continue
        same = doc[lo + o : hi + o] == item[lo:hi]
        wrong = np.concatenate([[0], np.cumsum(~same)])
        if hi - lo == n and wrong[-1] <= n // PER_EXCHANGED:
            return True
        # a stretch from i to j is allowed if excess[j] <= excess[i]: the best begin so far stands for all
        excess = PER_EXCHANGED * wrong - np.arange(len(wrong))
        begin = np.maximum.accumulate(np.where(same, excess[:-1], -len(wrong) - 1))[: len(same) - least + 1]
        if (excess[least:] <= begin)[same[least - 1 :]].any():
            return True
    return False


@F.pandas_udf(T.BooleanType())
def verified(docs: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    cache: dict[str, int] = {}
    items: dict[str, np.ndarray] = {}
    last, words = None, np.empty(0, np.uint64)
    for d, e, o in docs:
        out = []
        for doc, item, offsets in zip(d, e, o):
            if doc != last:
                last, words = doc, word_hashes([doc], cache)[0]
            if item not in items:
                if len(items) > 10_000:
                    items.clear()
                items[item] = word_hashes([item], cache)[0]
            out.append(holds(words, items[item], set(map(int, offsets))))
        yield pd.Series(out, dtype=bool)


def _leaks(docs: DataFrame, items: DataFrame, k: int, window: int = WINDOW) -> DataFrame:
    test = fingerprints(items, "item_id", k, window).withColumnRenamed("at", "item_at")
    wanted = docs.sparkSession.sparkContext.broadcast(bloom_of(test.select("h")))
    hits = (
        fingerprints(docs, "doc_id", k, window, wanted)
        .join(test, "h")
        .groupBy("doc_id", "item_id")
        .agg(F.collect_set(F.col("at") - F.col("item_at")).alias("offsets"))  # at most the length of the two texts
    )
    return (
        hits.join(docs.select("doc_id", "text"), "doc_id")
        .join(items.select("item_id", F.col("text").alias("item_text")), "item_id")
        .where(verified("text", "item_text", "offsets"))
        .select("doc_id", "item_id")
    )


def leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id for every document that holds an item. docs: doc_id, text; items: item_id, text.

    Null and empty texts hold nothing, and an item without a word is held by none. Repeated ids come out once. A hash that many items share meets each of them, without a cap.
    """
    n_words = F.size(F.regexp_extract_all("text", F.lit(r"[\p{L}\p{M}\p{N}]+"), F.lit(0)))
    sized = items.where("text is not null").withColumn("_n", n_words)
    found = _leaks(docs, sized.where(F.col("_n") >= STRETCH).drop("_n"), K_LONG)
    short = sized.where((F.col("_n") >= WINDOW + K_SHORT - 1) & (F.col("_n") < STRETCH)).drop("_n")
    if short.limit(1).count():
        found = found.unionByName(_leaks(docs, short, K_SHORT))
    tiny = sized.where(F.col("_n").between(1, WINDOW + K_SHORT - 2))
    for n in sorted(r._n for r in tiny.select("_n").distinct().collect()):  # at most five lengths
        found = found.unionByName(_leaks(docs, tiny.where(F.col("_n") == n).drop("_n"), n, 1))
    return found.distinct()


def p8_found(spark: SparkSession, data_dir: str) -> DataFrame:
    return leaks(table(spark, data_dir, "documents").select("doc_id", "text"), table(spark, data_dir, "eval_items").select("item_id", "text"))


def p8_items(spark: SparkSession, data_dir: str) -> DataFrame:
    """Test items that leaked, with the number of documents that hold them."""
    return p8_found(spark, data_dir).groupBy("item_id").agg(F.count("*").alias("n_documents"))
