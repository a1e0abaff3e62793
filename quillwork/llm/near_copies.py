"""Problem 4: groups of near-copies under small edits, at any size.

Similarity is that of the bags of words: shared words, repeats counted, over all words of the two texts. A repeat is
a token of its own (word, occurrence), so a bag is a set of tokens.

Candidates come from several global token orders. Each order (a seeded hash, so it is the same everywhere) ranks the
tokens of a text, and its prefix is the first of them; two texts of similarity s share the prefix of an order with
probability s. The filters of several orders are intersected in one key, and such keys are united, so a pair is a
candidate if it shares all prefixes of any of them. There are two families of orders: in RARE_WAY the tokens that more
than COMMON of the texts hold rank behind all others, in WHOLE_WAY all tokens rank alike and more orders are
intersected. Before a candidate is verified exactly on its tokens, a parity sketch of 128 bits prunes without loss: two
bags differ in at least as many tokens as their sketches differ in bits.

Every text is tokenised once; its tokens are kept in a compressed table, from which counts, keys and the verification
are taken. Texts of equal bags are one text in the search. The search is a sort-merge join of the keys with themselves;
the number of its partitions follows the number of keys, and a hot key is split by the adaptive skew join.

The chance to miss a pair is the product over both families of (1 - r^orders)^keys for a share r of common tokens in
the family; see README for measured recall. Nulls, and texts under LEAST_WORDS words, take no part; empty tables give
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwork.plans.bloom import bloom_of
from quillwork.plans.lineage import cut, cut_table, partitions, sweep
from quillwork.sources.tables import table

THRESHOLD, LEAST_WORDS = 0.8, 30
#: (intersected orders, keys) of a family.
RARE_WAY, WHOLE_WAY = (3, 16), (6, 12)
#: Shares of rare tokens from which the orders over rare tokens are used, and below which those over all tokens are.
RARE_FROM, WHOLE_BELOW = 0.2, 0.9
COMMON = 0.08
#: Keys a task of the join shall read, and the most tasks: beyond them tasks grow, and their sort spills.
TASK_KEYS, MOST_TASKS = 200_000, 100_000
MIX1, MIX2, STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * MIX1
        x = (x ^ (x >> np.uint64(27))) * MIX2
        return x ^ (x >> np.uint64(31))


def bag_tokens(texts: list[str], cache: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, lengths): for each text its token hashes in an order that equal bags share, concatenated. Words are runs of letters or digits in lower case."""
    import re

    import regex
    import xxhash

    ascii_word, any_word = re.compile("[a-z0-9]+"), regex.compile(r"[\p{L}\p{N}]+")
    flat: list[int] = []
    lengths = np.empty(len(texts), np.int64)
    for i, t in enumerate(texts):
        low = t.lower()
        words = ascii_word.findall(low) if low.isascii() else any_word.findall(low)
        if len(cache) > 1_000_000:
            cache.clear()
        try:
            flat += [cache[w] for w in words]
        except KeyError:
            for w in words:
                if w not in cache:
                    cache[w] = xxhash.xxh64_intdigest(w)
            flat += [cache[w] for w in words]
        lengths[i] = len(words)
    n = len(flat)
    if n == 0:
        return np.empty(0, np.uint64), lengths
    # the text's number above 44 bits of the word's hash: one plain sort orders the words within each text
    owner = np.repeat(np.arange(len(texts), dtype=np.uint64), lengths)
    both = np.sort((owner << np.uint64(44)) | (np.array(flat, np.uint64) >> np.uint64(20)))
    start = np.zeros(n, np.int64)
    new = np.flatnonzero(both[1:] != both[:-1]) + 1
    start[new] = new
    nth = (np.arange(n) - np.maximum.accumulate(start)).astype(np.uint64)  # the occurrence makes repeats tokens of their own
    with np.errstate(over="ignore"):
        return mixed((both & np.uint64((1 << 44) - 1)) + nth * STEP), lengths


def among(tokens: np.ndarray, sorted_: np.ndarray) -> np.ndarray:
    """Whether each token is in a short sorted list."""
    if not len(sorted_):
        return np.zeros(len(tokens), bool)
    at = np.minimum(np.searchsorted(sorted_, tokens), len(sorted_) - 1)
    return sorted_[at] == tokens


def near_texts(spark: SparkSession, data_dir: str) -> DataFrame:
    """record_table, record_id, text: responses, and the assistant contents of a chat joined by a blank."""
    examples = table(spark, data_dir, "training_examples").select(F.lit("training_examples").alias("record_table"), F.col("id").alias("record_id"), F.col("assistant_response").alias("text"))
    chats = table(spark, data_dir, "chat_records").select(
        F.lit("chat_records").alias("record_table"), "record_id", F.array_join(F.transform(F.filter("messages", lambda m: m.role == "assistant"), lambda m: F.coalesce(m.content, F.lit(""))), " ").alias("text")
    )
    return examples.unionByName(chats).where("text is not null")


BAG = "record_table string, record_id long, bag long, size int, low_bits long, high_bits long, tokens array<long>"


def bags_of(texts: DataFrame) -> DataFrame:
    """record_table, record_id, bag (a 64-bit key that equal bags of a table share), size, the two halves of the sketch, and the tokens of each text of enough words."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        cache: dict[str, int] = {}
        for b in batches:
            names = b.column("record_table").to_pylist()
            tokens, lengths = bag_tokens(b.column("text").to_pylist(), cache)
            keep = lengths >= LEAST_WORDS
            if not keep.any():
                continue
            tokens, own = tokens[np.repeat(keep, lengths)], lengths[keep]
            ends = np.cumsum(own)
            starts = ends - own
            kept = np.flatnonzero(keep)
            raw, salt = memoryview(tokens.view(np.uint8)), [xxhash.xxh32_intdigest(names[i]) for i in kept]
            bags = np.array([xxhash.xxh3_64_intdigest(raw[8 * i : 8 * j], s) for i, j, s in zip(starts, ends, salt)], np.uint64).view(np.int64)
            at = tokens >> np.uint64(57)
            bits = np.uint64(1) << (at & np.uint64(63))
            low, high = (np.bitwise_xor.reduceat(np.where(half, bits, np.uint64(0)), starts).view(np.int64) for half in (at < 64, at >= 64))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(tokens.view(np.int64)))
            ids = b.column("record_id").take(pa.array(kept))
            yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in kept], pa.string()), ids, pa.array(bags), pa.array(own.astype(np.int32)), pa.array(low), pa.array(high), lists], names=[c.split()[0] for c in BAG.split(", ")])

    return texts.mapInArrow(read, BAG)


def common_tokens(bags: DataFrame) -> np.ndarray:
    """Tokens of more than COMMON of the texts. There are at most (mean words of a text) / COMMON of them, however many texts."""
    least = COMMON * bags.count()
    frequent = bags.select(F.explode("tokens").alias("t")).groupBy("t").count().where(F.col("count") > least)
    return np.array(sorted(r.t for r in frequent.select("t").toLocalIterator()), np.int64)


def prefix_keys(which: np.ndarray, starts: np.ndarray, vocabulary: np.ndarray, orders: int, n_keys: int, way: int) -> np.ndarray:
    """(texts, n_keys): for every key the intersected one-token prefixes of its orders. `which` are places in the vocabulary; no text is empty."""
    keys = np.empty((len(starts), n_keys), np.uint64)
    seeds = mixed(np.arange(1, orders * n_keys + 1, dtype=np.uint64) * STEP + np.uint64(way)).reshape(n_keys, orders)
    with np.errstate(over="ignore"):
        for k in range(n_keys):
            key = np.full(len(starts), k + 1000 * way, np.uint64)
            for seed in seeds[k]:
                rank = (mixed(vocabulary ^ seed) >> np.uint64(32)).astype(np.uint32)
                key = mixed(key * STEP + np.minimum.reduceat(rank[which], starts))
            keys[:, k] = key
    return (keys >> np.uint64(32)).astype(np.uint32).view(np.int32)  # a chance match of 32 bits costs one comparison of sketches


KEY = "key int, bag long, size int, low_bits long, high_bits long"


def keys_of(bags: DataFrame, common: np.ndarray) -> DataFrame:
    """A row for each key of each text; copies within a batch are merged.

    A text of few rare tokens has keys over all its tokens, one of hardly any others has keys over the rare ones, one
    between has both.
    """

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bag = b.column("bag").to_numpy()
            _, first = np.unique(bag, return_index=True)
            b = b.take(pa.array(first))
            bag, size, low, high = (b.column(c).to_numpy() for c in ("bag", "size", "low_bits", "high_bits"))
            salt = np.where(np.array(b.column("record_table").to_pylist()) == "chat_records", 7, 0).astype(np.int32)
            own = size.astype(np.int64)
            flat = b.column("tokens").flatten().to_numpy()
            vocabulary, which = np.unique(flat, return_inverse=True)
            which = which.astype(np.int32)
            rare = ~among(vocabulary, common)[which]
            starts = np.cumsum(own) - own
            n_rare = np.add.reduceat(rare.astype(np.int64), starts)
            owner = np.repeat(np.arange(len(own)), own)
            share = n_rare / own
            everything = np.ones(len(flat), bool)
            for way, (orders, n_keys), chosen, mask, n in ((1, RARE_WAY, (share >= RARE_FROM) & (n_rare > 0), rare, n_rare), (2, WHOLE_WAY, share < WHOLE_BELOW, everything, own)):
                at = np.flatnonzero(chosen)
                if not len(at):
                    continue
                some = prefix_keys(which[mask & chosen[owner]], np.cumsum(n[at]) - n[at], vocabulary.view(np.uint64), orders, n_keys, way) + salt[at][:, None]
                rows = np.repeat(at, n_keys)
                yield pa.RecordBatch.from_arrays([pa.array(some.ravel())] + [pa.array(x[rows]) for x in (bag, size, low, high)], names=[c.split()[0] for c in KEY.split(", ")])

    return bags.select("record_table", "bag", "size", "low_bits", "high_bits", "tokens").mapInArrow(keys, KEY)


def held_by(rows: DataFrame, bags: DataFrame) -> DataFrame:
    """The rows (bag, tokens) of the given bags and a few others, so that the texts of no candidate are not shuffled."""
    bloom = rows.sparkSession.sparkContext.broadcast(bloom_of(bags))

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(bloom.value.holds(b.column("bag").to_numpy())))

    return rows.mapInArrow(some, "bag long, tokens array<long>")


def similar_bags(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members, pairs): members record_table, record_id, bag; pairs bag_a, bag_b of similarity THRESHOLD or more between different bags of one table."""
    spark = texts.sparkSession
    bags = cut_table(bags_of(texts))
    keyed = keys_of(bags, common_tokens(bags))
    one, two = keyed.alias("x"), keyed.alias("y")  # alike, so that one exchange serves both sides
    both = F.col("x.size") + F.col("y.size")
    differ = both * ((1 - THRESHOLD) / (1 + THRESHOLD)) + 1e-9  # tokens in which two bags of the threshold can differ
    apart = F.bit_count(F.col("x.low_bits").bitwiseXOR(F.col("y.low_bits"))) + F.bit_count(F.col("x.high_bits").bitwiseXOR(F.col("y.high_bits")))
    near = (F.col("x.bag") < F.col("y.bag")) & (F.abs(F.col("x.size") - F.col("y.size")) <= differ) & (apart <= differ)
    # the planner does not see that the keys multiply the rows, so it is told to sort and merge
    found = one.hint("merge").join(two, F.col("x.key") == F.col("y.key")).where(near).select(F.col("x.bag").alias("bag_a"), F.col("y.bag").alias("bag_b")).distinct()
    with partitions(spark, min(MOST_TASKS, bags.count() * (RARE_WAY[1] + WHOLE_WAY[1]) // TASK_KEYS)):
        candidates = cut(found)
    del keyed, one, two, found
    sweep(spark)  # the keys are the largest exchange, and no longer needed
    tokens = held_by(bags.select("bag", "tokens"), candidates.select(F.explode(F.array("bag_a", "bag_b")))).groupBy("bag").agg(F.first("tokens").alias("tokens"))
    for side in "ab":
        candidates = candidates.join(tokens.select(F.col("bag").alias(f"bag_{side}"), F.col("tokens").alias(f"tokens_{side}")).hint("merge"), f"bag_{side}")
    shared, total = F.size(F.array_intersect("tokens_a", "tokens_b")), F.size("tokens_a") + F.size("tokens_b")
    # a hair below the threshold, as 0.8 is no binary fraction
    pairs = candidates.where(shared >= (THRESHOLD - 1e-12) * (total - shared)).select("bag_a", "bag_b")
    return bags.select("record_table", "record_id", "bag"), pairs


def p4_found(spark: SparkSession, data_dir: str) -> DataFrame:
    """All pairs of records: those of similar bags, and those of one bag."""
    members, pairs = similar_bags(near_texts(spark, data_dir))
    one = members.select("record_table", F.col("bag").alias("bag_a"), F.col("record_id").alias("r1"))
    two = members.select(F.col("bag").alias("bag_b"), F.col("record_id").alias("r2"))
    several = members.groupBy("bag").agg(F.count("*").alias("n")).where("n > 1").select(F.col("bag").alias("bag_a"), F.col("bag").alias("bag_b"))
    linked = pairs.unionByName(several).join(one, "bag_a").join(two, "bag_b").where("bag_a <> bag_b or r1 < r2")
    return linked.select("record_table", F.least("r1", "r2").alias("record_a"), F.greatest("r1", "r2").alias("record_b"))


def p4_classes(spark: SparkSession, data_dir: str) -> DataFrame:
    """One row for each record of enough words: record_table, record_id, class (key of its equal bags), n_copies and n_links (similar other classes)."""
    members, pairs = similar_bags(near_texts(spark, data_dir))
    ends = pairs.select(F.explode(F.array("bag_a", "bag_b")).alias("bag"))
    links = ends.groupBy("bag").agg(F.count("*").alias("n_links"))
    sizes = members.groupBy("bag").agg(F.count("*").alias("n_copies"))
    return members.join(sizes.join(links, "bag", "left").fillna(0, ["n_links"]), "bag").select("record_table", "record_id", F.col("bag").alias("class"), "n_copies", "n_links")
