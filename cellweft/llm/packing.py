"""Packing by cutting-stock column generation.

Every text becomes ids plus an end id, cut into whole sequences and a remainder; the remainder is cut once more into a
multiple of GRAIN and a tail, so that there are fewer than capacity / GRAIN + GRAIN lengths whatever the table's size.
A linear program over the length histogram finds how often each pattern (a multiset of lengths filling one sequence) is
used: a knapsack by dynamic programming prices new patterns until none improves. Pattern counts are rounded down and
what remains is filled greedily. Pieces are ranked within their length on Spark (per shard, plus the counts of the
shards before), and a rank finds its sequence and offset in a table of patterns, bounded by the number of lengths.

Null and empty texts are one piece of the end id. Repeated rows stay rows and are packed each. A null doc_id is kept. An empty table
gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellweft.llm.common import give_back, plain, table
from cellweft.llm.registry import query
from cellweft.session import settle

CAPACITY = 2048
GRAIN = 64
END = 1
END_BYTES = END.to_bytes(4, "little")
RUN = 1_000_000      # characters of texts whose new words are encoded together
CACHE = 600_000      # chunks, and words, whose ids a task keeps, at most; a quarter stays with the worker process
# The vocabulary's words, and the same for lower-case ASCII.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\x09-\x0d a-z0-9]+")
SHARDS = 64


@lru_cache(4)
def encoder(path: str):
    """texts -> ids of each, kept by a worker process for all its tasks.

    Spaces bound the vocabulary's words, so each distinct chunk between them is encoded once. The new words of new ASCII
    chunks are encoded in one call, told apart by the ids that end a word; other new chunks in a second one, told apart
    by zeros put between them, as a digit is a word of its own. Chunks that hold a zero or may hold a special token, and
    all chunks of a vocabulary with other words, go one by one. Of more than CACHE the first quarter stays, and of
    what a task leaves: those met first are the commonest.
    """
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as spec:
        shared = WORDS in [x.get("pattern", {}).get("Regex") for x in
                           (json.load(spec).get("pre_tokenizer") or {}).get("pretokenizers", [])]
    last = np.zeros(tok.get_vocab_size() + 1, bool)
    last[[i for token, i in tok.get_vocab().items() if token.endswith("</w>")]] = True
    zero = tok.token_to_id("0</w>")
    words: dict[str, bytes] = {}
    known: dict[str, bytes] = {}

    def flat(texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in tok.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(fresh: set[str]) -> None:
        ascii_, mixed, odd = [], [], []
        for c in fresh:
            (odd if not shared or "<|" in c else ascii_ if c.isascii() else odd if "0" in c else mixed).append(c)
        cut = [ASCII_WORDS.findall(c.lower()) for c in ascii_]
        new = list({w for own in cut for w in own}.difference(words))
        for i in range(0, len(new), 5000):
            ids, = flat([" ".join(new[i:i + 5000])])
            ends, raw = (4 * (np.flatnonzero(last[ids]) + 1)).tolist(), ids.tobytes()
            words.update(zip(new[i:i + 5000], [raw[j:k] for j, k in zip([0, *ends], ends)], strict=True))
        known.update(zip(ascii_, [b"".join([words[w] for w in own]) for own in cut]))
        for i in range(0, len(mixed), 5000):
            ids, = flat([" 0 ".join(mixed[i:i + 5000])])
            raw, at = ids.tobytes(), (4 * np.flatnonzero(ids == zero)).tolist()
            known.update(zip(mixed[i:i + 5000], [raw[j:k] for j, k in zip([0, *[x + 4 for x in at]], [*at, len(raw)])],
                             strict=True))
        if odd:
            known.update(zip(odd, [ids.tobytes() for ids in flat(odd)]))

    def keep(most: int) -> None:
        for cache in (known, words):
            if len(cache) > most:
                first = list(islice(cache.items(), CACHE // 4))
                cache.clear()
                cache.update(first)

    def ids(texts: list[str | None]) -> list[np.ndarray]:
        chunks = [(text or "").split(" ") for text in texts]
        fresh = set().union(*chunks).difference(known)
        if fresh:
            learn(fresh)
        out = [np.frombuffer(b"".join([*map(known.__getitem__, own), END_BYTES]), "<u4") for own in chunks]
        keep(CACHE)
        return out
    ids.keep = keep
    return ids


def runs(texts: Iterable[str | None], size: int = RUN) -> Iterator[list[str | None]]:
    """The texts in runs of about ``size`` characters; a longer text is a run of its own."""
    run, held = [], 0
    for text in texts:
        run.append(text)
        held += len(text or "")
        if held >= size:
            yield run
            run, held = [], 0
    if run:
        yield run


def cuts(n: int, capacity: int = CAPACITY, grain: int = GRAIN) -> list[int]:
    rest = n % capacity
    return [capacity] * (n // capacity) + [x for x in (rest - rest % grain, rest % grain) if x]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, grain: int = GRAIN) -> DataFrame:
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_of = encoder(tokenizer)
        for batch in batches:
            rows = []
            encoded = (ids for run in runs(batch["text"]) for ids in ids_of(run))
            for doc, ids in zip(batch["doc_id"], encoded):
                at = 0
                for size in cuts(len(ids), capacity, grain):
                    rows.append((doc, at, size, zlib.crc32(ids[at:at + size].tobytes()), len(ids)))
                    at += size
            yield pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"]).astype(
                {"doc_id": "Int64"})
        batch = None
        ids_of.keep(CACHE // 4)
        give_back()
    return plain(docs, "doc_id", "text").mapInPandas(
        cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def price(values: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The pattern of greatest value that fits: unbounded knapsack over the capacity."""
    best, took = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        fit = np.searchsorted(lengths, c, side="right")
        best[c] = best[c - 1]
        if fit:
            worth = values[:fit] + best[c - lengths[:fit]]
            i = int(worth.argmax())
            if worth[i] > best[c]:
                best[c], took[c] = worth[i], i
    pattern, c = np.zeros(len(lengths)), capacity
    while c > 0:
        if took[c] < 0:
            c -= 1
        else:
            pattern[took[c]] += 1
            c -= lengths[took[c]]
    return best[capacity], pattern


def columns(lengths: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 2000) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (rows) and their counts in the linear program: revised simplex, one priced column a step."""
    m = len(lengths)
    basis = np.diag((capacity // lengths).astype(float))
    inverse = np.diag(1 / np.diag(basis))
    x = inverse @ demand
    for step in range(rounds):
        value, pattern = price(inverse.sum(0), lengths, capacity)
        if value <= 1 + 1e-7:
            break
        move = inverse @ pattern
        ratio = np.full(m, np.inf)
        ratio[move > 1e-9] = x[move > 1e-9] / move[move > 1e-9]
        out = int(ratio.argmin())
        x = x - ratio[out] * move
        x[out] = ratio[out]
        basis[:, out] = pattern
        pivot = inverse[out] / move[out]
        inverse = inverse - np.outer(move, pivot)
        inverse[out] = pivot
        if step % 50 == 49:
            inverse = np.linalg.inv(basis)
            x = np.maximum(inverse @ demand, 0)
    return basis.T.copy(), x


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first rank, last rank, sequence of the first, per sequence, offset) that place every rank."""
    lengths = np.array(sorted(histogram), int)
    if not len(lengths):
        return []
    left = np.array([histogram[x] for x in lengths], float)
    used: list[tuple[np.ndarray, int]] = []
    patterns, x = columns(lengths, left, capacity)
    for p, count in zip(patterns, np.floor(x + 1e-9).astype(int)):
        some = p > 0
        count = min(count, int((left[some] // p[some]).min())) if some.any() else 0
        if count > 0:
            used.append((p, count))
            left -= p * count
    while left.any():  # what rounding left: longest first, each pattern as often as it can be
        p, room = np.zeros(len(lengths)), capacity
        for i in range(len(lengths) - 1, -1, -1):
            p[i] = min(left[i], room // lengths[i])
            room -= int(p[i] * lengths[i])
        count = int((left[p > 0] // p[p > 0]).min())
        used.append((p, count))
        left -= p * count
    rows, rank, sequence = [], np.zeros(len(lengths), int), 0
    for p, count in used:
        offset = 0
        for i in np.flatnonzero(p):
            per = int(p[i])
            rows.append((int(lengths[i]), int(rank[i]), int(rank[i] + per * count - 1), sequence, per, offset))
            rank[i] += per * count
            offset += per * int(lengths[i])
        sequence += int(count)
    return rows


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, grain: int = GRAIN) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    shard = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(SHARDS)).cast("int")
    # Copies of one document differ by their place among the task's rows.
    cut = settle(pieces(docs, tokenizer, capacity, grain).withColumn("n", F.monotonically_increasing_id())
                 .withColumn("shard", F.pmod(shard + F.col("n"), F.lit(SHARDS)).cast("int")), "pieces")
    counts = cut.groupBy("length", "shard").count()
    ahead = counts.withColumn("ahead", F.sum("count").over(Window.partitionBy("length").orderBy("shard")) - F.col("count"))
    # At most one row a length.
    histogram = {int(r[0]): int(r[1]) for r in counts.groupBy("length").agg(F.sum("count")).collect()}
    places = spark.createDataFrame(plan(histogram, capacity) or [(0, 0, -1, 0, 1, 0)],
                                   "len long, low long, high long, first long, per long, at long")
    ranked = cut.withColumn("own", F.row_number().over(
        Window.partitionBy("length", "shard").orderBy("doc_id", "start", "n"))).join(
        F.broadcast(ahead.select("length", "shard", "ahead")), ["length", "shard"])
    ranked = ranked.withColumn("rank", F.col("own") - 1 + F.col("ahead"))
    inside = (F.col("length") == F.col("len")) & F.col("rank").between(F.col("low"), F.col("high"))
    nth = F.col("rank") - F.col("low")
    return ranked.join(F.broadcast(places), inside).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("first") + F.floor(nth / F.col("per"))).alias("sequence_id"),
        (F.col("at") + F.pmod(nth, F.col("per")) * F.col("length")).alias("offset"))


@query("op7_packing")
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
