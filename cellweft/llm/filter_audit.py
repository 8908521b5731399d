"""Audit of a chain of filters: what each order of five filters removes, step by step, with exact Shapley sums.

* One pass over the texts keeps a narrow row a document: its part, its failed filters as bits, a 64-bit text hash.
* Duplicates are found by a prepass of counting Bloom sketches over those hashes. Hash bits deal documents to shards; a
  sketch counts 0, 1 or 2 and more of two cells a document. Every task makes partial sketches of its rows (sparse: cells
  in order, one bit a cell for "more than once"), so a text copied any number of times is two cells of a task; partial
  sketches are merged by shard. A text with a cell that counts one is unique for certain and leaves.
* Only possible repeats are read again with their texts and shuffled, pre-aggregated by the full text, for the smallest
  doc_id. Texts that share a hash are told apart by a second join on the text itself.
* Flags and labels fold into counts by (part, failed filters). All orders are sums over those counts (32 sets a part).

Null texts count as empty, null parts as the empty string. A null doc_id is never smaller than another and never fails E;
rows that share the smallest doc_id of a text all pass E. A document is good (toxic) if any label row of its id says so.
An empty table gives no rows. Texts of any length are read whole. Extra columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellweft.llm.common import plain, table
from cellweft.llm.registry import query
from cellweft.session import attach, col, settle

LETTERS = "ABCDE"
CELL_BITS = 24                # cells of a shard's sketch, as a power of two
SHARD_DOCS = 1 << 20          # documents a shard is made for: 16 cells each
SLICES = 16                   # parts of a sketch that are merged apart
SKETCH = "shard long, slice int, cells binary, twice binary"


def conditions(text: Column) -> list[Column]:
    """The filters A to D as conditions that a failing text meets."""
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    # A capital that is not mapped to anything goes: what is lost in length is the number of capitals.
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return [n < 100, 100 * distinct < 80 * n, 100 * capitals > 10 * F.length(text), text.rlike(r"[#$%&*|]")]


def cells(bits: int = CELL_BITS) -> tuple[Column, Column]:
    """The two cells of a hash ``h``; the bits above them deal to shards."""
    mask = (1 << bits) - 1
    return F.col("h").bitwiseAND(F.lit(mask)), F.shiftrightunsigned("h", bits).bitwiseAND(F.lit(mask))


def shard_of(shards: int) -> Column:
    return F.pmod(F.xxhash64("h"), F.lit(shards))


def _write(shard: int, found: np.ndarray, twice: np.ndarray, bits: int) -> Iterator[list]:
    edges = np.searchsorted(found, np.arange(SLICES + 1) << (bits - SLICES.bit_length() + 1))
    for k in range(SLICES):
        a, b = edges[k], edges[k + 1]
        if b > a:
            yield [shard, k, found[a:b].astype("<u4").tobytes(), np.packbits(twice[a:b]).tobytes()]


def sketch(hashes: DataFrame, shards: int, bits: int = CELL_BITS) -> DataFrame:
    """shard, cell of the cells that count two or more over all rows of ``hashes`` (column h)."""
    dealt = hashes.select(shard_of(shards).alias("shard"), *[c.alias(n) for c, n in zip(cells(bits), ("one", "two"))])

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def fold(seen: dict) -> Iterator[list]:
            for shard, (found, twice) in seen.items():
                yield from _write(shard, found, twice, bits)

        seen: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        held = 0
        for pdf in batches:
            for shard, own in pdf.groupby("shard"):
                # Both cells of one document count once where they are the same cell.
                one, two = own["one"].to_numpy(), own["two"].to_numpy()
                new, counts = np.unique(np.concatenate([one, two[two != one]]), return_counts=True)
                merged = (new, counts > 1)
                if shard in seen:
                    merged = add(seen[shard], merged)
                    held -= len(seen[shard][0])
                seen[shard] = merged
                held += len(merged[0])
            if held > 4_000_000:
                yield pd.DataFrame(list(fold(seen)), columns=["shard", "slice", "cells", "twice"])
                seen, held = {}, 0
        yield pd.DataFrame(list(fold(seen)), columns=["shard", "slice", "cells", "twice"])

    def merge(key, pdf: pd.DataFrame) -> pd.DataFrame:
        width = 1 << (bits - SLICES.bit_length() + 1)
        counts = np.zeros(width, np.uint8)
        for found, twice in zip(pdf["cells"], pdf["twice"]):
            own = np.frombuffer(found, "<u4") - key[1] * width
            more = 1 + np.unpackbits(np.frombuffer(twice, np.uint8), count=len(own))
            counts[own] = np.minimum(counts[own] + more, 2)
        again = np.flatnonzero(counts == 2) + key[1] * width
        return pd.DataFrame({"shard": key[0], "cell": again})

    return dealt.mapInPandas(partial, SKETCH).groupBy("shard", "slice").applyInPandas(merge, "shard long, cell long")


def add(a: tuple, b: tuple) -> tuple[np.ndarray, np.ndarray]:
    """The sum of two sparse sketches."""
    both = np.concatenate([a[0], b[0]])
    found, at, counts = np.unique(both, return_inverse=True, return_counts=True)
    twice = counts > 1
    twice |= np.bincount(at, np.concatenate([a[1], b[1]]), len(found)) > 0
    return found, twice


def possible_repeats(hashes: DataFrame, shard_docs: int = SHARD_DOCS, bits: int = CELL_BITS) -> DataFrame:
    """Distinct h whose two cells both count two or more: all repeated ones and few others."""
    shards = max(1, -(-hashes.count() // shard_docs))
    again = settle(sketch(hashes, shards, bits), "sketch")
    one, two = cells(bits)
    dealt = hashes.select("h", shard_of(shards).alias("shard"), one.alias("one"), two.alias("two"))
    for n in ("one", "two"):
        dealt = attach(dealt, again.withColumnRenamed("cell", n), ["shard", n], "inner", salted=False)
    return dealt.select("h").distinct()


def facts(texts: DataFrame, *more: str) -> DataFrame:
    """doc_id, part, h and the failed filters A to D as bits of ``mask``."""
    bit = [F.when(c, 1 << i).otherwise(0) for i, c in enumerate(conditions(F.col("text")))]
    return texts.select("doc_id", "part", "h", sum(bit[1:], bit[0]).alias("mask"), *more)


def with_low(texts: DataFrame, shard_docs: int = SHARD_DOCS, bits: int = CELL_BITS, h: Column | None = None) -> DataFrame:
    """The facts of ``texts`` (doc_id, part, text) and ``low``: the smallest doc_id of the same text if it may repeat."""
    texts = texts.withColumn("h", F.xxhash64("text") if h is None else h)
    own = settle(facts(texts), "facts")
    maybe = settle(possible_repeats(own, shard_docs, bits), "maybe")
    repeats = attach(texts, maybe, ["h"], "inner", salted=False)
    by_text = repeats.groupBy("h", "text").agg(F.min("doc_id").alias("low"))
    by_hash = settle(by_text.select("h", "low").groupBy("h").agg(F.min("low").alias("low"), F.count("*").alias("texts")), "lows")
    placed = attach(own, by_hash, ["h"], "left", salted=False)
    calm = placed.where("texts is null or texts = 1").drop("texts")
    clash = by_hash.where("texts > 1").select("h")
    if not clash.limit(1).count():
        return calm
    # Different texts with one hash: their rows are made again and joined on the text.
    told = attach(texts, clash, ["h"], "inner", salted=False)
    lows = told.groupBy("text").agg(F.min("doc_id").alias("low"))
    return calm.unionByName(facts(attach(told, lows, ["text"], "left", salted=False), "low"))


def mask_counts(docs: DataFrame, labels: DataFrame, part: str = "lang", shard_docs: int = SHARD_DOCS,
                bits: int = CELL_BITS) -> DataFrame:
    """part, mask (bit i: fails filter i), n, good, toxic: additive counts that every audit is a sum of."""
    texts = plain(docs, "doc_id", "text", part).select(
        "doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(col(part).cast("string"), F.lit("")).alias("part"))
    again = F.when(F.col("doc_id") > F.col("low"), 1 << LETTERS.index("E")).otherwise(0)
    marked = with_low(texts, shard_docs, bits).select("doc_id", "part", (F.col("mask") + again).alias("mask"))
    known = plain(labels, "doc_id", "quality", "toxic").where("doc_id is not null").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic"))
    joined = attach(marked, settle(known, "known"), ["doc_id"], "left", salted=False)
    return joined.groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))


def audit(counts: DataFrame) -> DataFrame:
    """part, filter_order, step and what the step's filter does, for all orders of the filters (600 steps a part)."""
    steps = [{"filter_order": "".join(o), "step": i + 1, "own": 1 << LETTERS.index(f),
              "earlier": sum(1 << LETTERS.index(e) for e in o[:i])} for o in permutations(LETTERS) for i, f in enumerate(o)]
    listed = F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order: string, step: int, own: int, earlier: int>>")
    rows = counts.select("*", F.inline(listed))
    fails, passed = "mask & own <> 0", "mask & earlier = 0"

    def total(what: str, where: str, name: str) -> Column:
        return F.expr(f"sum(if({where}, {what}, 0))").alias(name)

    by_step = rows.groupBy("part", "filter_order", "step", "own").agg(
        total("n", "mask & (earlier | own) = 0", "kept"), total("n", f"{fails} and {passed}", "removed"),
        total("n", f"{fails} and not {passed}", "redundant"), total("n", "mask = own", "unique_fails"),
        total("good", f"{fails} and {passed}", "good_lost"), total("toxic", f"{fails} and {passed}", "toxic_lost"))
    return by_step.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "own"))).drop("own")


SQL = r"""with d as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t from documents),
w as (select *, regexp_extract_all(t, '[^ 	-]+') as words, min(doc_id) over (partition by t) as low from d),
k as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id),
m as (select w.part, (len(words) < 100)::int + 2 * (100 * len(list_distinct(words)) < 80 * len(words))::int
        + 4 * (100 * (length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 10 * length(t))::int
        + 8 * regexp_matches(t, '[#$%&*|]')::int + 16 * coalesce(w.doc_id > low, false)::int as mask,
        coalesce(good, 0) as good, coalesce(toxic, 0) as toxic from w left join k using (doc_id)),
c as (select part, mask, count(*) as n, sum(good) as good, sum(toxic) as toxic from m group by all),
l as (select unnest(['A', 'B', 'C', 'D', 'E']) as f, unnest([1, 2, 4, 8, 16]) as b),
o as (select a.f || b.f || c.f || d.f || e.f as filter_order, [a.b, b.b, c.b, d.b, e.b] as bits from l a, l b, l c, l d, l e
    where a.b + b.b + c.b + d.b + e.b = 31 and a.b | b.b | c.b | d.b | e.b = 31),
s as (select filter_order, step, bits[step] as own, coalesce(list_sum(bits[1:step - 1]), 0)::int as earlier
    from o, (select unnest([1, 2, 3, 4, 5]) as step)),
g as (select part, filter_order, step, own, sum(case when mask & (earlier | own) = 0 then n else 0 end)::bigint as kept,
        sum(case when mask & own <> 0 and mask & earlier = 0 then n else 0 end)::bigint as removed,
        sum(case when mask & own <> 0 and mask & earlier <> 0 then n else 0 end)::bigint as redundant,
        sum(case when mask = own then n else 0 end)::bigint as unique_fails,
        sum(case when mask & own <> 0 and mask & earlier = 0 then good else 0 end)::bigint as good_lost,
        sum(case when mask & own <> 0 and mask & earlier = 0 then toxic else 0 end)::bigint as toxic_lost
    from c, s group by all)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    (sum(removed) over (partition by part, own))::bigint as shapley from g"""


@query("op12_filter_audit", SQL)
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(mask_counts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))
