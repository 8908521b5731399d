"""N-gram Jaccard join by signature trees.

A document's set holds the 64-bit hashes of its distinct word n-grams. Equal sets are one class. Two classes can only
link if they agree on one of the parts that the hash space is cut into: linked sets of a size band differ in d hashes
at most, and d + 1 + s parts are taken, so s + 1 parts agree. A set with at most s empty parts leaves those out, as one of
the parts it agrees on is not empty; a set with more keeps all its parts. So sets are never brought together by an empty part,
unless both of them have next to no full ones. Classes that share a part are
chained to its smallest one, the chains' components are candidate clusters, and all links lie within clusters.

Where a lower share leaves parts of few n-grams, which passages of many texts fill alone, the keys are a set's rarest n-grams
instead (``rare``): in any one order of all n-grams, linked sets of up / down have one in common among the first
size - ceil(size * up / down) + 1 of both. The order is by a sketch of how many texts hold an n-gram, which may count too many
but never too few; so the order only decides how many candidates there are, and an n-gram counted once needs no key.

A cluster's classes are dealt, in order of size, to blocks of some BLOCK classes and BLOCK_HASHES hashes. A class goes to the
pairs of its own block with those that hold sizes it may link with, and each pair of blocks is one task's work: both blocks get a signature tree whose nodes hold the OR of their members' token bitmaps and their
range of sizes, and a dual traversal leaves a pair of nodes when the greatest possible overlap is too small or when all
their members are already linked through each other. Pairs of leaves are compared exactly. Links found by all tasks
are closed into components. A class is a node of its own number, so texts that share a doc_id stay apart.

Null texts and texts without words have an empty set and link with nothing. With fewer than n words the whole
sequence is the one n-gram. Exact copies and repeated rows fall into one class; each row comes back. A null doc_id takes part
in no component and keeps a null one. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import functools
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellweft.llm.common import LOWER, components, give_back, plain, table, utf8
from cellweft.llm.registry import query
from cellweft.operators.prefix import offsets
from cellweft.session import attach, release, settle

BLOCK = 2048         # classes of one block
BLOCK_HASHES = 4_000_000
LEAF = 16
BITS = 1024          # of a node's bitmap
CELLS = 1 << 26      # of the sketch, a byte each
CHUNK = 1 << 20      # cells that are summed in one task
MIX = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | bytes | None, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-grams of words."""
    words = (text if isinstance(text, bytes) else utf8(text)).translate(LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < n:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), len(words))], np.uint64)
    known: dict[bytes, int] = {}
    for w in set(words):
        known[w] = xxhash.xxh64_intdigest(w, 1)
    h = np.fromiter((known[w] for w in words), np.uint64, len(words))
    out = np.zeros(len(words) - n + 1, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(n):
            out = (out ^ h[j:j + len(out)]) * MIX
            out ^= out >> np.uint64(29)
    return np.unique(out)


def spare_parts(low: int, differ: int) -> int:
    """s: parts that a set of ``low`` hashes leaves empty, at most, but for some 1 in 30,000 (four deviations)."""
    spare = 0
    for _ in range(20):
        parts = differ + 1 + spare
        none = math.exp(-low / parts)
        deviation = math.sqrt(parts * none * max(0.0, 1 - (1 + low / parts) * none))
        need = math.ceil(parts * none + 4 * deviation)
        if need <= spare:
            break
        spare = need
    return spare


@functools.lru_cache(100_000)
def bands(size: int, share: tuple[int, int]) -> list[tuple[int, int, int]]:
    """(band, d, s): a pair belongs to the size band of its smaller set, so a set may also count in the band before its own."""
    up, down = share
    band, low, high, before = 0, 1, 1, None
    while size > high:
        before = (band, low, high)
        band, low = band + 1, high + 1
        high = max(low, low * down * down // (up * up))

    def one(band: int, low: int, high: int) -> tuple[int, int, int]:
        # The partner has at most high * down / up hashes; linked sets differ by a share of their summed sizes.
        differ = (down - up) * (high + high * down // up) // (down + up)
        return band, differ, spare_parts(low, differ)

    out = [one(band, low, high)]
    if before and size * up <= before[2] * down:
        out.append(one(*before))
    return out


def part_keys(hashes: np.ndarray, share: tuple[int, int]) -> np.ndarray:
    out = []
    mixed = (hashes * MIX) >> np.uint64(32)
    for band, differ, spare in bands(len(hashes), share):
        parts = differ + 1 + spare
        own = (mixed % np.uint64(parts)).astype(np.int64)
        total = np.zeros(parts, np.uint64)
        with np.errstate(over="ignore"):
            spread = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
            np.add.at(total, own, spread)
            key = (total ^ (np.arange(parts, dtype=np.uint64) << np.uint64(20)) ^ np.uint64(band)) * MIX
        full = np.bincount(own, minlength=parts) > 0
        if parts - full.sum() <= spare:
            key = key[full]
        out.append(key ^ (key >> np.uint64(32)))
    return np.concatenate(out).view(np.int64)


def cell_of(hashes: np.ndarray, cells: int) -> np.ndarray:
    return ((hashes * MIX) >> np.uint64(20)).astype(np.int64) % cells


def text_counts(docs: DataFrame, n: int, cells: int) -> dict[int, bytes]:
    """Deflated chunks of the sketch: in how many texts the n-grams of a cell stand, up to 255; empty chunks are left out."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros(cells, np.uint8)
        for batch in batches:
            for at in range(0, len(batch), 256):
                own = [cell_of(shingles(t, n), cells) for t in batch["text"].iloc[at:at + 256]]
                found, more = np.unique(np.concatenate(own), return_counts=True)
                seen[found] = np.minimum(seen[found] + more, 255)
        for at in range(0, cells, CHUNK):
            if seen[at:at + CHUNK].any():
                yield pd.DataFrame({"chunk": [at // CHUNK], "counts": [zlib.compress(seen[at:at + CHUNK].tobytes(), 1)]})
        batch = None
        give_back()

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        out = np.zeros(min(cells, CHUNK), np.uint8)
        for part in pdf["counts"]:
            out = np.minimum(out.astype(np.uint16) + np.frombuffer(zlib.decompress(part), np.uint8), 255).astype(np.uint8)
        return pd.DataFrame({"chunk": pdf["chunk"].iloc[:1], "counts": [zlib.compress(out.tobytes(), 1)]})

    form = "chunk int, counts binary"
    return {r["chunk"]: bytes(r["counts"]) for r in docs.select("text").mapInPandas(count, form).groupBy(
        "chunk").applyInPandas(total, form).collect()}


def inflated(chunks: dict[int, bytes], cells: int) -> np.ndarray:
    out = np.zeros(cells, np.uint8)
    for chunk, counts in chunks.items():
        out[chunk * CHUNK:(chunk + 1) * CHUNK] = np.frombuffer(zlib.decompress(counts), np.uint8)
    return out


def rare_keys(hashes: np.ndarray, counts: np.ndarray, share: tuple[int, int]) -> np.ndarray:
    up, down = share
    own = counts[cell_of(hashes, len(counts))]
    first = np.argsort(own, kind="stable")[:len(hashes) + 1 + -len(hashes) * up // down]  # ties by hash, as hashes are sorted
    return hashes[first[own[first] > 1]].view(np.int64)


class Tree:
    """Signature tree over sets in order of size; node i has the children 2i+1, 2i+2 unless it is a leaf."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        self.nodes: list = []
        marks = np.zeros((len(sets), BITS), bool)
        for i, s in enumerate(sets):
            marks[i, (s % np.uint64(BITS)).astype(int)] = True
        self.build(0, len(sets), marks)

    def build(self, a: int, b: int, marks: np.ndarray) -> int:
        at = len(self.nodes)
        self.nodes.append(None)
        sizes = [len(s) for s in self.sets[a:b]]
        kids = () if b - a <= LEAF else (self.build(a, (a + b) // 2, marks), self.build((a + b) // 2, b, marks))
        # How many hashes of a member fall on a bit, at most: bounds the overlap, together with the bitmap.
        lone = min(int(marks[i].sum()) for i in range(a, b))
        self.nodes[at] = (a, b, min(sizes), max(sizes), np.packbits(marks[a:b].any(0)), lone, kids)
        return at


def overlap_bound(x: tuple, y: tuple) -> int:
    """The most hashes that a member of x and one of y can share."""
    # A member has at least ``lone`` bits set; those outside the other node's bitmap are hashes it cannot share.
    common = int(np.bitwise_count(x[4] & y[4]).sum())
    return min(x[3] - max(0, x[5] - common), y[3] - max(0, y[5] - common), x[3], y[3])


def dual_links(left: list[np.ndarray], right: list[np.ndarray] | None, share: tuple[int, int]) -> list[tuple[int, int]]:
    """Links that join all linked members of both lists; members of ``right`` count on from those of ``left``."""
    up, down = share
    one = Tree(left)
    two = one if right is None else Tree(right)
    shift = 0 if right is None else len(left)
    root = list(range(len(left) + (len(right) if right else 0)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    links, todo = [], [(0, 0)]
    while todo:
        i, j = todo.pop()
        x, y = one.nodes[i], two.nodes[j]
        if up * max(x[2], y[2]) > down * min(x[3], y[3]):
            continue
        if down * overlap_bound(x, y) < up * max(x[2], y[2]):
            continue
        if len({find(a) for a in range(x[0], x[1])} | {find(b + shift) for b in range(y[0], y[1])}) == 1:
            continue
        if x[6] or y[6]:
            if i == j and one is two:
                todo += [(x[6][0], x[6][1]), (x[6][1], x[6][1]), (x[6][0], x[6][0])]
            elif x[6] and (not y[6] or x[1] - x[0] >= y[1] - y[0]):
                todo += [(k, j) for k in x[6]]
            else:
                todo += [(i, k) for k in y[6]]
            continue
        for a in range(x[0], x[1]):
            for b in range(max(y[0], a + 1) if one is two else y[0], y[1]):
                s, t = one.sets[a], two.sets[b]
                if up * max(len(s), len(t)) > down * min(len(s), len(t)) or find(a) == find(b + shift):
                    continue
                both = len(np.intersect1d(s, t, assume_unique=True))
                if down * both >= up * (len(s) + len(t) - both):
                    links.append((a, b + shift))
                    root[find(b + shift)] = find(a)
    return links


def row_hash() -> Column:
    return F.xxhash64("doc_id", "text")


def jaccard_classes(docs: DataFrame, n: int = 5, share: tuple[int, int] = (4, 5), block: int = BLOCK) -> DataFrame:
    """Per row of docs: doc_id, n_shingles, component_id; documents link when down * both >= up * union."""
    return jaccard_rows(docs, n, share, block).select("doc_id", "n_shingles", "component_id")


def deal(placed: DataFrame, share: tuple[int, int], block: int) -> DataFrame:
    """component, size, n, cost, before_cost; near and far, the first and last block with sizes that may link with this one.

    ``placed`` holds a row per class: component, size. A class costs one, or more if it is long; positions are summed costs
    in order of size. A component's windows run over its distinct sizes.
    """
    up, down = share
    cost = F.expr(f"(size - 1) div {max(1, BLOCK_HASHES // block)} + 1")
    sizes = settle(placed.groupBy("component", "size").agg(F.count("*").alias("n")).withColumn("cost", cost).withColumn(
        "total", F.col("n") * F.col("cost")), "sizes")
    at = offsets(sizes, ["component"], "size", ["total"]).withColumnRenamed("before_total", "before_cost").withColumns({
        "first": F.expr(f"cast(before_cost div {block} as int)"),
        "last": F.expr(f"cast((before_cost + total - 1) div {block} as int)")})
    at = settle(at.select("component", "size", "n", "cost", "before_cost", "first", "last"), "positions")

    def reach(limit: Column, found: str, name: str, order: Column) -> DataFrame:
        """``found`` of the last size up to the limit, in the given order: sizes and limits are sorted together."""
        both = at.select("component", F.col("size").alias("v"), F.col(found), F.lit(None).cast("long").alias("size")).unionByName(
            at.select("component", limit.alias("v"), F.lit(None).cast("int").alias(found), "size"))
        window = Window.partitionBy("component").orderBy(order, F.col("size").asc_nulls_first()).rowsBetween(
            Window.unboundedPreceding, 0)
        return both.withColumn(name, F.last(found, True).over(window)).where("size is not null").select("component", "size", name)

    far = reach(F.expr(f"size * {down} div {up}"), "last", "far", F.col("v").asc())
    near = reach(F.expr(f"(size * {up} + {down - 1}) div {down}"), "first", "near", F.col("v").desc())
    return at.drop("first", "last").join(near, ["component", "size"]).join(far, ["component", "size"])


def jaccard_rows(docs: DataFrame, n: int, share: tuple[int, int], block: int = BLOCK, rare: bool = False) -> DataFrame:
    """jaccard_classes with copy, a hash of doc_id and text, and node, which is the component's own number (null for
    rows that take part in none); components of several texts of one id have the same component_id and different nodes.
    ``rare``: keys are rare n-grams instead of parts."""
    docs = plain(docs, "doc_id", "text")
    cells = CELLS
    shared = docs.sparkSession.sparkContext.broadcast(text_counts(docs, n, cells)) if rare else None

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = inflated(shared.value, cells) if rare else None
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at:at + 256]
                own = [shingles(t, n) for t in part["text"]]
                keys = [rare_keys(s, counts, share) if rare else part_keys(s, share) if len(s) else np.empty(0, np.int64)
                        for s in own]
                yield pd.DataFrame({"doc_id": part["doc_id"].astype("Int64"), "copy": part["copy"],
                                    "n_shingles": [len(s) for s in own],
                                    "class": [xxhash.xxh128_digest(s.tobytes()) for s in own],
                                    "keys": keys})
        batch = part = None
        give_back()

    every = settle(docs.withColumn("copy", row_hash()).mapInPandas(
        sets, "doc_id long, copy long, n_shingles long, class binary, keys array<long>"), "shingles")
    if rare:
        shared.unpersist()
    # One document stands for its class; only those in clusters have their sets built again, from their texts.
    heads = every.where("n_shingles > 0 and doc_id is not null").groupBy("class").agg(
        F.min("doc_id").alias("head"), F.min("n_shingles").alias("size"))
    heads = settle(heads.withColumn("node", F.monotonically_increasing_id()), "heads")
    # Each step is stored by itself, so that no two steps' shuffles are on disk at once.
    own_class = (F.col("doc_id") == F.col("head")) & (F.col("class") == F.col("c"))
    owned = settle(every.join(heads.select("head", "node", F.col("class").alias("c")), own_class).select("node", "keys"), "keys")
    wide, every = every, settle(every.drop("keys"), "texts")
    release(wide)
    keys = owned.select("node", F.explode("keys").alias("key"))
    first = settle(keys.groupBy("key").agg(F.min("node").alias("low"), F.count("*").alias("c")).where("c > 1").drop("c"), "firsts")
    chained = keys.join(first, "key").where("node <> low").select(F.col("node").alias("a"), F.col("low").alias("b"))
    clusters = settle(components(chained), "clusters")
    release(owned, first)

    # A deflated text is a third of its set, whose hashes don't shrink; so texts are sent and sets built where they meet.
    def deflated(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[["node", "component", "block", "near", "far", "class"]].assign(
                text=[zlib.compress(utf8(t), 1) for t in batch["text"]])
        batch = None
        give_back()

    placed = clusters.join(heads, "node").select("node", "head", "class", "component", "size")
    dealt = settle(deal(placed, share, block), "dealt")
    placed = placed.join(dealt, ["component", "size"]).select(
        "node", "head", "class", "component", "near", "far", F.expr(
            f"cast((before_cost + pmod(xxhash64(node), n) * cost) div {block} as int)").alias("block"))
    placed = settle(docs.join(placed, F.col("doc_id") == F.col("head")).select(
        "node", "class", "component", "block", "near", "far", "text").mapInPandas(
        deflated, "node long, component long, block int, near int, far int, class binary, text binary"), "deflated")
    # Large clusters send a text to many pairs; they go in rounds that send no more than some n-grams of the whole table.
    sent = dealt.agg(F.sum(F.expr("double(n) * size * (far - near + 1)"))).first()[0] or 0.0
    rounds = max(1, math.ceil(sent / max(heads.agg(F.sum("size")).first()[0] or 1, 1)))
    pairs = placed.withColumn("other", F.explode(F.sequence("near", "far"))).select(
        "component", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), "block", "node",
        "class", "text")

    def link(key, pdf: pd.DataFrame) -> pd.DataFrame:
        if key[1] != key[2] and pdf["block"].nunique() < 2:
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        # Another text under the head's id is of another class; a repeated row of a node is the same set again.
        pdf = pdf.assign(hashes=[shingles(zlib.decompress(t), n) for t in pdf["text"]]).drop(columns="text")
        pdf = pdf[[xxhash.xxh128_digest(s.tobytes()) == c for s, c in zip(pdf["hashes"], pdf["class"])]].drop_duplicates("node")
        pdf = pdf.assign(size=pdf["hashes"].map(len)).sort_values(["size", "node"])
        sides = [pdf[pdf["block"] == key[1]], pdf[pdf["block"] == key[2]]] if key[1] != key[2] else [pdf]
        sides = [s for s in sides if len(s)]
        if key[1] != key[2] and len(sides) < 2:
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        own = [list(s["hashes"]) for s in sides]
        names = np.concatenate([s["node"].to_numpy() for s in sides])
        found = np.array(dual_links(own[0], own[1] if len(own) > 1 else None, share), int).reshape(-1, 2)
        return pd.DataFrame({"a": names[found[:, 0]], "b": names[found[:, 1]]})

    found = [settle(pairs.where(F.pmod(F.xxhash64("component", "p", "q"), F.lit(rounds)) == i).groupBy("component", "p", "q").applyInPandas(
        link, "a long, b long"), "links") for i in range(rounds)]
    linked = components(functools.reduce(DataFrame.unionByName, found))
    # A component's smallest node need not be that of its smallest document.
    names = linked.join(heads, "node").groupBy("component").agg(F.min("head").alias("low"))
    members = heads.join(linked, "node", "left").select("class", "head", F.coalesce("component", "node").alias("node"))
    named = attach(members, names.select(F.col("component").alias("node"), "low"), ["node"]).select(
        "class", "node", F.coalesce("low", "head").alias("component_id"))
    linking = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    return every.select("doc_id", "n_shingles", "class", "copy").join(named, "class", "left").select(
        "doc_id", "n_shingles", F.when(linking, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(linking, F.col("node")).alias("node"), "copy")


def first_of_groups(docs: DataFrame, n: int = 5, share: tuple[int, int] = (4, 5)) -> DataFrame:
    """``docs`` with one row of each group of near copies, of the smallest id; rows without an id or words stay."""
    found = jaccard_rows(docs, n, share, rare=True).where("node is not null")
    contents = settle(found.groupBy("node", "component_id", "doc_id", "copy").agg(F.count("*").alias("n")), "contents")
    kept = contents.where("doc_id = component_id").groupBy("node").agg(F.min("copy").alias("copy"))
    gone = contents.join(kept, ["node", "copy"], "left_anti").select("doc_id", "copy", F.lit(False).alias("again"))
    again = contents.where("n > 1").join(kept, ["node", "copy"], "left_semi").select(
        "doc_id", "copy", F.lit(True).alias("again"))
    marks = settle(gone.unionByName(again), "marks").withColumnsRenamed(
        {"doc_id": "__id", "copy": "__copy", "again": "__again"})
    marked = attach(docs.withColumns({"__id": F.col("doc_id"), "__copy": row_hash()}), marks, ["__id", "__copy"])
    once = marked.where("__again").dropDuplicates(["__id", "__copy"])
    return marked.where("__again is null").unionByName(once).select(*docs.columns)


@query("op2_jaccard_join")
def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents"), 3, (90, 100))
