"""Mixing, filter audit and centroid clusters against plain Python on awkward rows."""

import hashlib
import math
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest

from cellweft.llm import centroid_clusters as cc
from cellweft.llm import filter_audit as fa
from cellweft.llm import mixing

DOCS = [(1, "a b c d e", "s"), (2, None, "s"), (3, "", None), (4, "w " * 4000, "t"), (4, "w " * 4000, "t"), (5, "x y", "ü"),
        (None, "k l m", None), (6, "one", "u"), (7, "  \t\n", "s"), (8, "p q " * 30, "s"), (8, "other text", "s"),
        *[(9, "again and again", "v")] * 40]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, s, "clash", 3, "x") for i, t, s in DOCS],
                                 "doc_id long, text string, source string, content string, sid int, size string")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def targets(sizes, repeats=3):
    """Shares set to their limits one after the other until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    held = set()
    while True:
        left = sum(sizes.values()) - sum(repeats * sizes[s] for s in held)
        rest = sum(w for s, w in weight.items() if s not in held)
        out = {s: float(repeats * sizes[s]) if s in held else left * weight[s] / rest for s in names}
        over = {s for s in names if s not in held and out[s] > repeats * sizes[s]}
        if not over:
            return out
        held |= over


def test_mix(docs):
    done = mixing.mix(docs, block=7, bucket_rows=3)
    rows, spans = done.rows.collect(), done.spans.orderBy("position").collect()
    sources = {r["source"]: r for r in done.sources.collect()}
    sizes = Counter()
    for _, text, source in DOCS:
        sizes[source] += len(words(text))
    want = targets(sizes)
    assert {s: r["target"] for s, r in sources.items()} == pytest.approx(want)
    assert len(rows) == len(DOCS) and sum(r["size"] for r in rows) == sum(sizes.values())
    taken, each = Counter(), Counter()
    for s in spans:
        assert s["length"] > 0 and 0 <= s["start"] and s["start"] + s["length"] <= s["size"]
        taken[s["sid"]] += s["length"]
        each[tuple(s[c] for c in mixing.ROW)] += s["length"]
    assert all(taken[r["sid"]] == math.floor(r["target"] + 0.5) for r in sources.values())
    assert all(n <= 3 * k[-1] for k, n in each.items())
    # Slots are 0 .. S-1, each of one source, and every source is spread as evenly as the sequence allows.
    slots = {s["position"]: s["sid"] for s in spans}
    total = sum(r["slots"] for r in sources.values())
    assert set(slots) == set(range(total))
    for r in sources.values():
        seen = 0
        for i in range(total):
            seen += slots[i] == r["sid"]
            assert abs(seen - (i + 1) * r["slots"] / total) < 2 + math.log2(total)
    again = mixing.mix(docs.repartition(5), block=7, bucket_rows=3).spans
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, spans), key=str)
    assert mixing.mix(docs.limit(0)).spans.count() == 0


def test_mixed_texts_and_long_groups(docs, monkeypatch):
    monkeypatch.setattr(mixing, "STEP", 8)  # copies, blocks of a text and slots are exploded in two steps
    done = mixing.mix(docs, block=7, bucket_rows=2)
    texts = mixing.span_texts(done.spans, docs).collect()
    assert len(texts) == done.spans.count()
    by_row = {(r[0], hashlib.md5((r[1] or "").encode()).hexdigest()): words(r[1]) for r in DOCS}
    for t in texts:
        assert t["text"].split(" ") == by_row[t["doc_id"], t["content"]][t["start"]:t["start"] + t["length"]]


def test_reversed_rank(spark):
    for low, high in ((0, 37), (5, 30), (12, 13), (0, 64)):
        bits = 6
        order = sorted(range(low, high), key=lambda v: int(f"{v:0{bits}b}"[::-1], 2))
        got = spark.range(low, high).selectExpr("id as v", f"{low}L as a", f"{high}L as b").select(
            "v", mixing.reversed_rank("v", "a", "b", bits).alias("r")).collect()
        assert {r["v"]: r["r"] for r in got} == {v: i for i, v in enumerate(order)}


def masks(rows):
    low = {}
    for i, t, _ in rows:
        if i is not None:
            low[t or ""] = min(low.get(t or "", i), i)
    for i, t, part in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        yield i, part or "", (len(w) < 100) + 2 * (100 * len(set(w)) < 80 * len(w)) + 4 * (
            100 * len(re.findall("[A-Z]", t)) > 10 * len(t)) + 8 * bool(re.search(r"[#$%&*|]", t)) + 16 * (
            i is not None and i > low[t])


LONG = " ".join(f"word{i}" for i in range(150))
AUDIT = [(1, LONG, "en"), (2, LONG, "de"), (2, LONG, "en"), (3, None, None), (4, "", "en"), (5, "ABC #", ""), (None, LONG, "en"),
         (6, LONG + " ÄÖ", "en"), (7, LONG.upper(), "de"), (8, "same " * 200, "de"), (8, "same " * 200, "de"), (9, LONG, "fr"),
         *[(i, "copied text", "en") for i in range(100, 160)]]
LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, None), (5, 1, 1), (120, 1, 0), (None, 1, 1), (999, 1, 1)]


def want_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    facts = list(masks(rows))
    out, total = {}, Counter()
    for part in {p for _, p, _ in facts}:
        for order in permutations("ABCDE"):
            before = 0
            for k, f in enumerate(order):
                bit = 1 << "ABCDE".index(f)
                own = [(i, m) for i, p, m in facts if p == part]
                gone = [i for i, m in own if m & bit and not m & before]
                total[part, f] += len(gone)
                out[part, "".join(order), k + 1] = [
                    sum(not m & (before | bit) for _, m in own), len(gone), sum(bool(m & bit and m & before) for _, m in own),
                    sum(m == bit for _, m in own), sum(i in good for i in gone), sum(i in toxic for i in gone)]
                before |= bit
    return {k: (*v, total[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audited(counts):
    return {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in (
        "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))
        for r in fa.audit(counts).collect()}


def test_audit(spark):
    docs = spark.createDataFrame([(i, t, p, 1, "x", 2) for i, t, p in AUDIT],
                                 "doc_id long, text string, lang string, mask int, part string, low int").repartition(7)
    labels = spark.createDataFrame([(*r, "y") for r in LABELS], "doc_id long, quality int, toxic int, part string")
    want = want_audit(AUDIT, LABELS)
    assert audited(fa.mask_counts(docs, labels)) == want
    # Sketches of 16 cells in shards of 8 documents: nearly all cells clash, the counts stay exact.
    assert audited(fa.mask_counts(docs, labels, shard_docs=8, bits=4)) == want
    assert fa.audit(fa.mask_counts(docs.limit(0), labels.limit(0))).count() == 0


def test_equal_hashes_of_different_texts(spark):
    from pyspark.sql import functions as F
    docs = spark.createDataFrame([(i, t or "", p or "") for i, t, p in AUDIT], "doc_id long, text string, part string")
    low = fa.with_low(docs, h=F.pmod(F.length("text"), F.lit(2)).cast("long")).collect()
    got = Counter((r["doc_id"], r["part"], r["mask"] + 16 * (r["doc_id"] is not None and r["doc_id"] > r["low"])) for r in low)
    assert got == Counter(masks(AUDIT))


def test_sketch_clears_unique_texts(spark):
    hashes = spark.range(40000).selectExpr("xxhash64(if(id < 1000, id % 10, id)) as h").repartition(6)
    found = {r["h"] for r in fa.possible_repeats(hashes, shard_docs=10000, bits=18).collect()}
    repeated = {r["h"] for r in hashes.groupBy("h").count().where("count > 1").collect()}
    assert len(repeated) == 10 and repeated <= found and len(found) < 2500


def brute_clusters(rows, k, rounds, dimension, scale, seed):
    kept = [(i, [math.floor(scale * v) for v in x]) for i, x in rows
            if x is not None and len(x) == dimension and all(v is not None and math.isfinite(v) for v in x)]
    digest = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    centres = [x for _, x in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]
    for n in range(rounds + 1):
        out = []
        for i, x in kept:
            d = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in centres]
            out.append((i, d.index(min(d)), min(d), x))
        if n < rounds:
            for j in range(len(centres)):
                own = [x for _, c, _, x in out if c == j]
                if own:
                    centres[j] = [sum(col) // len(own) for col in zip(*own)]
    return centres, out


def cluster_rows(rows, spark, **how):
    table = spark.createDataFrame([(i, x, 0, "c") for i, x in rows], "vec_id long, embedding array<double>, cluster int, ids string")
    done = cc.cluster(table.repartition(3), **how)
    return done, sorted(((r["vec_id"], r["cluster"], r["distance"]) for r in done.vectors.collect()), key=str)


def test_clusters(spark):
    rng = np.random.default_rng(3)
    rows = [(i, list(map(float, x))) for i, x in enumerate(np.round(rng.normal(size=(300, 5)) + rng.integers(0, 4, (300, 1)), 1))]
    rows += [(7, rows[7][1])] * 30 + [(None, [1.0] * 5), (400, None), (401, [1.0]), (402, [1.0, None, 0.0, 0.0, 0.0]),
                                      (403, [float("nan")] * 5), (404, [float("inf")] * 5), (405, [-0.01] * 5), (406, [])]
    how = dict(k=6, rounds=3, dimension=5, scale=8, seed=1)
    centres, want = brute_clusters(rows, *how.values())
    for leading in (1, 2, 5):
        done, got = cluster_rows(rows, spark, leading=leading, **how)
        assert done.centroids == centres and got == sorted(((i, c, d) for i, c, d, _ in want), key=str)
    few, _ = cluster_rows(rows[:4], spark, **how)
    assert len(few.centroids) == 4
    none, got = cluster_rows([(1, None)], spark, **how)
    assert none.centroids == [] and got == [] and none.sizes.count() == 0


def test_clusters_of_huge_components(spark):
    rows = [(1, [2.0 ** 20, 1.0]), (2, [2.0 ** 31, -3.0]), (3, [2.0 ** 31 + 1, 5.0]), (4, [1e200, 0.0]), (5, [0.0, 0.0]), (6, [7.5, 1.25])]
    how = dict(k=3, rounds=2, dimension=2, scale=64, seed=1)
    centres, want = brute_clusters(rows, *how.values())
    done, got = cluster_rows(rows, spark, **how)
    assert done.centroids == centres
    assert got == sorted(((i, c, d if d < 2 ** 63 else None) for i, c, d, _ in want), key=str)


def test_bound_rules_out_centroids():
    rng = np.random.default_rng(5)
    centres = rng.normal(scale=300, size=(16, 64)).astype(np.int64)
    x = centres[rng.integers(0, 16, 4000)] + rng.normal(scale=40, size=(4000, 64)).astype(np.int64)
    ones = np.hstack([x, np.ones((4000, 1))])
    axes = cc.rotation(ones.T @ ones, cc.LEADING)
    at, far, taken = cc.nearest(x, centres, *cc.rotated(x, axes), axes)
    full = ((x[:, None] - centres) ** 2).sum(2)
    assert (at == full.argmin(1)).all() and (far == full.min(1)).all()
    print("distances taken of all:", taken / full.size)
    assert taken < 0.25 * full.size
