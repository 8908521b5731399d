"""Many fits of one training table side by side: the draws of a hyper-parameter search, spread over the cluster.

All labelled rows take part: Spark counts equal ones, and these entries with their counts go to every executor once. What is
distributed are the fits: each row of a table of units names a family, a fold and a range of trees, or one linear fit.
Where the entries are too many for that (``whole_rows`` gives None), ``search`` fits from tables instead.

* Forests whose draws differ only in depth and number of trees are prefixes of one another, as a tree's choices depend on
  its own number and on the path to a node alone. So a unit grows a range of trees once, to the deepest draw, and gives
  the held-out probabilities at every depth and number of trees that a draw asks for; Spark adds up the ranges.
* Trees are grown level by level, all trees of a unit in the same passes over binned rows. Equal binned rows are one
  entry with a count.
* Linear fits are damped Newton steps with soft thresholds, each one pass over a fold's rows.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweft.operators.sampling import sample_rows
from cellweft.session import col, settle

SEARCH_ROWS = 50_000         # rows of ``take_rows``
SEARCH_VALUES = 16_000_000   # rows x features of ``take_rows``
HELD_VALUES = 4_000_000      # values of the entries that a driver and a task hold
BINS = 32                    # of a feature in a forest
ENTRIES = 250_000            # entries x trees that a unit holds
DRAWN = 1_000_000            # rows of a bootstrap that are drawn one by one; of more the entries' counts are drawn
FORESTS = ("RandomForest", "ForestNoBootstrap")
UNIT = "family string, fold int, params string, first int, last int, draws string"
PART = "family string, draw int, fold int, trees int, sums array<double>, score double"


@dataclass
class Rows:
    x: np.ndarray       # NaN where missing
    y: np.ndarray
    weight: np.ndarray
    held: np.ndarray    # rows x folds: held out in that fold
    n: np.ndarray | None = None  # how many equal rows an entry stands for; None is one each


@dataclass
class Fold:
    x: np.ndarray       # training rows, filled and standardised
    y: np.ndarray
    weight: np.ndarray
    held_x: np.ndarray
    held_y: np.ndarray
    bins: np.ndarray    # entries of equal training rows
    entry_y: np.ndarray
    entry_weight: np.ndarray
    count: np.ndarray
    held_bins: np.ndarray
    pos: np.ndarray     # held-out rows of each held entry
    neg: np.ndarray
    merged: tuple | None = None  # first row and size of the entries of equal rows, for the linear fits
    n: np.ndarray | None = None       # equal rows that a row of x stands for
    held_n: np.ndarray | None = None  # and one of held_x


def whole_rows(train: DataFrame, folds: list[str], features: list[str], weight: str | None, most: int | None = None,
               ) -> Rows | None:
    """All rows of a search as entries with counts, or None where these are more than ``most`` or hold over HELD_VALUES values."""
    own = train.select(*[col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)],
                       F.col("label").cast("double").alias("y"), (col(weight) if weight else F.lit(1.0)).cast("double").alias("w"),
                       *[col(f).alias(f"h{i}") for i, f in enumerate(folds)])
    entries = settle(own.groupBy(*own.columns).agg(F.count("*").alias("n")), "entries")
    limit = HELD_VALUES // len(entries.columns)
    if entries.count() > (limit if most is None else min(most, limit)):
        return None
    held = entries.toPandas().sort_values(own.columns, kind="stable")
    return _rows(held, len(features), len(folds), held["n"].to_numpy(np.int64))


def _rows(own: pd.DataFrame, features: int, folds: int, n: np.ndarray | None = None) -> Rows:
    part = lambda tag, n: np.column_stack([own[f"{tag}{i}"].to_numpy() for i in range(n)])
    return Rows(part("x", features).astype(float), (own["y"].to_numpy() > 0).astype(np.int8),
                own["w"].to_numpy(float), part("h", folds).astype(bool), n)


def take_rows(train: DataFrame, folds: list[str], features: list[str], weight: str | None, limit: int = SEARCH_ROWS) -> Rows:
    """At most ``limit`` rows and SEARCH_VALUES values, by hash of the row key. Searches do not use it: they see all rows."""
    limit = max(1, min(limit, SEARCH_VALUES // max(1, len(features))))
    if train.count() > limit:
        train = sample_rows(train, limit)
    own = train.select("row_key", *[col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)],
                       F.col("label").cast("double").alias("y"), (col(weight) if weight else F.lit(1.0)).alias("w"),
                       *[col(f).alias(f"h{i}") for i, f in enumerate(folds)]).toPandas()
    return _rows(own.sort_values("row_key", kind="stable"), len(features), len(folds))


def quantiles(x: np.ndarray, n: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """As np.quantile of the values x, each n times."""
    order = np.argsort(x, kind="stable")
    values, upto = x[order], n[order].cumsum()
    place = shares * (upto[-1] - 1)
    low = np.floor(place).astype(np.int64)
    t = place - low
    a = values[np.searchsorted(upto, low, side="right")]
    b = values[np.searchsorted(upto, np.minimum(low + 1, upto[-1] - 1), side="right")]
    return np.where(t < 0.5, a + (b - a) * t, b - (b - a) * (1 - t))


def cuts(x: np.ndarray, n: np.ndarray | None = None) -> np.ndarray:
    """At most BINS - 1 split points: between all values if they are few, else quantiles."""
    values = np.unique(x)
    if len(values) <= BINS:
        return (values[1:] + values[:-1]) / 2
    return np.unique(quantiles(x, np.ones(len(x), np.int64) if n is None else n, np.arange(1, BINS) / BINS))


def same(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First row, number of the entry of each row, and size of the entries of rows that agree in all parts."""
    flat = np.ascontiguousarray(np.hstack([np.ascontiguousarray(p).view(np.uint8).reshape(len(p), -1) for p in parts]))
    if not len(flat):
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0, int)
    _, first, at, count = np.unique(flat.view(f"V{flat.shape[1]}").ravel(), return_index=True, return_inverse=True, return_counts=True)
    return first, at.ravel(), count


def make_fold(rows: Rows, i: int, strategy: str) -> Fold:
    """What fold i trains on and is scored on. Everything fitted (fills, scales, bins) is of its training rows."""
    out = rows.held[:, i]
    n = np.ones(len(rows.x), np.int64) if rows.n is None else rows.n
    own, times = rows.x[~out], n[~out]
    known = ~np.isnan(own)

    def middle(j: int) -> float:
        v, of = own[known[:, j], j], times[known[:, j]]
        if not len(v):
            return 0.0
        return float(quantiles(v, of, np.array([0.5]))[0] if strategy == "median" else np.average(v, weights=of))

    fill = np.array([middle(j) for j in range(own.shape[1])])
    x = np.where(np.isnan(rows.x), fill, rows.x)
    mean = np.average(x[~out], axis=0, weights=times) if len(times) else np.zeros(x.shape[1])
    spread = np.sqrt(np.average((x[~out] - mean) ** 2, axis=0, weights=times)) if len(times) else np.ones(x.shape[1])
    scaled = (x - mean) / np.where(spread > 0, spread, 1)
    bins = np.column_stack([np.searchsorted(cuts(x[~out, j], times), x[:, j]).astype(np.uint8) for j in range(x.shape[1])])
    b, y, w = bins[~out], rows.y[~out], rows.weight[~out]
    first, at, _ = same([b, y[:, None], w[:, None]])
    count = np.bincount(at, times, len(first)).astype(np.int64)
    h_first, h_at, _ = same([bins[out]])
    pos = np.bincount(h_at, n[out] * rows.y[out], len(h_first))
    neg = np.bincount(h_at, n[out] * (1 - rows.y[out]), len(h_first))
    return Fold(scaled[~out], y, w, scaled[out], rows.y[out], b[first], y[first], w[first], count, bins[out][h_first], pos, neg,
                n=times, held_n=n[out])


def class_factors(y: np.ndarray, count: np.ndarray, kind: str | None) -> np.ndarray:
    """Weight of class 0 and 1: even, or n / (2 * rows of the class)."""
    if not kind:
        return np.ones(2)
    sizes = np.bincount(y, count, 2)
    return np.where(sizes > 0, sizes.sum() / np.maximum(2 * sizes, 1), 1.0)


def subset_size(kind: str | int, features: int) -> int:
    """Features tried at a node."""
    if isinstance(kind, int):
        return kind
    size = {"sqrt": features ** 0.5, "log2": np.log2(max(features, 1)), "all": features}[kind]
    return max(1, int(size))


def shuffled(tree: np.ndarray, path: np.ndarray, features: int) -> np.ndarray:
    """Nodes x features: numbers that depend on the tree, the path to the node and the feature only."""
    with np.errstate(over="ignore"):
        z = (tree ^ (path * np.uint64(0x9E3779B97F4A7C15)))[:, None] + np.arange(1, features + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def impurity(kind: str, ones: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Weighted impurity of nodes with ``ones`` of ``total`` in class 1."""
    with np.errstate(divide="ignore", invalid="ignore"):
        p = np.clip(np.where(total > 0, ones / total, 0.0), 0, 1)
        if kind == "gini":
            return total * 2 * p * (1 - p)
        entropy = np.where(p > 0, -p * np.log2(p), 0) + np.where(p < 1, -(1 - p) * np.log2(1 - p), 0)
        return total * entropy


def bootstrap(count: np.ndarray, seed: int) -> np.ndarray:
    """How often the rows of each entry are drawn, as many draws as rows."""
    rng, n = np.random.default_rng(seed), int(count.sum())
    if n > DRAWN:
        return rng.multinomial(n, count / n)
    of_row = np.repeat(np.arange(len(count)), count)
    return np.bincount(of_row[rng.integers(0, n, n)], minlength=len(count))


def grow(fold: Fold, family: str, params: dict, first: int, last: int, depths: list[int], seed: object,
         levels: list | None = None) -> np.ndarray:
    """Sums over trees [first, last) of the held entries' probability of class 1, for each depth limit of ``depths``.

    ``levels`` takes the trees themselves: of every level the nodes' feature, bin, number of the pair of children (-1 for
    leaves) and probability.
    """
    trees, entries, held = last - first, len(fold.count), len(fold.pos)
    out = np.zeros((len(depths), held))
    if not entries or (not held and levels is None):
        return out
    seeds = [int.from_bytes(hashlib.md5(f"{seed}-{family}-{t}".encode()).digest()[:8], "little") for t in range(first, last)]
    if family == "RandomForest":
        count = np.stack([bootstrap(fold.count, s) for s in seeds])
    else:
        count = np.tile(fold.count, (trees, 1))
    each = params.get("classWeight") == "balanced_subsample"
    factors = np.stack([class_factors(fold.entry_y, c if each else fold.count, params.get("classWeight")) for c in count])
    node, entry = np.nonzero(count)
    c = count[node, entry].astype(float)
    y = fold.entry_y[entry].astype(float)
    w = c * fold.entry_weight[entry] * factors[node, fold.entry_y[entry]]
    tree, path = np.array(seeds, np.uint64), np.ones(trees, np.uint64)
    h_node, h_entry = np.repeat(np.arange(trees), held), np.tile(np.arange(held), trees)
    h_slot = np.arange(len(h_node))
    value = np.zeros(len(h_node))
    features, leaf = fold.bins.shape[1], params["minInstancesPerNode"]
    size = subset_size(params["featureSubset"], features)
    for depth in range(max(depths) + 1):
        nodes = len(tree)
        if nodes:
            ones, total, n = (np.bincount(node, v, nodes) for v in (w * y, w, c))
            value[h_slot] = (ones / np.maximum(total, 1e-300))[h_node]
        for k, d in enumerate(depths):
            if d == depth:
                out[k] = value.reshape(trees, held).sum(0)
        if not nodes or depth == max(depths):
            for k, d in enumerate(depths):
                if d > depth:
                    out[k] = value.reshape(trees, held).sum(0)
            if nodes and levels is not None:
                end = np.full(nodes, -1)
                levels.append((end, end, end, ones / np.maximum(total, 1e-300)))
            break
        open_ = (n >= 2 * leaf) & (ones > 0) & (ones < total)
        chosen = shuffled(tree, path, features)
        mask = np.broadcast_to(open_[:, None], chosen.shape)
        if size < features:
            mask = mask & (chosen <= np.partition(chosen, size - 1, axis=1)[:, size - 1:size])
        gain, split_f, split_b = np.full(nodes, 1e-9), np.full(nodes, -1), np.zeros(nodes, int)
        whole = impurity(params["impurity"], ones, total)
        for f in range(features):
            use = np.flatnonzero(mask[:, f])
            if not len(use):
                continue
            place = np.full(nodes, -1)
            place[use] = np.arange(len(use))
            at = place[node]
            rows = np.flatnonzero(at >= 0)
            cell = at[rows] * BINS + fold.bins[entry[rows], f]
            l1, lw, lc = (np.bincount(cell, v[rows], len(use) * BINS).reshape(-1, BINS)[:, :-1].cumsum(1) for v in (w * y, w, c))
            ok = (lc >= leaf) & (n[use, None] - lc >= leaf)
            better = np.where(ok, whole[use, None] - impurity(params["impurity"], l1, lw)
                              - impurity(params["impurity"], ones[use, None] - l1, total[use, None] - lw), 0.0)
            top = better.argmax(1)
            found = better[np.arange(len(use)), top]
            up = found > gain[use] * (1 + 1e-12)
            gain[use[up]], split_f[use[up]], split_b[use[up]] = found[up], f, top[up]
        split = np.flatnonzero(split_f >= 0)
        number = np.full(nodes, -1)
        number[split] = np.arange(len(split))
        if levels is not None:
            levels.append((split_f, split_b, number, ones / np.maximum(total, 1e-300)))

        def down(node: np.ndarray, rows: np.ndarray, bins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            stay = np.flatnonzero(number[node] >= 0)
            right = bins[rows[stay], split_f[node[stay]]] > split_b[node[stay]]
            return stay, 2 * number[node[stay]] + right

        stay, node = down(node, entry, fold.bins)
        entry, c, y, w = entry[stay], c[stay], y[stay], w[stay]
        stay, h_node = down(h_node, h_entry, fold.held_bins)
        h_entry, h_slot = h_entry[stay], h_slot[stay]
        tree = np.repeat(tree[split], 2)
        path = np.repeat(path[split] * np.uint64(2), 2) + np.tile(np.array([0, 1], np.uint64), len(split))
    return out


def logistic_loss(f: np.ndarray, y: np.ndarray, _) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    m = np.where(y > 0, f, -f)
    p = 1 / (1 + np.exp(-np.clip(m, -500, 500)))
    return np.logaddexp(0, -m), np.where(y > 0, p - 1, 1 - p), np.maximum(p * (1 - p), 1e-12)


def hinge_loss(f: np.ndarray, y: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hinge with its corner rounded over ``width``."""
    sign = np.where(y > 0, 1.0, -1.0)
    m = np.maximum(1 - sign * f, 0)
    inside = m < width
    return np.where(inside, m * m / (2 * width), m - width / 2), -sign * np.minimum(m / width, 1), np.where(inside & (m > 0), 1 / width, 1e-4)


def newton(x: np.ndarray, y: np.ndarray, w: np.ndarray, l1: float, l2: float, loss, tol: float, max_iter: int,
           width: float = 0.0, start: np.ndarray | None = None) -> np.ndarray:
    """Coefficients (the last is the intercept, without penalty) of mean weighted loss + l1 |b| + l2 b'b / 2."""
    z = np.hstack([x, np.ones((len(x), 1))])
    share = w / w.sum()
    one, two = np.full(z.shape[1], l1), np.full(z.shape[1], l2)
    one[-1] = two[-1] = 0.0
    b = np.zeros(z.shape[1]) if start is None else start.copy()
    value = lambda b: float(share @ loss(z @ b, y, width)[0] + one @ np.abs(b) + two @ (b * b) / 2)
    now = value(b)
    for _ in range(max_iter):
        _, slope, curve = loss(z @ b, y, width)
        g = z.T @ (share * slope) + two * b
        h = (z * (share * curve)[:, None]).T @ z + np.diag(two + 1e-10)
        new = b.copy()
        if l1 > 0:
            for _ in range(200):  # coordinate descent on the quadratic
                before = new.copy()
                for j in range(len(b)):
                    t = h[j, j] * new[j] - g[j] - h[j] @ (new - b)
                    new[j] = np.sign(t) * max(abs(t) - one[j], 0) / h[j, j]
                if np.abs(new - before).max() <= 1e-10 * max(1.0, np.abs(new).max()):
                    break
        else:
            new = b - np.linalg.solve(h, g)
        step, moved = 1.0, False
        while step > 1e-6:
            trial = b + step * (new - b)
            then = value(trial)
            if then < now:
                moved = True
                break
            step /= 2
        if not moved:
            break
        done = now - then <= max(tol, 1e-12) * max(abs(now), 1e-12) * 0.1
        b, now = trial, then
        if done:
            break
    return b


def linear(fold: Fold, family: str, params: dict) -> np.ndarray:
    """Scores of the held-out rows, above 0 for class 1."""
    if fold.merged is None:
        first, at, count = same([fold.x, fold.y[:, None], fold.weight[:, None]])
        fold.merged = first, count if fold.n is None else np.bincount(at, fold.n, len(first))
    first, count = fold.merged
    x, y = fold.x[first], fold.y[first]
    w = count * fold.weight[first] * class_factors(y, count, params.get("classWeight"))[y]
    penalty = 1 / (params["C"] * w.sum())
    mix = params.get("elasticNetParam", 0.0)
    if family == "LogisticRegression":
        b = newton(x, y, w, penalty * mix, penalty * (1 - mix), logistic_loss, params["tol"], params["maxIter"])
    else:
        b = None
        for width in (2.0, 0.5, 0.1, 0.03):  # every row lies on the first corner at the start
            b = newton(x, y, w, 0.0, penalty, hinge_loss, 1e-6, params["maxIter"], width, b)
    return fold.held_x @ b[:-1] + b[-1]


def f1(score: np.ndarray, cut: float, pos: np.ndarray, neg: np.ndarray) -> float:
    up = score > cut
    hit, wrong, missed = pos[up].sum(), neg[up].sum(), pos[~up].sum()
    return float(2 * hit / (2 * hit + wrong + missed)) if hit else 0.0


def average_precision(score: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> float:
    """Step sum over distinct scores, highest first."""
    kinds, at = np.unique(-score, return_inverse=True)
    p, n = np.bincount(at, pos, len(kinds)), np.bincount(at, neg, len(kinds))
    hit = p.cumsum()
    return float((p * hit / np.maximum(hit + n.cumsum(), 1)).sum() / hit[-1]) if len(hit) and hit[-1] else 0.0


def units(drawn: dict[str, list[dict]], folds: int, step: int) -> list[tuple]:
    """Rows of UNIT. Forest draws with the same splits share their trees; ranges end where a draw's trees end."""
    out = []
    for family, draws in drawn.items():
        if family not in FORESTS:
            out += [(family, i, json.dumps(p), 0, 0, json.dumps([[d, 0, 0]])) for d, p in enumerate(draws) for i in range(folds)]
            continue
        shared: dict[str, list[list[int]]] = {}
        for d, p in enumerate(draws):
            key = json.dumps({k: p[k] for k in ("impurity", "minInstancesPerNode", "featureSubset", "classWeight") if k in p}, sort_keys=True)
            shared.setdefault(key, []).append([d, p["maxDepth"], p["numTrees"]])
        for key, own in shared.items():
            most = max(n for _, _, n in own)
            ends = sorted({n for _, _, n in own} | set(range(step, most, step)))
            for a, b in zip([0, *ends], ends):
                wanted = json.dumps([o for o in own if o[2] >= b])
                out += [(family, i, key, a, b, wanted) for i in range(folds)]
    return out


def grid_scores(spark, rows: Rows | list[Fold], drawn: dict[str, list[dict]], scoring: str, strategy: str, seed: object) -> dict[tuple[str, int], list[float]]:
    """The score of every draw on every fold, by (family, number of the draw). Folds that are given are for forests only."""
    shared = spark.sparkContext.broadcast(rows)
    folds = rows.held.shape[1] if isinstance(rows, Rows) else len(rows)
    made: dict[int, Fold] = {}

    def fold_of(i: int) -> Fold:
        if isinstance(shared.value, list):
            return shared.value[i]
        if i not in made:
            made.clear()
            made[i] = make_fold(shared.value, i, strategy)
        return made[i]

    entries = max([1, *[len((make_fold(rows, i, strategy) if isinstance(rows, Rows) else rows[i]).count) for i in range(min(1, folds))]])
    table = units(drawn, folds, min(max(ENTRIES // entries, 4), 100))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for u in pdf.sort_values("fold").itertuples():
                fold, params, wanted = fold_of(u.fold), json.loads(u.params), json.loads(u.draws)
                if u.family in FORESTS:
                    depths = sorted({d for _, d, _ in wanted})
                    sums = grow(fold, u.family, params, u.first, u.last, depths, seed)
                    yield pd.DataFrame([[u.family, d, u.fold, n, sums[depths.index(k)], None] for d, k, n in wanted],
                                       columns=["family", "draw", "fold", "trees", "sums", "score"])
                else:
                    s, y = linear(fold, u.family, params), fold.held_y.astype(float)
                    pos, neg = fold.held_n * y, fold.held_n * (1 - y)
                    value = f1(s, 0.0, pos, neg) if scoring == "f1" else average_precision(s, pos, neg)
                    yield pd.DataFrame([[u.family, wanted[0][0], u.fold, 0, None, value]],
                                       columns=["family", "draw", "fold", "trees", "sums", "score"])

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        one = pdf.iloc[0]
        value = one["score"]
        if one["family"] in FORESTS:
            fold, total = fold_of(int(one["fold"])), np.sum(np.stack(pdf["sums"].to_list()), 0)
            value = (f1(total, one["trees"] / 2, fold.pos, fold.neg) if scoring == "f1"
                     else average_precision(np.round(total / one["trees"], 12), fold.pos, fold.neg))
        return pd.DataFrame([[one["family"], one["draw"], one["fold"], value]], columns=["family", "draw", "fold", "score"])

    tasks = min(len(table), max(4 * spark.sparkContext.defaultParallelism, len(table) // 16))
    parts = spark.createDataFrame(table, UNIT).repartition(tasks).mapInPandas(run, PART)
    found = parts.groupBy("family", "draw", "fold").applyInPandas(score, "family string, draw int, fold int, score double").collect()
    out: dict[tuple[str, int], list[float]] = {}
    for r in sorted(found, key=lambda r: (r.family, r.draw, r.fold)):
        out.setdefault((r.family, r.draw), []).append(r.score)
    return out
