"""Numeric operators against numpy."""

import copy

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import functions as F

from cellweft.functions.keys import seeded
from cellweft.operators import gating, metrics, outliers, power, prefix, quantiles, ranks, reports, sampling, stats
from cellweft.session import attach

RNG = np.random.default_rng(7)


def frame(spark, **columns):
    return spark.createDataFrame(pd.DataFrame(columns)).withColumn(
        "row_key", F.md5(F.monotonically_increasing_id().cast("string")))


def best_lambda(x, family):
    def llf(lam):
        if family == "boxcox":
            y = np.log(x + 1) if lam == 0 else ((x + 1) ** lam - 1) / lam
            return (lam - 1) * np.log(x + 1).sum() - len(x) / 2 * np.log(y.var())
        y = np.empty_like(x)
        up = x >= 0
        y[up] = np.log1p(x[up]) if lam == 0 else ((x[up] + 1) ** lam - 1) / lam
        y[~up] = -(np.log1p(-x[~up]) if lam == 2 else ((1 - x[~up]) ** (2 - lam) - 1) / (2 - lam))
        return (lam - 1) * (np.sign(x) * np.log1p(np.abs(x))).sum() - len(x) / 2 * np.log(y.var())
    low, high = -6.0, 6.0
    for _ in range(6):
        grid = np.linspace(low, high, 201)
        i = int(np.argmax([llf(g) for g in grid]))
        low, high = grid[max(i - 1, 0)], grid[min(i + 1, 200)]
    return (low + high) / 2


def test_boxcox_exponents(spark):
    data = {"a": RNG.lognormal(1, 1, 4000), "b": RNG.gamma(2, 3, 4000), "c": RNG.exponential(1, 4000) ** 2,
            "flat": np.full(4000, 2.0), "low": RNG.normal(0, 2, 4000)}
    df = frame(spark, **data)
    fits = {f.feature: f.lam for f in power.fit(df, list(data))}
    assert fits["flat"] is None and fits["low"] is None
    for name in "abc":
        assert abs(fits[name] - best_lambda(data[name], "boxcox")) < 1e-3
    done = power.apply(df, power.fit(df, ["flat"])).agg(F.max("flat")).first()[0]
    assert done == 0


def test_yeo_johnson_exponents(spark):
    data = {"a": RNG.normal(0, 2, 4000) ** 3, "b": RNG.exponential(2, 4000), "c": -RNG.exponential(2, 4000)}
    fits = {f.feature: f.lam for f in power.fit(frame(spark, **data), list(data), "yeo")}
    for name, x in data.items():
        assert abs(fits[name] - best_lambda(x, "yeo")) < 2e-3


def exact_gate(x):
    """The same gate on every value: mixture by EM, density by summing over all values."""
    n = len(x)
    one = pd.DataFrame({"i": 0, "n": np.ones(n), "s": x, "ss": x * x, "lo": x, "hi": x})
    return gating.gate_bins(one).iloc[0]


SHAPES = {"two": np.r_[RNG.normal(3, 1, 3000), RNG.normal(12, 2, 2000)],
          "zeros": np.r_[np.zeros(2000), RNG.normal(8, 2, 3000)], "skew": RNG.lognormal(0, 1, 5000),
          "very_skew": RNG.lognormal(0, 3, 5000), "saturated": np.minimum(RNG.lognormal(3, 1.5, 5000), 255.0),
          "shifted": 1e6 + np.r_[RNG.normal(0, 1, 3000), RNG.normal(9, 1, 2000)],
          "tight_and_wide": np.r_[RNG.normal(0.01, 0.001, 2000), RNG.normal(900, 200, 3000)],
          "tiny": np.r_[RNG.normal(1e-6, 1e-7, 500), RNG.normal(5, 1, 4500)], "flat": np.full(5000, 4.0),
          "negative": np.r_[-RNG.lognormal(1, 1, 2500), RNG.normal(50, 5, 2500)]}


@pytest.fixture(scope="module")
def shape_gates(spark):
    return {g.feature: g for g in gating.fit(frame(spark, **SHAPES), list(SHAPES))}


@pytest.mark.parametrize("name", SHAPES)
def test_gate_on_bins_equals_gate_on_values(shape_gates, name):
    x, want = SHAPES[name], exact_gate(SHAPES[name])
    got = shape_gates[name]
    step = (x.max() - x.min()) / 999  # the density's minimum lies on one of these grid points
    close = lambda a, b: abs(a - b) <= max(0.01 * abs(b - (1e6 if name == "shifted" else 0)), 1e-9)
    assert close(got.threshold, want["threshold"]) or abs(abs(got.threshold - want["threshold"]) - step) < 1e-9 * abs(step)
    assert got.n_components == want["n_components"]
    assert all(close(a, b) for a, b in zip(sorted(got.means), sorted(want["gmm_means"])))


def test_bins_stay_few(spark):
    """A tail of 13 powers of ten takes bins in proportion to its logarithm."""
    df = frame(spark, a=RNG.lognormal(0, 5, 20000))
    assert gating.sketch(df, ["a"], gating.first_binnings(df, ["a"])).count() < 20 * gating.STEPS


def test_density_minimum_against_plain_sum():
    x = np.r_[RNG.normal(0, 1, 400), RNG.normal(8, 1, 400)]
    h = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min(), x.max(), 1000)
    y = np.exp(-0.5 * ((grid[:, None] - x) / h) ** 2).sum(1)
    dips = [i for i in range(1, 999) if y[i] < y[i - 1] and y[i] < y[i + 1]]
    assert gating._first_minimum(x, np.ones(len(x)), x.min(), x.max(), x.std(ddof=1)) == pytest.approx(grid[dips[0]])


def test_gate_start_cuts_within_a_bin(spark):
    """Even values: the two-means cut falls into a full bin, which is binned again around it."""
    x = np.round(np.linspace(0.9, 105.0, 200_003) ** 1.01, 5)
    want = exact_gate(x)
    got = gating.fit(frame(spark, even=x), ["even"])[0]
    assert got.n_components == want["n_components"] == 2
    assert got.means == pytest.approx(tuple(want["gmm_means"]), abs=2e-4)
    assert got.stds == pytest.approx(tuple(want["gmm_stds"]), abs=2e-4)


def test_gate_nonfinite_counts_as_zero(spark):
    df = spark.createDataFrame([(float("inf"),), (float("nan"),), (None,), (5.0,)], "a double")
    gates = gating.fit(df, ["a"])
    low = gating.apply(df, gates).agg(F.min("a")).first()[0]
    assert low >= gates[0].threshold - 1e-12


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.floats(-50, 50), st.integers(0, 3).map(float)), min_size=1, max_size=300),
       st.sampled_from([0.0, 0.12, 0.5, 0.97, 1.0]))
def test_exact_percentile(spark, values, p):
    df = spark.createDataFrame([(v, i % 2) for i, v in enumerate(values)] + [(None, 5)], "v double, g int")
    got = {r["g"]: r["value"] for r in quantiles.exact_percentiles(df, ["g"], ["v"], [p], accuracy=20).collect()}
    assert got[5] is None
    for g in (0, 1):
        own = [v for i, v in enumerate(values) if i % 2 == g and v is not None]
        if own:
            assert got[g] == pytest.approx(np.percentile(own, p * 100), abs=1e-9)


def test_exact_percentile_of_a_large_skewed_group(spark):
    df = spark.range(300_000).select(F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.sqrt("id")).alias("v"))
    want = np.percentile(df.toPandas()["v"], [12, 50, 99])
    got = quantiles.exact_percentiles(df, [], ["v"], [0.12, 0.5, 0.99], accuracy=200).orderBy("p").collect()
    assert [r["value"] for r in got] == pytest.approx(list(want))


def test_exact_percentile_in_ranges(spark):
    """At most 50 values a range: hundreds of ranges, a spike at the start of one group, a feature without values."""
    df = spark.range(20_000).select((F.col("id") % 2).alias("g"), F.when(F.col("id") % 5 == 0, 3.0).otherwise(
        F.sqrt(F.col("id"))).alias("v"), F.lit(None).cast("double").alias("none"))
    how = dict(accuracy=200)
    want = quantiles.exact_percentiles(df, ["g"], ["v", "none"], [0.0, 0.12, 0.5, 1.0], **how)
    got = quantiles.exact_percentiles(df, ["g"], ["v", "none"], [0.0, 0.12, 0.5, 1.0], rows=50, **how)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    own = df.where("g = 1").toPandas()["v"]
    assert got.where("g = 1 and feature = 'v' and p = 0.12").first()["value"] == pytest.approx(np.percentile(own, 12))


@pytest.mark.parametrize("fraction", [0.0, 0.1, 0.5, 1.0])
def test_hash_cut_counts(spark, fraction):
    df = frame(spark, g=np.repeat(["hot", "mid", "one"], [5000, 100, 1])).withColumn("h", seeded(1))
    out = {r["g"]: r for r in ranks.hash_cut(df, ["g"], "h", F.ceil(F.col("n") * fraction)).collect()}
    for g, n in (("hot", 5000), ("mid", 100), ("one", 1)):
        k = int(np.ceil(n * fraction))
        assert out[g]["k"] == k and df.filter((F.col("g") == g) & (F.col("h") <= out[g]["cut"])).count() == k


def test_hash_cut_narrows_by_digits(spark, monkeypatch):
    """One digit at a time and at most 3 rows ranked: several levels of counts, the same cut."""
    df = frame(spark, g=np.repeat(["hot", "mid", "one"], [3000, 100, 1])).withColumn(
        "h", F.md5(F.monotonically_increasing_id().cast("string"))).cache()
    for fraction in (0.001, 0.37, 1.0):
        wanted = F.ceil(F.col("n") * fraction)
        want = {r["g"]: (r["n"], r["k"], r["cut"]) for r in ranks.hash_cut(df, ["g"], "h", wanted).collect()}
        got = {r["g"]: (r["n"], r["k"], r["cut"]) for r in ranks.hash_cut(df, ["g"], "h", wanted, 1, 3).collect()}
        assert got == want


def test_running_totals_many_buckets(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("g"), (F.pmod(F.col("id") * 7919, F.lit(5000)) / 10).alias("s"),
                                  F.lit(1).alias("one"))
    out = ranks.running_totals(df, ["g"], "s", ["one"], True, 50).toPandas()
    for _, part in out.groupby("g"):
        part = part.sort_values("s", ascending=False)
        assert list(part["cum_one"]) == list(range(1, len(part) + 1))


@pytest.mark.parametrize("fan", [2, 4, 4096])
def test_offsets_of_buckets_of_buckets(spark, fan):
    """A fan of 2 takes six levels of totals."""
    rows = [(g, b, (b * 7 + 3) % 11, b % 3) for g in ("a", None) for b in range(60) if b % 7 != 2]
    df = spark.createDataFrame(rows, "g string, b long, n long, m long")
    got = {(r["g"], r["b"]): (r["before_n"], r["before_m"]) for r in prefix.offsets(df, ["g"], "b", ["n", "m"], fan).collect()}
    assert got == {(g, b): (sum(x[2] for x in rows if x[0] == g and x[1] < b), sum(x[3] for x in rows if x[0] == g and x[1] < b))
                   for g, b, _, _ in rows}


def test_ordinals(spark):
    df = spark.range(500).select(F.when(F.col("id") % 50 > 0, F.md5(F.col("id").cast("string"))).alias("v"), "id")
    rows = prefix.ordinals(df, [F.col("v").asc_nulls_last(), F.col("id")], parts=7).orderBy("ordinal").collect()
    want = sorted(df.collect(), key=lambda r: (r["v"] is None, r["v"] or "", r["id"]))
    assert [r["ordinal"] for r in rows] == list(range(500)) and [r["id"] for r in rows] == [r["id"] for r in want]


def test_perfect_and_constant_scores(spark):
    df = spark.createDataFrame([(1, .9), (1, .8), (0, .1), (0, .2)], "y int, s double")
    assert tuple(metrics.ranking_scores(df, "y", "s").first()) == (1.0, 1.0)
    flat = metrics.ranking_scores(df.withColumn("s", F.lit(.5)), "y", "s").first()
    assert flat["roc_auc"] == 0.5 and flat["pr_auc"] == 0.5
    single = metrics.binary_scores(df.filter("y = 1").withColumn("p", F.lit(1)), "y", "p").first()
    assert single["balanced_accuracy"] == 1.0


def test_agreement_ignores_names(spark):
    df = spark.createDataFrame([(0, 5), (0, 5), (1, 7), (1, 7), (1, 5)], "a int, b int")
    one = metrics.cluster_agreement(df, "a", "b").first()
    two = metrics.cluster_agreement(df.withColumn("b", 100 - F.col("b")), "a", "b").first()
    assert tuple(one) == pytest.approx(tuple(two))
    same = metrics.cluster_agreement(df, "a", "a").first()
    assert same["ari"] == pytest.approx(1) and same["nmi"] == pytest.approx(1)


def lof_by_hand(x, k):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    near = np.argsort(d, axis=1, kind="stable")[:, :k]
    kd = np.take_along_axis(d, near, 1)[:, -1]
    reach = np.maximum(np.take_along_axis(d, near, 1), kd[near])
    lrd = 1 / (reach.mean(1) + 1e-10)
    return lrd[near].mean(1) / lrd


@pytest.mark.parametrize("leaf_rows,top_leaves", [(10_000, 2048), (40, 2048), (20, 3)])
def test_lof_against_all_pairs(spark, leaf_rows, top_leaves):
    x = np.r_[RNG.normal(0, 1, (250, 3)), RNG.normal(9, .2, (150, 3)), [[30, 30, 30]]]
    df = frame(spark, a=x[:, 0], b=x[:, 1], c=x[:, 2], i=np.arange(len(x)))
    got = outliers.local_outlier_factor(df, ["a", "b", "c"], 12, leaf_rows=leaf_rows, top_leaves=top_leaves).orderBy("i").toPandas()
    assert got["lof"].to_numpy() == pytest.approx(lof_by_hand(x, 12), rel=1e-6)
    assert got["lof"].idxmax() == len(x) - 1


@pytest.mark.parametrize("rows", [16_384, 50])
def test_lof_in_many_features_visits_no_boxes(spark, monkeypatch, rows):
    """With many features blocks of points meet once; a ball would reach every box and send a point to each."""
    x = np.r_[RNG.normal(0, 1, (250, 12)), RNG.normal(9, .2, (150, 12)), np.full((1, 12), 30.0)]
    names = [f"f{i}" for i in range(12)]
    df = frame(spark, i=np.arange(len(x)), **{n: x[:, i] for i, n in enumerate(names)})
    monkeypatch.setattr(outliers, "neighbours", None)
    pairs = outliers.all_pairs
    monkeypatch.setattr(outliers, "all_pairs", lambda points, k, n: pairs(points, k, n, rows))
    got = outliers.local_outlier_factor(df, names, 12).orderBy("i").toPandas()
    assert got["lof"].to_numpy() == pytest.approx(lof_by_hand(x, 12), rel=1e-6)


def test_neighbours_are_one_row_a_point(spark):
    x = RNG.normal(0, 1, (300, 2))
    points = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "pid long, x array<double>, m long")
    got = outliers.neighbours(points, 7, leaf_rows=20).orderBy("p").toPandas()
    far = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(far, np.inf)
    assert len(got) == 300 and np.stack(got["o"]).tolist() == np.argsort(far, axis=1)[:, :7].tolist()


def test_lof_with_a_pile_of_copies(spark):
    x = np.r_[np.zeros(400), RNG.normal(5, 1, 100)]
    df = frame(spark, a=x, i=np.arange(500))
    got = outliers.local_outlier_factor(df, ["a"], 20, leaf_rows=30).orderBy("i").toPandas()
    assert len(got) == 500 and got["lof"][:400].to_numpy() == pytest.approx(np.ones(400))
    assert got["lof"].notna().all()


def test_kd_tree_visits_every_reachable_box():
    x = RNG.normal(0, 1, (500, 4))
    tree = outliers.KdTree(x[:200], 16).freeze()
    home = tree.locate(x)
    radius = np.full(500, 0.8)
    seen = {(int(r), leaf) for leaf, rows in tree.touched(x, radius) for r in rows}
    near = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)) <= 0.8
    assert all((i, home[j]) in seen for i, j in zip(*np.nonzero(near)))
    assert len(seen) < 500 * tree.leaves


def test_grafted_tree_equals_its_parts():
    x = RNG.normal(0, 1, (400, 2))
    top = outliers.KdTree(x, 4)
    home = np.asarray(copy.deepcopy(top).freeze().locate(x))
    below = {leaf: outliers.KdTree(x[home == leaf], 4) for leaf in range(3)}
    want = [(h, int(copy.deepcopy(below[h]).freeze().locate(p[None])[0]) if h in below else -1) for h, p in zip(home, x)]
    top.graft(below)
    got = top.freeze().locate(x)
    assert top.leaves == 13 and len({(a, b) for a, b in zip(want, got)}) == len(set(want)) == 13


def test_isolation_forest_finds_the_far_point(spark):
    x = np.r_[RNG.normal(0, 1, 800), 40.0]
    df = frame(spark, a=x, b=np.r_[RNG.normal(0, 1, 800), 40.0])
    scored = outliers.isolation_score(df, ["a", "b"], trees=30).toPandas()
    assert scored["iso_score"].idxmax() == 800 and scored["iso_score"].between(0, 1).all()
    again = outliers.isolation_score(df.repartition(3), ["a", "b"], trees=30).agg(F.max("iso_score")).first()[0]
    assert again == pytest.approx(scored["iso_score"].max())


def test_logistic_curves_equal_spark_glm(spark):
    x = RNG.normal(0, 3, 600)
    y = np.clip(1 / (1 + np.exp(-(0.7 * x - 1))) + RNG.normal(0, .05, 600), 0, 1)
    df = frame(spark, x=x, y=y, g=np.repeat(["p", "q"], 300))
    mine = {r["g"]: r for r in reports.logistic_curves(df, ["g"], "x", "y").collect()}
    for g in ("p", "q"):
        part = VectorAssembler(inputCols=["x"], outputCol="f").transform(df.filter(F.col("g") == g))
        model = GeneralizedLinearRegression(family="binomial", featuresCol="f", labelCol="y", tol=1e-10).fit(part)
        assert mine[g]["slope"] == pytest.approx(model.coefficients[0], rel=1e-4)
        assert mine[g]["intercept"] == pytest.approx(model.intercept, rel=1e-4)


def test_constant_histogram(spark):
    out = stats.histogram(spark.createDataFrame([(3.0,)] * 4, "v double"), [], ["v"], 20).collect()
    assert len(out) == 1 and out[0]["n"] == 4 and out[0]["lo"] <= 3.0 <= out[0]["hi"]


def test_splits_keep_files_whole(spark):
    df = frame(spark, source_file=[f"f{i % 9}" for i in range(900)], y=[i % 2 for i in range(900)])
    parts = sampling.group_split(df).groupBy("source_file").agg(F.count_distinct("part").alias("n")).collect()
    assert all(r["n"] == 1 for r in parts)
    folds = sampling.group_folds(df, "y", folds=3).groupBy("fold").count().collect()
    assert sorted(r["count"] for r in folds) == [300, 300, 300]


def test_attach_shuffled_equals_broadcast(spark):
    rows = spark.range(2000).select(F.when(F.col("id") % 3 > 0, F.lit(1)).otherwise(F.col("id")).alias("k"), "id")
    rows = rows.withColumn("k", F.when(F.col("id") % 10 == 0, F.lit(None)).otherwise(F.col("k")))
    table = rows.select("k").distinct().withColumn("v", F.coalesce("k", F.lit(-1)) * 2)
    for how in ("left", "inner"):
        a = attach(rows, table, ["k"], how)
        b = attach(rows, table, ["k"], how, max_values=1)
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())) and b.count() == 2000


def test_curve_rounds_read_counts_of_equal_rows(spark, monkeypatch):
    """Fits of repeated rows pass over each distinct one, and give the same curve as the rows themselves."""
    rows = [("a", float(i % 9), (i * 7 % 11) / 11) for i in range(400)] + [("b", 3.0, 0.25)] * 5 + [("a", None, 0.5)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    stored = {}
    keep = reports.settle

    def spy(table, name="table", *more):
        out = keep(table, name, *more)
        stored.setdefault(name, out)
        return out

    monkeypatch.setattr(reports, "settle", spy)
    got = {r["g"]: r for r in reports.logistic_curves(df, ["g"], "x", "y").collect()}
    assert max(t.count() for t in stored.values()) == len({r for r in rows if r[1] is not None})
    x, y = (np.array([r[i] for r in rows[:400]]) for i in (1, 2))
    a = b = 0.0
    for _ in range(30):
        p = 1 / (1 + np.exp(-(a + b * x)))
        w = p * (1 - p)
        step = np.linalg.solve([[w.sum(), (w * x).sum()], [(w * x).sum(), (w * x * x).sum()]], [(y - p).sum(), ((y - p) * x).sum()])
        a, b = a + step[0], b + step[1]
    assert got["a"]["n"] == 400 and got["b"]["n"] == 5 and got["b"]["slope"] == 0
    assert abs(got["a"]["intercept"] - a) < 1e-6 and abs(got["a"]["slope"] - b) < 1e-6
    assert abs(got["b"]["intercept"] - np.log(1 / 3)) < 1e-4


def test_forest_steps_equal_single_walks():
    """Points that step down all trees together reach the leaves that each reaches alone; missing and infinite values too."""
    rng = np.random.default_rng(8)
    x = np.c_[rng.integers(0, 20, 400) / 3, rng.normal(size=400)]
    trees = [outliers._grow(x[rng.choice(400, 64, False)], np.random.default_rng(i)) for i in range(12)]
    trees.append(outliers._grow(np.ones((5, 2)), np.random.default_rng(0)))
    x[:5, 0], x[5:9, 1], x[9, 0] = np.nan, np.inf, -np.inf

    def walk(tree, point):
        at = 0
        while tree["feature"][at] >= 0:
            at = tree["left" if point[tree["feature"][at]] <= tree["split"][at] else "right"][at]
        return tree["split"][at]

    got = outliers._depths([outliers._steps(t) for t in trees], np.ascontiguousarray(x.T))
    assert got.tolist() == [sum(walk(t, p) for t in trees) for p in x]
