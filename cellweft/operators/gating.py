"""Gating: per feature, values below a background threshold are raised to it.

The threshold is the mean of the lower of one or two Gaussians (chosen by BIC) plus two standard
deviations, lowered to the first minimum of a kernel density. Cells are reduced to bins of counts
and moments in one scan; the mixture and the density are computed per feature on the bins, so their
cost does not grow with the number of cells. A bin that the two-means start would cut is binned again
around the cut, as a bin that goes to one side whole moves the start and with it the mixture.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellweft.functions.numeric import finite_or_zero, raise_to
from cellweft.operators.stats import chunks
from cellweft.session import col

STEPS = 512      # bins in one spread at the centre
ROUNDS = 8       # of binning a feature again
GRID = 1000
ZERO = -(1 << 62)  # bin of the exact zeros
CUT_BINS = 4096  # on either side of the two-means cut, within its reach
CUT_FIRST = 1 << 61
CUT_SHARE = 1e-8  # of the rows that a cut bin may hold

FITTED = T.StructType([
    T.StructField("i", T.IntegerType()), T.StructField("threshold", T.DoubleType()),
    T.StructField("n_components", T.IntegerType()), T.StructField("gmm_means", T.ArrayType(T.DoubleType())),
    T.StructField("gmm_stds", T.ArrayType(T.DoubleType())), T.StructField("centre", T.DoubleType()),
    T.StructField("spread", T.DoubleType()), T.StructField("fine", T.BooleanType()),
    T.StructField("cut", T.DoubleType()), T.StructField("reach", T.DoubleType())])


@dataclass(frozen=True)
class Gate:
    feature: str
    threshold: float
    n_components: int
    means: tuple[float, ...]
    stds: tuple[float, ...]


@dataclass(frozen=True)
class Binning:
    centre: float
    spread: float
    steps: float
    cut: float = 0.0
    reach: float = 0.0    # 0: no finer bins around the cut

    def slot(self, value):
        wide = F.floor(F.asinh((value - F.lit(self.centre)) / F.lit(self.spread)) * F.lit(self.steps)).cast("long")
        if not self.reach > 0:
            return wide
        away = value - F.lit(float(self.cut))
        near = F.lit(CUT_FIRST) + F.floor(away / F.lit(float(self.reach)) * F.lit(float(CUT_BINS))).cast("long")
        return F.when(F.abs(away) <= F.lit(float(self.reach)), near).otherwise(wide)


def value_of(name: str):
    """Non-numbers and non-finite values count as 0."""
    return finite_or_zero(col(name).cast("double"))


def _two_gaussians(x: np.ndarray, inner: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, np.ndarray]:
    """Weighted EM on bins (mean, squares about it, count): means, variances, log-likelihood, centres of the start."""
    n = w.sum()
    centre = np.array([x.min(), x.max()], float)
    for _ in range(50):  # two-means start
        near = np.abs(x - centre[0]) > np.abs(x - centre[1])
        new = np.array([np.average(x[~near], weights=w[~near]) if w[~near].sum() else centre[0],
                        np.average(x[near], weights=w[near]) if w[near].sum() else centre[1]])
        if np.allclose(new, centre, rtol=0, atol=1e-12):
            break
        centre = new
    near = np.abs(x - centre[0]) > np.abs(x - centre[1])
    resp = np.stack([(~near).astype(float), near.astype(float)])
    last = -np.inf
    mean = var = share = None
    for _ in range(100):
        mass = (resp * w).sum(1) + 10 * np.finfo(float).eps
        mean = (resp * w * x).sum(1) / mass
        var = (resp * (inner + w * (x - mean[:, None]) ** 2)).sum(1) / mass
        var = np.maximum(var, 0) + 1e-6
        share = mass / n
        log = (np.log(share)[:, None] - 0.5 * np.log(2 * np.pi * var)[:, None]
               - 0.5 * (x - mean[:, None]) ** 2 / var[:, None])
        top = log.max(0)
        norm = top + np.log(np.exp(log - top).sum(0))
        resp = np.exp(log - norm)
        bound = (w * norm).sum() / n
        if abs(bound - last) < 1e-3:
            break
        last = bound
    return mean, var, float((w * norm).sum()), centre


def _cut_bin(centre: np.ndarray, lo: np.ndarray, hi: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """The two-means cut and how far around it to bin again; 0 if the cut leaves its bin whole or nearly empty."""
    over = lambda v: np.abs(v - centre[0]) > np.abs(v - centre[1])
    both = np.flatnonzero(over(lo) != over(hi))
    both = both[w[both] > CUT_SHARE * w.sum()]
    return float(centre.mean()), float(8 * (hi[both] - lo[both]).max()) if len(both) else 0.0


def kernel_sums(grid: np.ndarray, x: np.ndarray, w: np.ndarray, var: np.ndarray, width: float) -> np.ndarray:
    """Unscaled Gaussian density of bins at the grid points; a bin spreads its own variance besides the kernel's."""
    order = np.argsort(x, kind="stable")
    x, w, own = x[order], w[order], np.sqrt(width * width + var[order])
    reach = 38 * own.max(initial=width)
    out = np.empty(len(grid))
    for i, g in enumerate(grid):
        a, b = np.searchsorted(x, (g - reach, g + reach))
        out[i] = (w[a:b] * (width / own[a:b]) * np.exp(-0.5 * ((g - x[a:b]) / own[a:b]) ** 2)).sum()
    return out


def _first_minimum(x: np.ndarray, w: np.ndarray, low: float, high: float, sd: float, upto: float = np.inf,
                   var: np.ndarray | None = None) -> float | None:
    """First strict interior minimum of the Gaussian density on a grid of 1000 points, if it lies at ``upto`` or below."""
    width = sd * w.sum() ** (-0.2)
    if not width > 0:
        return None
    grid = np.linspace(low, high, GRID)
    grid = grid[:min(int(np.searchsorted(grid, upto, "right")) + 1, GRID)]
    density = kernel_sums(grid, x, w, np.zeros(len(x)) if var is None else var, width)
    dip = np.flatnonzero((density[1:-1] < density[:-2]) & (density[1:-1] < density[2:])) + 1
    return float(grid[dip[0]]) if len(dip) else None


def gate_bins(pdf: pd.DataFrame) -> pd.DataFrame:
    w = pdf["n"].to_numpy(float)
    s, ssq = pdf["s"].to_numpy(float), pdf["ss"].to_numpy(float)
    # Moments about the bin's centre ``c``, which keeps large values from cancelling.
    c = pdf["c"].to_numpy(float) if "c" in pdf else np.zeros(len(pdf))
    x, inner = c + s / w, np.maximum(ssq - s * s / w, 0)
    lo, hi = pdf["lo"].to_numpy(float), pdf["hi"].to_numpy(float)
    n, low, high = w.sum(), float(lo.min()), float(hi.max())
    mean = (w * x).sum() / n
    var = ((w * (x - mean) ** 2).sum() + inner.sum()) / n
    one = -0.5 * n * (np.log(2 * np.pi * (var + 1e-6)) + var / (var + 1e-6))
    means, variances, components = np.array([mean]), np.array([var + 1e-6]), 1
    cut = reach = 0.0
    if high > low:
        m2, v2, two, start = _two_gaussians(x, inner, w)
        cut, reach = _cut_bin(start, lo, hi, w)
        if -2 * two + 5 * np.log(n) < -2 * one + 2 * np.log(n):
            means, variances, components = m2, v2, 2
    sds = np.sqrt(np.maximum(variances, 1e-12))
    dark = int(np.argmin(means))
    threshold = edge = float(means[dark] + 2 * sds[dark])
    fine, spread = True, float(sds[dark])
    wide = hi - lo
    if components == 2:
        near = (hi >= means[dark] - 4 * sds[dark]) & (lo <= means[dark] + 4 * sds[dark])
        fine = bool((wide[near] <= sds[dark] / 16).all())
    if high > low and n > 1:
        sd = np.sqrt(var * n / (n - 1))
        dip = _first_minimum(x, w, low, high, sd, edge, inner / w)
        if dip is not None:
            threshold = min(threshold, dip)
        kernel = sd * n ** (-0.2)
        near = lo <= edge + kernel
        if (wide[near] > kernel).any():
            fine, spread = False, min(spread, float(kernel))
    return pd.DataFrame({"i": [int(pdf["i"].iloc[0])], "threshold": [threshold], "n_components": [components],
                         "gmm_means": [means.tolist()], "gmm_stds": [sds.tolist()], "centre": [float(means[dark])],
                         "spread": [spread], "fine": [fine], "cut": [cut], "reach": [reach]})


def first_binnings(df: DataFrame, features: list[str], value_of=value_of) -> list[Binning]:
    """Around the median, with the quartiles' distance (or the next wider one that is not 0) as the spread."""
    out = []
    at = [0.5, 0.25, 0.75, 0.1, 0.9, 0.01, 0.99]
    for part in chunks(features):
        row = df.agg(*[a for i, f in enumerate(part) for a in (
            F.percentile_approx(value_of(f), F.array(*[F.lit(p) for p in at]), F.lit(1000)).alias(f"q{i}"),
            F.stddev_samp(value_of(f)).alias(f"s{i}"))], F.count("*").alias("n")).first()
        for i in range(len(part)):
            q, sd = row[f"q{i}"] or [0.0] * len(at), row[f"s{i}"] or 0.0
            spans = [b - a for a, b in (q[1:3], q[3:5], q[5:7])] + [sd, 1.0]
            spread = next(v for v in spans if np.isfinite(v) and v > 0)
            kernel = sd * max(row["n"], 1) ** (-0.2)
            out.append(Binning(q[0], spread, max(STEPS, min(4 * spread / kernel, 1 << 16) if kernel > 0 else 0)))
    return out


def sketch(df: DataFrame, features: list[str], binnings: list[Binning], value_of=value_of) -> DataFrame:
    """i, bin, c, n, s, ss, lo, hi: counts, moments about ``c`` and range of each bin of each feature, in one scan."""
    values = df.select(*[value_of(f).alias(f"__v{i}") for i, f in enumerate(features)])
    cells = [F.struct(F.lit(i).alias("i"),
                      # Exact zeros are many in dim channels: they keep a bin of their own.
                      F.when(F.col(f"__v{i}") == 0, F.lit(ZERO)).otherwise(b.slot(F.col(f"__v{i}"))).alias("bin"),
                      F.col(f"__v{i}").alias("v"), F.lit(float(b.centre)).alias("c")) for i, b in enumerate(binnings)]
    away = F.col("v") - F.col("c")
    return values.select(F.inline(F.array(*cells))).where("v is not null").groupBy("i", "bin", "c").agg(
        F.count("*").alias("n"), F.sum(away).alias("s"), F.sum(away * away).alias("ss"),
        F.min("v").alias("lo"), F.max("v").alias("hi"))


def fit(df: DataFrame, features: list[str]) -> list[Gate]:
    """Thresholds of every feature: a pass for the binnings, a binning pass, and one for features to bin again."""
    if not features or not df.limit(1).count():
        return []
    found: dict[str, object] = {}
    todo, binnings = list(features), first_binnings(df, features)
    for _ in range(ROUNDS):
        rows = sketch(df, todo, binnings).groupBy("i").applyInPandas(gate_bins, FITTED).collect()
        again = []
        for r in rows:
            found[todo[r["i"]]] = r
            old = binnings[r["i"]]
            if not r["fine"]:
                old = Binning(r["centre"], max(r["spread"], 1e-12 * abs(r["centre"]), 1e-300), STEPS, old.cut, old.reach)
            if r["reach"] > 0:
                old = replace(old, cut=r["cut"], reach=r["reach"])
            if not r["fine"] or r["reach"] > 0:
                again.append((todo[r["i"]], old))
        if not again:
            break
        todo, binnings = [f for f, _ in again], [b for _, b in again]
    return [Gate(f, found[f]["threshold"], found[f]["n_components"], tuple(found[f]["gmm_means"]), tuple(found[f]["gmm_stds"]))
            for f in features]


def apply(df: DataFrame, gates: list[Gate]) -> DataFrame:
    limit = {g.feature: g.threshold for g in gates}
    return df.select(*[raise_to(value_of(c), limit[c]).alias(c) if c in limit else col(c) for c in df.columns])


def summary(df: DataFrame, gates: list[Gate]) -> DataFrame:
    """Gating summary per feature, from the ungated table."""
    out = None
    for part in chunks([g.feature for g in gates], 20):
        own = {g.feature: g for g in gates}
        aggs = []
        for i, f in enumerate(part):
            g, v = own[f], value_of(f)
            cut = v < F.lit(g.threshold)
            aggs.append(F.struct(
                F.lit(f).alias("feature"), F.lit(g.threshold).alias("threshold"),
                F.lit(g.n_components).alias("n_components"),
                F.array(*[F.lit(m) for m in g.means]).alias("gmm_means"),
                F.array(*[F.lit(s) for s in g.stds]).alias("gmm_stds"),
                F.avg(v).alias("pre_mean"), F.avg(raise_to(v, g.threshold)).alias("post_mean"),
                F.avg(raise_to(v, g.threshold) - v).alias("delta_mean"),
                F.sum(cut.cast("long")).alias("cells_gated"),
                (F.avg(cut.cast("double")) * 100).alias("percent_gated")).alias(f"r{i}"))
        rows = df.agg(*aggs).select(F.inline(F.array(*[F.col(f"r{i}") for i in range(len(part))])))
        out = rows if out is None else out.unionByName(rows)
    return out


def empty_summary(df: DataFrame, features: list[str]) -> DataFrame:
    """The summary with gating switched off; no features give an empty table."""
    none = F.lit(None).cast("double")
    blank = F.array().cast("array<double>")
    if not features:
        return df.sparkSession.createDataFrame([], "feature string, threshold double, percent_gated double")
    aggs = [F.struct(F.lit(f).alias("feature"), none.alias("threshold"), F.lit(0).alias("n_components"),
                     blank.alias("gmm_means"), blank.alias("gmm_stds"), F.avg(value_of(f)).alias("pre_mean"),
                     F.avg(value_of(f)).alias("post_mean"), F.lit(0.0).alias("delta_mean"),
                     F.lit(0).cast("long").alias("cells_gated"), F.lit(0.0).alias("percent_gated")).alias(f"r{i}")
            for i, f in enumerate(features)]
    return df.agg(*aggs).select(F.inline(F.array(*[F.col(f"r{i}") for i in range(len(features))])))
