"""Box-Cox and Yeo-Johnson with the exponent found by maximum likelihood.

The profile log-likelihood needs n, the sum of logs and the variance of the transformed values. A
fine histogram in log space locates its peak for every feature in one scan; one exact scan at
three exponents around it then places the vertex of the parabola through them. Two scans after the
range pass, whatever the number of features.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweft.functions.numeric import boxcox, fill_zero, signed_log, yeo_johnson
from cellweft.operators.stats import chunks
from cellweft.session import attach, col, settle

BINS = 2048
STEP = 0.02
EXACT_CHUNK = 12


@dataclass(frozen=True)
class Fit:
    feature: str
    lam: float | None  # None: the transform failed (constant or outside the domain)


def _value(name: str, family: str) -> Column:
    value = fill_zero(col(name).cast("double"))
    return value + 1.0 if family == "boxcox" else value


def _transform(value: Column, lam: float, family: str) -> Column:
    return boxcox(value, lam) if family == "boxcox" else yeo_johnson(value, lam)


def _log(name: str, family: str) -> Column:
    value = _value(name, family)
    return F.when(value > 0, F.ln(value)) if family == "boxcox" else signed_log(value)


def _from_log(t: Column, lam: float, family: str) -> Column:
    """The transform of a value given as its (signed) logarithm."""
    def side(x: Column, power: float) -> Column:
        return x if abs(power) < 1e-12 else F.expm1(F.lit(float(power)) * x) / F.lit(float(power))
    return side(t, lam) if family == "boxcox" else F.when(t >= 0, side(t, lam)).otherwise(-side(-t, 2.0 - lam))


def profile(df: DataFrame, features: list[str], lambdas: dict[str, list[float]] | list[float],
            family: str = "boxcox") -> DataFrame:
    """(feature, lambda, n, llf): exact log-likelihood at given exponents, one scan per chunk."""
    grid = lambdas if isinstance(lambdas, dict) else {f: lambdas for f in features}
    out = None
    for part in chunks(features, EXACT_CHUNK):
        logs = df.select(*[_log(f, family).alias(f"t{i}") for i, f in enumerate(part)])
        aggs = []
        for i, f in enumerate(part):
            t = F.col(f"t{i}")
            aggs += [F.count(t).alias(f"n{i}"), F.sum(t).alias(f"s{i}")]
            aggs += [F.var_pop(_from_log(t, lam, family)).alias(f"v{i}_{j}") for j, lam in enumerate(grid[f])]
        wide = logs.agg(*aggs)
        rows = F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(float(lam)).alias("lambda"),
                                  F.col(f"n{i}").cast("long").alias("n"),
                                  ((F.lit(float(lam)) - 1) * F.col(f"s{i}")
                                   - F.col(f"n{i}") / 2 * F.ln(F.col(f"v{i}_{j}"))).alias("llf"))
                         for i, f in enumerate(part) for j, lam in enumerate(grid[f])])
        long = wide.select(F.inline(rows))
        out = long if out is None else out.unionByName(long)
    return out


def _peak(pdf: pd.DataFrame, family: str, low: float = -5.0, high: float = 5.0) -> float:
    """Exponent of the highest likelihood on one feature's bins (counts at mean log values)."""
    weight = pdf["n"].to_numpy(float)
    t = (pdf["s"] / pdf["n"]).to_numpy(float)
    total, logs = weight.sum(), float(pdf["s"].sum())
    x = np.exp(t) if family == "boxcox" else np.sign(t) * np.expm1(np.abs(t))

    def likelihood(lam: float) -> float:
        with np.errstate(all="ignore"):
            if family == "boxcox":
                y = t if abs(lam) < 1e-12 else np.expm1(lam * t) / lam
            else:
                up, down = np.maximum(x, 0), np.maximum(-x, 0)
                a = np.log1p(up) if abs(lam) < 1e-12 else np.expm1(lam * np.log1p(up)) / lam
                m = 2 - lam
                b = np.log1p(down) if abs(m) < 1e-12 else np.expm1(m * np.log1p(down)) / m
                y = np.where(x >= 0, a, -b)
            mean = (weight * y).sum() / total
            spread = (weight * (y - mean) ** 2).sum() / total
            value = (lam - 1) * logs - total / 2 * np.log(spread)
        return value if np.isfinite(value) else -np.inf

    for _ in range(12):
        grid = np.linspace(low, high, 41)
        best = int(np.argmax([likelihood(g) for g in grid]))
        step = grid[1] - grid[0]
        if best in (0, 40) and abs(grid[best]) < 640:
            low, high = (grid[best] - 8 * (high - low), high) if best == 0 else (low, grid[best] + 8 * (high - low))
            continue
        low, high = grid[max(best - 1, 0)], grid[min(best + 1, 40)]
        if step < 1e-5:
            break
    return float((low + high) / 2)


def fit(df: DataFrame, features: list[str], family: str = "boxcox") -> list[Fit]:
    """The exponent of every feature. What comes back to the driver is one number per column."""
    if not features:
        return []
    ranges: dict[str, tuple[float, float]] = {}
    for part in chunks(features):
        row = df.agg(*[a for i, f in enumerate(part) for a in (
            F.min(_value(f, family)).alias(f"a{i}"), F.max(_value(f, family)).alias(f"b{i}"))]).first()
        ranges.update({f: (row[f"a{i}"], row[f"b{i}"]) for i, f in enumerate(part)})

    def usable(f: str) -> bool:
        low, high = ranges[f]
        if low is None or not np.isfinite([low, high]).all() or low == high:
            return False
        return low > 0 if family == "boxcox" else True

    alive = [f for f in features if usable(f)]
    lam: dict[str, float] = {}
    if alive:
        def to_log(x: float) -> float:
            return float(np.log(x)) if family == "boxcox" else float(np.sign(x) * np.log1p(abs(x)))

        cells = []
        for i, f in enumerate(alive):
            low, high = to_log(ranges[f][0]), to_log(ranges[f][1])
            width = (high - low) / BINS or 1.0
            slot = F.least(F.floor((F.col(f"__t{i}") - low) / width), F.lit(BINS - 1)).cast("int")
            cells.append(F.struct(F.lit(i).alias("i"), F.greatest(slot, F.lit(0)).alias("bin"), F.col(f"__t{i}").alias("t")))
        logs = df.select(*[_log(f, family).alias(f"__t{i}") for i, f in enumerate(alive)])
        sketch = logs.select(F.inline(F.array(*cells))).groupBy("i", "bin").agg(
            F.count("*").alias("n"), F.sum("t").alias("s"))
        peaks = sketch.groupBy("i").applyInPandas(
            lambda pdf: pd.DataFrame({"i": [int(pdf["i"].iloc[0])], "lam": [_peak(pdf, family)]}),
            "i int, lam double")
        start = {alive[r["i"]]: r["lam"] for r in peaks.collect()}
        near = {f: [start[f] - STEP, start[f], start[f] + STEP] for f in alive}
        exact: dict[str, list[float]] = {}
        for r in sorted(profile(df, alive, near, family).collect(), key=lambda r: r["lambda"]):
            exact.setdefault(r["feature"], []).append(r["llf"])
        for f in alive:
            a, b, c = exact[f]
            bend = a - 2 * b + c
            shift = 0.5 * (a - c) / bend if bend and np.isfinite(bend) else 0.0
            lam[f] = start[f] + STEP * float(np.clip(shift, -1, 1))
    return [Fit(f, lam.get(f)) for f in features]


def apply(df: DataFrame, fits: list[Fit], family: str = "boxcox") -> DataFrame:
    """Transformed columns in place: column expressions with the exponents as literals. Failed
    Box-Cox columns become 0, failed Yeo-Johnson columns stay."""
    new = {}
    for f in fits:
        if f.lam is not None:
            new[f.feature] = _transform(_value(f.feature, family), f.lam, family)
        elif family == "boxcox":
            new[f.feature] = F.lit(0.0)
        else:
            new[f.feature] = _value(f.feature, family)
    return df.select(*[new[c].alias(c) if c in new else col(c) for c in df.columns])


def record(before: DataFrame, fits: list[Fit], family: str = "boxcox") -> DataFrame:
    """(Feature, Pre_Mean, Lambda, Post_Mean, Post_Min, Post_Max) in one scan per chunk."""
    out = None
    by_name = {f.feature: f for f in fits}
    for part in chunks([f.feature for f in fits], EXACT_CHUNK):
        aggs, columns = [], []
        for i, name in enumerate(part):
            lam = by_name[name].lam
            columns += [fill_zero(col(name).cast("double")).alias(f"a{i}"),
                        (_transform(_value(name, family), lam, family) if lam is not None else F.lit(0.0)).alias(f"b{i}")]
            pre, post = F.col(f"a{i}"), F.col(f"b{i}")
            text = F.lit(f"{lam:.3f}" if lam is not None else "Failed")
            aggs.append(F.struct(F.lit(name).alias("Feature"), F.avg(pre).alias("Pre_Mean"), text.alias("Lambda"),
                                 F.avg(post).alias("Post_Mean"), F.min(post).alias("Post_Min"),
                                 F.max(post).alias("Post_Max")).alias(f"r{i}"))
        rows = before.select(*columns).agg(*aggs).select(F.inline(F.array(*[F.col(f"r{i}") for i in range(len(part))])))
        out = rows if out is None else out.unionByName(rows)
    return out
