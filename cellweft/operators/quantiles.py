"""Exact linear percentiles without collecting a group's values in one place.

A first pass keeps a bounded quantile sketch per group and feature. Its error bound gives, for
each wanted rank, an interval that must hold it. The second pass counts what lies below the
interval and keeps distinct values inside it, which is some 4/accuracy of the rows. Where even those are many, they are
added up in ranges, not in one window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellweft.operators.ranks import BUCKET_ROWS, running_totals
from cellweft.session import attach, col, settle

ACCURACY = 10_000
ALL = "__all"


def exact_percentiles(df: DataFrame, groups: list[str], values: list[str], probabilities: list[float],
                      accuracy: int = ACCURACY, rows: int = BUCKET_ROWS) -> DataFrame:
    """Long (groups..., feature, p, n, value): the linear-interpolation percentile.

    NULL and NaN values do not count; a feature without values gets NULL.
    """
    keys = groups or [ALL]
    slots = [(i, p) for i in range(len(values)) for p in probabilities]
    base = df.select(*([col(g) for g in groups] or [F.lit(0).alias(ALL)]),
                     *[F.when(~F.isnan(col(v).cast("double")), col(v).cast("double")).alias(f"__v{i}")
                       for i, v in enumerate(values)])
    margin = 2.0 / accuracy
    edges = [e for p in probabilities for e in (max(p - margin, 0.0), min(p + margin, 1.0))]
    aggs = []
    for i in range(len(values)):
        v = F.col(f"__v{i}")
        aggs.append(F.struct(
            F.count(v).alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi"),
            F.percentile_approx(v, F.array(*[F.lit(e) for e in edges]), F.lit(accuracy)).alias("q")).alias(f"s{i}"))
    sketch = base.groupBy(*[col(k) for k in keys]).agg(*aggs)
    bounds = []
    for b, (i, p) in enumerate(slots):
        s, j = F.col(f"s{i}"), probabilities.index(p)
        # Ranks next to each other must both fit in the interval, so small groups are taken whole.
        small = s["n"] <= 2 * accuracy
        lo = s["lo"] if p - margin <= 0 else F.when(small, s["lo"]).otherwise(s["q"][2 * j])
        hi = s["hi"] if p + margin >= 1 else F.when(small, s["hi"]).otherwise(s["q"][2 * j + 1])
        bounds.append(F.struct(s["n"].alias("n"), lo.alias("lo"), hi.alias("hi")).alias(f"__b{b}"))
    table = settle(sketch.select(*[col(k) for k in keys], *bounds), "bounds")

    # An array literal of structs keeps the second pass inside generated code.
    near = attach(base, table, keys, "inner")
    each = F.array(*[F.struct(F.lit(b).alias("slot"), F.col(f"__b{b}")["n"].alias("n"), F.col(f"__b{b}")["hi"].alias("hi"),
                              (F.col(f"__v{i}") < F.col(f"__b{b}")["lo"]).alias("below"), F.col(f"__v{i}").alias("v"))
                     for b, (i, _) in enumerate(slots)])
    hit = near.select(*[col(k) for k in keys], F.inline(each)).filter(F.col("v") <= F.col("hi"))
    # Everything below the interval folds into one NULL-valued row per map task.
    counted = hit.groupBy(*[col(k) for k in keys], "slot", "n",
                          F.when(~F.col("below"), F.col("v")).alias("v")).agg(F.count("*").alias("c"))
    counted = settle(counted, "near-values")
    if counted.count() <= rows:
        part = Window.partitionBy(*[col(k) for k in keys], F.col("slot"), F.col("n"))
        upto = counted.withColumn("cum", F.sum("c").over(
            part.orderBy(F.col("v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)))
    else:
        # Too many for one window: ranges of them are added up apart, each range of ``rows`` at most.
        upto = running_totals(counted, [*keys, "slot", "n"], "v", ["c"], False, -(-counted.count() // rows)).withColumnRenamed(
            "cum_c", "cum")
    p_of = F.array(*[F.lit(float(p)) for _, p in slots])[F.col("slot")]
    f_of = F.array(*[F.lit(values[i]) for i, _ in slots])[F.col("slot")]
    rank = p_of * (F.col("n") - 1)
    low, high = F.floor(rank), F.ceil(rank)
    picked = upto.groupBy(*[col(k) for k in keys], "slot", "n").agg(
        F.min(F.when(F.col("cum") > low, F.col("v"))).alias("a"),
        F.min(F.when(F.col("cum") > high, F.col("v"))).alias("b"),
        F.coalesce(F.max(F.when(F.col("v").isNull(), F.col("cum"))), F.lit(0)).alias("under"))
    fraction = rank - low
    value = F.when((F.col("under") > low) | F.col("b").isNull(), F.raise_error(F.lit("quantile sketch missed a rank"))
                   ).otherwise(F.col("a") + (F.col("b") - F.col("a")) * fraction)
    found = picked.select(*[col(k) for k in keys], "slot", "n", value.cast("double").alias("value"))
    empty = table.select(*[col(k) for k in keys], F.inline(F.array(*[
        F.struct(F.lit(b).alias("slot"), F.col(f"__b{b}")["n"].alias("n")) for b in range(len(slots))]))).filter(
        "n = 0").withColumn("value", F.lit(None).cast("double"))
    out = found.unionByName(empty).select(
        *[col(k) for k in keys], f_of.alias("feature"), p_of.alias("p"), "n", "value")
    return out if groups else out.drop(ALL)


def percentile_wide(df: DataFrame, groups: list[str], values: list[str], probability: float,
                    accuracy: int = ACCURACY) -> DataFrame:
    """One row per group, one column per feature (thresholds in export form)."""
    long = exact_percentiles(df, groups, values, [probability], accuracy)
    return long.groupBy(*[col(g) for g in groups]).agg(
        *[F.max(F.when(F.col("feature") == v, F.col("value"))).alias(v) for v in values])
