"""Summary statistics, histograms and box statistics of feature columns.

Statistics are computed wide (one pass, one row per group, map-side partials) and turned long at
the end, so cells are not multiplied by features. Wide lists are cut into chunks to stay within
generated code; on a columnar table each chunk reads only its own columns.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweft.functions.numeric import finite_or_null
from cellweft.operators.quantiles import ALL, exact_percentiles
from cellweft.session import attach, col, settle

CHUNK = 40


def chunks(values: list[str], size: int = CHUNK) -> Iterator[list[str]]:
    for i in range(0, len(values), size):
        yield values[i:i + size]


def number(name: str) -> Column:
    value = col(name).cast("double")
    return F.when(~F.isnan(value), value)


def long_stats(df: DataFrame, groups: list[str], values: list[str],
               make: dict[str, callable]) -> DataFrame:
    """(groups..., feature, one column per statistic); ``make`` maps a name to column -> aggregate."""
    out = None
    for part in chunks(values):
        wide = df.groupBy(*[col(g) for g in groups]).agg(*[
            F.struct(F.lit(v).alias("feature"), *[fn(number(v)).alias(n) for n, fn in make.items()]).alias(f"s{i}")
            for i, v in enumerate(part)])
        long = wide.select(*[col(g) for g in groups],
                           F.inline(F.array(*[F.col(f"s{i}") for i in range(len(part))])))
        out = long if out is None else out.unionByName(long)
    return out


def running_stats(df: DataFrame, groups: list[str], values: list[str]) -> DataFrame:
    """Mergeable statistics: count, mean, population std, min, max (NULLs skipped)."""
    return long_stats(df, groups, values, {
        "n": lambda v: F.count(v).cast("long"), "mean": F.avg, "std": F.stddev_pop, "min": F.min, "max": F.max,
    }).filter("n > 0")


def describe(df: DataFrame, groups: list[str], values: list[str]) -> DataFrame:
    """count, mean, sample std, min, exact quartiles, max per feature."""
    base = long_stats(df, groups, values, {
        "n": lambda v: F.count(v).cast("long"), "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max})
    quart = exact_percentiles(df, groups, values, [0.25, 0.5, 0.75])
    wide = quart.groupBy(*[col(g) for g in groups], "feature").agg(
        *[F.max(F.when(F.col("p") == p, F.col("value"))).alias(n)
          for n, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))])
    return attach(base, settle(wide, "quartiles"), groups + ["feature"]).select(
        *groups, "feature", "n", "mean", "std", "min", "q25", "q50", "q75", "max")


def histogram(df: DataFrame, groups: list[str], values: list[str], bins: int = 20) -> DataFrame:
    """(groups..., feature, bin, lo, hi, n): equal bins between min and max, the last one closed.

    Two passes: the range first, then counts, so bins never shift while counting. Empty bins are
    not listed. A constant feature has one bin around its value, as a half unit to either side.
    """
    keys = groups or [ALL]
    base = df if groups else df.withColumn(ALL, F.lit(0))
    ranges = base.groupBy(*[col(k) for k in keys]).agg(*[
        F.struct(F.min(finite_or_null(number(v))).alias("lo"), F.max(finite_or_null(number(v))).alias("hi")).alias(f"r{i}")
        for i, v in enumerate(values)])
    table = settle(ranges, "ranges")
    near = attach(base.select(*[col(k) for k in keys], *[
        finite_or_null(number(v)).alias(f"__v{i}") for i, v in enumerate(values)]), table, keys, "inner")
    hit = near.select(*[col(k) for k in keys], F.inline(F.array(*[
        F.struct(F.lit(i).alias("i"), F.col(f"__v{i}").alias("v"), F.col(f"r{i}")["lo"].alias("lo"),
                 F.col(f"r{i}")["hi"].alias("hi")) for i in range(len(values))]))).filter("v is not null")
    lo0, hi0 = F.col("lo"), F.col("hi")
    flat = lo0 == hi0
    lo, hi = F.when(flat, lo0 - 0.5).otherwise(lo0), F.when(flat, hi0 + 0.5).otherwise(hi0)
    width = (hi - lo) / bins
    slot = F.least(F.floor((F.col("v") - lo) / width), F.lit(bins - 1)).cast("int")
    counted = (hit.select(*[col(k) for k in keys], "i", slot.alias("bin"), lo.alias("__lo"), width.alias("__w"))
               .groupBy(*[col(k) for k in keys], "i", "bin", "__lo", "__w").agg(F.count("*").cast("long").alias("n")))
    names = F.array(*[F.lit(v) for v in values])
    return counted.select(*groups, names[F.col("i")].alias("feature"), "bin",
                          (F.col("__lo") + F.col("bin") * F.col("__w")).alias("lo"),
                          (F.col("__lo") + (F.col("bin") + 1) * F.col("__w")).alias("hi"), "n")


def melt(df: DataFrame, keep: list[str], values: list[str], variable: str = "variable",
         value: str = "value") -> DataFrame:
    return df.select(*[col(k) for k in keep], *[col(v).cast("double").alias(v) for v in values]).unpivot(
        [col(k) for k in keep], [col(v) for v in values], variable, value)


def box_stats(df: DataFrame, group: str, values: list[str]) -> DataFrame:
    """Quartiles and 1.5 IQR whiskers of all listed columns pooled, per group."""
    pooled = melt(df, [group], values).filter("value is not null")
    quart = exact_percentiles(pooled, [group], ["value"], [0.25, 0.5, 0.75])
    table = settle(quart.groupBy(col(group)).agg(
        *[F.max(F.when(F.col("p") == p, F.col("value"))).alias(n)
          for n, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))], F.max("n").alias("n")), "quartiles")
    near = attach(pooled.select(col(group), "value"), table, [group], "inner")
    reach = 1.5 * (F.col("q75") - F.col("q25"))
    return near.groupBy(col(group), "n", "q25", "q50", "q75").agg(
        F.min(F.when(F.col("value") >= F.col("q25") - reach, F.col("value"))).alias("low_whisker"),
        F.max(F.when(F.col("value") <= F.col("q75") + reach, F.col("value"))).alias("high_whisker"))


def with_group(df: DataFrame, group: str) -> tuple[DataFrame, str]:
    """A missing group column becomes one constant group."""
    if group in df.columns:
        return df, group
    return df.withColumn("__ALL__", F.lit("all")), "__ALL__"


def first_groups(df: DataFrame, group: str, n: int = 50, ordinal: str = "row_key") -> DataFrame:
    """Rows of the first n groups, groups ordered by their first row."""
    first = df.groupBy(col(group)).agg(F.min(ordinal).alias("__first")).orderBy("__first").limit(n)
    return df.join(F.broadcast(first.select(col(group))), group, "left_semi")
