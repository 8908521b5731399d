"""Seeded samples and splits. Choices follow md5(seed, row key), so they do not depend on the
partitioning, the run or the engine, and each split is a comparison with a per-group cut value."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellweft.functions.keys import seeded
from cellweft.operators.prefix import offsets
from cellweft.operators.ranks import hash_cut
from cellweft.session import attach, col, settle


def sample_fraction(df: DataFrame, fraction: float, seed: int = 42, key: str = "row_key") -> DataFrame:
    """About ``fraction`` of the rows: a threshold on the hash, no shuffle."""
    cut = format(int(fraction * 0xFFFFFFFF), "08x")
    return df.filter(F.substring(seeded(seed, key), 1, 8) < cut)


def sample_exact(df: DataFrame, fraction: float, seed: int = 42, key: str = "row_key") -> DataFrame:
    """Exactly round(fraction * n) rows, without sorting the table."""
    marked = df.withColumn("__h", seeded(seed, key)).withColumn("__all", F.lit(0))
    cut = settle(hash_cut(marked, ["__all"], "__h", F.bround(F.col("n") * fraction)).select("__all", "cut"), "cut")
    return attach(marked, cut, ["__all"], "inner").filter(F.col("__h") <= F.col("cut")).drop("__h", "__all", "cut")


def sample_rows(df: DataFrame, n: int = 5000, seed: int = 421, key: str = "row_key") -> DataFrame:
    """At most n rows without replacement: the first n in hash order.

    A cut on the leading digits leaves some 4n rows of a large table before the sort, so that a
    top-n of every task need not meet in one place; if it leaves too few, the cut is not used.
    """
    marked = df.withColumn("__h", seeded(seed, key))
    total = df.count()
    if total > 16 * n:
        near = settle(marked.filter(F.substring("__h", 1, 12) < format(int(4 * n / total * 16 ** 12), "012x")), "near")
        if near.count() >= n:
            marked = near
    return marked.orderBy("__h", key).limit(n).drop("__h")


def stratified_split(df: DataFrame, stratum: str, fraction: float = 0.3, seed: object = 42,
                     key: str = "row_key", flag: str = "is_test") -> DataFrame:
    """``flag`` is true for exactly ceil(fraction * n) rows of each stratum."""
    marked = df.withColumn("__h", seeded(seed, key))
    cut = settle(hash_cut(marked, [stratum], "__h", F.ceil(F.col("n") * fraction)).select(col(stratum), "cut"), "cut")
    return attach(marked, cut, [stratum]).withColumn(flag, F.col("__h") <= F.col("cut")).drop("__h", "cut")


def shuffle_splits(df: DataFrame, stratum: str, splits: int = 5, fraction: float = 0.1, seed: object = 911,
                   key: str = "row_key") -> DataFrame:
    """``fold_0..``: independent stratified splits; one counting pass serves all of them."""
    names = [f"fold_{i}" for i in range(splits)]
    hashes = [seeded(f"{seed}.{i}", key) for i in range(splits)]
    long = df.select(col(stratum), F.explode(F.array(*[
        F.struct(F.lit(n).alias("fold"), h.alias("h")) for n, h in zip(names, hashes)])).alias("x")).select(
        stratum, "x.fold", "x.h")
    cuts = hash_cut(long, [stratum, "fold"], "h", F.ceil(F.col("n") * fraction))
    wide = settle(cuts.groupBy(stratum).agg(
        *[F.max(F.when(F.col("fold") == n, F.col("cut"))).alias(f"__{n}") for n in names]), "cuts")
    out = attach(df, wide, [stratum])
    return out.withColumns({n: h <= F.col(f"__{n}") for n, h in zip(names, hashes)}).drop(*[f"__{n}" for n in names])


def group_split(df: DataFrame, group: str = "source_file", test: float = 0.3, validation: float = 0.25,
                seed: int = 421, part: str = "part") -> DataFrame:
    """test / validation / train by whole groups: no file lies in two parts."""
    groups = df.select(col(group)).distinct()
    names = groups.withColumn("__h", seeded(seed, group)).withColumn("__all", F.lit(0))
    cut = settle(hash_cut(names, ["__all"], "__h", F.ceil(F.col("n") * test)).select("__all", "cut"), "cut")
    first = settle(attach(names, cut, ["__all"]).withColumn("__test", F.col("__h") <= F.col("cut")).drop("cut"), "groups")
    rest = first.filter("not __test").withColumn("__h", seeded(seed + 1, group))
    cut = settle(hash_cut(rest, ["__all"], "__h", F.ceil(F.col("n") * validation)).select("__all", "cut"), "cut")
    second = attach(rest, cut, ["__all"])
    named = first.filter("__test").select(col(group), F.lit("test").alias(part)).unionByName(
        second.select(col(group), F.when(F.col("__h") <= F.col("cut"), "validation").otherwise("train").alias(part)))
    return attach(df, settle(named, "parts"), [group])


def group_folds(df: DataFrame, label: str, group: str = "source_file", folds: int = 5) -> DataFrame:
    """``fold`` by whole groups, stratified: the groups whose class counts differ most go first, each to the fold that
    leaves the folds' shares of the classes most even (the emptier, then the lower fold on ties).

    One row per group (file) comes to the driver: its name and its class counts.
    """
    counts = df.groupBy(col(group).alias("g"), col(label).cast("string").alias("c")).agg(F.count("*").alias("n")).collect()
    classes = sorted({r["c"] or "" for r in counts})
    sizes: dict[object, list[int]] = {}
    for r in counts:
        sizes.setdefault(r["g"], [0] * len(classes))[classes.index(r["c"] or "")] += r["n"]
    total = [max(sum(s[k] for s in sizes.values()), 1) for k in range(len(classes))]
    held = [[0] * len(classes) for _ in range(folds)]

    def deviation(values: list[float]) -> float:
        mean = sum(values) / len(values)
        return (sum((v - mean) ** 2 for v in values) / len(values)) ** 0.5

    def uneven(i: int, more: list[int]) -> tuple[float, int, int]:
        own = [[h + m if j == i else h for h, m in zip(row, more)] for j, row in enumerate(held)]
        shares = [deviation([row[k] / total[k] for row in own]) for k in range(len(classes))]
        return round(sum(shares) / len(shares), 12), sum(held[i]), i

    rows = []
    for name, own in sorted(sizes.items(), key=lambda x: (-round(deviation(x[1]), 9), -sum(x[1]), x[0] is None, x[0] or "")):
        best = min(uneven(i, own) for i in range(folds))[2]
        held[best] = [h + m for h, m in zip(held[best], own)]
        rows.append((name, best))
    kind = df.schema[group].dataType.simpleString()
    dealt = df.sparkSession.createDataFrame(rows, f"`__group` {kind}, fold int").withColumnRenamed("__group", group)
    return attach(df, settle(dealt, "folds"), [group])


FOLD_ROWS = 2048  # rows that one window ranks


def row_folds(df: DataFrame, label: str, folds: int = 3, seed: int = 421, key: str = "row_key") -> DataFrame:
    """Stratified k-fold by rows: a row's fold is its rank by hash among the rows of its label, modulo ``folds``.

    Class counts of the folds differ by one at most. Ranks are counts of smaller hash buckets plus a rank inside the
    bucket; buckets hold some FOLD_ROWS rows, so no label is sorted in one task.
    """
    sizes = settle(df.groupBy(col(label).alias("__label")).agg(F.expr(f"(count(*) - 1) div {FOLD_ROWS} + 1").alias("__buckets")), "sizes")
    marked = attach(df.withColumns({"__label": col(label), "__h": seeded(seed, key)}), sizes, ["__label"], salt_by=[key])
    marked = marked.withColumn("__bucket", F.expr("shiftright(cast(conv(substring(__h, 1, 8), 16, 10) as bigint) * __buckets, 32)"))
    counts = settle(marked.groupBy("__label", "__bucket").agg(F.count("*").alias("n")), "counts")
    before = settle(offsets(counts, ["__label"], "__bucket", ["n"]).select("__label", "__bucket", "before_n"), "before")
    inside = F.row_number().over(Window.partitionBy("__label", "__bucket").orderBy("__h", col(key))) - 1
    placed = attach(marked.withColumn("__inside", inside), before, ["__label", "__bucket"], salt_by=[key])
    return placed.withColumn("fold", F.pmod(F.col("before_n") + F.col("__inside"), F.lit(folds)).cast("int")).select(
        *[col(c) for c in df.columns if c != "fold"], "fold")
