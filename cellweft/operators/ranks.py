"""Order-dependent operators that never sort a whole group in one task.

* ``first_per_key`` and ``top_per_key`` prune inside each map task before the shuffle.
* ``hash_cut`` finds the value that splits off exactly k rows of a group in hash order.
* ``running_totals`` makes prefix sums from totals of ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweft.operators.prefix import offsets
from cellweft.session import attach, col, settle

ALL = "__all"


def top_per_key(df: DataFrame, keys: list[Column], order: list[Column], n: int,
                rank: str = "rank") -> DataFrame:
    """The first n rows of each key. The rank filter lets Spark keep n rows per key in every map
    task, so a hot key shuffles n rows a task."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)


def first_per_key(df: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    """Drop later rows of a duplicated key; NULL parts of a key match each other."""
    return top_per_key(df, keys, order, 1, "__rank").drop("__rank")


def duplicate_keys(df: DataFrame, key: Column, table: str = "table_name") -> DataFrame:
    """Rows beyond the first of each key, per table: two aggregations, the key counted first."""
    per_key = df.groupBy(col(table), key.alias("__k")).agg(F.count("*").alias("__n"))
    return per_key.groupBy(table).agg(F.sum(F.col("__n") - 1).cast("long").alias("duplicates"))


# Leading hex digits that make the buckets of the hash order.
HASH_DIGITS = 3
HASH_LENGTH = 32
BUCKET_ROWS = 500_000  # rows that one window ranks or adds up


def hash_cut(df: DataFrame, groups: list[str], hash_column: str, wanted: Column,
             digits: int = HASH_DIGITS, rows: int | None = None) -> DataFrame:
    """(groups..., n, k, cut): ``hash <= cut`` holds for exactly ``k`` rows of the group.

    ``wanted`` computes k from the group size ``n``. Rows are counted per (group, leading digits); a running sum over
    those counts names the one bucket that holds the k-th row. While such a bucket has more than ``rows`` rows, they are
    counted by their next digits, so only that many are ranked. ``cut`` is '' when k is 0.
    """
    limit = BUCKET_ROWS if rows is None else rows
    keys = [col(g) for g in groups]
    over = Window.partitionBy(*keys)

    def holding(counts: DataFrame, left: str, head: str) -> DataFrame:
        """Of each group the bucket with the row number ``left``, and which row of the bucket that is."""
        placed = counts.withColumn("__upto", F.sum("__n").over(over.orderBy(head).rowsBetween(Window.unboundedPreceding, 0)))
        before = F.col("__upto") - F.col("__n")
        return placed.filter((F.col("__upto") >= F.col(left)) & (before < F.col(left))).withColumn("__row", F.col(left) - before)

    head = F.substring(F.col(hash_column), 1, digits)
    counts = settle(df.groupBy(*keys, head.alias("__head")).agg(F.count("*").cast("long").alias("__n")), "hash-counts")
    sized = counts.withColumn("n", F.sum("__n").over(over)).withColumn("k", wanted.cast("long"))
    bucket = settle(holding(sized, "k", "__head").select(
        *keys, "n", "k", F.col("__head").alias("__cut_head"), F.col("__row").alias("__left"), "__n"), "hash-bucket")
    seen = digits
    while True:
        own = df.select(*keys, F.col(hash_column))
        inside = attach(own, bucket.drop("__n"), groups, "inner", salt_by=[hash_column]).filter(
            F.substring(F.col(hash_column), 1, seen) == F.col("__cut_head"))
        most = bucket.agg(F.max("__n")).first()[0]
        if (most or 0) <= limit or seen >= HASH_LENGTH:
            break
        finer = inside.groupBy(*keys, "n", "k", "__cut_head", "__left", F.substring(F.col(hash_column), seen + 1, digits).alias(
            "__next")).agg(F.count("*").cast("long").alias("__n"))
        bucket = settle(holding(finer, "__left", "__next").select(
            *keys, "n", "k", F.concat("__cut_head", "__next").alias("__cut_head"), F.col("__row").alias("__left"), "__n"), "hash-bucket")
        seen += digits
    ranked = inside.withColumn("__r", F.row_number().over(over.orderBy(F.col(hash_column))))
    found = ranked.filter(F.col("__r") == F.col("__left")).select(*keys, "n", "k", F.col(hash_column).alias("cut"))
    none = sized.filter(F.col("k") <= 0).select(*keys, "n", "k").distinct().withColumn("cut", F.lit(""))
    return found.unionByName(none)


def running_totals(df: DataFrame, groups: list[str], order: str, sums: list[str],
                   descending: bool = True, buckets: int | None = None) -> DataFrame:
    """Adds ``cum_<c>`` for each summed column: totals of rows before and at each row.

    ``order`` must be unique within a group (aggregate by it first). Rows are dealt to ranges of (group, order), as many
    as their number asks for; the totals of earlier ranges are prefix sums of range totals, so no window holds a whole group.
    """
    data = settle(df, "ranked")
    if buckets is None:
        buckets = max(-(-data.count() // BUCKET_ROWS), 8)
    ranged = data.repartitionByRange(buckets, *[col(g) for g in groups], col(order)).withColumn(
        "__range", F.spark_partition_id().cast("long"))
    data = settle(ranged.withColumn("__bucket", F.lit(buckets - 1) - F.col("__range") if descending else F.col("__range"))
                  .drop("__range"), "ranges")
    totals = settle(data.groupBy(*[col(g) for g in groups], "__bucket").agg(*[F.sum(s).alias(s) for s in sums]), "totals")
    before = settle(offsets(totals, groups, "__bucket", sums).select(
        *[col(g) for g in groups], "__bucket", *[F.col(f"before_{s}").alias(f"__off_{s}") for s in sums]), "offsets")
    inner = F.col(order).desc() if descending else F.col(order).asc()
    inside = Window.partitionBy(*[col(g) for g in groups], F.col("__bucket")).orderBy(inner).rowsBetween(
        Window.unboundedPreceding, 0)
    placed = attach(data, before, [*groups, "__bucket"], "left", salt_by=[order])
    return placed.select(*[col(c) for c in df.columns], *[
        (F.sum(s).over(inside) + F.col(f"__off_{s}")).alias(f"cum_{s}") for s in sums])
