"""Session set-up, lineage cuts and joins whose broadcast side is size-checked."""

from __future__ import annotations

import contextlib
import os
import tempfile
import threading
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A lookup side is broadcast only below this many values (rows x columns); at 8 to 64 bytes a
# value that is a few hundred MB at most. Larger sides take the salted shuffle join.
BROADCAST_VALUES = 4_000_000
SALTS = 32


def build_session(app: str = "cellweft", cores: int | str = "*", partitions: int | None = None,
                  memory: str = "16g", **conf: str) -> SparkSession:
    """A session with the settings the plans count on; on a cluster pass your own instead."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; a temporary one only where it is unset."""
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        base = tempfile.mkdtemp(prefix="cellweft-", dir=os.environ.get("TMPDIR"))
        context.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_root(spark: SparkSession) -> str:
    return f"{scratch_dir(spark)}/cellweft-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str = "table") -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete the tables this application stored; call it when no result depends on them any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_writing = threading.Lock()
_writers: dict[str, int] = {}
_before: dict[str, str | None] = {}


@contextlib.contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Spark deletes the shuffle files of queries that are run inside as soon as they end, not when it collects its garbage.

    For writes only: nothing asks for their shuffles again. Threads that write at the same time share the setting.
    """
    name = spark.sparkContext.applicationId
    with _writing:
        if not _writers.get(name):
            _before[name] = spark.conf.get(CLEANUP, None)
            spark.conf.set(CLEANUP, "true")
        _writers[name] = _writers.get(name, 0) + 1
    try:
        yield
    finally:
        with _writing:
            _writers[name] -= 1
            if not _writers[name]:
                before = _before.pop(name)
                spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def settle(df: DataFrame, name: str = "table", partition_by: tuple[str, ...] = (), codec: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage (a lost executor re-reads the table instead of redoing the fit), gives the
    optimizer the true size, and keeps later passes column-pruned.
    """
    path = scratch_path(df.sparkSession, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if codec:
        writer = writer.option("compression", codec)
    with brief_shuffles(df.sparkSession):
        writer.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._settled_at = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete tables that ``settle`` returned, once nothing that is still to be computed reads them."""
    for table in tables:
        path = table.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(table._settled_at)
        path.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """A top-level column whatever characters its name holds."""
    return F.col(quote(name))


def fits_broadcast(table: DataFrame, max_values: int = BROADCAST_VALUES) -> bool:
    limit = max(1, max_values // max(1, len(table.columns)))
    return table.limit(limit + 1).count() <= limit


def attach(rows: DataFrame, table: DataFrame, on: list[str], how: str = "left",
           max_values: int = BROADCAST_VALUES, salt_by: list[str] | None = None,
           known_rows: int | None = None, salted: bool = True) -> DataFrame:
    """Join a (usually small) lookup ``table`` to ``rows`` on NULL-safe keys.

    Keys must be unique in ``table``. Its size is counted first (unless ``known_rows`` tells): below the bound it is broadcast
    and ``rows`` is not shuffled; above it both sides are shuffled, ``rows`` spread over ``SALTS``
    salts a key so that one hot key cannot land in one task. ``salted=False`` is for tables as
    large as ``rows``: a plain shuffle join, whose skewed partitions adaptive execution splits.
    """
    keys = [f"__key_{i}" for i in range(len(on))]
    right = table.select(*[col(k).alias(n) for k, n in zip(on, keys)],
                         *[col(c) for c in table.columns if c not in on])
    left = rows
    condition = None
    for k, n in zip(on, keys):
        part = col(k).eqNullSafe(F.col(n))
        condition = part if condition is None else condition & part
    small = (fits_broadcast(table, max_values) if known_rows is None
             else known_rows * len(table.columns) <= max_values)
    if small:
        joined = left.join(F.broadcast(right), condition, how)
    elif not salted:
        joined = left.join(right, condition, how)
    else:
        spread = salt_by or (["row_key"] if "row_key" in rows.columns else rows.columns)
        # The task's number keeps copies of one row apart; a task that is run again keeps its number.
        mixed = F.xxhash64(*[col(c) for c in spread], F.spark_partition_id())
        left = left.withColumn("__salt", F.pmod(mixed, F.lit(SALTS)))
        right = right.withColumn("__salt_r", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        condition = condition & (F.col("__salt") == F.col("__salt_r"))
        joined = left.join(right, condition, how).drop("__salt", "__salt_r")
    return joined.drop(*keys)
