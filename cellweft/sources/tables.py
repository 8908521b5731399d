"""Reading directories of cell TSVs and writing tables.

A directory may hold files with different headers, in different orders. Spark would map later
files onto the first header by position, so all files are read as lines in one scan: tasks count the lines of
every split and find each file's header, only the distinct headers come to the driver, and a line's fields are
named by its own file's header. Line numbers come from those counts, so a row's key does not depend on how files are split.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellweft.functions.numeric import to_number
from cellweft.functions.text import clean_column, decode_name, na_to_null
from cellweft.session import attach, col, settle
from cellweft.sources import catalog

# A table is one `x.tsv` file, or a folder `x.tsv` of part files as Spark writes them, with an
# optional `key=` in front of the folder name.
TABLE_NAME = r"([^/=]+\.tsv)(/part-[^/]*)?$"
IS_TABLE = r"[^/=]\.tsv(/part-[^/]*)?$"  # true for the same paths, with a look at each character only: it is asked for every line
FILES = "{*.tsv,part-*}"
SMALLEST_SPLIT = 4 << 20  # Spark's cost of opening a file: splits are no smaller


@dataclass
class Dataset:
    """A directory of tables: ``splits`` has path, block, first_id, before (lines), number (of the header), header_id, source_file."""
    files: DataFrame          # path, source_file, size, number (null: no header)
    headers: list[list[str]]  # distinct headers, as clean and distinct names
    splits: DataFrame
    bound: int                # splits at most


def list_tables(spark: SparkSession, directory: str) -> DataFrame:
    """path, source_file, size of the TSV files of a dataset; contents are not read.

    Scans leave out files without a byte, so the names come from the scan's own list of files on the driver: a path per
    file, with no file opened.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", FILES).load(directory)
    paths = spark.createDataFrame([(p,) for p in found.inputFiles()], "path string")
    sizes = found.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"))
    listed = paths.where(F.col("path").rlike(TABLE_NAME)).join(sizes, "path", "left")
    return listed.select("path", table_name(F.col("path")).alias("source_file"), F.coalesce("size", F.lit(0)).alias("size"))


def table_name(path: Column) -> Column:
    # A name lies in the last two parts; the pattern would be tried at every character of those before, for every row of a stream.
    return decode_name(F.regexp_extract(F.substring_index(path, "/", -2), TABLE_NAME, 1))


def source_name() -> Column:
    """File name of a row: percent-decoded, the folder name for tables written in parts."""
    return table_name(F.col("_metadata.file_path"))


def lines(spark: SparkSession, directory: str) -> DataFrame:
    """value, path, block (start of the split), id (rising within a split) of all lines of all tables."""
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", FILES).text(directory)
    return raw.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
                      F.monotonically_increasing_id().alias("id")).where(F.col("path").rlike(IS_TABLE))


def header_names(header: str, drop_parentheses: bool = False) -> list[str]:
    """Clean names; a name that comes again gets ``.1``, ``.2``, so that its column is kept."""
    seen: dict[str, int] = {}
    out: list[str] = []
    for raw in header.split("\t"):
        name = clean_column(raw.strip().strip('"'), drop_parentheses)
        again = seen.get(name, 0)
        seen[name] = again + 1
        new = f"{name}.{again}" if again else name
        while again and new in seen:
            again += 1
            new = f"{name}.{again}"
        seen.setdefault(new, 1)
        out.append(new if name else "")
    return out


def open_dataset(spark: SparkSession, directory: str, drop_parentheses: bool = False) -> Dataset:
    """Two scans of the lines: one counts them by split, one takes the first line with text of every file."""
    listed = settle(list_tables(spark, directory), "files")
    total = listed.agg(F.count("*"), F.sum("size")).first()
    if not total[0]:
        raise FileNotFoundError(f"no .tsv tables in {directory}")
    bound = total[0] + (total[1] or 0) // SMALLEST_SPLIT
    text = lines(spark, directory)
    counted = text.groupBy("path", "block").agg(
        F.min("id").alias("first_id"), F.count("*").alias("n"), F.min(F.when(F.trim("value") != "", F.col("id"))).alias("text_id"))
    # A file's splits: its bytes / the split size, at most.
    over = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counted = settle(counted.withColumns({
        "before": F.coalesce(F.sum("n").over(over), F.lit(0)), "earlier_text": F.max("text_id").over(over).isNotNull()}), "splits")
    first = counted.where("text_id is not null and not earlier_text").select("path", "block", F.col("text_id").alias("header_id"))
    top = attach(text, first, ["path", "block"], "inner", known_rows=bound).where("id = header_id").select("path", "header_id", "value")
    top = settle(top.withColumn("value", F.regexp_replace("value", "\r$", "")), "headers")
    # One row per distinct header line.
    kinds = sorted(r["value"] for r in top.select("value").distinct().collect())
    numbered = settle(attach(top, spark.createDataFrame(list(zip(kinds, range(len(kinds)))), "value string, number int"), ["value"])
                      .drop("value"), "numbered")
    files = attach(listed, numbered, ["path"]).drop("header_id")
    splits = settle(attach(counted.select("path", "block", "first_id", "before"), numbered, ["path"], salt_by=["block"])
                    .withColumn("source_file", table_name(F.col("path"))), "splits")
    return Dataset(files, [header_names(k, drop_parentheses) for k in kinds], splits, bound)


def _pick(places: dict[int, int]) -> Column:
    """The field that holds a column, by the number of the line's header."""
    by_place: dict[int, list[int]] = {}
    for number, place in places.items():
        by_place.setdefault(place, []).append(number)
    out = None
    for place, numbers in by_place.items():
        hit = F.col("number").isin(*numbers)
        value = F.col(f"fields.c{place}")
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out


def text_columns(table: DataFrame, names: list[str]) -> set[str]:
    """Columns that hold a value which is neither missing nor a number."""
    if not names:
        return set()
    row = table.agg(*[F.max(na_to_null(col(n)).isNotNull() & to_number(col(n)).isNull()).alias(f"t{i}")
                      for i, n in enumerate(names)]).first()
    return {n for i, n in enumerate(names) if row[f"t{i}"]}


def read_quant(spark: SparkSession, directory: str, columns: list[str] | None = None,
               drop_parentheses: bool = False, missing_label: str = "skip",
               label: str = "Classification") -> DataFrame:
    """All tables of a dataset as one DataFrame with ``source_file`` and a stable ``row_key``.

    Columns absent from a file are NULL; NA texts are NULL. Centroids and features (``Marker: Compartment: Stat``) are
    doubles, whatever else stands in them NULL; so are other columns that hold numbers only. The rest stay texts.
    A second column of a name becomes ``name.1``. ``row_key`` is the hash of path and line number.
    ``missing_label``: ``fail`` raises when a file lacks the label column or has no header at all, otherwise its labels
    are NULL (``zero`` and ``skip`` differ only in the counts built on top).
    """
    data = open_dataset(spark, directory, drop_parentheses)
    if missing_label == "fail":
        having = [i for i, names in enumerate(data.headers) if label in names]
        lacking = data.files.where(~F.coalesce(F.col("number").isin(*having), F.lit(False)) if having else F.lit(True))
        if (one := lacking.agg(F.count("*").alias("n"), F.min("path").alias("path")).first())["n"]:
            raise ValueError(f"label column {label!r} is missing in {one['n']} file(s), first {one['path']}")
    places: dict[str, dict[int, int]] = {}
    for number, names in enumerate(data.headers):
        for place, name in enumerate(names):
            if name and (columns is None or name in columns):
                places.setdefault(name, {})[number] = place
    width = max([len(h) for h in data.headers], default=1)
    found = attach(lines(spark, directory), data.splits, ["path", "block"], "left", known_rows=data.bound)
    line = F.when(F.col("before").isNull(), F.raise_error(F.lit("files or split size changed since the dataset was opened"))).otherwise(
        F.col("before") + F.col("id") - F.col("first_id"))
    fields = F.from_csv("value", ", ".join(f"c{i} string" for i in range(width)), {"sep": "\t", "escape": '"', "mode": "PERMISSIVE"})
    rows = found.where("trim(value) <> '' and id <> header_id").select(
        "path", "source_file", line.alias("line"), "number", fields.alias("fields"))
    table = rows.select("source_file",
                        F.concat_ws("-", "path", F.lpad("line", 20, "0")).alias("ordinal"),
                        *[_pick(p).alias(n) for n, p in places.items()])
    unsure = [n for n in places if not catalog.is_metadata(n) and ":" not in n]
    texts = text_columns(table, unsure) | {n for n in places if catalog.is_metadata(n) and "centroid" not in n.lower()}
    return table.select("source_file", *[(na_to_null(col(n)) if n in texts else to_number(col(n))).alias(n) for n in places],
                        F.md5("ordinal").alias("row_key"), "ordinal")


def ingest(spark: SparkSession, directory: str, target: str, **options) -> DataFrame:
    """Read the TSVs once and keep them as parquet by source file; later passes are columnar."""
    read_quant(spark, directory, **options).write.mode("overwrite").partitionBy("source_file").parquet(target)
    return spark.read.parquet(target)


def files_of(spark: SparkSession, directory: str, label: str = "Classification") -> DataFrame:
    """One row per table with a flag for the label column; files without any line are tables without it."""
    data = open_dataset(spark, directory)
    having = [i for i, names in enumerate(data.headers) if label in names]
    has = F.coalesce(F.col("number").isin(*having), F.lit(False)) if having else F.lit(False)
    return data.files.groupBy("source_file").agg(F.max(has).alias("has_label"))


def clean_names(df: DataFrame, drop_parentheses: bool = False) -> DataFrame:
    return df.toDF(*[clean_column(c, drop_parentheses) for c in df.columns])


def project_labels(df: DataFrame, label: str) -> DataFrame:
    if label not in df.columns:
        raise ValueError(f"label column {label!r} is missing")
    return df.select(col(label))


def unite(tables: list[DataFrame], fill: str | None = None) -> DataFrame:
    """Bag union with outer columns. ``fill`` is for text exports only."""
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table, allowMissingColumns=True)
    if fill is not None:
        out = out.select(*[F.coalesce(col(c).cast("string"), F.lit(fill)).alias(c) for c in out.columns])
    return out


def _text(name: str, kind: str) -> Column:
    """Arrays and structs have no TSV form: they are written as JSON."""
    nested = kind.startswith(("array", "struct", "map"))
    return (F.to_json(col(name)) if nested else col(name)).alias(name)


def write_tsv(df: DataFrame, path: str, partition_by: list[str] | None = None, rows: int | None = None) -> None:
    """``rows``: each folder of ``partition_by`` gets a file for every so many rows, as ``write_by`` does, not one a task."""
    if rows and partition_by:
        df = _dealt(df, partition_by, rows)
    writer = (df.select(*[_text(n, k) for n, k in df.dtypes]).write.mode("overwrite")
              .option("sep", "\t").option("header", True).option("emptyValue", "")
              .option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.select(*[_text(n, k) for n, k in df.dtypes]).write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


FILE_ROWS = 5_000_000  # rows of a file of one value


def _dealt(df: DataFrame, columns: list[str], rows: int) -> DataFrame:
    """``df`` with the rows of each value of ``columns`` in as many tasks as it has files.

    Values are counted first, so a hot value is not one task's work and a rare one is not spread over a file per task.
    Files are numbered and a task writes the file of its number: by hash several files would meet in one task, more of
    them the more files there are.
    """
    sizes = settle(df.groupBy(*[col(c) for c in columns]).agg(
        F.ceil(F.count("*") / F.lit(rows)).cast("int").alias("__files")), "sizes")
    # One row per folder.
    before = Window.orderBy(*[col(c) for c in columns]).rowsBetween(Window.unboundedPreceding, -1)
    sizes = settle(sizes.withColumn("__first", F.coalesce(F.sum("__files").over(before), F.lit(0)).cast("int")), "sizes")
    dealt = attach(df, sizes, columns, salt_by=[c for c in df.columns])
    mixed = F.xxhash64(*[col(c) for c in df.columns if not df.schema[c].dataType.simpleString().startswith("map")])
    dealt = dealt.withColumn("__file", (F.col("__first") + F.pmod(mixed, F.col("__files"))).cast("int"))
    total = sizes.agg(F.sum("__files")).first()[0] or 1
    return dealt.repartitionById(total, F.col("__file")).drop("__file", "__files", "__first")


def write_by(df: DataFrame, path: str, *columns: str, rows: int = FILE_ROWS) -> None:
    """One folder per value (marker, image) with a file for every ``rows`` rows or part of them."""
    _dealt(df, list(columns), rows).write.mode("overwrite").partitionBy(*columns).parquet(path)
