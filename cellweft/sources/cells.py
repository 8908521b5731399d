"""A cell table derived from the ``lineitem`` test table (same text for Spark and the SQL check)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cellweft.settings import X, Y

CELLS_SQL = """
select row_key, concat('batch_', cast(k % 4 as varchar(9)), '.tsv') as source_file,
 concat('img_', cast(k as varchar(9))) as Image,
 (l_orderkey % 1000) * 0.5e0 as x_um, (l_partkey % 1000) * 0.5e0 as y_um,
 nullif(concat_ws('|',
   case when l_returnflag='A' then null when l_quantity>30 then 'CD3+' when l_quantity<10 then 'CD3-' end,
   case when l_linestatus='O' and l_extendedprice>60000 then 'CD8+'
        when l_linestatus='O' and l_extendedprice<20000 then 'CD8-' end,
   case when l_discount>=0.09 then ' CD31+'
        when k % 4 = 0 and l_discount<0.02 and l_quantity<5 then ' CD31-' end,
   case when l_tax>=0.08 and l_linenumber=1 then 'FOXP3+' end),'') as Classification,
 l_quantity as cd3_cell_median, l_extendedprice/1000 as cd8_cell_median,
 l_discount*100 as cd31_cell_median, l_tax*100 as na2_cell_median
from (select *, l_suppkey % 8 as k,
        md5(concat_ws('-', cast(l_orderkey as varchar(20)), cast(l_partkey as varchar(20)),
            cast(l_suppkey as varchar(20)), cast(l_linenumber as varchar(20)),
            cast(l_quantity as varchar(40)), cast(l_extendedprice as varchar(40)))) as row_key
      from {lineitem}) t
"""

# The same cells under `Marker: Compartment: Stat` names, with more statistics and a region.
QUOTED = {
    "CD3: Cell: Median": "cd3_cell_median",
    "CD3: Cell: Mean": "cd3_cell_median * 0.5e0 + na2_cell_median",
    "CD3: Nucleus: Median": "cd3_cell_median * 0.25e0",
    "CD3: Cytoplasm: Std.Dev.": "na2_cell_median * 0.5e0",
    "CD8: Cell: Median": "cd8_cell_median",
    "CD8: Cell: Mean": "cd8_cell_median * 0.5e0 + na2_cell_median",
    "CD31: Cell: Median": "cd31_cell_median",
    "CD31: Cell: Max": "cd31_cell_median + cd3_cell_median",
    "NA2: Cell: Median": "na2_cell_median",
    "NA2: Cell: Variance": "na2_cell_median * na2_cell_median",
    "HLA-DR: Cell: Median": "cd8_cell_median * 0.125e0",
    "Blank: Cell: Max": "1e0",
}
FEATURES = list(QUOTED)
BASIC = ["cd3_cell_median", "cd8_cell_median", "cd31_cell_median", "na2_cell_median"]


def quant_sql(mark: str) -> str:
    """``cells`` under the long column names; ``mark`` is the engine's identifier quote."""
    q = lambda name: f"{mark}{name}{mark}"
    names = ", ".join(f"{expr} as {q(name)}" for name, expr in QUOTED.items())
    return (f"select row_key, source_file, Image, x_um as {q(X)}, y_um as {q(Y)}, Classification, "
            f"concat('roi_', substr(row_key, 1, 1)) as ROI, {names} from ({CELLS_SQL}) c")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CELLS_SQL, lineitem=table(spark, sf_dir, "lineitem"))


def quant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(quant_sql("`"), lineitem=table(spark, sf_dir, "lineitem"))
