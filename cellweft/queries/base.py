"""Registry of runnable queries, each with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweft.session import col
from cellweft.sources.cells import CELLS_SQL, quant_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

CTES = {
    "cells": CELLS_SQL.format(lineitem="lineitem"),
    "quant": quant_sql('"').format(lineitem="lineitem"),
    "tok": """select row_key, source_file, Image, trim(t) as label from (
        select row_key, source_file, Image, unnest(string_split(Classification, '|')) as t
        from cells where Classification is not null) u""",
    "signed": "select distinct row_key, source_file, label from tok where label like '%+' or label like '%-'",
    "melted": """select row_key, source_file, Image, 'cd3_cell_median' as feature, cd3_cell_median as v from cells
        union all select row_key, source_file, Image, 'cd8_cell_median', cd8_cell_median from cells
        union all select row_key, source_file, Image, 'cd31_cell_median', cd31_cell_median from cells
        union all select row_key, source_file, Image, 'na2_cell_median', na2_cell_median from cells""",
    "thr": "select source_file, feature, quantile_cont(v, 0.12) as threshold from melted group by 1, 2",
    "cnt": "select source_file, label, count(*) as n from tok where label <> '' group by 1, 2",
    "files": "select distinct source_file from cells",
    "targets": """select f.source_file, m.label, m.feature, t.threshold from files f
        join (select distinct n.label, k.feature from (select distinct label from cnt where label like '%-') n
              join (select 'CD3' as marker, 'cd3_cell_median' as feature union all select 'CD8', 'cd8_cell_median'
                    union all select 'CD31', 'cd31_cell_median' union all select 'NA2', 'na2_cell_median') k
                on k.marker = left(n.label, length(n.label) - 1)) m on true
        left join cnt c on c.source_file = f.source_file and c.label = m.label
        join thr t on t.source_file = f.source_file and t.feature = m.feature
        where coalesce(c.n, 0) <= 1""",
    "picks": """select source_file, label, row_key, r from (
        select m.source_file, t.label, m.row_key,
               row_number() over (partition by m.source_file, t.label order by md5('421-' || t.label || m.row_key)) as r
        from melted m join targets t on t.source_file = m.source_file and t.feature = m.feature
        where m.v <= t.threshold) p where r <= 8""",
    "scored": """select row_key, source_file, Image, x_um, y_um, 'CD3' as marker,
          round(1/(1+exp(-(cd3_cell_median-25)/8)), 6) as probability,
          case when cd3_cell_median >= 25 then 1 else 0 end as prediction from cells
        union all select row_key, source_file, Image, x_um, y_um, 'CD8',
          round(1/(1+exp(-(cd8_cell_median-50)/20)), 6),
          case when cd8_cell_median >= 50 then 1 else 0 end from cells where na2_cell_median <> 3""",
    "truth": """select s.row_key, s.source_file, s.marker, s.prediction, s.probability,
          case when list_contains(t.labels, s.marker || '+') then 1 else 0 end as label
        from scored s join (select row_key, list(label) as labels from tok group by 1) t on t.row_key = s.row_key
        where list_contains(t.labels, s.marker || '+') or list_contains(t.labels, s.marker || '-')""",
    "merged": """select k.Image, k.x_um, k.y_um,
          max(case when marker = 'CD3' then prediction end) as prediction_cd3,
          max(case when marker = 'CD8' then prediction end) as prediction_cd8 from (
          select *, row_number() over (partition by marker, Image, x_um, y_um order by row_key) as r from scored) k
        where r = 1 group by 1, 2, 3 having count(distinct marker) = 2""",
    "train": """select distinct c.row_key, c.source_file, c.Classification, s.label,
          left(s.label, length(s.label) - 1) as marker
        from cells c join signed s on s.row_key = c.row_key""",
}
NEEDS = {"tok": ["cells"], "signed": ["tok"], "melted": ["cells"], "thr": ["melted"], "cnt": ["tok"],
         "files": ["cells"], "targets": ["files", "cnt", "thr"], "picks": ["melted", "targets"], "scored": ["cells"],
         "truth": ["scored", "tok"], "merged": ["scored"], "train": ["cells", "signed"]}


def with_ctes(body: str, *names: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        for need in NEEDS.get(name, []):
            visit(need)
        if name not in order:
            order.append(name)

    for n in names:
        visit(n)
    recursive = "recursive" in order
    order = [n for n in order if n != "recursive"]
    if not order:
        return body
    return ("with recursive " if recursive else "with ") + ",\n".join(f"{n} as ({CTES[n]})" for n in order) + "\n" + body


def query(name: str, sql: str | None = None, ctes: str = "cells"):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_ctes(sql, *ctes.split())
        return fn
    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded: the order of summation differs between engines."""
    return df.select(*[(F.round(col(n), digits) + F.lit(0.0)).alias(n) if t == "double" else col(n)
                       for n, t in df.dtypes])
