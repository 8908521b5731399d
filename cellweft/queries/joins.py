"""Joins on the cell key."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweft.operators import merging
from cellweft.queries.base import query, rounded
from cellweft.queries.fixtures import KEY, scored
from cellweft.sources.cells import cells

NAMES = ["CD3", "CD8"]
FIRST = """select *, row_number() over (partition by Image, x_um, y_um order by row_key) as r from"""


@query("join_01_merge_predictions", """select Image, x_um, y_um, prediction_cd3 as "Prediction_CD3",
    prediction_cd8 as "Prediction_CD8" from merged""", "merged")
def merge_predictions(spark, d):
    return merging.merge_predictions(scored(spark, d), NAMES, "inner", KEY).drop("__key")


@query("join_02_merge_outer", """select Image, x_um, y_um, max(case when marker = 'CD3' then prediction end) as "Prediction_CD3",
    max(case when marker = 'CD8' then prediction end) as "Prediction_CD8" from (select *, row_number() over (
      partition by marker, Image, x_um, y_um order by row_key) as r from scored) k where r = 1 group by 1, 2, 3""", "scored")
def merge_outer(spark, d):
    return merging.merge_predictions(scored(spark, d), NAMES, "outer", KEY).drop("__key")


@query("join_03_context", f"""select m.Image, m.x_um, m.y_um, c.source_file, c.cd31_cell_median, m.prediction_cd3 as "Prediction_CD3",
    m.prediction_cd8 as "Prediction_CD8" from merged m left join (select * from ({FIRST} (select * from cells
      where cd31_cell_median < 9)) t where r = 1) c
    on c.Image = m.Image and c.x_um = m.x_um and c.y_um = m.y_um""", "cells merged")
def context(spark, d):
    merged = merging.merge_predictions(scored(spark, d), NAMES, "inner", KEY)
    known = cells(spark, d).filter("cd31_cell_median < 9")
    return merging.join_context(merged, known, [*KEY, "source_file", "cd31_cell_median"], KEY)


@query("join_04_prob_intensity", f"""select c.row_key, c.Image, c.x_um, c.y_um, c.cd8_cell_median as intensity, p.prediction,
    p.probability from cells c join (select * from ({FIRST} (select * from scored where marker = 'CD8')) t where r = 1) p
    on p.Image = c.Image and p.x_um = c.x_um and p.y_um = c.y_um""", "cells scored")
def prob_intensity(spark, d):
    return merging.probability_intensity(scored(spark, d).filter("marker = 'CD8'"), cells(spark, d), "cd8_cell_median", KEY)


@query("join_07_context_tables", f"""select m.Image, m.x_um, m.y_um, c.source_file, m.prediction_cd3 as "Prediction_CD3",
    m.prediction_cd8 as "Prediction_CD8" from merged m left join (select * from ({FIRST} (select * from cells
      where source_file in ('batch_0.tsv', 'batch_1.tsv'))) t where r = 1) c
    on c.Image = m.Image and c.x_um = m.x_um and c.y_um = m.y_um""", "cells merged")
def context_tables(spark, d):
    c = cells(spark, d)
    parts = [c.filter("source_file = 'batch_0.tsv'"), c.filter("source_file = 'batch_1.tsv'"),
             c.filter("source_file = 'batch_2.tsv'").drop("x_um")]
    united = merging.unite_context(parts, ["source_file"], KEY)
    merged = merging.merge_predictions(scored(spark, d), NAMES, "inner", KEY)
    return merging.join_context(merged, united, ["source_file"], KEY)


@query("join_09_no_keys", "select row_key, cd3_cell_median from cells")
def no_keys(spark, d):
    c = cells(spark, d)
    return merging.join_context(c.select("row_key", "cd3_cell_median"), c, ["source_file"], KEY)
